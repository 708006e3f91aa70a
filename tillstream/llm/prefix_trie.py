"""Trie of conversation prefixes.

Prefix digests are screened by a count-min sketch: where an estimate is one, the prefix belongs to one conversation only,
so that conversation's tail is emitted where it lies. Only prefixes that may be shared are shuffled, and grouped exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream.llm.common import stored
from tillstream.operators.skew import hot_keys, join_on_unique

BASE = 20  # a conversation shares its first turns with the one whose number is the next lower multiple
SHARED_TURNS = 4  # by a hash of its number: 0 to 3 of them
HOT_ROWS = 1000  # rows of one key that are kept apart in joins
SKETCH_LOAD = 8  # counters for each prefix, in each of the two rows of the sketch
SKETCH_BITS = (12, 25)  # least and most counters (a power of two) of a row; above it more prefixes count as shared
SLICE = 1 << 15  # counters merged at once
CHUNK = 4096  # conversation numbers joined into one text before they are hashed

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd; of the running digests
_SKETCH = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)  # odd; of the rows of the sketch
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROOT = bytes(16)
_WORDS = "[^\\x20\\x09-\\x0D]+"

NODE = "node binary, parent binary"


# ---- running sums over ordered groups of any size -----------------------------------------------

def _power(r: int, n: int) -> np.uint64:
    return np.uint64(pow(r, n, 1 << 64))


def _local_sums(columns: dict[str, int], group: str):
    """Place and running sums of each row in its group inside one piece (rows come ordered), and if it is the group's last there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, place0, sums0 = None, None, 0, {c: np.uint64(0) for c in columns}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            keys = batch[group].to_numpy()
            begins = np.append(True, keys[1:] != keys[:-1])
            starts = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
            goes_on = (starts == 0) & (keys[0] == now) if now is not None else np.zeros(n, dtype=bool)
            place = np.arange(n) - starts + 1
            added = []
            with np.errstate(over="ignore"):
                for c, r in columns.items():
                    powers = np.cumprod(np.full(n, r, dtype=np.uint64))[place - 1]
                    term = batch[c].to_numpy().view(np.uint64) * powers
                    term[goes_on] *= _power(r, place0)
                    total = np.cumsum(term)
                    total -= np.where(starts > 0, total[np.maximum(starts - 1, 0)], np.uint64(0))
                    total[goes_on] += sums0[c]
                    sums0[c] = total[-1]
                    added += [pa.array(total.view(np.int64)), pa.array((total - term).view(np.int64))]
            place[goes_on] += place0
            now, place0 = keys[-1], int(place[-1])
            last = np.append(begins[1:], False)
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(place), *added, pa.array(last)],
                                             names=[*batch.schema.names, "_place", *_sum_names(columns), "_last"])
            if held is not None:  # the last row of a batch waits for the next one
                yield _ended(held) if begins[0] and not goes_on[0] else held
            if n > 1:
                yield out.slice(0, n - 1)
            held = out.slice(n - 1)
        if held is not None:
            yield _ended(held)

    def _ended(row: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*row.columns[:-1], pa.array([True])], names=row.schema.names)

    return run


def _sum_names(columns: dict[str, int]) -> list[str]:
    return [name for c in columns for name in (f"{c}_upto", f"{c}_before")]


def _shifted(columns: dict[str, int], group: str, starts: dict, cut: set):
    """Add to the first group of every piece what the pieces before it hold of that group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = {name: batch[name].to_numpy(zero_copy_only=False).copy() for name in ("_place", *_sum_names(columns), "_last")}
            keys, pieces = batch[group].to_numpy(), batch["_piece"].to_numpy()
            for piece in np.unique(pieces).tolist():
                here = pieces == piece
                if (piece, True) in cut:
                    values["_last"][here & (keys == starts[piece][1][0])] = False
                first, place, sums = starts[piece][0]
                if place:
                    here &= keys == first
                    values["_place"][here] += place
                    with np.errstate(over="ignore"):
                        for (c, r), before in zip(columns.items(), sums):
                            for name in (f"{c}_upto", f"{c}_before"):
                                values[name].view(np.uint64)[here] *= _power(r, place)
                                values[name].view(np.uint64)[here] += np.uint64(before)
            names = [n for n in batch.schema.names if n != "_piece"]
            yield pa.RecordBatch.from_arrays([pa.array(values[n]) if n in values else batch[n] for n in names], names=names)

    return run


def running(rows: DataFrame, group: str, order: list[str], columns: dict[str, int]) -> DataFrame:
    """``rows`` with ``_place`` (from 1) in their group by ``order``, ``_last``, and running sums of columns times r**place, modulo 2**64.

    ``columns`` maps each summed column (long) to its r. A group may hold any share of the rows: rows are cut into pieces by
    range, summed inside their piece, and the first group of a piece is shifted by what lies before it. The driver gets one row a
    piece. The last of ``order`` should differ between rows, so that a range can end anywhere.
    """
    longs = [T.StructField(n, T.LongType()) for n in ("_place", *_sum_names(columns))]
    schema = T.StructType([*rows.schema.fields, *longs, T.StructField("_last", T.BooleanType())])
    sort = [group, *order]
    local = (
        rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .mapInArrow(_local_sums(columns, group), schema)
        .withColumn("_piece", F.spark_partition_id())
    )
    pieces = stored(local, "pieces")
    upto = [f"{c}_upto" for c in columns]
    edges = pieces.groupBy("_piece").agg(F.min(group).alias("first"), F.max(F.struct(group, "_place", *upto)).alias("end")).orderBy("_piece").collect()
    starts, cut, now, place, sums, before = {}, set(), None, 0, [0] * len(columns), None
    for e in edges:
        goes_on = place > 0 and e["first"] == now
        if goes_on:
            cut.add((before, True))
        starts[e["_piece"]] = ((e["first"], place, tuple(sums)) if goes_on else (e["first"], 0, ()), (e["end"][group],))
        whole = goes_on and e["end"][group] == now
        shift, base = (place, sums) if whole else (0, [0] * len(columns))
        sums = [(b + int(e["end"][f"{c}_upto"]) * pow(r, shift, 1 << 64)) % (1 << 64) for b, (c, r) in zip(base, columns.items())]
        now, place, before = e["end"][group], shift + e["end"]["_place"], e["_piece"]
    return pieces.mapInArrow(_shifted(columns, group, starts, cut), schema)


# ---- rebuilt conversations and their prefixes ---------------------------------------------------

def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % SHARED_TURNS).cast("int")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, lo, hi, words, place): turns of the rebuilt conversations as content hashes, and (conv_id) of all conversations."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("lo"), F.xxhash64(F.lit(2), role, text).alias("hi"),
        F.regexp_count(text, F.lit(_WORDS)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))
    placed = running(stored(turns, "turns"), "conv_id", ["turn", "lo", "hi", "row"], {}).select(
        "conv_id", F.col("_place").alias("at"), "lo", "hi", "words")
    placed = stored(placed, "placed")
    convs = placed.where("at = 1").select("conv_id", shared_turns(F.col("conv_id")).alias("h"))
    own = placed.where(F.col("at") > shared_turns(F.col("conv_id"))).select("conv_id", F.lit(1).alias("kind"), "at", "lo", "hi", "words")
    heads = placed.where((F.col("conv_id") % BASE == 0) & (F.col("at") < SHARED_TURNS)).withColumnRenamed("conv_id", "base")
    copies = convs.where("h > 0").withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE).join(heads, "base").where("at <= h")
    return own.unionByName(copies.select("conv_id", F.lit(0).alias("kind"), "at", "lo", "hi", "words")), convs.select("conv_id")


def _digest(lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """Two columns of eight bytes as one of sixteen."""
    n = len(lo)
    data = np.stack([lo, hi], axis=1).tobytes()
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * 16), pa.py_buffer(data)])


def _as_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b["conv_id"], b["_place"], b["words"], b["_last"], _digest(b["lo_upto"].to_numpy(), b["hi_upto"].to_numpy()),
             _digest(b["lo_before"].to_numpy(), b["hi_before"].to_numpy())], names=["conv_id", "depth", "words", "last", "node", "parent"])


def prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, words, last, node, parent) of every prefix with a turn, digests as 16 bytes; and all conversations."""
    turns, convs = rebuilt_turns(conversations)
    summed = running(turns, "conv_id", ["kind", "at"], dict(zip(("lo", "hi"), _MULTIPLIERS)))
    return stored(summed.mapInArrow(_as_nodes, f"conv_id long, depth long, words long, last boolean, {NODE}"), "prefixes"), convs


# ---- the sketch ---------------------------------------------------------------------------------

def _counters(digests: pa.Array, bits: int) -> list[np.ndarray]:
    """Number of the counter of each digest in each row of the sketch."""
    digests = digests.cast(pa.binary())
    first = np.frombuffer(digests.buffers()[1], dtype=np.int32)[digests.offset] if len(digests) else 0
    pairs = np.frombuffer(digests.buffers()[2] or b"", dtype=np.uint64, offset=int(first), count=2 * len(digests)).reshape(-1, 2)
    with np.errstate(over="ignore"):
        return [(((pairs[:, 0] ^ (pairs[:, 1] >> np.uint64(29)) * np.uint64(m)) + pairs[:, 1]) * np.uint64(m) >> np.uint64(64 - bits)).astype(np.int64)
                for m in _SKETCH]


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(_SKETCH), 1 << bits), dtype=np.uint8)  # they stop at two: more tells nothing
        for b in batches:
            for row, at in zip(counts, _counters(b["node"], bits)):
                used, times = np.unique(at, return_counts=True)
                row[used] = np.minimum(row[used] + np.minimum(times, 2), 2)
        for k, row in enumerate(counts):
            for s in range(0, len(row), SLICE):
                part = row[s:s + SLICE]
                if part.any():
                    yield pa.RecordBatch.from_pydict({"row": [k], "slice": [s // SLICE], "counts": [part.tobytes()]})

    return run


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for f in frames:
        for k, s, counts in zip(f["row"], f["slice"], f["counts"]):
            part = np.frombuffer(counts, dtype=np.uint8)
            sums[k, s] = np.minimum(sums[k, s] + part, 2) if (k, s) in sums else part
    for (k, s), part in sums.items():
        if (part > 1).any():
            yield pd.DataFrame({"row": [k], "slice": [s], "counts": [np.packbits(part > 1).tobytes()]})


def shared_counters(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Which counters of a count-min sketch of the prefix digests were met more than once, as bits (2 x 2**22 bytes at most).

    The size follows the number of prefixes. Each task fills a sketch of its own; their slices are added up in one shuffle.
    """
    bits = int(min(max(SKETCH_BITS[0], int(np.ceil(np.log2(SKETCH_LOAD * max(1, nodes.count()))))), SKETCH_BITS[1]))
    shape = "row long, slice long, counts binary"
    merged = nodes.select("node").mapInArrow(_count(bits), shape).repartition("row", "slice").mapInPandas(_merge, shape)
    crowded = np.zeros((len(_SKETCH), (1 << bits) // 8), dtype=np.uint8)
    size = min(SLICE, 1 << bits) // 8
    for r in merged.collect():
        crowded[r["row"], r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["counts"], dtype=np.uint8)
    return bits, crowded


def screened(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``shared`` and ``parent_shared``: false only where the sketch proves a single conversation."""
    bits, crowded = shared_counters(nodes)
    bitmap = nodes.sparkSession.sparkContext.broadcast(crowded)

    def met(digests: pa.Array) -> np.ndarray:
        found = np.ones(len(digests), dtype=bool)
        for row, at in zip(bitmap.value, _counters(digests, bits)):
            found &= (row[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            above = met(b["parent"]) | (b["depth"].to_numpy() == 1)  # the root is shared
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(met(b["node"])), pa.array(above)],
                                             names=[*b.schema.names, "shared", "parent_shared"])

    return nodes.mapInArrow(run, f"conv_id long, depth long, words long, last boolean, {NODE}, shared boolean, parent_shared boolean")


# ---- exact groups -------------------------------------------------------------------------------

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node in ordered (node, conv_id) rows as texts of at most ``CHUNK`` numbers."""
    for b in batches:
        nodes, convs = b["node"].to_pylist(), b["conv_id"].to_pylist()
        firsts = [i for i in range(len(nodes)) if i == 0 or nodes[i] != nodes[i - 1]]
        cuts = [c for a, z in zip(firsts, [*firsts[1:], len(nodes)]) for c in range(a, z, CHUNK)]
        yield pa.RecordBatch.from_pydict({
            "node": pa.array([nodes[a] for a in cuts], pa.binary()), "first": pa.array([convs[a] for a in cuts], pa.int64()),
            "joined": pa.array([",".join(map(str, convs[a:z])) for a, z in zip(cuts, [*cuts[1:], len(nodes)])], pa.string())})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined numbers of each node from its ordered chunks."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [state.hexdigest()]})

    for b in batches:
        for key, joined in zip(b["node"].to_pylist(), b["joined"].to_pylist()):
            if key == node:
                state.update(b",")
            else:
                if state is not None:
                    yield row()
                node, state = key, hashlib.sha256()
            state.update(joined.encode())
    if state is not None:
        yield row()


def _ends(members: DataFrame) -> DataFrame:
    """(node, ends_sha256). The hash runs over a list in order, so one task ends it; it gets the list in texts of many numbers."""
    ends = members.where("last").select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = ends.mapInArrow(_chunks, "node binary, first long, joined string")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; see the module's head for the method.

    ``conversations`` has (conv_id, turn, role, text); other columns are not read. Turns go by number, null first, and by a hash of
    role and text where numbers are equal; null role or text is empty; repeated rows are turns of their own; rows without conv_id
    belong to no conversation. A conversation c is rebuilt from the first h turns of c - c % 20 (the remainder has the sign of c)
    and its own turns after its first h, h = crc32 of its decimal number modulo 4. Without conversations there is no row.

    Prefixes are equal if 128 bits of hash are. A conversation or a group of copies may hold any share of the rows: turns are
    ordered by ranges, members of a node are combined before each shuffle, joins keep hot keys apart, and only the SHA-256 over
    the conversations that end in one node is sequential.
    """
    nodes, convs = prefixes(conversations)
    nodes = stored(screened(nodes), "screened")
    root = F.lit(_ROOT).cast("binary")
    turnless = convs.join(nodes.where("depth = 1").select("conv_id", F.lit(True).alias("_has")), "conv_id", "left")
    roots = turnless.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), F.col("_has").isNull().alias("last"),
                            root.alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(False).alias("parent_shared"))
    members = stored(nodes.where("shared").drop("shared").unionByName(roots), "members")
    tails = nodes.where("not shared")
    groups = stored(members.groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("parent").alias("parent"),
        F.max("parent_shared").alias("parent_shared")), "groups")
    below = groups.where("parent_shared").select(F.col("parent").alias("node")).unionByName(
        tails.where("parent_shared").select(F.col("parent").alias("node")))
    groups = groups.join(below.groupBy("node").agg(F.count(F.lit(1)).alias("n_children")), "node", "left").na.fill(0, ["n_children"])

    # What a conversation adds to every node it is a member of: its leaf, and the savings of the nodes it is the first member of.
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    owned = stored(groups.select("*", saved), "owned")
    leaf = F.lit(1).cast("long").alias("leaf")
    own = owned.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    values = own.unionByName(tails.where("last").select("conv_id", F.lit(0).cast("long").alias("saved"), leaf)).groupBy("conv_id").agg(
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")).where("saved > 0 or leaf > 0")
    added = join_on_unique(members.select("conv_id", "node"), values, "conv_id", hot_keys(members, "conv_id", HOT_ROWS))
    subtree = added.groupBy("node").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("_saved"))
    above = running(owned, "conv_id", ["depth"], {"saved": 1})
    whole = (
        above.join(subtree, "node").join(_ends(members), "node", "left")
        .select("conv_id", "depth", "n_convs", "n_children", "n_leaves", (F.col("_saved") - F.col("saved_before")).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"), "parent", "parent_shared")
    )
    one = F.lit(1).cast("long")
    alone = tails.select(
        "conv_id", "depth", one.alias("n_convs"), F.when(F.col("last"), 0).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_EMPTY).alias("ends_sha256"), "parent", "parent_shared")

    # Where the parent may be shared, its first member comes from its group; else it is the same conversation.
    both = whole.unionByName(alone)
    asking = both.where("parent_shared")
    hot = hot_keys(below.withColumnRenamed("node", "parent"), "parent", HOT_ROWS)
    named = join_on_unique(asking, owned.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent", hot)
    rest = both.where("not parent_shared").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return named.select(*names).unionByName(rest.select(*names))
