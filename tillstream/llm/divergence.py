"""Divergence audit of sources: which terms a source uses more than its language does, and how far sources lie apart.

Every shard (a slice of an Arrow batch) sorts pointers to its word starts by multikey quicksort with characters of
eight bytes. Equal runs of the sorted pointers give the number of occurrences and of documents per group and term, and
one shuffle adds them up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.common import stored

LEAST_DOCUMENTS = 10  # a term is kept if at least so many documents of its language hold it
TOP_TERMS = 10
SHARD_BYTES = 8 << 20  # text sorted at once
HELD_ROWS = 1_500_000  # counts combined inside a task before they are handed on
LEAF = 1 << 18  # pointers sorted by one call; larger slices are partitioned around a pivot
TILE = 256  # sources compared with each other at once
SALTS = 64  # parts of the terms of one language and pair of tiles
BLOCK = 1 << 18  # cells of a block of terms x sources
UNIT = 1_000_000_000

COUNTS = "lang string, source string, term string, n long, docs long"
SUMS = "lang string, left string, right string, value long"

# Bytes that are no part of a term become 0, capital ASCII letters small ones.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:0x41] = _BYTES[0x5B:0x61] = _BYTES[0x7B:0x80] = 0
_BYTES[0x41:0x5B] += 0x20
_MASKS = np.array([(1 << 64) - (1 << 8 * (8 - k)) for k in range(9)], dtype=np.uint64)


class _Pointers:
    """Starts and lengths of the words of a byte buffer, and the order of their words."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.starts, self.lengths = starts, lengths
        padded = np.zeros(len(data) + 8, dtype=np.uint8)
        padded[:len(data)] = data
        self.characters = np.ndarray(shape=(len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))

    def character(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        """The ``depth``-th eight bytes of the words at ``pointers``, zeros after their end."""
        left = np.clip(self.lengths[pointers] - 8 * depth, 0, 8)
        at = np.minimum(self.starts[pointers] + 8 * depth, len(self.characters) - 1)
        return self.characters[at].astype(np.uint64) & _MASKS[left]

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Pointers in the order of their words (equal words in the order they came in), and where a new word begins."""
        order = np.arange(len(self.starts), dtype=np.int64)
        begins = np.zeros(len(order), dtype=bool)
        slices = [(0, len(order), 0)] if len(order) else []
        while slices:
            low, high, depth = slices.pop()
            part = order[low:high]
            if high - low <= LEAF:
                order[low:high], begins[low:high] = self._leaf(part, depth)
                continue
            keys = self.character(part, depth)
            sample = np.sort(keys[::max(1, len(keys) // 63)])
            pivot = sample[len(sample) // 2]
            less, more = keys < pivot, keys > pivot
            same = ~(less | more)
            a, b = low + int(less.sum()), high - int(more.sum())
            order[low:high] = np.concatenate([part[less], part[same], part[more]])
            if a > low:
                slices.append((low, a, depth))
            if high > b:
                slices.append((b, high, depth))
            if pivot & np.uint64(255):  # the words go on
                slices.append((a, b, depth + 1))
            else:
                begins[a] = True
        return order, begins

    def _leaf(self, part: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """A slice sorted whole: all its runs that are still equal go to the next character together."""
        keys = self.character(part, depth)
        at = np.argsort(keys, kind="stable")
        part, keys = part[at], keys[at]
        begins = np.ones(len(part), dtype=bool)
        begins[1:] = keys[1:] != keys[:-1]
        unsure = np.flatnonzero(keys & np.uint64(255))
        while True:
            run = np.cumsum(begins)
            sizes = np.bincount(run)
            unsure = unsure[sizes[run[unsure]] > 1]
            if not len(unsure):
                return part, begins
            depth += 1
            here, key = part[unsure], self.character(part[unsure], depth)
            at = np.lexsort((key, run[unsure]))
            here, key, runs = here[at], key[at], run[unsure]
            part[unsure] = here
            begins[unsure[1:]] |= (key[1:] != key[:-1]) & (runs[1:] == runs[:-1])
            unsure = unsure[(key & np.uint64(255)) != 0]


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words in mapped bytes; no word goes over a bound between texts."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = data != 0
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    cuts = cuts[inside[cuts + 1] & inside[cuts]]
    first[cuts], last[cuts - 1] = True, True
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def _text_column(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    chars = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(chars))


def shard_counts(texts: pa.Array, groups: np.ndarray) -> pa.Table:
    """(group, term, n, docs) of one shard whose texts are ordered by group."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = _BYTES[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[bounds[0]:bounds[-1]]]
    bounds = bounds - bounds[0]
    starts, lengths = _words(data, bounds)
    pointers = _Pointers(data, starts, lengths)
    order, begins = pointers.sort()
    document = (np.searchsorted(bounds, starts, side="right") - 1)[order]
    group = groups[document]
    begins[1:] |= group[1:] != group[:-1]
    rows = np.flatnonzero(begins)
    begins[1:] |= document[1:] != document[:-1]
    documents = np.cumsum(begins)
    ends = np.append(rows[1:], len(order))
    at = order[rows]
    docs = documents[ends - 1] - documents[rows] + 1 if len(rows) else rows
    return pa.table({"group": group[rows], "term": _text_column(data, starts[at], lengths[at]), "n": ends - rows, "docs": docs})


def _combined(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["group", "term", "n", "docs"])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task, combined as long as they are few."""
    numbers: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def named(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = list(numbers)
        langs, sources = (pa.array([x[k] for x in names], pa.string()) for k in (0, 1))
        for part in table.to_batches(max_chunksize=50_000):
            yield pa.RecordBatch.from_arrays(
                [langs.take(part["group"]), sources.take(part["group"]), part["term"], part["n"], part["docs"]],
                names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        keys = list(zip(batch["lang"].to_pylist(), batch["source"].to_pylist()))
        for key in keys:
            numbers.setdefault(key, len(numbers))
        groups = np.array([numbers[k] for k in keys], dtype=np.int64)
        order = np.argsort(groups, kind="stable")
        sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)[order].astype(np.int64))
        shard = sizes // SHARD_BYTES
        for rows in np.split(order, np.flatnonzero(np.diff(shard)) + 1):
            if len(rows):
                held.append(shard_counts(batch["text"].take(pa.array(rows)), groups[rows]))
        if sum(t.num_rows for t in held) > HELD_ROWS:
            held = [_combined(held)]
            if held[0].num_rows > HELD_ROWS // 2:
                yield from named(held.pop())
    if held:
        yield from named(_combined(held))


def term_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, docs, n_lang) of the kept terms: occurrences and documents in the group, occurrences in the language."""
    texts = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = texts.mapInArrow(_count_terms, COUNTS).repartition("lang", "term")
    kept = (  # it reads every column, so that both uses of the counts share one exchange
        counts.groupBy("lang", "term").agg(F.sum("docs").alias("_all"), F.sum("n").alias("n_lang"), F.count("source").alias("_parts"))
        .where((F.col("_all") >= least_documents) & (F.col("_parts") > 0)).drop("_all", "_parts")
    )
    return (
        counts.join(kept.hint("shuffle_hash"), ["lang", "term"])
        .groupBy("lang", "term", "source", "n_lang").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .select("lang", "source", "term", "n", "docs", "n_lang")
    )


def smoothed(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exact for any counts; null where there are no terms."""
    scaled = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", scaled, F.nullif(total + 2 * terms, F.lit(0)).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the divergence of all pairs of sources of one key; takes rows ordered by key, heads (no term) first.

    Heads name the sources of the key with their value for a missing term. Terms are compared in blocks of a matrix with a
    column per source; for the terms that no source of the key has, only their number matters.
    """
    def frame(key, heads, sums, terms) -> pa.RecordBatch:
        _, low, high, salt = key
        tile = np.array([h[1] for h in heads])
        p, v = np.array([h[2] for h in heads], dtype=np.int64), heads[0][3]
        i, j = np.triu_indices(len(heads), 1)
        wanted = (tile[i] == low) & (tile[j] == high)
        i, j = i[wanted], j[wanted]
        missing = (p[i] - p[j]) ** 2 // np.maximum(p[i] + p[j], 1)
        names = pa.array([h[0] for h in heads], pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(i), pa.string()), names.take(pa.array(i)), names.take(pa.array(j)),
             pa.array(sums[i, j] + missing * ((v if salt == 0 else 0) - terms))], names=["lang", "left", "right", "value"])

    def add(block, sums) -> None:
        for k in range(block.shape[1] - 1):
            p, q = block[:, k:k + 1], block[:, k + 1:]
            sums[k, k + 1:] += ((p - q) ** 2 // (p + q)).sum(axis=0)

    key, heads, columns, block, filled, term, terms, sums = None, [], {}, None, 0, None, 0, None
    for batch in batches:
        for lang, low, high, salt, word, source, tile, p, v in zip(*(c.to_pylist() for c in batch.columns)):
            if (lang, low, high, salt) != key:
                if key is not None:
                    if filled:
                        add(block[:filled], sums)
                    yield frame(key, heads, sums, terms)
                key, heads, columns, block, filled, term, terms = (lang, low, high, salt), [], {}, None, 0, None, 0
            if word is None:
                columns[source] = len(heads)
                heads.append((source, tile, p, v))
                sums = np.zeros((len(heads), len(heads)), dtype=np.int64) if len(heads) == 1 or block is None else sums
                continue
            if block is None:
                sums = np.zeros((len(heads), len(heads)), dtype=np.int64)
                base = np.array([h[2] for h in heads], dtype=np.int64)
                block = np.empty((max(1, BLOCK // len(heads)), len(heads)), dtype=np.int64)
            if word != term:
                if filled == len(block):
                    add(block, sums)
                    filled = 0
                block[filled] = base
                term, filled, terms = word, filled + 1, terms + 1
            block[filled - 1, columns[source]] = p
    if key is not None:
        if filled:
            add(block[:filled], sums)
        yield frame(key, heads, sums, terms)


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all pairs of sources of a language."""
    tiles = F.sequence(F.lit(0), F.col("tiles") - 1)

    def keyed(df: DataFrame, salt: Column, term: Column, p: str) -> DataFrame:
        other = df.withColumn("_other", F.explode(tiles))
        low, high = F.least("tile", "_other"), F.greatest("tile", "_other")
        return other.select("lang", low.alias("low"), high.alias("high"), salt.cast("int").alias("salt"), term.alias("term"), "source", "tile",
                            F.coalesce(F.col(p), F.lit(0)).cast("long").alias("p"), F.col("v").cast("long").alias("v"))

    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS))
    # Salts and tiles of a key are few, so keys are dealt by all four columns; each part holds its own heads.
    heads = keyed(groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), F.col("_salt"), F.lit(None).cast("string"), "p0")
    key = ["lang", "low", "high", "salt"]
    ordered = heads.unionByName(keyed(rows, salt, F.col("term"), "p")).repartition(*key).sortWithinPartitions(*key, "term", "source")
    sums = ordered.mapInArrow(_pair_sums, SUMS).groupBy("lang", "left", "right").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("left").alias("source"), F.col("right").alias("item")),
                   F.struct(F.col("right").alias("source"), F.col("left").alias("item")))
    return sums.select("lang", F.explode(both).alias("_pair"), "value").select("lang", "_pair.*", "value")


def audit_sources(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank), part ``term`` or ``pair``.

    ``docs`` has lang, source and text; other columns are not read. Null lang, source and text are empty; repeated rows are
    documents of their own; a group without a kept term has its pairs, and no terms; an empty table gives no rows. Ties go
    by item. Terms are runs of letters (all characters that are not ASCII, and ASCII letters in small form).

    Kept counts and the table of groups are stored and read again. A shard holds ``SHARD_BYTES`` of text (or one longer
    text) and pointers to its words; a task combines at most ``HELD_ROWS`` counts. Terms are dealt by language and term,
    so neither a large source nor a large language meets in one task.
    """
    counts = stored(term_counts(docs, least_documents), "term-counts")
    occurring = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    terms = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = occurring.join(sums, ["lang", "source"], "left").na.fill(0, ["n"])
    by_lang = totals.groupBy("lang").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("_sources")).join(terms, "lang", "left").na.fill(0, ["v"])
    place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("_place")
    groups = totals.join(by_lang, "lang").select("*", place).select(
        "lang", "source", "v", F.floor(F.col("_place") / TILE).cast("int").alias("tile"),
        F.ceil(F.col("_sources") / TILE).cast("int").alias("tiles"), "n", "n_all")
    groups = stored(groups.withColumn("p0", smoothed(F.lit(0), F.col("n"), F.col("v"))), "term-groups")
    rows = (
        counts.withColumnRenamed("n", "_n").join(groups, ["lang", "source"])
        .withColumns({"p": smoothed(F.col("_n"), F.col("n"), F.col("v")), "q": smoothed(F.col("n_lang"), F.col("n_all"), F.col("v"))})
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        rows.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    )
    pairs = _pairs(rows, groups).withColumn("rank", F.row_number().over(ranked))
    shape = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*shape).unionByName(terms.withColumn("part", F.lit("term")).select(*shape))
