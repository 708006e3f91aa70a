"""Exact Jaccard join of word-shingle sets by universe partitioning and the pigeonhole principle.

Two sets r, s with Jaccard similarity of at least 3/4 differ in at most H = (|r| + |s|) / 7 elements. The hash
universe is cut into segments, their number fixed by size band. Each differing element spoils one segment, so of
any H + 1 segments that r occupies, s has at least one unchanged. A set therefore indexes the subsets it has in
H + 1 segments, and the allocation picks the cheapest ones: segments whose rarest element is rarest in the corpus,
in one order for all sets, so two similar sets always meet in a segment that both picked (the argument of prefix
filters, on segments). Sets that occupy too few segments index all of them and add one-deletion neighbourhoods:
a segment that may differ by one counts for two; if even that is too little, they index single elements too.

Sets that meet become candidates of the smallest set they meet with and are verified exactly. Groups of linked
sets are found as connected components; only where candidates failed are other pairs that met verified as well, first
those that suffice to connect a group, then whatever pairs of sets that are still apart are left.
Before texts are fetched, a pair is dropped if the parity sketches of its sets differ in more bits than linked sets
may differ in elements, which proves that they do not link.
Equal sets are one node, numbered by a 64-bit hash of the set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tillstream.llm.common import forget_kept, stored

SHINGLE = 5
SKETCH_BITS = 19  # counters of the commonness sketch: its size is fixed, whatever the corpus
SLICES = 64
PACKED = 1 << 20  # entries of the index packed by one task at a time
PARTS = 1 << 10  # ranges of signatures that the index is dealt by, at least
GROUP_ROWS = 1 << 14  # expected rows of one segment subset in one group; commoner ones are dealt over several
BLOCK = 1024  # members of one segment subset compared by one task with as many others at a time
MEMBERS = 500  # candidates of one set verified by one task at a time
FORESTS = (2, None)  # likely pairs verified of groups that are not linked yet: of so many spanning forests, at last all that are left
FILTER_BITS = 23  # of the filter that says which texts may be wanted: its size is fixed, whatever the corpus
FEW = 1 << 11  # wanted texts; for so few Spark sends their list to all texts by itself
EDGES = 1 << 17  # links contracted by one task at a time

_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MUL[1]
    x = (x ^ (x >> np.uint64(27))) * _MUL[2]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles; a shorter text is one shingle, no word is no shingle.

    Words are runs of anything but ASCII white space, with A-Z in lower case.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = _mix(out * _MUL[0] + hashes[i:len(hashes) - width + 1 + i])
    return np.unique(out)


def set_number(shingles: np.ndarray) -> int:
    """Node number of a set."""
    total = int(_mix(shingles ^ _MUL[0]).sum(dtype=np.uint64)) + len(shingles) * int(_MUL[2])
    return (total + 2 ** 63) % 2 ** 64 - 2 ** 63


def parity_sketch(shingles: np.ndarray) -> bytes:
    """For each residue of the elements, modulo a power of two of at least 2n, the parity of their number.

    Sets that differ in d elements differ in at most d bits. A longer sketch folds onto a shorter one.
    """
    size = 1 << max(6, (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """In how many bits two parity sketches differ: never more than their sets differ in elements."""
    short, long = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(long) > len(short):
        long = long[:len(long) // 2] ^ long[len(long) // 2:]
    return int(np.bitwise_count(short ^ long).sum())


def _band(n: int) -> int:
    """Size band: sizes from 4**band to 4**(band + 1) - 1."""
    return (n.bit_length() - 1) // 2


def _counters(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counter and sign of each element in the sketch: with signs, elements that share a counter cancel out on average."""
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1 - 2 * (shingles & np.uint64(1)).astype(np.int64)


def _costs(shingles: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """log2 of the estimated corpus count of each element."""
    at, sign = _counters(shingles)
    return np.ceil(np.log2(np.maximum(sketch[at] * sign, 1))).astype(np.uint8)


def _roles(n: int) -> list[tuple[int, int]]:
    """(band, most differing elements) that a set of size n joins in: its own, and the one below if partners lie there."""
    own = _band(n)
    roles = [(own, (n + 4 * n // 3) // 7)]
    if own and 3 * n <= 4 * (4 ** own - 1):
        roles.append((own - 1, (n + 4 ** own - 1) // 7))
    return roles


def signatures(shingles: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, log2 of how common it may be) of the segment subsets that a set indexes.

    ``sketch`` has the signed corpus counts of all counters.
    """
    found, costs = [], []
    element, cost = _mix(shingles), _costs(shingles, sketch)
    for band, differing in _roles(len(shingles)):
        segments = np.uint64(4 * 4 ** band)
        segment = _mix(shingles ^ np.uint64(band + 1)) % segments
        order = np.argsort(segment, kind="stable")
        segment, own, own_cost = segment[order], element[order], cost[order]
        starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        total = np.add.reduceat(own, starts)
        label = segment[starts] * np.uint64(64) + np.uint64(band)
        exact, price = _mix(total * _MUL[0] + label), np.minimum.reduceat(own_cost, starts)
        if len(starts) > differing:
            cheap = np.lexsort((exact, price))[:differing + 1]
            found.append(exact[cheap])
            costs.append(price[cheap])
            continue
        found.append(exact)
        costs.append(price)
        counts = np.diff(np.append(starts, len(own)))
        for s, k, t, tag in zip(starts, counts, total, label):
            if k > 1:  # subsets without one element
                found.append(_mix((t - own[s:s + k]) * _MUL[0] + tag))
                costs.append(np.array([np.delete(own_cost[s:s + k], i).min() for i in range(k)]))
        if np.minimum(counts, 2).sum() <= differing:
            found.append(_mix(own + np.uint64(band) * _MUL[2]))
            costs.append(own_cost)
    return np.concatenate(found), np.concatenate(costs)


def _scan_sets(docs: DataFrame) -> DataFrame:
    """One pass over all texts: (doc_id, n, node, bits) for each row, and the task's sketch of element counts in slices."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_kept()  # in a pipeline, workers come from other operators
        sketch, seen = np.zeros(1 << SKETCH_BITS, dtype=np.int64), set()
        for f in frames:
            sets = [shingle_set(t) for t in f.text]
            nodes = [set_number(s) for s in sets]
            for at in range(0, len(sets), 500):
                new = {n: s for n, s in zip(nodes[at:at + 500], sets[at:at + 500]) if n not in seen}  # equal sets count once a task
                seen.update(new)
                if new:
                    counter, sign = _counters(np.concatenate(list(new.values())))
                    sketch += np.bincount(2 * counter + (sign > 0), minlength=2 * len(sketch)).reshape(-1, 2) @ [-1, 1]
            yield pd.DataFrame({"doc_id": f.doc_id, "n": [len(s) for s in sets], "node": nodes,
                                "bits": [parity_sketch(s) for s in sets], "slice": None, "counts": None})
        parts = np.split(sketch.astype("<i4"), SLICES)
        yield pd.DataFrame({"doc_id": None, "n": 0, "node": 0, "bits": None, "slice": range(SLICES), "counts": [p.tobytes() for p in parts]})

    # Numbers pass as text, since pandas turns a column of numbers with a null in it into doubles.
    scanned = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").mapInPandas(
        run, "doc_id string, n long, node long, bits binary, slice int, counts binary")
    return scanned.withColumn("doc_id", F.col("doc_id").cast("long"))


def _sketch(scanned: DataFrame) -> np.ndarray:
    """The signed corpus counts of all sketch counters, added up on the cluster."""
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for f in frames:
            for at, raw in zip(f["slice"], f.counts):
                sums[at] = sums.get(at, 0) + np.frombuffer(raw, dtype="<i4").astype(np.int64)
        yield pd.DataFrame({"slice": list(sums), "counts": [v.tobytes() for v in sums.values()]})

    parts = scanned.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice")
    rows = parts.mapInPandas(add, "slice int, counts binary").collect()  # 64 rows of fixed size
    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), dtype=np.int64)
    for r in rows:
        out[r["slice"]] = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
    return out.ravel()


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of numbers, all lowest bytes first: of sorted or small ones the high bytes compress to nothing."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(planes: pd.Series, width: int) -> np.ndarray:
    """The numbers of several ``_planes``, one after the other."""
    out = []
    for raw in planes:
        wide = np.zeros((len(raw) // width, 8), dtype=np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
        out.append(wide.view("<i8").ravel())
    return np.concatenate(out)


def _packed(sig: np.ndarray, salts: np.ndarray, node: np.ndarray, n: np.ndarray, parts: int) -> pd.DataFrame:
    """Entries of the index (sig of 48 bits) as one row per range of signatures: (part, salts, sig, node, n), sorted by sig.

    A row of a shuffle for each entry would hold little but its headers, and the less compressible the more partitions there are.
    Entries of a subset that is dealt over several groups go to the ranges of these groups.
    """
    salt = (node % salts).view(np.uint64)
    place = np.where(salts > 1, _mix(sig.view(np.uint64) + salt * _MUL[0]) >> np.uint64(16), sig.view(np.uint64))
    part = (place >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)
    order = np.argsort(sig) if (salts == 1).all() else np.lexsort((sig, salts, part))
    sig, salts, node, n, part = (x[order] for x in (sig, salts, node, n, part))
    cuts = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (salts[1:] != salts[:-1]), [True])))
    ranges = list(zip(cuts[:-1], cuts[1:]))
    return pd.DataFrame({
        "part": part[cuts[:-1]].astype(np.int32), "salts": salts[cuts[:-1]].astype(np.int32), "sig": [_planes(sig[s:e], 6) for s, e in ranges],
        "node": [node[s:e].astype("<i8").tobytes() for s, e in ranges], "n": [_planes(n[s:e], 4) for s, e in ranges]})


def _index(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """The index (sig, salts, node, n) of every set, ``_packed``, with 48 bits of each signature; a task indexes equal sets once."""
    usual = int(GROUP_ROWS).bit_length() - 1
    parts = max(PARTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_kept()
        seen: set[int] = set()
        columns: list[list[np.ndarray]] = [[], [], [], []]
        entries = 0
        for f in frames:
            for text in f.text:
                shingles = shingle_set(text)
                if not len(shingles) or (node := set_number(shingles)) in seen:
                    continue
                seen.add(node)
                sig, cost = signatures(shingles, sketch)
                salts = 1 << np.maximum(cost.astype(np.int64) - usual, 0)
                for column, values in zip(columns, ((sig >> np.uint64(16)).view(np.int64), salts, np.full(len(sig), node), np.full(len(sig), len(shingles)))):
                    column.append(values)
                entries += len(sig)
                if entries >= PACKED:
                    yield _packed(*map(np.concatenate, columns), parts)
                    columns, entries = [[], [], [], []], 0
        if entries:
            yield _packed(*map(np.concatenate, columns), parts)

    return docs.where("doc_id is not null").select("text").mapInPandas(run, "part int, salts int, sig binary, node binary, n binary")


def _shared(index: DataFrame) -> DataFrame:
    """(sig, salt, salts, node, n) of the entries of the packed ``index`` whose subset another set has too.

    Groups of the same members stay once in each range of signatures, under the smallest. Entries of subsets that are dealt
    over several groups all stay.
    """
    def run(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for salts, same in f.groupby("salts"):
            sig, n, node = _numbers(same.sig, 6), _numbers(same.n, 4), np.frombuffer(b"".join(same.node), "<i8")
            if salts == 1:  # most entries have a signature alone
                _, of, rows = np.unique(sig, return_inverse=True, return_counts=True)
                sig, node, n = (x[rows[of] > 1] for x in (sig, node, n))
            salt = node % salts
            order = np.lexsort((node, salt, sig))
            sig, salt, node, n = (x[order] for x in (sig, salt, node, n))
            starts = np.concatenate(([True], (sig[1:] != sig[:-1]) | (salt[1:] != salt[:-1])))[:len(sig)]
            once = np.concatenate(([True], node[1:] != node[:-1]))[:len(sig)] | starts  # equal sets of several tasks
            sig, salt, node, n, starts = (x[once] for x in (sig, salt, node, n, starts))
            at = np.flatnonzero(starts)
            members = np.diff(np.append(at, len(sig)))
            if salts == 1 and len(at):
                groups = np.flatnonzero(members > 1)
                first, last = node[at[groups]], node[at[groups] + members[groups] - 1]
                mark = np.add.reduceat(_mix(node.view(np.uint64)), at)[groups]
                order = np.lexsort((mark, members[groups], last, first))
                keys = np.stack([first, last, members[groups], mark.view(np.int64)])[:, order]
                new = np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))[:len(order)]
                stays = np.zeros(len(at), dtype=bool)
                stays[groups[order[new]]] = True
                stays = np.repeat(stays, members)
                sig, salt, node, n = (x[stays] for x in (sig, salt, node, n))
            out.append(pd.DataFrame({"sig": sig, "salt": salt, "salts": salts, "node": node, "n": n}))
        return pd.concat(out)

    return index.groupBy("part").applyInPandas(run, "sig long, salt int, salts int, node long, n int")


def _met(index: DataFrame) -> DataFrame:
    """(sig, node, n, leader, leader_n): sets that share an indexed subset, with the smallest node of their group.

    Groups of the same members stay once. Subsets that are common in the corpus have their sets dealt over several groups,
    whose leaders meet in turn; these groups all stay.
    """
    def groups(rows: DataFrame, keys: list[str]) -> DataFrame:
        whole = Window.partitionBy(*keys)
        met = rows.withColumns({"_first": F.min(F.struct("node", "n")).over(whole), "last": F.max("node").over(whole)})
        met = met.select("*", F.col("_first.node").alias("leader"), F.col("_first.n").alias("leader_n")).drop("_first")
        return met.where("leader < last or salts > 1").withColumn("x", F.bit_xor(F.xxhash64("node")).over(whole))

    inner = stored(groups(index, ["sig", "salt"]).drop("salt"), "groups")
    same = [F.xxhash64("last", "x").alias("x"), "leader", "node"]
    once = inner.where("salts = 1").groupBy(*same).agg(*(F.min(c).alias(c) for c in ("sig", "n", "leader_n")))
    common = inner.where("salts > 1")
    leaders = common.select("sig", F.col("leader").alias("node"), F.col("leader_n").alias("n"), F.lit(1).alias("salts")).distinct()
    out = ["sig", "node", "n", "leader", "leader_n"]
    return stored(once.select(out).unionByName(common.where("leader < last").select(out)).unionByName(groups(leaders, ["sig"]).select(out)), "met")


def _compatible(a: str, b: str):
    return F.greatest(a, b) * 3 <= F.least(a, b) * 4


def plausible_pairs(pairs: DataFrame, where: DataFrame) -> DataFrame:
    """The (a, b, doc_a, doc_b) of ``pairs`` (a, b: nodes) that may link by their parity sketches in ``where`` (node, doc_id, n, bits)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            differ = [differing_bits(a, b) for a, b in zip(f.bits_a, f.bits_b)]
            yield f.loc[7 * np.array(differ, dtype=np.int64) <= f.n_a + f.n_b, ["a", "b", "doc_a", "doc_b"]]

    of = [where.select(F.col("node").alias(c), F.col("doc_id").alias(f"doc_{c}"), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab"]
    return pairs.join(of[0], "a").join(of[1], "b").select("a", "b", "doc_a", "doc_b", "n_a", "n_b", "bits_a", "bits_b").mapInPandas(
        run, "a long, b long, doc_a long, doc_b long")


def _likely_in_group(node: np.ndarray, n: np.ndarray, root: np.ndarray, first: np.ndarray, bits: list[bytes], crossed: bool) -> Iterator[np.ndarray]:
    """(i, j, differing bits) of the members of one group whose sizes and parity sketches let them link, of different roots.

    ``crossed``: one of them is in ``first``.
    """
    lengths = np.array([len(x) for x in bits])
    classes = {k: (at := np.flatnonzero(lengths == k), np.frombuffer(b"".join(bits[i] for i in at), np.uint64).reshape(len(at), -1)) for k in np.unique(lengths)}
    for k, (at, own) in classes.items():
        against = [(at, own, True)]
        if 2 * k in classes:  # partners have at most 4/3 of the size: the same sketch length or the next
            longer, wide = classes[2 * k]
            half = wide.shape[1] // 2
            against.append((longer, wide[:, :half] ^ wide[:, half:], False))
        for i, sketch in zip(at, own):
            for others, sketches, same in against:
                ok = (root[others] != root[i]) & (3 * np.maximum(n[others], n[i]) <= 4 * np.minimum(n[others], n[i]))
                ok &= (first[others] != first[i]) if crossed else True
                ok &= (others > i) if same else True
                if not ok.any():
                    continue
                others_ok = others[ok]
                differ = np.bitwise_count(sketches[ok] ^ sketch).sum(axis=1, dtype=np.int64)
                near = 7 * differ <= n[others_ok] + n[i]
                if near.any():
                    yield np.stack([np.full(near.sum(), i), others_ok[near], differ[near]], axis=1)


def _spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of edges between vertices ``a`` and ``b`` that span whatever all edges connect, earlier edges first."""
    vertices, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    part, chosen, live = np.arange(len(vertices)), [], np.arange(len(a))
    while len(live := live[part[a[live]] != part[b[live]]]):
        best = np.full(len(vertices), len(a))  # the first edge that leaves each part
        for end in (a, b):
            np.minimum.at(best, part[end[live]], live)
        picked = np.unique(best[best < len(a)])
        chosen.append(picked)
        parent = list(range(len(vertices)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for x, y in zip(part[a[picked]].tolist(), part[b[picked]].tolist()):
            parent[top(x)] = top(y)
        part = np.array([top(x) for x in part.tolist()])
    return np.concatenate(chosen) if chosen else live


def _nearest_pairs(node: np.ndarray, root: np.ndarray, found: np.ndarray, forests: int | None) -> np.ndarray:
    """(a, b) nodes of the likely pairs ``found``: all, or those of so many disjoint forests over the roots, nearest first."""
    pairs = np.sort(node[found[:, :2]], axis=1)
    if forests is None or not len(found):
        return pairs
    order = np.lexsort((pairs[:, 1], pairs[:, 0], found[:, 2]))
    out = []
    for _ in range(forests):
        taken = _spanning(root[found[order, 0]], root[found[order, 1]])
        out.append(pairs[order[taken]])
        order = np.delete(order, taken)
    return np.concatenate(out)


def likely_within(rows: DataFrame, where: DataFrame) -> DataFrame:
    """The (a, b) of sets (nodes) that share a ``sig`` of ``rows`` (sig, node, n, root), have different roots and may link."""
    return _compared(rows, where.withColumn("doc_id", F.lit(0)), None).select("a", "b").distinct()


def _compared(rows: DataFrame, where: DataFrame, forests: int | None) -> DataFrame:
    """The pairs (a, b, doc_a, doc_b) of ``likely_within``, and rows with ``cut`` whose ``a`` is a sig of which pairs were left out.

    The pairs of a group are compared by parity sketch (``where``: node, doc_id, bits) inside tasks and only those that pass
    leave them: all, or with ``forests`` so many spanning forests of the roots in a task, which are no more pairs than so many
    times its members. A group is dealt over blocks; a task holds two blocks at most, whatever the size of the group.
    """
    groups = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("low"), F.max("root").alias("high"))
    groups = groups.where("low < high").select("sig", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(groups, "sig").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", every).join(where.select("node", "doc_id", "bits"), "node").select(
        "sig", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "doc_id", "n", "root", "bits")
    keys = ["sig", "low", "high"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def compare(f: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
            sig, node, doc, n, root, low, high, block = (f[c].to_numpy() for c in ("sig", "node", "doc_id", "n", "root", "low", "high", "block"))
            bits, out, cut = list(f.bits), [np.empty((0, 4), dtype=np.int64)], []
            for s, e in zip(cuts[:-1], cuts[1:]):
                found = [np.empty((0, 3), dtype=np.int64), *_likely_in_group(node[s:e], n[s:e], root[s:e], block[s:e] == low[s], bits[s:e], low[s] != high[s])]
                found = np.concatenate(found)
                pairs, order = _nearest_pairs(node[s:e], root[s:e], found, forests), np.argsort(node[s:e])
                out.append(np.column_stack([pairs, doc[s:e][order][np.searchsorted(node[s:e][order], pairs)]]))
                if len(pairs) < len(found):
                    cut.append((sig[s], sig[s], 0, 0))
            out = np.unique(np.concatenate(out), axis=0)  # a pair may meet in many groups
            out = np.concatenate([out, np.array(cut, dtype=np.int64).reshape(-1, 4)])
            return pd.DataFrame(out, columns=["a", "b", "doc_a", "doc_b"]).assign(cut=np.arange(len(out)) >= len(out) - len(cut))

        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            at = f[keys].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1))
            yield compare(f, cuts)  # all groups but the last, which may go on in the next frame
            rest = f.iloc[cuts[-1]:]
        if rest is not None:
            yield compare(rest.reset_index(drop=True), np.array([0, len(rest)]))

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "a long, b long, doc_a long, doc_b long, cut boolean").distinct()


def _holders(docs: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that may have a ``key`` of ``wanted``: all that have one, and few others.

    A filter of fixed size, so that texts and sketches that nobody asks for are left where they lie.
    """
    at = F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS))
    words = wanted.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 31 as int))) as bits"))
    marks = np.zeros((1 << FILTER_BITS) // 32, dtype=np.int64)
    found = words.toArrow()  # as many rows at most, whatever the corpus
    marks[found["word"].to_numpy()] = found["bits"].to_numpy()

    @F.pandas_udf("boolean")
    def marked(at: pd.Series) -> pd.Series:
        at = at.to_numpy()
        return pd.Series((marks[at >> 5] >> (at & 31)) & 1 == 1)

    return docs.where(F.col(key).isNotNull()).where(marked(at))


def verify_pairs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` (nodes a, b in documents doc_a, doc_b) whose sets have a Jaccard similarity of at least 3/4, by their texts.

    A set with many partners is compared in parts, each of which streams the partners past it.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
    ends = F.explode(F.array(*(F.struct(F.col(x).alias("node"), F.col(f"doc_{x}").alias("doc_id")) for x in "ba"))).alias("end")
    wanted = pairs.join(parts, "a").select("a", part, ends).select("a", "part", "end.*").distinct()
    wanted = stored(wanted, "wanted")  # stored: its size is known when texts are fetched
    texts = docs.select("doc_id", "text")
    rows = wanted.join(_holders(texts, wanted) if wanted.count() > FEW else texts, "doc_id").select(
        "a", "part", "node", (F.col("node") != F.col("a")).alias("partner"), "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, own, last = None, None, None
        for f in frames:
            found = []
            for a, node, partner, text in zip(f.a, f.node, f.partner, f.text):
                if (a, node) == last:  # another row with the same text
                    continue
                shingles = shingle_set(text)
                if set_number(shingles) != node:  # another row with this doc_id
                    continue
                last = a, node
                if not partner:
                    first, own = a, shingles
                elif first == a:
                    both = len(np.intersect1d(own, shingles, assume_unique=True))
                    if 100 * both >= 75 * (len(own) + len(shingles) - both):
                        found.append((a, node))
            yield pd.DataFrame(found, columns=["a", "b"])

    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", "partner", "node")
    return ordered.mapInPandas(run, "a long, b long")


def _contracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) as links of each node to the smallest one that it reaches, ``EDGES`` links at a time."""
    def stars(links: list[pd.DataFrame]) -> pd.DataFrame:
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for f in links:
            for a, b in zip(f.a.tolist(), f.b.tolist()):
                a, b = top(a), top(b)
                parent[max(a, b)] = min(a, b)
        found = [(x, top(x)) for x in parent]
        return pd.DataFrame([x for x in found if x[0] != x[1]], columns=["a", "b"])

    links, rows = [], 0
    for f in frames:
        links.append(f)
        rows += len(f)
        if rows >= EDGES:
            yield stars(links)
            links, rows = [], 0
    if links:
        yield stars(links)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the stored ``edges`` (a, b), root being the smallest node reachable.

    Tasks contract the links they hold, ``EDGES`` at a time; then large-star and small-star steps alternate until every node
    has one root that has none itself. Only row counts reach the driver.
    """
    def steps(links: DataFrame, large: bool) -> DataFrame:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seen = both if large else both.where("b < a")
        least = seen.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = both.where("b > a") if large else seen
        out = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out if large else out.unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def open_nodes(links: DataFrame) -> DataFrame:
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")).distinct())
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1")

    chunks = -(-edges.count() // EDGES)
    links = stored(edges.select("a", "b").coalesce(max(1, chunks)).mapInPandas(_contracted, "a long, b long"), "components")
    while chunks > 1 and open_nodes(links).limit(1).count():
        links = stored(steps(steps(links.distinct(), True), False), "components")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text): the smallest linked doc_id.

    Two documents link when their sets of 5-word shingles have 3/4 of their union in common; component_id is the
    smallest doc_id reachable by links. Null text and text without a word have no shingles and no links; equal
    texts link; repeated rows give repeated rows. Rows without doc_id are no documents to link with: they keep
    their n_shingles and get no component. No rows give no rows; other columns are not read.
    """
    scanned = stored(_scan_sets(docs), "sets")
    members = scanned.where("slice is null").select("doc_id", "n", "node")
    met = _met(_shared(_index(docs, _sketch(scanned))))
    sets = scanned.where("slice is null and n > 0 and doc_id is not null").select("node", "doc_id", "n", "bits")
    where = stored(_holders(sets, met, "node").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "nodes")  # only of sets that met another
    pairs = met.where("leader != node").where(_compatible("leader_n", "n")).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    judged = stored(plausible_pairs(pairs, where), "plausible")
    edges = stored(verify_pairs(docs, judged), "edges")
    roots = connected_components(edges)

    # Groups whose members did not all link with their leader, directly or through others: there, all that met are compared.
    rows = met.select("sig", "node", "n")
    for forests in FORESTS:
        named = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        within = stored(_compared(named, where, forests), "likely")
        likely = stored(within.where("not cut").drop("cut").join(judged, ["a", "b"], "left_anti"), "likely-new")
        late = stored(verify_pairs(docs, likely), "late_edges")
        judged = judged.unionByName(likely)
        if late.limit(1).count():
            edges = edges.unionByName(late)
            roots = connected_components(edges)
        left = within.where("cut").select(F.col("a").alias("sig")).distinct()
        if not left.limit(1).count():
            break
        rows = rows.join(left, "sig", "left_semi")

    named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    linked = F.col("n") > 0
    smallest = named.where(linked).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(linked & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
