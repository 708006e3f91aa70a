"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At every level a row draws one number per child from a hash of (key, child) and goes to the child with
the smallest ``-ln(u) / weight``, which picks children in proportion to their weights. A draw depends on
its own child only, so a changed weight moves rows into or out of that child and nowhere else; below
unchanged nodes nothing moves. All of it is one column expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.common import number_within

Tree = dict[str, dict[str, dict[int, float]]]  # region -> rack -> shard -> weight

BASE = 8  # shards of the balanced part of :func:`topology`


def topology(shards: int) -> Tree:
    """Two regions of two racks of two shards, equal weights; every shard after the eighth is a region of its own.

    So one more shard beyond eight changes no weight below an existing region, and rows move only into it.
    """
    tree: Tree = {}
    for s in range(shards):
        region, rack = (f"r{s // 4}", f"r{s // 4}k{s // 2 % 2}") if s < BASE else (f"r{s}", f"r{s}k0")
        tree.setdefault(region, {}).setdefault(rack, {})[s] = 1.0
    return tree


def _uniform(key: Column, child: str) -> Column:
    """A number in (0, 1) from the key and the child's name: the upper 53 bits of a 64-bit hash."""
    return (F.shiftrightunsigned(F.xxhash64(key, F.lit(child)), 11) + 0.5) * 2.0 ** -53


def _drawn(key: Column, weights: dict[str, float]) -> Column:
    """Name of the child with the smallest weighted draw; equal draws go to the smaller name."""
    draws = [F.struct((-F.log(_uniform(key, c)) / F.lit(float(w))).alias("d"), F.lit(c).alias("c"))
             for c, w in sorted(weights.items()) if w > 0]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["c"]


def _descend(key: Column, at: Column, nodes: dict[str, dict[str, float]]) -> Column:
    cases = [(F.lit(parent), _drawn(key, kids)) for parent, kids in nodes.items()]
    return reduce(lambda c, x: c.when(at == x[0], x[1]), cases[1:], F.when(at == cases[0][0], cases[0][1]))


def shard_of(df: DataFrame, key: str, tree: Tree, name: str = "shard") -> DataFrame:
    """Add ``name``, the shard (int) that the tree gives to ``key``. A null key is a key like any other."""
    rack_sum = {r: {k: sum(s.values()) for k, s in racks.items()} for r, racks in tree.items()}
    region_sum = {r: sum(k.values()) for r, k in rack_sum.items()}
    leaves = {k: {str(s): w for s, w in shards.items()} for racks in tree.values() for k, shards in racks.items()}
    out = df.withColumn("_region", _drawn(F.col(key), region_sum))
    out = out.withColumn("_rack", _descend(F.col(key), F.col("_region"), rack_sum))
    out = out.withColumn(name, _descend(F.col(key), F.col("_rack"), leaves).cast("int"))
    return out.drop("_region", "_rack")


def shard_documents(docs: DataFrame, shards: int = BASE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, place in the shard and shard after growth for every document.

    Law ``key``: key and number of shards decide, and one more shard takes rows only into itself.
    Returns (key, size, text_crc32, law, shard, slot, grown_shard), a row for every row of ``docs``:
    ``size`` is the UTF-8 length plus one, null text counts as empty (size 1, checksum 0), rows with the
    same key share a shard and have their own slots. No rows give no rows. Other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(key, (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = shard_of(shard_of(rows, key, topology(shards)), key, topology(shards + 1), "grown_shard")
    return number_within(placed, ["shard"], "slot").select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
