"""Finding and isolating keys that hold too many rows for one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 16
SHARE = 8  # a bucket is suspect from this many times the mean bucket size
MIN_ROWS = 5_000_000  # below this many rows a key fits one task whatever its share


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_ROWS) -> DataFrame | None:
    """Keys with so many rows that one task should not hold them all, or None when there are none.

    The first pass counts rows per key *hash*: one small row per bucket, however many keys there
    are. Only when a bucket is far over the mean are its keys counted one by one. A hot key has
    over ``SHARE / BUCKETS`` of all rows, so the result never has more than ``BUCKETS / SHARE``
    (8,192) rows and may be broadcast.
    """
    bucket = F.pmod(F.hash(key), F.lit(BUCKETS))
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    large = F.when(F.col("n") > min_rows, F.struct("bucket", "n"))
    found = counts.agg(F.sum("n").alias("total"), F.collect_list(large).alias("large")).first()
    limit = max(min_rows, math.ceil(SHARE * (found["total"] or 0) / BUCKETS))
    suspects = [r["bucket"] for r in found["large"] if r["n"] > limit]
    if not suspects:
        return None
    keys = (
        df.where(bucket.isin(suspects) & F.col(key).isNotNull())
        .groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > limit)
        .select(key)
        .collect()
    )
    if not keys:
        return None
    return df.sparkSession.createDataFrame(keys, df.select(key).schema)


def split_hot(df: DataFrame, key: str | list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the hot keys, all other rows); ``hot`` comes from :func:`hot_keys`."""
    small = F.broadcast(hot)
    return df.join(small, key, "left_semi"), df.join(small, key, "left_anti")


def join_on_unique(many: DataFrame, one: DataFrame, key: str | list[str], hot: DataFrame | None = None,
                   condition: Column | None = None) -> DataFrame:
    """Inner join of ``many`` with ``one``, keeping the keys in ``hot`` off single tasks.

    Rows of hot keys are not shuffled at all: with at most one row per key in ``one``, the at most
    8,192 hot keys need a broadcast of at most as many rows. Everything else, and everything when
    ``hot`` is None, is an ordinary join.
    """
    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        out = left.join(right, key, "inner")
        return out if condition is None else out.where(condition)

    if hot is None:
        return joined(many, one)
    many_hot, many_cold = split_hot(many, key, hot)
    one_hot, one_cold = split_hot(one, key, hot)
    return joined(many_hot, F.broadcast(one_hot)).unionByName(joined(many_cold, one_cold))
