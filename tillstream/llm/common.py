"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.session import scratch_dir

WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: later jobs and lost executors see the same rows."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[tuple, object] = {}
FORGET: list[Callable[[], None]] = []  # empties the tables that a module keeps


def forget_kept() -> None:
    """Empty what this worker process keeps, and give the memory back: a task that keeps nothing calls it before it starts."""
    _KEPT.clear()
    for forget in FORGET:
        forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # freed memory stays with the process otherwise
    if trim:
        trim(0)


def kept(make: Callable, *args):
    """``make(*args)``, made once per worker process and kept from task to task until another operator keeps its own.

    Spark's worker processes outlive a stage, so what one operator keeps would add to the memory of all operators after it.
    """
    key = (make.__module__, make.__qualname__, *args)
    if key not in _KEPT:
        forget_kept()
        _KEPT[key] = make(*args)
    return _KEPT[key]


def from_texts(texts: Column, make: Callable[[], Callable[[list], list[tuple]]], fields: str, rows: int = 256) -> Column:
    """A struct of ``fields`` for each text (or null). ``make()`` gives, once per task, the function from a list of texts to rows.

    Only the text passes through Python, ``rows`` at a time: ids and other columns stay in the JVM as they are.
    """
    names = [f.split()[0] for f in fields.split(", ")]

    @F.pandas_udf(fields)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = make()
        for batch in batches:
            for at in range(0, max(1, len(batch)), rows):
                yield pd.DataFrame(work(batch.iloc[at:at + rows].tolist()), columns=names)

    return run(texts)


def number_within(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... without gaps among the rows of each key (keys are not null).

    Rows are counted per key and piece of the input, and numbered inside their piece, so a key that
    holds most of the rows is still spread over as many groups as there are pieces. The pieces are
    fixed by storing the rows, so give only the columns that are needed.
    """
    pieces = stored(df.withColumns({"_piece": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "numbered")
    at = [*keys, "_piece"]
    counts = pieces.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*at, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*at).orderBy("_row")) - 1
    return (
        pieces.withColumn("_inside", inside).join(starts, at)
        .withColumn(name, (F.col("_inside") + F.col("_start")).cast("long"))
        .drop("_piece", "_row", "_inside", "_start")
    )
