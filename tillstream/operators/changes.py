"""Change records: normalising captured changes, newest row per key, deletes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.event_time import instant_from_wall_millis, to_millis
from tillstream.operators.positions import mysql_position, postgres_position
from tillstream.schemas import PAYMENT, POSTGRES_NAMES

# Operation letters of change records (create, snapshot read, update, delete).
OPERATIONS = {"c": "I", "r": "I", "u": "U", "d": "D"}


def _row_and_op(changes: DataFrame, at: Callable[[Column], Column]) -> DataFrame:
    """Flatten change envelopes: the row before for deletes, the row after for all else, and what orders them.

    That is ``position`` where records have a source block, else their ``seq``. Records without an operation go: tombstones,
    which follow deletes in a compacted topic, and values that are no record.
    """
    letters = F.create_map(*(F.lit(x) for pair in OPERATIONS.items() for x in pair))
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    order = at(F.col("source")).alias("position") if "source" in changes.columns else F.col("seq")
    flat = changes.where(F.col("op").isNotNull()).select(row.alias("row"), letters[F.col("op")].alias("op"), order)
    return flat.select("row.*", *flat.columns[1:])


def _payment_columns(df: DataFrame, created_at: Column) -> DataFrame:
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PAYMENT.fields if f.name != "created_at"]
    return df.select(*typed, to_millis(created_at).alias("created_at"), *df.columns[-2:])


def payments_from_mysql(changes: DataFrame, source_tz: str) -> DataFrame:
    """Payment changes captured from MySQL; ``created_at`` is wall-clock millis in ``source_tz``."""
    rows = _row_and_op(changes, mysql_position)
    return _payment_columns(rows, instant_from_wall_millis(F.col("created_at"), source_tz))


def payments_from_postgres(changes: DataFrame) -> DataFrame:
    """Payment changes captured from Postgres: lower-case names, decimal amounts, zoned timestamps."""
    rows = _row_and_op(changes, postgres_position).withColumnsRenamed(POSTGRES_NAMES)
    return _payment_columns(rows, F.col("created_at").cast("timestamp"))


def direct_payments(messages: DataFrame, stamp: bool = False) -> DataFrame:
    """Payments posted straight to a topic: they carry no ``created_at``.

    It stays NULL, and such payments then complete no sale. ``stamp=True`` fills in the time of
    ingest, as a database default would have.
    """
    created = F.current_timestamp() if stamp else F.lit(None).cast("timestamp")
    return messages.withColumn("created_at", created)


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The newest row of every key, whatever order the rows arrived in.

    The maximum is combined before the shuffle, so a key with very many versions sends one row per task. Its row begins with the
    ``order`` columns, which thus are shuffled once; of rows equal in them the highest by the others stays, in any run.
    """
    rest = [c for c in df.columns if c not in key]
    first = [c for c in order if c not in key]
    newest = F.max(F.struct(*first, *(c for c in rest if c not in first)))
    return df.groupBy(*key).agg(newest.alias("_row")).select(*key, "_row.*").select(*df.columns)


def live_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Current content of a keyed table: newest row per key, without keys whose newest row is a delete."""
    return latest_per_key(df, key, order).where("op <> 'D'").drop("op", *order)
