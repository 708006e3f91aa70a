"""Payments out of a relational table: the snapshot that precedes captured changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def snapshot_bounds(first: str, last: str, partitions: int) -> dict[str, str]:
    """Reader options that split a snapshot by ``created_at``; rows outside the range are read too."""
    return {"partitionColumn": "created_at", "lowerBound": first, "upperBound": last,
            "numPartitions": str(partitions)}


def read_snapshot(spark: SparkSession, url: str, first: str, last: str, partitions: int = 16,
                  table: str = "salespayments", properties: dict[str, str] | None = None) -> DataFrame:
    """Read a payments table in parallel, split by creation time."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, fetchsize="10000", **snapshot_bounds(first, last, partitions), **(properties or {}),
    ).load()


def postgres_place(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> tuple[int, int]:
    """The log's current place, for :func:`tillstream.operators.positions.read_chunks`."""
    query = "select pg_current_wal_lsn() - '0/0'::pg_lsn as place"
    row = spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load().first()
    return 0, int(row["place"])


def read_range(spark: SparkSession, url: str, first: str, last: str, table: str = "salespayments", key: str = "invoicenumber",
               properties: dict[str, str] | None = None) -> DataFrame:
    """Rows of one key range (``first`` included, ``last`` not): a chunk of a snapshot."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    query = f"select * from {table} where {key} >= {quoted(first)} and {key} < {quoted(last)}"
    return spark.read.format("jdbc").options(url=url, query=query, fetchsize="10000", **(properties or {})).load()
