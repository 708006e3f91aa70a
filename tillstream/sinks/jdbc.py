"""Payments into a relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillstream.schemas import PAYMENT_MESSAGE


def write_payments(df: DataFrame, url: str, properties: dict[str, str] | None = None, table: str = "salespayments",
                   batch_size: int = 1000, connections: int = 8) -> None:
    """Insert payments in batches over a bounded number of connections.

    ``created_at`` is left to the database's default. Each task inserts its rows in one transaction
    and a failed task fails the write; a repeated task meets the primary key, not silent doubles.
    """
    df.select(*PAYMENT_MESSAGE.names).write.option("numPartitions", connections).jdbc(
        url, table, mode="append", properties={"batchsize": str(batch_size), **(properties or {})})
