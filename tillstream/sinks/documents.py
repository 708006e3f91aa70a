"""JSON documents on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def document(df: DataFrame, pretty: bool = False) -> DataFrame:
    """One JSON document per row in the column ``value``."""
    options = {"pretty": "true"} if pretty else {}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def write_documents(df: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """JSON lines, the form document stores import in bulk. Readers tell the ``compression`` (as "gzip") from the files' names."""
    document(df).write.mode(mode).option("compression", compression).text(path)


def write_spool(df: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """Spool form: indented documents, each followed by a comma and a newline. A compressed file is read by one task."""
    document(df, pretty=True).write.mode(mode).options(lineSep=",\n", compression=compression).text(path)


def insert_documents(df: DataFrame, store_format: str, options: dict[str, str]) -> None:
    """Insert documents through a document store's own Spark connector (batch size in its options)."""
    df.write.format(store_format).options(**options).mode("append").save()
