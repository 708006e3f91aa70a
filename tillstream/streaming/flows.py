"""Starting streams: file inputs, append and keyed outputs, triggers, state settings."""

from __future__ import annotations

import contextlib
import threading
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tillstream.operators.completed import put_items
from tillstream.session import settings
from tillstream.sinks.keyed_table import KeyedTable

# Join state lives in RocksDB, on executor disks, and goes to the checkpoint as change logs, both compressed with zstd.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.join.stateFormatVersion": "3",  # one store for a task of a join instead of four, each with files of its own
}
UNLOAD = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}  # a run that ends leaves no state on executor disks, for the next one loads it anew


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
               bytes_per_batch: int | None = None) -> DataFrame:
    """Stream of Parquet files from their beginning, as a topic is read from its earliest offset.

    A micro-batch takes at most ``files_per_batch`` files, or files of ``bytes_per_batch`` bytes (one file at least).
    """
    if files_per_batch and bytes_per_batch:
        raise ValueError("bound a batch by files or by bytes, not by both")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Stream of the rows of a catalog table, those already there first."""
    return spark.readStream.table(name)


def _start(writer: DataStreamWriter, spark: SparkSession, name: str, checkpoint: str, every: str | None,
           state_partitions: int | None, table: str | None = None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = writer.queryName(name).option("checkpointLocation", checkpoint).trigger(**trigger)
    conf = dict(STATE_SETTINGS) if every else {**STATE_SETTINGS, **UNLOAD}
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    with settings(spark, conf):
        return writer.toTable(table) if table else writer.start()


def start_append(df: DataFrame, path: str, checkpoint: str, name: str, every: str | None = None,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Append to Parquet files, each row exactly once. ``every=None`` works off what is there and stops.

    ``state_partitions`` is the number of state partitions on the first start; later starts keep it.
    """
    writer = df.writeStream.format("parquet").option("path", path).outputMode("append")
    return _start(writer, df.sparkSession, name, checkpoint, every, state_partitions)


def start_table(df: DataFrame, table: str, checkpoint: str, name: str, every: str | None = None,
                state_partitions: int | None = None, file_format: str = "parquet") -> StreamingQuery:
    """Append to a catalog table, created from the stream's schema on the first start."""
    writer = df.writeStream.format(file_format).outputMode("append")
    return _start(writer, df.sparkSession, name, checkpoint, every, state_partitions, table)


def start_keyed(df: DataFrame, table: KeyedTable, checkpoint: str, name: str, every: str | None = None,
                state_partitions: int | None = None, baskets: str | None = None) -> StreamingQuery:
    """Write each micro-batch as one segment of a keyed table.

    Completed sales of baskets without items get them where they are written, from the catalog table ``baskets`` (see ``put_items``).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table.write_segment(put_items(batch, batch.sparkSession.table(baskets)) if baskets else batch, batch_id)

    writer = df.writeStream.foreachBatch(write).outputMode("append")
    return _start(writer, df.sparkSession, name, checkpoint, every, state_partitions)


def start_batches(df: DataFrame, write, checkpoint: str, name: str, every: str | None = None,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Give each micro-batch and its number to ``write``, which must put up with a batch that is repeated after a failure."""
    return _start(df.writeStream.foreachBatch(write).outputMode("append"), df.sparkSession, name, checkpoint, every, state_partitions)


def finish(*queries: StreamingQuery) -> None:
    """Wait for streams started with ``every=None``; errors of any of them are raised."""
    for q in queries:
        q.awaitTermination()


class RunCounts(StreamingQueryListener):
    """Records, batches and time of every run, added up report by report, however many reports Spark keeps."""

    def __init__(self):
        self._lock = threading.Lock()
        self._runs: dict[str, dict] = defaultdict(lambda: {"records": 0, "batches": 0, "seconds": 0.0, "state_rows": 0})
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            run = self._runs[str(p.runId)]
            run["state_rows"] = sum(s.numRowsTotal for s in p.stateOperators)
            if p.numInputRows > 0:
                run["records"] += p.numInputRows
                run["batches"] += 1
                run["seconds"] += p.durationMs.get("triggerExecution", 0) / 1000

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended[str(event.runId)].set()

    def so_far(self, query: StreamingQuery) -> dict[str, float]:
        """What was reported of a run that may go on."""
        with self._lock:
            run = dict(self._runs[str(query.runId)])
        return {**run, "records_per_second": run["records"] / run["seconds"] if run["seconds"] else 0.0}

    def of(self, query: StreamingQuery, wait: float = 60) -> dict[str, float]:
        """Complete counts of a run that has ended. Reports come in order, its end last."""
        with self._lock:
            ended = self._ended[str(query.runId)]
        if not ended.wait(wait):
            raise TimeoutError(f"no report of the end of {query.name}")
        return self.so_far(query)


@contextlib.contextmanager
def counted(spark: SparkSession) -> Iterator[RunCounts]:
    """Count the runs of all streams that are started inside the block."""
    counts = RunCounts()
    spark.streams.addListener(counts)
    try:
        yield counts
    finally:
        spark.streams.removeListener(counts)


def run_metrics(query: StreamingQuery) -> dict[str, float]:
    """Records and throughput of the last reports of a run (those Spark still holds). :class:`RunCounts` has all."""
    done = [p for p in query.recentProgress if p.numInputRows > 0]
    records = sum(p.numInputRows for p in done)
    seconds = sum(p.durationMs["triggerExecution"] for p in done) / 1000
    return {"records": records, "batches": len(done), "seconds": seconds,
            "records_per_second": records / seconds if seconds else 0.0,
            "state_rows": sum(s.numRowsTotal for s in query.lastProgress.stateOperators) if query.lastProgress else 0}
