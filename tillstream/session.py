"""Session helpers: a shared scratch folder and scoped settings."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session without the setting gets a new temporary folder. On a cluster a folder of
    one machine would lose data with that machine, so the setting is then required.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tillstream-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Set SQL settings for one block and put the old values back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Item arrays are built from sorted rows, where sort aggregation needs neither a hash table nor a
# second sort. Worth setting on a cluster too.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int = 8, app: str = "tillstream") -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
