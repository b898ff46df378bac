"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "tidegauge", master: str | None = None, **conf) -> SparkSession:
    """New or existing session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Recording the Python line of every column expression slows down building plans.
    start_up = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
    for key, value in {**start_up, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    A plain local master, where driver and executors are one process, gets a folder of its own when
    none is named; it is removed when the process ends. Every other master must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    given = spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        if not _own_root:
            _own_root.append(tempfile.mkdtemp(prefix="tidegauge-"))
            atexit.register(shutil.rmtree, _own_root[0], ignore_errors=True)
        return f"file://{_own_root[0]}"
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


_own_root: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path for data this run writes; never used twice, removed when the process ends."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove_written)
    _written[path] = spark
    return path


_written: dict[str, SparkSession] = {}


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    _written.pop(path, None)


def _remove_written() -> None:
    for path, spark in list(_written.items()):
        with contextlib.suppress(Exception):  # the session may be gone already
            remove_path(spark, path)


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A setting of the session that holds for one step."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _tidy_shuffles(spark: SparkSession):
    """Let the shuffle files of a table go once it is written; nothing else reads them."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def listing_tasks(spark: SparkSession):
    """List many folders in as many tasks as run at once, not in one task for each folder."""
    tasks = str(max(1, spark.sparkContext.defaultParallelism))
    return _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)


class Scratch:
    """Tables that a job writes to the shared folder and reads back.

    Each is computed once, cuts the lineage and survives the loss of any executor. ``drop`` removes
    those that no later step reads; the rest goes when the process ends. ``batch`` bounds the bytes of rows
    that go to a Python worker at once while a table is computed.
    """

    def __init__(self, spark: SparkSession, label: str, batch: int | None = None):
        self.spark, self.root, self.batch = spark, scratch_path(spark, label), batch

    def table(self, df: DataFrame, name: str) -> DataFrame:
        with contextlib.ExitStack() as settings:
            settings.enter_context(_tidy_shuffles(self.spark))
            if self.batch:
                settings.enter_context(_setting(self.spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(self.batch)))
            df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, f"{self.root}/{name}")


def durable(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage; survives the loss of any executor."""
    return Scratch(df.sparkSession, "durable").table(df, "rows")
