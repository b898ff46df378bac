"""JSON-lines and CSV writers."""

from __future__ import annotations

import uuid
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F, types as T

from tidegauge.functions.time import format_iso, partition_keys
from tidegauge.schema import PARTITION_KEYS, STORED_SCHEMA
from tidegauge.sources.commits import Commit, latest, publish, stage


def to_stored(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Readings in stored form: time as text, plus the writer's calendar day as partition keys.

    A reading whose time did not parse keeps its original text, if ``df`` still has it.
    """
    time = format_iso("event_time")
    if "timestamp" in df.columns:
        time = F.coalesce(time, F.col("timestamp").cast("string"))
    fields = [
        time.alias(f.name) if f.name == "timestamp" else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in STORED_SCHEMA.fields
    ]
    return df.select(*fields, *partition_keys("event_time", zone))


def _in_time_order():
    """Stored times have different numbers of digits, so the text itself does not sort as time does."""
    return F.rpad(F.rtrim(F.col("timestamp"), F.lit("Z")), 26, "0")


def _arranged(df: DataFrame, zone: str) -> DataFrame:
    """Stored rows gathered by day, in time order.

    The rebalance gathers each day into one file and lets adaptive execution split a day that is
    too big for one task into several.
    """
    return (
        to_stored(df, zone)
        .hint("rebalance", *PARTITION_KEYS)
        .sortWithinPartitions(*PARTITION_KEYS, _in_time_order(), "device_id")
    )


def write_partitioned_jsonl(
    df: DataFrame, root: str, zone: str = "UTC", replace: str = "days"
) -> None:
    """Write readings into year=/month=/day= folders, in time order inside each file.

    ``replace='days'`` swaps only the days present in ``df``; ``'all'`` replaces the whole table. Files
    are swapped in place, for programs that find them by folder name; readers in between may meet a
    part of them. :func:`publish_readings` has no such moment. Tables with commits are refused.
    """
    if replace not in ("days", "all"):
        raise ValueError(f"replace must be 'days' or 'all', not {replace!r}")
    if latest(df.sparkSession, root) is not None:
        raise ValueError("the table has commits: use publish_readings")
    (
        _arranged(df, zone)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if replace == "days" else "static")
        .option("ignoreNullFields", "false")
        .partitionBy(*PARTITION_KEYS)
        .json(root)
    )


def publish_readings(df: DataFrame, root: str, zone: str = "UTC", replace: str = "days") -> Commit:
    """Write readings like :func:`write_partitioned_jsonl` and make them count all at once.

    Until the last moment, and for ever if the write fails, scans see the table as it was; from then on
    they see it as it is now. ``replace='none'`` adds to the days. ``df`` may be read from the table itself.
    Old files stay until :func:`tidegauge.sources.commits.clean` is called.
    """
    if replace not in ("days", "all", "none"):
        raise ValueError(f"replace must be 'days', 'all' or 'none', not {replace!r}")
    write, days = stage(_arranged(df, zone), root, "json", ignoreNullFields="false")
    return publish(df.sparkSession, root, write, days, replace)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Write one JSON object per line, keeping NULL fields, in the order of ``df``."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested fields as ``outer_inner`` columns."""

    def leaves(prefix: list[str], schema: T.StructType):
        for field in schema.fields:
            path = prefix + [field.name]
            if isinstance(field.dataType, T.StructType):
                yield from leaves(path, field.dataType)
            else:
                quoted = ".".join(f"`{p}`" for p in path)
                yield F.col(quoted).alias("_".join(path))

    return df.select(*leaves([], df.schema))


def write_result_csv(df: DataFrame, path: str) -> None:
    """Write a query result as CSV with a header line; structs become plain columns.

    Times keep their microseconds.
    """
    (
        flatten_structs(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )


NO_SESSION = "__HIVE_DEFAULT_PARTITION__"


def write_transcripts(lines: DataFrame, root: str) -> None:
    """Write (session_id, line_no, line) as one text file per session, under session_id=.../.

    Sessions are many and short, so what a file costs decides. Files go through pyarrow's file systems, which
    spend less on each than Hadoop's, and a task writes many; a store that pyarrow does not open
    gets them from Spark's own writer. Sessions are dealt to a fixed number of tasks, as adaptive execution
    would leave few lines, however many files, to a single one.
    """
    spark = lines.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = lines.repartition(tasks, "session_id").sortWithinPartitions("session_id", "line_no")
    try:
        system, base = fs.FileSystem.from_uri(root)
    except (pa.ArrowException, OSError, ValueError):
        rows.select("session_id", "line").write.partitionBy("session_id").text(root)
        return
    system.create_dir(base, recursive=True)
    named = F.coalesce(F.col("session_id").cast("string"), F.lit(NO_SESSION)).alias("session_id")
    text = F.coalesce("line", F.lit("")).alias("line")
    rows.select(named, text).mapInArrow(lambda it: _write_sessions(it, root), "files long").agg(F.sum("files")).first()


def _write_sessions(batches, root: str):
    """One file for each run of rows of a session. It gets its name when it is whole, so attempts may overlap."""
    system, base = fs.FileSystem.from_uri(root)
    files, session, stream, folder, hidden = 0, None, None, "", ""

    def finish():
        if stream is not None:
            stream.close()
            system.move(hidden, f"{folder}/lines.txt")

    for batch in batches:
        for now, line in zip(*(batch.column(c).to_pylist() for c in ("session_id", "line"))):
            if now != session:
                finish()
                session, folder = now, f"{base}/session_id={quote(now, safe='')}"
                hidden = f"{folder}/.{uuid.uuid4().hex}"
                system.create_dir(folder)
                stream = system.open_output_stream(hidden)
                files += 1
            stream.write(line.encode("utf-8", "surrogatepass") + b"\n")
    finish()
    yield pa.record_batch({"files": pa.array([files], pa.int64())})
