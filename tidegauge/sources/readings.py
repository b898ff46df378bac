"""Scans of a JSON-lines readings table laid out as year=/month=/day= folders.

A table may be those folders and nothing else, or have commits (see :mod:`tidegauge.sources.commits`); every
scan here reads both.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidegauge.functions.time import parse_iso
from tidegauge.schema import STORED_FIELDS, TABLE_SCHEMA
from tidegauge.sources.commits import day_key, read_days

CORRUPT = "_corrupt_record"


def _scan(spark: SparkSession, root: str, mode: str, days: Iterable[str] | None = None) -> DataFrame:
    schema = T.StructType(list(TABLE_SCHEMA.fields)).add(CORRUPT, T.StringType())
    return read_days(spark, root, schema, "json", days, mode=mode, columnNameOfCorruptRecord=CORRUPT)


def _mentions_every_field() -> Column:
    """True for every bad line, while needing all of its fields.

    A scan parses the columns a query asks for and only notices errors among those. This makes
    whole lines be parsed, so that the split is the same for every query.
    """
    texts = [F.col(f.name).cast("string") for f in STORED_FIELDS]
    return F.concat_ws("", *texts, CORRUPT) != ""


def scan_readings(
    spark: SparkSession, root: str, mode: str = "PERMISSIVE", days: Iterable[str] | None = None
) -> DataFrame:
    """Readings with their partition keys and ``event_time``.

    With ``days``, names of day folders such as "2024-01-15", no other folder is so much as listed.

    Lines that are not valid JSON or hold a wrongly typed field are left to
    :func:`scan_rejects`, which takes parsing every line in full. For tables known to be sound,
    ``mode='TRUSTED'`` parses only the columns that the query reads; a bad field is then NULL. With
    ``mode='FAILFAST'`` a bad line among the columns read stops the query.
    """
    df = _scan(spark, root, "PERMISSIVE" if mode == "TRUSTED" else mode, days)
    if mode == "PERMISSIVE":
        df = df.filter(F.col(CORRUPT).isNull() | ~_mentions_every_field())
    return df.drop(CORRUPT).withColumn("event_time", parse_iso("timestamp"))


def scan_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The lines :func:`scan_readings` leaves out, as text, with whatever fields did parse."""
    bad = F.col(CORRUPT).isNotNull() & _mentions_every_field()
    return _scan(spark, root, "PERMISSIVE").filter(bad)


def _as_date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def _days(low: date, high: date) -> list[str]:
    return [day_key(date.fromordinal(n)) for n in range(low.toordinal(), high.toordinal() + 1)]


PROJECTED_DAYS = 4000  # longest range whose folders are asked for one by one


def _between(df: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of UTC days, by a condition on the time alone."""
    first, after = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (start, min(end, date.max - timedelta(1)) + timedelta(1)))
    inside = F.col("event_time") >= first
    return df.filter(inside if end == date.max else inside & (F.col("event_time") < after))


def scan_date_range(
    spark: SparkSession, root: str, start: date | str, end: date | str, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Readings whose UTC day lies in ``start..end`` (both included).

    The writer's calendar may be any zone, so a folder's day and the UTC day can differ by one:
    one more folder is opened on each side and the rows are then filtered exactly. Folder names follow
    from the dates, so a range of n days touches n + 2 folders of a table of any size. A range of more than
    ``PROJECTED_DAYS`` days lists the table instead and prunes its folders.
    """
    start, end = _as_date(start), _as_date(end)
    low = start - timedelta(days=int(start > date.min))
    high = end + timedelta(days=int(end < date.max))
    if (high - low).days < PROJECTED_DAYS:
        return _between(scan_readings(spark, root, mode, _days(low, high)), start, end)
    key = F.concat_ws("-", "year", "month", "day")
    return _between(scan_readings(spark, root, mode).filter(key.between(day_key(low), day_key(high))), start, end)


def scan_partition_day(spark: SparkSession, root: str, day: date | str) -> DataFrame:
    """Readings stored in one day's folder."""
    return scan_readings(spark, root, days=[day_key(_as_date(day))])


def register_readings(
    spark: SparkSession, root: str, view: str = "sensor_data", mode: str = "PERMISSIVE"
) -> DataFrame:
    """Expose the table to ``spark.sql`` under ``view``."""
    df = scan_readings(spark, root, mode)
    df.createOrReplaceTempView(view)
    return df
