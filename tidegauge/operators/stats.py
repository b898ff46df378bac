"""Fleet and device statistics: one map-side-combined aggregation each."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidegauge.functions.numeric import round_half_up, rounded_avg
from tidegauge.functions.time import bucket, in_zone
from tidegauge.schema import MEASURES


def _averages(measures: Sequence[str], digits: int):
    return [rounded_avg(m, digits).alias(f"avg_{m}") for m in measures]


def _sorted(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def dataset_overview(
    df: DataFrame, device: str = "device_id", time: str = "event_time"
) -> DataFrame:
    """Rows, distinct devices, first and last reading time."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.countDistinct(device).alias("device_count"),
        F.min(time).alias("earliest_timestamp"),
        F.max(time).alias("latest_timestamp"),
    )


def device_stats(
    df: DataFrame,
    measures: Sequence[str] = MEASURES,
    battery: str = "battery",
    device: str = "device_id",
    digits: int = 2,
    ordered: bool = True,
) -> DataFrame:
    """Per device: count, average of each measure, lowest and highest battery."""
    out = df.groupBy(device).agg(
        F.count("*").alias("record_count"),
        *_averages(measures, digits),
        F.min(battery).alias(f"min_{battery}"),
        F.max(battery).alias(f"max_{battery}"),
    )
    return _sorted(out, ordered, F.asc_nulls_last(device))


def bucket_avg(
    df: DataFrame,
    unit: str = "hour",
    measures: Sequence[str] = ("temperature",),
    with_count: bool = False,
    name: str | None = None,
    time: str = "event_time",
    digits: int = 2,
    ordered: bool = True,
) -> DataFrame:
    """Average of each measure per hour or day over all devices."""
    name = name or unit
    counts = [F.count("*").alias("record_count")] if with_count else []
    out = df.groupBy(bucket(time, unit).alias(name)).agg(*_averages(measures, digits), *counts)
    return _sorted(out, ordered, F.asc_nulls_last(name))


def bucket_range(
    df: DataFrame,
    unit: str = "day",
    value: str = "temperature",
    time: str = "event_time",
    digits: int = 2,
    ordered: bool = True,
) -> DataFrame:
    """Lowest, highest and average value per hour or day."""
    out = df.groupBy(bucket(time, unit).alias(unit)).agg(
        round_half_up(F.min(value), digits).alias(f"min_{value}"),
        round_half_up(F.max(value), digits).alias(f"max_{value}"),
        rounded_avg(value, digits).alias(f"avg_{value}"),
    )
    return _sorted(out, ordered, F.asc_nulls_last(unit))


def device_bucket_avg(
    df: DataFrame,
    unit: str = "day",
    measures: Sequence[str] = MEASURES,
    battery: str = "battery",
    device: str = "device_id",
    time: str = "event_time",
    digits: int = 2,
    ordered: bool = True,
) -> DataFrame:
    """Averages per device and hour or day; battery to whole percent."""
    out = df.groupBy(device, bucket(time, unit).alias(unit)).agg(
        *_averages(measures, digits), rounded_avg(battery, 0).alias(f"avg_{battery}")
    )
    return _sorted(out, ordered, F.asc_nulls_last(unit), F.asc_nulls_last(device))


def hour_of_day_profile(
    df: DataFrame,
    value: str = "temperature",
    device: str = "device_id",
    time: str = "event_time",
    digits: int = 2,
    ordered: bool = True,
) -> DataFrame:
    """Device by hour-of-day averages and counts, the cells of a heat map."""
    out = df.groupBy(device, F.hour(time).cast("long").alias("hour_of_day")).agg(
        rounded_avg(value, digits).alias(f"avg_{value}"), F.count("*").alias("record_count")
    )
    return _sorted(out, ordered, F.asc_nulls_last(device), F.asc_nulls_last("hour_of_day"))


def active_devices(
    df: DataFrame,
    day: date | str,
    device: str = "device_id",
    time: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Distinct devices of one day.

    The day is looked up in the partition keys, so only its folder is read. For a table without
    such keys name the ``time`` column and its UTC day is used.
    """
    d = date.fromisoformat(day) if isinstance(day, str) else day
    if time is None:
        wanted = (
            (F.col("year") == f"{d.year:04d}")
            & (F.col("month") == f"{d.month:02d}")
            & (F.col("day") == f"{d.day:02d}")
        )
    else:
        start = F.lit(d).cast("timestamp_ntz")
        wanted = (F.col(time) >= start) & (F.col(time) < F.timestamp_add("DAY", F.lit(1), start))
    return _sorted(df.filter(wanted).select(device).distinct(), ordered, F.asc_nulls_last(device))


def sensor_averages_tz(
    df: DataFrame,
    zone: str = "Asia/Tokyo",
    label: str = "jst",
    measures: Sequence[str] = MEASURES,
    device: str = "device_id",
    time: str = "event_time",
    digits: int = 2,
    ordered: bool = True,
) -> DataFrame:
    """Per device averages with the covered period on the UTC clock and on a second zone's clock."""
    out = (
        df.groupBy(device)
        .agg(
            F.min(time).alias("first_utc"),
            F.max(time).alias("last_utc"),
            *_averages(measures, digits),
        )
        .withColumns(
            {
                f"first_{label}": in_zone("first_utc", zone),
                f"last_{label}": in_zone("last_utc", zone),
            }
        )
    )
    return _sorted(out, ordered, F.asc_nulls_last(device))
