"""Outliers, low batteries, spikes and transmission gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegauge.functions.time import epoch_micros, minutes_between, slot_floor
from tidegauge.plans.neighbours import where_neighbours
from tidegauge.plans.presented import presented
from tidegauge.plans.sized_join import BROADCAST_ROWS, join_key_summary

BINS_PER_CHUNK = 1000  # bins of a device that one task sorts


def sigma_anomalies(
    df: DataFrame,
    value: str = "temperature",
    k: float = 2.0,
    only_anomalies: bool = True,
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Readings further than ``k`` sample standard deviations from their device's mean.

    The bounds are strict; a device with one reading has no deviation and is never flagged.
    ``only_anomalies=False`` keeps every reading and labels the rest ``NORMAL``.
    """
    stats = df.groupBy(device).agg(
        F.count("*").alias("_rows"),
        F.avg(value).alias("avg_temp"),
        F.stddev_samp(value).alias("stddev_temp"),
    )
    high = F.col(value) > F.col("avg_temp") + k * F.col("stddev_temp")
    low = F.col(value) < F.col("avg_temp") - k * F.col("stddev_temp")
    rows = df.select(device, F.col(time).alias("timestamp"), value)
    if only_anomalies:
        rows = rows.filter(F.col(value).isNotNull())
    out = join_key_summary(
        rows, stats, device, "_rows", (high | low) if only_anomalies else None, broadcast_rows
    ).select(
        device, "timestamp", value, "avg_temp", "stddev_temp",
        F.when(high, "HIGH_ANOMALY").when(low, "LOW_ANOMALY").otherwise("NORMAL")
        .alias("anomaly_type"),
    )
    if not ordered:
        return out
    return presented(
        out, F.asc_nulls_last("timestamp"), device, settle=only_anomalies, spread=True
    )


def low_battery(
    df: DataFrame,
    threshold: int = 20,
    battery: str = "battery",
    location: str = "location",
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
) -> DataFrame:
    """Readings with the battery at or below ``threshold``, emptiest and newest first."""
    out = df.filter(F.col(battery) <= threshold).select(
        device, F.col(time).alias("timestamp"), battery,
        F.col(f"{location}.lat").alias("latitude"), F.col(f"{location}.lon").alias("longitude"),
    )
    if not ordered:
        return out
    # Five narrow columns are cheaper to shuffle than lines are to parse a second time.
    return presented(
        out, F.asc_nulls_last(battery), F.desc_nulls_last("timestamp"), F.asc_nulls_last(device),
        settle=True, spread=True,
    )


def spikes(
    df: DataFrame,
    value: str = "temperature",
    delta: float = 5.0,
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
    chunk_minutes: int = 60,
) -> DataFrame:
    """Readings that jump by more than ``delta`` from both the previous and the next reading.

    Readings of one device at one time are ordered by value, and NaN counts as no value. Readings
    without a time have no place in the order and are left out. ``chunk_minutes`` is how much of one
    device's history a task sorts at a time; it does not change the result.
    """
    if delta < 0:
        raise ValueError("delta must not be negative")
    number = F.col(value)
    if dict(df.dtypes)[value] in ("double", "float"):
        number = F.when(~F.isnan(number), number)
    points = df.filter(F.col(time).isNotNull()).select(
        device, F.col(time).alias("timestamp"), number.alias(value)
    )
    jump = F.abs(F.col(value) - F.col(f"prev_{value}")) > delta
    back = F.abs(F.col(value) - F.col(f"next_{value}")) > delta
    out = (
        where_neighbours(
            points, [device], slot_floor("timestamp", chunk_minutes), ["timestamp", value], [value],
            wanted=jump & back,
        )
        .select(
            device, "timestamp", value,
            F.col(f"prev_{value}").alias("prev_temp"), F.col(f"next_{value}").alias("next_temp"),
        )
    )
    if not ordered:
        return out
    return presented(out, F.asc_nulls_last(device), "timestamp", value, settle=True)


def time_gaps(
    df: DataFrame,
    minutes: float = 15.0,
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
) -> DataFrame:
    """Pauses strictly longer than ``minutes`` between a device's consecutive readings.

    With the time line cut into bins of that length, both ends of such a pause are the last
    reading of one occupied bin and the first of the next, so first and last time per bin are
    enough: readings are combined before the shuffle and only bins are sorted per device.
    """
    if minutes <= 0:
        raise ValueError("minutes must be positive")
    micros = epoch_micros(time)
    bin_start = micros - F.pmod(micros, F.lit(max(1, int(minutes * 60_000_000))))
    bins = (
        df.filter(F.col(time).isNotNull())
        .groupBy(device, bin_start.alias("bin"))
        .agg(F.min(time).alias("timestamp"), F.max(time).alias("last_in_bin"))
    )
    # Short bins may be as many as readings, so a device's bins are linked chunk by chunk.
    chunk = F.floor(F.col("bin") / max(1, int(minutes * 60_000_000) * BINS_PER_CHUNK))
    gap = minutes_between("prev_last_in_bin", "timestamp")
    out = (
        where_neighbours(bins, [device], chunk, ["bin"], ["last_in_bin"], wanted=gap > minutes)
        .select(
            device, "timestamp", F.col("prev_last_in_bin").alias("prev_timestamp"),
            gap.alias("gap_minutes"),
        )
    )
    if not ordered:
        return out
    return presented(
        out, F.col("gap_minutes").desc(), F.asc_nulls_last(device), "timestamp", settle=True
    )
