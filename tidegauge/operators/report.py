"""Daily report tables, for all days at once.

Readings without a device or a time belong to no sensor's day and are left out of every table. All
tables but the anomaly count derive from one rollup per device and day, which is computed once.
:class:`tidegauge.operators.daily.DailyReport` has the tables of a single day from stored rollups.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.numeric import percent, round_half_up
from tidegauge.functions.time import day_of
from tidegauge.plans.slots import mask_aggregates, occupied, slots_per_day
from tidegauge.plans.sized_join import join_key_summary
from tidegauge.schema import MEASURES
from tidegauge.session import durable

WATCH_SPREAD = 9.0
MIN_AVAILABILITY = 99.0
MIN_COMPLETENESS = 95.0


def _placed(df: DataFrame, device: str, time: str) -> DataFrame:
    return df.filter(F.col(device).isNotNull() & F.col(time).isNotNull())


def _between(df: DataFrame, time: str, start: date | str | None, end: date | str | None) -> DataFrame:
    """Readings of the days from ``start`` to ``end``, by a condition on the bare time, which a scan can use."""
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        after = (date.fromisoformat(end) if isinstance(end, str) else end) + timedelta(1)
        df = df.filter(F.col(time) < F.lit(str(after)).cast("timestamp_ntz"))
    return df


def device_day_rollup(
    df: DataFrame,
    value: str = "temperature",
    interval: int = 5,
    device: str = "device_id",
    time: str = "event_time",
) -> DataFrame:
    """Per device and day: rows, occupied slots, and count, sum, squared deviations, lowest and
    highest value."""
    return (
        _placed(df, device, time)
        .groupBy(day_of(time).alias("day"), F.col(device).alias("device_id"))
        .agg(
            F.count("*").alias("rows"),
            F.sum(value).alias("value_sum"),
            F.count(value).alias("value_count"),
            (F.var_pop(value) * F.count(value)).alias("value_dev"),
            F.min(value).alias("value_min"),
            F.max(value).alias("value_max"),
            *mask_aggregates(time, interval),
        )
        .withColumn("slots", occupied(interval))
    )


def day_figures(rollup: DataFrame) -> DataFrame:
    """One row per day with what the devices of that day have in common."""
    return rollup.groupBy("day").agg(
        F.count("*").alias("active_sensors"),
        *([F.sum("is_new").alias("new_sensors")] if "is_new" in rollup.columns else []),
        F.sum("slots").alias("occupied_slots"),
        F.sum("rows").alias("rows"),
        (F.sum("value_sum") / F.nullif(F.sum("value_count"), F.lit(0))).alias("mean"),
        F.min("value_min").alias("low"),
        F.max("value_max").alias("high"),
    )


def with_day_before(days: DataFrame) -> DataFrame:
    """Each day goes on to the next one as the day before it; no table is read or joined twice."""
    before = W.orderBy("day")  # of days
    is_next = F.lag("day").over(before) == F.timestamp_add("DAY", F.lit(-1), "day")
    return days.withColumn("mean_before", F.when(is_next, F.lag("mean").over(before)))


def _days(rollup: DataFrame) -> DataFrame:
    """One row per day: the day's figures, all devices ever heard from, the mean of the day before.

    Each device counts as new on its first day, so the devices are the sum of the new ones of all days.
    """
    first = F.row_number().over(W.partitionBy("device_id").orderBy("day")) == 1
    days = day_figures(rollup.withColumn("is_new", first.cast("long")))
    whole = W.orderBy("day").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # of days
    return with_day_before(days).withColumn("total_sensors", F.sum("new_sensors").over(whole))


def in_order(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    return df.orderBy(*(keys or ("day",))) if ordered else df


def _active() -> dict[str, Column]:
    return {"availability_pct": percent(F.col("active_sensors"), F.col("total_sensors"))}


def _complete(total: Column, interval: int) -> dict[str, Column]:
    expected = total * slots_per_day(interval)
    return {
        "expected_slots": expected,
        "completeness_pct": percent(F.col("occupied_slots"), expected),
    }


def _change(value: str, digits: int) -> dict[str, Column]:
    """Mean and its difference to the previous calendar day."""
    return {
        f"avg_{value}": round_half_up("mean", digits),
        "change": round_half_up(F.col("mean") - F.col("mean_before"), digits),
    }


def _range(value: str, digits: int) -> dict[str, Column]:
    return {
        f"min_{value}": round_half_up("low", digits),
        f"max_{value}": round_half_up("high", digits),
    }


def report_active(
    df: DataFrame, device: str = "device_id", time: str = "event_time", ordered: bool = True
) -> DataFrame:
    """Devices heard from per day, out of all devices."""
    return active_of(_days(_plain_rollup(df, device, time)), ordered)


def active_of(days: DataFrame, ordered: bool) -> DataFrame:
    days = days.withColumns(_active())
    return in_order(
        days.select("day", "active_sensors", "total_sensors", "availability_pct"), ordered
    )


def _plain_rollup(df: DataFrame, device: str, time: str) -> DataFrame:
    """The rollup where no value is asked for."""
    return device_day_rollup(df.withColumn("_none", F.lit(0.0)), "_none", 1440, device, time)


def report_completeness(
    df: DataFrame,
    interval: int = 5,
    by_device: bool = False,
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
) -> DataFrame:
    """Occupied reporting slots as a share of the expected ones, per day or per day and device."""
    rollup = device_day_rollup(
        df.withColumn("_none", F.lit(0.0)), "_none", interval, device, time
    )
    return completeness_of(rollup if by_device else _days(rollup), interval, by_device, device, ordered)


def completeness_of(days: DataFrame, interval: int, by_device: bool, device: str, ordered: bool) -> DataFrame:
    if by_device:
        days = days.select("day", F.col("device_id").alias(device), F.col("slots").alias("occupied_slots"))
        keys, total = ("day", device), F.lit(1).cast("long")
    else:
        keys, total = ("day",), F.col("total_sensors")
    out = days.withColumns(_complete(total, interval))
    return in_order(
        out.select(*keys, "occupied_slots", "expected_slots", "completeness_pct"), ordered, *keys
    )


def report_day_change(
    df: DataFrame, value: str = "temperature", time: str = "event_time", digits: int = 1,
    ordered: bool = True, device: str = "device_id",
) -> DataFrame:
    """Day average and its change from the previous calendar day, NULL when that day is missing."""
    return change_of(_days(device_day_rollup(df, value, 1440, device, time)), value, digits, ordered)


def change_of(days: DataFrame, value: str, digits: int, ordered: bool) -> DataFrame:
    return in_order(days.select("day", *_named(_change(value, digits))), ordered)


def report_day_range(
    df: DataFrame, value: str = "temperature", time: str = "event_time", digits: int = 1,
    ordered: bool = True, device: str = "device_id", start: date | str | None = None, end: date | str | None = None,
) -> DataFrame:
    """Lowest and highest value of the day, for all days or those from ``start`` to ``end``."""
    days = _placed(_between(df, time, start, end), device, time).groupBy(day_of(time).alias("day")).agg(
        F.min(value).alias("low"), F.max(value).alias("high")
    )
    return range_of(days, value, digits, ordered)


def range_of(days: DataFrame, value: str, digits: int, ordered: bool) -> DataFrame:
    return in_order(days.select("day", *_named(_range(value, digits))), ordered)


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def _device_stats(rollup: DataFrame) -> DataFrame:
    """Mean and sample deviation per device, from its days.

    Deviations from a day's mean and of the days' means from the device's add up, without the loss of
    digits that sums of squares would bring.
    """
    own = W.partitionBy("device_id")
    n = F.nullif(F.sum("value_count").over(own), F.lit(0))
    mean = F.sum("value_sum").over(own) / n
    away = F.col("value_sum") / F.nullif(F.col("value_count"), F.lit(0)) - F.col("avg")
    return (
        rollup.withColumn("avg", mean)
        .groupBy("device_id")
        .agg(
            F.sum("rows").alias("_rows"),
            F.max("avg").alias("_avg"),
            F.sum("value_count").alias("_n"),
            F.sum(F.coalesce(F.col("value_dev") + F.col("value_count") * away * away, F.lit(0.0))).alias("_dev"),
        )
        .select(
            "device_id", "_rows", "_avg",
            F.when(F.col("_n") > 1, F.sqrt(F.col("_dev") / (F.col("_n") - 1))).alias("_sd"),
        )
    )


def _with_anomalies(
    df: DataFrame, rollup: DataFrame, days: DataFrame, value: str, k: float, device: str, time: str
) -> DataFrame:
    """Add anomalies, the day's readings beyond ``k`` deviations of their device, and accuracy_pct."""
    readings = _placed(df, device, time).select(
        F.col(device).alias("device_id"), day_of(time).alias("day"), F.col(value).alias("_value")
    )
    beyond = F.abs(F.col("_value") - F.col("_avg")) > k * F.col("_sd")
    flagged = join_key_summary(
        readings.filter(F.col("_value").isNotNull()), _device_stats(rollup), "device_id", "_rows", beyond
    )
    counts = flagged.groupBy("day").agg(F.count("*").alias("anomalies"))
    return (
        days.join(counts, "day", "left")
        .withColumn("anomalies", F.coalesce("anomalies", F.lit(0).cast("long")))
        .withColumn("accuracy_pct", percent(F.col("rows") - F.col("anomalies"), F.col("rows")))
    )


def report_anomalies(
    df: DataFrame,
    value: str = "temperature",
    k: float = 2.0,
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
) -> DataFrame:
    """Sigma anomalies per day and the share of readings that are none."""
    rollup = durable(device_day_rollup(df, value, 1440, device, time))
    days = _with_anomalies(df, rollup, _days(rollup), value, k, device, time)
    return in_order(days.select("day", "rows", "anomalies", "accuracy_pct"), ordered)


def report_sensors(
    df: DataFrame,
    watch: float = WATCH_SPREAD,
    value: str = "temperature",
    measures=MEASURES,
    battery: str = "battery",
    location: str = "location",
    device: str = "device_id",
    time: str = "event_time",
    digits: int = 1,
    ordered: bool = True,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Per day and device: position, averages, spread of the value, and ``WATCH`` or ``OK``.

    For all days, or those from ``start`` to ``end``.
    """
    out = (
        _placed(_between(df, time, start, end), device, time)
        .select(
            day_of(time).alias("day"), device, time, value, *[m for m in measures if m != value],
            battery, F.col(f"{location}.lat").alias("lat"), F.col(f"{location}.lon").alias("lon"),
        )
        .groupBy("day", device)
        .agg(
            F.max_by("lat", time).alias("latitude"),
            F.max_by("lon", time).alias("longitude"),
            *[round_half_up(F.avg(m), digits).alias(f"avg_{m}") for m in measures],
            round_half_up(F.avg(battery), 0).alias(f"avg_{battery}"),
            F.min(value).alias(f"min_{value}"),
            F.max(value).alias(f"max_{value}"),
        )
        .withColumn("spread", round_half_up(F.col(f"max_{value}") - F.col(f"min_{value}"), digits))
        .withColumn("status", F.when(F.col("spread") >= watch, "WATCH").otherwise("OK"))
    )
    return in_order(out, ordered, "day", device)


def report_alerts(
    df: DataFrame,
    watch: float = WATCH_SPREAD,
    value: str = "temperature",
    device: str = "device_id",
    time: str = "event_time",
    digits: int = 1,
    ordered: bool = True,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Per day: each device whose spread needs watching, and the one with the lowest value.

    For all days, or those from ``start`` to ``end``.
    """
    days = (
        _placed(_between(df, time, start, end), device, time)
        .groupBy(day_of(time).alias("day"), device)
        .agg(F.min(value).alias("low"), F.max(value).alias("high"))
    )
    return alerts_of(days, device, watch, digits, ordered)


def alerts_of(days: DataFrame, device: str, watch: float, digits: int, ordered: bool) -> DataFrame:
    # Both alerts of a device's day come from its one row, so the readings are combined once.
    coldest = W.partitionBy("day").orderBy(F.asc_nulls_last("low"), device)
    spread = round_half_up(F.col("high") - F.col("low"), digits)
    alert = lambda name, x: F.struct(F.lit(name).alias("alert"), x.alias("value"))
    lowest = (F.col("rank") == 1) & F.col("low").isNotNull()
    alerts = F.array_compact(
        F.array(
            F.when(spread >= watch, alert("WIDE_SPREAD", spread)),
            F.when(lowest, alert("LOWEST", round_half_up("low", digits))),
        )
    )
    out = days.withColumn("rank", F.row_number().over(coldest)).select(
        "day", device, F.inline(alerts)
    )
    return in_order(out, ordered, "day", "alert", device)


def _health(interval: int, min_avail: float, min_complete: float):
    """Columns of availability and completeness, and then the verdict on both."""
    good = (F.col("availability_pct") >= min_avail) & (F.col("completeness_pct") >= min_complete)
    return (
        _active() | _complete(F.col("total_sensors"), interval),
        {"health": F.when(good, "GOOD").otherwise("DEGRADED")},
    )


def report_health(
    df: DataFrame,
    min_avail: float = MIN_AVAILABILITY,
    min_complete: float = MIN_COMPLETENESS,
    interval: int = 5,
    value: str = "temperature",
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
) -> DataFrame:
    """``GOOD`` for days whose availability and completeness both reach their threshold."""
    return health_of(_days(device_day_rollup(df, value, interval, device, time)), interval, min_avail, min_complete, ordered)


def health_of(days: DataFrame, interval: int, min_avail: float, min_complete: float, ordered: bool) -> DataFrame:
    for columns in _health(interval, min_avail, min_complete):
        days = days.withColumns(columns)
    return in_order(days.select("day", "availability_pct", "completeness_pct", "health"), ordered)


def report_summary(
    df: DataFrame,
    value: str = "temperature",
    interval: int = 5,
    k: float = 2.0,
    min_avail: float = MIN_AVAILABILITY,
    min_complete: float = MIN_COMPLETENESS,
    device: str = "device_id",
    time: str = "event_time",
    digits: int = 1,
    ordered: bool = True,
) -> DataFrame:
    """The report's headline figures, one row per day.

    The readings are read twice: for the rollup, which also gives each device's mean and deviation,
    and to count those beyond them.
    """
    rollup = durable(device_day_rollup(df, value, interval, device, time))
    days = summary_columns(_days(rollup), value, interval, min_avail, min_complete, digits)
    return summary_of(_with_anomalies(df, rollup, days, value, k, device, time), value, ordered)


def summary_columns(
    days: DataFrame, value: str, interval: int, min_avail: float, min_complete: float, digits: int
) -> DataFrame:
    days = days.withColumns(_change(value, digits) | _range(value, digits))
    for columns in _health(interval, min_avail, min_complete):
        days = days.withColumns(columns)
    return days


def summary_of(days: DataFrame, value: str, ordered: bool) -> DataFrame:
    out = days.select(
        "day", "active_sensors", "total_sensors", "availability_pct", "completeness_pct",
        f"avg_{value}", "change", f"min_{value}", f"max_{value}",
        "anomalies", "accuracy_pct", "health",
    )
    return in_order(out, ordered)
