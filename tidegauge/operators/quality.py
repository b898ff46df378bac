"""Missing readings, loss accounting, ordering and record counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidegauge.functions.numeric import percent
from tidegauge.functions.time import day_of, partition_keys, slot_floor, slot_of_day, slot_start
from tidegauge.plans.presented import presented
from tidegauge.plans.slots import (
    first_occupied, last_occupied, mask_aggregates, missing, occupied, slots_per_day,
)
from tidegauge.schema import PARTITION_KEYS


def _bound(given, interval: int) -> Column | None:
    return None if given is None else slot_floor(F.lit(given).cast("timestamp_ntz"), interval)


def _inside(time: str, interval: int, first: Column | None, last: Column | None) -> Column:
    """Range condition on the bare time column, which a scan can use."""
    inside = F.col(time).isNotNull()
    if first is not None:
        inside = inside & (F.col(time) >= first)
    if last is not None:
        inside = inside & (F.col(time) < F.timestamp_add("MINUTE", F.lit(interval), last))
    return inside


def _device_days(
    df: DataFrame, interval: int, start, end, device: str, time: str
) -> tuple[DataFrame, Column, Column]:
    """Occupied slots per device and day, and the first and last expected slot.

    Readings outside given bounds only vouch for their device, under a NULL day, and so do those without
    a time. A bound that is not given is the first or last occupied slot of all readings, which the masks
    tell. The readings are combined once, as both uses share the exchange: to that end both ask for the
    same columns, and whether the device is known is asked of a column that only exists above it.
    """
    first, last = _bound(start, interval), _bound(end, interval)
    inside = F.when(_inside(time, interval, first, last), F.col(time))
    masks = (
        df.select(device, inside.alias("inside"))
        .groupBy(device, day_of("inside").alias("day"))
        .agg(F.max(F.col(device).isNotNull()).alias("known"), *mask_aggregates("inside", interval))
    )
    every = masks.filter(F.col("known").isNotNull())
    if first is None:
        opens = slot_start("day", first_occupied(interval), interval)
        first = every.agg(F.min(opens).alias("at")).scalar()
    if last is None:
        closes = slot_start("day", last_occupied(interval), interval)
        last = every.agg(F.max(closes).alias("at")).scalar()
    return masks.filter("known"), first, last


def missing_slots(
    df: DataFrame,
    interval: int = 5,
    start=None,
    end=None,
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
) -> DataFrame:
    """Expected slots of each device that hold no reading.

    Every device of ``df`` is expected in every slot of ``interval`` minutes from ``start`` to
    ``end``, by default the first and last slot of the whole data. No grid is built or joined:
    readings shrink to a bit mask per device and day, each day looks back to the device's day
    before it, and only the unset slots and the days in between become rows.
    """
    masks, first, last = _device_days(df, interval, start, end, device, time)
    by_day = W.partitionBy(device).orderBy(F.asc_nulls_first("day"))
    day, eve = F.col("day").cast("date"), F.date_sub(first.cast("date"), 1)
    none = F.array().cast("array<date>")

    def between(low: Column, high: Column) -> Column:
        return F.when(low <= high, F.sequence(low, high)).otherwise(none)

    silent_before = between(F.date_add(F.coalesce("before", eve), 1), F.date_sub(day, 1))
    silent_after = F.when(
        F.col("newest"), between(F.date_add(F.coalesce(day, eve), 1), last.cast("date"))
    ).otherwise(none)
    own = F.when(day.isNotNull(), F.array(day)).otherwise(none)
    every_slot = F.sequence(F.lit(0), F.lit(slots_per_day(interval) - 1))
    out = (
        masks.withColumns(
            {
                "before": F.lag(day).over(by_day),
                "newest": F.lead(F.lit(1)).over(by_day).isNull(),
                "unset": missing(interval),
            }
        )
        .withColumn("expected_day", F.explode(F.concat(silent_before, own, silent_after)))
        .withColumn(
            "slot",
            F.explode(F.when(F.col("expected_day").eqNullSafe(day), F.col("unset")).otherwise(every_slot)),
        )
        .select(
            device,
            slot_start(F.col("expected_day").cast("timestamp_ntz"), "slot", interval).alias("slot"),
        )
        .filter(F.col("slot").between(first, last))
    )
    return out.orderBy(device, "slot") if ordered else out


def loss_summary(
    df: DataFrame,
    interval: int = 5,
    start=None,
    end=None,
    device: str = "device_id",
    time: str = "event_time",
    ordered: bool = True,
) -> DataFrame:
    """Expected, actual and lost slots with the loss rate in percent, per device and overall.

    The overall row has a NULL device. The expected number follows from the bounds alone.
    """
    masks, first, last = _device_days(df, interval, start, end, device, time)
    days = F.datediff(last.cast("date"), first.cast("date")).cast("long")
    expected = (
        days * slots_per_day(interval) + slot_of_day(last, interval) - slot_of_day(first, interval) + 1
    )
    per_device = (
        masks.groupBy(device)
        .agg(F.sum(occupied(interval)).alias("actual"))
    )
    out = (
        per_device.rollup(device)
        .agg((F.count("*") * F.max(expected)).alias("expected"), F.sum("actual").alias("actual"))
        .withColumn("lost", F.col("expected") - F.col("actual"))
        .withColumn("loss_rate", percent(F.col("lost"), F.col("expected")))
    )
    return out.orderBy(F.asc_nulls_last(device)) if ordered else out


def time_ordered(
    df: DataFrame, device: str = "device_id", time: str = "event_time"
) -> DataFrame:
    """All readings in time order; readings of one instant by device."""
    return presented(df, F.asc_nulls_last(time), F.asc_nulls_last(device), spread=True)


def daily_record_counts(
    df: DataFrame, time: str = "event_time", zone: str = "UTC", ordered: bool = True
) -> DataFrame:
    """Records per calendar day of the writer's zone, under the partition keys."""
    out = df.groupBy(*partition_keys(time, zone)).agg(F.count("*").alias("record_count"))
    return out.orderBy(*[F.asc_nulls_last(c) for c in PARTITION_KEYS]) if ordered else out
