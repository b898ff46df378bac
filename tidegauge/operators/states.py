"""States of a readings table: one small row for each device and day, kept in a table of their own.

A state holds what can be merged: counts, sum, squared deviations, extremes, first and last time, and the
occupied slots as bits. The table has the same day folders as the readings and is brought up to date day by
day: a folder of readings that has not changed since is not read again. Within a folder there is one state
for each UTC day, which near midnight of another zone's calendar may be two.

Readings without a device or a time have states too (latest status and deviations count them); the
report leaves them out, as always.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from tidegauge.functions.time import day_of
from tidegauge.plans.slots import mask_aggregates, mask_columns, occupied
from tidegauge.schema import PARTITION_FIELDS, PARTITION_KEYS
from tidegauge.sources.commits import NO_DAY, day_key, latest, publish, read_days, stage, versions
from tidegauge.sources.readings import scan_readings

_LONG, _DOUBLE, _TIME = T.LongType(), T.DoubleType(), T.TimestampNTZType()


def _schema(interval: int) -> T.StructType:
    fields = [("device_id", T.StringType()), ("utc_day", _TIME), ("rows", _LONG), ("value_count", _LONG)]
    fields += [(f"value_{c}", _DOUBLE) for c in ("sum", "dev", "min", "max")]
    fields += [("first_time", _TIME), ("last_time", _TIME), *((c, _LONG) for c in mask_columns(interval))]
    return T.StructType([T.StructField(*f) for f in fields] + PARTITION_FIELDS)


def day_states(readings: DataFrame, value: str, interval: int) -> DataFrame:
    """One state for each folder, UTC day and device; combined before the shuffle."""
    schema = _schema(interval)
    states = readings.groupBy(*PARTITION_KEYS, "device_id", day_of("event_time").alias("utc_day")).agg(
        F.count("*").alias("rows"),
        F.count(value).alias("value_count"),
        F.sum(value).alias("value_sum"),
        (F.var_pop(value) * F.count(value)).alias("value_dev"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
        *mask_aggregates("event_time", interval),
    )
    return states.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def update_states(
    spark: SparkSession, readings: str, states: str, value: str = "temperature", interval: int = 5,
    mode: str = "PERMISSIVE",
) -> list[str]:
    """Bring the states under ``states`` up to date with the table under ``readings``.

    Only folders that are new or have changed are read, and all of them count from one moment on. Returns
    those folders' days; without a change nothing is read or written.
    """
    settings, now, held = {"value": value, "interval": interval}, versions(spark, readings), latest(spark, states)
    if held is not None and held.notes["settings"] != settings:
        raise ValueError(f"the states are kept with {held.notes['settings']}, not {settings}")
    before = held.notes["source"] if held else {}
    changed = sorted(d for d, version in now.items() if before.get(d) != version)
    gone = sorted(set(before) - set(now))
    if held is not None and not changed and not gone:
        return []
    write, days = None, []
    if changed:
        rows = day_states(scan_readings(spark, readings, mode, changed), value, interval)
        write, days = stage(rows.hint("rebalance", *PARTITION_KEYS), states, "parquet")
    publish(spark, states, write, days, gone=[*gone, *changed], notes={"settings": settings, "source": now})
    return changed


def merged(states: DataFrame, *keys: str) -> DataFrame:
    """States of the same keys as one.

    Deviations from each state's mean and of their means from the common one add up, without the loss of
    digits that sums of squares would bring.
    """
    own = W.partitionBy(*keys)
    mean = F.sum("value_sum").over(own) / F.nullif(F.sum("value_count").over(own), F.lit(0))
    away = F.col("value_sum") / F.nullif(F.col("value_count"), F.lit(0)) - F.col("_mean")
    masks = [c for c in states.columns if c.startswith("slots_")]
    return (
        states.withColumn("_mean", mean)
        .groupBy(*keys)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("value_count").alias("value_count"),
            F.sum("value_sum").alias("value_sum"),
            F.sum(F.coalesce(F.col("value_dev") + F.col("value_count") * away * away, F.lit(0.0))).alias("value_dev"),
            F.min("value_min").alias("value_min"),
            F.max("value_max").alias("value_max"),
            F.min("first_time").alias("first_time"),
            F.max("last_time").alias("last_time"),
            *[F.bit_or(c).alias(c) for c in masks],
        )
    )


def folder_day() -> Column:
    """The day of a row's folder, as commits name it."""
    return F.when(F.col("year").isNull() | F.col("month").isNull() | F.col("day").isNull(), NO_DAY).otherwise(
        F.concat_ws("-", *PARTITION_KEYS)
    )


def days_in(df: DataFrame) -> list[str]:
    """Distinct folder days of rows that have the partition keys: as many at most as the calendar has."""
    return sorted(r.folder for r in df.select(folder_day().alias("folder")).distinct().collect())


class States:
    """The states as they are now; ``start`` and ``end`` are UTC days, both included."""

    def __init__(self, spark: SparkSession, root: str):
        commit = latest(spark, root)
        if commit is None:
            raise ValueError(f"no states under {root}: call update_states first")
        self.spark, self.root = spark, root
        self.value, self.interval = commit.notes["settings"]["value"], commit.notes["settings"]["interval"]

    def rows(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """All states, or those of some days, for which the folders of these and their neighbours are opened."""
        schema = _schema(self.interval)
        if start is None:
            return read_days(self.spark, self.root, schema, "parquet")
        days = [day_key(start + timedelta(n)) for n in range(-1, (end - start).days + 2)]
        inside = F.col("utc_day").between(*(F.lit(d.isoformat()).cast("timestamp_ntz") for d in (start, end)))
        return read_days(self.spark, self.root, schema, "parquet", days).filter(inside)

    def device_days(self, start: date, end: date) -> DataFrame:
        """Per device and day, with ``day`` and the occupied ``slots``; only devices and times that are known."""
        known = self.rows(start, end).filter(F.col("device_id").isNotNull()).drop(*PARTITION_KEYS)
        days = merged(known.withColumnRenamed("utc_day", "day"), "day", "device_id")
        return days.withColumn("slots", occupied(self.interval))

    def devices(self, timed: bool = True) -> DataFrame:
        """Per known device: all its states as one, with ``avg`` and sample deviation ``sd``.

        ``timed`` leaves out readings without a time.
        """
        rows = self.rows().filter(F.col("device_id").isNotNull() & (F.lit(not timed) | F.col("utc_day").isNotNull()))
        n = F.col("value_count")
        masks = mask_columns(self.interval)
        return merged(rows.drop(*PARTITION_KEYS, "utc_day", *masks), "device_id").withColumns({
            "avg": F.col("value_sum") / F.nullif(n, F.lit(0)),
            "sd": F.when(n > 1, F.sqrt(F.col("value_dev") / (n - 1))),
        })
