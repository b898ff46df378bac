"""Answers from stored states: the report of one day or a few, and figures of all history, that read
only the folders of readings they need."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.functions.numeric import percent
from tidegauge.functions.time import day_of
from tidegauge.operators import report
from tidegauge.operators.states import States, days_in, folder_day
from tidegauge.operators.trends import latest_status
from tidegauge.plans.presented import presented
from tidegauge.schema import MEASURES, PARTITION_KEYS
from tidegauge.session import durable
from tidegauge.sources.readings import scan_date_range, scan_readings


def _date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


class DailyReport:
    """The report tables of :mod:`tidegauge.operators.report` for ``start`` to ``end``, by default one day.

    ``readings`` is the root of the table and ``states`` of its states, which :func:`update_states` keeps.
    Figures of a day come from the states of that day and the one before, those that need all history (the
    number of devices, their means and deviations) from all states. Of the readings only the days asked
    for are opened, and only by the tables of sensors and anomalies.
    """

    def __init__(
        self, spark: SparkSession, readings: str, states: str, start: date | str, end: date | str | None = None,
        mode: str = "PERMISSIVE",
    ):
        self.spark, self.readings, self.mode = spark, readings, mode
        self.start, self.end = _date(start), _date(start if end is None else end)
        self.states = States(spark, states)
        self.value, self.interval = self.states.value, self.states.interval

    def _scan(self) -> DataFrame:
        return scan_date_range(self.spark, self.readings, self.start, self.end, self.mode)

    def _device_days(self) -> DataFrame:
        return self.states.device_days(self.start, self.end)

    def _days(self) -> DataFrame:
        """One row per day with the figures, the number of devices and the mean of the day before."""
        eve = self.start - timedelta(1) if self.start > date.min else self.start
        days = report.with_day_before(report.day_figures(self.states.device_days(eve, self.end)))
        total = self.states.devices().agg(F.count("*")).scalar()
        first = F.lit(self.start.isoformat()).cast("timestamp_ntz")
        return days.filter(F.col("day") >= first).withColumn("total_sensors", total)

    def active(self, ordered: bool = True) -> DataFrame:
        return report.active_of(self._days(), ordered)

    def completeness(self, by_device: bool = False, ordered: bool = True) -> DataFrame:
        days = self._device_days() if by_device else self._days()
        return report.completeness_of(days, self.interval, by_device, "device_id", ordered)

    def day_change(self, digits: int = 1, ordered: bool = True) -> DataFrame:
        return report.change_of(self._days(), self.value, digits, ordered)

    def day_range(self, digits: int = 1, ordered: bool = True) -> DataFrame:
        return report.range_of(report.day_figures(self._device_days()), self.value, digits, ordered)

    def sensors(self, watch: float = report.WATCH_SPREAD, measures: Sequence[str] = MEASURES, **options) -> DataFrame:
        return report.report_sensors(self._scan(), watch, self.value, measures, **options)

    def alerts(self, watch: float = report.WATCH_SPREAD, digits: int = 1, ordered: bool = True) -> DataFrame:
        rows = self._device_days().select("day", "device_id", F.col("value_min").alias("low"), F.col("value_max").alias("high"))
        return report.alerts_of(rows, "device_id", watch, digits, ordered)

    def health(
        self, min_avail: float = report.MIN_AVAILABILITY, min_complete: float = report.MIN_COMPLETENESS, ordered: bool = True
    ) -> DataFrame:
        return report.health_of(self._days(), self.interval, min_avail, min_complete, ordered)

    def _with_anomalies(self, days: DataFrame, k: float) -> DataFrame:
        """Add anomalies and accuracy; readings are only joined for device days whose extremes are beyond."""

        def beyond(x: str):
            return F.abs(F.col(x) - F.col("avg")) > k * F.col("sd")

        devices = self.states.devices().select("device_id", "avg", "sd")
        suspects = self._device_days().join(devices, "device_id").filter(beyond("value_min") | beyond("value_max"))
        readings = self._scan().select("device_id", day_of("event_time").alias("day"), F.col(self.value).alias("_value"))
        # Which side is small, and whether a device is hot, adaptive execution finds out while it runs.
        flagged = readings.join(suspects.select("day", "device_id", "avg", "sd"), ["day", "device_id"]).filter(beyond("_value"))
        counts = flagged.groupBy("day").agg(F.count("*").alias("anomalies"))
        return (
            days.join(counts, "day", "left")
            .withColumn("anomalies", F.coalesce("anomalies", F.lit(0).cast("long")))
            .withColumn("accuracy_pct", percent(F.col("rows") - F.col("anomalies"), F.col("rows")))
        )

    def anomalies(self, k: float = 2.0, ordered: bool = True) -> DataFrame:
        days = self._with_anomalies(report.day_figures(self._device_days()), k)
        return report.in_order(days.select("day", "rows", "anomalies", "accuracy_pct"), ordered)

    def summary(
        self, k: float = 2.0, min_avail: float = report.MIN_AVAILABILITY, min_complete: float = report.MIN_COMPLETENESS,
        digits: int = 1, ordered: bool = True,
    ) -> DataFrame:
        days = report.summary_columns(self._days(), self.value, self.interval, min_avail, min_complete, digits)
        return report.summary_of(self._with_anomalies(days, k), self.value, ordered)


def sigma_anomalies_of(
    spark: SparkSession, readings: str, states: str, k: float = 2.0, mode: str = "PERMISSIVE", ordered: bool = True
) -> DataFrame:
    """What :func:`tidegauge.operators.anomaly.sigma_anomalies` finds, with means and deviations from states.

    Readings are opened only in folders where the extremes of a device lie beyond its bounds, and joined
    with those devices' days alone.
    """
    held = States(spark, states)
    value = held.value
    high = lambda x: F.col(x) > F.col("avg_temp") + k * F.col("stddev_temp")
    low = lambda x: F.col(x) < F.col("avg_temp") - k * F.col("stddev_temp")
    devices = held.devices(timed=False).select("device_id", F.col("avg").alias("avg_temp"), F.col("sd").alias("stddev_temp"))
    suspects = held.rows().join(devices, "device_id").filter(high("value_max") | low("value_min"))
    # Computed once, for the folders to open and for the join.
    suspects = durable(suspects.select("device_id", folder_day().alias("folder"), "avg_temp", "stddev_temp").distinct())
    folders = sorted(r.folder for r in suspects.select("folder").distinct().collect())  # days of the calendar
    rows = scan_readings(spark, readings, mode, folders).select(
        "device_id", folder_day().alias("folder"), F.col("event_time").alias("timestamp"), value
    )
    out = rows.filter(F.col(value).isNotNull()).join(suspects, ["device_id", "folder"]).filter(high(value) | low(value)).select(
        "device_id", "timestamp", value, "avg_temp", "stddev_temp",
        F.when(high(value), "HIGH_ANOMALY").otherwise("LOW_ANOMALY").alias("anomaly_type"),
    )
    return presented(out, F.asc_nulls_last("timestamp"), "device_id", settle=True, spread=True) if ordered else out


def latest_status_of(
    spark: SparkSession, readings: str, states: str, mode: str = "PERMISSIVE", tie_break: Sequence[str] = ()
) -> DataFrame:
    """What :func:`tidegauge.operators.trends.latest_status` finds, opening only the folders that hold the
    newest reading of some device; the states tell which those are.

    For a device without any time that is a folder with readings of it.
    """
    never = F.lit("0001-01-01").cast("timestamp_ntz") - F.expr("INTERVAL '1' DAY")  # before any time a reading can have
    newest = States(spark, states).rows().groupBy("device_id").agg(
        F.max_by(F.struct(*PARTITION_KEYS), F.coalesce("last_time", never)).alias("at")
    )
    folders = days_in(newest.select("at.*"))
    return latest_status(scan_readings(spark, readings, mode, folders), tie_break=tie_break)
