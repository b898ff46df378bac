"""Registered queries and the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.adapters import lines_from_conversations, readings_from_events
from tidegauge.functions.numeric import round_half_up
from tidegauge.functions.time import hour_of
from tidegauge.operators import anomaly, correlation, daily, quality, report, stats, transcripts, trends
from tidegauge.operators.states import update_states
from tidegauge.session import scratch_path
from tidegauge.sinks import files
from tidegauge.sources import readings as source
from tidegauge.sources.transcripts import scan_transcript_lines

try:  # the operators for training data are an optional part
    import corpus_pipeline
    from tidegauge.llm import queries as llm
except ImportError:  # without them, or without a library that they need
    llm = None

HOUR = 60  # reporting interval, in minutes, that fits the density of the test events
DAY = "2024-01-15"
RANGE = ("2024-01-10", "2024-01-12")


def _readings(spark: SparkSession, sf_dir: str, device: str = "event_type") -> DataFrame:
    return readings_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), device)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir, "user_id")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lines_from_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return transcripts.transcript_lines(raw)


def _rounded_sigma(df: DataFrame, **options) -> DataFrame:
    out = anomaly.sigma_anomalies(df, **options)
    return out.withColumns(
        {c: round_half_up(c, 6) for c in ("avg_temp", "stddev_temp")}
    )


# -- sources and sinks: write the events as a readings table, read it back ---------------------


def _written_table(spark: SparkSession, sf_dir: str, zone: str = "UTC") -> str:
    root = scratch_path(spark, "readings")
    files.write_partitioned_jsonl(_readings(spark, sf_dir), root, zone)
    return root


def _stored_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "device_id", "event_time", "temperature", "humidity", "pressure",
        F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"),
        "battery", "year", "month", "day",
    )


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_columns(source.scan_readings(spark, _written_table(spark, sf_dir)))


def jsonl_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _written_table(spark, sf_dir, zone="Asia/Tokyo")
    return _stored_columns(source.scan_date_range(spark, root, *RANGE))


def jsonl_partition_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = source.scan_readings(spark, _written_table(spark, sf_dir))
    return stats.active_devices(table, DAY)


def jsonl_replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table, then publish one corrected day in place of it; the other days stay."""
    root = _written_table(spark, sf_dir)
    corrected = _readings(spark, sf_dir).filter(F.col("event_time").cast("date") == DAY)
    files.publish_readings(corrected.withColumn("battery", F.lit(100)), root)
    return _stored_columns(source.scan_readings(spark, root))


def jsonl_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table, then refresh it in full with the readings before DAY; later days go."""
    root = _written_table(spark, sf_dir)
    earlier = _readings(spark, sf_dir).filter(F.col("event_time") < DAY)
    files.publish_readings(earlier, root, replace="all")
    return _stored_columns(source.scan_readings(spark, root))


def jsonl_replace_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table, then swap the files of one corrected day for readers without commits."""
    root = _written_table(spark, sf_dir)
    corrected = _readings(spark, sf_dir).filter(F.col("event_time").cast("date") == DAY)
    files.write_partitioned_jsonl(corrected.withColumn("battery", F.lit(100)), root)
    return _stored_columns(source.scan_readings(spark, root))


def _stated(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A table of readings by user and its states, both brought up to date once.

    The writer lives in Tokyo, so the later readings also go into the folder that is half full.
    """
    readings, states, df = scratch_path(spark, "readings"), scratch_path(spark, "states"), _users(spark, sf_dir)
    files.publish_readings(df.filter(F.col("event_time") < DAY), readings, "Asia/Tokyo")
    update_states(spark, readings, states, interval=HOUR)
    files.publish_readings(df.filter(F.col("event_time") >= DAY), readings, "Asia/Tokyo", replace="none")
    update_states(spark, readings, states, interval=HOUR)
    return readings, states


def _day_report(table: str, *days: str, **options) -> Callable[[SparkSession, str], DataFrame]:
    """A table of the report for DAY, or from the first to the last of ``days``, from stored states."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = daily.DailyReport(spark, *_stated(spark, sf_dir), *(days or (DAY,)))
        return getattr(made, table)(**options)

    return run


def sigma_anomalies_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = daily.sigma_anomalies_of(spark, *_stated(spark, sf_dir))
    return out.withColumns({c: round_half_up(c, 6) for c in ("avg_temp", "stddev_temp")})


def latest_status_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.latest_status_of(spark, *_stated(spark, sf_dir))


_ODD_TIMES = ["T", "T Z", "time", "date", "month", "+09:00", "-0330", "words"]


def jsonl_odd_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store lines whose time is written in eight ways, most of them odd, and read them back."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    forms = [
        text, F.concat(F.translate(text, "T", " "), F.lit("Z")), F.substring(text, 12, 8), F.substring(text, 1, 10),
        F.substring(text, 1, 7), F.concat(text, F.lit("+09:00")), F.concat(F.substring(text, 1, 16), F.lit("-0330")),
        F.lit("yesterday"),
    ]
    stored = F.element_at(F.array(*forms), F.pmod(F.col("event_id"), F.lit(8)).cast("int") + 1)
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("device_id"), stored.alias("timestamp")))
    root = scratch_path(spark, "odd-times")
    keys = [F.date_format("ts", f).alias(n) for f, n in (("yyyy", "year"), ("MM", "month"), ("dd", "day"))]
    events.select(line.alias("value"), *keys).hint("rebalance", "year", "month", "day").write.partitionBy(
        "year", "month", "day"
    ).text(root)
    return source.scan_readings(spark, root).select("device_id", "event_time")


def jsonl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the raw payloads as lines, those of errors cut short; read the lines that fail."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    whole = F.to_json(
        F.struct(F.col("event_id").cast("string").alias("device_id"), F.col("value").alias("temperature"))
    )
    line = F.when(F.col("event_type") == "error", F.expr("left(whole, length(whole) - 1)")).otherwise(
        F.col("whole")
    )
    root = scratch_path(spark, "rejects")
    (
        events.withColumn("whole", whole)
        .select(line.alias("value"), *[F.date_format("ts", f).alias(n) for f, n in
                                       (("yyyy", "year"), ("MM", "month"), ("dd", "day"))])
        .hint("rebalance", "year", "month", "day")
        .write.partitionBy("year", "month", "day").text(root)
    )
    return source.scan_rejects(spark, root).select(
        F.col(source.CORRUPT).alias("line"), "year", "month", "day"
    )


def jsonl_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "plain")
    rows = quality.time_ordered(_readings(spark, sf_dir))
    files.write_jsonl(files.to_stored(rows).drop("year", "month", "day"), path)
    return source.scan_readings(spark, path).select(
        "device_id", "event_time", "temperature", "humidity", "pressure",
        F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"), "battery",
    )


def csv_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "result")
    files.write_result_csv(_readings(spark, sf_dir), path)
    schema = (
        "device_id string, event_time timestamp_ntz, temperature double, humidity double, "
        "pressure double, location_lat double, location_lon double, battery int"
    )
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )


def registered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL text over the table."""
    source.register_readings(spark, _written_table(spark, sf_dir), "sensor_data")
    return spark.sql(
        """
        SELECT device_id, count(*) AS record_count, min(battery) AS min_battery,
               max(location.lat) AS max_lat
        FROM sensor_data WHERE year = '2024' AND month = '01' AND day >= '08'
        GROUP BY device_id ORDER BY device_id
        """
    )


def transcript_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one text file for each transcript, scan and parse them."""
    path = scratch_path(spark, "transcripts")
    raw = lines_from_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    files.write_transcripts(raw, path)
    parsed = transcripts.transcript_lines(scan_transcript_lines(spark, path))
    session = F.regexp_extract("session_id", "session_id=([^/]+)", 1).alias("session_id")
    return parsed.select(session, "line_no", "hhmm", "speaker", "text")


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship query: readings more than two standard deviations from their device's mean."""
    return _rounded_sigma(_readings(spark, sf_dir))


def _on(load: Callable, op: Callable, *args, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(load(spark, sf_dir), *args, **options)


def _at_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings stamped with their full hour, so devices share times and hold several per time."""
    return _readings(spark, sf_dir).withColumn("event_time", hour_of("event_time"))


def _some_untimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by user, of which one user in seven has no time in any and the rest lack some."""
    user, battery = F.col("device_id").cast("long"), F.col("battery")
    known = F.when((user % 7 != 0) & (battery % 3 != 0), F.col("event_time"))
    return _users(spark, sf_dir).withColumn("event_time", known)


def _known_status(df: DataFrame) -> DataFrame:
    out = trends.latest_status(df)
    when = F.col("last_update").isNotNull()
    return out.select("device_id", "last_update", F.when(when, F.col("temperature")).alias("temperature"),
                      F.col("temperature").isNotNull().alias("has_value"))


def _level(df: DataFrame) -> DataFrame:
    """The same readings at a level of 1e9, a different one for each device."""
    level = F.lit(1e9) + F.length("device_id") * 1e8
    return df.withColumn("temperature", F.col("temperature") + level)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on, users, lines = partial(_on, _readings), partial(_on, _users), partial(_on, _lines)
    return {
        # fleet and device statistics
        "dataset_overview": on(stats.dataset_overview),
        "device_stats": on(stats.device_stats),
        "hourly_avg_temperature": on(stats.bucket_avg, "hour", ["temperature"], with_count=True),
        "daily_temperature_range": on(stats.bucket_range, "day", "temperature"),
        "hourly_fleet_avg": on(stats.bucket_avg, "hour", name="time_hour",
                               measures=["temperature", "humidity", "pressure"]),
        "daily_device_avg": on(stats.device_bucket_avg, "day"),
        "hour_of_day_profile": on(stats.hour_of_day_profile),
        "active_devices": users(stats.active_devices, DAY, time="event_time"),
        "sensor_averages_tz": on(stats.sensor_averages_tz),
        "user_stats": users(stats.device_stats),
        # anomalies
        "sigma_anomalies": on(_rounded_sigma),
        "sigma_labels": on(_rounded_sigma, only_anomalies=False),
        "user_sigma_anomalies": users(_rounded_sigma),
        "user_sigma_anomalies_many_keys": users(_rounded_sigma, broadcast_rows=50),
        "low_battery": on(anomaly.low_battery),
        "spikes": on(anomaly.spikes, delta=50),
        "user_spikes": users(anomaly.spikes, delta=50),
        "time_gaps": on(anomaly.time_gaps),
        "user_time_gaps": users(anomaly.time_gaps, minutes=1440),
        # trends
        "latest_status": on(trends.latest_status),
        "user_latest_status": users(trends.latest_status),
        "user_latest_status_ranked": users(trends.latest_status, tie_break=["temperature"]),
        "latest_status_missing_times": partial(_on, _some_untimed)(_known_status),
        "moving_average": on(trends.moving_average),
        "moving_average_range": on(trends.moving_average, by="range"),
        "device_correlation": on(correlation.device_correlation, align="hour"),
        "device_correlation_shared_times": partial(_on, _at_hours)(correlation.device_correlation),
        "device_correlation_level": on(lambda df: correlation.device_correlation(_level(df), align="hour")),
        "device_correlation_some": on(
            correlation.device_correlation, align="hour", devices=["error", "login"]),
        "user_correlation": users(correlation.device_correlation, align="day", min_samples=10),
        # sources and sinks
        "jsonl_roundtrip": jsonl_roundtrip,
        "jsonl_date_range": jsonl_date_range,
        "jsonl_partition_day": jsonl_partition_day,
        "jsonl_replace_days": jsonl_replace_days,
        "jsonl_replace_all": jsonl_replace_all,
        "jsonl_replace_in_place": jsonl_replace_in_place,
        "jsonl_odd_times": jsonl_odd_times,
        "jsonl_rejects": jsonl_rejects,
        "jsonl_plain": jsonl_plain,
        "csv_result": csv_result,
        "registered_view": registered_view,
        # data quality
        "missing_slots": on(quality.missing_slots, HOUR),
        "user_missing_slots": users(quality.missing_slots, HOUR),
        "loss_summary": on(quality.loss_summary, HOUR),
        "user_loss_summary": users(quality.loss_summary, 5),
        "daily_record_counts": on(quality.daily_record_counts),
        "daily_record_counts_tokyo": on(quality.daily_record_counts, zone="Asia/Tokyo"),
        "time_ordered": on(lambda df: quality.time_ordered(df).select(
            "*", "location.lat", "location.lon").drop("location")),
        # daily report
        "report_active": users(report.report_active),
        "report_completeness": on(report.report_completeness, HOUR),
        "report_completeness_by_device": on(report.report_completeness, HOUR, by_device=True),
        "report_day_change": on(report.report_day_change),
        "report_day_range": on(report.report_day_range),
        "report_anomalies": on(report.report_anomalies),
        "report_sensors": on(report.report_sensors),
        "report_alerts": users(report.report_alerts, watch=100.0),
        "report_health": on(report.report_health, interval=HOUR),
        "report_summary": on(report.report_summary, interval=HOUR),
        "report_one_day_range": on(report.report_day_range, start=DAY, end=DAY),
        "report_days_sensors": on(report.report_sensors, start=RANGE[0], end=RANGE[1]),
        "report_days_alerts": users(report.report_alerts, watch=100.0, start=RANGE[0], end=RANGE[1]),
        # the same for one day or a few, and figures of all history, from stored states
        "day_active": _day_report("active"),
        "day_completeness": _day_report("completeness"),
        "day_completeness_by_device": _day_report("completeness", by_device=True),
        "day_change": _day_report("day_change"),
        "day_range": _day_report("day_range"),
        "day_anomalies": _day_report("anomalies"),
        "day_sensors": _day_report("sensors"),
        "day_alerts": _day_report("alerts", watch=100.0),
        "day_health": _day_report("health"),
        "day_summary": _day_report("summary"),
        "days_summary": _day_report("summary", "2024-01-13", "2024-01-17"),
        "sigma_anomalies_states": sigma_anomalies_states,
        "latest_status_states": latest_status_states,
        # transcripts
        "transcript_files": transcript_files,
        "transcript_lines": lines(lambda df: df),
        "transcript_timeline": lines(transcripts.transcript_timeline),
        "transcript_metrics": lines(transcripts.transcript_metrics),
    } | ({"pipeline": corpus_pipeline.run, **llm.QUERIES} if llm else {})


# -- the same results in SQL --------------------------------------------------------------------

_MEASURES = ("temperature", "humidity", "pressure")


def _round(x: str, digits: int) -> str:
    return f"CAST(round(TRY_CAST({x} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return _round(f"100.0 * CAST({part} AS DOUBLE) / nullif({whole}, 0)", 2)


def _avgs(digits: int = 2) -> str:
    return ", ".join(f"{_round(f'avg({m})', digits)} AS avg_{m}" for m in _MEASURES)


def _base(device: str = "event_type", time: str = "ts") -> str:
    return f"""r AS (
      SELECT CAST({device} AS VARCHAR) AS device_id, {time} AS event_time, value AS temperature,
             CAST(props->>'$.k' AS DOUBLE) AS humidity, CAST(user_id AS DOUBLE) AS pressure,
             CAST(props->>'$.k' AS INTEGER) AS battery
      FROM events)"""


_R, _U = _base(), _base("user_id")


def _device_stats(base: str) -> str:
    return f"""WITH {base} SELECT device_id, count(*) AS record_count, {_avgs()},
      min(battery) AS min_battery, max(battery) AS max_battery FROM r GROUP BY device_id"""


def _sigma(base: str, only: bool = True) -> str:
    high, low = "temperature > a + 2.0 * s", "temperature < a - 2.0 * s"
    return f"""WITH {base}, st AS (
        SELECT device_id, avg(temperature) AS a, stddev_samp(temperature) AS s FROM r GROUP BY 1)
      SELECT device_id, event_time AS timestamp, temperature, {_round('a', 6)} AS avg_temp,
             {_round('s', 6)} AS stddev_temp,
             CASE WHEN {high} THEN 'HIGH_ANOMALY' WHEN {low} THEN 'LOW_ANOMALY' ELSE 'NORMAL' END
               AS anomaly_type
      FROM r JOIN st USING (device_id) {f'WHERE {high} OR {low}' if only else ''}"""


def _spikes(base: str, delta: int) -> str:
    over = "OVER (PARTITION BY device_id ORDER BY event_time, temperature)"
    return f"""WITH {base}, w AS (
        SELECT device_id, event_time AS timestamp, temperature,
               lag(temperature) {over} AS prev_temp, lead(temperature) {over} AS next_temp FROM r)
      SELECT * FROM w
      WHERE abs(temperature - prev_temp) > {delta} AND abs(temperature - next_temp) > {delta}"""


def _gaps(base: str, minutes: int) -> str:
    return f"""WITH {base}, w AS (
        SELECT device_id, event_time AS timestamp,
               lag(event_time) OVER (PARTITION BY device_id ORDER BY event_time) AS prev_timestamp
        FROM r), g AS (
        SELECT *, (epoch_us(timestamp) - epoch_us(prev_timestamp)) / 6e7 AS gap_minutes FROM w)
      SELECT * FROM g WHERE gap_minutes > {minutes}"""


def _latest(base: str) -> str:
    return f"""WITH {base}, w AS (
        SELECT *, row_number() OVER (PARTITION BY device_id
          ORDER BY event_time DESC, temperature DESC) AS rn FROM r)
      SELECT device_id, event_time AS last_update, temperature, humidity, pressure, battery,
             humidity AS latitude, pressure AS longitude
      FROM w WHERE rn = 1"""


def _moving(frame: str) -> str:
    return f"""WITH {_R}, h AS (
        SELECT device_id, date_trunc('hour', event_time) AS hour, avg(temperature) AS t
        FROM r GROUP BY 1, 2)
      SELECT device_id, hour, {_round('t', 2)} AS temperature,
             {_round(f'avg(t) OVER (PARTITION BY device_id ORDER BY hour {frame})', 2)}
               AS moving_avg_12h
      FROM h"""


def _correlation(rows: str, samples: int) -> str:
    x, y = "CASE WHEN y IS NOT NULL THEN x END", "CASE WHEN x IS NOT NULL THEN y END"
    corr = f"covar_pop(x, y) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"
    return f"""WITH {rows}, p AS (
        SELECT a.device_id AS device_a, b.device_id AS device_b, a.v AS x, b.v AS y
        FROM c a JOIN c b ON a.t = b.t AND a.device_id < b.device_id)
      SELECT device_a, device_b, {_round(corr, 3)} AS temperature_correlation,
             count(*) AS sample_size
      FROM p GROUP BY 1, 2 HAVING count(*) > {samples}"""


def _stored(where: str = "", zone: str = "", battery: str = "battery") -> str:
    local = f"event_time AT TIME ZONE 'UTC' AT TIME ZONE '{zone}'" if zone else "event_time"
    return f"""WITH {_R} SELECT device_id, event_time, temperature, humidity, pressure,
      humidity AS lat, pressure AS lon, {battery} AS battery,
      strftime({local}, '%Y') AS year, strftime({local}, '%m') AS month,
      strftime({local}, '%d') AS day
      FROM r {where}"""


def _grid(base: str, minutes: int) -> str:
    slot = f"time_bucket(INTERVAL {minutes} MINUTE, event_time)"
    return f"""{base}, o AS (SELECT DISTINCT device_id, {slot} AS slot FROM r),
      e AS (SELECT unnest(generate_series(min(slot), max(slot), INTERVAL {minutes} MINUTE)) AS slot
            FROM o),
      g AS (SELECT d.device_id, e.slot FROM (SELECT DISTINCT device_id FROM r) d, e)"""


def _missing(base: str, minutes: int) -> str:
    return f"""WITH {_grid(base, minutes)}
      SELECT device_id, slot FROM g ANTI JOIN o USING (device_id, slot)"""


def _loss(base: str, minutes: int) -> str:
    return f"""WITH {_grid(base, minutes)}, l AS (
        SELECT g.device_id, count(*) AS expected, count(o.slot) AS actual
        FROM g LEFT JOIN o ON g.device_id = o.device_id AND g.slot = o.slot
        GROUP BY ROLLUP (g.device_id))
      SELECT device_id, expected, actual, expected - actual AS lost,
             {_pct('expected - actual', 'expected')} AS loss_rate FROM l"""


def _daily_counts(zone: str = "") -> str:
    local = f"event_time AT TIME ZONE 'UTC' AT TIME ZONE '{zone}'" if zone else "event_time"
    return f"""WITH {_R} SELECT strftime({local}, '%Y') AS year, strftime({local}, '%m') AS month,
      strftime({local}, '%d') AS day, count(*) AS record_count FROM r GROUP BY 1, 2, 3"""


_DAY = "date_trunc('day', event_time)"
_HOUR_SLOT = "date_trunc('hour', event_time)"


def _report(base: str) -> str:
    """Per-day facts of the report, with whole hours as slots."""
    return f"""WITH {base}, s AS (
        SELECT device_id, avg(temperature) AS a, stddev_samp(temperature) AS sd FROM r GROUP BY 1),
      f AS (SELECT {_DAY} AS day, count(*) AS anomalies FROM r JOIN s USING (device_id)
            WHERE temperature > a + 2.0 * sd OR temperature < a - 2.0 * sd GROUP BY 1),
      n AS (SELECT count(DISTINCT device_id) AS total FROM r),
      d AS (SELECT {_DAY} AS day, count(*) AS rows, count(DISTINCT device_id) AS active,
                   count(DISTINCT (device_id, {_HOUR_SLOT})) AS slots, avg(temperature) AS mean,
                   min(temperature) AS lo, max(temperature) AS hi
            FROM r GROUP BY 1),
      t AS (SELECT d.day AS day, d.active AS active_sensors, total AS total_sensors,
              {_pct('d.active', 'total')} AS availability_pct,
              d.slots AS occupied_slots, total * 24 AS expected_slots,
              {_pct('d.slots', 'total * 24')} AS completeness_pct,
              {_round('d.mean', 1)} AS avg_temperature, {_round('d.mean - b.mean', 1)} AS change,
              {_round('d.lo', 1)} AS min_temperature, {_round('d.hi', 1)} AS max_temperature,
              d.rows AS rows, coalesce(anomalies, 0) AS anomalies,
              {_pct('d.rows - coalesce(anomalies, 0)', 'd.rows')} AS accuracy_pct
            FROM d CROSS JOIN n LEFT JOIN f ON f.day = d.day
            LEFT JOIN d b ON b.day + INTERVAL 1 DAY = d.day),
      u AS (SELECT *, CASE WHEN availability_pct >= 99 AND completeness_pct >= 95 THEN 'GOOD'
                      ELSE 'DEGRADED' END AS health FROM t)"""


_LINES = """l AS (
      SELECT CAST(conv_id AS VARCHAR) AS session_id, turn + 1 AS line_no, role,
             (1430 + turn * 3 + conv_id % 7) % 1440 AS minute, turn, conv_id,
             replace(replace(text, chr(13), ' '), chr(10), ' ') || ' load ' || turn || '.5% in '
               || conv_id || 'ms after ' || turn || '秒' AS text
      FROM conversations),
    k AS (SELECT *, lpad(CAST(minute // 60 AS VARCHAR), 2, '0') || ':'
                 || lpad(CAST(minute % 60 AS VARCHAR), 2, '0') AS hhmm FROM l)"""


def _sensors(base: str) -> str:
    return f"""WITH {base}, c AS (
        SELECT {_DAY} AS day, device_id, arg_max(humidity, event_time) AS latitude,
               arg_max(pressure, event_time) AS longitude, {_avgs(1)},
               {_round('avg(battery)', 0)} AS avg_battery, min(temperature) AS min_temperature,
               max(temperature) AS max_temperature,
               {_round('max(temperature) - min(temperature)', 1)} AS spread
        FROM r GROUP BY 1, 2)
      SELECT *, CASE WHEN spread >= 9 THEN 'WATCH' ELSE 'OK' END AS status FROM c"""


def _alerts(base: str) -> str:
    return f"""WITH {base}, c AS (
        SELECT {_DAY} AS day, device_id, min(temperature) AS low,
               {_round('max(temperature) - min(temperature)', 1)} AS spread FROM r GROUP BY 1, 2),
      m AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY low, device_id) AS rn FROM c)
      SELECT day, device_id, 'WIDE_SPREAD' AS alert, spread AS value FROM c WHERE spread >= 100
      UNION ALL
      SELECT day, device_id, 'LOWEST', {_round('low', 1)} FROM m WHERE rn = 1"""


def _complete_by_device(base: str) -> str:
    return f"""WITH {base}, c AS (
        SELECT {_DAY} AS day, device_id, count(DISTINCT {_HOUR_SLOT}) AS occupied_slots,
               CAST(24 AS BIGINT) AS expected_slots FROM r GROUP BY 1, 2)
      SELECT *, {_pct('occupied_slots', 'expected_slots')} AS completeness_pct FROM c"""


def _days_of(sql: str, start: str = DAY, end: str = DAY) -> str:
    return f"SELECT * FROM ({sql}) WHERE day BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"


def oracle_sql() -> dict[str, str]:
    summary = "SELECT * EXCLUDE (rows, occupied_slots, expected_slots) FROM u"
    hourly_cells = f"""{_R}, c AS (SELECT device_id, {_HOUR_SLOT} AS t, avg(temperature) AS v
      FROM r GROUP BY 1, 2)"""
    daily_cells = f"""{_U}, c AS (SELECT device_id, {_DAY} AS t, avg(temperature) AS v
      FROM r GROUP BY 1, 2)"""
    shared_cells = f"""{_R}, c AS (SELECT device_id, {_HOUR_SLOT} AS t, temperature AS v FROM r)"""
    clock = "(1430 + turn * 3 + conv_id % 7)"  # minutes without the wrap at midnight
    session = "OVER (PARTITION BY session_id)"
    return {
        "dataset_overview": f"""WITH {_R} SELECT count(*) AS total_records,
          count(DISTINCT device_id) AS device_count, min(event_time) AS earliest_timestamp,
          max(event_time) AS latest_timestamp FROM r""",
        "device_stats": _device_stats(_R),
        "user_stats": _device_stats(_U),
        "hourly_avg_temperature": f"""WITH {_R} SELECT {_HOUR_SLOT} AS hour,
          {_round('avg(temperature)', 2)} AS avg_temperature, count(*) AS record_count
          FROM r GROUP BY 1""",
        "daily_temperature_range": f"""WITH {_R} SELECT {_DAY} AS day,
          {_round('min(temperature)', 2)} AS min_temperature,
          {_round('max(temperature)', 2)} AS max_temperature,
          {_round('avg(temperature)', 2)} AS avg_temperature FROM r GROUP BY 1""",
        "hourly_fleet_avg": f"WITH {_R} SELECT {_HOUR_SLOT} AS time_hour, {_avgs()} FROM r GROUP BY 1",
        "daily_device_avg": f"""WITH {_R} SELECT device_id, {_DAY} AS day, {_avgs()},
          {_round('avg(battery)', 0)} AS avg_battery FROM r GROUP BY 1, 2""",
        "hour_of_day_profile": f"""WITH {_R} SELECT device_id,
          CAST(extract(hour FROM event_time) AS BIGINT) AS hour_of_day,
          {_round('avg(temperature)', 2)} AS avg_temperature, count(*) AS record_count
          FROM r GROUP BY 1, 2""",
        "active_devices": f"""WITH {_U} SELECT DISTINCT device_id FROM r
          WHERE CAST(event_time AS DATE) = DATE '{DAY}'""",
        "sensor_averages_tz": f"""WITH {_R}, a AS (
            SELECT device_id, min(event_time) AS first_utc, max(event_time) AS last_utc, {_avgs()}
            FROM r GROUP BY 1)
          SELECT *, first_utc AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo' AS first_jst,
                 last_utc AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo' AS last_jst FROM a""",
        "sigma_anomalies": _sigma(_R),
        "sigma_labels": _sigma(_R, only=False),
        "user_sigma_anomalies": _sigma(_U),
        "user_sigma_anomalies_many_keys": _sigma(_U),
        "low_battery": f"""WITH {_R} SELECT device_id, event_time AS timestamp, battery,
          humidity AS latitude, pressure AS longitude FROM r WHERE battery <= 20""",
        "spikes": _spikes(_R, 50),
        "user_spikes": _spikes(_U, 50),
        "time_gaps": _gaps(_R, 15),
        "user_time_gaps": _gaps(_U, 1440),
        "latest_status": _latest(_R),
        "user_latest_status": _latest(_U),
        "user_latest_status_ranked": _latest(_U),
        "latest_status_missing_times": f"""WITH {_U}, u AS (
            SELECT *, CASE WHEN CAST(device_id AS BIGINT) % 7 <> 0 AND battery % 3 <> 0 THEN event_time
                      END AS t FROM r),
          w AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY t DESC NULLS LAST) AS rn FROM u)
          SELECT device_id, t AS last_update, CASE WHEN t IS NOT NULL THEN temperature END AS temperature,
                 temperature IS NOT NULL AS has_value FROM w WHERE rn = 1""",
        "moving_average": _moving("ROWS BETWEEN 11 PRECEDING AND CURRENT ROW"),
        "moving_average_range": _moving("RANGE BETWEEN INTERVAL 11 HOUR PRECEDING AND CURRENT ROW"),
        "device_correlation": _correlation(hourly_cells, 100),
        "device_correlation_shared_times": _correlation(shared_cells, 100),
        "device_correlation_level": _correlation(hourly_cells, 100),
        "device_correlation_some": f"""SELECT * FROM ({_correlation(hourly_cells, 100)})
          WHERE device_a IN ('error', 'login') OR device_b IN ('error', 'login')""",
        "user_correlation": _correlation(daily_cells, 10),
        "jsonl_roundtrip": _stored(),
        "jsonl_date_range": _stored(
            f"WHERE CAST(event_time AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'",
            zone="Asia/Tokyo",
        ),
        "jsonl_partition_day": f"""WITH {_R} SELECT DISTINCT device_id FROM r
          WHERE CAST(event_time AS DATE) = DATE '{DAY}'""",
        "jsonl_replace_days": _stored(
            battery=f"CASE WHEN CAST(event_time AS DATE) = DATE '{DAY}' THEN 100 ELSE battery END"
        ),
        "jsonl_replace_in_place": _stored(
            battery=f"CASE WHEN CAST(event_time AS DATE) = DATE '{DAY}' THEN 100 ELSE battery END"
        ),
        "jsonl_replace_all": _stored(f"WHERE event_time < TIMESTAMP '{DAY}'"),
        "jsonl_odd_times": """SELECT CAST(event_id AS VARCHAR) AS device_id, CASE event_id % 8
            WHEN 0 THEN ts WHEN 1 THEN ts WHEN 5 THEN ts - INTERVAL 9 HOUR
            WHEN 6 THEN date_trunc('minute', ts) + INTERVAL 210 MINUTE END AS event_time FROM events""",
        "jsonl_rejects": """SELECT '{"device_id":"' || event_id || '","temperature":' || value AS line,
          strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
          FROM events WHERE event_type = 'error'""",
        "jsonl_plain": f"""WITH {_R} SELECT device_id, event_time, temperature, humidity,
          pressure, humidity AS lat, pressure AS lon, battery FROM r""",
        "csv_result": f"""WITH {_R} SELECT device_id, event_time,
          temperature, humidity, pressure, humidity AS location_lat, pressure AS location_lon, battery
          FROM r""",
        "registered_view": f"""WITH {_R} SELECT device_id, count(*) AS record_count,
          min(battery) AS min_battery, max(humidity) AS max_lat FROM r
          WHERE event_time >= TIMESTAMP '2024-01-08' AND event_time < TIMESTAMP '2024-02-01'
          GROUP BY device_id""",
        "missing_slots": _missing(_R, 60),
        "user_missing_slots": _missing(_U, 60),
        "loss_summary": _loss(_R, 60),
        "user_loss_summary": _loss(_U, 5),
        "daily_record_counts": _daily_counts(),
        "daily_record_counts_tokyo": _daily_counts("Asia/Tokyo"),
        "time_ordered": f"WITH {_R} SELECT *, humidity AS lat, pressure AS lon FROM r",
        "report_active": f"""{_report(_U)} SELECT day, active_sensors, total_sensors,
          availability_pct FROM u""",
        "report_completeness": f"""{_report(_R)} SELECT day, CAST(occupied_slots AS BIGINT)
          AS occupied_slots, expected_slots, completeness_pct FROM u""",
        "report_completeness_by_device": _complete_by_device(_R),
        "report_day_change": f"{_report(_R)} SELECT day, avg_temperature, change FROM u",
        "report_day_range": f"{_report(_R)} SELECT day, min_temperature, max_temperature FROM u",
        "report_anomalies": f"{_report(_R)} SELECT day, rows, anomalies, accuracy_pct FROM u",
        "report_sensors": _sensors(_R),
        "report_alerts": _alerts(_U),
        "report_health": f"{_report(_R)} SELECT day, availability_pct, completeness_pct, health FROM u",
        "report_summary": f"{_report(_R)} {summary}",
        "report_one_day_range": _days_of(f"{_report(_R)} SELECT day, min_temperature, max_temperature FROM u"),
        "report_days_sensors": _days_of(_sensors(_R), *RANGE),
        "report_days_alerts": _days_of(_alerts(_U), *RANGE),
        "day_active": _days_of(f"{_report(_U)} SELECT day, active_sensors, total_sensors, availability_pct FROM u"),
        "day_completeness": _days_of(f"""{_report(_U)} SELECT day, CAST(occupied_slots AS BIGINT) AS occupied_slots,
          expected_slots, completeness_pct FROM u"""),
        "day_completeness_by_device": _days_of(_complete_by_device(_U)),
        "day_change": _days_of(f"{_report(_U)} SELECT day, avg_temperature, change FROM u"),
        "day_range": _days_of(f"{_report(_U)} SELECT day, min_temperature, max_temperature FROM u"),
        "day_anomalies": _days_of(f"{_report(_U)} SELECT day, rows, anomalies, accuracy_pct FROM u"),
        "day_sensors": _days_of(_sensors(_U)),
        "day_alerts": _days_of(_alerts(_U)),
        "day_health": _days_of(f"{_report(_U)} SELECT day, availability_pct, completeness_pct, health FROM u"),
        "day_summary": _days_of(f"{_report(_U)} {summary}"),
        "days_summary": _days_of(f"{_report(_U)} {summary}", "2024-01-13", "2024-01-17"),
        "sigma_anomalies_states": _sigma(_U),
        "latest_status_states": _latest(_U),
        "transcript_files": f"""WITH {_LINES}
          SELECT session_id, line_no, hhmm, role AS speaker, text FROM k""",
        "transcript_lines": f"""WITH {_LINES}
          SELECT session_id, line_no, hhmm, role AS speaker, text FROM k""",
        "transcript_timeline": f"""WITH {_LINES}, c AS (SELECT *, {clock} AS clock FROM k)
          SELECT session_id, line_no,
                 row_number() OVER (PARTITION BY session_id ORDER BY line_no) AS entry_no,
                 hhmm, role AS speaker, clock - min(clock) {session} AS minutes_since_first,
                 clock - lag(clock) OVER (PARTITION BY session_id ORDER BY line_no)
                   AS minutes_since_prev,
                 max(clock) {session} - min(clock) {session} AS total_minutes FROM c""",
        "transcript_metrics": f"""WITH {_LINES}, h AS (
            SELECT session_id, line_no, hhmm, role AS speaker, unnest(regexp_extract_all(text,
                     '([0-9]+(?:\\.[0-9]+)?) ?(%|ms|秒)', 0)) AS hit,
                   generate_subscripts(regexp_extract_all(text,
                     '([0-9]+(?:\\.[0-9]+)?) ?(%|ms|秒)', 0), 1) AS mention_no FROM k)
          SELECT session_id, line_no, hhmm, speaker, mention_no,
                 CAST(regexp_extract(hit, '[0-9.]+') AS DOUBLE) AS value,
                 CASE regexp_extract(hit, '(%|ms|秒)') WHEN '%' THEN 'percent'
                   WHEN 'ms' THEN 'milliseconds' ELSE 'seconds' END AS unit FROM h""",
    } | (llm.SQL if llm else {})
