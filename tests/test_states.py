"""Stored states: kept up to date by day, equal to the full computation, and few folders opened."""

import random

import pytest
from pyspark.sql import functions as F
from test_files import line, put

from tidegauge.operators import anomaly, daily, report, states as st, trends
from tidegauge.sinks import files
from tidegauge.sources import commits, readings as source

COLUMNS = "device_id string, event_time timestamp_ntz, temperature double, battery int"


def make(spark, rows):
    return spark.createDataFrame(rows, "device_id string, time string, temperature double, battery int").select(
        "device_id", F.col("time").cast("timestamp_ntz").alias("event_time"), "temperature",
        (F.col("temperature") * 2).alias("humidity"), (F.col("temperature") + 1000).alias("pressure"),
        F.struct(F.col("temperature").alias("lat"), F.lit(139.0).alias("lon")).alias("location"), "battery",
    )


def some_rows():
    """Eight days of a few devices: some fall silent, some have no time, no value or no name."""
    rng, rows = random.Random(6), []
    for day in range(1, 9):
        for device in "abcdef":
            if (device == "c" and day > 3) or (device == "d" and day % 2) or (device == "f" and day != 5):
                continue
            for _ in range(rng.randrange(5, 20)):
                time = f"2024-03-{day:02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}.{rng.randrange(10**6):06d}"
                value = rng.choice([None, round(rng.gauss(20, 3), 3)]) if rng.random() < 0.1 else round(rng.gauss(20, 3), 3)
                rows.append((device, time, value, rng.randrange(100)))
    rows.append(("a", "2024-03-06 12:00:00", 90.0, 1))  # the only far outlier, on one day
    rows += [("z", None, 1.0, 2), ("a", None, 19.0, 3), (None, "2024-03-02 03:00:00", 20.0, 4), (None, None, 20.0, 5)]
    return rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A writer in Tokyo, so that folders hold parts of two UTC days."""
    root = tmp_path_factory.mktemp("stored")
    readings, states = str(root / "readings"), str(root / "states")
    df = make(spark, some_rows())
    files.publish_readings(df, readings, "Asia/Tokyo")
    st.update_states(spark, readings, states, interval=60)
    return df, readings, states


def same(a, b):
    def plain(df):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)

    assert a.columns == b.columns
    assert plain(a) == plain(b)


def opened(df, under="/"):
    """Days of the folders below a root whose files a plan reads."""
    keys = [[p.split("=")[1] for p in f.split("/") if p.split("=")[0] in ("year", "month", "day")] for f in df.inputFiles() if under in f]
    return sorted({"-".join(k) for k in keys})


def test_every_table_equals_the_full_computation(spark, stored):
    df, readings, states = stored
    for start, end in (("2024-03-05", "2024-03-07"), ("2024-02-28", "2024-04-01")):
        made = daily.DailyReport(spark, readings, states, start, end)
        within = lambda t: t.filter(F.col("day").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
        same(made.active(), within(report.report_active(df)))
        same(made.completeness(), within(report.report_completeness(df, 60)))
        same(made.completeness(by_device=True), within(report.report_completeness(df, 60, by_device=True)))
        same(made.day_change(), within(report.report_day_change(df)))
        same(made.day_range(), within(report.report_day_range(df)))
        same(made.anomalies(k=1.5), within(report.report_anomalies(df, k=1.5)))
        same(made.sensors(), within(report.report_sensors(df)))
        same(made.alerts(), within(report.report_alerts(df)))
        same(made.health(), within(report.report_health(df, interval=60)))
        same(made.summary(), within(report.report_summary(df, interval=60)))
        same(report.report_day_range(df, start=start, end=end), within(report.report_day_range(df)))
        same(report.report_sensors(df, start=start, end=end), within(report.report_sensors(df)))
        same(report.report_alerts(df, start=start, end=end), within(report.report_alerts(df)))


def test_one_day_opens_its_own_folders_alone(spark, stored):
    _, readings, states = stored
    made = daily.DailyReport(spark, readings, states, "2024-03-05")
    near = ["2024-03-04", "2024-03-05", "2024-03-06"]
    assert set(opened(made.sensors())) <= set(near)
    assert set(opened(made.alerts())) <= set(near) and set(opened(made.day_range())) <= set(near)
    assert set(opened(made.completeness(by_device=True))) <= set(near)
    assert set(opened(made.day_change())) <= {"2024-03-03", *near}  # the day before, and the folders around both
    assert set(opened(made.summary(), readings)) <= set(near)
    assert daily.DailyReport(spark, readings, states, "2024-02-20").summary().count() == 0


def test_only_new_and_changed_folders_are_read(spark, tmp_path, monkeypatch):
    readings, states = str(tmp_path / "readings"), str(tmp_path / "states")
    df, asked, scan = make(spark, some_rows()), [], st.scan_readings
    monkeypatch.setattr(st, "scan_readings", lambda s, r, m, days: asked.append(days) or scan(s, r, m, days))
    early, late = df.filter("event_time < '2024-03-04'"), df.filter("event_time >= '2024-03-04' OR event_time IS NULL")
    files.publish_readings(early, readings)
    assert st.update_states(spark, readings, states, interval=60) == [f"2024-03-{d:02d}" for d in (1, 2, 3)]
    assert st.update_states(spark, readings, states, interval=60) == []
    files.publish_readings(late, readings, replace="none")
    assert st.update_states(spark, readings, states, interval=60) == [*(f"2024-03-{d:02d}" for d in range(4, 9)), commits.NO_DAY]
    fixed = df.filter("to_date(event_time) = '2024-03-06'").withColumn("temperature", F.lit(1.0))
    files.publish_readings(fixed, readings)
    assert st.update_states(spark, readings, states, interval=60) == ["2024-03-06"]
    assert len(asked) == 3
    now = source.scan_readings(spark, readings)
    same(daily.DailyReport(spark, readings, states, "2024-03-01", "2024-03-09").summary(), report.report_summary(now, interval=60))
    files.publish_readings(early, readings, replace="all")  # days disappear
    assert st.update_states(spark, readings, states, interval=60) == [f"2024-03-{d:02d}" for d in (1, 2, 3)]
    same(daily.DailyReport(spark, readings, states, "2024-03-01", "2024-03-09").summary(), report.report_summary(early, interval=60))
    files.publish_readings(early.limit(0), readings, replace="all")
    assert st.update_states(spark, readings, states, interval=60) == []
    assert daily.DailyReport(spark, readings, states, "2024-03-01", "2024-03-09").summary().count() == 0
    with pytest.raises(ValueError, match="kept with"):
        st.update_states(spark, readings, states, interval=30)
    with pytest.raises(ValueError, match="no states"):
        daily.DailyReport(spark, readings, str(tmp_path / "none"), "2024-03-01")


def test_states_of_a_table_of_plain_folders(spark, tmp_path):
    readings, states = str(tmp_path / "readings"), str(tmp_path / "states")
    put(readings, "2024-01-08", line("a", "2024-01-08T00:00:00.000Z", 1.0), line("a", "no time", 2.0))
    put(readings, "2024-01-09", line("a", "2024-01-08T15:30:00.000Z", 3.0), line("b", "2024-01-09T01:00:00.000Z", 4.0))
    assert st.update_states(spark, readings, states) == ["2024-01-08", "2024-01-09"]
    put(readings, "2024-01-09", line("b", "2024-01-09T01:05:00.000Z", 5.0))
    assert st.update_states(spark, readings, states) == ["2024-01-09"]
    df = source.scan_readings(spark, readings)
    same(daily.DailyReport(spark, readings, states, "2024-01-08", "2024-01-09").summary(), report.report_summary(df))
    same(daily.latest_status_of(spark, readings, states), trends.latest_status(df))


def test_sigma_anomalies_skip_the_days_within_bounds(spark, stored):
    df, readings, states = stored
    for k in (1.0, 2.0, 3.0, 100.0):
        found = daily.sigma_anomalies_of(spark, readings, states, k=k)
        same(found, anomaly.sigma_anomalies(df, k=k))
        if k == 3.0:
            assert [r.temperature for r in found.collect()] == [90.0]
            assert opened(found, readings) == ["2024-03-06"]
        if k == 100.0:
            assert opened(found, readings) == []


def test_latest_status_opens_the_last_folders_alone(spark, stored):
    df, readings, states = stored
    found = daily.latest_status_of(spark, readings, states)
    known = "last_update IS NOT NULL AND device_id IS NOT NULL"
    same(found.filter(known), trends.latest_status(df).filter(known))
    rest = lambda t: sorted((str(r.device_id), r.last_update) for r in t.filter(f"NOT ({known})").collect())
    assert rest(found) == rest(trends.latest_status(df))
    # a, b and e end on the last days, c on the third, f on the fifth; z has no time
    assert len(opened(found, readings)) <= 7
    assert "2024-03-01" not in opened(found, readings)


def test_deviations_keep_their_digits_far_from_zero(spark, tmp_path):
    rng = random.Random(9)
    rows = [("a", f"2024-03-{d:02d} 01:{m:02d}:00", 1e9 + rng.random(), 5) for d in range(1, 6) for m in range(60)]
    df, readings, states = make(spark, rows), str(tmp_path / "readings"), str(tmp_path / "states")
    files.publish_readings(df, readings)
    st.update_states(spark, readings, states)
    got = st.States(spark, states).devices().first()
    want = df.agg(F.avg("temperature").alias("a"), F.stddev_samp("temperature").alias("s")).first()
    assert abs(got.avg - want.a) < 1e-6 and abs(got.sd / want.s - 1) < 1e-7


def test_a_range_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_type").alias("device_id"), F.col("ts").alias("event_time"), F.col("value").alias("temperature"),
        F.col("value").alias("humidity"), F.col("value").alias("pressure"), F.lit(1).alias("battery"),
        F.struct(F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon")).alias("location"),
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    for table in (report.report_day_range, report.report_sensors, report.report_alerts):
        plan = table(df, start="2024-01-15", end="2024-01-15")._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters") :]
        assert "GreaterThanOrEqual(ts,2024-01-15" in pushed and "LessThan(ts,2024-01-16" in pushed
    spark.conf.unset("spark.sql.maxMetadataStringLength")
