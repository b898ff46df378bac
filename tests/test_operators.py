"""Hand-written edge rows, one behaviour each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import anomaly, quality, report, stats, transcripts, trends


def at(text):
    return dt.datetime.fromisoformat(text)


def stamp(minutes, day="2024-01-01"):
    start = at(f"{day}T00:00:00")
    return (start + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.000Z")


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# -- statistics ---------------------------------------------------------------------------------


def test_overview_counts_rows_without_a_readable_time(readings):
    df = readings([("a", stamp(0), 1.0), ("a", "not a time", 2.0), ("b", stamp(5), None)])
    assert rows(stats.dataset_overview(df), "*") == [
        (3, 2, at("2024-01-01T00:00:00"), at("2024-01-01T00:05:00"))
    ]


def test_offsets_are_honoured(readings):
    df = readings([("a", "2024-01-01T09:00:00+09:00", 1.0), ("a", "2024-01-01T00:30:00.000Z", 2.0)])
    assert rows(stats.bucket_avg(df, "hour", with_count=True), "*") == [
        (at("2024-01-01T00:00:00"), 1.5, 2)
    ]


def test_half_is_rounded_up(readings):
    df = readings([("a", stamp(0), 1.005), ("a", stamp(5), 1.005)])
    assert rows(stats.device_stats(df), "avg_temperature") == [(1.01,)]


def test_nulls_do_not_enter_averages(readings):
    df = readings([("a", stamp(0), None), ("a", stamp(5), 4.0), ("b", stamp(0), None)])
    assert rows(stats.device_stats(df), "device_id", "record_count", "avg_temperature") == [
        ("a", 2, 4.0), ("b", 1, None)
    ]


def test_active_devices_by_partition_keys(spark):
    df = spark.createDataFrame(
        [("b", "2025", "08", "15"), ("a", "2025", "08", "15"), ("c", "2025", "08", "16")],
        "device_id string, year string, month string, day string",
    )
    assert rows(stats.active_devices(df, "2025-08-15"), "*") == [("a",), ("b",)]


def test_second_zone_shows_next_day(readings):
    df = readings([("a", "2024-01-01T15:30:00.000Z", 1.0)])
    assert rows(stats.sensor_averages_tz(df), "first_utc", "first_jst") == [
        (at("2024-01-01T15:30:00"), at("2024-01-02T00:30:00"))
    ]


# -- anomalies ----------------------------------------------------------------------------------


def test_single_reading_and_constant_device_are_never_flagged(readings):
    df = readings([("one", stamp(0), 99.0)] + [("flat", stamp(i), 5.0) for i in range(20)])
    assert anomaly.sigma_anomalies(df).count() == 0
    labels = anomaly.sigma_anomalies(df, only_anomalies=False)
    assert {r[0] for r in rows(labels, "anomaly_type")} == {"NORMAL"}
    assert labels.count() == 21


def test_bounds_are_strict(readings):
    # mean 0 and sample deviation 1: the outer values lie exactly on the bound for k=1.
    values = [1.0, -1.0, 0.0]
    df = readings([("a", stamp(i), v) for i, v in enumerate(values)])
    assert anomaly.sigma_anomalies(df, k=1.0).count() == 0
    assert anomaly.sigma_anomalies(df, k=0.99).count() == 2


def test_low_and_high_labels(readings):
    df = readings(
        [("a", stamp(i), 10.0 + i % 2) for i in range(40)]
        + [("a", stamp(50), 90.0), ("a", stamp(51), -70.0)]
    )
    found = rows(anomaly.sigma_anomalies(df), "temperature", "anomaly_type")
    assert found == [(90.0, "HIGH_ANOMALY"), (-70.0, "LOW_ANOMALY")]


@pytest.mark.parametrize("limit", [1, 2, 500_000])
def test_anomalies_do_not_depend_on_the_broadcast_limit(readings, limit):
    df = readings(
        [("hot", stamp(i), 500.0 if i == 77 else float(i % 7)) for i in range(300)]
        + [(f"d{k}", stamp(i), 50.0 if i == 9 else float(i % 3)) for k in range(4) for i in range(20)]
    )
    found = anomaly.sigma_anomalies(df, broadcast_rows=limit)
    assert sorted(rows(found, "device_id", "temperature")) == [
        ("d0", 50.0), ("d1", 50.0), ("d2", 50.0), ("d3", 50.0), ("hot", 500.0)
    ]


def test_battery_threshold_is_included(readings):
    df = readings([("a", stamp(0), 1.0, 20), ("a", stamp(5), 1.0, 21), ("a", stamp(9), 1.0, 3)])
    assert rows(anomaly.low_battery(df), "battery", "latitude") == [(3, 35.0), (20, 35.0)]


def test_spike_needs_both_sides_and_a_strict_jump(readings):
    series = [20.0, 25.0, 20.0, 25.1, 20.0, 24.0, 40.0, 40.0, 20.0]
    df = readings([("a", stamp(5 * i), v) for i, v in enumerate(series)])
    assert rows(anomaly.spikes(df), "temperature", "prev_temp", "next_temp") == [(25.1, 20.0, 20.0)]


def test_spike_across_empty_hours_and_nulls(readings):
    df = readings(
        [("a", stamp(59), 10.0), ("a", stamp(60), 30.0), ("a", stamp(600), 10.0),
         ("a", stamp(601), None), ("a", stamp(602), 90.0), ("a", stamp(700), 10.0)]
    )
    assert rows(anomaly.spikes(df), "temperature") == [(30.0,)]


def test_copies_are_not_spikes(readings):
    df = readings(
        [("a", stamp(0), 1.0), ("a", stamp(5), 50.0), ("a", stamp(5), 50.0), ("a", stamp(10), 1.0)]
    )
    assert anomaly.spikes(df).count() == 0


def test_gap_of_exactly_the_limit_is_no_gap(readings):
    df = readings(
        [("a", stamp(0), 1.0), ("a", stamp(15), 1.0), ("a", "2024-01-01T00:30:00.001Z", 1.0),
         ("a", stamp(100), 1.0), ("a", stamp(100), 1.0), ("b", stamp(0), 1.0)]
    )
    found = rows(anomaly.time_gaps(df), "device_id", "prev_timestamp", "timestamp")
    assert found == [
        ("a", at("2024-01-01T00:30:00.001"), at("2024-01-01T01:40:00")),
        ("a", at("2024-01-01T00:15:00"), at("2024-01-01T00:30:00.001")),
    ]


@pytest.mark.parametrize("minutes", [0.5, 1, 7, 15, 60])
def test_gaps_equal_a_plain_window(spark, readings, minutes):
    import random

    rng = random.Random(5)
    data, clock = [], 0.0
    for _ in range(400):
        clock += rng.choice([0, 0.25, 0.5, 1, 7, 15, 15.5, 61, 300])
        data.append((rng.choice("abc"), stamp(clock), 1.0))
    df = readings(data)
    from pyspark.sql import Window as W

    w = W.partitionBy("device_id").orderBy("event_time")
    gap = (F.unix_micros(F.col("event_time").cast("timestamp")) - F.unix_micros(
        F.lag("event_time").over(w).cast("timestamp"))) / 6e7
    plain = df.withColumn("gap", gap).filter(F.col("gap") > minutes)
    got = sorted(rows(anomaly.time_gaps(df, minutes), "device_id", "timestamp", "gap_minutes"))
    assert got == sorted(rows(plain, "device_id", "event_time", "gap"))


# -- trends -------------------------------------------------------------------------------------


def test_latest_status_breaks_ties_as_asked(readings):
    df = readings(
        [("a", stamp(0), 1.0), ("a", stamp(5), 3.0), ("a", stamp(5), 2.0), ("b", stamp(1), None)]
    )
    latest = trends.latest_status(df, tie_break=["temperature"])
    assert sorted(rows(latest, "device_id", "temperature")) == [("a", 3.0), ("b", None)]
    assert {r[0] for r in rows(trends.latest_status(df), "device_id")} == {"a", "b"}


def test_moving_average_by_rows_and_by_clock(readings):
    df = readings([("a", stamp(60 * h), v) for h, v in ((0, 10.0), (1, 20.0), (30, 60.0))])
    by_rows = rows(trends.moving_average(df), "moving_avg_12h")
    by_clock = rows(trends.moving_average(df, by="range"), "moving_avg_12h")
    assert by_rows == [(10.0,), (15.0,), (30.0,)]
    assert by_clock == [(10.0,), (15.0,), (60.0,)]


# -- quality ------------------------------------------------------------------------------------


def test_missing_slots_cover_whole_silent_days(readings):
    df = readings(
        [("a", stamp(m), 1.0) for m in range(0, 3 * 1440, 5)]
        + [("b", stamp(3), 1.0), ("b", stamp(2 * 1440 + 1437), 1.0)]
    )
    missing = quality.missing_slots(df, 5)
    assert {r[0] for r in rows(missing, "device_id")} == {"b"}
    assert missing.count() == 3 * 288 - 2
    assert rows(quality.loss_summary(df, 5), "device_id", "expected", "actual", "lost") == [
        ("a", 864, 864, 0), ("b", 864, 2, 862), (None, 1728, 866, 862)
    ]


@pytest.mark.parametrize("interval", [1, 5, 60, 1440])
def test_missing_and_loss_agree(readings, interval):
    df = readings([("a", stamp(m), 1.0) for m in range(7, 3000, 13)] + [("b", stamp(2000), 1.0)])
    lost = dict(rows(quality.loss_summary(df, interval), "device_id", "lost"))
    missing = quality.missing_slots(df, interval).groupBy("device_id").count()
    assert {k: v for k, v in lost.items() if k and v} == dict(rows(missing, "device_id", "count"))


def test_given_bounds_clip_the_grid(readings):
    df = readings([("a", stamp(0), 1.0), ("a", stamp(20), 1.0), ("b", stamp(50), 1.0)])
    bounds = {"start": at("2024-01-01T00:10:00"), "end": at("2024-01-01T00:24:00")}
    assert rows(quality.missing_slots(df, 5, **bounds), "device_id", "slot") == [
        ("a", at("2024-01-01T00:10:00")), ("a", at("2024-01-01T00:15:00")),
        ("b", at("2024-01-01T00:10:00")), ("b", at("2024-01-01T00:15:00")),
        ("b", at("2024-01-01T00:20:00")),
    ]
    assert rows(quality.loss_summary(df, 5, **bounds), "device_id", "expected", "lost") == [
        ("a", 3, 2), ("b", 3, 3), (None, 6, 5)
    ]


def test_uneven_interval_is_refused(readings):
    with pytest.raises(ValueError):
        quality.missing_slots(readings([("a", stamp(0), 1.0)]), 7)


# -- report -------------------------------------------------------------------------------------


def test_change_is_null_after_a_missing_day(readings):
    df = readings(
        [("a", stamp(0, "2024-01-01"), 10.0), ("a", stamp(0, "2024-01-02"), 12.5),
         ("a", stamp(0, "2024-01-04"), 20.0)]
    )
    assert rows(report.report_day_change(df), "avg_temperature", "change") == [
        (10.0, None), (12.5, 2.5), (20.0, None)
    ]


def test_watch_starts_at_the_threshold(readings):
    df = readings(
        [("a", stamp(0), 10.0), ("a", stamp(5), 19.0), ("b", stamp(0), 5.0), ("b", stamp(5), 13.9)]
    )
    assert rows(report.report_sensors(df), "device_id", "spread", "status") == [
        ("a", 9.0, "WATCH"), ("b", 8.9, "OK")
    ]
    assert rows(report.report_alerts(df), "device_id", "alert", "value") == [
        ("b", "LOWEST", 5.0), ("a", "WIDE_SPREAD", 9.0)
    ]


def test_health_needs_both_scores(readings):
    full = [("a", stamp(m), 1.0) for m in range(0, 1440, 5)]
    df = readings(full + [("a", stamp(m, "2024-01-02"), 1.0) for m in range(0, 700, 5)])
    assert rows(report.report_health(df), "availability_pct", "completeness_pct", "health") == [
        (100.0, 100.0, "GOOD"), (100.0, 48.61, "DEGRADED")
    ]


def test_completeness_and_loss_are_complements(readings):
    df = readings([("a", stamp(m), 1.0) for m in range(0, 1440, 5) if m % 35])
    complete = rows(report.report_completeness(df.union(df)), "occupied_slots", "completeness_pct")
    start, end = at("2024-01-01T00:00:00"), at("2024-01-01T23:55:00")
    lost = rows(quality.loss_summary(df, 5, start, end), "actual", "loss_rate")[0]
    assert complete[0][0] == lost[0]
    assert complete[0][1] + lost[1] == pytest.approx(100.0)


def test_summary_agrees_with_its_parts(readings):
    df = readings(
        [(d, stamp(5 * i, day), float(i % 9) + (80 if i == 30 else 0))
         for d in "ab" for day in ("2024-01-01", "2024-01-02") for i in range(100)]
        + [("c", stamp(0, "2024-01-02"), 3.0)]
    )
    summary = report.report_summary(df)
    for part, columns in (
        (report.report_active(df), ["active_sensors", "total_sensors", "availability_pct"]),
        (report.report_completeness(df), ["completeness_pct"]),
        (report.report_day_change(df), ["avg_temperature", "change"]),
        (report.report_day_range(df), ["min_temperature", "max_temperature"]),
        (report.report_anomalies(df), ["anomalies", "accuracy_pct"]),
        (report.report_health(df), ["health"]),
    ):
        assert rows(summary, "day", *columns) == rows(part, "day", *columns)


# -- transcripts --------------------------------------------------------------------------------


@pytest.fixture
def lines(spark):
    def build(texts, session="s"):
        return spark.createDataFrame(
            [(session, i + 1, t) for i, t in enumerate(texts)],
            "session_id string, line_no long, line string",
        )

    return build


def test_lines_of_another_form_are_kept(lines):
    parsed = transcripts.transcript_lines(
        lines(["[09:15] 青木: ディスク: 71%", "", "no bracket", "[09:16] Eva: 了解\r"])
    )
    assert rows(parsed.orderBy("line_no"), "hhmm", "speaker", "text") == [
        ("09:15", "青木", "ディスク: 71%"), (None, None, ""), (None, None, "no bracket"),
        ("09:16", "Eva", "了解"),
    ]


def test_timeline_carries_over_midnight(lines, monkeypatch):
    texts = ["[23:50] a: x", "", "[23:58] b: x", "[00:03] a: x", "[00:03] b: x", "[23:00] a: x",
             "[01:00] a: x"]
    expected = [
        (1, 0, None, 1510), (2, 8, 8, 1510), (3, 13, 5, 1510), (4, 13, 0, 1510),
        (5, 1390, 1377, 1510), (6, 1510, 120, 1510),
    ]
    parsed = transcripts.transcript_lines(lines(texts))
    for size in (10_000, 2, 1):
        monkeypatch.setattr(transcripts, "LINES_PER_CHUNK", size)
        got = transcripts.transcript_timeline(parsed).orderBy("line_no")
        assert rows(
            got, "entry_no", "minutes_since_first", "minutes_since_prev", "total_minutes"
        ) == expected


def test_every_metric_of_a_line_is_listed(lines):
    parsed = transcripts.transcript_lines(
        lines(["[09:15] a: p95 350ms, 平均7秒, disk 71% and 0.4 % errors for 12 min", "[09:16] b: none"])
    )
    assert rows(transcripts.transcript_metrics(parsed), "mention_no", "value", "unit") == [
        (1, 350.0, "milliseconds"), (2, 7.0, "seconds"), (3, 71.0, "percent"), (4, 0.4, "percent")
    ]


# -- adapters -----------------------------------------------------------------------------------


def test_payloads_of_any_form_are_read(spark):
    from tidegauge.adapters import readings_from_events

    payloads = ['{"k": 7}', '{"k":8}', '{"a": 1, "k": 9}', '{"k": -3}', '{"a": 1}', "broken", None]
    events = spark.createDataFrame(
        [(i, 1, "a", 1.0, p) for i, p in enumerate(payloads)],
        "event_id long, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    df = readings_from_events(events)
    assert [r[0] for r in df.select("battery").collect()] == [7, 8, 9, -3, None, None, None]
