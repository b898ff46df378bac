"""Readings at odd times, levels and values."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.functions.numeric import round_half_up
from tidegauge.functions.time import format_iso, parse_iso
from tidegauge.operators import anomaly, correlation, report, trends
from tidegauge.plans import sized_join
from tidegauge.session import Scratch, scratch_path, shared_root
from tidegauge.sinks.files import write_partitioned_jsonl
from tidegauge.sources.readings import scan_date_range

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_iso_text_means_the_same_in_any_session_zone(spark, zone):
    texts = {
        "2024-01-01T00:00:00": START, "2024-01-01 00:00:00Z": START, "2024-01-01T09:00:00+09:00": START,
        "2024-01-01T09:00+0900": START, "2023-12-31T21:30:00.000-02:30": START, "2024-01-01T00:00:00.123456789Z":
        START.replace(microsecond=123456), "12:30": None, "T12:30": None, "2024": None, "2024-05": None, "2024-05-01": None,
        "2024-13-01T00:00:00Z": None, " 2024-01-01T00:00:00Z": None, "now": None, "": None, None: None,
    }
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        assert [r[0] for r in df.select(parse_iso("t")).collect()] == list(texts.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stored_text_keeps_all_digits(spark):
    times = [START, START.replace(microsecond=120_000), START.replace(microsecond=123_450), START.replace(microsecond=7)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").select("t", format_iso("t").alias("x"))
    assert [r["x"][19:] for r in df.collect()] == [".000Z", ".120Z", ".12345Z", ".000007Z"]
    assert all(r[0] == r[1] for r in df.select("t", parse_iso("x")).collect())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_a_date_range_has_no_bounds_of_its_own(spark, zone):
    stamps = ["2019-06-01T00:00:00Z", "2020-01-01T03:00:00Z", "2030-12-31T23:59:00Z", "2031-05-05T12:00:00Z"]
    df = spark.createDataFrame([("a", s, 1.0, 1.0, 1.0, 5) for s in stamps],
                               "device_id string, timestamp string, temperature double, humidity double, pressure double, battery int")
    df = df.withColumns({"event_time": parse_iso("timestamp"), "location": F.struct(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))})
    root = scratch_path(spark, "years")
    write_partitioned_jsonl(df, root, zone)
    for start, end, n in (("2019-01-01", "2032-12-31", 4), ("2020-01-01", "2020-01-01", 1), ("2030-12-31", "2031-05-05", 2),
                          ("0001-01-01", "9999-12-31", 4), ("2021-01-01", "2022-01-01", 0)):
        assert scan_date_range(spark, root, start, end).count() == n


def test_large_values_round_as_doubles(spark):
    df = spark.createDataFrame([(9e25,), (1e26,), (-3e300,), (float("inf"),), (float("nan"),), (2.345,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got == [9e25, 1e26, -3e300, float("inf"), None, 2.35]


@pytest.mark.parametrize("rows", [50, 200_000])
@pytest.mark.parametrize("level", [0.0, 1e6, 1e8, 1e10])
def test_correlation_at_any_level(spark, level, rows):
    rng = np.random.default_rng(5)
    common = rng.normal(size=200)
    series = {f"d{i}": common * (0.5 + i / 3) + rng.normal(size=200) + level * (1 + i) for i in range(4)}
    flat = [(d, START + dt.timedelta(minutes=t), float(v)) for d, vs in series.items() for t, v in enumerate(vs)]
    df = spark.createDataFrame(flat, "device_id string, event_time timestamp_ntz, temperature double")
    out = correlation.device_correlation(df, min_samples=10, block_rows=rows).collect()
    assert len(out) == 6
    for r in out:
        want = np.corrcoef(series[r["device_a"]] - level, series[r["device_b"]] - level)[0, 1]
        assert abs(r["temperature_correlation"] - want) < 0.0011


def test_an_infinite_reading_only_spoils_its_own_pairs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=120)
    series = {"a": x, "b": x + rng.normal(size=120) / 9, "c": np.where(np.arange(120) == 7, np.inf, x)}
    flat = [(d, START + dt.timedelta(minutes=t), float(v)) for d, vs in series.items() for t, v in enumerate(vs)]
    flat += [("d", START + dt.timedelta(minutes=t), float(x[t])) for t in range(8, 120)]  # shares no infinite time
    df = spark.createDataFrame(flat, "device_id string, event_time timestamp_ntz, temperature double")
    out = {(r[0], r[1]): r[2] for r in correlation.device_correlation(df, min_samples=10).collect()}
    assert out["a", "b"] > 0.98 and out["a", "c"] is None and out["b", "c"] is None
    assert out["c", "d"] == out["a", "d"] == 1.0


def test_correlation_of_some_devices_with_all(spark):
    rng = random.Random(1)
    flat = [(f"d{i:02d}", START + dt.timedelta(minutes=t), rng.random()) for i in range(30) for t in range(20)]
    df = spark.createDataFrame(flat, "device_id string, event_time timestamp_ntz, temperature double")
    every = correlation.device_correlation(df, min_samples=5, block_devices=4).collect()
    some = correlation.device_correlation(df, min_samples=5, block_devices=4, devices=["d03", "d17", "none"]).collect()
    assert {tuple(r) for r in some} == {tuple(r) for r in every if {"d03", "d17"} & {r[0], r[1]}} and len(some) == 57


def test_a_device_without_times_keeps_a_reading(readings):
    df = readings([("a", "not a time", 5.0), ("b", "not a time", 1.0), ("b", "2024-01-01T00:00:00Z", 2.0)])
    for tie in ((), ("temperature",)):
        got = sorted(tuple(r)[:3] for r in trends.latest_status(df, tie_break=tie).select("device_id", "last_update", "temperature").collect())
        assert got == [("a", None, 5.0), ("b", START, 2.0)]


def test_nan_is_no_spike(readings):
    df = readings([("a", f"2024-01-01T00:0{i}:00Z", v) for i, v in enumerate([1.0, float("nan"), 1.0, 1.0, 50.0, 1.0])])
    assert [r["temperature"] for r in anomaly.spikes(df).collect()] == [50.0]


def test_gaps_of_a_dense_history_are_linked_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "BINS_PER_CHUNK", 3)
    rng = random.Random(4)
    times = sorted({START + dt.timedelta(seconds=rng.randrange(4000)) for _ in range(900)})
    df = spark.createDataFrame([("a", t) for t in times], "device_id string, event_time timestamp_ntz")
    got = {(r["prev_timestamp"], r["timestamp"]) for r in anomaly.time_gaps(df, minutes=0.1).collect()}
    assert got == {(a, b) for a, b in zip(times, times[1:]) if (b - a).total_seconds() > 6}


def test_long_names_count_against_the_broadcast(spark):
    names = [("x" * 5000 + str(i), float(v)) for i in range(20) for v in range(5)] + [("hot", float(v % 7)) for v in range(400)]
    rows = spark.createDataFrame(names, "device_id string, temperature double")
    summary = rows.groupBy("device_id").agg(F.count("*").alias("n"), F.avg("temperature").alias("mean"))
    for limit in (10, 100, 10_000):
        out = sized_join.join_key_summary(rows, summary, "device_id", "n", broadcast_rows=limit)
        assert sorted(map(tuple, out.select("device_id", "temperature", "mean").collect())) == sorted(
            map(tuple, rows.join(summary, "device_id").select("device_id", "temperature", "mean").collect()))


def test_report_tables_agree_when_devices_or_times_are_missing(readings):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, f"2024-01-0{rng.randrange(1, 6)}T0{rng.randrange(9)}:00:00Z"]),
             rng.choice([None, float(rng.randrange(40))])) for _ in range(300)]
    df = readings([(d, t or "no time", v) for d, t, v in rows])
    whole = {r["day"]: r.asDict() for r in report.report_summary(df, interval=60).collect()}
    parts = [report.report_active(df), report.report_completeness(df, 60), report.report_day_change(df), report.report_day_range(df),
             report.report_anomalies(df), report.report_health(df, interval=60)]
    for part in parts:
        got = {r["day"]: r.asDict() for r in part.collect()}
        assert got.keys() == whole.keys()
        for day, row in got.items():
            assert {k: v for k, v in row.items() if k in whole[day]} == {k: whole[day][k] for k in row if k in whole[day]}
    placed = [(d, t[:10], v) for d, t, v in rows if d and t]
    for day, row in whole.items():
        mine = [v for _, t, v in placed if t == str(day)[:10] and v is not None]
        assert abs(row["avg_temperature"] - sum(mine) / len(mine)) < 0.051 and row["total_sensors"] == 3
        assert (row["min_temperature"], row["max_temperature"]) == (min(mine), max(mine))


def test_scratch_tables_are_removed(spark):
    scratch = Scratch(spark, "gone")
    table = scratch.table(spark.range(5).toDF("x"), "t")
    assert table.count() == 5 and scratch.root.startswith(shared_root(spark))
    path = scratch.path("t").removeprefix("file://")
    import os

    assert os.path.isdir(path)
    scratch.drop("t")
    assert not os.path.exists(path)
