"""Plan shapes: exactness under any cut, and what the physical plans contain."""

import random
import re

import __spark_entry__ as registered
import pytest
from pyspark.sql import Window as W, functions as F

from tidegauge.functions.time import format_iso, parse_iso, slot_of_day
from tidegauge.operators import anomaly, quality, stats, trends
from tidegauge.plans.neighbours import where_neighbours
from tidegauge.plans.slots import mask_aggregates, missing, occupied, slots_per_day

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_neighbours_equal_a_plain_window(spark, width):
    rng = random.Random(width)
    data = [
        (rng.choice("aab"), i * rng.choice([1, 1, 40]), rng.choice([None, 1.0, 2.0, 3.0]))
        for i in range(600)
    ]
    df = spark.createDataFrame(list(set(data)), "k string, t long, v double")
    w = W.partitionBy("k").orderBy("t", "v")
    plain = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"))
    chunk = F.floor(F.col("t") / width)
    for wanted in (F.lit(True), (F.col("v") > F.col("prev_v")) & (F.col("v") >= F.col("next_v"))):
        chunked = where_neighbours(df, ["k"], chunk, ["t", "v"], ["v"], wanted)
        assert sorted(map(str, chunked.collect())) == sorted(map(str, plain.filter(wanted).collect()))


def test_neighbours_sort_all_rows_once(spark):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.col("id").alias("t"))
    chunk = F.floor(F.col("t") / 10)
    out = where_neighbours(df, ["k"], chunk, ["t"], ["t"], F.col("next_t") - F.col("prev_t") > 2)
    assert out.count() == 0
    plan = plan_of(out)
    assert "Union" not in plan and plan.count("+- Range") == 1


@pytest.mark.parametrize("interval", [1, 5, 30, 1440])
def test_slot_masks_count_distinct_slots(spark, readings, interval):
    rng = random.Random(interval)
    minutes = [rng.randrange(1440) for _ in range(300)] + [0, 1439]
    df = readings([("a", f"2024-01-01T{m // 60:02d}:{m % 60:02d}:30.000Z", 1.0) for m in minutes])
    got = df.agg(*mask_aggregates("event_time", interval)).select(
        occupied(interval), F.size(missing(interval))
    ).first()
    exact = df.select(slot_of_day("event_time", interval)).distinct().count()
    assert tuple(got) == (exact, slots_per_day(interval) - exact)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    texts = ["2024-03-10T02:30:00.250Z", "2024-03-10T07:05:00.000Z", "2024-11-03T05:30:00.000Z",
             "2024-11-03T06:30:00.000Z", "2024-03-31T09:00:00.000+09:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([("a", t, 1.0) for t in texts],
                                   "device_id string, timestamp string, temperature double")
        df = df.withColumn("event_time", parse_iso("timestamp"))
        hours = [str(r[0]) for r in stats.bucket_avg(df, "hour").collect()]
        gaps = [r[0] for r in anomaly.time_gaps(df).select("gap_minutes").collect()]
        back = {r[0] for r in df.select(format_iso("event_time")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert hours == ["2024-03-10 02:00:00", "2024-03-10 07:00:00", "2024-03-31 00:00:00",
                     "2024-11-03 05:00:00", "2024-11-03 06:00:00"]
    assert [round(g, 6) for g in gaps] == [312810.0, 29815.0, 274.995833, 60.0]
    assert back == set(texts[:4]) | {"2024-03-31T00:00:00.000Z"}


def test_a_sort_splits_copies(spark, readings):
    one = readings([("a", "2024-01-01T00:00:00.000Z", 1.0, 5)])
    copies = one.crossJoin(spark.range(0, 20_000, 1, 8)).drop("id")
    for df in (quality.time_ordered(copies), anomaly.low_battery(copies)):
        assert df.count() == 20_000
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r[0] for r in df.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert len(sizes) == 8 and max(sizes) < 10_000
    assert quality.time_ordered(copies).columns == copies.columns


def test_results_do_not_depend_on_shuffle_partitions(spark):
    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        queries = registered.queries()
        return {
            name: sorted(map(str, queries[name](spark, SF).collect()))
            for name in ("spikes", "user_time_gaps", "moving_average", "transcript_timeline")
        }

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert run("3") == run("17")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scans_read_only_what_a_query_needs(spark):
    plan = plan_of(stats.hour_of_day_profile(registered._readings(spark, SF)))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_latest_status_is_a_hash_aggregation(spark):
    plan = plan_of(trends.latest_status(registered._readings(spark, SF)))
    assert "HashAggregate" in plan and "Sort" not in plan and "Window" not in plan
    ranked = plan_of(trends.latest_status(registered._readings(spark, SF), tie_break=["battery"]))
    assert "WindowGroupLimit" in ranked


def test_only_correlation_uses_python(spark):
    for name, query in registered.queries().items():
        if "correlation" not in name and not re.match(r"pipeline$|op\d+_", name):
            plan = plan_of(query(spark, SF))
            assert "Python" not in plan and "Pandas" not in plan, name
            assert "CartesianProduct" not in plan, name
