"""Scans and writers on real folders."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import quality, transcripts
from tidegauge.sinks import files
from tidegauge.sources import readings as source
from tidegauge.sources.transcripts import scan_transcript_lines


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def put(root, day, *lines):
    year, month, dom = day.split("-")
    folder = os.path.join(root, f"year={year}", f"month={month}", f"day={dom}")
    os.makedirs(folder, exist_ok=True)
    name = os.path.join(folder, f"part-{len(os.listdir(folder))}.jsonl")
    with open(name, "w", encoding="utf-8") as out:
        out.write("\n".join(lines))


def listed(df):
    """The folders that Spark lists for a scan."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for i in range(leaves.size()):
        if "LogicalRelation" in leaves.apply(i).getClass().getName():
            paths = leaves.apply(i).relation().location().rootPaths()
            found += [paths.apply(k).toString() for k in range(paths.size())]
    return sorted(found)


def line(device, time, temperature=1.0):
    return (
        f'{{"device_id":"{device}","timestamp":"{time}","temperature":{temperature},'
        '"humidity":55.1,"pressure":1015.25,"location":{"lat":35.0,"lon":139.0},"battery":99}'
    )


@pytest.fixture
def table(tmp_path):
    root = str(tmp_path / "table")
    put(root, "2024-01-08", line("a", "2024-01-08T00:00:00.000Z"),
        '{"device_id":"b","timestamp":"2024-01-08T00:05:00.000Z","temperature":"warm"}',
        '{"device_id":"c","timest', "", line("a", "no time"))
    put(root, "2024-01-09", line("a", "2024-01-08T15:30:00.000Z"), line("b", "2024-01-09T01:00:00.000Z"))
    put(root, "2024-01-11", line("a", "2024-01-10T20:00:00.000Z"), line("b", "2024-01-11T08:00:00.000Z"))
    return root


def test_keys_stay_padded_text_and_bad_time_is_null(spark, table):
    df = source.scan_readings(spark, table)
    assert df.count() == 6
    assert rows(df.filter("event_time IS NULL"), "device_id", "month", "day") == [("a", "01", "08")]
    assert rows(df.filter("day = '11'"), "location.lat", "battery") == [(35.0, 99)] * 2


def test_split_of_bad_lines_does_not_depend_on_the_columns_used(spark, table):
    df, rejects = source.scan_readings(spark, table), source.scan_rejects(spark, table)
    assert df.select("battery").count() == df.select("temperature").count() == df.count() == 6
    assert rows(rejects, "day", F.substring(source.CORRUPT, 15, 1)) == [("08", "b"), ("08", "c")]
    assert rejects.count() == 2


def test_failfast_stops(spark, table):
    with pytest.raises(Exception, match="(?i)malformed"):
        source.scan_readings(spark, table, mode="FAILFAST").collect()


def test_date_range_reads_neighbouring_folders_only(spark, table):
    df = source.scan_date_range(spark, table, "2024-01-10", "2024-01-10")
    assert rows(df, "device_id", "day") == [("a", "11")]
    assert [p[-len("day=09"):] for p in listed(df)] == ["day=09", "day=11"]
    # a range without any folder is empty, not an error
    assert source.scan_date_range(spark, table, "2025-01-01", "2025-02-01").count() == 0
    assert source.scan_date_range(spark, table, "2025-01-01", "2025-02-01").columns == df.columns


def test_day_folder(spark, table):
    assert rows(source.scan_partition_day(spark, table, "2024-01-09"), "device_id") == [
        ("a",), ("b",)
    ]


def test_round_trip_keeps_every_row(spark, table, tmp_path):
    root = str(tmp_path / "copy")
    df = source.scan_readings(spark, table)
    files.write_partitioned_jsonl(df, root)
    again = source.scan_readings(spark, root)
    columns = [c for c in df.columns if c not in ("year", "month", "day")]
    assert df.select(columns).exceptAll(again.select(columns)).count() == 0
    assert again.select(columns).exceptAll(df.select(columns)).count() == 0
    # one file per day, the day being the UTC one
    assert sorted(os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{root}/*/*/*/*.json")) == [
        "day=08", "day=09", "day=10", "day=11", "day=__HIVE_DEFAULT_PARTITION__"
    ]


def test_writer_zone_names_the_folder(spark, table, tmp_path):
    root = str(tmp_path / "tokyo")
    df = source.scan_readings(spark, table).filter("event_time IS NOT NULL")
    files.write_partitioned_jsonl(df, root, zone="Asia/Tokyo")
    assert rows(source.scan_readings(spark, root), "timestamp", "day") == [
        ("2024-01-08T00:00:00.000Z", "08"), ("2024-01-08T15:30:00.000Z", "09"),
        ("2024-01-09T01:00:00.000Z", "09"), ("2024-01-10T20:00:00.000Z", "11"),
        ("2024-01-11T08:00:00.000Z", "11"),
    ]


def test_replacing_days_or_everything(spark, table, tmp_path):
    root = str(tmp_path / "swap")
    df = source.scan_readings(spark, table).filter("event_time IS NOT NULL")
    files.write_partitioned_jsonl(df, root)
    one_day = df.filter("to_date(event_time) = '2024-01-09'")
    files.write_partitioned_jsonl(one_day.withColumn("battery", F.lit(1)), root)
    assert rows(source.scan_readings(spark, root), "day", "battery") == [
        ("08", 99), ("08", 99), ("09", 1), ("10", 99), ("11", 99)
    ]
    files.write_partitioned_jsonl(one_day, root, replace="all")
    assert rows(source.scan_readings(spark, root), "day") == [("09",)]


def test_big_day_is_split_into_files(spark, tmp_path):
    root = str(tmp_path / "hot")
    ids = spark.range(0, 200_000, 1, 8)
    df = ids.select(
        F.lit("a").alias("device_id"),
        F.timestamp_add("MILLISECOND", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")).alias(
            "event_time"
        ),
        F.rand(1).alias("temperature"), F.rand(2).alias("humidity"), F.rand(3).alias("pressure"),
        F.struct(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon")).alias("location"),
        F.lit(5).alias("battery"),
    )
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512kb"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        files.write_partitioned_jsonl(df, root)
    finally:
        for key in keys:
            spark.conf.unset(key)
    written = glob.glob(f"{root}/year=2024/month=01/day=01/*.json")
    assert len(written) > 1
    assert source.scan_readings(spark, root).count() == 200_000


def test_plain_lines_keep_null_fields_and_order(spark, table, tmp_path):
    path = str(tmp_path / "plain")
    df = quality.time_ordered(source.scan_readings(spark, table)).select(
        "device_id", "timestamp", F.lit(None).cast("double").alias("temperature")
    )
    files.write_jsonl(df, path)
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{path}/*.json"))).splitlines()
    assert text[0] == '{"device_id":"a","timestamp":"2024-01-08T00:00:00.000Z","temperature":null}'
    assert [t.split('"timestamp":"')[1][:13] for t in text[:5]] == [
        "2024-01-08T00", "2024-01-08T15", "2024-01-09T01", "2024-01-10T20", "2024-01-11T08"
    ]


def test_csv_flattens_structs(spark, table, tmp_path):
    path = str(tmp_path / "csv")
    files.write_result_csv(source.scan_readings(spark, table).filter("day = '11'"), path)
    text = [open(f).read().splitlines() for f in sorted(glob.glob(f"{path}/*.csv"))]
    assert "location_lat,location_lon" in text[0][0]
    assert sum(len(t) - 1 for t in text) == 2


def test_sql_over_the_registered_view(spark, table):
    source.register_readings(spark, table, "sensor_data")
    found = spark.sql(
        "SELECT DISTINCT device_id FROM sensor_data "
        "WHERE year = '2024' AND month = '01' AND day = '09' ORDER BY device_id"
    )
    assert [r[0] for r in found.collect()] == ["a", "b"]


def test_transcript_lines_are_numbered_across_blocks(spark, tmp_path):
    root = tmp_path / "talk"
    root.mkdir()
    want = {}
    for name, n in (("one", 900), ("two", 3), ("three", 250)):
        texts = [f"[{i // 60 % 24:02d}:{i % 60:02d}] s: 行 {i}" if i % 7 else "" for i in range(n)]
        (root / f"{name}.txt").write_text("\n".join(texts), encoding="utf-8")
        want[name] = list(enumerate(texts, 1))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "2000")
        df = scan_transcript_lines(spark, str(root))
        assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()  # read once, before
        got = {}
        for session, number, text in df.orderBy("session_id", "line_no").collect():
            got.setdefault(os.path.basename(session)[:-4], []).append((number, text))
        entries = transcripts.transcript_timeline(transcripts.transcript_lines(df)).count()
    finally:
        spark.conf.set(key, before)
    assert got == want
    assert entries == sum(1 for texts in want.values() for _, t in texts if t)


def test_many_transcripts_cost_few_tasks_and_no_spark_file_each(spark, tmp_path):
    lines = [(f"s {i}/é" if i else None, n, f"[10:0{n}] a: {i}" if n != 2 else None) for i in range(40) for n in (3, 1, 2)]
    df = spark.createDataFrame(lines, "session_id string, line_no int, line string")
    root = f"file://{tmp_path}/many"
    files.write_transcripts(df, root)
    found = sorted(glob.glob(f"{tmp_path}/many/*/*"))
    assert len(found) == 40 and not glob.glob(f"{tmp_path}/many/*/.*")  # no checksum files, nothing unfinished
    assert open(f"{tmp_path}/many/session_id=s%207%2F%C3%A9/lines.txt").read() == "[10:01] a: 7\n\n[10:03] a: 7\n"
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    spark.sparkContext.setJobGroup("scan", "scan")
    scanned = scan_transcript_lines(spark, root)
    assert scanned.count() == 120 and scanned.select("session_id").distinct().count() == 40
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("scan") for s in tracker.getJobInfo(j).stageIds}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(info.numTasks for s in stages if (info := tracker.getStageInfo(s))) <= spark.sparkContext.defaultParallelism
    assert spark.conf.get(key, None) == before
