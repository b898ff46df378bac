"""Tables that change as a whole: commits, projected folders, failures and readers in between."""

import datetime as dt
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F
from test_files import line, listed, put, rows

from tidegauge.sinks import files
from tidegauge.sources import commits, readings as source

DAYS = ["2024-01-08", "2024-01-09", "2024-01-10", "2024-01-11"]


@pytest.fixture
def build(spark):
    """Readings of some days, four an hour, all with one value."""

    def make(days, value, device="a"):
        start = F.col("d").cast("timestamp_ntz")
        return (
            spark.createDataFrame([(d,) for d in days], "d string")
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(95))))
            .select(
                F.lit(device).alias("device_id"), F.timestamp_add("MINUTE", F.col("i") * 15, start).alias("event_time"),
                F.lit(float(value)).alias("temperature"), F.lit(1.0).alias("humidity"), F.lit(2.0).alias("pressure"),
                F.struct(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon")).alias("location"), F.lit(50).alias("battery"),
            )
        )

    return make


def held(spark, root):
    df = source.scan_readings(spark, root)
    return {(r["day"], r.temperature): r["count"] for r in df.groupBy("day", "temperature").count().collect()}


def test_days_all_and_none(spark, build, tmp_path):
    root = str(tmp_path / "t")
    files.publish_readings(build(DAYS, 1), root)
    assert held(spark, root) == {(d[-2:], 1.0): 96 for d in DAYS}
    files.publish_readings(build(DAYS[1:2], 2), root)
    assert held(spark, root) == {("08", 1.0): 96, ("09", 2.0): 96, ("10", 1.0): 96, ("11", 1.0): 96}
    files.publish_readings(build(DAYS[1:3], 3, "b"), root, replace="none")
    assert held(spark, root)[("09", 3.0)] == held(spark, root)[("09", 2.0)] == held(spark, root)[("10", 1.0)] == 96
    files.publish_readings(build(DAYS[3:], 4), root, replace="all")
    assert held(spark, root) == {("11", 4.0): 96}
    files.publish_readings(build([], 5), root, replace="days")
    assert held(spark, root) == {("11", 4.0): 96}
    files.publish_readings(build([], 5), root, replace="all")
    assert held(spark, root) == {}
    assert source.scan_readings(spark, root).columns[-1] == "event_time"
    assert commits.latest(spark, root).number == 6
    with pytest.raises(ValueError, match="replace"):
        files.publish_readings(build([], 5), root, replace="some")


def test_a_table_of_folders_is_taken_over(spark, build, tmp_path):
    root = str(tmp_path / "t")
    put(root, "2024-01-08", line("x", "2024-01-08T01:00:00.000Z", 7.0), "{broken")
    put(root, "2024-01-09", line("x", "2024-01-09T01:00:00.000Z", 7.0))
    files.publish_readings(build(DAYS[1:3], 1), root)
    assert held(spark, root) == {("08", 7.0): 1, ("09", 1.0): 96, ("10", 1.0): 96}
    assert source.scan_rejects(spark, root).count() == 1
    files.publish_readings(build(DAYS[:1], 2), root, replace="none")
    assert held(spark, root)[("08", 7.0)] == 1 and held(spark, root)[("08", 2.0)] == 96
    with pytest.raises(ValueError, match="commits"):
        files.write_partitioned_jsonl(build(DAYS, 1), root)


def test_rows_without_a_time_and_a_refresh_from_the_table_itself(spark, build, tmp_path):
    root = str(tmp_path / "t")
    odd = build(DAYS[:1], 1).withColumn("event_time", F.when(F.minute("event_time") > 0, F.col("event_time")))
    files.publish_readings(odd, root)
    assert held(spark, root) == {("08", 1.0): 72, (None, 1.0): 24}
    again = source.scan_readings(spark, root).withColumn("temperature", F.col("temperature") + 1)
    files.publish_readings(again, root, replace="all")
    assert held(spark, root) == {("08", 2.0): 72, (None, 2.0): 24}


def test_a_range_touches_n_plus_two_folders(spark, build, tmp_path, monkeypatch):
    days = [(dt.date(2023, 11, 1) + dt.timedelta(k)).isoformat() for k in range(60)]
    plain, committed = str(tmp_path / "plain"), str(tmp_path / "committed")
    files.write_partitioned_jsonl(build(days, 1), plain)
    files.publish_readings(build(days, 1), committed)
    files.publish_readings(build(days[20:22], 2), committed)
    asked = []
    exists = commits.Folder.exists
    monkeypatch.setattr(commits.Folder, "exists", lambda self, *n: asked.append(n) or exists(self, *n))
    monkeypatch.setattr(commits.Folder, "matching", lambda *a: pytest.fail("the table was listed"))
    for root in (plain, committed):
        del asked[:]
        df = source.scan_date_range(spark, root, days[20], days[22])
        assert len(listed(df)) <= 5  # a write that lies wholly in the range is one folder
        opened = {tuple(p.split("=")[1] for p in f.split("/") if p[:5] in ("year=", "month", "day=2")) for f in df.inputFiles()}
        assert sorted("-".join(k) for k in opened) == days[19:24]
        assert len(asked) == (5 if root == plain else 0)
        assert df.count() == 3 * 96
        assert listed(source.scan_partition_day(spark, root, days[5]))[0].endswith("month=11/day=06")
    assert len(listed(source.scan_readings(spark, committed))) == 59  # 58 days of the first write, and the second
    files.publish_readings(build(days, 3), committed, replace="all")
    assert len(listed(source.scan_readings(spark, committed))) == 1
    assert len(listed(source.scan_readings(spark, plain))) == 1


def test_long_ranges_list_the_table(spark, build, tmp_path):
    root = str(tmp_path / "t")
    files.publish_readings(build(DAYS, 1), root)
    assert source.scan_date_range(spark, root, dt.date.min, dt.date.max).count() == 4 * 96
    assert source.scan_date_range(spark, root, dt.date.min, "2024-01-09").count() == 2 * 96
    assert source.scan_date_range(spark, root, "2024-01-10", dt.date.max).count() == 2 * 96


def test_a_write_that_fails_in_its_last_stage_is_never_seen(spark, build, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    files.publish_readings(build(DAYS, 1), root)
    before = held(spark, root)
    fixed = uuid.uuid4()
    folder = os.path.join(root, "_writes", f"write=w{fixed.hex}")
    with monkeypatch.context() as patch:
        patch.setattr(commits.uuid, "uuid4", lambda: fixed)

        def dies(df, *args, **options):  # all files are written, the job is not
            raise RuntimeError("killed")

        stage = commits.stage
        patch.setattr(files, "stage", lambda df, *a, **o: (stage(df, *a, **o), dies(df))[0])
        with pytest.raises(RuntimeError, match="killed"):
            files.publish_readings(build(DAYS, 2), root, replace="all")
    assert os.path.isdir(os.path.join(folder, "year=2024", "month=01", "day=11"))
    assert held(spark, root) == before
    # a task of the last stage fails for good, after the sort and while other days are written
    arranged = files._arranged
    lost = F.when(F.col("day") == "11", F.raise_error(F.lit("lost"))).otherwise(F.col("timestamp")).cast("string")
    with monkeypatch.context() as patch:
        patch.setattr(files, "_arranged", lambda df, zone: arranged(df, zone).withColumn("timestamp", lost))
        with pytest.raises(Exception, match="lost"):
            files.publish_readings(build(DAYS, 3), root)
    assert held(spark, root) == before
    assert commits.clean(spark, root) == []  # too young to be told from writes under way
    assert f"w{fixed.hex}" in commits.clean(spark, root, hours=0)
    assert not os.path.isdir(folder)
    assert held(spark, root) == before
    files.publish_readings(build(DAYS, 4), root)
    assert set(held(spark, root)) == {(d[-2:], 4.0) for d in DAYS}


def test_readers_see_old_or_new_rows_and_never_a_mix(spark, build, tmp_path):
    root = str(tmp_path / "t")
    files.publish_readings(build(DAYS, 0), root)
    begun = source.scan_readings(spark, root)
    seen, stop, errors = [], threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                seen.append(held(spark, root))
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for value in (1, 2, 3):
        files.publish_readings(build(DAYS[: value + 1], value), root, replace="all")
    stop.set()
    reader.join()
    assert not errors
    whole = [{(d[-2:], 0.0): 96 for d in DAYS}]
    whole += [{(d[-2:], float(v)): 96 for d in DAYS[: v + 1]} for v in (1, 2, 3)]
    assert seen and all(s in whole for s in seen)
    assert begun.agg(F.sum("temperature")).first()[0] == 0  # planned before, read after


def test_two_writers(spark, build, tmp_path):
    """The second to commit makes its change to what the first left; no number is used twice."""
    root = str(tmp_path / "t")
    files.publish_readings(build(DAYS, 1), root)
    writes = [files.stage(files._arranged(build(DAYS[k : k + 1], 2 + k), "UTC"), root, "json") for k in range(4)]
    threads = [threading.Thread(target=commits.publish, args=(spark, root, *w)) for w in writes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert held(spark, root) == {(d[-2:], 2.0 + k): 96 for k, d in enumerate(DAYS)}
    assert commits.latest(spark, root).number == 5
    folder = commits.Folder(spark, root)
    assert not folder.write_new("{}", "_commits", f"{5:012d}.json")
    assert sorted(folder.names("_commits")) == [n for n in sorted(folder.names("_commits")) if n.endswith((".json", ".crc"))]


def test_cleaning(spark, build, tmp_path):
    root = str(tmp_path / "t")
    put(root, "2024-01-08", line("x", "2024-01-08T01:00:00.000Z", 7.0))
    put(root, "2024-01-12", line("x", "2024-01-12T01:00:00.000Z", 7.0))
    assert commits.clean(spark, root) == []
    for value in (1, 2, 3):
        files.publish_readings(build(DAYS, value), root)
    assert len(commits.clean(spark, root, hours=0)) == 1
    assert [n for n in sorted(os.listdir(f"{root}/_commits")) if not n.startswith(".")] == [f"{k:012d}.json" for k in (2, 3)]
    assert os.path.isdir(f"{root}/year=2024/month=01/day=12") and not os.path.isdir(f"{root}/year=2024/month=01/day=08")
    assert held(spark, root) == {(d[-2:], 3.0): 96 for d in DAYS} | {("12", 7.0): 1}


def test_versions_change_with_their_day_alone(spark, build, tmp_path):
    root = str(tmp_path / "t")
    put(root, "2024-01-07", line("x", "2024-01-07T01:00:00.000Z", 7.0))
    plain = commits.versions(spark, root)
    assert list(plain) == ["2024-01-07"]
    put(root, "2024-01-07", line("x", "2024-01-07T02:00:00.000Z", 7.0))
    assert commits.versions(spark, root) != plain
    files.publish_readings(build(DAYS, 1), root)
    first = commits.versions(spark, root)
    files.publish_readings(build(DAYS[:1], 1), root)
    second = commits.versions(spark, root)
    assert {d for d in second if second[d] != first[d]} == {DAYS[0]}
