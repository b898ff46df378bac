"""Captures of one host and day by the thousand are dealt to several tasks, with the same verdicts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidegauge.llm import url_filter as uf
from tidegauge.session import Scratch


def rows_of(rng):
    start = dt.datetime(2024, 3, 1)
    rows = [("hot", start + dt.timedelta(minutes=rng.randrange(1440)), i) for i in range(1000)]
    rows += [(rng.choice(["a", "b", "hot", "none"]), start + dt.timedelta(minutes=rng.randrange(-3000, 6000)), i) for i in range(1000, 3000)]
    spans = []
    for key in ("a", "b", "hot"):
        at = sorted(start + dt.timedelta(minutes=rng.randrange(-4000, 6000)) for _ in range(30))
        for k, since in enumerate(at):
            until = at[k + 1] if k + 1 < len(at) else None
            spans.append((key, since, until if k % 5 else since + ((until or since + dt.timedelta(9)) - since) / 2, rng.choice(["block", "allow", "clear"])))
    return rows, [s for s in spans if s[2] is None or s[1] < s[2]]


def test_hot_keys_are_split_by_count(spark, monkeypatch):
    rows, spans = rows_of(random.Random(5))
    df = spark.createDataFrame(rows, "key string, at timestamp_ntz, n long").withColumn("key", F.xxhash64("key"))
    held = spark.createDataFrame(spans, "key string, valid_from timestamp_ntz, valid_to timestamp_ntz, action string")
    held = held.withColumn("key", F.xxhash64("key"))
    want = {}
    for key, at, n in rows:
        hit = [s[3] for s in spans if s[0] == key and s[1] <= at and (s[2] is None or at < s[2])]
        want[n] = hit[0] if hit else None
    for most in (100_000, 50, 7):
        monkeypatch.setattr(uf, "PART_ROWS", most)
        assert {r.n: r.action for r in uf.as_of(df, held).collect()} == want
    monkeypatch.setattr(uf, "PART_ROWS", 50)
    chunked = df.withColumn("chunk", uf._chunk("at", uf.CHUNK_MINUTES))
    counts = chunked.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    dealt, hot = uf.parted(chunked, counts, Scratch(spark, "t"), ["at", "n"])
    assert hot.count() >= 1
    sizes = [r["count"] for r in dealt.groupBy("key", "chunk", "part").count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == len(rows)
