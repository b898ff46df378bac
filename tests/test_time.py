"""Reading times: the stored form by position equals the general form by pattern."""

import random

from pyspark.sql import functions as F

from tidegauge.functions import time as tm

BASE = ["2024-01-01T00:00:00.000Z", "2024-12-31T23:59:59.123456Z", "2024-02-29T01:02:03.1234Z", "2023-02-29T01:02:03.12345Z"]


def test_the_fast_path_gives_what_the_pattern_gives(spark):
    rng, rows = random.Random(1), list(BASE)
    rows += ["20241-1-01T00:00:00.000Z", "2024-01-01T00:00:00.+09Z", "2024-01-01T00:00:00.1+9Z", "2024-01-01T00:00:00.12 Z"]
    for _ in range(30_000):
        text = list(rng.choice(BASE))
        for _ in range(rng.randrange(1, 4)):
            i = rng.randrange(len(text))
            text[i : i + rng.randrange(2)] = rng.choice(["", *"0123456789-+:T .Z/\taé"])
        rows.append("".join(text))
    df = spark.createDataFrame([(r,) for r in rows] + [(None,)], "t string")
    both = df.select("t", tm._parse_stored(F.col("t")).alias("a"), tm._parse_any(F.col("t")).alias("b"), tm.parse_iso("t").alias("c"))
    both = both.cache()
    assert both.filter("a IS NOT NULL").count() > 1000
    assert [r.t for r in both.filter("a IS NOT NULL AND NOT a <=> b").collect()] == []
    assert [r.t for r in both.filter("NOT b <=> c").collect()] == []
    stored = both.filter(F.col("t").isin(BASE)).select("t", "a").collect()
    assert {r.t: str(r.a) for r in stored}[BASE[1]] == "2024-12-31 23:59:59.123456"
    assert {r.t: r.a for r in stored}[BASE[3]] is None
    both.unpersist()
