"""Bounds of the expected slots: carried in the masks, found without another read of the readings."""

import random

from pyspark.sql import functions as F

from tidegauge.operators import quality
from tidegauge.plans import slots


def seen(spark, df):
    """The rows again, counting how many are read."""
    count = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    return df.mapInArrow(passing, df.schema), count


def rows_of(rng):
    rows = [(d, f"2024-01-{rng.randrange(3, 9):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00") for d in "abc" for _ in range(40)]
    return [*rows, ("d", None), (None, "2024-01-02 23:30:00"), (None, "2024-01-10 00:10:00"), (None, None)]


def plain(rows, interval, first=None, last=None):
    """Expected slots of every known device that hold no reading, as minutes of January."""
    at = lambda t: ((int(t[8:10]) * 24 + int(t[11:13])) * 60 + int(t[14:16])) // interval
    times = [at(t) for _, t in rows if t]
    first, last = min(times) if first is None else at(first), max(times) if last is None else at(last)
    held = {(d, at(t)) for d, t in rows if d and t}
    return {(d, s) for d in {d for d, _ in rows if d} for s in range(first, last + 1) if (d, s) not in held}


def test_against_a_grid_with_one_read(spark):
    rng = random.Random(3)
    for interval in (5, 30, 1440):
        rows = rows_of(rng)
        df = spark.createDataFrame(rows, "device_id string, time string").select(
            "device_id", F.col("time").cast("timestamp_ntz").alias("event_time")
        )
        for start, end in ((None, None), ("2024-01-04 10:00:00", None), (None, "2024-01-07 03:00:00"), ("2024-01-01 00:00:00", "2024-01-12 00:00:00")):
            given = {"start": start, "end": end}
            counted, count = seen(spark, df)
            found = quality.missing_slots(counted, interval, ordered=False, **given).collect()
            assert count.value == len(rows)
            got = [(r.device_id, ((r.slot.day * 24 + r.slot.hour) * 60 + r.slot.minute) // interval) for r in found]
            assert len(got) == len(set(got)) and set(got) == plain(rows, interval, start, end)
        counted, count = seen(spark, df)
        losses = {r.device_id: r.lost for r in quality.loss_summary(counted, interval, ordered=False).collect()}
        assert count.value == len(rows)
        lost = plain(rows, interval)
        assert losses == {None: len(lost), **{d: sum(x == d for x, _ in lost) for d in "abcd"}}


def test_first_and_last_slot(spark):
    interval, rng = 5, random.Random(7)
    names = slots.mask_columns(interval)
    days = [sorted(rng.sample(range(288), rng.randrange(1, 5))) for _ in range(200)] + [[0], [287], [62], [63], [0, 287], []]
    rows = [tuple(sum(1 << s % slots.WORD for s in day if s // slots.WORD == w) for w in range(len(names))) for day in days]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names)).coalesce(1)
    got = df.select(slots.first_occupied(interval).alias("a"), slots.last_occupied(interval).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(day[0], day[-1]) if day else (None, None) for day in days]
