"""Incident transcripts as tables: lines, timeline, and the figures people mention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidegauge.session import durable

# The line form "[HH:MM] speaker: text", and a number with its unit.
LINE_PATTERN = r"^\[([0-9]{2}:[0-9]{2})\] ([^:]+): (.*)$"
METRIC_PATTERN = r"([0-9]+(?:\.[0-9]+)?) ?(%|ms|秒)"
METRIC_UNITS = {"%": "percent", "ms": "milliseconds", "秒": "seconds"}

LINES_PER_CHUNK = 10_000


def transcript_lines(lines: DataFrame, text: str = "line") -> DataFrame:
    """Split (session_id, line_no, line) into time, speaker and text.

    A line of any other form keeps its text and has NULL time and speaker.
    """
    body = F.regexp_replace(text, r"\r$", "")
    matched = body.rlike(LINE_PATTERN)

    def part(i: int):
        return F.when(matched, F.regexp_extract(body, LINE_PATTERN, i))

    return lines.select(
        "session_id", "line_no", part(1).alias("hhmm"), part(2).alias("speaker"),
        F.when(matched, F.regexp_extract(body, LINE_PATTERN, 3)).otherwise(body).alias("text"),
    )


def transcript_timeline(lines: DataFrame) -> DataFrame:
    """Timed lines of each session: order, minutes since the first and the previous entry, total.

    The clock has no date, so a time that goes backwards means the next day. Lines are summed
    up inside chunks; one row per chunk, with its first and last clock, links the chunks. The summed-up
    lines are stored, as both the chunks and the result need them.
    """
    zero = F.lit(0).cast("long")

    def minutes(start, end):
        return F.pmod(F.col(end) - start, F.lit(1440)).cast("long")

    clock = (
        F.substring("hhmm", 1, 2).cast("int") * 60 + F.substring("hhmm", 4, 2).cast("int")
    )
    inside = W.partitionBy("session_id", "chunk").orderBy("line_no")
    so_far = inside.rowsBetween(W.unboundedPreceding, 0)
    timed = (
        lines.filter(F.col("hhmm").isNotNull())
        .select(
            "session_id", "line_no", "hhmm", "speaker", clock.alias("clock"),
            F.floor(F.col("line_no") / LINES_PER_CHUNK).alias("chunk"),
        )
        .withColumns(
            {"step": minutes(F.lag("clock").over(inside), "clock"), "n": F.row_number().over(inside)}
        )
        .withColumn("elapsed", F.sum(F.coalesce("step", zero)).over(so_far))
    )
    timed = durable(timed)
    by_chunk = W.partitionBy("session_id").orderBy("chunk")
    earlier = by_chunk.rowsBetween(W.unboundedPreceding, -1)
    spent = F.col("inner") + F.coalesce("jump", zero)
    chunks = (
        timed.groupBy("session_id", "chunk")
        .agg(
            F.min_by("clock", "line_no").alias("opens"), F.max_by("clock", "line_no").alias("closes"),
            F.max("elapsed").alias("inner"), F.count("*").alias("entries"),
        )
        .withColumn("jump", minutes(F.lag("closes").over(by_chunk), "opens"))
        .select(
            "session_id", "chunk", "jump",
            (F.coalesce(F.sum(spent).over(earlier), zero) + F.coalesce("jump", zero)).alias("offset"),
            F.coalesce(F.sum("entries").over(earlier), zero).alias("entries_before"),
            F.sum(spent).over(W.partitionBy("session_id")).alias("total_minutes"),
        )
    )
    return timed.join(chunks, ["session_id", "chunk"]).select(
        "session_id", "line_no", (F.col("entries_before") + F.col("n")).alias("entry_no"),
        "hhmm", "speaker",
        (F.col("offset") + F.col("elapsed")).alias("minutes_since_first"),
        F.when(F.col("n") == 1, F.col("jump")).otherwise(F.col("step")).alias("minutes_since_prev"),
        "total_minutes",
    )


def transcript_metrics(lines: DataFrame) -> DataFrame:
    """One row per number with a unit in a line's text, in the order they are mentioned."""
    numbers = F.regexp_extract_all("text", F.lit(METRIC_PATTERN), F.lit(1))
    units = F.regexp_extract_all("text", F.lit(METRIC_PATTERN), F.lit(2))
    names = F.create_map(*[F.lit(x) for pair in METRIC_UNITS.items() for x in pair])
    return (
        lines.select(
            "session_id", "line_no", "hhmm", "speaker",
            F.posexplode(F.arrays_zip(numbers.alias("number"), units.alias("unit"))).alias(
                "pos", "found"
            ),
        )
        .select(
            "session_id", "line_no", "hhmm", "speaker",
            (F.col("pos") + 1).cast("long").alias("mention_no"),
            F.col("found.number").cast("double").alias("value"),
            names[F.col("found.unit")].alias("unit"),
        )
    )
