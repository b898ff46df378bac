"""Views of general tables in the shape of readings and transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def readings_from_events(events: DataFrame, device: str = "event_type") -> DataFrame:
    """An event log as device readings; one device per value of ``device``."""
    user = F.col("user_id").cast("double")
    # A payload that holds k alone needs no JSON parser, which costs several times more. Taken
    # apart in its own projection, so that several uses do it once.
    alone = F.regexp_extract("props", r'^\{"k": ?(-?[0-9]{1,9})\}$', 1).try_cast("int")
    parsed = events.withColumn(
        "k", F.coalesce(alone, F.get_json_object("props", "$.k").try_cast("int"))
    )
    k = F.col("k").cast("double")
    return parsed.select(
        F.col(device).cast("string").alias("device_id"),
        F.col("ts").alias("event_time"),
        F.col("value").alias("temperature"),
        k.alias("humidity"),
        user.alias("pressure"),
        F.struct(k.alias("lat"), user.alias("lon")).alias("location"),
        F.col("k").alias("battery"),
    )


def lines_from_conversations(conversations: DataFrame) -> DataFrame:
    """Each turn as one transcript line, three minutes apart from shortly before midnight."""
    minute = F.pmod(1430 + F.col("turn") * 3 + F.pmod("conv_id", F.lit(7)), F.lit(1440))
    hhmm = F.format_string("[%02d:%02d] ", F.floor(minute / 60), F.pmod(minute, F.lit(60)))
    spoken = F.translate("text", "\r\n", "  ")
    measured = F.concat(
        F.lit(" load "), F.col("turn"), F.lit(".5% in "), F.col("conv_id"), F.lit("ms after "),
        F.col("turn"), F.lit("秒"),
    )
    return conversations.select(
        F.col("conv_id").cast("string").alias("session_id"),
        (F.col("turn") + 1).alias("line_no"),
        F.concat(hhmm, F.col("role"), F.lit(": "), spoken, measured).alias("line"),
    )
