"""Scan of meeting-transcript text files into numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tidegauge.session import durable, listing_tasks


def scan_transcript_lines(spark: SparkSession, root: str) -> DataFrame:
    """One row per text line: session (file path), line number from 1, text.

    Files stay splittable and are read once. A reader task gives the lines of its blocks rising ids, without
    gaps inside a block; they are stored. The first id and the line count of each block, one row per block,
    then turn ids into file-wide numbers, so lines are neither sorted nor counted one after the other.
    """
    with listing_tasks(spark):
        files = spark.read.text(root)
    lines = durable(
        files.select(
            F.col("_metadata.file_path").alias("session_id"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            F.col("value").alias("line"),
        )
    )
    earlier = W.partitionBy("session_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("session_id", "block")
        .agg(F.count("*").alias("block_lines"), F.min("id").alias("first_id"))
        .select(
            "session_id", "block", "first_id",
            F.coalesce(F.sum("block_lines").over(earlier), F.lit(0)).alias("lines_before"),
        )
    )
    number = F.col("lines_before") + F.col("id") - F.col("first_id") + 1
    return lines.join(blocks, ["session_id", "block"]).select("session_id", number.alias("line_no"), "line")
