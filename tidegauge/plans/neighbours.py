"""Rows chosen by their previous and next row, without a key's whole history in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def where_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Column,
    order: Sequence[str],
    columns: Sequence[str],
    wanted: Column,
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>`` of ``columns``, by ``order`` per key; keep ``wanted`` rows.

    ``chunk`` must rise with the order and not be NULL. Rows are sorted per (keys, chunk), which
    settles all of them but the first and last of each chunk. Of the others only wanted ones go
    on; the edges are then ordered per key, and their number is set by how many chunks a key
    spans, not by how many rows it has.
    """
    prev, following = [f"prev_{c}" for c in columns], [f"next_{c}" for c in columns]
    local = W.partitionBy("_chunk", *keys).orderBy(*order)
    marked = df.withColumn("_chunk", chunk).select(
        "*",
        *[F.lag(c).over(local).alias(p) for c, p in zip(columns, prev)],
        *[F.lead(c).over(local).alias(n) for c, n in zip(columns, following)],
        F.lag(F.lit(1)).over(local).isNull().alias("_first"),
        F.lead(F.lit(1)).over(local).isNull().alias("_last"),
    )
    edge = F.col("_first") | F.col("_last")
    # Edges share the NULL lane of their key; settled rows keep to their chunk's.
    kept = marked.filter(edge | wanted).withColumn("_lane", F.when(~edge, F.col("_chunk")))
    across = W.partitionBy("_lane", *keys).orderBy(*order)
    linked = kept.withColumns(
        {
            p: F.when(F.col("_first"), F.lag(c).over(across)).otherwise(F.col(p))
            for c, p in zip(columns, prev)
        }
        | {
            n: F.when(F.col("_last"), F.lead(c).over(across)).otherwise(F.col(n))
            for c, n in zip(columns, following)
        }
    )
    return linked.filter(wanted).drop("_chunk", "_lane", "_first", "_last")
