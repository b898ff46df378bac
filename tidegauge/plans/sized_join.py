"""Join of many rows with one row per key, whatever the number of keys and their skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.session import durable

# Most rows of 100 bytes ever broadcast, that is 50 MB; a longer key counts as more rows.
BROADCAST_ROWS = 500_000


def join_key_summary(
    rows: DataFrame,
    summary: DataFrame,
    key: str,
    weight: str,
    on: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` with ``summary``, which has one row per ``key``.

    ``weight`` is the summary's row count per key; ``on`` is a further condition over both
    sides. The summary is computed once and counted. A small one is broadcast and the rows never
    shuffle. Of a large one only the heavy keys are broadcast, those with at least
    1/``broadcast_rows`` of all rows for each 100 bytes they take; as all shares add up to one,
    these cannot take more than ``broadcast_rows`` times 100 bytes. The other keys hold too few rows
    each to unbalance a shuffle join.
    """
    summary = durable(summary)
    cost = 1 + F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) / 100
    size = summary.agg(F.sum(cost), F.sum(weight)).first()
    if (size[0] or 0) <= broadcast_rows:
        return _join(rows, F.broadcast(summary), key, on)
    heavy = F.col(weight) * broadcast_rows >= cost * size[1]
    heavy_keys = F.broadcast(summary.filter(heavy).select(key))
    return _join(rows, F.broadcast(summary.filter(heavy)), key, on).unionByName(
        _join(rows.join(heavy_keys, key, "left_anti"), summary.filter(~heavy), key, on)
    )


def _join(rows: DataFrame, side: DataFrame, key: str, on: Column | None) -> DataFrame:
    joined = rows.join(side, key)
    return joined if on is None else joined.filter(on)
