"""Final ordering of a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def presented(
    df: DataFrame, *keys: Column | str, settle: bool = False, spread: bool = False
) -> DataFrame:
    """Sort a result for its reader.

    A global sort runs its input twice, once to sample the key ranges. ``settle`` shuffles the
    rows first, so that the work below is done once; worth it when the result is much smaller
    than what it was made from. ``spread`` adds a last key that differs for every row, for
    results in which equal rows may be many: without it they could only go to one task.
    """
    if spread:
        df, keys = df.withColumn("_spread", F.monotonically_increasing_id()), (*keys, "_spread")
    if settle:
        df = df.hint("rebalance")
    return df.orderBy(*keys).drop("_spread")
