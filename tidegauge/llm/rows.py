"""A table's own columns carried along by an operator, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def own(name: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


class Carried:
    """The columns ``keep`` of a table (all by default) without those that an operator adds.

    They go along inside one struct under names of their place, so none can clash with an operator's.
    """

    def __init__(self, df: DataFrame, keep: list[str] | None, added: tuple[str, ...]):
        self.names = [c for c in (df.columns if keep is None else keep) if c not in added]
        places = [own(c).alias(f"c{k}") for k, c in enumerate(self.names)]
        self.packed = F.struct(*(places or [F.lit(0).alias("none")])).alias("row")

    def columns(self) -> list[Column]:
        return [F.col("row").getField(f"c{k}").alias(c) for k, c in enumerate(self.names)]
