"""Rounding and correlation expressions that give one answer everywhere."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidegauge.functions.time import col


def round_half_up(x: Column | str, digits: int) -> Column:
    """Round through a decimal, so near-ties of binary doubles do not depend on the engine.

    Values that no such decimal holds, 1e26 and above, have no digits to round away and are rounded
    as doubles; infinities stay. NaN gives NULL.
    """
    double = col(x).cast("double")
    exact = F.round(double.try_cast("decimal(38,12)"), digits).cast("double")
    return F.coalesce(exact, F.when(~F.isnan(double), F.round(double, digits)))


def rounded_avg(x: Column | str, digits: int) -> Column:
    return round_half_up(F.avg(col(x)), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_half_up(100.0 * part / F.nullif(whole, F.lit(0)), digits)
