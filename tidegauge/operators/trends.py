"""Latest status and moving averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tidegauge.functions.numeric import round_half_up
from tidegauge.functions.time import epoch_micros, hour_of
from tidegauge.schema import MEASURES


def latest_status(
    df: DataFrame,
    measures: Sequence[str] = MEASURES,
    battery: str = "battery",
    location: str = "location",
    device: str = "device_id",
    time: str = "event_time",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest reading of each device, with its position.

    Without ``tie_break`` all columns come from ``max_by`` over one ordering: a hash aggregation
    that keeps one row per device and task before the shuffle. With it (highest value wins) the
    row is picked by rank, which also discards the other rows before the shuffle. A device without
    any time keeps one of its readings, with a NULL time.
    """
    columns = [
        *measures, battery,
        F.col(f"{location}.lat").alias("latitude"), F.col(f"{location}.lon").alias("longitude"),
    ]
    if tie_break:
        newest = W.partitionBy(device).orderBy(
            F.desc_nulls_last(time), *[F.desc_nulls_last(c) for c in tie_break]
        )
        return (
            df.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") == 1)
            .select(device, F.col(time).alias("last_update"), *columns)
        )
    flat = df.select(device, time, *columns)
    carried = [c for c in flat.columns if c not in (device, time)]
    # A device whose readings all lack a time still has a reading; any time is newer than none.
    newest = F.coalesce(epoch_micros(time), F.lit(-(2**63)))
    return flat.groupBy(device).agg(
        F.max(time).alias("last_update"), *[F.max_by(c, newest).alias(c) for c in carried]
    )


def moving_average(
    df: DataFrame,
    value: str = "temperature",
    rows: int = 12,
    by: str = "rows",
    device: str = "device_id",
    time: str = "event_time",
    digits: int = 2,
    ordered: bool = True,
) -> DataFrame:
    """Hourly means per device with their trailing mean over ``rows`` hours.

    ``by='rows'`` takes the last ``rows`` hours that have readings; ``'range'`` takes the last
    ``rows`` hours of the clock. The window runs over hourly means, never over readings.
    """
    hourly = df.groupBy(device, hour_of(time).alias("hour")).agg(F.avg(value).alias("hourly"))
    trailing = W.partitionBy(device).orderBy(F.asc_nulls_last("hour"))
    if by == "rows":
        moving = F.avg("hourly").over(trailing.rowsBetween(-(rows - 1), 0))
    elif by == "range":
        # Whole hours as numbers: a value range needs a numeric ordering.
        clock = F.datediff(F.col("hour").cast("date"), F.lit("1970-01-01").cast("date")) * 24
        hours = clock + F.hour("hour")
        moving = F.avg("hourly").over(
            W.partitionBy(device).orderBy(F.asc_nulls_last(hours)).rangeBetween(-(rows - 1), 0)
        )
    else:
        raise ValueError(f"by must be 'rows' or 'range', not {by!r}")
    out = hourly.select(
        device, "hour",
        round_half_up("hourly", digits).alias(value),
        round_half_up(moving, digits).alias(f"moving_avg_{rows}h"),
    )
    return out.orderBy(F.asc_nulls_last(device), F.asc_nulls_last("hour")) if ordered else out
