"""Time expressions.

Everything here works on UTC wall-clock ``timestamp_ntz`` values and none of it
depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_MINUTE = 60_000_000
MINUTES_PER_DAY = 1440


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


# A full date and time; seconds, fraction and offset may be missing.
_ISO = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})[T ]([0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?)(?:Z|([+-][0-9]{2}):?([0-9]{2})?)?$"


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 date and time to UTC wall-clock time; text without an offset is UTC already.

    Everything else, a date or a time alone included, gives NULL. Text in the stored form is told by its
    positions and cast; regular expressions only see what is left.
    """
    t = col(text).cast("string")
    return F.coalesce(_parse_stored(t), _parse_any(t))


def _parse_stored(t: Column) -> Column:
    """``2024-01-01T00:00:00.000Z``, with three to six digits after the point; NULL for other text.

    The cast checks the rest: between these marks it takes nothing but digits, apart from signs and
    white space after the point, which the number made of those digits rules out.
    """
    length = F.length(t)
    fraction, last = F.substring(t, F.lit(21), length - 21), F.substring(t, length - 1, F.lit(1))
    marked = (
        length.between(24, 27)
        & (F.substring(t, 5, 1) == "-")
        & (F.substring(t, 8, 1) == "-")
        & (F.substring(t, 11, 1) == "T")
        & (F.substring(t, 20, 1) == ".")
        & F.endswith(t, F.lit("Z"))
        & last.between("0", "9")
        & F.concat(F.lit("1"), fraction).try_cast("int").isNotNull()
    )
    return F.when(marked, F.substring(t, F.lit(1), length - 1).try_cast("timestamp_ntz"))


def _parse_any(t: Column) -> Column:
    hours, minutes = F.regexp_extract(t, _ISO, 3), F.regexp_extract(t, _ISO, 4)
    offset = F.when(hours == "", "Z").otherwise(
        F.concat(hours, F.lit(":"), F.when(minutes == "", "00").otherwise(minutes))
    )
    clock = F.regexp_extract(t, _ISO, 2)
    clock = F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    whole = F.concat(F.regexp_extract(t, _ISO, 1), F.lit("T"), clock, offset)
    instant = F.try_to_timestamp(F.when(t.rlike(_ISO), whole))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def format_iso(time: Column | str) -> Column:
    """UTC wall-clock time to the stored text form: milliseconds, or all digits it has, and ``Z``."""
    # Not date_format, which goes through the session zone and shifts hours that zone skips.
    text = col(time).cast("string")
    digits = F.substring(text, 21, 6)
    digits = F.when(F.length(digits) < 3, F.rpad(digits, 3, "0")).otherwise(digits)
    return F.concat(
        F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), digits, F.lit("Z")
    )


def partition_keys(time: Column | str, zone: str = "UTC") -> list[Column]:
    """The zone's calendar day as zero-padded ``year``, ``month`` and ``day`` text."""
    date = in_zone(time, zone).cast("date").cast("string")
    return [
        F.substring(date, 1, 4).alias("year"),
        F.substring(date, 6, 2).alias("month"),
        F.substring(date, 9, 2).alias("day"),
    ]


def day_of(time: Column | str) -> Column:
    return col(time).cast("date").cast("timestamp_ntz")


def hour_of(time: Column | str) -> Column:
    return F.timestamp_add("HOUR", F.hour(col(time)), day_of(time))


def bucket(time: Column | str, unit: str) -> Column:
    """Start of the hour or day, as ``timestamp_ntz``."""
    if unit == "hour":
        return hour_of(time)
    if unit == "day":
        return day_of(time)
    raise ValueError(f"unit must be 'hour' or 'day', not {unit!r}")


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Signed microseconds from start to end."""
    gap = col(end) - col(start)

    def part(field: str) -> Column:
        return F.extract(F.lit(field), gap)

    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * MICROS_PER_MINUTE + (part("SECOND") * 1_000_000).cast("long")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end) / F.lit(float(MICROS_PER_MINUTE))


def epoch_micros(time: Column | str) -> Column:
    return micros_between(_epoch(), time)


def slot_of_day(time: Column | str, interval: int) -> Column:
    """Index of the reporting slot inside the day, counted from midnight."""
    minute = F.hour(col(time)) * 60 + F.minute(col(time))
    return F.floor(minute / interval).cast("int")


def slot_start(day: Column | str, slot: Column | str, interval: int) -> Column:
    return F.timestamp_add("MINUTE", col(slot) * interval, col(day))


def slot_floor(time: Column | str, interval: int) -> Column:
    """Start of the reporting slot a time falls into."""
    return slot_start(day_of(time), slot_of_day(time, interval), interval)


def in_zone(time: Column | str, zone: str) -> Column:
    """The same instant on another zone's wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(time))
