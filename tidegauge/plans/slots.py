"""Sets of occupied reporting slots as bit masks, so counting distinct slots needs no extra shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidegauge.functions.time import MINUTES_PER_DAY, slot_of_day

WORD = 63  # bits used of a signed 64-bit word


def slots_per_day(interval: int) -> int:
    if not 0 < interval <= MINUTES_PER_DAY or MINUTES_PER_DAY % interval:
        raise ValueError("interval must be whole minutes that divide a day")
    return MINUTES_PER_DAY // interval


def _words(interval: int) -> int:
    return -(-slots_per_day(interval) // WORD)


def mask_columns(interval: int) -> list[str]:
    return [f"slots_{i}" for i in range(_words(interval))]


def mask_aggregates(time: Column | str, interval: int) -> list[Column]:
    """Aggregates giving the occupied slots of a day as words, to be grouped by day."""
    slot = slot_of_day(time, interval)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(WORD)).cast("int"))
    word = F.floor(slot / WORD)
    return [
        F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(name)
        for i, name in enumerate(mask_columns(interval))
    ]


def occupied(interval: int) -> Column:
    """Number of distinct slots in the mask columns."""
    total = F.lit(0).cast("long")
    for name in mask_columns(interval):
        total = total + F.bit_count(F.coalesce(name, F.lit(0).cast("long")))
    return total


def missing(interval: int) -> Column:
    """Array of the slot indexes whose bit is not set."""
    words = F.array(*[F.coalesce(F.col(c), F.lit(0).cast("long")) for c in mask_columns(interval)])

    def unset(slot: Column) -> Column:
        word = F.element_at(words, (F.floor(slot / WORD) + 1).cast("int"))
        return F.getbit(word, F.pmod(slot, F.lit(WORD)).cast("int")) == 0

    return F.filter(F.sequence(F.lit(0), F.lit(slots_per_day(interval) - 1)), unset)


def _word(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))


def first_occupied(interval: int) -> Column:
    """The first slot of a day's mask columns; NULL if there is none."""

    def lowest_bit(w: Column) -> Column:  # as many as there are bits below it
        return F.bit_count(F.bitwise_not(w).bitwiseAND(w - 1))

    words = enumerate(mask_columns(interval))
    return F.coalesce(*[F.when(_word(n) != 0, i * WORD + lowest_bit(_word(n))) for i, n in words])


def last_occupied(interval: int) -> Column:
    """The last slot of a day's mask columns; NULL if there is none."""
    words = list(enumerate(mask_columns(interval)))[::-1]
    return F.coalesce(*[F.when(_word(n) != 0, i * WORD + F.length(F.bin(_word(n))) - 1) for i, n in words])
