"""Polynomial string hash that picks a bit in a bitmap of ``capacity`` bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 61
DEFAULT_CAPACITY = 1 << 27
LONG_DIGITS = 19


def _check(capacity: int) -> None:
    if capacity <= 0 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")


def string_offset(text: Column, seed: int = SEED, capacity: int = DEFAULT_CAPACITY) -> Column:
    """Offset of any text without characters outside the basic plane.

    The remainder is taken at each step: for a power of two that equals masking
    the full sum at the end, and it cannot overflow.
    """
    _check(capacity)
    return F.aggregate(
        F.split(text, ""),
        F.lit(0).cast("long"),
        lambda total, char: (total * seed + F.ascii(char)) % capacity,
    )


def long_offset(number: Column, seed: int = SEED, capacity: int = DEFAULT_CAPACITY) -> Column:
    """Same offset for the decimal text of a long, about five times as fast.

    The polynomial is taken over the digits' values, plus what the characters
    add to them, which depends on the length and sign alone. The terms are kept
    short: generated code beyond 8,000 bytes per method is not compiled by the
    JVM, and then slower than the form above.
    """
    _check(capacity)
    number = number.cast("long")
    values = number % 10
    for place in range(1, LONG_DIGITS):
        left = F.call_function("div", number, F.lit(10**place).cast("long"))
        values = values + left % 10 * F.lit(pow(seed, place, capacity)).cast("long")

    # What the characters "0" add up to in texts of 1, 2, ... digits, and the
    # same with a minus in front.
    weights = [pow(seed, place, capacity) for place in range(LONG_DIGITS + 1)]
    zeros = [ord("0") * sum(weights[:digits]) for digits in range(1, LONG_DIGITS + 1)]
    signed = [total + ord("-") * weight for total, weight in zip(zeros, weights[1:])]
    length = F.length(number.cast("string"))
    added = F.when(number < 0, _pick(signed, length - 1)).otherwise(_pick(zeros, length))
    # All digits of a negative number come out negative.
    return F.pmod(F.abs(values) + added, F.lit(capacity))


def _pick(totals: list[int], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(total).cast("long") for total in totals]), position)
