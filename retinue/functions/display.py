"""Text forms of numbers and ids for report cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shorten(text: Column, length: int) -> Column:
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def with_thousands(number: Column) -> Column:
    return F.format_number(number, 0)


def fixed(number: Column, digits: int, prefix: str = "", suffix: str = "") -> Column:
    """``prefix`` + number with ``digits`` decimals (3 at most) + ``suffix``; NULL for NULL.

    Rounds the double's exact binary value, ties to even: 53 and then 53 more bits of its
    fraction are whole numbers, and integer arithmetic finds the decimals and what is left.
    """
    value = F.abs(number.cast("double"))
    whole = F.floor(value)
    bits = (value - whole) * F.lit(float(1 << 53))
    high = F.floor(bits)
    low = ((bits - high) * F.lit(float(1 << 53))).cast("bigint") * F.lit(10**digits)
    scaled = high * F.lit(10**digits) + F.shiftright(low, 53)
    shown = F.shiftright(scaled, 53)
    rest = scaled - F.shiftleft(shown, 53)
    more = low != F.shiftleft(F.shiftright(low, 53), 53)
    odd = (whole * F.lit(10**digits % 2) + shown) % 2 == 1
    up = (rest > F.lit(1 << 52)) | ((rest == F.lit(1 << 52)) & (more | odd))
    shown = shown + up.cast("bigint")
    carry = (shown == 10**digits).cast("bigint")
    text = F.concat(
        F.lit(prefix),
        F.when(number.cast("double") < 0, "-").otherwise(""),
        (whole + carry).cast("string"),
        F.concat(F.lit("."), F.lpad((shown - carry * 10**digits).cast("string"), digits, "0")) if digits else F.lit(""),
        F.lit(suffix),
    )
    return F.when(F.isnan(number.cast("double")), F.lit(f"{prefix}nan{suffix}")).otherwise(text)


def label_of(code: Column, labels: dict[str, str]) -> Column:
    """Look a code up in a fixed mapping; unknown codes stay as they are."""
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, label in labels.items():
        chosen = chosen.when(code == value, F.lit(label))
    return chosen.otherwise(code)
