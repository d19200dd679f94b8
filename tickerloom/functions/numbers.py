"""Number coercion and the three "first usable value" rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in a landed text (grouping underscores and infinities
# included), and the texts a landed file uses for a missing measure.
NUMBER_PATTERN = (
    r"^\s*[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
)
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def number_strict(text: Column) -> Column:
    """A text as DOUBLE, null when it is not a plain number. Thousands separators do not parse.

    The pattern guard keeps out what a Spark cast would take beyond that, such as ``1.0d``.
    """
    bare = F.replace(F.trim(text), F.lit("_"), F.lit(""))
    return F.when(text.rlike(NUMBER_PATTERN), bare.try_cast("double"))


def number(text: Column) -> Column:
    """:func:`number_strict` that also takes thousands separators."""
    return number_strict(F.replace(text, F.lit(","), F.lit("")))


def payload_number(text: Column) -> Column:
    """:func:`number` of a JSON value's text; NaN, which Spark spells with quotes, stays NaN."""
    return F.when(text.isin("NaN", '"NaN"'), float("nan")).otherwise(number(text))


def missing_as_null(text: Column) -> Column:
    """Null out the missing-value texts of a landed measure column."""
    return F.when(~text.isin(MISSING_TEXTS), text)


def nan_as_null(value: Column) -> Column:
    """Null out NaN in a DOUBLE column."""
    return F.when(~F.isnan(value), value)


def first_parsed(*texts: Column) -> Column:
    """The first candidate that parses as a number; an unparseable one is passed over."""
    return F.coalesce(*(number(t) for t in texts))


def first_raw(*texts: Column) -> Column:
    """The first candidate that is present, then parsed: an unparseable one gives null."""
    return number(F.coalesce(*texts))


def first_truthy(*values: Column, falsy=0) -> Column:
    """Pass over null and ``falsy`` values; the last candidate is taken as it is."""
    *head, last = values
    return F.coalesce(*(F.nullif(v, F.lit(falsy)) for v in head), last)


def whole_volume(value: Column) -> Column:
    """A number cut towards zero to BIGINT, null when it does not fit."""
    return value.try_cast("bigint")


def fixed_text(value: Column, places: int) -> Column:
    """A DOUBLE as text with ``places`` decimals, rounded on its exact binary value.

    ``format_string`` and decimal casts round the shortest decimal text instead, so 1.005 would
    come out as 1.01 although the stored number lies below the tie. Here ``value * 10^places`` is
    split into its rounded product and the exact remainder, and the remainder settles ties. Larger
    numbers have few binary places left, or none, and are spelled digit by digit. ``places`` is at most 6.
    """
    return _named(value, lambda v: _fixed_text(v, places))


def _named(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; inlined it would be repeated in every term."""
    return F.transform(F.array(value), body)[0]


def _fixed_text(value: Column, places: int) -> Column:
    unit = 10**places
    size, scale = F.abs(value), float(unit)
    product = size * scale
    spread = size * 134217729.0  # 2^27 + 1, splits a double into two half-width parts
    high = spread - (spread - size)
    remainder = (high * scale - product) + (size - high) * scale
    base = F.floor(product)
    over_half = (product - base) - 0.5
    round_up = (over_half > 0) | (
        (over_half == 0) & ((remainder > 0) | ((remainder == 0) & (base % 2 == 1)))
    )
    sign = F.when(value.cast("string").startswith("-"), "-").otherwise("")

    def text(whole: Column, parts: Column) -> Column:
        return F.concat(sign, whole.cast("string"), F.lit("."), F.lpad(parts.cast("string"), places, "0"))

    def spelled(n: Column) -> Column:
        return text(((n - n % unit) / unit).cast("bigint"), n % unit)

    # From 2^52 scaled units on the split is no longer exact, but the fraction has so few bits left
    # that its product with the unit is.
    whole = F.floor(size)
    parts = F.rint((size - whole) * scale).cast("bigint")
    carried = text(whole + (parts >= unit).cast("bigint"), parts % unit)
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        .when(product < 2.0**52, _named(base + round_up.cast("bigint"), spelled))
        .when(size < 2.0**62, carried)
        .when(size >= 2.0**62, text(_integer_digits(size), F.lit(0)))
    )


def _integer_digits(size: Column) -> Column:
    """All digits of a DOUBLE of 2^62 or more: its 53 bits in limbs of nine digits, doubled as often as it takes."""
    limb, step = 10**9, 20
    doublings = F.floor(F.log2(size)).cast("int") - 54  # leaves a whole number below 2^56

    def whole(y: Column) -> Column:
        return ((y - y % limb) / limb).cast("bigint")

    def times(limbs: Column, factor: Column) -> Column:
        empty = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

        def one(acc: Column, x: Column) -> Column:
            y = x * factor + acc["carry"]
            return F.struct(whole(y).alias("carry"), F.concat(acc["out"], F.array(y % limb)).alias("out"))

        return F.aggregate(limbs, empty, one, lambda acc: F.concat(acc["out"], F.array(acc["carry"])))

    start = (size / F.pow(F.lit(2.0), doublings)).cast("bigint")
    limbs = F.array(start % limb, whole(start))
    rounds = F.sequence(F.lit(1), F.greatest(F.floor(doublings / step).cast("int"), F.lit(1)))
    limbs = F.aggregate(rounds, limbs, lambda acc, _: times(acc, F.when(doublings >= step, 1 << step).otherwise(1)))
    limbs = times(limbs, F.pow(F.lit(2.0), doublings % step).cast("bigint"))
    digits = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    return F.ltrim(digits, F.lit("0"))
