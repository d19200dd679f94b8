"""Price change, run status and run message columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom.functions.numbers import fixed_text

# Fixed value: share of failed items up to which a run only warns.
WARNING_RATE = 0.01


def price_change(price: Column, previous: Column) -> Column:
    """Price minus previous close; null unless both are known and the previous one is not 0."""
    return F.when(previous != 0, price - previous)


def price_change_percent(price: Column, previous: Column) -> Column:
    """The change as text, e.g. ``-0.91%``."""
    ratio = F.try_divide(price - previous, F.nullif(previous, F.lit(0.0))) * 100
    return F.concat(fixed_text(ratio, 2), F.lit("%"))


def error_rate(total: Column, errors: Column) -> Column:
    return F.when(total > 0, errors / total).otherwise(0.0)


def run_status(total: Column, errors: Column) -> Column:
    return (
        F.when(errors == 0, "success")
        .when(error_rate(total, errors) <= WARNING_RATE, "warning")
        .otherwise("error")
    )


def run_message(item: str, done_label: str, total: Column, done: Column, errors: Column) -> Column:
    """``symbols total=10 success=9 errors=1 rate=0.1000``."""
    return F.concat(
        F.lit(f"{item} total="), total.cast("string"),
        F.lit(f" {done_label}="), done.cast("string"),
        F.lit(" errors="), errors.cast("string"),
        F.lit(" rate="), fixed_text(error_rate(total, errors), 4),
    )


def run_details(
    item: str, done_label: str, total: Column, done: Column, errors: Column, context: dict | None = None
) -> Column:
    """The same counters as JSON text, the rate to six decimals, after the run's ``context`` fields."""
    counters = F.struct(
        total.alias("total"), done.alias(done_label), errors.alias("errors"),
        error_rate(total, errors).cast("decimal(9,6)").alias("error_rate"),
    )
    fields = [F.lit(value).alias(name) for name, value in (context or {}).items()]
    return F.to_json(F.struct(*fields, counters.alias(item)))


def duration_ms(started: Column, ended: Column) -> Column:
    return ((F.unix_micros(ended) - F.unix_micros(started)) / 1000).cast("int")
