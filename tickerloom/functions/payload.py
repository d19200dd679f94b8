"""Reading loosely typed JSON values.

A payload field may hold a boolean, a number or a text, and ``false`` and ``"false"`` mean
different things, so fields are parsed as VARIANT and judged by their JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom.functions.numbers import number_strict

_EMPTY_JSON = ["null", "false", '""', "[]", "{}"]


def json_text(value: Column) -> Column:
    """The JSON spelling of a VARIANT: texts keep their quotes."""
    return F.to_json(value)


def text_value(value: Column) -> Column:
    """A VARIANT as plain text, null for JSON null."""
    return F.try_variant_get(value, "$", "string")


def is_truthy(value: Column) -> Column:
    """False for null, false, 0, and empty text, list or object; true otherwise."""
    spelled = json_text(value)
    judged = ~spelled.isin(_EMPTY_JSON) & F.coalesce(spelled.try_cast("double") != 0, F.lit(True))
    return F.coalesce(judged, F.lit(False))


def number_value(value: Column) -> Column:
    """A VARIANT as DOUBLE: numbers, number texts, and 1 or 0 for booleans; else null."""
    spelled = json_text(value)
    return (
        F.when(spelled == "true", 1.0)
        .when(spelled == "false", 0.0)
        .when(spelled.startswith('"'), number_strict(text_value(value)))
        .otherwise(spelled.try_cast("double"))
    )
