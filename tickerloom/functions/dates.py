"""Day and time coercion. Days are UTC calendar days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Numeric date forms as (pattern, its ISO spelling), month first where both readings are
# possible; years from 69 are of the last century, as in POSIX. Then the forms with a month's name, and quarters.
NUMERIC_DAYS = [
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](69|[7-9]\d)$", "19$3-$1-$2"),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{2})$", "20$3-$1-$2"),
]
NAMED_DAY = r"^((\d{1,2}[ -])?[A-Za-z]{3,9}[ -]\d{4}|\d{1,2}[ -][A-Za-z]{3,9}[ -]\d{2}|[A-Za-z]{3,9} \d{1,2},? \d{4})$"
QUARTER = r"^(\d{4})-?[Qq]([1-4])$"
MONTHS = "january february march april may june july august september october november december".split()
TIME_OF_DAY = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AaPp][Mm])?$"


def strict_day(text: Column) -> Column:
    """A day in any form :func:`lenient_day` reads; another text fails the query (ANSI cast)."""
    return F.coalesce(lenient_day(text), text.cast("date"))


def lenient_day(text: Column) -> Column:
    """A day from an ISO text or one of the forms above, with or without a time behind it; else null.

    Nearly all texts are ISO days. The other forms stand in a lambda, which Spark doesn't generate code for:
    spelled out in the generated method of a scan they make it too long for the JVM to compile.
    """
    other = F.get(F.transform(F.array(text), _other_day), F.lit(0))
    return F.coalesce(text.try_cast("date"), F.when(text.rlike("[0-9]"), other))


def _other_day(text: Column) -> Column:
    bare = F.regexp_replace(F.trim(text), TIME_OF_DAY, "")
    iso = bare
    for pattern, spelling in NUMERIC_DAYS:
        iso = F.regexp_replace(iso, pattern, spelling)
    day_first = F.regexp_replace(iso, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "$1-$3-$2")
    name = F.lower(F.regexp_extract(bare, "([A-Za-z]+)", 1))
    month = F.try_element_at(F.create_map(*(F.lit(x) for i, m in enumerate(MONTHS, 1) for x in dict.fromkeys((m, m[:3])) for x in (x, f"{i:02d}"))), name)
    day = F.regexp_extract(bare, r"(?:^|[A-Za-z] )(\d{1,2})(?:\D)", 1)  # a month without one begins with its first day
    year = F.regexp_replace(F.regexp_extract(bare, r"(\d+)$", 1), r"^(69|[7-9]\d)$", "19$1")
    year = F.regexp_replace(year, r"^(\d{2})$", "20$1")
    named = F.concat_ws("-", year, month, F.when(day == "", "01").otherwise(day))
    quarter = F.concat_ws("-", F.regexp_extract(bare, QUARTER, 1), (F.regexp_extract(bare, QUARTER, 2).try_cast("int") * 3 - 2).cast("string"), F.lit("01"))
    return F.coalesce(
        iso.try_cast("date"),
        F.when(bare.rlike(r"^\d{1,2}[/.-]"), day_first.try_cast("date")),
        F.when(bare.rlike(NAMED_DAY) & month.isNotNull(), named.try_cast("date")),
        F.when(bare.rlike(QUARTER), quarter.try_cast("date")),
    )


def unread_days(frame, text: str):
    """One row: how many filled texts :func:`lenient_day` can't read, for the log of a load that skips them."""
    filled = F.trim(F.col(f"`{text}`")) != ""
    return frame.agg(F.count_if(filled & lenient_day(F.col(f"`{text}`")).isNull()).alias("unread"))


def lenient_time(text: Column) -> Column:
    """A zone-less timestamp, null when the text is not one."""
    return text.try_cast("timestamp_ntz")


def as_of_time(columns: list[str]) -> Column:
    """The bar time: ``DateTime`` if the file has that column, else ``Timestamp``, else null."""
    for name in ("DateTime", "Timestamp"):
        if name in columns:
            return lenient_time(F.col(name))
    return F.lit(None).cast("timestamp_ntz")


def epoch_day(seconds: Column) -> Column:
    """The UTC day of an epoch second, independent of the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def first_epoch_day(*seconds: Column) -> Column:
    """:func:`epoch_day` of the first candidate that is neither null nor 0, else null."""
    return epoch_day(F.coalesce(*(F.nullif(s, F.lit(0)) for s in seconds)))
