"""Insert-if-newer: only bars past a symbol's stored high-water mark go in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def marks_of(rows: DataFrame) -> DataFrame:
    """Marks of price rows: exchange, symbol, last_seen and, where rows have times, seen_time."""
    time = [F.max("as_of").alias("seen_time")] if "as_of" in rows.columns else []
    return rows.groupBy("exchange", "symbol").agg(F.max("latest_day").alias("last_seen"), *time)


def merged_marks(marks: DataFrame) -> DataFrame:
    """One mark per exchange and symbol from several versions of them."""
    return marks.groupBy("exchange", "symbol").agg(*(F.max(n).alias(n) for n in ("last_seen", "seen_time") if n in marks.columns))


def is_marks(stored: DataFrame) -> bool:
    """True for marks, False for stored rows: the loads take either."""
    return "last_seen" in stored.columns


def has_times_stored(stored: DataFrame) -> bool:
    return "as_of" in stored.columns or "seen_time" in stored.columns


def latest_seen(stored: DataFrame, exchange: str, column: str = "latest_day") -> DataFrame:
    """High-water mark per symbol of one exchange, from stored rows or from marks."""
    own = stored.where(F.col("exchange") == exchange)
    if is_marks(stored):
        return own.select("symbol", "last_seen")
    return own.groupBy("symbol").agg(F.max(column).alias("last_seen"))


def newer_than_seen(bars: DataFrame, seen: DataFrame) -> DataFrame:
    """Keep bars of unseen symbols and bars after the mark; an equal day is not newer."""
    mark = F.col("last_seen")
    return bars.join(seen, "symbol", "left").where(mark.isNull() | (F.col("latest_day") > mark)).drop("last_seen")


def newer_than_seen_anti(bars: DataFrame, seen: DataFrame) -> DataFrame:
    """:func:`newer_than_seen` as an anti join, for callers that keep no column of ``seen``."""
    b, s = bars.alias("b"), seen.alias("s")
    stale = (F.col("b.symbol") == F.col("s.symbol")) & (F.col("b.latest_day") <= F.col("s.last_seen"))
    return b.join(s, stale, "left_anti")


def gated_append(bars: DataFrame, stored: DataFrame, exchange: str) -> DataFrame:
    """The bars of a run that are to be appended to ``stored``."""
    return newer_than_seen(bars, latest_seen(stored, exchange))


def gate_outcomes(bars: DataFrame, stored: DataFrame, exchange: str) -> DataFrame:
    """What the gate does with each symbol's bar, without computing the bars a second time to append."""
    judged = bars.join(latest_seen(stored, exchange), "symbol", "left")
    newer = F.col("last_seen").isNull() | (F.col("latest_day") > F.col("last_seen"))
    outcome = F.when(F.col("price").isNotNull() & newer, "inserted").otherwise("skipped")
    return judged.select("symbol", outcome.alias("outcome"))


def gate_by_time(
    bars: DataFrame, stored: DataFrame, exchange: str, timed_run: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Gate on ``as_of`` for a target that stores it: ``(accepted, rejects)``.

    As soon as one bar of the run has a time, bars are held against ``max(as_of)``. A bar without
    a time can then not be compared with a stored time and is rejected with a reason; it counts as
    an error. If no bar has a time the day decides. ``timed_run`` passes that in if known, which
    saves computing ``bars`` once more to look.
    """
    own = stored.where(F.col("exchange") == exchange)
    if is_marks(stored):
        marks = own.select("symbol", "seen_time", F.col("last_seen").alias("seen_day"))
    else:
        marks = own.groupBy("symbol").agg(F.max("as_of").alias("seen_time"), F.max("latest_day").alias("seen_day"))
    if timed_run is None:
        timed_run = has_times(bars).scalar()
    joined = bars.join(marks, "symbol", "left").withColumn("timed_run", timed_run)
    no_time = F.col("timed_run") & F.col("as_of").isNull() & F.col("seen_time").isNotNull()
    by_time = F.col("seen_time").isNull() | (F.col("as_of") > F.col("seen_time"))
    by_day = F.col("seen_day").isNull() | (F.col("latest_day") > F.col("seen_day"))
    accepted = ~no_time & F.when(F.col("timed_run"), by_time).otherwise(by_day)
    extra = ["seen_time", "seen_day", "timed_run"]
    rejects = joined.where(no_time).drop(*extra)
    return joined.where(accepted).drop(*extra), rejects.withColumn("reason", F.lit("bar has no time to compare"))


def has_times(bars: DataFrame) -> DataFrame:
    """One row: does any bar have a time?"""
    return bars.agg(F.coalesce(F.bool_or(F.col("as_of").isNotNull()), F.lit(False)).alias("timed"))


def semi_join_universe(frame: DataFrame, universe: DataFrame, key: str = "symbol") -> DataFrame:
    """Keep rows whose symbol is in the universe. Catalyst broadcasts the universe if it is small."""
    return frame.join(universe.select(key), key, "left_semi")


def distinct_tickers(financials: DataFrame, exchange: str = "US") -> DataFrame:
    """Tickers with statements on an exchange."""
    return financials.where(F.col("exchange") == exchange).select("ticker").distinct()

