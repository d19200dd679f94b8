"""Run statistics: what went in, what came out, and the status that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickerloom.functions.reports import error_rate, run_details, run_message, run_status


def candidate_tickers(*statements: DataFrame) -> DataFrame:
    """All tickers that occur in any statement file, upper-cased."""
    tickers = [s.where("Ticker is not null").select(F.upper("Ticker").alias("ticker")) for s in statements]
    result = tickers[0]
    for part in tickers[1:]:
        result = result.union(part)
    return result.distinct()


def coverage_diff(candidates: DataFrame, loaded: DataFrame) -> DataFrame:
    """Candidate tickers for which nothing was loaded."""
    return candidates.join(loaded.select("ticker"), "ticker", "left_anti")


def _status_row(counts: DataFrame, item: str, done: str, context: dict | None = None) -> DataFrame:
    """One row with counters ``total``, ``done`` and ``errors`` -> the run's status row."""
    args = (F.col("total"), F.col("done"), F.col("errors"))
    return counts.select(
        "total",
        F.col("done").alias(done),
        "errors",
        error_rate(F.col("total"), F.col("errors")).alias("error_rate"),
        run_status(F.col("total"), F.col("errors")).alias("status"),
        run_message(item, done, *args).alias("message"),
        run_details(item, done, *args, context).alias("details"),
    )


def coverage_status(candidates: DataFrame, loaded: DataFrame, context: dict | None = None) -> DataFrame:
    """Tickers seen, loaded and missed, as one status row, in one grouping instead of a join."""
    seen = candidates.select("ticker", F.lit(0).alias("loaded"))
    return marked_status(seen.union(loaded.select("ticker", F.lit(1))), context)


def marked_status(marked: DataFrame, context: dict | None = None) -> DataFrame:
    """:func:`coverage_status` from (ticker, loaded) rows, loaded being 1 or 0."""
    per_ticker = marked.groupBy("ticker").agg(F.max("loaded").alias("loaded"))
    counts = per_ticker.agg(F.count("*").alias("total"), F.count_if(F.col("loaded") == 1).alias("done"))
    return _status_row(counts.withColumn("errors", F.col("total") - F.col("done")), "tickers", "inserted", context)


def outcome_status(outcomes: DataFrame) -> DataFrame:
    """One row per symbol with ``outcome`` inserted, skipped or error -> the run's status row.

    Skipped symbols (stale, or without a price) are neither successes nor errors.
    """
    counts = outcomes.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("outcome") == "inserted").alias("done"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
    )
    return _status_row(counts, "symbols", "success")


def symbol_outcomes(attempted: DataFrame, appended: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """What became of each attempted symbol of a price run."""
    marks = attempted.select("symbol", F.lit(0).alias("mark")).union(appended.select("symbol", F.lit(1)))
    if rejects is not None:
        marks = marks.union(rejects.select("symbol", F.lit(2)))
    best = F.max("mark")
    outcome = F.when(best == 2, "error").when(best == 1, "inserted").otherwise("skipped")
    return marks.groupBy("symbol").agg(outcome.alias("outcome"))


def dedup_stats(statements: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after de-duplication. Null keys count as a key, hence the struct."""
    return statements.agg(
        F.count("*").alias("concat_rows"), F.count_distinct(F.struct(*(f"`{k}`" for k in keys))).alias("dedup_rows")
    )


def inserted_per_statement(loaded: DataFrame) -> DataFrame:
    return loaded.groupBy("stmt_type").agg(F.count("*").alias("inserted_rows"))


class WriteCounts:
    """Counts taken by the pass that computes or writes a frame, so that no second scan counts anything."""

    def __init__(self):
        self._taken: list[Observation] = []

    def on(self, frame: DataFrame, **counts: Column) -> DataFrame:
        """``frame``, counted on its way; the frame returned has to be computed once."""
        self._taken.append(Observation())
        return frame.observe(self._taken[-1], *(value.alias(name) for name, value in counts.items()))

    def result(self) -> dict[str, int]:
        """The counts by name, summed where several frames have one. Waits for the frames to be computed."""
        total: dict[str, int] = {}
        for taken in self._taken:
            for name, value in taken.get.items():
                total[name] = total.get(name, 0) + (value or 0)
        return total


def counted_status(spark, item: str, done_label: str, total: int, done: int, errors: int, context: dict | None = None) -> DataFrame:
    """The status row of a run whose counters are known."""
    counters = spark.range(1).select(*(F.lit(v).cast("long").alias(n) for n, v in (("total", total), ("done", done), ("errors", errors))))
    return _status_row(counters, item, done_label, context)
