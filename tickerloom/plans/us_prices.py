"""US prices: bulk price files -> bars to append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators import bars, coverage, gate, runlog
from tickerloom.operators.bars import BAR_COLUMNS
from tickerloom.operators.coverage import WriteCounts
from tickerloom.session import written_once
from tickerloom.sinks.gated import GatedTarget


def us_price_bars(prices: DataFrame, financials: DataFrame, position: list[str], variant: str = "latest") -> DataFrame:
    """One bar per US symbol that has statements.

    ``daily`` files carry history, so the previous close and the change come with the bar.
    Reducing to one row per symbol comes first and is cut before the shuffle; the universe and the
    gate then join the reduced rows on the same key.
    """
    rows = bars.bulk_bars(prices)
    timed = "DateTime" in prices.columns or "Timestamp" in prices.columns
    if variant.lower() == "daily":
        latest = bars.latest_with_previous(rows, position, timed)
    else:
        latest = bars.latest_only(rows, position)
    universe = gate.distinct_tickers(financials, "US").withColumnRenamed("ticker", "symbol")
    return bars.bulk_to_bars(gate.semi_join_universe(latest, universe))


def us_prices(
    prices: DataFrame, financials: DataFrame, stored: DataFrame, position: list[str], variant: str = "latest"
) -> DataFrame:
    """The bars newer than what ``stored`` holds per symbol; ``stored`` may be marks."""
    found = bars.require_price(us_price_bars(prices, financials, position, variant))
    return gate.gated_append(found, stored, "US").select(*BAR_COLUMNS)


def us_prices_by_time(
    prices: DataFrame, financials: DataFrame, stored: DataFrame, position: list[str], variant: str = "latest"
) -> tuple[DataFrame, DataFrame]:
    """``(rows to append, rejects)`` for a target with an ``as_of`` column.

    A bar that cannot be compared is rejected even if it has no price: the gate comes first. The bars,
    one per symbol, are computed once and written; both outputs and the look for times read them.
    """
    if not gate.has_times_stored(stored):
        accepted = us_prices(prices, financials, stored, position, variant)
        return accepted, accepted.where("false")
    found = written_once(us_price_bars(prices, financials, position, variant))
    accepted, rejects = gate.gate_by_time(found, stored, "US")
    return bars.require_price(accepted).select(*BAR_COLUMNS, "as_of"), rejects.select(*BAR_COLUMNS, "reason")


def us_prices_status(
    prices: DataFrame, financials: DataFrame, stored: DataFrame, position: list[str], variant: str = "latest"
) -> DataFrame:
    """The run's status row: symbols of the universe found, appended, and rejected as errors."""
    if not gate.has_times_stored(stored):
        found = us_price_bars(prices, financials, position, variant)
        return coverage.outcome_status(gate.gate_outcomes(found, stored, "US"))
    found = written_once(us_price_bars(prices, financials, position, variant))
    accepted, rejects = gate.gate_by_time(found, stored, "US")
    return coverage.outcome_status(coverage.symbol_outcomes(found, bars.require_price(accepted), rejects))


def us_prices_early_exit(financials: DataFrame) -> DataFrame | None:
    """The status row of a run that has nothing to load prices for, else None."""
    if gate.distinct_tickers(financials, "US").isEmpty():
        return runlog.plain_status(financials.sparkSession, "warning", "No US tickers found in financials table")
    return None


def us_prices_log(
    prices: DataFrame, financials: DataFrame, stored: DataFrame, position: list[str], variant: str = "latest"
) -> DataFrame:
    """The status row of a run, whether it has anything to load prices for or not."""
    early = us_prices_early_exit(financials)
    return us_prices_status(prices, financials, stored, position, variant) if early is None else early


def us_prices_load(
    prices: DataFrame, financials: DataFrame, target: GatedTarget, position: list[str], variant: str = "latest", context: dict | None = None
) -> DataFrame:
    """Append the bars past the target's marks; the run's status row, for the log.

    The target isn't read. Symbols, missing closes and appended bars are counted by the passes that write.
    """
    early = us_prices_early_exit(financials)
    if early is not None:
        return early
    spark, counts = prices.sparkSession, WriteCounts()
    found = us_price_bars(prices, financials, position, variant)
    missing = F.count_if(F.col("price").isNull())
    found = written_once(counts.on(found, symbols=F.count(F.lit(1)), missing_closes=missing))
    errors = 0
    if target.timed:
        _, rejects = gate.gate_by_time(found, target.marks(spark), "US")
        errors = rejects.count()  # of bars held once, against marks
    target.append(found, "US", counts=counts)
    taken = counts.result()
    details = {**(context or {}), "missing_closes": taken["missing_closes"]}
    return coverage.counted_status(spark, "symbols", "success", taken["symbols"], taken.get("appended", 0), errors, details)
