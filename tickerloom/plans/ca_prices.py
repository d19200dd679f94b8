"""Canadian prices: quotes, panels, or fast info with history as fallback -> bars to append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.operators import bars, coverage, gate, listings
from tickerloom.operators.bars import BAR_COLUMNS
from tickerloom.sources import files, payloads


def _append(found: DataFrame, symbol_list: DataFrame, stored: DataFrame, position: list[str]) -> DataFrame:
    symbol_map = listings.vendor_symbol_map(listings.official_symbols(symbol_list, position), position, keep_position=True)
    listed = listings.one_per_listing(listings.to_listed_symbols(found, symbol_map), position)
    return gate.gated_append(listed, stored, "CA").select(*BAR_COLUMNS)


def ca_prices_quotes(symbol_list: DataFrame, quotes: DataFrame, stored: DataFrame, position: list[str]) -> DataFrame:
    """From flattened quotes, one per vendor symbol."""
    return _append(bars.quote_bars(quotes), symbol_list, stored, position)


def ca_prices_panel(
    symbol_list: DataFrame, panel: DataFrame, stored: DataFrame, position: list[str], panel_position: tuple[str, ...] = ()
) -> DataFrame:
    """From long panel rows (``ticker``, ``date``, OHLCV); ``panel_position`` orders panels that overlap."""
    return _append(bars.panel_bars(panel, position=panel_position), symbol_list, stored, position)


def ca_prices_fallback(
    symbol_list: DataFrame,
    fast_infos: DataFrame,
    history: DataFrame,
    stored: DataFrame,
    position: list[str],
    history_position: list[str],
    today: Column | None = None,
) -> DataFrame:
    """From fast info, else the last history bar. This path computes no change columns."""
    fast = bars.fast_info_bars(fast_infos, F.current_date() if today is None else today)
    found = bars.first_source_bars(fast, bars.history_bars(history, history_position))
    blank = {"previous_close": "double", "change": "double", "change_percent": "string"}
    return _append(
        found.withColumns({n: F.lit(None).cast(t) for n, t in blank.items()}), symbol_list, stored, position
    )


def ca_prices_fallback_landed(
    symbol_list: DataFrame, fast_infos: DataFrame, history: DataFrame, stored: DataFrame, position: list[str], today: Column | None = None
) -> DataFrame:
    """:func:`ca_prices_fallback` from landed payload lines (:func:`files.read_payloads`); broken lines are passed over."""
    fast = payloads.flatten_fast_info(files.readable(fast_infos), files.POSITION)
    rows = payloads.flatten_history(files.readable(history), files.POSITION)
    return ca_prices_fallback(symbol_list, fast, rows, stored, position, [*files.POSITION, "place"], today)


def ca_prices_status(symbol_list: DataFrame, appended: DataFrame, position: list[str], broken: DataFrame | None = None) -> DataFrame:
    """The status row of a Canadian price run, whichever input it had.

    Attempted are the listed symbols. Those with an appended bar are successes; those whose payload was
    broken (``broken``: rejects of :func:`files.rejects`, by vendor symbol) and that have no bar are errors; the
    others, stale or without a price, are skipped. ``appended`` should be the rows written, not a plan.
    """
    symbol_map = listings.vendor_symbol_map(listings.official_symbols(symbol_list, position), position)
    marks = symbol_map.select("symbol", F.lit(0).alias("mark")).union(appended.select("symbol", F.lit(2)))
    if broken is not None:
        named = broken.where("symbol is not null").select(F.col("symbol").alias("vendor_symbol")).distinct()
        marks = marks.union(listings.to_listed_symbols(named, symbol_map).select("symbol", F.lit(1)))
    best = F.max("mark")
    outcome = F.when(best == 2, "inserted").when(best == 1, "error").otherwise("skipped")
    return coverage.outcome_status(marks.groupBy("symbol").agg(outcome.alias("outcome")))
