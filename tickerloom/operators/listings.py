"""Symbol lists: keys, multi-class issuers, suffix statistics, vendor-symbol lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.numbers import number
from tickerloom.functions.symbols import (
    is_filled,
    listing_suffix,
    market_code,
    root_ticker,
    strip,
    upper_trim,
    vendor_symbol,
)
from tickerloom.operators.bars import optional
from tickerloom.operators.ranking import last_per_key, top_per_key
from tickerloom.sources.files import require_columns


def multi_class_parents(listings: DataFrame, limit: int | None = None, position: tuple[str, ...] = ()) -> DataFrame:
    """Parents with more than one instrument, with the parent's first name; ``limit`` keeps the first by symbol."""
    name = (
        F.min_by("parent_name", F.struct(*position)) if position else F.min("parent_name")
    )
    counted = (
        listings.where("parent_symbol is not null")
        .groupBy("parent_symbol")
        .agg(F.count("*").alias("instruments"), name.alias("first_parent_name"))
        .where("instruments > 1")
    )
    return counted if limit is None else counted.orderBy("parent_symbol").limit(limit)


def variants_of_parents(listings: DataFrame, limit: int | None = None, position: tuple[str, ...] = ()) -> DataFrame:
    """The instruments of each multi-class parent, under the parent's first name."""
    parents = multi_class_parents(listings, limit, position).select("parent_symbol", "first_parent_name")
    return listings.join(parents, "parent_symbol").select("parent_symbol", "first_parent_name", "symbol", "name")


def with_suffix(listings: DataFrame) -> DataFrame:
    return listings.withColumn("suffix", listing_suffix(F.col("symbol")))


def suffix_counts(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """Symbols per suffix; ``limit`` keeps the most frequent."""
    counted = (
        listings.select(listing_suffix(F.col("symbol")).alias("suffix"))
        .where("suffix is not null")
        .groupBy("suffix")
        .agg(F.count("*").alias("symbols"))
    )
    return counted if limit is None else counted.orderBy(F.desc("symbols"), "suffix").limit(limit)


def exchange_totals(listings: DataFrame) -> DataFrame:
    return listings.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("exchange") == "TSX").alias("tsx"),
        F.count_if(F.col("exchange") == "TSXV").alias("tsxv"),
    )


def official_symbols(listings: DataFrame, position: list[str], cap: int | None = None) -> DataFrame:
    """Listed symbols with their vendor symbol; keys trimmed and upper-cased, blank symbols dropped.

    ``cap`` keeps the first listings in file order, for trial runs.
    """
    require_columns(listings, "symbol", "exchange", "parent_symbol")
    keyed = listings.where("symbol is not null and exchange is not null").select(
        upper_trim(F.col("symbol")).alias("symbol"),
        upper_trim(F.col("exchange")).alias("exchange"),
        upper_trim(F.col("parent_symbol")).alias("parent_symbol"),
        *position,
    )
    filled = keyed.where("symbol <> ''")
    if cap:
        filled = filled.orderBy(*position).limit(cap)
    return filled.withColumn("yahoo_symbol", vendor_symbol(F.col("symbol"), F.col("exchange")))


def vendor_symbol_map(official: DataFrame, position: list[str], keep_position: bool = False) -> DataFrame:
    """Vendor symbol -> listed symbol and market; the last listing of a vendor symbol wins."""
    return last_per_key(official, ["yahoo_symbol"], position).select(
        F.col("yahoo_symbol").alias("vendor_symbol"), "symbol", market_code(F.col("exchange")).alias("exchange"),
        *(position if keep_position else []),
    )


def to_listed_symbols(bars: DataFrame, symbol_map: DataFrame) -> DataFrame:
    """Bars under vendor symbols -> bars under listed symbols; unknown vendor symbols are dropped."""
    return bars.join(symbol_map, "vendor_symbol").drop("vendor_symbol")


def one_per_listing(bars: DataFrame, position: list[str]) -> DataFrame:
    """One bar per listed symbol: of a symbol listed on several exchanges the newest day, then the first listing.

    The table's key has the market, not the exchange, so a second bar of the day would break it.
    """
    order = [F.col("latest_day").desc(), *(F.col(p) for p in position)]
    return top_per_key(bars, ["symbol"], order).drop(*position)


def vendor_symbol_lookup(instrument_meta: DataFrame) -> DataFrame:
    """Stored vendor symbol per symbol, where there is one."""
    return instrument_meta.where("yahoo_symbol is not null").select("symbol", "yahoo_symbol")


def with_stored_vendor_symbol(frame: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add the stored vendor symbol; a symbol without one stands for itself."""
    joined = frame.join(lookup, "symbol", "left")
    return joined.withColumn("yahoo_symbol", F.coalesce("yahoo_symbol", "symbol"))


def issuer_rows(listings: DataFrame, position: list[str]) -> DataFrame:
    """Symbol list -> issuer rows; rows without symbol or exchange are dropped."""
    require_columns(listings, "symbol", "exchange", "name")
    rows = listings.select(
        strip(F.col("symbol")).alias("symbol"),
        root_ticker(F.col("symbol"), optional(listings, "parent_symbol")).alias("root_ticker"),
        strip(optional(listings, "co_id")).alias("co_id"),
        upper_trim(F.col("exchange")).alias("exchange"),
        strip(F.col("name")).alias("name"),
        number(optional(listings, "market_cap")).alias("market_cap"),
        number(optional(listings, "os_shares")).alias("os_shares"),
        strip(optional(listings, "source_sheet")).alias("source_sheet"),
        *position,
    )
    return rows.where(is_filled(F.col("symbol")) & is_filled(F.col("exchange")))


def issuer_scan(issuers: DataFrame, cap: int | None = None) -> DataFrame:
    """Issuers as lookup rows; ``cap`` keeps the first by symbol, for trial runs."""
    rows = issuers.select("symbol", F.lit("CA").alias("exchange"), "name")
    return rows.orderBy("symbol").limit(cap) if cap else rows
