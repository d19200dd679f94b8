"""Canadian listings: directory payloads -> symbol list -> issuers -> instrument types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators import instruments, listings, merge
from tickerloom.operators.ranking import last_per_key
from tickerloom.sources import files
from tickerloom.sources.payloads import flatten_directory


@dataclass
class Directory:
    symbols: DataFrame
    multi_class: DataFrame
    suffixes: DataFrame
    totals: DataFrame


def symbol_directory(senior: DataFrame, venture: DataFrame, keep: tuple[str, ...] = (), top: int | None = None) -> Directory:
    """Both exchanges' directory documents -> the symbol list and its statistics.

    Suffixes belong to the senior exchange's rows; the venture rows have none. ``top`` keeps the first
    so many multi-class parents, for a short report.
    """
    tsx = listings.with_suffix(flatten_directory(senior, "TSX", keep))
    tsxv = flatten_directory(venture, "TSXV", keep)
    place = (*keep, "company_no", "instrument_no")
    return Directory(
        symbols=tsx.unionByName(tsxv, allowMissingColumns=True),
        multi_class=listings.variants_of_parents(tsx, top, place),
        suffixes=listings.suffix_counts(tsx),
        totals=listings.exchange_totals(tsx.select("exchange").union(tsxv.select("exchange"))),
    )


def ca_issuers(symbol_list: DataFrame, stored: DataFrame, position: list[str]) -> DataFrame:
    """Issuers the table does not hold yet."""
    rows = merge.insert_if_absent(stored, listings.issuer_rows(symbol_list, position), "symbol", position)
    return rows.drop(*position)


def ca_instruments(issuers: DataFrame, infos: DataFrame, cap: int | None = None) -> DataFrame:
    """Instrument rows of the listed issuers that have an info payload, for an upsert by symbol."""
    found = _looked_up(issuers, infos, cap).where("info is not null")
    rows = instruments.classify_instruments(found, keep=("symbol", "exchange"))
    return rows.withColumn("yahoo_symbol", F.col("symbol"))


def _looked_up(issuers: DataFrame, infos: DataFrame, cap: int | None = None) -> DataFrame:
    """Every issuer with its info payload, null where the lookup delivered none."""
    return listings.issuer_scan(issuers, cap).drop("name").join(infos.select("symbol", "info"), "symbol", "left")


def ca_instrument_table(issuers: DataFrame, infos: DataFrame, stored: DataFrame, position: list[str], cap: int | None = None) -> DataFrame:
    """The new instrument table: found rows replace the stored ones of their symbol, of repeated payloads the last.

    The last payload per symbol is taken before it is parsed; the upsert finds one row per symbol.
    """
    last = last_per_key(infos, ["symbol"], position)
    return merge.upsert(stored, ca_instruments(issuers, last, cap).select(*stored.columns), "symbol", ["symbol"])


def ca_instruments_not_found(issuers: DataFrame, infos: DataFrame, cap: int | None = None) -> DataFrame:
    """Issuers looked up, and those for which nothing came back."""
    return instruments.not_found_count(_looked_up(issuers, infos, cap))


def ca_instruments_landed(issuers: DataFrame, infos: DataFrame, cap: int | None = None) -> DataFrame:
    """:func:`ca_instruments` from landed info payloads (:func:`files.read_payloads`), of repeated ones the last."""
    return ca_instruments(issuers, last_per_key(files.readable(infos), ["symbol"], files.POSITION), cap)
