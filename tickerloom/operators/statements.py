"""Financial statements: wide vendor tables and tag matrices -> one long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.dates import lenient_day
from tickerloom.functions.numbers import first_parsed
from tickerloom.functions.symbols import is_filled
from tickerloom.operators.bars import optional

# Logical tag -> the vendor columns that may hold it, best first.
TAG_MAPS = {
    "IS": {
        "SharesOutstanding": ["Shares (Basic)", "Shares (Diluted)"],
        "Revenue": ["Revenue", "Total Revenue", "Sales"],
        "GrossProfit": ["Gross Profit"],
        "OperatingProfit": ["Operating Income (Loss)"],
        "NetIncome": ["Net Income", "Net Income (Common)"],
    },
    "BS": {
        "Equity": ["Total Equity"],
        "Liabilities": ["Total Liabilities"],
        "CashAndEquivalents": ["Cash, Cash Equivalents & Short Term Investments"],
        "Assets": ["Total Assets"],
    },
    "CF": {
        "OperatingCashFlow": [
            "Net Cash from Operating Activities",
            "Operating Cash Flow",
            "Cash From Operations",
            "Net Cash Provided by Operating Activities",
        ],
        "FreeCashFlow": ["Free Cash Flow"],
        "CapitalExpenditure": ["Capital Expenditures", "Capital Expenditure", "Purchase Of PPE"],
        "ChangeInCash": ["Change in Cash", "Changes In Cash", "Net Change in Cash"],
    },
}


def _tag_values(wide: DataFrame, stmt_type: str) -> list[Column]:
    """Each logical tag from its first vendor column that parses, null where the file has none."""
    values = []
    for tag, candidates in TAG_MAPS[stmt_type].items():
        present = [F.col(f"`{c}`") for c in candidates if c in wide.columns]
        values.append((first_parsed(*present) if present else F.lit(None).cast("double")).alias(tag))
    return values


def _empty(wide: DataFrame, columns: str) -> DataFrame:
    return wide.sparkSession.createDataFrame([], columns)


def kept_tags(wide: DataFrame, stmt_type: str) -> DataFrame:
    """Wide rows with what a load needs of them: ticker, filled (the ticker isn't blank), fy_end_date, unit and the tags.

    The day is null where it can't be read. A tag takes its first vendor column that parses. The currency
    defaults to USD only if the file has no such column.
    """
    return wide.select(
        F.upper("Ticker").alias("ticker"),
        is_filled(F.col("Ticker")).alias("filled"),
        lenient_day(optional(wide, "Report Date")).alias("fy_end_date"),
        optional(wide, "Currency", "USD").alias("unit"),
        *_tag_values(wide, stmt_type),
    )


def marks_of_kept(kept: DataFrame, stmt_type: str) -> DataFrame:
    """(ticker, loaded): every ticker of the rows, and 1 where :func:`rows_of_kept` would give a row for it."""
    gives = F.col("filled") & F.col("fy_end_date").isNotNull()
    loaded = F.coalesce(gives & F.coalesce(*TAG_MAPS[stmt_type]).isNotNull(), F.lit(False))
    return kept.where("ticker is not null").select("ticker", loaded.cast("int").alias("loaded"))


def rows_of_kept(kept: DataFrame, stmt_type: str, exchange: str = "US", source: str = "SimFin") -> DataFrame:
    """One row per statement and logical tag that has a value; blank tickers and unread days are skipped."""
    keyed = kept.where("filled").drop("filled")
    long = keyed.unpivot(["ticker", "fy_end_date", "unit"], list(TAG_MAPS[stmt_type]), "tag", "value")
    return long.where("fy_end_date is not null and value is not null").select(
        "ticker", F.lit(exchange).alias("exchange"), "fy_end_date", F.lit(stmt_type).alias("stmt_type"),
        "tag", "value", "unit", F.lit(source).alias("source"),
    )


def skipped_days(kept: DataFrame) -> Column:
    """How many rows are skipped for their day alone, as an aggregate of :func:`kept_tags`."""
    return F.count_if(kept["filled"] & kept["fy_end_date"].isNull())


def ticker_marks(wide: DataFrame, stmt_type: str) -> DataFrame:
    """:func:`marks_of_kept` of wide rows."""
    if "Ticker" not in wide.columns:
        return _empty(wide, "ticker string, loaded int")
    return marks_of_kept(kept_tags(wide, stmt_type), stmt_type)


def unpivot_tags(wide: DataFrame, stmt_type: str, exchange: str = "US", source: str = "SimFin") -> DataFrame:
    """:func:`rows_of_kept` of wide rows."""
    if "Ticker" not in wide.columns:
        return _empty(wide, "ticker string, exchange string, fy_end_date date, stmt_type string, tag string, value double, unit string, source string")
    return rows_of_kept(kept_tags(wide, stmt_type), stmt_type, exchange, source)


def first_source_cells(cells: DataFrame) -> DataFrame:
    """Keep, per symbol and statement, the cells of its best (lowest) API that has any.

    A window minimum would bring all cells of a symbol into one task. The minimum is aggregated
    with map-side combining instead and joined back, a join adaptive execution can split on skew.
    """
    keys = ["symbol", "stmt_type"]
    best = cells.groupBy(*keys).agg(F.min("api_priority").alias("api_priority"))
    return cells.join(best, [*keys, "api_priority"], "left_semi")


def most_recent_period(cells: DataFrame) -> DataFrame:
    """Cells of the first landed period, which the vendor puts first as the most recent."""
    return cells.where("period_ordinal = 0")


def statement_rows(cells: DataFrame, exchange: str = "CA", source: str = "yfinance") -> DataFrame:
    """Tag cells -> long statement rows. Cells without a value stay."""
    return cells.select(
        F.col("symbol").alias("ticker"), F.lit(exchange).alias("exchange"), "fy_end_date", "stmt_type",
        "tag", "value", F.lit(None).cast("string").alias("unit"), F.lit(source).alias("source"),
    )
