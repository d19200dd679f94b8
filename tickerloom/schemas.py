"""Landing and target schemas.

Landed measures are STRING: files mix plain numbers, thousands separators and missing-value
texts, so every measure goes through an explicit coercion instead of schema inference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _text(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


_S, _D, _T = StringType(), DoubleType(), TimestampType()

# --- targets -----------------------------------------------------------------------------

FINANCIALS = _struct(
    ticker=_S, exchange=_S, fy_end_date=DateType(), stmt_type=_S, tag=_S, value=_D,
    unit=_S, source=_S, inserted_at=_T,
)
STOCK_PRICES = _struct(
    symbol=_S, exchange=_S, open=_D, high=_D, low=_D, price=_D, volume=LongType(),
    latest_day=DateType(), previous_close=_D, change=_D, change_percent=_S, inserted_at=_T,
)
STOCK_PRICES_AS_OF = StructType(STOCK_PRICES.fields + [StructField("as_of", TimestampNTZType())])
INSTRUMENT_META = _struct(
    symbol=_S, exchange=_S, yahoo_symbol=_S, quote_type=_S, asset_type=_S,
    is_etf=BooleanType(), is_mutual_fund=BooleanType(), is_closed_end_fund=BooleanType(),
    is_trust=BooleanType(), is_index=BooleanType(), category=_S, fund_family=_S, legal_type=_S,
    currency=_S, underlying_symbol=_S, nav_price=_D, expense_ratio=_D, total_assets=_D,
    **{"yield": _D}, ytd_return=_D, three_year_avg_return=_D, five_year_avg_return=_D, beta_3y=_D,
    long_name=_S, attributes=_S, updated_at=_T,
)
TMX_ISSUERS = _struct(
    symbol=_S, root_ticker=_S, co_id=_S, exchange=_S, name=_S, market_cap=_D, os_shares=_D,
    source_sheet=_S, inserted_at=_T,
)
INGEST_LOGS = _struct(
    script=_S, status=_S, message=_S, details=_S, started_at=_T, ended_at=_T,
    duration_ms=IntegerType(),
)

UNIQUE_KEYS = {
    "stock_prices": ["symbol", "latest_day", "exchange"],
    "tmx_issuers": ["symbol"],
    "instrument_meta": ["symbol"],
}
NOT_NULL = {
    "stock_prices": ["symbol", "exchange"],
    "tmx_issuers": ["symbol"],
    "instrument_meta": ["symbol"],
    "ingest_logs": ["script", "status"],
}
PARTITIONS = {"financials": ["exchange", "stmt_type"], "stock_prices": ["exchange"]}


def column_defaults(table: str) -> dict[str, Column]:
    """Values the target fills in when an incoming row does not carry the column."""
    return {
        "financials": {"inserted_at": F.current_timestamp()},
        "stock_prices": {"exchange": F.lit("US"), "inserted_at": F.current_timestamp()},
        "tmx_issuers": {"inserted_at": F.current_timestamp()},
        "instrument_meta": {"updated_at": F.current_timestamp()},
        "ingest_logs": {"started_at": F.current_timestamp()},
    }[table]


# --- landed inputs -----------------------------------------------------------------------

PRICES_BULK = _text("Ticker", "Date", "DateTime", "Open", "High", "Low", "Close", "Adj. Close", "Volume")
SYMBOL_LIST = _text("symbol", "name", "parent_symbol", "parent_name", "suffix", "exchange")
STATEMENT_MATRIX = StructType(
    [
        StructField("symbol", StringType()),
        StructField("stmt_type", StringType()),
        StructField("api_priority", IntegerType()),
        StructField("period_ordinal", IntegerType()),
        StructField("period_end", StringType()),
        StructField("tag", StringType()),
        StructField("value", StringType()),
    ]
)
DIRECTORY = StructType(
    [
        StructField(
            "results",
            ArrayType(
                StructType(
                    [
                        StructField("symbol", StringType()),
                        StructField("name", StringType()),
                        StructField("instruments", ArrayType(_text("symbol", "name"))),
                    ]
                )
            ),
        )
    ]
)
_QUOTE = _struct(
    symbol=_S, regularMarketPrice=_S, regularMarketOpen=_S, regularMarketDayHigh=_S,
    regularMarketDayLow=_S, regularMarketVolume=_S, regularMarketPreviousClose=_S,
    regularMarketTime=_S, postMarketTime=_S, preMarketTime=_S,
)
QUOTES = StructType(
    [
        StructField("quoteResponse", StructType([StructField("result", ArrayType(_QUOTE))])),
        StructField("quoteSummary", StructType([StructField("result", ArrayType(_QUOTE))])),
    ]
)
# Payload files: one response a line, led by the symbol it was asked for. Numbers stay text, as epochs and
# prices come as numbers, as texts and as NaN.
FAST_INFO = _text(
    "symbol", "lastPrice", "last_price", "regularMarketPrice", "open", "dayHigh", "regularMarketDayHigh", "dayLow", "regularMarketDayLow",
    "lastVolume", "regularMarketVolume", "regularMarketTime", "lastMarketTime",
)
HISTORY = StructType(
    [StructField("symbol", StringType()), StructField("history", ArrayType(_text("date", "Open", "High", "Low", "Close", "Volume")))]
)
INFO = _text("symbol", "info")  # the info object as JSON text
