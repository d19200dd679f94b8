"""Nested vendor payloads -> flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.functions.dates import lenient_day
from tickerloom.functions.numbers import number, payload_number, whole_volume
from tickerloom.operators.ranking import last_per_key


def flatten_directory(documents: DataFrame, exchange: str | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Listing directory JSON in ``payload`` -> one row per instrument with its parent.

    Missing texts become ``''``; instruments without a symbol are dropped; a document without
    results gives no rows. ``keep`` passes document columns through. ``position`` orders the
    instruments of a document.
    """
    exchange = F.lit(exchange) if isinstance(exchange, str) else exchange
    parsed = documents.select(*keep, exchange.alias("exchange"), F.from_json("payload", schemas.DIRECTORY).alias("d"))
    companies = parsed.select(*keep, "exchange", F.posexplode("d.results").alias("company_no", "company"))
    listed = companies.select(
        *keep, "exchange", "company_no", "company.symbol", "company.name",
        F.posexplode("company.instruments").alias("instrument_no", "instrument"),
    )
    blank = F.lit("")
    return listed.where(F.col("instrument.symbol") != "").select(
        *keep,
        F.col("instrument.symbol").alias("symbol"),
        F.coalesce("instrument.name", blank).alias("name"),
        F.coalesce("symbol", blank).alias("parent_symbol"),
        F.coalesce("name", blank).alias("parent_name"),
        "exchange",
        "company_no",
        "instrument_no",
    )


def flatten_quotes(documents: DataFrame, position: list[str]) -> DataFrame:
    """Quote JSON in ``payload`` -> the last quote of each symbol.

    A document lists its quotes under ``quoteResponse`` or, if that is empty, ``quoteSummary``.
    ``position`` names the columns that order the documents.
    """
    parsed = documents.select(*position, F.from_json("payload", schemas.QUOTES).alias("d"))
    response, summary = F.col("d.quoteResponse.result"), F.col("d.quoteSummary.result")
    quotes = parsed.select(*position, F.posexplode(F.when(F.size(response) > 0, response).otherwise(summary)).alias("place", "q"))
    rows = quotes.where(F.col("q.symbol") != "").select(*position, "place", "q.*")
    last = last_per_key(rows, ["symbol"], [*position, "place"])
    return last.select(
        "symbol",
        *(
            number(F.col(f"regularMarket{f}")).alias(f"regularMarket{f}")
            for f in ("Price", "Open", "DayHigh", "DayLow", "Volume", "PreviousClose")
        ),
        # epochs come as whole numbers, as 1704067200.0 and as text
        *(whole_volume(number(F.col(f"{f}MarketTime"))).alias(f"{f}MarketTime") for f in ("regular", "post", "pre")),
    )


BAR_FIELDS = ["Open", "High", "Low", "Close", "Volume"]


def panel_to_long(panel: DataFrame, day: str = "date", sep: str = "|", ticker: str | None = None) -> DataFrame:
    """Wide price panel -> one OHLCV row per day and ticker.

    Columns are named ``<ticker><sep><field>``. A panel of one ticker has bare field columns and
    takes its name from ``ticker``. The tickers come from the header, so the reshape is one narrow
    explode of per-ticker structs, without the shuffle an unpivot and pivot back would need.
    """
    if ticker is not None:
        return panel.select(F.lit(ticker).alias("ticker"), day, *BAR_FIELDS)
    tickers = dict.fromkeys(c.rsplit(sep, 1)[0] for c in panel.columns if sep in c)
    bars = F.array(
        *(
            F.struct(F.lit(t).alias("ticker"), *(F.col(f"`{t}{sep}{f}`").alias(f) for f in BAR_FIELDS))
            for t in tickers
        )
    )
    return panel.select(day, F.explode(bars).alias("bar")).select("bar.ticker", day, *(f"bar.{f}" for f in BAR_FIELDS))


#: Commas outside quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _fields(line: Column) -> Column:
    """The fields of a CSV line, without their quotes."""
    bare = lambda x: F.replace(F.regexp_replace(x, '^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
    return F.transform(F.split(line, _COMMA, -1), bare)


def matrix_cells(matrices: DataFrame) -> DataFrame:
    """Statement matrices (``payload``: CSV text) -> one row per cell, in the columns of :data:`schemas.STATEMENT_MATRIX`.

    The first line has the period ends, the first field of every other line a tag. Files differ in their
    periods, so columns are found per file: a cell's ``period_ordinal`` is the place of its column. A line
    may end early; cells beyond the header are left out. A field cannot hold a line break.
    """
    lines = F.filter(F.split("payload", r"\r?\n"), lambda line: F.trim(line) != "")
    found = matrices.select("symbol", "stmt_type", "api_priority", lines.alias("lines"))
    # explode the tags first and split a line once, whatever its length
    rows = found.select(
        "symbol", "stmt_type", "api_priority", _fields(F.get("lines", F.lit(0))).alias("periods"),
        F.explode(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).alias("line"),
    )
    cells = rows.select("symbol", "stmt_type", "api_priority", "periods", _fields(F.col("line")).alias("fields"))
    cells = cells.select(
        "symbol", "stmt_type", "api_priority", F.get("fields", F.lit(0)).alias("tag"), "fields",
        F.posexplode(F.slice("periods", 2, F.greatest(F.size("periods") - 1, F.lit(0)))).alias("period_ordinal", "period_end"),
    )
    value = F.nullif(F.get("fields", F.col("period_ordinal") + 1), F.lit(""))
    return cells.withColumn("value", value).select(*(F.col(f.name).cast(f.dataType) for f in schemas.STATEMENT_MATRIX.fields))


def statement_cells(matrix: DataFrame) -> DataFrame:
    """Landed statement matrix as text cells -> typed cells; unreadable period ends become null."""
    return matrix.select(
        "symbol", "stmt_type", "api_priority", "period_ordinal",
        lenient_day(F.col("period_end")).alias("fy_end_date"),
        "tag",
        number(F.col("value")).alias("value"),
    )


def flatten_fast_info(payloads: DataFrame, position: list[str]) -> DataFrame:
    """Fast-info payloads -> the last one of each symbol, typed; ``position`` orders them.

    Prices keep NaN, which is a value to the rule that takes the first truthy field. Volumes and epochs
    come as whole numbers, as 1704067200.0 and as text.
    """
    last = last_per_key(payloads, ["symbol"], position)
    whole = {"lastVolume", "regularMarketVolume", "regularMarketTime", "lastMarketTime"}
    fields = [f.name for f in schemas.FAST_INFO.fields if f.name != "symbol"]
    typed = {n: whole_volume(number(F.col(n))) if n in whole else payload_number(F.col(n)) for n in fields}
    return last.select("symbol", *(typed[n].alias(n) for n in fields))


def flatten_history(payloads: DataFrame, position: list[str]) -> DataFrame:
    """History payloads -> one row per symbol and bar, typed, with ``position`` and the bar's ``place``.

    The day is that of the text, whatever its offset; a bar without a readable day is left out.
    """
    rows = payloads.select("symbol", *position, F.posexplode("history").alias("place", "bar"))
    typed = rows.select(
        "symbol", F.col("bar.date").try_cast("date").alias("date"), *(payload_number(F.col(f"bar.{f}")).alias(f) for f in BAR_FIELDS), *position, "place"
    )
    return typed.where("date is not null")
