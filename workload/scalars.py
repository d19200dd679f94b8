"""Column builders over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import dates, numbers, reports, symbols
from tickerloom.operators import bars, listings
from workload import duck
from workload.registry import query

c = F.col


@query(
    "drop_blank_keys",
    "SELECT ord, Ticker FROM income WHERE trim(Ticker) <> ''",
    "income",
)
def _(t):
    return t.income.select("ord", "Ticker").where(symbols.is_filled(c("Ticker")))


@query(
    "normalise_keys",
    """SELECT ord, upper(trim(symbol)) AS price_symbol, trim(symbol) AS issuer_symbol, upper(symbol) AS statement_symbol,
       upper(trim(exchange)) AS exchange, upper(trim(parent_symbol)) AS parent FROM symbol_list""",
    "symbol_list",
)
def _(t):
    return t.symbol_list.select(
        "ord",
        symbols.upper_trim(c("symbol")).alias("price_symbol"),
        symbols.strip(c("symbol")).alias("issuer_symbol"),
        F.upper("symbol").alias("statement_symbol"),
        symbols.upper_trim(c("exchange")).alias("exchange"),
        symbols.upper_trim(c("parent_symbol")).alias("parent"),
    )


_PRICE_KEY = ["ord", "ord_price", "ord_qty"]


@query(
    "coerce_number",
    f"""SELECT ord, ord_price, ord_qty, {duck.num('Open')} AS open, {duck.num('High')} AS high, {duck.num('Low')} AS low,
        {duck.num('Close')} AS close FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    return t.prices_bulk.select(*_PRICE_KEY, *(numbers.number(c(n)).alias(n.lower()) for n in ("Open", "High", "Low", "Close")))


@query(
    "coerce_number_strict",
    f"""SELECT ord, ord_price, ord_qty, {duck.strict_num('High')} AS high, {duck.strict_num('Close')} AS close FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    return t.prices_bulk.select(*_PRICE_KEY, *(numbers.number_strict(c(n)).alias(n.lower()) for n in ("High", "Close")))


@query(
    "pick_first_parsed",
    f"""SELECT ord, ord_price, ord_qty, coalesce({duck.num('Close')}, {duck.num('"Adj. Close"')}) AS close FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    return t.prices_bulk.select(*_PRICE_KEY, numbers.first_parsed(c("Close"), c("`Adj. Close`")).alias("close"))


@query(
    "pick_first_raw",
    f"""SELECT ord, ord_price, ord_qty, {duck.num('coalesce(Close, "Adj. Close")')} AS close FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    return t.prices_bulk.select(*_PRICE_KEY, numbers.first_raw(c("Close"), c("`Adj. Close`")).alias("close"))


@query(
    "truthy_coalesce",
    """SELECT ord, CASE WHEN "lastPrice" <> 0 THEN "lastPrice" WHEN last_price <> 0 THEN last_price ELSE "regularMarketPrice" END AS price,
       CASE WHEN "dayHigh" <> 0 THEN "dayHigh" ELSE "regularMarketDayHigh" END AS high,
       CASE WHEN "lastVolume" <> 0 THEN "lastVolume" ELSE "regularMarketVolume" END AS volume FROM fast_info_rows""",
    "fast_info_rows",
)
def _(t):
    return t.fast_info_rows.select(
        "ord",
        numbers.first_truthy(c("lastPrice"), c("last_price"), c("regularMarketPrice")).alias("price"),
        numbers.first_truthy(c("dayHigh"), c("regularMarketDayHigh")).alias("high"),
        numbers.first_truthy(c("lastVolume"), c("regularMarketVolume")).alias("volume"),
    )


@query(
    "optional_columns",
    """SELECT ord, "Currency" AS unit, 'USD' AS assumed_unit, CAST(NULL AS VARCHAR) AS sheet FROM income""",
    "income",
)
def _(t):
    wide = t.income
    bare = wide.drop("Currency")
    return wide.select(
        "ord",
        bars.optional(wide, "Currency", "USD").alias("unit"),
        bars.optional(bare, "Currency", "USD").alias("assumed_unit"),
        bars.optional(wide, "source_sheet").alias("sheet"),
    )


@query(
    "lenient_dates",
    f"""SELECT ord, {duck.day('"Report Date"')} AS fy_end_date FROM income""",
    "income",
)
def _(t):
    return t.income.select("ord", dates.lenient_day(c("Report Date")).alias("fy_end_date"))


@query(
    "strict_dates",
    """SELECT ord, ord_price, ord_qty, CAST("Date" AS DATE) AS latest_day FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    return t.prices_bulk.select(*_PRICE_KEY, dates.strict_day(c("Date")).alias("latest_day"))


@query(
    "as_of_timestamp",
    """SELECT ord, ord_price, ord_qty, try_cast("DateTime" AS TIMESTAMP) AS as_of FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    prices = t.prices_bulk
    return prices.select(*_PRICE_KEY, dates.as_of_time(prices.columns).alias("as_of"))


@query(
    "epoch_to_day",
    """SELECT ord, CAST(make_timestamp(CASE WHEN "regularMarketTime" <> 0 THEN "regularMarketTime"
       WHEN "lastMarketTime" <> 0 THEN "lastMarketTime" END * 1000000) AS DATE) AS latest_day FROM fast_info_rows""",
    "fast_info_rows",
)
def _(t):
    return t.fast_info_rows.select(
        "ord", dates.first_epoch_day(c("regularMarketTime"), c("lastMarketTime")).alias("latest_day")
    )


@query(
    "drop_all_null_bars",
    """SELECT ord, "Open", "Close", "Volume" FROM history
       WHERE NOT ("Open" IS NULL AND "Close" IS NULL AND "Volume" IS NULL)""",
    "history",
)
def _(t):
    sparse = t.history.select("ord", "Open", "Close", "Volume", *(F.lit(None).cast("double").alias(n) for n in ("High", "Low")))
    return bars.drop_empty_bars(sparse).drop("High", "Low")


@query(
    "volume_to_long",
    f"""SELECT ord, ord_price, ord_qty, {duck.volume(duck.num('"Volume"'))} AS volume FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    return t.prices_bulk.select(*_PRICE_KEY, numbers.whole_volume(numbers.number(c("Volume"))).alias("volume"))


@query(
    "require_close",
    """SELECT ord, symbol, "Close" AS price FROM history WHERE "Close" IS NOT NULL""",
    "history",
)
def _(t):
    return bars.require_price(t.history.select("ord", "symbol", c("Close").alias("price")))


@query(
    "root_ticker",
    """SELECT ord, CASE WHEN parent_symbol IS NULL THEN trim(symbol) WHEN trim(parent_symbol) <> '' THEN trim(parent_symbol)
       ELSE split_part(trim(symbol), '.', 1) END AS root_ticker FROM symbol_list""",
    "symbol_list",
)
def _(t):
    return t.symbol_list.select("ord", symbols.root_ticker(c("symbol"), c("parent_symbol")).alias("root_ticker"))


@query("market_code", "SELECT ord, 'CA' AS market FROM symbol_list", "symbol_list")
def _(t):
    return t.symbol_list.select("ord", symbols.market_code(c("exchange")).alias("market"))


@query(
    "tmx_to_yahoo",
    f"WITH {duck.OFFICIAL} SELECT symbol, exchange, parent_symbol, ord, yahoo_symbol FROM official",
    "symbol_list",
)
def _(t):
    return listings.official_symbols(t.symbol_list, ["ord"])


_SUFFIX = "CASE WHEN ex IN ('TSX') THEN '.TO' WHEN ex = 'TSXV' THEN '.V' WHEN ex = 'NEO' THEN '.NE' ELSE '' END"


@query(
    "yahoo_symbol",
    f"""SELECT ord, CASE WHEN root = '' THEN '' ELSE concat(replace(root, '.', '-'), {_SUFFIX}) END AS vendor
        FROM (SELECT ord, upper(trim(coalesce(symbol, ''))) AS root, upper(trim(coalesce(exchange, ''))) AS ex FROM symbol_list)""",
    "symbol_list",
)
def _(t):
    return t.symbol_list.select("ord", symbols.hyphenated_root_with_suffix(c("symbol"), c("exchange")).alias("vendor"))


@query(
    "tmx_symbol",
    f"""SELECT ord, concat(root, {_SUFFIX}) AS vendor
        FROM (SELECT ord, upper(trim(coalesce(symbol, ''))) AS root, upper(trim(coalesce(exchange, ''))) AS ex FROM symbol_list)""",
    "symbol_list",
)
def _(t):
    return t.symbol_list.select("ord", symbols.root_with_suffix(c("symbol"), c("exchange")).alias("vendor"))


@query(
    "yahoo_base",
    """SELECT ord, CASE WHEN contains(s, '.') THEN concat(replace(left(s, length(s) - length(split_part(s, '.', -1)) - 1), '.', '-'),
       '.', split_part(s, '.', -1)) ELSE s END AS base FROM (SELECT ord, coalesce(symbol, '') AS s FROM symbol_list)""",
    "symbol_list",
)
def _(t):
    return t.symbol_list.select("ord", symbols.hyphenate_classes(c("symbol")).alias("base"))


@query(
    "yahoo_variants",
    f"""WITH {duck.OFFICIAL} SELECT ord, concat(split_part(yahoo_symbol, '.', 1), s, substr(yahoo_symbol, strpos(yahoo_symbol, '.'))) AS variant
        FROM official, (VALUES ('-UN'), ('-U')) v(s) WHERE contains(yahoo_symbol, '.')""",
    "symbol_list",
)
def _(t):
    official = listings.official_symbols(t.symbol_list, ["ord"])
    return official.select("ord", F.explode(symbols.unit_variants(c("yahoo_symbol"))).alias("variant"))


@query(
    "yahoo_variants_all",
    """WITH y AS (SELECT ord, concat(upper(trim(symbol)), '.TO') AS y, lower(name) AS n FROM symbol_list WHERE symbol IS NOT NULL),
       h AS (SELECT ord, y, list_concat(CASE WHEN n LIKE '%reit%' OR n LIKE '%trust%' OR n LIKE '%fund%' THEN ['-UN','-U'] ELSE []::VARCHAR[] END,
         CASE WHEN n LIKE '%class b%' THEN ['-B'] ELSE []::VARCHAR[] END, CASE WHEN n LIKE '%class a%' THEN ['-A'] ELSE []::VARCHAR[] END,
         ['-B','-A','-X','-Y']) AS l FROM y),
       p AS (SELECT ord, y, unnest(l) AS s, unnest(range(len(l))) AS pos FROM h),
       f AS (SELECT ord, y, s, min(pos) AS pos FROM p GROUP BY ALL)
       SELECT ord, CAST(row_number() OVER (PARTITION BY ord ORDER BY pos) - 1 AS INTEGER) AS place,
         concat(left(y, length(y) - 3), s, '.TO') AS variant FROM f""",
    "symbol_list",
)
def _(t):
    named = t.symbol_list.where("symbol is not null")
    vendor = F.concat(symbols.upper_trim(c("symbol")), F.lit(".TO"))
    return named.select("ord", F.posexplode(symbols.class_variants(vendor, c("name"))).alias("place", "variant"))


@query(
    "suffix_extract",
    r"SELECT ord, nullif(regexp_extract(symbol, '\.([A-Z]+)$', 1), '') AS suffix FROM symbol_list",
    "symbol_list",
)
def _(t):
    return listings.with_suffix(t.symbol_list).select("ord", "suffix")


@query(
    "price_change",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice AS price, prev, {duck.change('l_extendedprice', 'prev')} AS change,
        {duck.change_percent('l_extendedprice', 'prev')} AS change_percent
        FROM (SELECT *, CASE WHEN l_quantity = 13 THEN NULL ELSE (l_quantity - 17) * 1000 END AS prev FROM lineitem)""",
)
def _(t):
    rows = t.base("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice as price",
        "case when l_quantity = 13 then null else (l_quantity - 17) * 1000 end as prev",
    )
    return rows.withColumns(
        {
            "change": reports.price_change(c("price"), c("prev")),
            "change_percent": reports.price_change_percent(c("price"), c("prev")),
        }
    )


_PER_SCRIPT = """SELECT l_partkey, count(*) AS total, count(*) FILTER (l_quantity > 2) AS done,
   count(*) FILTER (l_quantity <= 2) AS errors FROM lineitem GROUP BY l_partkey"""


def _counters(t):
    return t.base("lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("total"),
        F.count_if(c("l_quantity") > 2).alias("done"),
        F.count_if(c("l_quantity") <= 2).alias("errors"),
    )


@query(
    "run_status",
    f"SELECT l_partkey, total, errors, {duck.status('total', 'errors')} AS status FROM ({_PER_SCRIPT})",
)
def _(t):
    return _counters(t).select("l_partkey", "total", "errors", reports.run_status(c("total"), c("errors")).alias("status"))


@query(
    "run_message",
    f"""SELECT l_partkey, {duck.message('symbols', 'success', 'total', 'done', 'errors')} AS message,
        {duck.details('symbols', 'success', 'total', 'done', 'errors')} AS details FROM ({_PER_SCRIPT})""",
)
def _(t):
    counters = (c("total"), c("done"), c("errors"))
    return _counters(t).select(
        "l_partkey",
        reports.run_message("symbols", "success", *counters).alias("message"),
        reports.run_details("symbols", "success", *counters).alias("details"),
    )
