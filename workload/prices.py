"""Price operators and loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.operators import bars, gate, listings, ranking
from tickerloom.plans import ca_prices, us_prices
from tickerloom.sources import payloads
from workload import duck
from workload.registry import Tables, query

POSITION = ["ord", "ord_price", "ord_qty"]
LANDED = "ord DESC, ord_price DESC, ord_qty DESC"
c = F.col

BARS = """bars AS (
  SELECT upper("Ticker") AS symbol, CAST("Date" AS DATE) AS latest_day, try_cast("DateTime" AS TIMESTAMP) AS as_of,
         "Open", "High", "Low", "Close", "Adj. Close", "Volume", ord, ord_price, ord_qty FROM prices_bulk)"""
LATEST = f"""latest AS (
  SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY latest_day DESC, as_of DESC NULLS FIRST, {LANDED}) = 1)"""
PREVIOUS = f"""previous AS (
  SELECT symbol, {duck.num('coalesce("Close", "Adj. Close")')} AS previous_close FROM
    (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY latest_day DESC, {LANDED}) AS age FROM bars) WHERE age = 2)"""
TYPED = f"""{duck.num('"Open"')} AS open, {duck.num('"High"')} AS high, {duck.num('"Low"')} AS low,
  {duck.num('coalesce("Close", "Adj. Close")')} AS price, {duck.volume(duck.num('"Volume"'))} AS volume, latest_day"""
UNIVERSE = "universe AS (SELECT DISTINCT ticker AS symbol FROM financials_stored WHERE exchange = 'US')"
SEEN = "seen AS (SELECT symbol, max(latest_day) AS last_seen FROM stored_us WHERE exchange = 'US' GROUP BY symbol)"
SEEN_CA = "seen AS (SELECT symbol, max(latest_day) AS last_seen FROM {} WHERE exchange = 'CA' GROUP BY symbol)"
OUT = f"""symbol, exchange, open, high, low, price, volume, latest_day, previous_close,
  {duck.change('price', 'previous_close')} AS change, {duck.change_percent('price', 'previous_close')} AS change_percent"""


def _us(previous: str) -> str:
    return f"""WITH {BARS}, {LATEST}, {PREVIOUS}, {UNIVERSE}, {SEEN},
      typed AS (SELECT symbol, 'US' AS exchange, {TYPED}, {previous} AS previous_close FROM latest LEFT JOIN previous USING (symbol))
      SELECT {OUT} FROM typed SEMI JOIN universe USING (symbol) LEFT JOIN seen USING (symbol)
      WHERE price IS NOT NULL AND (last_seen IS NULL OR latest_day > last_seen)"""


US_VIEWS = "prices_bulk financials_stored stored_us"


@query("us_prices_daily", _us("previous_close"), US_VIEWS)
def us_prices_daily(t: Tables):
    return us_prices.us_prices(t.prices_bulk, t.financials_stored, t.stored_us, POSITION, "daily")


@query("us_prices_latest", _us("CAST(NULL AS DOUBLE)"), US_VIEWS)
def _(t):
    return us_prices.us_prices(t.prices_bulk, t.financials_stored, t.stored_us, POSITION, "latest")


@query(
    "us_prices_daily_untimed",
    _us("previous_close").replace('try_cast("DateTime" AS TIMESTAMP)', "CAST(NULL AS TIMESTAMP)"),
    US_VIEWS,
)
def _(t):
    return us_prices.us_prices(t.prices_bulk.drop("DateTime"), t.financials_stored, t.stored_us, POSITION, "daily")


BY_TIME = f"""WITH {BARS}, {LATEST}, {PREVIOUS}, {UNIVERSE},
  marks AS (SELECT symbol, max(latest_day + INTERVAL 10 HOUR) AS seen_time, max(latest_day) AS seen_day FROM stored_us WHERE exchange = 'US' GROUP BY symbol),
  typed AS (SELECT symbol, 'US' AS exchange, {TYPED}, as_of, previous_close FROM latest LEFT JOIN previous USING (symbol)),
  found AS (SELECT * FROM typed SEMI JOIN universe USING (symbol)),
  judged AS (SELECT *, (SELECT bool_or(as_of IS NOT NULL) FROM found) AS timed FROM found LEFT JOIN marks USING (symbol))"""


def stored_with_times(t):
    return t.stored_us.withColumn("as_of", c("latest_day").cast("timestamp_ntz") + F.expr("interval 10 hours"))


def _by_time(t):
    return us_prices.us_prices_by_time(t.prices_bulk, t.financials_stored, stored_with_times(t), POSITION, "daily")


@query(
    "us_prices_by_time",
    f"""{BY_TIME} SELECT {OUT}, as_of FROM judged WHERE price IS NOT NULL AND CASE WHEN timed THEN seen_time IS NULL OR as_of > seen_time
        ELSE seen_day IS NULL OR latest_day > seen_day END""",
    US_VIEWS,
)
def _(t):
    return _by_time(t)[0]


@query(
    "us_prices_rejects",
    f"""{BY_TIME} SELECT {OUT}, 'bar has no time to compare' AS reason FROM judged
        WHERE timed AND as_of IS NULL AND seen_time IS NOT NULL""",
    US_VIEWS,
)
def _(t):
    return _by_time(t)[1]


@query("latest_bar", f"WITH {BARS}, {LATEST} SELECT * FROM latest", "prices_bulk")
def _(t):
    return bars.latest_bar(bars.bulk_bars(t.prices_bulk), POSITION)


@query(
    "last_two_bars",
    f"""WITH {BARS} SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY latest_day DESC, {LANDED}) AS INTEGER) AS age
        FROM bars QUALIFY age <= 2""",
    "prices_bulk",
)
def _(t):
    return bars.last_two_bars(bars.bulk_bars(t.prices_bulk), POSITION)


@query(
    "prev_close_join",
    f"""WITH {BARS}, {LATEST}, {PREVIOUS} SELECT symbol, latest_day, previous_close FROM latest LEFT JOIN previous USING (symbol)""",
    "prices_bulk",
)
def _(t):
    rows = bars.bulk_bars(t.prices_bulk)
    return bars.latest_with_previous(rows, POSITION, timed=True).select("symbol", "latest_day", "previous_close")


@query(
    "filter_universe",
    f"""WITH {BARS}, {UNIVERSE} SELECT symbol, latest_day, ord, ord_price, ord_qty FROM bars
        WHERE symbol IN (SELECT symbol FROM universe)""",
    "prices_bulk financials_stored",
)
def _(t):
    rows = bars.bulk_bars(t.prices_bulk).select("symbol", "latest_day", *POSITION)
    return rows.join(gate.distinct_tickers(t.financials_stored).withColumnRenamed("ticker", "symbol"), "symbol")


@query(
    "semi_join_universe",
    f"""WITH {BARS}, {UNIVERSE} SELECT symbol, count(*) AS bars FROM bars SEMI JOIN universe USING (symbol) GROUP BY symbol""",
    "prices_bulk financials_stored",
)
def _(t):
    # The universe is a per-symbol filter, so the bars are counted before the join.
    counts = bars.bulk_bars(t.prices_bulk).groupBy("symbol").agg(F.count("*").alias("bars"))
    universe = gate.distinct_tickers(t.financials_stored).withColumnRenamed("ticker", "symbol")
    return gate.semi_join_universe(counts, universe)


@query(
    "distinct_tickers",
    "SELECT DISTINCT ticker FROM financials_stored WHERE exchange = 'US'",
    "financials_stored",
)
def _(t):
    return gate.distinct_tickers(t.financials_stored).orderBy("ticker")


@query("latest_seen", f"WITH {SEEN} SELECT * FROM seen", "stored_us")
def _(t):
    return gate.latest_seen(t.stored_us, "US")


_GATED = f"""WITH {BARS}, {LATEST}, {SEEN} SELECT symbol, latest_day FROM latest LEFT JOIN seen USING (symbol)
   WHERE last_seen IS NULL OR latest_day > last_seen"""


@query("gated_append", _GATED, "prices_bulk stored_us")
def _(t):
    latest = bars.latest_bar(bars.bulk_bars(t.prices_bulk), POSITION).select("symbol", "latest_day")
    return gate.gated_append(latest, t.stored_us, "US")


@query("gate_join", _GATED, "prices_bulk stored_us")
def _(t):
    latest = bars.latest_bar(bars.bulk_bars(t.prices_bulk), POSITION).select("symbol", "latest_day")
    return gate.newer_than_seen_anti(latest, gate.latest_seen(t.stored_us, "US"))


# --- Canadian inputs -----------------------------------------------------------------------

_QUOTE_TYPE = (
    '{"quoteResponse":{"result":[{"symbol":"VARCHAR","regularMarketPrice":"VARCHAR","regularMarketOpen":"VARCHAR","regularMarketDayHigh":"VARCHAR",'
    '"regularMarketDayLow":"VARCHAR","regularMarketVolume":"VARCHAR","regularMarketPreviousClose":"VARCHAR","regularMarketTime":"VARCHAR",'
    '"postMarketTime":"VARCHAR","preMarketTime":"VARCHAR"}]}'
)
_QUOTE_TYPE = _QUOTE_TYPE + "," + _QUOTE_TYPE[1:].replace("quoteResponse", "quoteSummary") + "}"
_Q = {
    "regularMarketPrice": "Price", "regularMarketOpen": "Open", "regularMarketDayHigh": "DayHigh",
    "regularMarketDayLow": "DayLow", "regularMarketVolume": "Volume", "regularMarketPreviousClose": "PreviousClose",
}
_QUOTE_COLUMNS = ", ".join(f'{duck.num(f"q.{n}")} AS "{n}"' for n in _Q)
_TIMES = ", ".join(f'{duck.volume(duck.num(f"q.{n}MarketTime"))} AS "{n}MarketTime"' for n in ("regular", "post", "pre"))
QUOTES = f"""parsed AS (SELECT ord, from_json(payload, '{_QUOTE_TYPE}') AS d FROM quote_docs),
  listed AS (SELECT ord, CASE WHEN len(d.quoteResponse.result) > 0 THEN d.quoteResponse.result ELSE d.quoteSummary.result END AS l FROM parsed),
  each_quote AS (SELECT ord, unnest(l) AS q, unnest(range(len(l))) AS place FROM listed),
  quotes AS (SELECT q.symbol AS symbol, {_QUOTE_COLUMNS}, {_TIMES} FROM each_quote WHERE q.symbol <> ''
    QUALIFY row_number() OVER (PARTITION BY q.symbol ORDER BY ord DESC, place DESC) = 1)"""


def _epoch(*names: str) -> str:
    first = " ".join(f'WHEN "{n}" <> 0 THEN "{n}"' for n in names)
    return f"CAST(make_timestamp(CASE {first} END * 1000000) AS DATE)"


QUOTE_BARS = f"""quote_bars AS (SELECT symbol AS vendor_symbol, "regularMarketOpen" AS open, "regularMarketDayHigh" AS high,
  "regularMarketDayLow" AS low, "regularMarketPrice" AS price, {duck.volume('"regularMarketVolume"')} AS volume,
  {_epoch('regularMarketTime', 'postMarketTime', 'preMarketTime')} AS latest_day, "regularMarketPreviousClose" AS previous_close FROM quotes
  WHERE price IS NOT NULL AND latest_day IS NOT NULL)"""


@query("flatten_quotes", f"WITH {QUOTES} SELECT * FROM quotes", "quote_docs")
def _(t):
    return payloads.flatten_quotes(t.quote_docs, ["ord"])


@query(
    "project_bar_fields",
    f"""WITH {QUOTES}, {QUOTE_BARS} SELECT {OUT.replace('symbol, exchange', 'vendor_symbol')} FROM quote_bars""",
    "quote_docs",
)
def _(t):
    return bars.quote_bars(payloads.flatten_quotes(t.quote_docs, ["ord"]))


@query(
    "keep_last_per_key",
    f"WITH {duck.OFFICIAL}, {duck.SYMBOL_MAP} SELECT vendor_symbol, symbol, 'CA' AS exchange FROM symbol_map",
    "symbol_list",
)
def _(t):
    return listings.vendor_symbol_map(listings.official_symbols(t.symbol_list, ["ord"]), ["ord"])


@query(
    "symbol_map_join",
    f"""WITH {QUOTES}, {duck.OFFICIAL}, {duck.SYMBOL_MAP}
        SELECT symbol_map.symbol, 'CA' AS exchange, "regularMarketPrice" AS price FROM quotes JOIN symbol_map ON quotes.symbol = vendor_symbol""",
    "quote_docs symbol_list",
)
def _(t):
    quotes = payloads.flatten_quotes(t.quote_docs, ["ord"]).select(c("symbol").alias("vendor_symbol"), c("regularMarketPrice").alias("price"))
    symbol_map = listings.vendor_symbol_map(listings.official_symbols(t.symbol_list, ["ord"]), ["ord"])
    return listings.to_listed_symbols(quotes, symbol_map)


def _ca(found: str, listings_view: str = "symbol_list", stored: str = "stored_ca") -> str:
    official = duck.OFFICIAL.replace("symbol_list", listings_view)
    return f"""{official}, {duck.SYMBOL_MAP}, {SEEN_CA.format(stored)},
      mapped AS (SELECT symbol_map.symbol, 'CA' AS exchange, f.* FROM {found} f JOIN symbol_map USING (vendor_symbol)
        QUALIFY row_number() OVER (PARTITION BY symbol_map.symbol ORDER BY latest_day DESC, place) = 1)
      SELECT {OUT} FROM mapped LEFT JOIN seen USING (symbol) WHERE last_seen IS NULL OR latest_day > last_seen"""


@query("ca_prices_quotes", f"WITH {QUOTES}, {QUOTE_BARS}, {_ca('quote_bars')}", "quote_docs symbol_list stored_ca")
def _(t):
    quotes = payloads.flatten_quotes(t.quote_docs, ["ord"])
    return ca_prices.ca_prices_quotes(t.symbol_list, quotes, t.stored_ca, ["ord"])


CELLS = """daily AS (SELECT date, ticker, min(price) AS "Open", max(price) AS "High", min(price) AS "Low",
    max(CASE WHEN qty > 5 THEN price END) AS "Close", CAST(sum(qty) AS BIGINT) AS "Volume" FROM panel_cells GROUP BY date, ticker),
  panel AS (SELECT ticker, date, "Open", "High", "Low", "Close", "Volume" FROM (SELECT DISTINCT date FROM panel_cells) CROSS JOIN (SELECT concat('N', n, CASE WHEN n % 2 = 0 THEN '.TO' ELSE '.V' END) AS ticker FROM range(25) r(n))
    LEFT JOIN daily USING (date, ticker))"""


def _survivors(source: str) -> str:
    return f"""recent AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS age FROM {source} QUALIFY age <= 2),
  alive AS (SELECT * FROM recent WHERE NOT ("Open" IS NULL AND "High" IS NULL AND "Low" IS NULL AND "Close" IS NULL AND "Volume" IS NULL)),
  panel_bars AS (SELECT a.ticker AS vendor_symbol, "Open" AS open, "High" AS high, "Low" AS low, "Close" AS price, "Volume" AS volume, date AS latest_day,
    (SELECT b."Close" FROM alive b WHERE b.ticker = a.ticker AND b.age > a.age) AS previous_close FROM alive a
    WHERE NOT EXISTS (SELECT 1 FROM alive b WHERE b.ticker = a.ticker AND b.age < a.age) AND "Close" IS NOT NULL)"""


# The panel's columns are those of its download batch, whether or not a ticker traded.
PANEL_TICKERS = [f"N{n}{'.TO' if n % 2 == 0 else '.V'}" for n in range(25)]


def _wide_panel(t):
    """Landed wide panel: one row per day, columns ``<ticker>|<field>``."""
    pivoted = t.panel_cells.groupBy("date").pivot("ticker", PANEL_TICKERS).agg(
        F.min("price").alias("Open"),
        F.max("price").alias("High"),
        F.min("price").alias("Low"),
        F.max(F.when(c("qty") > 5, c("price"))).alias("Close"),
        F.sum("qty").cast("bigint").alias("Volume"),
    )
    return pivoted.select(
        "date", *(F.col(f"`{n}_{f}`").alias(f"{n}|{f}") for n in PANEL_TICKERS for f in payloads.BAR_FIELDS)
    )


@query("panel_to_long", f"WITH {CELLS} SELECT * FROM panel", "panel_cells")
def _(t):
    return payloads.panel_to_long(_wide_panel(t))


@query(
    "last_two_non_null",
    f"""WITH days AS (SELECT concat('P', l_partkey) AS ticker, CAST(l_shipdate AS DATE) AS date, max(CASE WHEN l_quantity > 25 THEN l_extendedprice END) AS "Close",
          max(CASE WHEN l_quantity > 20 THEN l_extendedprice END) AS "High", CAST(sum(CASE WHEN l_quantity > 20 THEN l_quantity END) AS BIGINT) AS "Volume",
          CAST(NULL AS DOUBLE) AS "Open", CAST(NULL AS DOUBLE) AS "Low" FROM lineitem GROUP BY ALL),
        {_survivors('days')} SELECT {OUT.replace('symbol, exchange', 'vendor_symbol')} FROM panel_bars""",
)
def _(t):
    days = t.base("lineitem").selectExpr(
        "concat('P', l_partkey) as ticker", "cast(l_shipdate as date) as date", "l_quantity", "l_extendedprice"
    ).groupBy("ticker", "date").agg(
        F.max(F.when(c("l_quantity") > 25, c("l_extendedprice"))).alias("Close"),
        F.max(F.when(c("l_quantity") > 20, c("l_extendedprice"))).alias("High"),
        F.sum(F.when(c("l_quantity") > 20, c("l_quantity"))).cast("bigint").alias("Volume"),
    )
    return bars.panel_bars(days.withColumns({n: F.lit(None).cast("double") for n in ("Open", "Low")}))


@query(
    "ca_prices_panel",
    f"WITH {CELLS}, {_survivors('panel')}, {_ca('panel_bars', 'panel_listings', 'stored_panel')}",
    "panel_cells panel_listings stored_panel",
)
def _(t):
    panel = payloads.panel_to_long(_wide_panel(t))
    return ca_prices.ca_prices_panel(t.panel_listings, panel, t.stored_panel, ["ord"])


HISTORY = """history_last AS (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC, ord DESC) = 1)"""
FAST = f"""fast_last AS (SELECT * FROM fast_info_rows QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ord DESC) = 1),
  fast AS (SELECT symbol AS vendor_symbol, open, CASE WHEN "dayHigh" <> 0 THEN "dayHigh" ELSE "regularMarketDayHigh" END AS high,
    CASE WHEN "dayLow" <> 0 THEN "dayLow" ELSE "regularMarketDayLow" END AS low,
    CASE WHEN "lastPrice" <> 0 THEN "lastPrice" WHEN last_price <> 0 THEN last_price ELSE "regularMarketPrice" END AS price,
    CASE WHEN "lastVolume" <> 0 THEN "lastVolume" ELSE "regularMarketVolume" END AS volume,
    coalesce({_epoch('regularMarketTime', 'lastMarketTime')}, DATE '2024-07-01') AS latest_day FROM fast_last WHERE price IS NOT NULL),
  hist AS (SELECT symbol AS vendor_symbol, "Open" AS open, "High" AS high, "Low" AS low, "Close" AS price, {duck.volume('"Volume"')} AS volume,
    date AS latest_day FROM history_last WHERE "Close" IS NOT NULL),
  fallback AS (SELECT * FROM fast UNION ALL SELECT * FROM hist WHERE vendor_symbol NOT IN (SELECT vendor_symbol FROM fast)),
  fallback_bars AS (SELECT *, CAST(NULL AS DOUBLE) AS previous_close FROM fallback)"""
def _today():
    return F.lit("2024-07-01").cast("date")


def _fast(t):
    return ranking.last_per_key(t.fast_info_rows, ["symbol"], ["ord"])


@query("last_history_bar", f"WITH {HISTORY} SELECT * FROM history_last", "history")
def _(t):
    return bars.last_history_bar(t.history, ["ord"])


@query("price_source_fallback", f"WITH {HISTORY}, {FAST} SELECT * FROM fallback", "history fast_info_rows")
def _(t):
    return bars.first_source_bars(bars.fast_info_bars(_fast(t), _today()), bars.history_bars(t.history, ["ord"]))


@query(
    "ca_prices_fallback",
    f"WITH {HISTORY}, {FAST}, {_ca('fallback_bars')}",
    "history fast_info_rows symbol_list stored_ca",
)
def _(t):
    return ca_prices.ca_prices_fallback(t.symbol_list, _fast(t), t.history, t.stored_ca, ["ord"], ["ord"], _today())
