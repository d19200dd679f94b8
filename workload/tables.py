"""Table mutations, scans, sinks and the stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.operators import bars, coverage, gate, listings, merge, runlog
from tickerloom.plans import us_financials as us
from tickerloom.plans import us_prices as us_plan
from tickerloom.session import scratch_dir
from tickerloom.sinks import tables
from tickerloom.sources import files
from tickerloom.streaming.gated import stream_gated_append
from workload import duck
from workload.directory import ISSUER_ROWS, _directory, symbol_directory
from workload.directory import FLAT, _SYMBOLS
from workload.financials import _LOADED, STATEMENTS, us_financials
from workload.prices import BARS, BY_TIME, LATEST, OUT, POSITION, SEEN, TYPED, UNIVERSE, US_VIEWS, stored_with_times
from workload.registry import query

c = F.col

# --- mutations ------------------------------------------------------------------------------


@query(
    "insert_if_absent",
    f"""WITH {ISSUER_ROWS} SELECT symbol, name, ord FROM issuer_rows ANTI JOIN stored_issuers USING (symbol)
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ord) = 1""",
    "symbol_list stored_issuers",
)
def _(t):
    incoming = listings.issuer_rows(t.symbol_list, ["ord"]).select("symbol", "name", "ord")
    return merge.insert_if_absent(t.stored_issuers, incoming, "symbol", ["ord"])


@query(
    "anti_join_absent",
    f"WITH {ISSUER_ROWS} SELECT DISTINCT symbol FROM issuer_rows WHERE symbol NOT IN (SELECT symbol FROM stored_issuers)",
    "symbol_list stored_issuers",
)
def _(t):
    return listings.issuer_rows(t.symbol_list, ["ord"]).select("symbol").distinct().join(t.stored_issuers, "symbol", "left_anti")


_UPSERT = """last AS (SELECT * FROM meta_incoming QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ord DESC) = 1)
  SELECT symbol, yahoo_symbol, long_name, nav_price FROM meta_stored WHERE symbol NOT IN (SELECT symbol FROM last)
  UNION ALL SELECT symbol, yahoo_symbol, long_name, nav_price FROM last"""


@query("upsert_meta", f"WITH {_UPSERT}", "meta_stored meta_incoming")
def _(t):
    return merge.upsert(t.meta_stored, t.meta_incoming, "symbol", ["ord"])


@query("clear_exchange", "SELECT * FROM stored_us WHERE exchange <> 'US'", "stored_us")
def _(t):
    return merge.clear_exchange(t.stored_us, "US")


_AUDIT = "SELECT symbol, latest_day, exchange, count(*) AS copies FROM stored_us GROUP BY ALL HAVING count(*) > 1"


@query("unique_key_audit", _AUDIT, "stored_us")
def _(t):
    return merge.duplicate_keys(t.stored_us, schemas.UNIQUE_KEYS["stock_prices"])


# --- sinks and scans: written under the shared scratch folder and read back -------------------


@query("append_rows", _LOADED, STATEMENTS)
def _(t):
    path = f"{scratch_dir(t.spark)}/financials"
    rows = us_financials(t)
    for stmt in ("IS", "BS", "CF"):
        tables.append_rows(rows.where(c("stmt_type") == stmt), path, "financials", sort_by="ticker")
    return t.spark.read.schema(schemas.FINANCIALS).parquet(path).drop("inserted_at")


_EXPORTED = """SELECT symbol, nullif(name, '') AS name, nullif(parent_symbol, '') AS parent_symbol,
  nullif(parent_name, '') AS parent_name, suffix, exchange FROM"""


@query("export_symbols", f"WITH {FLAT} {_EXPORTED} ({_SYMBOLS})", "directory_docs")
def _(t):
    path = f"{scratch_dir(t.spark)}/symbols"
    tables.export_symbols(symbol_directory(t), path)
    return t.spark.read.schema(schemas.SYMBOL_LIST).option("header", True).csv(path)


@query("export_combined", f"WITH {FLAT} {_EXPORTED} ({_SYMBOLS})", "directory_docs")
def _(t):
    path = f"{scratch_dir(t.spark)}/combined"
    found = _directory(t).symbols
    tables.export_combined(found.where("exchange = 'TSX'"), found.where("exchange = 'TSXV'"), path)
    return t.spark.read.schema(schemas.SYMBOL_LIST).option("header", True).csv(path)


@query(
    "scan_bulk_csv",
    """SELECT "Ticker", "Date", nullif("DateTime", 'n/a') AS "DateTime", "Open", "High", "Low", "Close", "Adj. Close", "Volume",
         CASE WHEN ord % 3 = 0 THEN 'NA' ELSE 'US' END AS market, CASE WHEN ord % 2 = 0 THEN 'daily' ELSE 'latest' END AS variant FROM prices_bulk""",
    "prices_bulk",
)
def _(t):
    path = bulk_landing(t)
    scans = [files.read_bulk_csv(t.spark, path, market=m, variant=v) for m in ("NA", "US") for v in ("daily", "latest")]
    return reduce(DataFrame.unionByName, scans).drop(*files.POSITION)


def bulk_landing(t):
    """Two markets (one of a name that means missing in a measure) and two variants are landed."""
    path = f"{scratch_dir(t.spark)}/shareprices"
    market, variant = F.when(c("ord") % 3 == 0, "NA").otherwise("US"), F.when(c("ord") % 2 == 0, "daily").otherwise("latest")
    landed = t.prices_bulk.withColumns({"market": market, "variant": variant}).drop(*POSITION)
    landed.write.option("sep", ";").option("header", True).partitionBy("market", "variant").csv(path)
    return path


def bulk_scan(t):
    """One market and variant of them."""
    return files.read_bulk_csv(t.spark, bulk_landing(t), market="NA", variant="daily")


@query(
    "scan_symbol_csv",
    "SELECT symbol, name, parent_symbol, exchange FROM symbol_list",
    "symbol_list",
)
def _(t):
    path = f"{scratch_dir(t.spark)}/symbol_list"
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    t.symbol_list.select("symbol", "name", "parent_symbol", "exchange").write.options(**options).csv(path)
    return files.read_symbol_csv(t.spark, path, position=False)


# --- run log --------------------------------------------------------------------------------


def _outcome_counts() -> str:
    return """n AS (SELECT count(*) AS total, count(*) FILTER (outcome = 'inserted') AS done, count(*) FILTER (outcome = 'error') AS errors FROM outcomes)"""


_STATUS = f"""{duck.status('total', 'errors')} AS status, {duck.message('symbols', 'success', 'total', 'done', 'errors')} AS message,
  {duck.details('symbols', 'success', 'total', 'done', 'errors')} AS details"""


@query(
    "row_status",
    f"WITH {_outcome_counts()} SELECT total, done AS success, errors, {duck.rate('total', 'errors')} AS error_rate, {_STATUS} FROM n",
    "outcomes",
)
def _(t):
    return coverage.outcome_status(t.outcomes)


def _log_rows(status):
    started = F.lit("2024-01-01 00:00:00").cast("timestamp")
    ended = F.lit("2024-01-01 00:01:30.0129").cast("timestamp")
    return runlog.run_log_rows(status, F.lit("us_prices"), started, ended)


_LOG = "CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS started_at, CAST('2024-01-01 00:01:30.0129' AS TIMESTAMP) AS ended_at, CAST(90012 AS INTEGER) AS duration_ms"


@query(
    "run_log_append",
    f"WITH {_outcome_counts()} SELECT 'us_prices' AS script, {_STATUS}, {_LOG} FROM n",
    "outcomes",
)
def _(t):
    path = f"{scratch_dir(t.spark)}/ingest_logs"
    tables.append_rows(_log_rows(coverage.outcome_status(t.outcomes)), path, "ingest_logs")
    logs = t.spark.read.schema(schemas.INGEST_LOGS).parquet(path)
    return logs.withColumns({n: c(n).cast("timestamp_ntz") for n in ("started_at", "ended_at")})


_FOUND = f"""WITH {BARS}, {LATEST}, {SEEN}, {UNIVERSE}, typed AS (SELECT symbol, {TYPED} FROM latest SEMI JOIN universe USING (symbol)),
  appended AS (SELECT symbol FROM typed LEFT JOIN seen USING (symbol) WHERE price IS NOT NULL AND (last_seen IS NULL OR latest_day > last_seen)),
  n AS (SELECT count(*) AS total, count(*) FILTER (symbol IN (SELECT symbol FROM appended)) AS done, CAST(0 AS BIGINT) AS errors FROM typed)"""


def _zoneless(log):
    return log.withColumns({n: c(n).cast("timestamp_ntz") for n in ("started_at", "ended_at")})


@query("run_log", f"{_FOUND} SELECT 'us_prices' AS script, {_STATUS}, {_LOG} FROM n", US_VIEWS)
def _(t):
    return _zoneless(_log_rows(us_plan.us_prices_status(t.prices_bulk, t.financials_stored, t.stored_us, POSITION)))


@query(
    "run_log_by_time",
    f"""{BY_TIME}, n AS (SELECT count(*) AS total,
          count(*) FILTER (price IS NOT NULL AND CASE WHEN timed THEN seen_time IS NULL OR as_of > seen_time ELSE seen_day IS NULL OR latest_day > seen_day END) AS done,
          count(*) FILTER (timed AND as_of IS NULL AND seen_time IS NOT NULL) AS errors FROM judged)
        SELECT 'us_prices' AS script, {_STATUS}, {_LOG} FROM n""",
    US_VIEWS,
)
def _(t):
    status = us_plan.us_prices_status(t.prices_bulk, t.financials_stored, stored_with_times(t), POSITION, "daily")
    return _zoneless(_log_rows(status))


_NOTHING = "NOT EXISTS (SELECT 1 FROM financials_stored WHERE exchange = 'US')"


@query(
    "run_log_early_exit",
    f"""{_FOUND} SELECT 'us_prices' AS script, {_STATUS}, {_LOG} FROM n WHERE NOT {_NOTHING}
        UNION ALL SELECT 'us_prices', 'warning', 'No US tickers found in financials table', '{{}}', {_LOG} WHERE {_NOTHING}""",
    US_VIEWS,
)
def _(t):
    return _zoneless(_log_rows(us_plan.us_prices_log(t.prices_bulk, t.financials_stored, t.stored_us, POSITION)))


_RUNS = """ordered AS (SELECT *, sum(CASE WHEN exit_code NOT IN (0, 2) THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY step_no) AS fails FROM steps),
  aborts AS (SELECT run_id, min(step_no) AS abort_step FROM ordered WHERE exit_code = 2 OR (fails >= 3 AND exit_code <> 0) GROUP BY run_id),
  outcome AS (SELECT s.run_id, count(*) AS steps_planned, count(*) FILTER (exit_code NOT IN (0, 2) AND step_no <= coalesce(abort_step, 999999999)) AS counted_failures,
    any_value(abort_step) AS abort_step, CAST(coalesce(max(CASE WHEN step_no = abort_step THEN CASE exit_code WHEN 2 THEN 2 ELSE 1 END END), 0) AS INTEGER) AS exit_code
    FROM steps s LEFT JOIN aborts USING (run_id) GROUP BY s.run_id)"""


@query(
    "run_outcome",
    f"""WITH {_RUNS} SELECT *, CASE exit_code WHEN 0 THEN 'complete' WHEN 2 THEN 'critical' ELSE 'too many failures' END AS outcome FROM outcome""",
    "steps",
)
def _(t):
    return runlog.run_outcomes(t.steps)


@query(
    "steps_not_run",
    f"WITH {_RUNS} SELECT steps.* FROM steps JOIN aborts USING (run_id) WHERE step_no > abort_step",
    "steps",
)
def _(t):
    return runlog.steps_not_run(t.steps, runlog.run_outcomes(t.steps))


def _recent(by: str) -> str:
    return f"SELECT * FROM logs QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY started_at DESC, event_id DESC) <= 3"


@query("recent_runs", _recent("script"), "logs")
def _(t):
    return runlog.recent_runs(t.logs, "script", 3, ("event_id",))


@query("recent_runs_by_status", _recent("status"), "logs")
def _(t):
    return runlog.recent_runs(t.logs, "status", 3, ("event_id",))


# --- stream ---------------------------------------------------------------------------------


def _batch(n: int, seen: str) -> str:
    """Accepted bars of the n-th landed file, held against the marks ``seen``; then the next marks."""
    bars_n = BARS.replace("bars AS (", f"bars{n} AS (", 1).replace("FROM prices_bulk", f"FROM prices_bulk WHERE ord % 3 = {n}")
    latest_n = LATEST.replace("latest AS (", f"latest{n} AS (", 1).replace("FROM bars ", f"FROM bars{n} ")
    return f"""{bars_n}, {latest_n},
      accepted{n} AS (SELECT * FROM (SELECT symbol, 'US' AS exchange, {TYPED}, CAST(NULL AS DOUBLE) AS previous_close FROM latest{n}) LEFT JOIN {seen} USING (symbol)
        WHERE price IS NOT NULL AND (last_seen IS NULL OR latest_day > last_seen)),
      seen{n} AS (SELECT symbol, max(last_seen) AS last_seen FROM (SELECT symbol, last_seen FROM {seen} UNION ALL SELECT symbol, latest_day FROM accepted{n}) GROUP BY symbol)"""


@query(
    "stream_gated_append",
    f"""WITH {SEEN}, {_batch(0, 'seen')}, {_batch(1, 'seen0')}, {_batch(2, 'seen1')},
        added AS (SELECT * FROM accepted0 UNION ALL SELECT * FROM accepted1 UNION ALL SELECT * FROM accepted2)
        SELECT {OUT} FROM added
        UNION ALL SELECT symbol, exchange, NULL, NULL, NULL, price, NULL, latest_day, NULL, NULL, NULL FROM stored_us""",
    "prices_bulk stored_us",
)
def _(t):
    """Three bulk datasets land one after another, each in several files; the target starts with rows that gate the first.

    The stream is started again for each, so that it is one batch whatever the number of its files.
    """
    root = scratch_dir(t.spark)
    landing, target = f"{root}/landing", f"{root}/stock_prices"
    rows = t.prices_bulk
    tables.write_version(t.stored_us, target, "stock_prices")
    for n in range(3):
        part = rows.where(c("ord") % 3 == n)
        part.write.mode("append").option("sep", ";").option("header", True).csv(landing)
        stream = stream_gated_append(t.spark, landing, rows.schema, target, f"{root}/checkpoint", POSITION, files_per_batch=None, csv=True)
        stream.awaitTermination()
    return t.spark.read.schema(schemas.STOCK_PRICES).parquet(target).drop("inserted_at")
