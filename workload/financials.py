"""Statement operators and loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators import coverage, merge, ranking, statements
from tickerloom.operators.gate import semi_join_universe
from tickerloom.plans import ca_financials as ca
from tickerloom.plans import us_financials as us
from tickerloom.session import written_once
from tickerloom.sources import payloads
from workload import duck
from workload.registry import ORACLES, query

c = F.col
VIEW_OF = {"IS": "income", "BS": "balance", "CF": "cashflow"}
STATEMENTS = "income balance cashflow"
SOURCES = range(3)  # banks, insurance, general


def _parts(wide: DataFrame) -> list[DataFrame]:
    """The three files of a statement."""
    return [wide.where(c("source_priority") == s).drop("source_priority") for s in SOURCES]


def _tagged(t) -> dict[str, DataFrame]:
    """Each statement's files in one frame; ``dedup_by_priority`` and ``union_by_name`` take them apart."""
    return {stmt: getattr(t, view) for stmt, view in VIEW_OF.items()}


def _dedup(view: str) -> str:
    return f"""(SELECT * FROM {view} QUALIFY row_number() OVER
      (PARTITION BY "Ticker", "Report Date" ORDER BY source_priority, ord) = 1)"""


# The vendor's column names.
_TAGS = {
    "income": {
        "SharesOutstanding": ["Shares (Basic)", "Shares (Diluted)"],
        "Revenue": ["Revenue", "Sales"],
        "GrossProfit": ["Gross Profit"],
        "OperatingProfit": ["Operating Income (Loss)"],
        "NetIncome": ["Net Income (Common)"],
    },
    "balance": {
        "Equity": ["Total Equity"],
        "Liabilities": ["Total Liabilities"],
        "CashAndEquivalents": ["Cash, Cash Equivalents & Short Term Investments"],
        "Assets": ["Total Assets"],
    },
    "cashflow": {
        "OperatingCashFlow": ["Net Cash from Operating Activities", "Cash From Operations"],
        "CapitalExpenditure": ["Capital Expenditure", "Purchase Of PPE"],
        "ChangeInCash": ["Net Change in Cash"],
    },
}


def _long(stmt: str, source: str) -> str:
    view = VIEW_OF[stmt]
    selects = []
    for tag, columns in _TAGS[view].items():
        first = ", ".join(duck.num(f'"{n}"') for n in columns)
        selects.append(
            f"""SELECT upper("Ticker") AS ticker, 'US' AS exchange, {duck.day('"Report Date"')} AS fy_end_date, '{stmt}' AS stmt_type,
            '{tag}' AS tag, coalesce({first}) AS value, "Currency" AS unit, 'SimFin' AS source
            FROM {source} WHERE trim("Ticker") <> '' AND fy_end_date IS NOT NULL AND value IS NOT NULL"""
        )
    return " UNION ALL ".join(selects)


_LOADED = " UNION ALL ".join(_long(s, _dedup(v)) for s, v in VIEW_OF.items())
_CANDIDATES = " UNION ".join(f'SELECT upper("Ticker") AS ticker FROM {v} WHERE "Ticker" IS NOT NULL' for v in VIEW_OF.values())


@query(
    "union_by_name",
    """SELECT ord, "Ticker", source_priority, CASE WHEN source_priority = 0 THEN NULL ELSE "Gross Profit" END AS gross FROM income""",
    "income",
)
def _(t):
    banks, insurance, general = _parts(t.income)
    merged = ranking.union_by_priority([banks.drop("Gross Profit"), insurance, general])
    return merged.select("ord", "Ticker", "source_priority", c("Gross Profit").alias("gross"))


@query(
    "dedup_by_priority",
    f"""SELECT ord, "Ticker", "Report Date", source_priority FROM {_dedup('income')}""",
    "income",
)
def _(t):
    return us.deduplicated(_parts(t.income), ["ord"]).select("ord", "Ticker", "Report Date", "source_priority")


@query("tag_map_unpivot", _long("BS", "balance"), "balance")
def _(t):
    return statements.unpivot_tags(t.balance, "BS")


@query("us_financials", _LOADED, STATEMENTS)
def us_financials(t):
    return us.us_financials(_tagged(t), ["ord"])


@query("ticker_set_union", _CANDIDATES, STATEMENTS)
def _(t):
    tickers = [getattr(t, v).where("Ticker is not null").select(F.upper("Ticker").alias("ticker")) for v in VIEW_OF.values()]
    return merge.union_distinct(*tickers)


@query(
    "coverage_diff",
    f"WITH candidates AS ({_CANDIDATES}), loaded AS ({_LOADED}) SELECT ticker FROM candidates ANTI JOIN loaded USING (ticker)",
    STATEMENTS,
)
def _(t):
    candidates = coverage.candidate_tickers(*(getattr(t, v) for v in VIEW_OF.values()))
    return coverage.coverage_diff(candidates, us_financials(t))


@query(
    "coverage_status",
    f"""WITH candidates AS ({_CANDIDATES}), loaded AS ({_LOADED}),
        n AS (SELECT count(*) AS total, count(*) FILTER (ticker IN (SELECT ticker FROM loaded)) AS done FROM candidates)
        SELECT total, done AS inserted, total - done AS errors, {duck.rate('total', '(total - done)')} AS error_rate,
        {duck.status('total', '(total - done)')} AS status, {duck.message('tickers', 'inserted', 'total', 'done', '(total - done)')} AS message,
        {duck.details('tickers', 'inserted', 'total', 'done', '(total - done)')} AS details FROM n""",
    STATEMENTS,
)
def _(t):
    return us.us_financials_coverage(_tagged(t), ["ord"])


@query(
    "coverage_status_written",
    ORACLES["coverage_status"],
)
def _(t):
    parts = {stmt: _parts(getattr(t, view)) for stmt, view in VIEW_OF.items()}
    return us.us_financials_status(parts, written_once(us.us_financials(parts, ["ord"])))


def _stats(stmt: str) -> str:
    view = VIEW_OF[stmt]
    return f"""SELECT '{stmt}' AS stmt_type, count(*) AS concat_rows,
      (SELECT count(*) FROM (SELECT DISTINCT "Ticker", "Report Date" FROM {view})) AS dedup_rows FROM {view}"""


@query("dedup_stats", " UNION ALL ".join(_stats(s) for s in VIEW_OF), STATEMENTS)
def _(t):
    parts = [
        coverage.dedup_stats(getattr(t, v), us.KEYS).select(F.lit(s).alias("stmt_type"), "concat_rows", "dedup_rows")
        for s, v in VIEW_OF.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("inserted_per_statement", f"SELECT stmt_type, count(*) AS inserted_rows FROM ({_LOADED}) GROUP BY stmt_type", STATEMENTS)
def _(t):
    return coverage.inserted_per_statement(us_financials(t))


# --- statement matrices ---------------------------------------------------------------------

_CELLS = f"""SELECT symbol, stmt_type, api_priority, period_ordinal, {duck.day('period_end')} AS fy_end_date, tag, {duck.num('value')} AS value FROM matrix"""
_BEST = """SELECT m.* FROM {0} m WHERE (symbol, stmt_type, api_priority) IN
  (SELECT symbol, stmt_type, min(api_priority) FROM {0} GROUP BY symbol, stmt_type)"""
_ROWS = """SELECT symbol AS ticker, 'CA' AS exchange, fy_end_date, stmt_type, tag, value, CAST(NULL AS VARCHAR) AS unit, 'yfinance' AS source FROM {}"""


@query("statement_matrix_scan", _CELLS, "matrix")
def _(t):
    return payloads.statement_cells(t.matrix)


@query("statement_unpivot", f"WITH cells AS ({_CELLS}) {_ROWS.format('cells')}", "matrix")
def _(t):
    return statements.statement_rows(payloads.statement_cells(t.matrix))


@query("most_recent_period", "SELECT * FROM matrix WHERE period_ordinal = 0", "matrix")
def _(t):
    return statements.most_recent_period(t.matrix)


@query("first_non_empty_source", _BEST.format("matrix"), "matrix")
def _(t):
    return statements.first_source_cells(t.matrix)


@query(
    "ca_financials",
    f"""WITH cells AS ({_CELLS}), listed AS (SELECT * FROM cells SEMI JOIN matrix_issuers USING (symbol)),
        best AS ({_BEST.format('listed')}), recent AS (SELECT * FROM best WHERE period_ordinal = 0) {_ROWS.format('recent')}""",
    "matrix matrix_issuers",
)
def ca_financials(t):
    return ca.ca_financials(t.matrix_issuers, t.matrix)


@query("semi_join_issuers", "SELECT symbol, tag, value FROM matrix SEMI JOIN matrix_issuers USING (symbol)", "matrix matrix_issuers")
def _(t):
    return semi_join_universe(t.matrix, t.matrix_issuers).select("symbol", "tag", "value")
