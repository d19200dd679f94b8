"""Driver tables shaped as landed inputs.

A view is one projection of one table, in expressions that mean the same in Spark and DuckDB.
The driver tables hold no nulls, so nulls and malformed texts are derived from row values.
"""

from __future__ import annotations


def text(expr: str) -> str:
    return f"cast({expr} as string)"


def money(expr: str) -> str:
    return f"cast({expr} as decimal(12,2))"


def comma(expr: str) -> str:
    """A number text with a thousands separator."""
    return f"concat('1,', {expr})"


def pick(place: str, values: list[str]) -> str:
    """The value at a place, from 0."""
    return f"split_part('{','.join(values)}', ',', cast({place} + 1 as int))"


SHIP_DAY = "cast(cast(l_shipdate as date) as string)"
TOTAL = money("o_totalprice")
ROOT = f"concat('T', {text('p_partkey - p_partkey % 2')})"
LISTED_SUFFIX = pick("p_size % 10", [".A", ".PF.E", ".PR.E", ".DB", ".WT.A", ".UN", ".U", ".P", "", ".RT"])
LISTED = f"concat({ROOT}, {LISTED_SUFFIX})"
NAMED = (
    "concat(p_name, case p_size % 7 when 0 then ' trust' when 1 then ' Class B' when 2 then ' class A REIT' "
    "when 3 then ' Fund' else '' end)"
)
VALUE = text(money("value"))
QUOTED_SUFFIX = pick("event_id % 7", ["-A.TO", ".PR.E.TO", ".DB.V", ".UN.TO", ".V", ".TO", "-A.V"])
QUOTED = f"concat('T', cast(user_id * 2 as string), {QUOTED_SUFFIX})"

_statement_keys = {
    "Ticker": (
        "case when o_custkey % 17 = 0 then '  ' when o_custkey % 19 = 0 then null "
        f"when o_custkey % 5 = 0 and o_orderkey % 2 = 0 then concat('c', {text('o_custkey')}) "
        f"else concat('C', {text('o_custkey')}) end"
    ),
    "Report Date": (
        "case when o_orderkey % 23 = 0 then 'n/a' when o_orderkey % 29 = 0 then null "
        "when o_orderkey % 31 = 0 then concat('12/31/', substr(cast(o_orderdate as string), 1, 4)) "
        "when o_orderkey % 37 = 0 then concat(substr(cast(o_orderdate as string), 1, 4), '/12/31') "
        "when o_orderkey % 41 = 0 then concat('31 Dec ', substr(cast(o_orderdate as string), 1, 4)) "
        "when o_orderkey % 43 = 0 then concat('Dec 31, ', substr(cast(o_orderdate as string), 1, 4)) "
        "when o_orderkey % 47 = 0 then concat('12-31-', substr(cast(o_orderdate as string), 1, 4)) "
        "when o_orderkey % 53 = 0 then concat('31/12/', substr(cast(o_orderdate as string), 1, 4)) "
        "when o_orderkey % 59 = 0 then concat('12/31/', substr(cast(o_orderdate as string), 3, 2)) "
        "else concat(substr(cast(o_orderdate as string), 1, 4), '-12-31') end"
    ),
    "Currency": "case when o_orderkey % 13 = 0 then null when o_orderkey % 3 = 0 then 'EUR' else 'USD' end",
    "source_priority": "case o_orderstatus when 'P' then 0 when 'F' then 1 else 2 end",
    "ord": "o_orderkey",
}

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "prices_bulk": (
        "lineitem",
        {
            "Ticker": f"concat(case when l_linenumber % 2 = 0 then 'p' else 'P' end, {text('l_partkey')})",
            "Date": SHIP_DAY,
            "DateTime": (
                "case when l_linenumber % 3 = 0 then null when l_linenumber = 7 then 'n/a' "
                f"else concat({SHIP_DAY}, ' 0', {text('l_linenumber')}, ':00:00') end"
            ),
            "Open": text("l_extendedprice"),
            "High": comma(text("l_extendedprice")),
            "Low": f"case when l_linenumber = 4 then '-' else {text('l_discount')} end",
            "Close": (
                "case when l_quantity = 13 then null when l_quantity = 17 then 'abc' "
                f"when l_linenumber = 5 then {comma(text('l_quantity'))} else {text('l_extendedprice')} end"
            ),
            "Adj. Close": text("l_tax"),
            "Volume": f"case when l_quantity = 7 then null else concat({text('l_quantity')}, '7') end",
            "ord": "l_orderkey * 10 + l_linenumber",
            "ord_price": "l_extendedprice",
            "ord_qty": "l_quantity",
        },
    ),
    "stored_us": (
        "lineitem",
        {
            "symbol": f"concat('P', {text('l_partkey')})",
            "exchange": "case when l_linenumber = 7 then 'CA' else 'US' end",
            "latest_day": "case when cast(l_shipdate as date) < date '2001-06-01' then cast(l_shipdate as date) else date '1994-01-01' end",
            "price": "l_extendedprice",
        },
    ),
    "financials_stored": (
        "part",
        {
            "ticker": f"concat('P', {text('p_partkey')})",
            "exchange": "case when p_size % 2 = 0 then 'US' else 'CA' end",
            "stmt_type": "case p_size % 3 when 0 then 'IS' when 1 then 'BS' else 'CF' end",
            "value": "p_retailprice",
        },
    ),
    "income": (
        "orders",
        {
            **_statement_keys,
            "Shares (Basic)": f"case when o_orderkey % 3 = 0 then null else {text(TOTAL)} end",
            "Shares (Diluted)": text(f"{TOTAL} + 1"),
            "Revenue": f"case when o_orderkey % 7 = 0 then 'abc' when o_orderkey % 7 = 1 then null else {text(f'{TOTAL} + 2')} end",
            "Sales": comma(text(f"{TOTAL} + 3")),
            "Gross Profit": f"case when o_orderkey % 11 = 0 then 'n.m.' else {text(f'{TOTAL} - 4')} end",
            "Operating Income (Loss)": f"case when o_orderkey % 2 = 0 then null else concat('-', {text(TOTAL)}) end",
            "Net Income (Common)": "case when o_orderkey % 4 = 0 then null else concat(' ', cast(o_custkey as string), '.5 ') end",
        },
    ),
    "balance": (
        "orders",
        {
            **_statement_keys,
            "Total Equity": f"case when o_orderkey % 5 = 0 then null else {text(TOTAL)} end",
            "Total Liabilities": comma(text(f"{TOTAL} + 10")),
            "Cash, Cash Equivalents & Short Term Investments": f"case when o_orderkey % 6 = 0 then '' else {text(f'{TOTAL} - 7')} end",
            "Total Assets": text(f"{TOTAL} + {TOTAL}"),
        },
    ),
    "cashflow": (
        "orders",
        {
            **_statement_keys,
            "Net Cash from Operating Activities": f"case when o_orderkey % 3 = 0 then null else {text(TOTAL)} end",
            "Cash From Operations": f"case when o_orderkey % 9 = 0 then null else {text(f'{TOTAL} + 5')} end",
            "Capital Expenditure": "case when o_orderkey % 2 = 0 then '1.0d' else '1e3' end",
            "Purchase Of PPE": f"concat('-', {text(TOTAL)})",
            "Net Change in Cash": f"case when o_orderkey % 8 = 0 then null else {text('o_custkey')} end",
        },
    ),
    "matrix": (
        "lineitem",
        {
            "symbol": f"concat('S', {text('l_suppkey')})",
            "stmt_type": "case l_returnflag when 'A' then 'IS' when 'N' then 'BS' else 'CF' end",
            "api_priority": "case when l_suppkey % 4 = 0 then 1 + l_linenumber % 2 else l_linenumber % 3 end",
            "period_ordinal": "cast(l_orderkey % 4 as int)",
            "period_end": (
                "case when l_quantity = 11 then 'TTM' when l_quantity = 12 then null "
                "else concat(substr(cast(l_shipdate as string), 1, 4), '-12-31') end"
            ),
            "tag": f"concat(l_returnflag, l_linestatus, {text('l_linenumber')})",
            "value": (
                "case when l_quantity = 13 then null when l_quantity = 17 then 'abc' "
                f"when l_linenumber = 5 then {comma(text('l_quantity'))} else {text('l_extendedprice')} end"
            ),
        },
    ),
    "matrix_issuers": ("supplier", {"symbol": f"concat('S', {text('s_suppkey')})", "name": "s_name"}),
    "symbol_list": (
        "part",
        {
            "symbol": (
                "case when p_partkey % 37 = 0 then '  ' when p_partkey % 41 = 0 then null else concat("
                f"case when p_partkey % 11 = 0 then ' t' else 'T' end, {text('p_partkey - p_partkey % 2')}, {LISTED_SUFFIX}) end"
            ),
            "name": NAMED,
            "parent_symbol": f"case when p_partkey % 13 = 0 then null when p_partkey % 17 = 0 then ' ' else {ROOT} end",
            "parent_name": "p_brand",
            "exchange": (
                "case when p_partkey % 43 = 0 then null when p_partkey % 5 = 0 then 'NEO' "
                "when p_partkey % 3 = 0 then 'TSX' when p_partkey % 3 = 1 then 'TSXV' else ' tsx ' end"
            ),
            "co_id": f"case when p_size % 4 = 0 then null else concat(' ', {text('p_size')}) end",
            "market_cap": comma(text(money("p_retailprice"))),
            "os_shares": f"case when p_size % 6 = 0 then '--' else {text(money('p_retailprice'))} end",
            "ord": "p_partkey",
        },
    ),
    "stored_issuers": (
        "supplier",
        {
            "symbol": f"concat('T', {text('s_suppkey * 2')}, case s_nationkey % 5 when 0 then '.A' when 1 then '.DB' when 2 then '.UN' when 3 then '' else '.P' end)",
            "name": "s_name",
        },
    ),
    "directory_docs": (
        "part",
        {
            "ord": "p_partkey",
            "exchange": "case when p_partkey % 3 = 0 then 'TSXV' else 'TSX' end",
            "payload": (
                "case when p_partkey % 9 = 4 then '{\"message\":\"nothing listed\"}' else "
                f"concat('{{\"results\":[{{\"symbol\":\"', {ROOT}, '\",\"name\":\"', p_brand, '\",\"instruments\":[{{\"symbol\":\"', {LISTED}, "
                f"'\",\"name\":\"', {NAMED}, '\"}},{{\"symbol\":\"\",\"name\":\"blank\"}},{{\"name\":\"none\"}}', "
                f"case when p_size % 3 = 0 then concat(',{{\"symbol\":\"', {ROOT}, '.B\"}}') else '' end, "
                f"']}},{{\"symbol\":\"E\"}},{{\"instruments\":[{{\"symbol\":\"Z', {text('p_partkey')}, '\",\"name\":\"orphan\"}}]}}]}}') end"
            ),
        },
    ),
    "quote_docs": (
        "events",
        {
            "ord": "event_id",
            "payload": (
                "concat(case when event_id % 4 = 1 then '{\"quoteResponse\":{\"result\":[]},\"quoteSummary\":{\"result\":[' "
                "when event_id % 4 = 2 then '{\"quoteSummary\":{\"result\":[' else '{\"quoteResponse\":{\"result\":[' end, "
                f"'{{\"symbol\":\"', {QUOTED}, '\"', "
                f"case when event_id % 10 = 0 then '' else concat(',\"regularMarketPrice\":', {VALUE}) end, "
                f"',\"regularMarketOpen\":', {text(money('value') + ' + 0.25')}, ',\"regularMarketDayHigh\":\"1,', {text('user_id + 100')}, '\"', "
                f"case when event_id % 3 = 0 then ',\"regularMarketDayLow\":null' else concat(',\"regularMarketDayLow\":', {VALUE}) end, "
                f"',\"regularMarketVolume\":', {text('event_id * 3')}, ',\"regularMarketPreviousClose\":', "
                "case when event_id % 12 = 5 then '0' when event_id % 12 = 6 then 'null' else cast(user_id + 1 as string) end, "
                "case when event_id % 15 = 0 then '' when event_id % 16 = 7 "
                "then concat(',\"regularMarketTime\":\"', cast(1704067200 + event_id * 3600 as string), '\"') "
                "when event_id % 16 = 9 then concat(',\"regularMarketTime\":', cast(1704067200 + event_id * 3600 as string), '.0') "
                "when event_id % 6 = 0 "
                "then concat(',\"regularMarketTime\":0,\"postMarketTime\":', cast(1704067200 + event_id * 3600 as string)) "
                "else concat(',\"regularMarketTime\":', cast(1704067200 + event_id * 3600 as string)) end, "
                "'},{\"symbol\":\"\"},{\"regularMarketPrice\":1}', "
                f"case when event_id % 14 = 3 then concat(',{{\"symbol\":\"', {QUOTED}, '\",\"regularMarketPrice\":7.5,\"regularMarketTime\":1704067200}}') else '' end, "
                "']}}')"
            ),
        },
    ),
    "fast_info_rows": (
        "events",
        {
            "symbol": QUOTED,
            "lastPrice": "case when user_id % 4 = 0 then 0.0 else value end",
            "last_price": "case when user_id % 4 = 0 and event_id % 2 = 0 then null else 0.0 end",
            "regularMarketPrice": "case when user_id % 8 = 0 then null when user_id % 12 = 4 then 0.0 else value + 1 end",
            "open": "value",
            "dayHigh": "case when event_id % 3 = 0 then 0.0 else value end",
            "regularMarketDayHigh": "value + 2",
            "dayLow": "case when event_id % 3 = 1 then null else value end",
            "regularMarketDayLow": "case when event_id % 5 = 0 then null else value end",
            "lastVolume": "case when event_id % 3 = 2 then 0 else event_id end",
            "regularMarketVolume": "event_id + 7",
            "regularMarketTime": "case when event_id % 4 = 0 then 0 else 1704067200 + event_id * 3600 end",
            "lastMarketTime": "case when event_id % 8 = 0 then null else 1704067200 + event_id * 1800 end",
            "ord": "event_id",
        },
    ),
    "history": (
        "events",
        {
            "symbol": QUOTED,
            "date": "cast(ts as date)",
            "Open": "case when event_id % 5 = 0 then null else value end",
            "High": "value + 1",
            "Low": "value - 1",
            "Close": "case when event_id % 9 = 0 then null else value end",
            "Volume": "case when event_id % 4 = 0 then null else value * 10 + 0.25 end",
            "ord": "event_id",
        },
    ),
    "stored_ca": (
        "part",
        {
            "symbol": f"upper({LISTED})",
            "exchange": "case when p_size % 13 = 0 then 'US' else 'CA' end",
            "latest_day": "date '2024-01-01' + p_size",
        },
    ),
    "panel_listings": (
        "nation",
        {
            "symbol": f"concat('N', {text('n_nationkey')})",
            "exchange": "case when n_nationkey % 2 = 0 then 'TSX' else 'TSXV' end",
            "parent_symbol": "n_name",
            "ord": "n_nationkey",
        },
    ),
    "stored_panel": (
        "nation",
        {
            "symbol": f"concat('N', {text('n_nationkey')})",
            "exchange": "'CA'",
            "latest_day": "case when n_regionkey = 1 then date '2030-01-01' else date '1998-01-01' end",
        },
    ),
    "panel_cells": (
        "lineitem",
        {
            "date": "cast(l_shipdate as date)",
            "ticker": f"concat('N', {text('l_suppkey % 25')}, case when l_suppkey % 25 % 2 = 0 then '.TO' else '.V' end)",
            "price": "l_extendedprice",
            "qty": "l_quantity",
        },
    ),
    "infos": (
        "part",
        {
            "symbol": f"concat('I', {text('p_partkey')})",
            "info": (
                "case when p_partkey % 31 = 0 then null when p_partkey % 31 = 1 then '{}' when p_partkey % 31 = 2 then 'null' "
                "else concat('{', "
                "case p_size % 9 when 0 then '\"quoteType\":\"\",\"quote_type\":\"Stock\",' when 1 then '\"quoteType\":\"EQUITY\",' when 2 then '\"quoteType\":\"ETF\",' "
                "when 3 then '\"quote_type\":\"INDEX\",' when 4 then '\"quoteType\":\"MUTUALFUND\",' when 5 then '\"quoteType\":\"CRYPTOCURRENCY\",' "
                "when 6 then '\"quoteType\":\"Index\",' when 7 then '\"quoteType\":\"\",' else '' end, "
                "case p_size % 11 when 0 then '\"isEtf\":true,' when 1 then '\"isEtf\":false,\"isETF\":1,' when 2 then '\"isEtf\":0,' "
                "when 3 then '\"isEtf\":\"false\",' when 4 then '\"isMutualFund\":true,' when 5 then '\"isMutualFund\":\"\",' else '' end, "
                "case p_partkey % 13 when 0 then '\"category\":\"Closed-End Debt\",' when 1 then '\"category\":\"closed end\",' else concat('\"category\":\"', p_type, '\",') end, "
                f"case when p_partkey % 3 = 0 then concat('\"longName\":\"\",\"long_name\":\"', {NAMED}, '\",') else concat('\"longName\":\"', {NAMED}, '\",') end, "
                "case when p_size % 4 = 0 then '\"underlyingSymbol\":\"X\",' else '\"underlying_symbol\":\"Y\",' end, "
                "case when p_partkey % 5 = 0 then '\"yield\":\"0.05\",' when p_partkey % 5 = 1 then '\"yield\":\"1,5\",' when p_partkey % 5 = 2 then '\"yield\":true,' else '' end, "
                f"'\"navPrice\":', {text(money('p_retailprice'))}, ',\"totalAssets\":', {text('p_partkey * 1000')}, "
                "',\"beta3Year\":null,\"fundFamily\":\"', p_brand, '\",\"currency\":\"CAD\"}') end"
            ),
            "ord": "p_partkey",
        },
    ),
    "issuers": ("customer", {"symbol": f"concat('I', {text('c_custkey')})", "name": "c_name"}),
    "meta_stored": (
        "customer",
        {
            "symbol": f"concat('I', {text('c_custkey')})",
            "yahoo_symbol": f"case when c_nationkey % 3 = 0 then null else concat('I', {text('c_custkey')}, '.TO') end",
            "long_name": "c_name",
            "nav_price": "c_acctbal",
        },
    ),
    "meta_incoming": (
        "part",
        {
            "symbol": f"concat('I', {text('p_partkey - p_partkey % 2')})",
            "yahoo_symbol": f"concat('J', {text('p_partkey')})",
            "long_name": "p_name",
            "nav_price": "p_retailprice",
            "ord": "p_partkey",
        },
    ),
    "steps": (
        "events",
        {
            "run_id": "event_id - event_id % 8",
            "step_no": "event_id % 8 + 1",
            "script": "event_type",
            "exit_code": "case when event_id % 29 = 0 then 2 when event_id % 3 = 0 then 1 else 0 end",
        },
    ),
    "logs": (
        "events",
        {
            "script": "event_type",
            "status": "case user_id % 3 when 0 then 'success' when 1 then 'warning' else 'error' end",
            "started_at": "ts",
            "event_id": "event_id",
        },
    ),
    "outcomes": (
        "events",
        {
            "symbol": text("event_id"),
            "outcome": "case when event_id % 150 = 0 then 'error' when event_id % 4 = 0 then 'skipped' else 'inserted' end",
        },
    ),
}


def view_sql(name: str) -> str:
    """The view as DuckDB text."""
    table, columns = VIEWS[name]
    return "SELECT " + ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items()) + f" FROM {table}"
