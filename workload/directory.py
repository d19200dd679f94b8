"""Listings, issuers and instruments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.operators import instruments, listings
from tickerloom.plans import ca_listings
from tickerloom.sources import payloads
from workload import duck
from workload.registry import query

c = F.col

_DIRECTORY_TYPE = (
    '{"results":[{"symbol":"VARCHAR","name":"VARCHAR","instruments":[{"symbol":"VARCHAR","name":"VARCHAR"}]}]}'
)
FLAT = f"""companies AS (SELECT ord, exchange, unnest(r) AS company, unnest(range(len(r))) AS company_no
    FROM (SELECT ord, exchange, from_json(payload, '{_DIRECTORY_TYPE}').results AS r FROM directory_docs)),
  listed AS (SELECT ord, exchange, company_no, company.symbol AS ps, company.name AS pn, unnest(company.instruments) AS i,
    unnest(range(len(company.instruments))) AS instrument_no FROM companies),
  flat AS (SELECT ord, i.symbol AS symbol, coalesce(i.name, '') AS name, coalesce(ps, '') AS parent_symbol, coalesce(pn, '') AS parent_name,
    exchange, CAST(company_no AS INTEGER) AS company_no, CAST(instrument_no AS INTEGER) AS instrument_no FROM listed WHERE i.symbol <> '')"""
PLACE = ("ord", "company_no", "instrument_no")


def _flat(t):
    return payloads.flatten_directory(t.directory_docs, c("exchange"), keep=("ord",))


@query("flatten_directory", f"WITH {FLAT} SELECT * FROM flat", "directory_docs")
def _(t):
    return _flat(t)


_PARENTS = """SELECT parent_symbol, count(*) AS instruments, arg_min(parent_name, (ord, company_no, instrument_no)) AS first_parent_name
   FROM {} WHERE parent_symbol IS NOT NULL GROUP BY parent_symbol HAVING count(*) > 1"""


@query("multi_class_parents", f"WITH {FLAT} {_PARENTS.format('flat')}", "directory_docs")
def _(t):
    return listings.multi_class_parents(_flat(t), position=PLACE)


@query("top_multi_class_parents", f"WITH {FLAT} {_PARENTS.format('flat')} ORDER BY parent_symbol LIMIT 10", "directory_docs")
def _(t):
    return listings.multi_class_parents(_flat(t), 10, PLACE)


@query(
    "variants_of_parent",
    f"WITH {FLAT}, parents AS ({_PARENTS.format('flat')}) SELECT parent_symbol, first_parent_name, symbol, name FROM flat JOIN parents USING (parent_symbol)",
    "directory_docs",
)
def _(t):
    return listings.variants_of_parents(_flat(t), position=PLACE)


_SUFFIXES = rf"""WITH {FLAT} SELECT suffix, count(*) AS symbols FROM (SELECT nullif(regexp_extract(symbol, '\.([A-Z]+)$', 1), '') AS suffix FROM flat)
        WHERE suffix IS NOT NULL GROUP BY suffix"""


@query("suffix_counts", _SUFFIXES, "directory_docs")
def _(t):
    return listings.suffix_counts(_flat(t))


@query("top_suffixes", f"{_SUFFIXES} ORDER BY symbols DESC, suffix LIMIT 20", "directory_docs")
def _(t):
    return listings.suffix_counts(_flat(t), 20)


_TOTALS = """SELECT count(*) AS total, count(*) FILTER (exchange = 'TSX') AS tsx, count(*) FILTER (exchange = 'TSXV') AS tsxv FROM {}"""


@query("exchange_totals", _TOTALS.format("symbol_list"), "symbol_list")
def _(t):
    return listings.exchange_totals(t.symbol_list)


def _directory(t):
    docs = t.directory_docs
    return ca_listings.symbol_directory(docs.where("exchange = 'TSX'"), docs.where("exchange = 'TSXV'"), keep=("ord",))


_SYMBOLS = rf"""SELECT symbol, name, parent_symbol, parent_name,
  CASE WHEN exchange = 'TSX' THEN nullif(regexp_extract(symbol, '\.([A-Z]+)$', 1), '') END AS suffix, exchange FROM flat"""


@query("symbol_directory", f"WITH {FLAT} {_SYMBOLS}", "directory_docs")
def symbol_directory(t):
    return _directory(t).symbols.select("symbol", "name", "parent_symbol", "parent_name", "suffix", "exchange")


@query(
    "symbol_directory_variants",
    f"""WITH {FLAT}, tsx AS (SELECT * FROM flat WHERE exchange = 'TSX'), parents AS ({_PARENTS.format('tsx')})
        SELECT parent_symbol, first_parent_name, symbol, name FROM tsx JOIN parents USING (parent_symbol)""",
    "directory_docs",
)
def _(t):
    return _directory(t).multi_class


@query("symbol_directory_totals", f"WITH {FLAT} {_TOTALS.format('flat')}", "directory_docs")
def _(t):
    return _directory(t).totals


# --- issuers --------------------------------------------------------------------------------

ISSUER_ROWS = f"""issuer_rows AS (SELECT trim(symbol) AS symbol, CASE WHEN parent_symbol IS NULL THEN trim(symbol)
    WHEN trim(parent_symbol) <> '' THEN trim(parent_symbol) ELSE split_part(trim(symbol), '.', 1) END AS root_ticker,
    trim(co_id) AS co_id, upper(trim(exchange)) AS exchange, trim(name) AS name, {duck.num('market_cap')} AS market_cap,
    {duck.num('os_shares')} AS os_shares, CAST(NULL AS VARCHAR) AS source_sheet, ord FROM symbol_list
  WHERE trim(symbol) <> '' AND trim(exchange) <> '')"""


@query("issuer_rows", f"WITH {ISSUER_ROWS} SELECT * FROM issuer_rows", "symbol_list")
def _(t):
    return listings.issuer_rows(t.symbol_list, ["ord"])


@query(
    "ca_issuers",
    f"""WITH {ISSUER_ROWS} SELECT * EXCLUDE (ord) FROM issuer_rows ANTI JOIN stored_issuers USING (symbol)
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ord) = 1""",
    "symbol_list stored_issuers",
)
def ca_issuers(t):
    return ca_listings.ca_issuers(t.symbol_list, t.stored_issuers, ["ord"])


@query("scan_issuers", "SELECT symbol, 'CA' AS exchange, name FROM issuers", "issuers")
def _(t):
    return listings.issuer_scan(t.issuers).orderBy("symbol")


@query("cap_by_symbol", "SELECT symbol, 'CA' AS exchange, name FROM issuers ORDER BY symbol LIMIT 50", "issuers")
def _(t):
    return listings.issuer_scan(t.issuers, cap=50)


@query(
    "cap_by_position",
    f"WITH {duck.OFFICIAL} SELECT symbol, yahoo_symbol, ord FROM official ORDER BY ord LIMIT 50",
    "symbol_list",
)
def _(t):
    return listings.official_symbols(t.symbol_list, ["ord"], cap=50).select("symbol", "yahoo_symbol", "ord")


@query("scan_meta_map", "SELECT symbol, yahoo_symbol FROM meta_stored WHERE yahoo_symbol IS NOT NULL", "meta_stored")
def _(t):
    return listings.vendor_symbol_lookup(t.meta_stored)


@query(
    "meta_lookup_join",
    "SELECT infos.symbol, coalesce(yahoo_symbol, infos.symbol) AS yahoo_symbol FROM infos LEFT JOIN meta_stored USING (symbol)",
    "infos meta_stored",
)
def _(t):
    return listings.with_stored_vendor_symbol(t.infos.select("symbol"), listings.vendor_symbol_lookup(t.meta_stored))


# --- instruments ----------------------------------------------------------------------------


def _text(field: str) -> str:
    return f"json_extract_string(info, '$.{field}')"


def _truthy(field: str) -> str:
    raw = f"CAST(json_extract(info, '$.{field}') AS VARCHAR)"
    return f"coalesce({raw} NOT IN ('null', 'false', '\"\"', '0', '[]', '{{}}'), false)"


def _number(field: str) -> str:
    raw = f"CAST(json_extract(info, '$.{field}') AS VARCHAR)"
    return (
        f"CASE WHEN {raw} = 'true' THEN 1.0::DOUBLE WHEN {raw} = 'false' THEN 0.0::DOUBLE "
        f"WHEN starts_with({raw}, '\"') THEN {duck.strict_num(_text(field))} ELSE try_cast({raw} AS DOUBLE) END"
    )


INSTRUMENTS = f"""found AS (SELECT *, json_keys(info) AS k FROM infos WHERE info IS NOT NULL AND info NOT IN ('{{}}', 'null')),
  flags AS (SELECT symbol, info, coalesce(nullif({_text('quoteType')}, ''), {_text('quote_type')}) AS quote_type, {_text('quoteType')} AS own,
    coalesce(nullif({_text('longName')}, ''), {_text('long_name')}) AS long_name, {_text('category')} AS category,
    ({_truthy('isEtf')} OR {_truthy('isETF')}) AS is_etf, {_truthy('isMutualFund')} AS is_mutual_fund FROM found),
  judged AS (SELECT *, regexp_matches(lower(coalesce(category, '')), 'closed[- ]end') AS is_closed_end_fund,
    contains(lower(coalesce(long_name, '')), 'trust') AS is_trust, lower(coalesce(quote_type, '')) AS ql FROM flags),
  instruments AS (SELECT symbol, quote_type, CASE WHEN is_etf THEN 'etf' WHEN is_mutual_fund THEN 'mutual_fund' WHEN is_closed_end_fund THEN 'closed_end_fund'
      WHEN is_trust THEN 'trust' WHEN ql IN ('equity', 'stock', 'company') THEN 'equity' WHEN contains('fund', ql) THEN 'fund' WHEN contains('etf', ql) THEN 'etf'
      WHEN contains('mutualfund', ql) THEN 'mutual_fund' WHEN contains('index', ql) THEN 'index' ELSE ql END AS asset_type,
    is_etf, is_mutual_fund, is_closed_end_fund, is_trust, lower(coalesce(own, '')) = 'index' AS is_index, category, {_text('fundFamily')} AS fund_family,
    CASE WHEN is_trust THEN 'trust' END AS legal_type, {_text('currency')} AS currency,
    coalesce(nullif({_text('underlyingSymbol')}, ''), {_text('underlying_symbol')}) AS underlying_symbol, {_number('navPrice')} AS nav_price,
    {_number('annualReportExpenseRatio')} AS expense_ratio, {_number('totalAssets')} AS total_assets, {_number('yield')} AS "yield",
    {_number('ytdReturn')} AS ytd_return, {_number('threeYearAverageReturn')} AS three_year_avg_return,
    {_number('fiveYearAverageReturn')} AS five_year_avg_return, {_number('beta3Year')} AS beta_3y, long_name, info AS attributes FROM judged)"""


@query(
    "classify_instrument",
    f"""WITH {INSTRUMENTS} SELECT symbol, quote_type, asset_type, is_etf, is_mutual_fund, is_closed_end_fund, is_trust, is_index, legal_type
        FROM instruments""",
    "infos",
)
def _(t):
    return instruments.classify_instruments(t.infos).select(
        "symbol", "quote_type", "asset_type", "is_etf", "is_mutual_fund", "is_closed_end_fund", "is_trust", "is_index", "legal_type"
    )


@query("meta_projection", f"WITH {INSTRUMENTS} SELECT * FROM instruments", "infos")
def _(t):
    return instruments.classify_instruments(t.infos)


@query(
    "not_found_count",
    """SELECT count(*) AS processed, count(*) FILTER (info IS NULL OR info IN ('{}', 'null')) AS not_found
       FROM issuers LEFT JOIN infos USING (symbol)""",
    "infos issuers",
)
def _(t):
    return ca_listings.ca_instruments_not_found(t.issuers, t.infos)


@query(
    "ca_instruments",
    f"""WITH {INSTRUMENTS} SELECT instruments.*, 'CA' AS exchange, symbol AS yahoo_symbol FROM instruments SEMI JOIN issuers USING (symbol)""",
    "infos issuers",
)
def ca_instruments(t):
    return ca_listings.ca_instruments(t.issuers, t.infos)


@query(
    "ca_instrument_table",
    f"""WITH {INSTRUMENTS}, listed AS (SELECT * FROM instruments SEMI JOIN issuers USING (symbol))
        SELECT symbol, yahoo_symbol, long_name, nav_price FROM meta_stored ANTI JOIN listed USING (symbol)
        UNION ALL SELECT symbol, symbol, long_name, nav_price FROM listed""",
    "infos issuers meta_stored",
)
def _(t):
    return ca_listings.ca_instrument_table(t.issuers, t.infos, t.meta_stored, ["ord"])
