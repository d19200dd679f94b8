"""DuckDB fragments the oracle texts share."""

from __future__ import annotations

_DIGITS = r"\d+(_\d+)*"
NUMBER = (
    rf"\s*[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*"
)


def strict_num(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '{NUMBER}') THEN try_cast(replace(trim({x}), '_', '') AS DOUBLE) END)"


def num(x: str) -> str:
    return strict_num(f"replace({x}, ',', '')")


def day(x: str) -> str:
    iso = rf"regexp_replace(regexp_replace(trim({x}), '^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})\b', '\3-\1-\2'), '^(\d{{4}})(\d{{2}})(\d{{2}})$', '\1-\2-\3')"
    forms = ["%m/%d/%y", "%d/%m/%y", "%Y%m%d", "%Y/%m/%d", "%Y.%m.%d", "%m/%d/%Y", "%m-%d-%Y", "%m.%d.%Y", "%m/%d/%y", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y"]
    forms += ["%d %b %Y", "%d %B %Y", "%d-%b-%Y", "%b %d, %Y", "%B %d, %Y"]
    return f"coalesce(try_cast({iso} AS DATE), try_strptime(trim({x}), {forms})::DATE)"


def volume(x: str) -> str:
    return f"try_cast(trunc({x}) AS BIGINT)"


def change(price: str, prev: str) -> str:
    return f"(CASE WHEN {prev} <> 0 THEN {price} - {prev} END)"


def change_percent(price: str, prev: str) -> str:
    return f"(CASE WHEN {prev} <> 0 AND {price} IS NOT NULL THEN printf('%.2f%%', ({price} - {prev}) / {prev} * 100) END)"


def rate(total: str, errors: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN {errors}::DOUBLE / {total} ELSE 0.0::DOUBLE END)"


def status(total: str, errors: str) -> str:
    return f"(CASE WHEN {errors} = 0 THEN 'success' WHEN {rate(total, errors)} <= 0.01 THEN 'warning' ELSE 'error' END)"


def message(item: str, label: str, total: str, done: str, errors: str) -> str:
    return f"concat('{item} total=', {total}, ' {label}=', {done}, ' errors=', {errors}, ' rate=', printf('%.4f', {rate(total, errors)}))"


def details(item: str, label: str, total: str, done: str, errors: str) -> str:
    return (
        f"concat('{{\"{item}\":{{\"total\":', {total}, ',\"{label}\":', {done}, ',\"errors\":', {errors}, "
        f"',\"error_rate\":', CAST({rate(total, errors)} AS DECIMAL(9,6)), '}}}}')"
    )


def vendor(symbol: str, exchange: str) -> str:
    s = symbol
    return (
        f"concat(CASE WHEN contains({s}, '.PF.') THEN replace({s}, '.PF.', '.PR.') "
        f"WHEN regexp_matches({s}, '\\.PR\\.|\\.DB|\\.WT|\\.RT|\\.UN?$') THEN {s} "
        f"ELSE replace({s}, '.', '-') END, CASE WHEN {exchange} = 'TSXV' THEN '.V' ELSE '.TO' END)"
    )


# Official symbols and the vendor-symbol map from the ``symbol_list`` view.
OFFICIAL = f"""official AS (
  SELECT *, {vendor('symbol', 'exchange')} AS yahoo_symbol FROM (
    SELECT upper(trim(symbol)) AS symbol, upper(trim(exchange)) AS exchange, upper(trim(parent_symbol)) AS parent_symbol, ord
    FROM symbol_list WHERE symbol IS NOT NULL AND exchange IS NOT NULL)
  WHERE symbol <> '')"""
SYMBOL_MAP = """symbol_map AS (
  SELECT yahoo_symbol AS vendor_symbol, symbol, ord AS place FROM official
  QUALIFY row_number() OVER (PARTITION BY yahoo_symbol ORDER BY ord DESC) = 1)"""
