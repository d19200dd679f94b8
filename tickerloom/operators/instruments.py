"""Instrument classification from vendor info payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.payload import is_truthy, number_value, text_value

# Quote types that mean common equity; then the type names tested in this order,
# each matched when the quote type is a *part* of the name, with the asset type it stands for.
EQUITY_TYPES = ["equity", "stock", "company"]
TYPE_NAMES = {"fund": "fund", "etf": "etf", "mutualfund": "mutual_fund", "index": "index"}
CLOSED_END_WORDS = ["closed-end", "closed end"]
# Target column -> payload field.
NUMERIC_FIELDS = {
    "nav_price": "navPrice",
    "expense_ratio": "annualReportExpenseRatio",
    "total_assets": "totalAssets",
    "yield": "yield",
    "ytd_return": "ytdReturn",
    "three_year_avg_return": "threeYearAverageReturn",
    "five_year_avg_return": "fiveYearAverageReturn",
    "beta_3y": "beta3Year",
}
# Field names differ in case only in places, so the payload is read as a map, not as a struct.
_PAYLOAD = "map<string, variant>"


def has_info(info: Column) -> Column:
    """True for a JSON object with at least one field."""
    return _is_filled(F.from_json(info, _PAYLOAD))


def _is_filled(fields: Column) -> Column:
    return F.coalesce(F.size(fields) > 0, F.lit(False))


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def asset_type(quote_type: Column, is_etf: Column, is_mutual: Column, is_closed_end: Column, is_trust: Column, strict: bool = False) -> Column:
    """Flags first, then the quote type.

    An empty quote type is a part of every type name, so it counts as the first of them, ``fund``.
    ``strict`` gives ``unknown`` instead.
    """
    kind = _lower(quote_type)
    result = (
        F.when(is_etf, "etf").when(is_mutual, "mutual_fund").when(is_closed_end, "closed_end_fund").when(is_trust, "trust")
    )
    if strict:
        result = result.when(kind == "", "unknown")
    result = result.when(kind.isin(EQUITY_TYPES), "equity")
    for name, meaning in TYPE_NAMES.items():
        result = result.when(F.contains(F.lit(name), kind), meaning)
    return result.otherwise(kind)


def classify_instruments(infos: DataFrame, keep: tuple[str, ...] = ("symbol",), strict: bool = False) -> DataFrame:
    """Info payloads (``info`` JSON text) -> instrument columns; symbols without info are dropped."""
    # Dropping empty payloads by an explode parses each payload once; a filter on the parsed map
    # would be pushed below the projection and parse it again.
    parsed = infos.select(
        *keep, "info", F.explode(F.filter(F.array(F.from_json("info", _PAYLOAD)), _is_filled)).alias("p")
    )
    field = lambda name: F.try_element_at("p", F.lit(name))
    text = lambda name: text_value(field(name))
    # a false or 0 in a text field is passed over like an empty text
    either = lambda name, other: F.when(is_truthy(field(name)), text(name)).otherwise(text(other))
    flat = parsed.select(
        *keep,
        "info",
        either("quoteType", "quote_type").alias("quote_type"),
        text("quoteType").alias("own_quote_type"),
        either("longName", "long_name").alias("long_name"),
        text("category").alias("category"),
        text("fundFamily").alias("fund_family"),
        text("currency").alias("currency"),
        either("underlyingSymbol", "underlying_symbol").alias("underlying_symbol"),
        (is_truthy(field("isEtf")) | is_truthy(field("isETF"))).alias("is_etf"),
        is_truthy(field("isMutualFund")).alias("is_mutual_fund"),
        *(number_value(field(source)).alias(target) for target, source in NUMERIC_FIELDS.items()),
    )
    category = _lower(F.col("category"))
    closed_end = category.contains(CLOSED_END_WORDS[0]) | category.contains(CLOSED_END_WORDS[1])
    trust = _lower(F.col("long_name")).contains("trust")
    kind = asset_type(
        F.col("quote_type"), F.col("is_etf"), F.col("is_mutual_fund"),
        F.col("is_closed_end_fund"), F.col("is_trust"), strict,
    )
    return flat.withColumns({"is_closed_end_fund": closed_end, "is_trust": trust}).select(
        *keep,
        "quote_type",
        kind.alias("asset_type"),
        "is_etf",
        "is_mutual_fund",
        "is_closed_end_fund",
        "is_trust",
        (_lower(F.col("own_quote_type")) == "index").alias("is_index"),
        "category",
        "fund_family",
        F.when(F.col("is_trust"), "trust").alias("legal_type"),
        "currency",
        "underlying_symbol",
        *NUMERIC_FIELDS,
        "long_name",
        F.col("info").alias("attributes"),
    )


def not_found_count(infos: DataFrame) -> DataFrame:
    """Symbols looked up and symbols without an info payload."""
    return infos.agg(
        F.count("*").alias("processed"), F.count_if(~has_info(F.col("info"))).alias("not_found")
    )
