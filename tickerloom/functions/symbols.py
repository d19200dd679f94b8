"""Symbol conversion between the exchange's spelling and the data vendor's."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange names and the vendor suffix of each.
EXCHANGE_SUFFIXES = {
    ".TO": ["TSX", "TSX-MKT", "TORONTO"],
    ".V": ["TSXV", "TSX-V", "VENTURE"],
    ".CN": ["CSE", "CN", "CANADIAN SECURITIES EXCHANGE"],
    ".NE": ["NEO", "NEO-L", "NEO EXCHANGE"],
}
# Share-class markers whose dots the vendor keeps.
DOTTED_MARKERS = [".PR.", ".DB", ".WT", ".RT"]
DOTTED_ENDINGS = [".UN", ".U"]
# Variant suffixes, by hint in the instrument name and for every instrument.
UNIT_NAME_HINTS = ["reit", "trust", "fund"]
UNIT_SUFFIXES = ["-UN", "-U"]
CLASS_NAME_HINTS = {"class b": "-B", "class a": "-A"}
COMMON_SUFFIXES = ["-B", "-A", "-X", "-Y"]


def strip(text: Column) -> Column:
    """Trim blanks, tabs and line ends."""
    return F.btrim(text, F.lit(" \t\r\n\f\v"))


def upper_trim(text: Column) -> Column:
    return F.upper(strip(text))


def is_filled(text: Column) -> Column:
    """True when a key is neither null nor blank."""
    return F.coalesce(strip(text) != "", F.lit(False))


def market_code(exchange: Column) -> Column:
    """Every Canadian exchange is stored under one market code."""
    return F.lit("CA")


def _any(conditions) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def vendor_symbol(symbol: Column, exchange: Column) -> Column:
    """Listing symbol -> vendor symbol, e.g. ``ACO.X`` on TSX -> ``ACO-X.TO``.

    ``.PF.`` preferreds become ``.PR.``; preferreds, debentures, warrants, rights and units keep
    their dots; any other dot turns into a hyphen. Unknown exchanges count as the senior one.
    """
    marks = [re.escape(m) for m in DOTTED_MARKERS] + [re.escape(e) + r"\z" for e in DOTTED_ENDINGS]
    keeps_dots = symbol.rlike("|".join(marks))
    base = (
        F.when(symbol.contains(".PF."), F.replace(symbol, F.lit(".PF."), F.lit(".PR.")))
        .when(keeps_dots, symbol)
        .otherwise(F.replace(symbol, F.lit("."), F.lit("-")))
    )
    return F.concat(base, F.when(exchange == "TSXV", ".V").otherwise(".TO"))


def _exchange_suffix(exchange: Column) -> Column:
    name = F.coalesce(upper_trim(exchange), F.lit(""))
    suffix = F.lit("")
    for text, names in EXCHANGE_SUFFIXES.items():
        suffix = F.when(name.isin(names), text).otherwise(suffix)
    return suffix


def root_with_suffix(root: Column, exchange: Column) -> Column:
    """Root plus the exchange's suffix; a blank root still gets the suffix."""
    return F.concat(F.coalesce(upper_trim(root), F.lit("")), _exchange_suffix(exchange))


def hyphenated_root_with_suffix(root: Column, exchange: Column) -> Column:
    """:func:`root_with_suffix` with class dots as hyphens; a blank root gives ``''``."""
    name = F.coalesce(upper_trim(root), F.lit(""))
    joined = F.concat(F.replace(name, F.lit("."), F.lit("-")), _exchange_suffix(exchange))
    return F.when(name == "", "").otherwise(joined)


def hyphenate_classes(symbol: Column) -> Column:
    """Hyphens for all dots but the last one; a symbol without a dot is unchanged."""
    text = F.coalesce(symbol, F.lit(""))
    head = F.regexp_extract(text, r"(?s)^(.*)\.([^.]*)$", 1)
    tail = F.regexp_extract(text, r"(?s)^(.*)\.([^.]*)$", 2)
    spelled = F.concat(F.replace(head, F.lit("."), F.lit("-")), F.lit("."), tail)
    return F.when(text.contains("."), spelled).otherwise(text)


def unit_variants(symbol: Column) -> Column:
    """``IGBT.TO`` -> ``[IGBT-UN.TO, IGBT-U.TO]``, split at the first dot; no dot gives ``[]``."""
    at = F.locate(".", symbol)
    base, ext = F.substr(symbol, F.lit(1), at - 1), F.substr(symbol, at)
    return F.when(at > 0, F.array(*(F.concat(base, F.lit(s), ext) for s in UNIT_SUFFIXES))).otherwise(
        F.array().cast("array<string>")
    )


def class_variants(symbol: Column, name: Column) -> Column:
    """Candidate share-class spellings, the ones the name hints at first; no dot gives ``[]``."""
    hint = F.lower(F.coalesce(name, F.lit("")))
    none = F.array().cast("array<string>")

    def some(condition: Column, suffixes: list[str]) -> Column:
        return F.when(condition, F.array(*(F.lit(s) for s in suffixes))).otherwise(none)

    suffixes = F.array_distinct(
        F.concat(
            some(_any(hint.contains(h) for h in UNIT_NAME_HINTS), UNIT_SUFFIXES),
            *(some(hint.contains(h), [s]) for h, s in CLASS_NAME_HINTS.items()),
            F.array(*(F.lit(s) for s in COMMON_SUFFIXES)),
        )
    )
    ext = F.concat(F.lit("."), F.substring_index(symbol, ".", -1))
    base = F.substr(symbol, F.lit(1), F.length(symbol) - F.length(ext))
    spelled = F.transform(suffixes, lambda s: F.concat(base, s, ext))
    return F.when(symbol.contains("."), spelled).otherwise(none)


def listing_suffix(symbol: Column) -> Column:
    """The capital letters after the last dot, null when there are none."""
    return F.nullif(F.regexp_extract(symbol, r"\.([A-Z]+)$", 1), F.lit(""))


def root_ticker(symbol: Column, parent: Column) -> Column:
    """The parent when given; a blank parent gives the symbol up to its first dot, none the symbol."""
    return (
        F.when(parent.isNull(), strip(symbol))
        .when(strip(parent) != "", strip(parent))
        .otherwise(F.substring_index(strip(symbol), ".", 1))
    )
