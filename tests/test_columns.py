"""Column builders against hand-derived rows."""

import datetime
import math

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerloom.functions import dates, numbers, payload, reports, symbols

c = F.col


def test_number_takes_separators_and_rejects_other_spellings(texts):
    values = ["1,234.5", " 1.5 ", "", "abc", "1.0d", "1f", "0x1p3", "1_000", "-.5e3", "5.", None, "1__0", "inf", "-Infinity", "nan"]
    want = [1234.5, 1.5, None, None, None, None, None, 1000.0, -500.0, 5.0, None, None, math.inf, -math.inf, None]
    assert texts(numbers.number, values) == want


def test_strict_number_has_no_separators(texts):
    assert texts(numbers.number_strict, ["1,234", "1234"]) == [None, 1234.0]


def test_first_value_rules(one):
    rows, schema = [("abc", "7"), (None, "8"), ("9", None)], "a string, b string"
    assert one(rows, schema, numbers.first_parsed(c("a"), c("b"))) == [7.0, 8.0, 9.0]
    assert one(rows, schema, numbers.first_raw(c("a"), c("b"))) == [None, 8.0, 9.0]


def test_first_truthy_passes_over_zero_but_keeps_the_last(one):
    rows, schema = [(0.0, None, 5.0), (0.0, None, 0.0), (None, None, None), (3.0, 2.0, 1.0)], "a double, b double, d double"
    assert one(rows, schema, numbers.first_truthy(c("a"), c("b"), c("d"))) == [5.0, 0.0, None, 3.0]


def test_missing_texts(texts):
    assert texts(numbers.missing_as_null, ["NA", "n/a", "", "NAN", "0", None]) == [None, None, None, "NAN", "0", None]


def test_whole_volume(one):
    rows = [(12.9,), (-12.9,), (None,), (1e30,), (math.inf,)]
    assert one(rows, "x double", numbers.whole_volume(c("x"))) == [12, -12, None, None, None]


def test_fixed_text_known_ties(one):
    values = [1.005, 0.125, -0.001, 2.675, 0.0, -0.0, 1e15, 12345.678, 0.375, 99.995, None]
    values += [698585663263148.1, 2.0**52 / 100, 2.0**53 - 0.5, 2.0**53, 2.0**62, 2.0**63, 1e22, 1e300, 1.7976931348623157e308]
    values += [math.inf, -math.inf, math.nan, -1e25, 90071992547409.995, 45035996273704.955]
    got = one([(v,) for v in values], "x double", numbers.fixed_text(c("x"), 2))
    assert got == [None if v is None else f"{v:.2f}" for v in values]


@settings(max_examples=5, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.floats(-1e12, 1e12), st.floats(4e13, 1e17), st.floats(allow_subnormal=False), st.integers(-10**7, 10**7).map(lambda i: i / 1000)), min_size=200, max_size=400))
def test_fixed_text_rounds_like_a_binary_formatter(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    rows = frame.select("x", numbers.fixed_text(c("x"), 2), numbers.fixed_text(c("x"), 4)).collect()
    for value, two, four in rows:
        assert two == f"{value:.2f}"
        assert four == f"{value:.4f}"


def test_lenient_day(texts):
    day = datetime.date(2020, 12, 31)
    values = ["2020-12-31", "20201231", "12/31/2020", "2020-12-31 10:00:00", "2020/12/31", "31 Dec 2020", "Dec 31, 2020", "12-31-2020"]
    values += ["31/12/2020", "12/31/20", " 12/31/2020 10:30", "December 31, 2020", "31-Dec-2020"]
    assert texts(dates.lenient_day, values) == [day] * len(values)
    assert texts(dates.strict_day, values) == [day] * len(values)
    assert texts(dates.lenient_day, ["2020-13-01", "TTM", "", None]) == [None] * 4
    assert texts(dates.lenient_day, ["1/31/2024", "1/2/2024"]) == [datetime.date(2024, 1, 31), datetime.date(2024, 1, 2)]
    assert texts(dates.lenient_day, ["12/31/95"]) == [datetime.date(1995, 12, 31)]


def test_epoch_day_is_utc_whatever_the_session(spark, one):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = one([(0, 1704067200), (None, 0), (1704153599, 5)], "a bigint, b bigint", dates.first_epoch_day(c("a"), c("b")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # the last candidate is passed over too when it is 0: there is no time
    assert got == [datetime.date(2024, 1, 1), None, datetime.date(2024, 1, 1)]


def test_vendor_symbol(one):
    rows = [
        ("ACO.X", "TSX"), ("BN.PF.E", "TSX"), ("BN.PR.A", "TSX"), ("TD.PR.P", "TSX"), ("ACD.DB", "TSX"), ("AAAJ.P", "TSXV"),
        ("A.UN", "TSX"), ("A.B.U", "TSX"), ("A.WT.B", "NEO"), ("A.RT", "TSXV"), ("RY", "TSX"), ("A.UX", "TSX"),
    ]
    want = [
        "ACO-X.TO", "BN.PR.E.TO", "BN.PR.A.TO", "TD.PR.P.TO", "ACD.DB.TO", "AAAJ-P.V",
        "A.UN.TO", "A.B.U.TO", "A.WT.B.TO", "A.RT.V", "RY.TO", "A-UX.TO",
    ]
    assert one(rows, "s string, e string", symbols.vendor_symbol(c("s"), c("e"))) == want


def test_roots_with_exchange_suffix(one):
    rows = [(" bam.a ", "TSX"), ("X", "venture"), ("X", "CN"), ("X", "Neo Exchange"), ("X", "NYSE"), ("", "TSX"), (None, None)]
    assert one(rows, "r string, e string", symbols.hyphenated_root_with_suffix(c("r"), c("e"))) == [
        "BAM-A.TO", "X.V", "X.CN", "X.NE", "X", "", "",
    ]
    assert one(rows, "r string, e string", symbols.root_with_suffix(c("r"), c("e"))) == [
        "BAM.A.TO", "X.V", "X.CN", "X.NE", "X", ".TO", "",
    ]


def test_hyphenate_classes(texts):
    assert texts(symbols.hyphenate_classes, ["A.B.TO", "A.TO", "A", "", None, "A.B.C.V"]) == ["A-B.TO", "A.TO", "A", "", "", "A-B-C.V"]


def test_variants(one, texts):
    assert texts(symbols.unit_variants, ["IGBT.TO", "A.B.TO", "X"]) == [
        ["IGBT-UN.TO", "IGBT-U.TO"], ["A-UN.B.TO", "A-U.B.TO"], [],
    ]
    rows = [("AGF.TO", "AGF Class B"), ("X.Y.V", "A REIT class A"), ("X.V", None), ("X", "Trust")]
    assert one(rows, "s string, n string", symbols.class_variants(c("s"), c("n"))) == [
        ["AGF-B.TO", "AGF-A.TO", "AGF-X.TO", "AGF-Y.TO"],
        ["X.Y-UN.V", "X.Y-U.V", "X.Y-A.V", "X.Y-B.V", "X.Y-X.V", "X.Y-Y.V"],
        ["X-B.V", "X-A.V", "X-X.V", "X-Y.V"],
        [],
    ]


def test_listing_suffix(texts):
    assert texts(symbols.listing_suffix, ["ACO.X", "RY", "A.PF.E", "A.1", None]) == ["X", None, "E", None, None]


def test_root_ticker(one):
    rows = [("ACO.X", None), ("ACO.X", " "), ("ACO.X", " P "), ("RY", "")]
    assert one(rows, "s string, p string", symbols.root_ticker(c("s"), c("p"))) == ["ACO.X", "ACO", "P", "RY"]


def test_price_change(one):
    rows = [(243.49, 245.73), (5.0, 0.0), (5.0, None), (None, 5.0), (2.0, 4.0)]
    change = one(rows, "p double, q double", reports.price_change(c("p"), c("q")))
    assert change == [243.49 - 245.73, None, None, None, -2.0]
    assert one(rows, "p double, q double", reports.price_change_percent(c("p"), c("q"))) == ["-0.91%", None, None, None, "-50.00%"]


def test_run_status_and_message(one):
    rows, schema = [(0, 0), (100, 1), (100, 2), (100, 0), (3, 1)], "t bigint, e bigint"
    assert one(rows, schema, reports.run_status(c("t"), c("e"))) == ["success", "warning", "error", "success", "error"]
    message = reports.run_message("symbols", "success", c("t"), c("t") - c("e"), c("e"))
    assert one(rows, schema, message)[4] == "symbols total=3 success=2 errors=1 rate=0.3333"
    details = reports.run_details("tickers", "inserted", c("t"), c("t") - c("e"), c("e"))
    assert one(rows, schema, details)[4] == '{"tickers":{"total":3,"inserted":2,"errors":1,"error_rate":0.333333}}'


def test_run_details_lead_with_the_context(one):
    details = reports.run_details("tickers", "inserted", c("t"), c("t"), c("e"), {"market": "us", "batch": 5000})
    assert one([(2, 0)], "t bigint, e bigint", details) == [
        '{"market":"us","batch":5000,"tickers":{"total":2,"inserted":2,"errors":0,"error_rate":0.000000}}'
    ]


def test_truthiness_of_json(one):
    values = ["false", '"false"', "0", "0.0", "1", '""', "[]", "{}", "null", "true", '"0"', "[0]"]
    rows = [('{"f": %s}' % v,) for v in values] + [("{}",)]
    field = F.try_element_at(F.from_json("j", "map<string, variant>"), F.lit("f"))
    want = [False, True, False, False, True, False, False, False, False, True, True, True, False]
    assert one(rows, "j string", payload.is_truthy(field)) == want
    numbers_ = [0.0, None, 0.0, 0.0, 1.0, None, None, None, None, 1.0, 0.0, None, None]
    assert one(rows, "j string", payload.number_value(field)) == numbers_


def test_days_with_short_years_months_and_quarters(texts):
    D = datetime.date
    forms = {
        "31-Dec-20": D(2020, 12, 31), "12-31-20": D(2020, 12, 31), "12.31.20": D(2020, 12, 31), "31-12-20": D(2020, 12, 31), "1-Dec-69": D(1969, 12, 1),
        "Dec 2020": D(2020, 12, 1), "December 2020": D(2020, 12, 1), "Dec-2020": D(2020, 12, 1), "5-May-1999": D(1999, 5, 5), "Dec 5 2020": D(2020, 12, 5),
        "2020Q1": D(2020, 1, 1), "2020-Q3": D(2020, 7, 1), "2020q4": D(2020, 10, 1), "2020Q5": None, "Foo 2020": None, "TTM": None, "x1": None,
    }
    assert texts(dates.lenient_day, list(forms)) == list(forms.values())
