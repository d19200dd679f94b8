"""Operators against hand-derived rows, and their properties."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tickerloom.operators import bars, coverage, gate, instruments, listings, merge, ranking, runlog, statements
from tickerloom.plans import ca_financials, ca_listings, ca_prices, us_financials, us_prices
from tickerloom.sources import files, payloads

D = datetime.date
BULK = "Ticker string, Date string, DateTime string, Open string, High string, Low string, Close string, `Adj. Close` string, Volume string, ord int"


def bulk(spark, *rows):
    """Rows of (ticker, date, time, close, adjusted close), in file order."""
    return spark.createDataFrame(
        [(t, d, x, "1", "1", "1", close, adj, "10.9", i) for i, (t, d, x, close, adj) in enumerate(rows)], BULK
    )


def keyed(frame, *columns):
    return {r[0]: (tuple(r[1:]) if len(r) > 2 else r[1]) for r in frame.select(*columns).collect()}


def test_latest_bar_prefers_a_missing_time_and_then_the_last_row(spark):
    rows = bulk(
        spark,
        ("a", "2024-01-02", "2024-01-02 10:00:00", "1", None),
        ("A", "2024-01-02", None, "2", None),
        ("A", "2024-01-02", "2024-01-02 11:00:00", "3", None),
        ("B", "2024-01-01", "x", "4", None),
        ("B", "2024-01-01", None, "5", None),
        ("C", None, None, "6", None),
        (None, "2024-01-01", None, "7", None),
    )
    assert keyed(bars.latest_bar(bars.bulk_bars(rows), ["ord"]), "symbol", "Close") == {"A": "2", "B": "5"}


def test_previous_close_is_the_second_last_row_of_the_untimed_order(spark):
    rows = bulk(
        spark,
        ("A", "2024-01-01", "2024-01-01 10:00:00", "1", None),
        ("A", "2024-01-02", "2024-01-02 12:00:00", "2", None),
        ("A", "2024-01-02", "2024-01-02 11:00:00", "3", None),
        ("B", "2024-01-01", None, "4", None),
        ("C", "2024-01-01", None, None, "5"),
        ("C", "2024-01-02", None, "6", None),
        ("D", "2024-01-01", None, "abc", "5"),
        ("D", "2024-01-02", None, "6", None),
    )
    got = keyed(bars.latest_with_previous(bars.bulk_bars(rows), ["ord"], timed=True), "symbol", "Close", "previous_close")
    assert got == {"A": ("2", 2.0), "B": ("4", None), "C": ("6", 5.0), "D": ("6", None)}
    assert keyed(bars.previous_close(bars.bulk_bars(rows), ["ord"]), "symbol", "previous_close") == {
        "A": 2.0, "B": None, "C": 5.0, "D": None,
    }
    untimed = bars.bulk_bars(rows.drop("DateTime"))
    got = keyed(bars.latest_with_previous(untimed, ["ord"], timed=False), "symbol", "Close", "previous_close")
    assert got == {"A": ("3", 2.0), "B": ("4", None), "C": ("6", 5.0), "D": ("6", None)}


def test_bad_price_date_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bars.bulk_bars(bulk(spark, ("A", "soon", None, "1", None))).collect()


def test_us_prices_gate_universe_and_unparseable_close(spark):
    rows = bulk(
        spark,
        ("NEW", "2024-01-01", None, "100", None), ("NEW", "2024-01-02", None, "101", None),
        ("SAME", "2024-01-02", None, "1", None), ("LATER", "2024-01-03", None, "1", None),
        ("OTHER", "2024-01-02", None, "1", None), ("BAD", "2024-01-02", None, "abc", "7"),
    )
    financials = spark.createDataFrame([(s, "US") for s in ("NEW", "SAME", "LATER", "BAD")] + [("OTHER", "CA")], "ticker string, exchange string")
    stored = spark.createDataFrame(
        [("SAME", "US", D(2024, 1, 2)), ("LATER", "US", D(2024, 1, 2)), ("NEW", "CA", D(2025, 1, 1))],
        "symbol string, exchange string, latest_day date",
    )
    got = us_prices.us_prices(rows, financials, stored, ["ord"], "daily")
    assert keyed(got, "symbol", "price", "previous_close", "change", "change_percent", "volume") == {
        "NEW": (101.0, 100.0, 1.0, "1.00%", 10), "LATER": (1.0, None, None, None, 10),
    }
    found = us_prices.us_price_bars(rows, financials, ["ord"], "daily")
    assert keyed(gate.gate_outcomes(found, stored, "US"), "symbol", "outcome") == {
        "NEW": "inserted", "LATER": "inserted", "SAME": "skipped", "BAD": "skipped",
    }
    # appending what was accepted leaves nothing more to append
    again = us_prices.us_prices(rows, financials, stored.unionByName(got.select(*stored.columns)), ["ord"], "daily")
    assert again.count() == 0


def test_gate_by_time(spark):
    schema = "symbol string, exchange string, latest_day date, as_of timestamp_ntz"
    at = datetime.datetime
    stored = spark.createDataFrame(
        [(s, "US", D(2024, 1, 2), at(2024, 1, 2, 10)) for s in ("NEWER", "OLDER", "NOTIME")], schema
    )
    found = spark.createDataFrame(
        [("NEWER", "US", D(2024, 1, 2), at(2024, 1, 2, 11)), ("OLDER", "US", D(2024, 1, 2), at(2024, 1, 2, 9)),
         ("NOTIME", "US", D(2024, 1, 3), None), ("UNSEEN", "US", D(2024, 1, 1), None)],
        schema,
    )
    accepted, rejects = gate.gate_by_time(found, stored, "US")
    assert sorted(r.symbol for r in accepted.collect()) == ["NEWER", "UNSEEN"]
    assert [r.symbol for r in rejects.collect()] == ["NOTIME"]
    timeless = found.withColumn("as_of", F.lit(None).cast("timestamp_ntz"))
    accepted, rejects = gate.gate_by_time(timeless, stored, "US")
    assert sorted(r.symbol for r in accepted.collect()) == ["NOTIME", "UNSEEN"]
    assert rejects.count() == 0


def test_panel_bars(spark):
    schema = "ticker string, date date, Open double, High double, Low double, Close double, Volume bigint"
    d1, d2, d3 = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    full = lambda t, d, x: (t, d, x, x, x, x, 1)
    empty = lambda t, d: (t, d, None, None, None, None, None)
    rows = [
        full("A", d1, 1.0), full("A", d2, 2.0), full("A", d3, 3.0),
        full("GAP", d1, 1.0), full("GAP", d2, 2.0), empty("GAP", d3),
        empty("NONE", d2), empty("NONE", d3), full("NONE", d1, 9.0),
        ("NOCLOSE", d3, 1.0, 1.0, 1.0, None, 1), full("NOCLOSE", d2, 1.0),
        ("PREV", d2, 1.0, 1.0, 1.0, None, 1), full("PREV", d3, 4.0),
        ("NAN", d3, 1.0, 1.0, 1.0, float("nan"), 1),
    ]
    got = bars.panel_bars(spark.createDataFrame(rows, schema))
    assert keyed(got, "vendor_symbol", "price", "previous_close", "latest_day") == {
        "A": (3.0, 2.0, d3), "GAP": (2.0, None, d2), "PREV": (4.0, None, d3),
    }


def test_panel_to_long(spark):
    panel = spark.createDataFrame([(1, *range(10))], ["date"] + [f"{t}|{f}" for t in ("A.TO", "B") for f in payloads.BAR_FIELDS])
    assert keyed(payloads.panel_to_long(panel), "ticker", "Open", "Volume") == {"A.TO": (0, 4), "B": (5, 9)}
    flat = spark.createDataFrame([(1, 1, 2, 3, 4, 5)], ["date", *payloads.BAR_FIELDS])
    assert keyed(payloads.panel_to_long(flat, ticker="X"), "ticker", "Close") == {"X": 4}


def test_price_fallback_chooses_before_the_gate(spark):
    names = ["lastPrice", "last_price", "regularMarketPrice", "open", "dayHigh", "regularMarketDayHigh", "dayLow", "regularMarketDayLow"]
    schema = "symbol string, " + ", ".join(f"{n} double" for n in names) + ", lastVolume bigint, regularMarketVolume bigint, regularMarketTime bigint, lastMarketTime bigint"
    day = 1704153600  # 2024-01-02
    rows = [
        ("FAST.TO", 0.0, None, 5.0, 1.0, 0.0, 9.0, None, 2.0, 0, 7, 0, day),
        ("NONE.TO", 0.0, 0.0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1, day, None),
        ("STALE.TO", 3.0, None, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1, None, None),
        ("NAN.TO", float("nan"), 7.0, 7.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 1, day, None),
    ]
    fast = spark.createDataFrame(rows, schema)
    history = spark.createDataFrame(
        [(s, D(2024, 1, d), 1.0, 1.0, 1.0, close, 5.0, i) for i, (s, d, close) in enumerate(
            [("FAST.TO", 9, 8.0), ("NONE.TO", 3, 1.5), ("NONE.TO", 4, 2.5), ("STALE.TO", 9, 8.0), ("HIST.TO", 3, 1.0), ("HIST.TO", 4, None), ("NAN.TO", 4, 6.0)])],
        "symbol string, date date, Open double, High double, Low double, Close double, Volume double, ord int",
    )
    listing = spark.createDataFrame(
        [(s, "TSX", s, i) for i, s in enumerate(["FAST", "NONE", "STALE", "HIST", "NAN"])], "symbol string, exchange string, parent_symbol string, ord int"
    )
    stored = spark.createDataFrame([("STALE", "CA", D(2024, 1, 5))], "symbol string, exchange string, latest_day date")
    got = ca_prices.ca_prices_fallback(listing, fast, history, stored, ["ord"], ["ord"], F.lit("2024-01-05").cast("date"))
    assert keyed(got, "symbol", "price", "high", "volume", "latest_day") == {
        "FAST": (5.0, 9.0, 7, D(2024, 1, 2)), "NONE": (2.5, 1.0, 5, D(2024, 1, 4)),
        "NAN": (6.0, 1.0, 5, D(2024, 1, 4)),
    }


def test_quotes_last_duplicate_wins_and_summary_is_the_second_choice(spark):
    docs = [
        (1, '{"quoteResponse":{"result":[{"symbol":"A","regularMarketPrice":1},{"symbol":"A","regularMarketPrice":2},{"symbol":""}]}}'),
        (2, '{"quoteResponse":{"result":[]},"quoteSummary":{"result":[{"symbol":"B","regularMarketPrice":"1,000"}]}}'),
        (3, '{"quoteResponse":{"result":[{"symbol":"C"}]},"quoteSummary":{"result":[{"symbol":"D"}]}}'),
        (4, "{}"),
    ]
    got = payloads.flatten_quotes(spark.createDataFrame(docs, "ord int, payload string"), ["ord"])
    assert keyed(got, "symbol", "regularMarketPrice") == {"A": 2.0, "B": 1000.0, "C": None}


def test_directory(spark):
    doc = (
        '{"results":[{"symbol":"ACO.X","name":"ATCO Ltd.","instruments":[{"symbol":"ACO.X","name":"ATCO Ltd. Cl I NV"},'
        '{"symbol":"ACO.Y","name":"ATCO Ltd. Cl II"},{"symbol":""},{"name":"x"}]},{"symbol":"RY"},'
        '{"instruments":[{"symbol":"Z"}]},{"symbol":"S","name":"Solo","instruments":[{"symbol":"S.UN"}]}]}'
    )
    docs = spark.createDataFrame([(doc,), ('{"other":1}',)], "payload string")
    found = ca_listings.symbol_directory(docs, docs.limit(0))
    rows = keyed(found.symbols, "symbol", "name", "parent_symbol", "parent_name", "suffix", "exchange")
    assert rows == {
        "ACO.X": ("ATCO Ltd. Cl I NV", "ACO.X", "ATCO Ltd.", "X", "TSX"),
        "ACO.Y": ("ATCO Ltd. Cl II", "ACO.X", "ATCO Ltd.", "Y", "TSX"),
        "Z": ("", "", "", None, "TSX"), "S.UN": ("", "S", "Solo", "UN", "TSX"),
    }
    assert {r.symbol for r in found.multi_class.collect()} == {"ACO.X", "ACO.Y"}
    assert keyed(found.suffixes, "suffix", "symbols") == {"X": 1, "Y": 1, "UN": 1}
    assert found.totals.collect()[0].asDict() == {"total": 4, "tsx": 4, "tsxv": 0}


def test_vendor_symbol_map_keeps_the_last_listing(spark):
    rows = [("A.PF.E", "TSX", None, 1), ("A.PR.E", "TSX", None, 2), (" ", "TSX", None, 3), ("B", None, None, 4)]
    listing = spark.createDataFrame(rows, "symbol string, exchange string, parent_symbol string, ord int")
    official = listings.official_symbols(listing, ["ord"])
    assert keyed(listings.vendor_symbol_map(official, ["ord"]), "vendor_symbol", "symbol") == {"A.PR.E.TO": "A.PR.E"}


def test_issuer_rows_and_missing_columns(spark):
    listing = spark.createDataFrame([(" A.X ", "tsx", " Name ", None, "1,5", 1)], "symbol string, exchange string, name string, parent_symbol string, market_cap string, ord int")
    row = listings.issuer_rows(listing, ["ord"]).collect()[0]
    assert (row.symbol, row.exchange, row.name, row.root_ticker, row.market_cap, row.os_shares, row.co_id) == ("A.X", "TSX", "Name", "A.X", 15.0, None, None)
    with pytest.raises(files.MissingColumns, match="name"):
        listings.issuer_rows(listing.drop("name"), ["ord"])


def test_dedup_by_priority(spark):
    schema = "Ticker string, `Report Date` string, v string, ord int"
    banks = spark.createDataFrame([("A", "d", "bank", 1), (None, None, "n1", 2), (None, None, "n2", 3)], schema)
    general = spark.createDataFrame([("A", "d", "general", 1), ("a", "d", "lower", 2)], schema)
    merged = ranking.union_by_priority([banks, general.withColumn("extra", F.lit("x"))])
    kept = ranking.dedup_by_priority(merged, us_financials.KEYS, "source_priority", ["ord"])
    assert sorted(r.v for r in kept.collect()) == ["bank", "lower", "n1"]
    assert coverage.dedup_stats(merged, us_financials.KEYS).collect()[0].asDict() == {"concat_rows": 5, "dedup_rows": 3}
    bare = merged.drop("Report Date")
    assert ranking.dedup_by_priority(bare, us_financials.KEYS, "source_priority", ["ord"]) is bare


def test_us_financials_and_coverage(spark):
    schema = "Ticker string, `Report Date` string, Revenue string, Sales string, ord int"
    rows = [("a", "2020-12-31", "abc", "1,000", 1), ("B", "n/a", "1", None, 2), (" ", "2020-12-31", "1", None, 3), ("C", "2020-12-31", None, None, 4)]
    parts = {"IS": [spark.createDataFrame(rows, schema)], "BS": [], "CF": []}
    loaded = us_financials.us_financials(parts, ["ord"])
    assert [tuple(r) for r in loaded.collect()] == [("A", "US", D(2020, 12, 31), "IS", "Revenue", 1000.0, "USD", "SimFin")]
    status = us_financials.us_financials_status(parts, loaded).collect()[0]
    assert (status.total, status.inserted, status.errors, status.status) == (4, 1, 3, "error")
    assert status.message == "tickers total=4 inserted=1 errors=3 rate=0.7500"
    with pytest.raises(ValueError):
        us_financials.us_financials({"IS": []}, ["ord"])


def test_null_currency_stays_null(spark):
    rows = spark.createDataFrame([("A", "2020-12-31", None, "1")], "Ticker string, `Report Date` string, Currency string, Revenue string")
    assert statements.unpivot_tags(rows, "IS").collect()[0].unit is None


def test_ca_financials(spark):
    schema = "symbol string, stmt_type string, api_priority int, period_ordinal int, period_end string, tag string, value string"
    rows = [
        ("A", "IS", 1, 0, "2023-12-31", "Rev", "5"), ("A", "IS", 1, 0, "2023-12-31", "Cost", None), ("A", "IS", 1, 1, "2022-12-31", "Rev", "4"),
        ("A", "IS", 2, 0, "2023-12-31", "Old", "1"), ("A", "BS", 0, 0, "TTM", "Cash", "1,0"), ("X", "IS", 0, 0, None, "Rev", "1"),
    ]
    got = ca_financials.ca_financials(spark.createDataFrame([("A",)], "symbol string"), spark.createDataFrame(rows, schema))
    assert sorted((r.ticker, r.stmt_type, r.tag, r.value, r.fy_end_date) for r in got.collect()) == [
        ("A", "BS", "Cash", 10.0, None), ("A", "IS", "Cost", None, D(2023, 12, 31)), ("A", "IS", "Rev", 5.0, D(2023, 12, 31)),
    ]


def test_classify(spark):
    infos = {
        "EMPTY": '{"quoteType":""}', "FUND": '{"quoteType":"FUND"}', "ETF": '{"quoteType":"ETF"}', "CRYPTO": '{"quoteType":"CRYPTOCURRENCY"}',
        "TRUST": '{"longName":"X Trust","isEtf":true}', "EQ": '{"quote_type":"Equity"}', "CEF": '{"category":"Closed End","quoteType":"EQUITY"}',
        "MF": '{"isMutualFund":1,"category":"closed-end"}', "TEXT": '{"isEtf":"false"}', "LIT": '{"isEtf":false,"isETF":false,"quoteType":"MUTUALFUND"}',
        "IDX": '{"quoteType":"INDEX"}', "IDX2": '{"quote_type":"INDEX"}', "UND": '{"quoteType":"UND"}', "NOQ": '{"x":1}',
        "NONE": "{}", "NULL": None, "BAD": "oops", "LIST": "[1]",
    }
    frame = spark.createDataFrame(list(infos.items()), "symbol string, info string")
    got = keyed(instruments.classify_instruments(frame), "symbol", "asset_type", "is_etf", "is_trust", "is_index", "legal_type")
    assert got == {
        "EMPTY": ("fund", False, False, False, None), "FUND": ("fund", False, False, False, None), "ETF": ("etf", False, False, False, None),
        "CRYPTO": ("cryptocurrency", False, False, False, None), "TRUST": ("etf", True, True, False, "trust"),
        "EQ": ("equity", False, False, False, None), "CEF": ("closed_end_fund", False, False, False, None),
        "MF": ("mutual_fund", False, False, False, None), "TEXT": ("etf", True, False, False, None),
        "LIT": ("mutual_fund", False, False, False, None), "IDX": ("index", False, False, True, None),
        "IDX2": ("index", False, False, False, None), "UND": ("fund", False, False, False, None), "NOQ": ("fund", False, False, False, None),
    }
    strict = keyed(instruments.classify_instruments(frame, strict=True), "symbol", "asset_type")
    assert strict["EMPTY"] == strict["NOQ"] == "unknown" and strict["UND"] == "fund"
    assert instruments.not_found_count(frame).collect()[0].asDict() == {"processed": 18, "not_found": 4}


def test_insert_if_absent_and_upsert(spark):
    target = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, v int")
    incoming = spark.createDataFrame([("B", 9, 1), ("C", 3, 2), ("C", 4, 3)], "symbol string, v int, ord int")
    assert keyed(merge.insert_if_absent(target, incoming, "symbol", ["ord"]), "symbol", "v") == {"C": 3}
    table = merge.upsert(target, incoming, "symbol", ["ord"])
    assert keyed(table, "symbol", "v") == {"A": 1, "B": 9, "C": 4}
    assert merge.duplicate_keys(table, ["symbol"]).count() == 0
    same = merge.upsert(target, target.withColumn("ord", F.lit(0)), "symbol", ["ord"])
    assert sorted(same.collect()) == sorted(target.collect())


def test_clear_exchange_and_audit(spark):
    table = spark.createDataFrame([("A", "US"), ("A", "US"), ("B", "CA"), ("C", None)], "symbol string, exchange string")
    assert sorted(r.symbol for r in merge.clear_exchange(table, "US").collect()) == ["B", "C"]
    assert [tuple(r) for r in merge.duplicate_keys(table, ["symbol", "exchange"]).collect()] == [("A", "US", 2)]
    assert [r.symbol for r in merge.missing_keys(table, ["symbol", "exchange"]).collect()] == ["C"]


@pytest.mark.parametrize(
    "exits, want",
    [
        ([0, 1, 1, 1, 0], (3, 4, 1, "too many failures")),
        ([0, 2, 0], (0, 2, 2, "critical")),
        ([1, 1, 2, 1], (2, 3, 2, "critical")),
        ([1, 1, 1, 2], (3, 3, 1, "too many failures")),
        ([0, 1, 0, 1], (2, None, 0, "complete")),
        ([0, 0], (0, None, 0, "complete")),
    ],
)
def test_run_outcomes(spark, exits, want):
    steps = spark.createDataFrame([(1, i, e) for i, e in enumerate(exits, 1)], "run_id int, step_no bigint, exit_code int")
    row = runlog.run_outcomes(steps).collect()[0]
    assert (row.counted_failures, row.abort_step, row.exit_code, row.outcome) == want
    after = sorted(r.step_no for r in runlog.steps_not_run(steps, runlog.run_outcomes(steps)).collect())
    assert after == ([] if want[1] is None else list(range(want[1] + 1, len(exits) + 1)))


def test_plain_status_row(spark):
    status = runlog.plain_status(spark, "error", "no data", {"error": "x"})
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    row = runlog.run_log_rows(status, F.lit("us_prices"), start, F.timestamp_add("SECOND", F.lit(2), start)).collect()[0]
    assert (row.script, row.status, row.details, row.duration_ms) == ("us_prices", "error", '{"error": "x"}', 2000)


def test_symbol_outcomes(spark):
    names = lambda *s: spark.createDataFrame([(x,) for x in s], "symbol string")
    outcomes = coverage.symbol_outcomes(names("A", "B", "C"), names("A"), names("B"))
    assert keyed(outcomes, "symbol", "outcome") == {"A": "inserted", "B": "error", "C": "skipped"}
    status = coverage.outcome_status(outcomes).collect()[0]
    assert (status.total, status.success, status.errors, status.status) == (3, 1, 1, "error")


def test_results_do_not_depend_on_input_order(spark):
    rng = random.Random(7)
    rows = [(f"S{rng.randrange(9)}", f"2024-01-{rng.randrange(1, 9):02d}", None, str(i), None) for i in range(300)]
    frame = bulk(spark, *rows)
    shuffled = frame.orderBy(F.rand(3)).repartition(5)
    for variant in (True, False):
        run = lambda f: sorted(bars.latest_with_previous(bars.bulk_bars(f), ["ord"], variant).collect())
        assert run(frame) == run(shuffled)
