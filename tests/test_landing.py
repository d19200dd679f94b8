"""Landed files of differing shape: bulk headers, matrices, payload lines."""

import datetime
import gzip
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.operators import bars
from tickerloom.plans import ca_financials, ca_prices, us_financials, us_prices
from tickerloom.sources import files, payloads

D = datetime.date


# --- bulk files -------------------------------------------------------------------------------


def test_files_of_one_folder_may_differ_in_their_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Ticker;Date;DateTime;Close\nA;2024-01-01;2024-01-01 10:00:00;1\nA;2024-01-01;;2\n")
    (tmp_path / "b.csv").write_text("Date;Ticker;Close\n2024-01-02;NA;n/a\n2024-01-03;A;3\n")
    (tmp_path / "c.csv").write_bytes("﻿Ticker;Date;Timestamp;\"Adj. Close\"\nB;2024-01-04;2024-01-04 11:00:00;4\n".encode())
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress(b"Ticker;Date;DateTime;Close\nC;2024-01-05;;5\n"))
    (tmp_path / "e.csv").write_text("")
    assert [len(v) for v in files.files_by_header(spark, str(tmp_path)).values()] == [2, 1, 1]
    frame = files.read_bulk_csv(spark, str(tmp_path), instead={"DateTime": "Timestamp"})
    rows = [tuple(r) for r in frame.orderBy(*files.POSITION).select("Ticker", "Date", "DateTime", "Close", "`Adj. Close`").collect()]
    assert rows == [
        ("A", "2024-01-01", "2024-01-01 10:00:00", "1", None), ("A", "2024-01-01", None, "2", None),
        ("NA", "2024-01-02", None, None, None), ("A", "2024-01-03", None, "3", None),
        ("B", "2024-01-04", "2024-01-04 11:00:00", None, "4"), ("C", "2024-01-05", None, "5", None),
    ]
    latest = bars.latest_bar(bars.bulk_bars(frame), files.POSITION).collect()
    assert {r.symbol: (r.Close, r.as_of is not None) for r in latest} == {"A": ("3", False), "NA": (None, False), "B": (None, True), "C": ("5", False)}


def test_folders_are_taken_before_headers_are_read(spark, tmp_path):
    for market, header in (("NA", "Ticker;Date"), ("us", "Ticker;Date;Close")):
        folder = tmp_path / f"market={market}" / "variant=daily"
        folder.mkdir(parents=True)
        (folder / "a.csv").write_text(header + "\nA;2024-01-01" + (";1" if market == "us" else "") + "\n")
    one = files.read_bulk_csv(spark, str(tmp_path), market="NA")
    assert "Close" not in one.columns and [(r.Ticker, r.market, r.variant) for r in one.collect()] == [("A", "NA", "daily")]
    every = files.read_bulk_csv(spark, str(tmp_path))
    assert sorted((r.market, r.Close) for r in every.collect()) == [("NA", None), ("us", "1")]
    with pytest.raises(files.MissingColumns):
        files.read_bulk_csv(spark, str(tmp_path), market="none")


# --- matrices ---------------------------------------------------------------------------------


def matrix(tmp_path, symbol, stmt, api, text):
    folder = tmp_path / f"symbol={symbol}" / f"stmt_type={stmt}" / f"api_priority={api}"
    folder.mkdir(parents=True)
    (folder / "m.csv").write_text(text)


def test_matrices_have_their_own_periods(spark, tmp_path):
    matrix(tmp_path, "NA", "IS", 0, ',2024-12-31,TTM\n"Revenue, ""net""",1,2\nProfit,"1,5"\n')
    matrix(tmp_path, "123", "BS", 1, "tag,2023-12-31,2022-12-31,2021-12-31\r\nAssets,-,1e3,7,extra\r\n\r\n")
    matrix(tmp_path, "E", "BS", 1, "")
    matrix(tmp_path, "F", "BS", 1, ",2023-12-31\n")
    cells = payloads.matrix_cells(files.read_statement_matrices(spark, str(tmp_path)))
    assert [(f.name, f.dataType) for f in cells.schema.fields] == [(f.name, f.dataType) for f in schemas.STATEMENT_MATRIX.fields]
    assert sorted(map(tuple, cells.collect()), key=str) == sorted([
        ("NA", "IS", 0, 0, "2024-12-31", 'Revenue, "net"', "1"), ("NA", "IS", 0, 1, "TTM", 'Revenue, "net"', "2"),
        ("NA", "IS", 0, 0, "2024-12-31", "Profit", "1,5"), ("NA", "IS", 0, 1, "TTM", "Profit", None),
        ("123", "BS", 1, 0, "2023-12-31", "Assets", "-"), ("123", "BS", 1, 1, "2022-12-31", "Assets", "1e3"), ("123", "BS", 1, 2, "2021-12-31", "Assets", "7"),
    ], key=str)
    typed = {(r.symbol, r.tag, r.period_ordinal): (r.fy_end_date, r.value) for r in payloads.statement_cells(cells).collect()}
    assert typed["NA", "Profit", 0] == (D(2024, 12, 31), 15.0) and typed["NA", 'Revenue, "net"', 1] == (None, 2.0)
    assert typed["123", "Assets", 0] == (D(2023, 12, 31), None) and typed["123", "Assets", 1] == (D(2022, 12, 31), 1000.0)
    issuers = spark.createDataFrame([("NA",)], "symbol string")
    rows = ca_financials.ca_financials_landed(issuers, files.read_statement_matrices(spark, str(tmp_path))).collect()
    assert sorted((r.ticker, r.tag, r.value) for r in rows) == [("NA", "Profit", 15.0), ("NA", 'Revenue, "net"', 1.0)]


def test_bundled_matrices_are_those_of_single_files(spark, tmp_path):
    texts = [("NA", "IS", 0, ',2024-12-31,TTM\n"Revenue, ""net""",1,2\nProfit,"1,5"\n'), ("7", "BS", 1, "tag,2023-12-31\r\nA\\b,é\r\n"), ("E", "BS", 2, "")]
    for text in texts:
        matrix(tmp_path / "single", *text)
    landed = spark.createDataFrame(texts, "symbol string, stmt_type string, api_priority int, payload string")
    landed.write.json(str(tmp_path / "bundled"))
    cells = lambda name, **how: sorted(payloads.matrix_cells(files.read_statement_matrices(spark, str(tmp_path / name), **how)).collect())
    assert cells("bundled", bundled=True) == cells("single") and len(cells("single")) == 5
    (tmp_path / "bundled" / "cut.json").write_text('{"symbol":"X","payl')
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed|FAILFAST"):
        cells("bundled", bundled=True)


def test_landed_matrices_are_few_files(spark, monkeypatch, tmp_path):
    from workload import landed

    monkeypatch.setattr(landed, "scratch_dir", lambda _: str(tmp_path / "scratch"))
    rows = [(f"S{i}", "IS", i % 3, "2024-12-31", "T", str(i)) for i in range(60)]
    table = SimpleNamespace(spark=spark, matrix=spark.createDataFrame(rows, "symbol string, stmt_type string, api_priority int, period_end string, tag string, value string"))
    found = payloads.matrix_cells(landed.landed_matrices(table)).collect()
    assert sorted((r.symbol, r.stmt_type, r.api_priority, r.period_end, r.tag, r.value) for r in found) == sorted(rows)
    assert len(list((tmp_path / "scratch").rglob("part-*"))) <= 4  # not one per matrix


def test_an_api_without_its_first_period_gives_nothing(spark):
    cells = [("S", "IS", 0, 1, "2022-12-31", "T", "1"), ("S", "IS", 1, 0, "2023-12-31", "T", "2"), ("S", "BS", 1, 0, "2023-12-31", "T", "3")]
    found = ca_financials.ca_financials(spark.createDataFrame([("S",)], "symbol string"), spark.createDataFrame(cells, schemas.STATEMENT_MATRIX))
    assert [(r.stmt_type, r.value) for r in found.collect()] == [("BS", 3.0)]


# --- payload lines ----------------------------------------------------------------------------


def test_broken_lines_go_to_the_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"symbol":"A","lastPrice":1,"regularMarketTime":"1704067200"}\n{"symbol":"B","lastPrice":1.5,\n\n{"lastPrice":2}\n[1]\nnull\n'
        '{"symbol":"A","lastPrice":NaN,"regularMarketPrice":5,"lastVolume":12.0,"regularMarketTime":1704153600.0,"dayHigh":"1,000.5"}\n{"symbol":" "}\n'
    )
    landed = files.read_payloads(spark, str(tmp_path), schemas.FAST_INFO)
    rejects = sorted((r.landed_text, r.symbol, r.reason) for r in files.rejects(landed).collect())
    assert rejects == sorted([
        ('{"symbol":"B","lastPrice":1.5,', "B", "malformed"), ('{"lastPrice":2}', None, "no symbol"), ("[1]", None, "malformed"),
        ("null", None, "malformed"), ('{"symbol":" "}', " ", "no symbol"),
    ])
    assert {r.landed_file.rsplit("/", 1)[-1] for r in files.rejects(landed).collect()} == {"a.json"}
    row = payloads.flatten_fast_info(files.readable(landed), files.POSITION).collect()
    assert len(row) == 1 and row[0].symbol == "A"
    assert row[0].lastPrice != row[0].lastPrice and (row[0].lastVolume, row[0].regularMarketTime, row[0].dayHigh) == (12, 1704153600, 1000.5)


def test_history_and_info_lines(spark, tmp_path):
    lines = [
        '{"symbol":"A","history":[{"date":"2024-01-02 23:30:00-05:00","Open":1,"Close":null,"Volume":"7"},{"date":"x","Close":9},{"Close":8}]}',
        '{"symbol":"B","history":[]}', '{"symbol":"C"}', '{"symbol":"D","info":{"quoteType":"ETF","yield":0.05}}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    rows = payloads.flatten_history(files.readable(files.read_payloads(spark, str(tmp_path), schemas.HISTORY)), files.POSITION).collect()
    assert [(r.symbol, r.date, r.Open, r.Close, r.Volume, r.place) for r in rows] == [("A", D(2024, 1, 2), 1.0, None, 7.0, 0)]
    infos = files.readable(files.read_payloads(spark, str(tmp_path), schemas.INFO)).collect()
    assert [r.info is not None for r in infos] == [False, False, False, True]


def test_status_of_a_canadian_run(spark, tmp_path):
    listing = [(s, "TSX", None, i) for i, s in enumerate(["AA", "BB", "CC", "DD"])]
    symbols = spark.createDataFrame(listing, "symbol string, exchange string, parent_symbol string, ord int")
    (tmp_path / "fast.json").write_text(
        '{"symbol":"AA.TO","lastPrice":1,"regularMarketTime":1704067200}\n{"symbol":"BB.TO","lastPrice":\n{"symbol":"CC.TO","lastPrice":3,"regularMarketTime":1704067200}\n'
        '{"symbol":"AA.TO","lastP\n{"symbol":"ZZ.TO",\n'
    )
    landed = files.read_payloads(spark, str(tmp_path), schemas.FAST_INFO)
    history = spark.createDataFrame([], landed.select("symbol").schema).withColumn("history", F.lit(None).cast(schemas.HISTORY["history"].dataType))
    history = history.withColumns({files.PROBLEM: F.lit(None).cast("string"), "landed_text": F.lit(""), **{p: F.lit(0) for p in files.POSITION}})
    stored = spark.createDataFrame([("CC", "CA", D(2024, 1, 1))], "symbol string, exchange string, latest_day date")
    appended = ca_prices.ca_prices_fallback_landed(symbols, landed, history, stored, ["ord"], F.lit("2024-07-01").cast("date"))
    assert [(r.symbol, r.price) for r in appended.collect()] == [("AA", 1.0)]
    status = ca_prices.ca_prices_status(symbols, appended, ["ord"], files.rejects(landed)).first()
    # AA has a bar beside its broken line, BB only a broken one, CC is stale, DD has no payload
    assert (status.total, status.success, status.errors, status.status) == (4, 1, 1, "error")


# --- runs with nothing to load ------------------------------------------------------------------


def test_runs_with_nothing_to_load(spark, tmp_path):
    none = us_financials.us_financials_load(spark, {"IS": [], "BS": []}, ["ord"], str(tmp_path / "t")).first()
    assert (none.status, none.message, none.details) == ("error", "No datasets fetched via API", '{"phase": "empty_fetch"}')
    assert us_financials.us_financials_early_exit(spark, {"IS": [spark.range(1)]}) is None
    assert not (tmp_path / "t").exists()
    financials = spark.createDataFrame([("A", "CA")], "ticker string, exchange string")
    row = us_prices.us_prices_log(None, financials, None, []).first()
    assert (row.status, row.message) == ("warning", "No US tickers found in financials table")
    prices = spark.createDataFrame([("A", "2024-01-01", "5")], "Ticker string, Date string, Close string").withColumn("ord", F.lit(1))
    stored = spark.createDataFrame([], schemas.STOCK_PRICES)
    run = us_prices.us_prices_log(prices, spark.createDataFrame([("A", "US")], "ticker string, exchange string"), stored, ["ord"]).first()
    assert (run.total, run.success, run.status) == (1, 1, "success")
