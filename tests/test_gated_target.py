"""Marks, restarts, keys against stored rows, clearing, clustered files, counts from the write."""

import datetime
import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.operators import bars, statements
from tickerloom.operators.coverage import WriteCounts
from tickerloom.plans import us_financials, us_prices
from tickerloom.session import written_once
from tickerloom.sinks import gated, storage, tables
from tickerloom.sinks.gated import GatedTarget

D = datetime.date
BAR = "symbol string, exchange string, price double, latest_day date"


def bar_rows(spark, *rows):
    return spark.createDataFrame([(s, x, p, D(2024, 1, d)) for s, x, p, d in rows], BAR)


@pytest.fixture
def target(spark, tmp_path):
    tables.write_version(bar_rows(spark, ("A", "US", 1.0, 1), ("A", "CA", 1.0, 9), ("B", "US", 2.0, 5)), str(tmp_path / "prices"), "stock_prices")
    return GatedTarget(str(tmp_path / "prices"), str(tmp_path / "state"))


def stored(spark, target):
    return sorted((r.symbol, r.exchange, r.price, r.latest_day.day) for r in target.stored(spark).collect())


START = [("A", "CA", 1.0, 9), ("A", "US", 1.0, 1), ("B", "US", 2.0, 5)]


def test_loads_read_the_marks_and_not_the_target(spark, target):
    assert target.append(bar_rows(spark, ("A", "US", 3.0, 2), ("B", "US", 4.0, 5), ("C", "US", 5.0, 1), ("D", "US", None, 1)), "US")
    assert stored(spark, target) == sorted([*START, ("A", "US", 3.0, 2), ("C", "US", 5.0, 1)])
    prices = spark.createDataFrame([("A", "2024-01-03", "7"), ("C", "2024-01-01", "8")], "Ticker string, Date string, Close string").withColumn("ord", F.lit(1))
    financials = spark.createDataFrame([("A", "US"), ("C", "US")], "ticker string, exchange string")
    found = us_prices.us_prices(prices, financials, target.marks(spark), ["ord"])
    assert not any(target.target_path in path for path in found.inputFiles())
    assert [(r.symbol, r.price) for r in found.collect()] == [("A", 7.0)]
    again = GatedTarget(target.target_path, os.path.dirname(target.marks_path))
    assert not any(target.target_path in path for path in again.marks(spark).inputFiles())
    marks = {(r.exchange, r.symbol): r.last_seen.day for r in again.marks(spark).collect()}
    assert marks == {("US", "A"): 2, ("CA", "A"): 9, ("US", "B"): 5, ("US", "C"): 1}


@pytest.mark.parametrize("cut", ["before", "during", "after"])
def test_an_append_that_was_cut_off_is_finished_once(spark, target, monkeypatch, cut):
    """Cut off before the append, after it, or after its marks: the batch, delivered again, leaves each bar once."""
    batch = bar_rows(spark, ("A", "US", 3.0, 2), ("C", "US", 5.0, 1))
    target.marks(spark)

    def broken(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if cut == "before":
            m.setattr(gated, "append_rows", broken)
        elif cut == "during":
            m.setattr(GatedTarget, "_mark", broken)
        else:
            m.setattr(storage, "delete", broken)
        with pytest.raises(OSError):
            target.append(batch, "US", version=1)
    restarted = GatedTarget(target.target_path, os.path.dirname(target.marks_path))
    reads = []
    monkeypatch.setattr(GatedTarget, "stored", lambda self, s, f=GatedTarget.stored: (reads.append(1), f(self, s))[1])
    assert not restarted.append(batch, "US", version=1)  # the batch is delivered again
    assert len(reads) == (0 if cut == "after" else 1)
    assert restarted.append(bar_rows(spark, ("A", "US", 4.0, 3)), "US", version=2)
    assert len(reads) == (0 if cut == "after" else 1)
    assert stored(spark, restarted) == sorted([*START, ("A", "US", 3.0, 2), ("A", "US", 4.0, 3), ("C", "US", 5.0, 1)])
    assert storage.versions(spark, restarted.staged_path) == []


def test_versions_of_the_marks_are_merged(spark, target, monkeypatch):
    monkeypatch.setattr(gated, "MERGE_AFTER", 3)
    for day in range(10, 18):
        assert target.append(bar_rows(spark, ("A", "US", 1.0, day), (f"S{day}", "US", 1.0, day)), "US")
    assert len(storage.versions(spark, target.marks_path)) <= 3
    marks = {r.symbol: r.last_seen.day for r in target.marks(spark).where("exchange = 'US'").collect()}
    assert marks == {"A": 17, "B": 5, **{f"S{d}": d for d in range(10, 18)}}
    assert not target.append(bar_rows(spark, ("Z", "US", 1.0, 1)), "US", version=5)
    target.rebuild(spark)
    assert {r.symbol: r.last_seen.day for r in target.marks(spark).where("exchange = 'US'").collect()} == marks


def test_broken_rows_leave_nothing_staged(spark, target):
    with pytest.raises(tables.BrokenConstraint):
        target.append(bar_rows(spark, ("Z", "US", 1.0, 1), ("Z", "US", 2.0, 1)), "US")
    assert stored(spark, target) == START and storage.versions(spark, target.staged_path) == []


def test_marks_of_a_timed_target(spark, tmp_path):
    rows = spark.sql("select 'A' symbol, 'US' exchange, 1.0D price, date'2024-01-01' latest_day, timestamp_ntz'2024-01-01 10:00:00' as_of")
    tables.write_version(rows, str(tmp_path / "p"), "stock_prices")
    target = GatedTarget(str(tmp_path / "p"), str(tmp_path / "s"), timed=True)
    later = rows.withColumn("as_of", F.expr("as_of + interval 1 hour"))
    assert target.append(rows.unionByName(rows.withColumn("symbol", F.lit("B"))), "US")
    assert target.append(later.withColumn("latest_day", F.expr("date'2024-01-02'")), "US")
    assert sorted((r.symbol, r.as_of.hour) for r in target.stored(spark).collect()) == [("A", 10), ("A", 11), ("B", 10)]


# --- keys against stored rows -------------------------------------------------------------------


def test_a_stored_key_stops_the_append(spark, tmp_path):
    path = str(tmp_path / "prices")
    tables.append_rows(bar_rows(spark, ("A", "US", 1.0, 1)), path, "stock_prices")
    read = lambda: spark.read.schema(schemas.STOCK_PRICES).parquet(path)
    with pytest.raises(tables.BrokenConstraint, match="stored already: A"):
        tables.append_rows(bar_rows(spark, ("A", "US", 2.0, 1), ("B", "US", 2.0, 1)), path, "stock_prices", stored=read())
    tables.append_rows(bar_rows(spark, ("A", "CA", 2.0, 1), ("A", "US", 2.0, 2)), path, "stock_prices", stored=read())
    assert read().count() == 3


def test_a_bucketed_target_is_not_dealt_out_again(spark, tmp_path):
    path = str(tmp_path / "bucketed")
    tables.open_bucketed(spark, "bucketed_prices", "stock_prices", path, buckets=4)
    tables.append_bucketed(bar_rows(spark, *((f"S{i}", "US", 1.0, 1 + i % 20) for i in range(200))), "bucketed_prices", "stock_prices")
    with pytest.raises(tables.BrokenConstraint, match="stored already: S7"):
        tables.append_bucketed(bar_rows(spark, ("S7", "US", 9.0, 8), ("new", "US", 9.0, 8)), "bucketed_prices", "stock_prices")
    tables.append_bucketed(bar_rows(spark, ("S7", "US", 9.0, 9), ("S7", "CA", 9.0, 8)), "bucketed_prices", "stock_prices")
    assert spark.table("bucketed_prices").count() == 202
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", tables.BY_PART_OF_KEY: "false", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = written_once(tables.to_table(bar_rows(spark, ("S7", "US", 9.0, 8)), "stock_prices"))
        plan = tables.key_clashes(rows, spark.table("bucketed_prices"), "stock_prices")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert exchange < scan  # the incoming rows' side is printed first, and only it has one
    # the table can be opened again, by another session too
    spark.sql("DROP TABLE bucketed_prices")
    assert tables.open_bucketed(spark, "bucketed_prices", "stock_prices", path, buckets=4).count() == 202
    spark.sql("DROP TABLE bucketed_prices")


# --- clearing -----------------------------------------------------------------------------------


def part_files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/part-*", recursive=True)}


def test_clearing_an_exchange_touches_no_other(spark, tmp_path):
    path = str(tmp_path / "financials")
    row = lambda t, x, s: (t, x, D(2024, 1, 1), s, "Tag", 1.0)
    columns = "ticker string, exchange string, fy_end_date date, stmt_type string, tag string, value double"
    rows = spark.createDataFrame([row("A", "US", "IS"), row("A", "US", "BS"), row("B", "CA", "IS")], columns)
    tables.append_rows(rows, path, "financials", sort_by="ticker")
    read = lambda: sorted((r.ticker, r.exchange, r.stmt_type) for r in spark.read.schema(schemas.FINANCIALS).parquet(path).collect())
    others = part_files(f"{path}/exchange=CA")
    tables.clear_exchange(spark, path, "financials", "US")
    assert read() == [("B", "CA", "IS")] and part_files(f"{path}/exchange=CA") == others
    tables.replace_partitions(spark.createDataFrame([row("C", "US", "IS")], columns), path, "financials")
    assert read() == [("B", "CA", "IS"), ("C", "US", "IS")] and part_files(f"{path}/exchange=CA") == others
    tables.clear_table(spark, path, "financials")
    assert read() == [] and not part_files(f"{path}/exchange=CA")
    with pytest.raises(ValueError):
        tables.clear_exchange(spark, path, "ingest_logs", "US")


# --- clustered files ------------------------------------------------------------------------------


def test_files_hold_ranges_of_symbols(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("concat('S', id % 2000) as symbol", "'US' as exchange", "1.0D as price", "date_add(date'2024-01-01', cast(id / 2000 as int)) as latest_day").repartition(8)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.append_rows(rows, str(tmp_path / "p"), "stock_prices", sort_by="symbol")
        listing = spark.range(500).selectExpr("cast(id as string) symbol", "'n' name", "'p' parent_symbol", "'q' parent_name", "'' suffix", "'TSX' exchange", "500 - id as ord")
        tables.export_symbols(listing.repartition(4), str(tmp_path / "list"), order=("ord",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    groups = kept = 0
    for file in part_files(tmp_path / "p"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("symbol")
        for g in range(meta.num_row_groups):
            limits = meta.row_group(g).column(at).statistics
            groups, kept = groups + 1, kept + (limits.min <= "S777" <= limits.max)
    assert groups >= 4 and kept == 1
    exported = [line.split(",")[0] for f in sorted(part_files(tmp_path / "list")) for line in open(f).read().splitlines()[1:]]
    assert exported == [str(i) for i in reversed(range(500))]


# --- counts from the write ------------------------------------------------------------------------


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    wide = spark.createDataFrame(
        [("A", "2024-12-31", "1", 0), ("B", "TTM", "2", 1), ("", "bad", "3", 2), ("C", "2024-12-31", "n.m.", 3), ("D", None, "4", 4)],
        "Ticker string, `Report Date` string, Revenue string, ord int",
    ).withColumn("source_priority", F.lit(0))
    row = us_financials.us_financials_load(spark, {"IS": wide, "BS": []}, ["ord"], str(tmp_path / "f"), {"market": "us"}).first()
    assert row.details.startswith('{"market":"us","skipped_days":2,"rows_IS":1,"tickers":{"total":5,"inserted":1,"errors":4')
    assert spark.read.schema(schemas.FINANCIALS).parquet(str(tmp_path / "f")).count() == 1
    counts = WriteCounts()
    first = counts.on(spark.range(10), n=F.count(F.lit(1)))
    second = counts.on(spark.range(5), n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    written_once(first), written_once(second)
    assert counts.result() == {"n": 15, "odd": 2}


def test_price_load_counts_missing_closes(spark, target):
    prices = spark.createDataFrame([("A", "2024-01-03", "7"), ("B", "2024-01-09", "x"), ("C", "2024-01-01", "8"), ("E", "2024-01-01", "8")], "Ticker string, Date string, Close string")
    financials = spark.createDataFrame([(s, "US") for s in "ABC"], "ticker string, exchange string")
    row = us_prices.us_prices_load(prices.withColumn("ord", F.lit(1)), financials, target, ["ord"], context={"variant": "latest"}).first()
    assert (row.total, row.success, row.errors, row.status) == (3, 2, 0, "success")
    assert row.details.startswith('{"variant":"latest","missing_closes":1,"symbols":')
    again = us_prices.us_prices_load(prices.withColumn("ord", F.lit(1)), financials, target, ["ord"]).first()
    assert (again.total, again.success) == (3, 0)


# --- price path -----------------------------------------------------------------------------------


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def test_a_hot_day_sends_a_few_rows_per_task(spark):
    rows = spark.range(0, 40_000, 1, 4).selectExpr(
        "'HOT' as Ticker", "'2024-01-02' as Date", "cast(timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id % 7919) as string) as DateTime",
        "cast(id as string) as Close", "cast(null as string) as Open", "id as ord",
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = bars.latest_with_previous(bars.bulk_bars(rows), ["ord"], timed=True)
        row = found.collect()
        plan = found._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sent = [n.metrics().get("shuffleRecordsWritten").get().value() for n in nodes(plan) if n.nodeName() == "Exchange"]
    newest = max(range(40_000), key=lambda i: (i % 7919, i))
    assert [(r.symbol, r.Close, r.previous_close) for r in row] == [("HOT", str(newest), 39_998.0)]
    assert sent and max(sent) <= 4 * 2 * 2, sent


def test_rows_without_a_time_are_ranked_once(spark):
    rows = spark.range(0, 300, 1, 3).selectExpr(
        "concat('S', id) as Ticker", "'2024-01-02' as Date", "case when id % 3 = 0 then '2024-01-02 10:00:00' end as DateTime", "'1' as Close", "id as ord"
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = bars.latest_with_previous(bars.bulk_bars(rows), ["ord"], timed=True)
        assert found.count() == 300 and len(found.collect()) == 300
        plan = found._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sent = [n.metrics().get("shuffleRecordsWritten").get().value() for n in nodes(plan) if n.nodeName() == "Exchange"]
    assert max(sent) == 400, sent  # a hundred rows with a time twice, the others once


def test_timed_bars_against_plain_python(spark):
    rng = random.Random(11)
    texts = [None, "", "1", "a\x1fb", "\\n", "\\s\\b", "\\", "2,5", "é"]
    rows = []
    for i in range(1500):
        day = f"2024-01-{rng.randrange(1, 5):02d}"
        time = None if rng.random() < 0.4 else f"{day} 1{rng.randrange(3)}:00:00"
        rows.append((f"S{rng.randrange(60) * rng.randrange(2) + rng.randrange(40)}", day, time, *(rng.choice(texts) for _ in range(6)), rng.choice([None, i]), i))
    columns = ["Ticker", "Date", "DateTime", "Open", "High", "Low", "Close", "Adj. Close", "Volume", "half", "ord"]
    frame = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n in ('half', 'ord') else 'string'}" for n in columns)).repartition(5)
    found = bars.latest_with_previous(bars.bulk_bars(frame), ["half", "ord"], timed=True).drop("previous_close").collect()
    close = {r.symbol: r.previous_close for r in bars.latest_with_previous(bars.bulk_bars(frame), ["half", "ord"], timed=True).collect()}
    want, before = {}, {}
    place = lambda r: (r[1], -1 if r[9] is None else r[9], r[10])
    for symbol in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == symbol]
        best = max(own, key=lambda r: (r[1], r[2] is None, r[2] or "", place(r)))
        want[symbol] = (best[1], best[2], *best[3:7], best[8], best[7])
        landed = sorted(own, key=place, reverse=True)
        text = (landed[1][6] if landed[1][6] is not None else landed[1][7]) if len(landed) > 1 else None
        before[symbol] = {"1": 1.0, "2,5": 25.0}.get(text)
    got = {r.symbol: (str(r.latest_day), None if r.as_of is None else str(r.as_of), r.Open, r.High, r.Low, r.Close, r.Volume, r["Adj. Close"]) for r in found}
    assert got == want and close == before


@pytest.mark.parametrize("build", [lambda t: us_prices.us_prices(t.prices_bulk, t.financials_stored, t.stored_us, ["ord"], "daily"), lambda t: statements.unpivot_tags(t.income, "IS")])
def test_generated_methods_stay_short_enough_to_be_compiled(spark, sf_dir, build):
    from workload.registry import Tables

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = build(Tables(spark, sf_dir))._jdf.queryExecution().debug().codegenToSeq()
        sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sizes and max(sizes) < 8000, sizes
