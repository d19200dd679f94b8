"""File scans, sinks and the stream."""

import datetime

import pytest
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.operators import bars, gate
from tickerloom.session import scratch_dir
from tickerloom.sinks import tables
from tickerloom.sources import files
from tickerloom.streaming.gated import GatedAppend, gate_batch, stream_gated_append

D = datetime.date


def test_bulk_csv(spark, tmp_path):
    folder = tmp_path / "market=us"
    folder.mkdir()
    (folder / "a.csv").write_text("Ticker;Date;Adj. Close;Volume\nNA;2024-01-01;n/a;1\nB;2024-01-02;2;NULL\n")
    (folder / "b.csv").write_text("Ticker;Date;Adj. Close;Volume\nNA;2024-01-01;3;\n")
    frame = files.read_bulk_csv(spark, str(tmp_path))
    rows = [tuple(r) for r in frame.orderBy(*files.POSITION).select("Ticker", "Date", "`Adj. Close`", "Volume", "market").collect()]
    assert rows == [("NA", "2024-01-01", None, "1", "us"), ("B", "2024-01-02", "2", None, "us"), ("NA", "2024-01-01", "3", None, "us")]
    latest = bars.latest_bar(bars.bulk_bars(frame.drop("market")), files.POSITION)
    assert {r.symbol: r["Adj. Close"] for r in latest.collect()} == {"NA": "3", "B": "2"}


def test_reordered_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date;Ticker\n2024-01-01;A\n")
    schema = "Ticker string, Date string"
    from pyspark.sql.types import StructType

    with pytest.raises(Exception):
        files.read_bulk_csv(spark, str(tmp_path), StructType.fromDDL(schema)).collect()


def test_symbol_csv_drops_a_byte_order_mark(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes("﻿symbol,name,parent_symbol,exchange\nNA,\"A, B\",,TSX\n".encode())
    row = files.read_symbol_csv(spark, str(tmp_path)).collect()[0]
    assert (row.symbol, row.name, row.parent_symbol, row.exchange) == ("NA", "A, B", None, "TSX")
    (tmp_path / "s.csv").write_text("symbol,name\nA,B\n")
    with pytest.raises(files.MissingColumns):
        files.read_symbol_csv(spark, str(tmp_path))


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"results":\n[]}')
    assert files.read_json_documents(spark, str(tmp_path)).collect()[0].payload == '{"results":\n[]}'


def test_table_defaults_versions_and_constraints(spark, tmp_path):
    bars_ = spark.createDataFrame([("A", 1.0, D(2024, 1, 1))], "symbol string, price double, latest_day date")
    path = str(tmp_path / "prices")
    tables.write_version(bars_, path, "stock_prices", sort_by="symbol")
    tables.append_rows(bars_.withColumn("exchange", F.lit("CA")), path, "stock_prices")
    stored = spark.read.schema(schemas.STOCK_PRICES).parquet(path)
    assert sorted((r.symbol, r.exchange, r.volume) for r in stored.collect()) == [("A", "CA", None), ("A", "US", None)]
    assert stored.where("inserted_at is null").count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_version(bars_, path, "stock_prices")
    tables.check_constraints(stored, "stock_prices")
    with pytest.raises(tables.BrokenConstraint, match="repeated"):
        tables.check_constraints(stored.union(stored), "stock_prices")
    with pytest.raises(tables.BrokenConstraint, match="null"):
        tables.check_constraints(stored.withColumn("symbol", F.lit(None).cast("string")), "stock_prices")


def test_combined_export_needs_both_lists(spark, tmp_path):
    senior = spark.createDataFrame([("A.X", "n", "p", "q", "X", "TSX")], schemas.SYMBOL_LIST)
    venture = senior.drop("suffix").withColumn("exchange", F.lit("TSXV"))
    assert not tables.export_combined(senior, venture.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert tables.export_combined(senior, venture, str(tmp_path / "both"))
    back = files.read_symbol_csv(spark, str(tmp_path / "both"))
    assert sorted((r.exchange, r.suffix) for r in back.collect()) == [("TSX", "X"), ("TSXV", None)]


def test_scratch_follows_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert root and scratch_dir(spark).startswith(f"{root}/tickerloom/")
    assert scratch_dir(spark) != scratch_dir(spark)


def _price_file(spark, path, name, rows):
    frame = spark.createDataFrame(
        [(t, d, None, "1", "1", "1", close, None, "1", i) for i, (t, d, close) in enumerate(rows)],
        "Ticker string, Date string, DateTime string, Open string, High string, Low string, Close string, `Adj. Close` string, Volume string, ord int",
    )
    frame.coalesce(1).write.mode("append").parquet(path)
    return frame


def test_stream_over_several_batches_equals_one_gated_run(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    batches = [
        [("A", "2024-01-01", "1"), ("A", "2024-01-02", "2"), ("B", "2024-01-05", "5")],
        [("A", "2024-01-03", "3"), ("B", "2024-01-04", "late"), ("C", "2024-01-01", "7")],
    ]
    tables.write_version(spark.createDataFrame([], schemas.STOCK_PRICES), target, "stock_prices")

    def run():
        stream_gated_append(spark, landing, frame.schema, target, str(tmp_path / "cp"), ["ord"], files_per_batch=1).awaitTermination()

    for rows in batches:
        frame = _price_file(spark, landing, "x", rows)
        run()
    read = lambda: sorted((r.symbol, str(r.latest_day), r.price) for r in spark.read.schema(schemas.STOCK_PRICES).parquet(target).collect())
    want = [("A", "2024-01-02", 2.0), ("A", "2024-01-03", 3.0), ("B", "2024-01-05", 5.0), ("C", "2024-01-01", 7.0)]
    assert read() == want
    run()
    gate_batch(frame, target, ["ord"])  # a replayed batch adds nothing
    assert read() == want
    stored = spark.read.schema(schemas.STOCK_PRICES).parquet(target)
    with pytest.raises(tables.BrokenConstraint):
        tables.append_rows(stored.limit(1).union(stored.limit(1)), target, "stock_prices")
    assert read() == want
    newest = gate.latest_seen(stored, "US")
    assert {r.symbol: str(r.last_seen) for r in newest.collect()} == {"A": "2024-01-03", "B": "2024-01-05", "C": "2024-01-01"}


def test_a_batch_reads_the_marks_not_the_target(spark, tmp_path):
    target = str(tmp_path / "target")
    tables.write_version(spark.createDataFrame([], schemas.STOCK_PRICES), target, "stock_prices")
    frame = _price_file(spark, str(tmp_path / "landing"), "x", [("A", "2024-01-01", "1")])
    append = GatedAppend(target, ["ord"])
    append(frame)
    plan = append.newer(frame)._jdf.queryExecution().optimizedPlan().toString()
    read = append.newer(frame).inputFiles()
    assert "last_seen" in plan and not any(target in path for path in read)
    assert append.newer(frame).count() == 0


def test_files_that_landed_together_are_one_batch(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    tables.write_version(spark.createDataFrame([], schemas.STOCK_PRICES), target, "stock_prices")
    _price_file(spark, landing, "x", [("A", "2024-01-01", "1"), ("B", "2024-01-05", "5")])
    frame = _price_file(spark, landing, "y", [("A", "2024-01-02", "2")])
    stream_gated_append(spark, landing, frame.schema, target, str(tmp_path / "cp"), ["ord"], files_per_batch=None).awaitTermination()
    stored = spark.read.schema(schemas.STOCK_PRICES).parquet(target).collect()
    assert sorted((r.symbol, str(r.latest_day), r.price) for r in stored) == [("A", "2024-01-02", 2.0), ("B", "2024-01-05", 5.0)]


def test_the_stream_query_lands_by_several_tasks(spark, sf_dir, monkeypatch, tmp_path):
    from workload import registry
    from workload import tables as queries

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(600)
    lines.repartition(4, "l_orderkey").write.parquet(str(tmp_path / "several" / "lineitem.parquet"))
    lines.coalesce(1).write.parquet(str(tmp_path / "one" / "lineitem.parquet"))
    found = {}
    for name in ("several", "one"):
        root = tmp_path / f"scratch-{name}"
        monkeypatch.setattr(queries, "scratch_dir", lambda _, root=root: str(root))
        found[name] = sorted(registry.QUERIES["stream_gated_append"](spark, str(tmp_path / name)).collect(), key=str)
        assert {int(p.name) for p in (root / "checkpoint" / "commits").iterdir() if p.name.isdigit()} == {0, 1, 2}
    assert found["several"] == found["one"]
    assert len(list((tmp_path / "scratch-several" / "landing").glob("*.csv"))) > 3
