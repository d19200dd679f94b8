"""Parquet, CSV and JDBC writers.

Spark overwrites a path by deleting it first, so a table is never rewritten in place from its own rows:
mutations write a new path, and the caller points readers to it. Clearing overwrites with nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickerloom import schemas
from tickerloom.session import written_once
from tickerloom.sinks import storage


class BrokenConstraint(ValueError):
    """Rows to be written repeat a unique key or lack a required value."""


def _target(table: str, timed: bool) -> StructType:
    return {
        "financials": schemas.FINANCIALS,
        "stock_prices": schemas.STOCK_PRICES_AS_OF if timed else schemas.STOCK_PRICES,
        "instrument_meta": schemas.INSTRUMENT_META,
        "tmx_issuers": schemas.TMX_ISSUERS,
        "ingest_logs": schemas.INGEST_LOGS,
    }[table]


def to_table(frame: DataFrame, table: str) -> DataFrame:
    """Columns of the target in its types; absent ones take the target's default or null."""
    defaults, target = schemas.column_defaults(table), _target(table, "as_of" in frame.columns)
    columns = []
    for field in target.fields:
        value = F.col(f"`{field.name}`") if field.name in frame.columns else defaults.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return frame.select(*columns)


def _laid_out(rows: DataFrame, table: str, sort_by: str | None, computed: bool = False) -> DataFrame:
    """Rows clustered for a write. Ranges come from a sample, so rows that aren't ``computed`` yet are written to scratch first."""
    if not sort_by:
        return rows
    return clustered(rows if computed else written_once(rows), [*schemas.PARTITIONS.get(table, []), sort_by], schemas.UNIQUE_KEYS.get(table, []))


def _write(frame: DataFrame, path: str, table: str, mode: str, sort_by: str | None, computed: bool = False) -> None:
    partitions = schemas.PARTITIONS.get(table, [])
    rows = _laid_out(to_table(frame, table), table, sort_by, computed)
    rows.write.mode(mode).partitionBy(*partitions).parquet(path)


def clustered(frame: DataFrame, by: list[str], within: list[str] = ()) -> DataFrame:
    """``frame`` dealt out by ranges of ``by`` and sorted, so that a file holds a range of values and not all of them.

    Statistics then skip files and row groups, not only for the first rows of each. ``within`` are further
    columns to range over, so that one frequent value still spreads over tasks.
    """
    order = [*by, *(c for c in within if c not in by)]
    return frame.repartitionByRange(*order).sortWithinPartitions(*order)


def append_rows(
    frame: DataFrame, path: str, table: str, sort_by: str | None = None, checked: bool = False, stored: DataFrame | None = None
) -> None:
    """Append to a table folder, laid out by the table's partition columns.

    Rows of a table with constraints are computed once, into the scratch folder; what is checked there
    is what is appended, and a broken constraint stops the append. Keys are held against each other,
    and against the rows of ``stored`` if given; else the gate and the merges see to those. ``checked`` rows,
    which are written somewhere already, are appended as they are.
    """
    computed = checked
    if not checked and (table in schemas.NOT_NULL or table in schemas.UNIQUE_KEYS):
        frame, computed = written_once(to_table(frame, table)), True
        check_constraints(frame, table)
        if stored is not None:
            check_stored(frame, stored, table)
    _write(frame, path, table, "append", sort_by, computed)


def key_clashes(rows: DataFrame, stored: DataFrame, table: str) -> DataFrame:
    """The rows whose unique key ``stored`` has already."""
    keys = schemas.UNIQUE_KEYS[table]
    return rows.join(stored.select(*keys), keys, "left_semi")


def check_stored(rows: DataFrame, stored: DataFrame, table: str) -> None:
    """Raise if a row's unique key is stored already."""
    found = key_clashes(rows, stored, table).limit(1).collect()
    if found:
        key = ", ".join(str(found[0][k]) for k in schemas.UNIQUE_KEYS[table])
        raise BrokenConstraint(f"{table}: stored already: {key}")


# --- bucketed tables --------------------------------------------------------------------------

#: A join on the full key may rely on rows dealt out by a part of it, so that the target isn't dealt out anew.
BY_PART_OF_KEY = "spark.sql.requireAllClusterKeysForCoPartition"


def open_bucketed(spark: SparkSession, name: str, table: str, path: str, buckets: int = 64, by: str = "symbol") -> DataFrame:
    """A table folder as the catalog's table ``name``, in ``buckets`` by ``by``; created empty if there is none."""
    target, partitions = _target(table, False), schemas.PARTITIONS.get(table, [])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in target.fields)
    parts = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partitions and storage.exists(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def append_bucketed(frame: DataFrame, name: str, table: str) -> None:
    """Append to a bucketed table; a key that repeats, in the rows or in the table, stops the append.

    The stored side of that check is read bucket by bucket, only its keys, and isn't dealt out again.
    """
    spark = frame.sparkSession
    rows = written_once(to_table(frame, table))
    check_constraints(rows, table)
    before = spark.conf.get(BY_PART_OF_KEY, None)
    spark.conf.set(BY_PART_OF_KEY, "false")
    try:
        check_stored(rows, spark.table(name), table)
    finally:
        spark.conf.unset(BY_PART_OF_KEY) if before is None else spark.conf.set(BY_PART_OF_KEY, before)
    rows.select(*spark.table(name).columns).write.insertInto(name)


# --- clearing ---------------------------------------------------------------------------------


def _empty(spark: SparkSession, table: str, timed: bool) -> DataFrame:
    return spark.createDataFrame([], _target(table, timed))


def clear_exchange(spark: SparkSession, path: str, table: str, exchange: str, timed: bool = False) -> None:
    """Remove one exchange's rows from a table folder: its partition is overwritten with nothing.

    No other exchange's files are read or written.
    """
    if schemas.PARTITIONS.get(table, [])[:1] != ["exchange"]:
        raise ValueError(f"{table} is not laid out by exchange")
    rest = schemas.PARTITIONS[table][1:]
    _empty(spark, table, timed).drop("exchange").write.mode("overwrite").partitionBy(*rest).parquet(f"{path}/exchange={exchange}")


def clear_table(spark: SparkSession, path: str, table: str, timed: bool = False) -> None:
    """Remove all rows of a table folder; it stays readable."""
    empty = _empty(spark, table, timed)
    empty.write.mode("overwrite").partitionBy(*schemas.PARTITIONS.get(table, [])).parquet(path)


def replace_partitions(frame: DataFrame, path: str, table: str, sort_by: str | None = None) -> None:
    """Replace the partitions that ``frame`` has rows for, and no others.

    ``frame`` must not read what it replaces. New files are written aside and moved when all are there.
    """
    partitions, rows = schemas.PARTITIONS[table], _laid_out(to_table(frame, table), table, sort_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_version(frame: DataFrame, path: str, table: str, sort_by: str | None = None) -> None:
    """Write a whole table to a new folder; an existing one is an error."""
    _write(frame, path, table, "errorifexists", sort_by)


def check_constraints(frame: DataFrame, table: str) -> None:
    """Raise if rows break the table's unique key or NOT NULL rules; one pass for both."""
    required, unique = schemas.NOT_NULL.get(table, []), schemas.UNIQUE_KEYS.get(table, [])
    lacking = F.lit(False)
    for name in required:
        lacking = lacking | F.col(name).isNull()
    per_key = frame.groupBy(*unique).agg(F.count("*").alias("copies"), F.count_if(lacking).alias("lacking"))
    repeated = F.count_if(F.col("copies") > 1) if unique else F.lit(0)
    found = per_key.agg(repeated.alias("repeated"), F.sum("lacking").alias("lacking")).first()
    if found["lacking"]:
        raise BrokenConstraint(f"{table}: null in {required}, {found['lacking']} rows")
    if found["repeated"]:
        raise BrokenConstraint(f"{table}: repeated {unique}, {found['repeated']} keys")


def append_jdbc(frame: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 5000) -> None:
    """Append to a database table in batches. Untested here: no database is available."""
    rows = to_table(frame, table)
    rows.write.mode("append").option("batchsize", batch_size).jdbc(url, table, properties=properties)


SYMBOL_COLUMNS = ["symbol", "name", "parent_symbol", "parent_name", "suffix", "exchange"]


def export_symbols(symbols: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """Write the symbol list as CSV with header; empty and missing texts are both left blank.

    With ``order`` the files, by name, hold the rows in the order of these columns.
    """
    rows = clustered(written_once(symbols), list(order)) if order else symbols
    rows.select(*SYMBOL_COLUMNS).write.mode("errorifexists").options(header=True, emptyValue="").csv(path)


def export_combined(senior: DataFrame, venture: DataFrame, path: str, order: tuple[str, ...] = ()) -> bool:
    """Write the combined list, but only if the second exchange delivered any rows."""
    if venture.isEmpty():
        return False
    export_symbols(senior.unionByName(venture, allowMissingColumns=True), path, order)
    return True
