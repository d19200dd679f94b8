"""Delimited and JSON landing files."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickerloom.functions.numbers import missing_as_null

# Columns that carry the position of a row in its landed files, in sort order. Spark packs file
# splits into tasks by size, so a running id alone does not follow the files.
POSITION = ["landed_file", "landed_block", "landed_row"]


class MissingColumns(ValueError):
    """A landed file lacks columns the load cannot do without."""


def require_columns(frame: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in frame.columns]
    if missing:
        raise MissingColumns(f"missing {missing}, found {frame.columns}")
    return frame


def with_position(frame: DataFrame) -> DataFrame:
    """Add :data:`POSITION` to a file scan, for "first row" and "last row" rules."""
    return frame.select(
        "*",
        F.col("_metadata.file_path").alias("landed_file"),
        F.col("_metadata.file_block_start").alias("landed_block"),
        F.monotonically_increasing_id().alias("landed_row"),
    )


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a landed file, wherever Spark can read it; compressed files by their ending."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        raw = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8")).readLine()
    finally:
        stream.close()


def files_by_header(spark: SparkSession, path, sep: str = ";", folders: dict[str, str] | None = None) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` grouped by their header's columns, in the order of their names; empty files are in no group.

    The driver reads one line of each file, as Spark's readers do with footers. ``folders`` takes the
    files below the partition folders of these values.
    """
    found = sorted(spark.read.text(path).inputFiles())
    for name, value in (folders or {}).items():
        found = [f for f in found if f"/{name}={value}/" in f]
    with ThreadPoolExecutor(8) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), found))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(found, lines, strict=True):
        if line:
            groups.setdefault(tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))), []).append(file)
    return groups


def read_bulk_csv(
    spark: SparkSession,
    path,
    schema: StructType | None = None,
    keys: tuple[str, ...] = ("Ticker",),
    sep: str = ";",
    position: bool = True,
    market: str | None = None,
    variant: str | None = None,
    instead: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a bulk dataset: ``;``-delimited, with header, every column as text.

    Files of one folder may differ in their headers: each header is one scan, and a column that a file
    lacks is null for its rows, or the file's column ``instead[name]`` if it has that. With a ``schema``
    there is one scan, and a file with another header fails.

    ``path`` may be a folder whose ``market=..`` / ``variant=..`` partitions become columns; ``market``
    and ``variant`` take one of them. That filter comes before the row ids, which it could not pass,
    so other folders are not read. Missing-value texts turn to null in all columns of the files but
    ``keys``, so a ticker spelled ``NA`` stays, and so does a folder of that name.
    """
    folders = {n: v for n, v in (("market", market), ("variant", variant)) if v is not None}

    def scan(header: StructType, files) -> DataFrame:
        # The CSV reader checks headers against the schema, so a reordered file fails loudly.
        reader = spark.read.schema(header).options(sep=sep, header=True, enforceSchema=False)
        if files is not path and isinstance(path, str):
            reader = reader.option("basePath", path)  # keeps the folders' columns
        raw = reader.csv(files)
        for name, value in folders.items():
            raw = raw.where(F.col(name) == value)
        raw = raw.withColumns({f.name: missing_as_null(F.col(f"`{f.name}`")) for f in header.fields if f.name not in keys})
        for name, other in (instead or {}).items():
            if name not in raw.columns and other in raw.columns:
                raw = raw.withColumn(name, F.col(f"`{other}`"))
        return with_position(raw) if position else raw

    if schema is not None:
        return scan(schema, path)
    headers = files_by_header(spark, path, sep, folders if isinstance(path, str) else None)
    if not headers:
        raise MissingColumns(f"no file with a header below {path}")
    text = lambda names: StructType([StructField(n, StringType()) for n in names])
    if len(headers) == 1:
        return scan(text(next(iter(headers))), path)
    return reduce(_by_name, (scan(text(h), files) for h, files in headers.items()))


def _by_name(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other, allowMissingColumns=True)


def read_bulk_csv_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None, keys: tuple[str, ...] = ("Ticker",), sep: str = ";"
) -> DataFrame:
    """Bulk files as they land, in the form :func:`read_bulk_csv` gives them; a position is a column of the files.

    Without ``files_per_batch`` a batch takes all files that have landed.
    """
    reader = spark.readStream.schema(schema).options(sep=sep, header=True, enforceSchema=False)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.csv(path)
    texts = [f.name for f in schema.fields if f.dataType == StringType() and f.name not in keys]
    return raw.withColumns({name: missing_as_null(F.col(f"`{name}`")) for name in texts})


def read_symbol_csv(
    spark: SparkSession, path, schema: StructType | None = None, position: bool = True
) -> DataFrame:
    """Scan a symbol list: comma-delimited, with header; a byte-order mark is dropped."""
    return require_columns(
        read_bulk_csv(spark, path, schema, keys=("symbol", "parent_symbol", "exchange"), sep=",", position=position),
        "symbol",
        "exchange",
    )


def read_json_documents(spark: SparkSession, path) -> DataFrame:
    """Whole payload files, one per row, as ``payload`` text; a file is one vendor response."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def read_statement_matrices(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """Landed statement matrices as whole texts in ``payload``, one file each.

    The folders ``symbol=../stmt_type=../api_priority=..`` say what a file holds. That is a folder and a file
    for each matrix, which the driver has to list; where they get many, land them ``bundled``: JSON files
    with a matrix a line, in the fields ``symbol``, ``stmt_type``, ``api_priority`` and ``payload``. A line that
    is broken fails the read.
    """
    if bundled:
        fields = "payload string, symbol string, stmt_type string, api_priority int"
        return spark.read.schema(fields).json(path, mode="FAILFAST")
    schema = "value string, symbol string, stmt_type string, api_priority int"
    return spark.read.schema(schema).text(path, wholetext=True).withColumnRenamed("value", "payload")


PROBLEM = "landed_problem"


def read_payloads(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Landed payload files, one JSON response a line, in the columns of ``schema``.

    Every line is kept, with its text (``landed_text``), its position and what is wrong with it
    (:data:`PROBLEM`): ``malformed`` for broken JSON, ``no symbol``, or null. :func:`readable` and
    :func:`rejects` take them apart.
    """
    corrupt = "_corrupt"
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    lines = with_position(spark.read.text(path).where(F.trim("value") != ""))
    # behind an explode, so that no filter on the parsed line parses it again
    parsed = lines.select("value", *POSITION, F.explode(F.array(F.from_json("value", wide, options))).alias("p"))
    blank = F.coalesce(F.trim("p.symbol") == "", F.lit(True))
    problem = F.when(F.col("p").isNull() | F.col(f"p.{corrupt}").isNotNull(), "malformed").when(blank, "no symbol")
    return parsed.select(*(F.col(f"p.{f.name}") for f in schema.fields), F.col("value").alias("landed_text"), problem.alias(PROBLEM), *POSITION)


def readable(payloads: DataFrame) -> DataFrame:
    """The lines that can be used."""
    return payloads.where(F.col(PROBLEM).isNull()).drop(PROBLEM, "landed_text")


def rejects(payloads: DataFrame) -> DataFrame:
    """The lines that cannot, as they landed: file, symbol as far as it can be seen, text, reason."""
    seen = F.regexp_extract("landed_text", r'"symbol"\s*:\s*"([^"]*)"', 1)
    return payloads.where(F.col(PROBLEM).isNotNull()).select(
        "landed_file", F.nullif(F.coalesce("symbol", seen), F.lit("")).alias("symbol"), "landed_text", F.col(PROBLEM).alias("reason")
    )
