"""What the operators share: scratch tables, column names that cannot clash, repeatable draws."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.session import scratch_dir


def materialise(frame: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``frame`` to the shared scratch folder and read it back.

    It cuts the lineage, so that a lost executor never makes Spark compute a step a second time with
    another outcome. The planner then knows the size of the files, which are compressed; sessions that
    want broadcasts judged by the size of the rows set spark.sql.sources.fileCompressionFactor. The folder
    is a new one that an enclosing ``scratch_scope`` deletes, or ``path``.
    """
    spark = frame.sparkSession
    path = path or scratch_dir(spark)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no column in ``taken`` has it (in any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def unit_draw(*parts: Column | str) -> Column:
    """A number in (0, 1) that depends on the parts only: 52 bits of an MD5; null parts count as empty."""
    text = F.concat_ws("|", *(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
