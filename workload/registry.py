"""Query registry: a Spark function per name and, where SQL can say it, the DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import VIEWS, view_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables and the input views built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, view: str) -> DataFrame:
        if view not in VIEWS:
            raise AttributeError(view)
        table, columns = VIEWS[view]
        return self.base(table).selectExpr(*(f"{expr} as `{name}`" for name, expr in columns.items()))


def query(name: str, oracle: str | None = None, views: str = ""):
    """Register ``fn(tables) -> DataFrame``; ``views`` lists the input views the oracle text uses."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ctes = ", ".join(f"{v} AS ({view_sql(v)})" for v in views.split())
            body = oracle.strip()
            if ctes:
                body = f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"
            ORACLES[name] = body
        return fn

    return add
