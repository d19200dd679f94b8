"""What the two vector searches share: usable vectors, copies held once, blocks of queries, final ranks.

A search compares different vectors only. Vectors that many rows hold are held once, with the few
smallest ids a result of k rows can ever need, and a query's own row is left out at the end; so a
vector that a third of all rows hold costs as much as any other. Rows are told apart by a number of their
own: rows that repeat an id, with one vector or several, are candidates and queries each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import materialise

c = F.col


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, row, vector as doubles) of the rows without null or non-finite parts; to be written before ``row`` is used."""
    parts = c(vector_col).cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(c(id_col).isNotNull() & c(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    return kept.select(c(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), parts.alias("vector"))


def held_once(vectors: DataFrame, k: int) -> DataFrame:
    """(vid, vector, dim, ids, rows): every different vector and its first k + 1 rows by id; the first one's number is ``vid``."""
    turn = F.row_number().over(W.partitionBy("vector").orderBy("id", "row"))
    few = vectors.withColumn("turn", turn).filter(c("turn") <= k + 1)
    held = few.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("held"))
    part = lambda name: F.transform("held", lambda h: h[name]).alias(f"{name}s")
    return held.select(c("held")[0]["row"].alias("vid"), "vector", F.size("vector").alias("dim"), part("id"), part("row"))


def holders(frame: pd.DataFrame) -> list[list[tuple[int, int]]]:
    """Per vector of :func:`held_once` the (id, row) that hold it."""
    return [list(zip(map(int, i), map(int, r), strict=True)) for i, r in zip(frame["ids"], frame["rows"], strict=True)]


def query_rows(vectors: DataFrame, once: DataFrame, every: int) -> DataFrame:
    """(query_id, query_row, vid) of the rows whose id is divisible by ``every``."""
    asked = vectors.filter(F.pmod(c("id"), F.lit(every)) == 0)
    return asked.join(once.select("vector", "vid"), "vector").select(c("id").alias("query_id"), c("row").alias("query_row"), "vid")


def blocks_of(frame: DataFrame, group: Column, rows: int, salt: int) -> tuple[DataFrame, dict]:
    """``frame`` with ``block``, a number that about ``rows`` rows of one ``group`` share, and {group: (first, blocks)}.

    The groups are few by construction (dimensions, or routing objects): one count each comes to the driver.
    """
    grouped = frame.withColumn("group", group)
    counts = sorted((r["group"], r["n"]) for r in grouped.groupBy("group").agg(F.count("*").alias("n")).collect())
    first, at = {}, 0
    for name, n in counts:
        first[name] = (at, -(-n // rows))
        at += first[name][1]
    if not first:
        return grouped.withColumn("block", F.lit(0)).drop("group"), {}
    starts = F.create_map(*(F.lit(x) for name, (start, _) in first.items() for x in (name, start)))
    parts = F.create_map(*(F.lit(x) for name, (_, n) in first.items() for x in (name, n)))
    block = starts[c("group")] + F.pmod(F.xxhash64("vid", F.lit(salt)), parts[c("group")])
    return grouped.withColumn("block", block.cast("int")).drop("group"), first


def pairs(left: DataFrame, left_blocks: dict, key: str, right_blocks: dict, other: str) -> DataFrame:
    """The packed blocks ``left``, numbered by ``key``, once for each block ``other`` of the same group.

    Blocks of a group are numbered in a row, so a group's partners are one range.
    """
    spread = F.array().cast("array<int>")
    for group, (start, n) in left_blocks.items():
        first, m = right_blocks.get(group, (0, 0))
        if m:
            spread = F.when(c(key).between(start, start + n - 1), F.sequence(F.lit(first), F.lit(first + m - 1))).otherwise(spread)
    return left.withColumn(other, F.explode(spread))


def matrix(column: pd.Series, dtype) -> np.ndarray:
    return np.array(column.tolist(), dtype)


def ranked(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vid, id, row, score): k best of other rows, ties to the smaller id."""
    best = W.partitionBy("vid").orderBy(c("score").desc(), "id", "row")
    few = found.withColumn("turn", F.row_number().over(best)).filter(c("turn") <= k + 1).drop("turn")
    per_query = queries.join(materialise(few), "vid").filter(c("row") != c("query_row"))
    order = W.partitionBy("query_row").orderBy(c("score").desc(), "id", "row")
    out = per_query.withColumn("rank", F.row_number().over(order).cast("int")).filter(c("rank") <= k)
    return out.select("query_id", "rank", c("id").alias("vec_id"), "score")
