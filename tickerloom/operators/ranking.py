"""Top rows per key.

All of these are ``row_number() <= k`` filters. Catalyst turns that shape into a window group
limit that runs before the shuffle as well, so a task hands on at most ``k`` rows of a key however
many it holds: a key with a third of the table does not pile up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(frame: DataFrame, keys: list[str], order: list[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each key under ``order``; null keys form one key.

    ``rank`` keeps the row number under that name.
    """
    name = rank or "_row_no"
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = frame.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def first_per_key(frame: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    return top_per_key(frame, keys, [F.col(c).asc_nulls_first() for c in position])


def last_per_key(frame: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    return top_per_key(frame, keys, [F.col(c).desc_nulls_last() for c in position])


def dedup_by_priority(frame: DataFrame, keys: list[str], priority: str, position: list[str]) -> DataFrame:
    """One row per key: the best (lowest) priority, then the first landed.

    Left alone when a key column is missing.
    """
    if not set(keys) <= set(frame.columns):
        return frame
    return first_per_key(frame, keys, [priority, *position])


def union_by_priority(parts: list[DataFrame], priority: str = "source_priority") -> DataFrame:
    """Union with all columns of all parts, tagged with the part's place in the list."""
    tagged = [p.withColumn(priority, F.lit(i)) for i, p in enumerate(parts)]
    result = tagged[0]
    for part in tagged[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
