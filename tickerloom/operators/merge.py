"""Table mutations as transforms: ``(target, incoming) -> rows to append`` or the new table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.ranking import first_per_key, last_per_key


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str, position: list[str]) -> DataFrame:
    """Rows to append: keys the target lacks; of repeated incoming keys the first."""
    return first_per_key(incoming, [key], position).join(target.select(key), key, "left_anti")


def upsert(target: DataFrame, incoming: DataFrame, key: str, position: list[str], stamp: str | None = None) -> DataFrame:
    """The new table: incoming rows replace the target's, of repeated keys the last.

    ``stamp`` names a column set to the current time on every incoming row.
    """
    last = last_per_key(incoming, [key], position)
    if stamp:
        last = last.withColumn(stamp, F.current_timestamp())
    return target.join(last.select(key), key, "left_anti").unionByName(last.select(*target.columns))


def clear_exchange(target: DataFrame, exchange: str) -> DataFrame:
    """The new table without one exchange's rows."""
    return target.where(~F.coalesce(F.col("exchange") == exchange, F.lit(False)))


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Spark enforces no unique constraint."""
    return frame.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def missing_keys(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that break a NOT NULL rule."""
    broken = F.lit(False)
    for name in columns:
        broken = broken | F.col(name).isNull()
    return frame.where(broken)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Set union of single-column frames."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame)
    return result.distinct()
