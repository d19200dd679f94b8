"""Folders on any file system Spark can reach."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    system, place = _place(spark, path)
    system.delete(place, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers n of the folders ``version=n`` below ``path`` whose write was finished."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    names = (status.getPath().getName() for status in system.listStatus(place))
    numbers = (int(m.group(1)) for name in names if (m := re.fullmatch(r"version=(\d+)", name)))
    return sorted(n for n in numbers if exists(spark, f"{path}/version={n}/_SUCCESS"))
