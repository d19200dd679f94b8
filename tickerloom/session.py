"""Session settings the library is written for, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tickerloom.sinks import storage

_handed_out: ContextVar[list[str] | None] = ContextVar("handed_out", default=None)

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "tickerloom", master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with :data:`SETTINGS`, overridden by ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``, or the checkpoint folder the context was given.

    One of them has to be set. There is no fallback: in a machine-local folder every executor would
    write to a different disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{root.rstrip('/')}/tickerloom/{uuid.uuid4().hex}"
    if (folders := _handed_out.get()) is not None:
        folders.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders handed out inside, on leaving.

    Frames made inside read those folders: write what is still needed elsewhere before. A scope inside
    another one deletes its own folders only.
    """
    folders: list[str] = []
    token = _handed_out.set(folders)
    try:
        yield
    finally:
        _handed_out.reset(token)
        for folder in folders:
            storage.delete(spark, folder)


def written_once(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared scratch folder and read back, for results that are used several times."""
    path = scratch_dir(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
