"""Landed price files -> gated append per micro-batch.

A batch reduces to one bar per symbol, and only bars past the symbol's mark are appended. The marks are
versioned by batch id beside the stream's checkpoint (:mod:`tickerloom.sinks.gated`): a batch joins them
and adds its own, so that no batch reads the target. A batch that a restarted stream delivers again is passed
over if its marks are there; if it was cut off between staging its rows and marking them, the rows
that are missing are appended, and only then the target is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickerloom.operators import bars, gate
from tickerloom.session import scratch_dir
from tickerloom.sinks.gated import GatedTarget
from tickerloom.sources.files import read_bulk_csv_stream


class GatedAppend:
    """Appends micro-batches of one exchange to a target, with its marks in ``state_path`` (scratch, if not given)."""

    def __init__(self, target_path: str, position: list[str], exchange: str = "US", state_path: str | None = None):
        self.target_path, self.position, self.exchange, self.state_path = target_path, position, exchange, state_path
        self._target: GatedTarget | None = None

    def target(self, spark: SparkSession) -> GatedTarget:
        if self._target is None:
            self._target = GatedTarget(self.target_path, self.state_path or scratch_dir(spark))
        return self._target

    def found(self, batch: DataFrame) -> DataFrame:
        """One bar per symbol of a batch."""
        latest = bars.latest_only(bars.bulk_bars(batch), self.position)
        return bars.require_price(bars.bulk_to_bars(latest, self.exchange))

    def newer(self, batch: DataFrame) -> DataFrame:
        """The bars of a batch that are past their marks."""
        return gate.gated_append(self.found(batch), self.target(batch.sparkSession).marks(batch.sparkSession), self.exchange)

    def __call__(self, batch: DataFrame, batch_id: int | None = None) -> None:
        version = None if batch_id is None else batch_id + 1  # 0 is what the target held before
        self.target(batch.sparkSession).append(self.found(batch), self.exchange, version)


def gate_batch(batch: DataFrame, target_path: str, position: list[str], exchange: str = "US") -> None:
    """Append the bars of a single batch that are newer than the target's."""
    GatedAppend(target_path, position, exchange)(batch)


def stream_gated_append(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target_path: str,
    checkpoint: str,
    position: list[str],
    exchange: str = "US",
    files_per_batch: int | None = 100,
    csv: bool = False,
) -> StreamingQuery:
    """Start the query over landed parquet, or bulk CSV, files; it stops when all of them are processed.

    The target folder must exist. One writer per exchange is assumed. With ``files_per_batch=None`` all files that
    have landed are one batch, so a bulk dataset may be dealt out to any number of files.
    """
    if csv:
        landed = read_bulk_csv_stream(spark, landing, schema, files_per_batch)
    else:
        reader = spark.readStream.schema(schema)
        landed = (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).parquet(landing)
    return (
        landed.writeStream.foreachBatch(GatedAppend(target_path, position, exchange, f"{checkpoint}/gate"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
