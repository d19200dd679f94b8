"""A price table that takes a symbol's newer bars only, with its marks beside it.

The marks (newest stored day and time per exchange and symbol) are kept in versions: every append writes
what it moved as one more version, and the marks are the maximum over all of them. So a load reads the
compact marks, never the target. Its bars are staged first, appended from there, and then counted in the
marks. An append that was cut off leaves a staged version without marks; the next one finishes it, holding
it against the stored rows of its days. That is the only time the target is read, besides the first use.

One writer per target is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom import schemas
from tickerloom.operators import gate
from tickerloom.operators.coverage import WriteCounts
from tickerloom.session import written_once
from tickerloom.sinks import storage
from tickerloom.sinks.tables import append_rows, check_constraints, to_table

#: Versions of the marks after which they are merged into one.
MERGE_AFTER = 32


class GatedTarget:
    """A ``stock_prices`` folder and the state of its appends; ``timed`` if it has an ``as_of`` column.

    Bars without a price are never appended.
    """

    def __init__(self, target_path: str, state_path: str, timed: bool = False):
        self.target_path, self.timed = target_path, timed
        self.marks_path, self.staged_path = f"{state_path}/marks", f"{state_path}/staged"
        self.schema = schemas.STOCK_PRICES_AS_OF if timed else schemas.STOCK_PRICES

    def stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.target_path)

    def marks(self, spark: SparkSession) -> DataFrame:
        """exchange, symbol, last_seen and, for a timed target, seen_time; from the target if there are none yet."""
        self.finish(spark)
        if not storage.versions(spark, self.marks_path):
            self._mark(self.stored(spark), 0)
        return gate.merged_marks(spark.read.parquet(self.marks_path).drop("version"))

    def append(self, bars: DataFrame, exchange: str, version: int | None = None, counts: WriteCounts | None = None) -> bool:
        """Append the bars past their marks; False if ``version`` was appended before.

        ``version`` numbers the batches of a stream; loads take the next one. ``counts`` takes ``appended``.
        """
        spark = bars.sparkSession
        marks = self.marks(spark)
        done = storage.versions(spark, self.marks_path)
        version = done[-1] + 1 if version is None else version
        if version <= done[-1] and version > 0:
            return False
        if self.timed:
            newer, _ = gate.gate_by_time(bars, marks, exchange)
        else:
            newer = gate.gated_append(bars.drop("as_of"), marks, exchange)
        newer = to_table(newer.where(F.col("price").isNotNull()), "stock_prices")
        if counts is not None:
            newer = counts.on(newer, appended=F.count(F.lit(1)))
        staged = f"{self.staged_path}/version={version}"
        newer.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(newer.schema).parquet(staged)
        try:
            check_constraints(rows, "stock_prices")
        except ValueError:
            storage.delete(spark, staged)
            raise
        self._commit(rows, version)
        return True

    def finish(self, spark: SparkSession) -> None:
        """Finish appends that were cut off after their rows were staged."""
        staged = storage.versions(spark, self.staged_path)
        done = storage.versions(spark, self.marks_path) if staged else []
        for version in staged:
            if version in done:
                storage.delete(spark, f"{self.staged_path}/version={version}")
                continue
            rows = spark.read.schema(self.schema).parquet(f"{self.staged_path}/version={version}")
            keys = schemas.UNIQUE_KEYS["stock_prices"]
            missing = written_once(rows.join(self.stored(spark).select(keys), keys, "left_anti").select(rows.columns))
            self._commit(missing, version, rows)

    def _commit(self, rows: DataFrame, version: int, moved: DataFrame | None = None) -> None:
        append_rows(rows, self.target_path, "stock_prices", sort_by="symbol", checked=True)
        self._mark(rows if moved is None else moved, version)
        storage.delete(rows.sparkSession, f"{self.staged_path}/version={version}")

    def _mark(self, rows: DataFrame, version: int) -> None:
        spark = rows.sparkSession
        gate.marks_of(rows).write.mode("overwrite").parquet(f"{self.marks_path}/version={version}")
        known = storage.versions(spark, self.marks_path)
        if len(known) > MERGE_AFTER:
            # all but the newest go into the second newest, then the older ones go: a crash between leaves marks twice,
            # and the newest still tells which batch was the last
            older, into = spark.read.parquet(self.marks_path).where(F.col("version") < known[-1]).drop("version"), known[-2]
            merged = written_once(gate.merged_marks(older))
            merged.write.mode("overwrite").parquet(f"{self.marks_path}/version={into}")
            for old in known[:-2]:
                storage.delete(spark, f"{self.marks_path}/version={old}")

    def rebuild(self, spark: SparkSession) -> None:
        """Take the marks from the target anew, for a target that was changed by other means."""
        known = storage.versions(spark, self.marks_path)
        self._mark(self.stored(spark), known[-1] if known else 0)
        for old in known[:-1]:
            storage.delete(spark, f"{self.marks_path}/version={old}")
