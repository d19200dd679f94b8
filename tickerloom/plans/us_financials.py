"""US financials: three files per statement -> long statement rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.operators import coverage, ranking, runlog, statements
from tickerloom.operators.coverage import WriteCounts
from tickerloom.session import written_once
from tickerloom.sinks.tables import append_rows

KEYS = ["Ticker", "Report Date"]


def deduplicated(parts: list[DataFrame], position: list[str]) -> DataFrame:
    """Union of a statement's files in priority order (banks, insurance, general), one row per key."""
    return ranking.dedup_by_priority(ranking.union_by_priority(parts), KEYS, "source_priority", position)


#: A statement's files in priority order, or one frame that holds them all under ``source_priority``.
Files = list[DataFrame] | DataFrame


def _one_per_key(files: Files, position: list[str]) -> DataFrame:
    if isinstance(files, DataFrame):  # one scan instead of one for each file
        return ranking.dedup_by_priority(files, KEYS, "source_priority", position)
    return deduplicated(files, position)


def us_statement(files: Files, stmt_type: str, position: list[str]) -> DataFrame:
    return statements.unpivot_tags(_one_per_key(files, position), stmt_type)


def us_financials(parts: dict[str, Files], position: list[str]) -> DataFrame:
    """``parts`` maps IS, BS and CF to their files; a missing or empty list is skipped."""
    return reduce(DataFrame.unionByName, (us_statement(f, stmt, position) for stmt, f in _landed(parts).items()))


def _landed(parts: dict[str, Files]) -> dict[str, Files]:
    landed = {stmt: files for stmt, files in parts.items() if isinstance(files, DataFrame) or files}
    if not landed:
        raise ValueError("no statement files landed")
    return landed


def us_financials_coverage(parts: dict[str, Files], position: list[str], context: dict | None = None) -> DataFrame:
    """The load's status row without loading: tickers and whether they give rows, from one pass over the kept rows.

    De-duplication keeps a row of every ticker, so no second scan is needed for the candidates.
    """
    marks = (statements.ticker_marks(_one_per_key(f, position), stmt) for stmt, f in _landed(parts).items())
    return coverage.marked_status(reduce(DataFrame.unionByName, marks), context)


def us_financials_early_exit(spark: SparkSession, parts: dict[str, Files]) -> DataFrame | None:
    """The status row of a load for which no statement file landed, else None."""
    if any(isinstance(files, DataFrame) or files for files in parts.values()):
        return None
    return runlog.plain_status(spark, "error", "No datasets fetched via API", {"phase": "empty_fetch"})


def us_financials_load(spark: SparkSession, parts: dict[str, Files], position: list[str], path: str, context: dict | None = None) -> DataFrame:
    """Load the statements into the table folder ``path``; the run's status row, for the log.

    The files are read once: their kept rows are written to scratch, and rows, coverage and counts come from
    there. The details lead with ``context`` and the counts: rows skipped for a day that can't be read, and
    rows per statement, both taken by the passes that write.
    """
    early = us_financials_early_exit(spark, parts)
    if early is not None:
        return early
    skipped, written, marks = WriteCounts(), WriteCounts(), []
    for stmt, files in _landed(parts).items():
        wide = _one_per_key(files, position)
        if "Ticker" not in wide.columns:
            continue
        kept = statements.kept_tags(wide, stmt)
        kept = written_once(skipped.on(kept, skipped_days=statements.skipped_days(kept)))
        rows = written.on(statements.rows_of_kept(kept, stmt), **{f"rows_{stmt}": F.count(F.lit(1))})
        append_rows(rows, path, "financials", sort_by="ticker")
        marks.append(statements.marks_of_kept(kept, stmt))
    if not marks:
        return runlog.plain_status(spark, "error", "No datasets fetched via API", {"phase": "empty_fetch"})
    counts = {**(context or {}), **skipped.result(), **written.result()}
    return coverage.marked_status(reduce(DataFrame.unionByName, marks), counts)


def us_financials_status(
    parts: dict[str, list[DataFrame]], loaded: DataFrame, context: dict | None = None
) -> DataFrame:
    """Status row of the load, its details led by ``context`` (market, variant and the like).

    Pass the *written* rows as ``loaded`` so that they are not recomputed.
    """
    files = [f for group in parts.values() for f in group]
    candidates = coverage.candidate_tickers(*files)
    return coverage.coverage_status(candidates, loaded.select(F.col("ticker")), context)
