"""Run log rows, step outcomes and recent runs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions.reports import duration_ms
from tickerloom.operators.ranking import top_per_key

# The exit code that aborts a run at once, and the failures that abort it otherwise.
CRITICAL_EXIT = 2
MAX_FAILURES = 3


def plain_status(spark: SparkSession, status: str, message: str, details: dict | None = None) -> DataFrame:
    """Status row of a run that ended before it had counters, such as a failed or empty input."""
    return spark.range(1).select(
        F.lit(status).alias("status"), F.lit(message).alias("message"), F.lit(json.dumps(details or {})).alias("details")
    )


def run_log_rows(status: DataFrame, script: Column, started: Column, ended: Column) -> DataFrame:
    """Status rows -> run log rows."""
    return status.select(
        script.alias("script"), "status", "message", "details",
        started.alias("started_at"), ended.alias("ended_at"),
        duration_ms(started, ended).alias("duration_ms"),
    )


def run_outcomes(steps: DataFrame, max_failures: int = MAX_FAILURES) -> DataFrame:
    """Per run the step that aborted it, if any, and its exit code.

    A critical exit aborts at once (code 2); the ``max_failures``-th other failure aborts with
    code 1. Only the first failures of a run matter, so these are taken by a ranking that is cut
    before the shuffle, instead of a running sum over all steps.
    """
    failed = steps.where("exit_code <> 0").select(
        "run_id", "step_no", (F.col("exit_code") == CRITICAL_EXIT).alias("critical")
    )
    first = top_per_key(failed, ["run_id", "critical"], [F.col("step_no")], k=max_failures)
    per_run = first.groupBy("run_id").agg(
        F.min(F.when(F.col("critical"), F.col("step_no"))).alias("critical_step"),
        # at most max_failures elements
        F.sort_array(F.collect_list(F.when(~F.col("critical"), F.col("step_no")))).alias("failed_steps"),
    )
    totals = steps.groupBy("run_id").agg(F.count("*").alias("steps_planned"))
    limit_step = F.get("failed_steps", F.lit(max_failures - 1))
    abort = F.least("critical_step", "limit_step")  # least() passes over nulls
    failures = F.size(
        F.filter(F.coalesce("failed_steps", F.array().cast("array<bigint>")), lambda s: abort.isNull() | (s <= abort))
    )
    is_critical = F.col("critical_step") == abort
    exit_code = F.when(abort.isNull(), 0).when(is_critical, CRITICAL_EXIT).otherwise(1)
    outcome = F.when(abort.isNull(), "complete").when(is_critical, "critical").otherwise("too many failures")
    return (
        totals.join(per_run, "run_id", "left")
        .withColumn("limit_step", limit_step)
        .select(
            "run_id",
            "steps_planned",
            failures.cast("bigint").alias("counted_failures"),
            abort.alias("abort_step"),
            exit_code.alias("exit_code"),
            outcome.alias("outcome"),
        )
    )


def steps_not_run(steps: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Steps after their run's abort."""
    aborts = outcomes.where("abort_step is not null").select("run_id", "abort_step")
    return steps.join(aborts, "run_id").where("step_no > abort_step").drop("abort_step")


def recent_runs(logs: DataFrame, by: str = "script", k: int = 3, position: tuple[str, ...] = ()) -> DataFrame:
    """The latest ``k`` runs per script, or per status."""
    order = [F.col("started_at").desc(), *(F.col(p).desc() for p in position)]
    return top_per_key(logs, [by], order, k)
