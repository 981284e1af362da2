"""The life of a run: opened, judged against the last published one, closed or failed, and read back by the next."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell import config as C
from upswell.operators import quality as Q
from upswell.operators import tables as B
from upswell.session import stored
from upswell.sources.stored import latest_run

Result = TypeVar("Result")


@dataclass
class Judged:
    """Report (one row, with decision and reason) and closed run row of a run."""

    report: DataFrame
    run: DataFrame
    publish: bool
    reason: str


def published_report(runs: DataFrame) -> DataFrame:
    """Report of the latest run that really published; no row if there is none."""
    return latest_run(runs, published_only=True).filter("quality_report IS NOT NULL").select("quality_report.*")


def judge_run(
    candidates: DataFrame, ranked: DataFrame, events: DataFrame, parsed: DataFrame, counters: DataFrame, runs: DataFrame | None,
    run_id: str, started_at: Column, finished_at: Column, rules: Sequence[tuple[str, str, float]] = tuple(C.QUALITY_RULES),
) -> Judged:
    """Build the report, compare it with the one the latest published run of ``runs`` stored, and close the run row."""
    report = Q.check_thresholds(Q.build_quality_report(candidates, ranked, events, parsed, generated_at=finished_at), rules)
    old = report.filter("false") if runs is None else published_report(runs)
    report = stored(Q.should_publish(Q.previous_report(report, old)))
    verdict = report.select("publish", "publish_reason").first()
    whole = report.select(F.struct(*report.columns).alias("_report"))
    both = Q.side_by_side([counters, whole])
    publish = F.col("_report.publish")
    status = F.when(publish, "success").otherwise("success_with_warnings")
    named = both.withColumn("_status", status).withColumn("_publish", publish)
    row = B.record_run(
        named.select(*counters.columns, "_report", "_status", "_publish"), run_id, started_at, finished_at, F.col("_status"), F.col("_publish"), F.col("_report")
    )
    return Judged(report, row, bool(verdict.publish), verdict.publish_reason)


def within_run(spark: SparkSession, root: str, run_id: str, started_at: Column, finished_at: Column, work: Callable[[DataFrame], Result], fetched: Callable[[], int] | None = None) -> Result:
    """Open the run in the table at ``root``, give ``work`` the runs stored so far, and store a failed row if it raises.

    ``work`` stores the closed row itself (``append_run_state``) when its other results are stored. A run whose driver is lost stays open.
    """
    opened = B.open_run(spark, run_id, started_at)
    B.append_run_state(opened, root)
    try:
        return work(B.read_runs(spark, root))
    except Exception:
        B.append_run_state(B.failed_run(opened, finished_at, None if fetched is None else fetched()), root)
        raise
