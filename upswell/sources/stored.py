"""Scans of stored tables: identity, aliases, event history, runs, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell import schemas


def scan_identity(companies: DataFrame) -> DataFrame:
    """Only the six identity columns; the other columns are never read."""
    return companies.select(schemas.IDENTITY_COLUMNS)


def scan_aliases(aliases: DataFrame) -> DataFrame:
    return aliases.select(schemas.ALIAS_COLUMNS)


def scan_event_history(events: DataFrame, touched: DataFrame) -> DataFrame:
    """Full history of all touched companies in one semi join. Operators that care
    about newest-first order take it from ``published_at``."""
    return events.join(touched.select("company_id").distinct(), "company_id", "left_semi")


def latest_run(
    runs: DataFrame, statuses: Sequence[str] = ("success", "success_with_warnings"), n: int = 1,
    published_only: bool = False,
) -> DataFrame:
    done = runs.filter(F.col("run_status").isin(list(statuses)))
    if published_only:
        done = done.filter("published")
    return done.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def load_weights(stored: DataFrame | None, defaults: DataFrame) -> DataFrame:
    """Stored weights as they are; the defaults when the table is missing or empty."""
    if stored is None:
        return defaults
    rows = stored.filter(F.col("component").isNotNull() & F.col("weight").isNotNull()).select(
        "component", F.col("weight").cast("double").alias("weight")
    )
    empty = rows.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    fallback = defaults.join(empty, F.lit(True), "left_semi")
    return rows.unionByName(fallback.select("component", "weight"))


def weights_with_defaults(stored: DataFrame | None, defaults: DataFrame) -> DataFrame:
    """The weight of every component of ``defaults``: the stored one where there is one, else its default. Stored components of other names go.

    A component that is stored twice has its largest weight. Both frames are config-sized; ``ranking.checked_weights`` tells
    whether the result is sound.
    """
    if stored is None:
        return defaults.select("component", "weight")
    own = stored.filter("weight IS NOT NULL").groupBy("component").agg(F.max(F.col("weight").cast("double")).alias("_stored"))
    return defaults.join(own, "component", "left").select("component", F.coalesce("_stored", "weight").alias("weight"))
