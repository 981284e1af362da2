"""Eligibility, momentum score, regional rank and rank history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions import scores as S

COMPONENTS = list(C.WEIGHTS)


def weights_diff(weights: DataFrame, defaults: DataFrame) -> DataFrame:
    """Problems of a weight table: missing, unexpected or negative components, and a
    sum other than 1. Empty when it is sound. Both frames are config-sized."""
    both = defaults.select("component", F.col("weight").alias("d")).join(
        weights.select("component", F.col("weight").alias("w")), "component", "full_outer"
    )
    bad = (
        F.when(F.col("w").isNull(), "missing").when(F.col("d").isNull(), "unexpected").when(F.col("w") < 0, "negative")
    )
    total = weights.agg(F.sum("weight").alias("s")).filter(
        F.col("s").isNull() | (F.abs(F.col("s") - 1.0) > 1e-6)
    )
    return both.select("component", bad.alias("problem")).filter("problem is not null").unionByName(
        total.select(F.lit("*").alias("component"), F.lit("sum is not 1").alias("problem"))
    )


def checked_weights(weights: DataFrame, defaults: DataFrame) -> dict[str, float]:
    """The weight table as a mapping; raises when it is not sound. At most one row per
    component reaches the driver."""
    problems = weights_diff(weights, defaults).limit(20).collect()
    if problems:
        raise ValueError("bad weights: " + ", ".join(f"{r.component}: {r.problem}" for r in problems))
    return {r.component: r.weight for r in weights.collect()}


def eligibility_gate(
    df: DataFrame, cfg: C.EligibilityConfig = C.EligibilityConfig(), sources: str = "independent_sources"
) -> DataFrame:
    """Add ``reasons`` (all failed tests) and ``eligible`` (none failed)."""
    col = F.col
    zero = F.lit(0)

    def fails(test: Column, reason: str) -> Column:
        return F.when(test, F.lit(reason))

    no = lambda c: ~F.coalesce(c, F.lit(False))
    reasons = F.array_compact(
        F.array(
            fails(no(col("region_bucket").isin(C.REGIONS)), "region not supported"),
            fails(no(col("primary_domain_verified")), "primary domain not verified"),
            fails(no(col("industry").isin(C.SUPPORTED_INDUSTRIES)), "industry not supported"),
            fails(no(col("days_since_event") <= cfg.event_window_days), "no recent qualifying event"),
            fails(F.coalesce(col("data_confidence"), zero) < cfg.min_confidence, "data confidence too low"),
            fails(
                no(col("best_source_tier") == 1) & (F.coalesce(col(sources), zero) < cfg.min_sources),
                "only weak sources",
            ),
            fails(col("company_status").isin(C.INELIGIBLE_STATUSES), "company status not rankable"),
            fails(col("entity_resolution_needs_review"), "identity needs review"),
            fails(col("days_since_verified") > cfg.stale_exclude_days, "verification too old"),
        )
    )
    return df.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def momentum_score(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted sum of the components, 0..100; a component outside 0..100 fails the job."""
    w = weights or C.WEIGHTS
    if set(w) != set(COMPONENTS) or abs(sum(w.values()) - 1.0) > 1e-6 or min(w.values()) < 0:
        raise ValueError("weights must name the seven components, be non-negative and sum to 1")

    def part(name: str) -> Column:
        c = F.coalesce(F.col(name), F.lit(0))
        return F.when((c >= 0) & (c <= 100), c * F.lit(float(w[name]))).otherwise(
            F.raise_error(F.lit(f"component {name} is outside 0..100"))
        )

    total = sum((part(n) for n in COMPONENTS[1:]), part(COMPONENTS[0]))
    return df.withColumn("momentum_score", S.clamp(total))


def why_ranked(df: DataFrame, weights: dict[str, float] | None = None, top_n: int = 2) -> DataFrame:
    """A sentence naming the components that contribute most; ties keep the listed order."""
    w = weights or C.WEIGHTS
    parts = F.array(
        *[
            F.struct(
                (-F.coalesce(F.col(n), F.lit(0)) * F.lit(float(w[n]))).alias("k"),
                F.lit(i).alias("i"),
                F.coalesce(F.col(n), F.lit(0)).alias("score"),
                F.lit(C.COMPONENT_LABELS[n]).alias("label"),
            )
            for i, n in enumerate(w)
        ]
    )
    top = F.slice(F.array_sort(parts), 1, top_n)
    labels = F.array_join(F.transform(top, lambda t: t["label"]), " and ")
    text = F.when(F.forall(top, lambda t: t["score"] == 0), F.lit(C.LIMITED_SIGNAL_TEXT)).otherwise(
        F.concat(F.lit("Ranked mainly on "), labels, F.lit("."))
    )
    return df.withColumn("why_ranked", text)


def rank_regions(
    df: DataFrame, weights: dict[str, float] | None = None, top_n: int = C.TARGET_PER_REGION,
    sources: str = "independent_sources",
) -> DataFrame:
    """Top ``top_n`` of each region on its own.

    The rank filter reaches the window as a group limit, so each task sends at
    most ``top_n`` rows per region into the three-key shuffle.
    """
    scored = momentum_score(df, weights)
    order = Window.partitionBy("region_bucket").orderBy(
        F.desc("momentum_score"),
        F.coalesce(F.col("data_confidence"), F.lit(0)).desc(),
        F.col("last_event_date").desc_nulls_last(),
        F.coalesce(F.col(sources), F.lit(0)).desc(),
        F.lower(F.trim(F.coalesce(F.col("canonical_name"), F.lit("")))),
        F.col("company_id"),
    )
    top = scored.withColumn("regional_rank", F.row_number().over(order)).filter(F.col("regional_rank") <= top_n)
    return why_ranked(top, weights).withColumn("score_version", F.lit(C.SCORE_VERSION))


def previous_rank(ranked: DataFrame, snapshots: DataFrame, before: Column) -> DataFrame:
    """Join each ranked company with its rank in its latest snapshot before ``before``."""
    old = (
        snapshots.filter(F.col("run_ts") < before)
        .groupBy("company_id")
        .agg(F.max_by("regional_rank", "run_ts").alias("previous_regional_rank"))
    )
    out = ranked.join(old, "company_id", "left")
    return out.withColumn("rank_change", F.col("previous_regional_rank") - F.col("regional_rank"))


def rank_change(snapshots: DataFrame) -> DataFrame:
    """Previous minus current rank per company and run; NULL for the first run."""
    w = Window.partitionBy("company_id").orderBy("run_ts")
    return snapshots.withColumn("rank_change", F.lag("regional_rank").over(w) - F.col("regional_rank"))


def score_trajectory(snapshots: DataFrame) -> DataFrame:
    """Score of each run with the change since the run before."""
    w = Window.partitionBy("company_id").orderBy("run_ts")
    return snapshots.withColumn("run_no", F.row_number().over(w)).withColumn(
        "score_change", F.col("momentum_score") - F.lag("momentum_score").over(w)
    )
