"""Event roll-ups, peer comparison and the component scores of companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions import scores as S
from upswell.functions.text import is_populated
from upswell.functions.money import amount_points_v1, decimal_sum, stage_points_v1
from upswell.operators.common import cohort_ranks, spread_nulls


def _on(event_date: str | None = None) -> Column:
    return F.to_date(F.coalesce(F.col("event_date"), F.col("published_at"))) if event_date else F.to_date("published_at")


def _event_day(events: DataFrame) -> Column:
    return _on("event_date" if "event_date" in events.columns else None)


def countable_events(events: DataFrame, types: Sequence[str]) -> DataFrame:
    """Completed events of the given types."""
    return events.filter(S.is_countable(F.col("event_type"), F.col("verification_status"), types))


def completed_funding(events: DataFrame) -> DataFrame:
    return events.filter(
        (F.col("event_type") == "funding_round_completed")
        & (F.col("verification_status") == "completed")
        & (F.col("amount_usd") != 0)
    )


def _decayed_sum(events: DataFrame, types: Sequence[str], now: Column, half_life: float) -> Column:
    worth = S.decayed(
        S.event_base(F.col("event_type")).cast("double"), S.age_days(_event_day(events), now), half_life
    )
    counts = S.is_countable(F.col("event_type"), F.col("verification_status"), types)
    return S.clamp(F.coalesce(F.sum(F.when(counts, worth)), F.lit(0.0)))


def decayed_event_score(
    events: DataFrame, types: Sequence[str], now: Column, half_life: float = C.HALF_LIFE_DAYS,
    name: str = "score",
) -> DataFrame:
    """Sum of base value times exp(-age / half_life) over countable events, 0..100."""
    return events.groupBy("company_id").agg(_decayed_sum(events, types, now, half_life).alias(name))


def recent_events_score(events: DataFrame, now: Column, half_life: float = C.HALF_LIFE_DAYS) -> DataFrame:
    types = S.component_types("recent_verified_events")
    return decayed_event_score(events, types, now, half_life, "recent_verified_events")


def traction_score(events: DataFrame, now: Column, half_life: float = C.HALF_LIFE_DAYS) -> DataFrame:
    return decayed_event_score(events, S.component_types("traction"), now, half_life, "traction")


def market_expansion_score(events: DataFrame, now: Column, half_life: float = C.HALF_LIFE_DAYS) -> DataFrame:
    types = S.component_types("market_expansion")
    return decayed_event_score(events, types, now, half_life, "market_expansion")


def days_since_last_event(events: DataFrame, now: Column) -> DataFrame:
    last = F.to_date(F.max("published_at"))
    return events.groupBy("company_id").agg(
        last.alias("last_event_date"), F.datediff(now, last).alias("days_since_event")
    )


def best_source_tier(events: DataFrame) -> DataFrame:
    return events.groupBy("company_id").agg(F.min("source_tier").alias("best_source_tier"))


def extraction_confidence(claims: DataFrame, key: str = "group_key") -> DataFrame:
    return claims.groupBy(key).agg(
        F.avg(F.coalesce(F.col("confidence"), F.lit(0))).alias("extraction_confidence")
    )


def event_rollup(events: DataFrame, now: Column, half_life: float = C.HALF_LIFE_DAYS) -> DataFrame:
    """Everything the scores need from the event history, in one shuffle of it."""
    last = F.to_date(F.max("published_at"))
    aggs = [
        _decayed_sum(events, S.component_types(c), now, half_life).alias(c)
        for c in ("recent_verified_events", "traction", "market_expansion")
    ]
    aggs += [last.alias("last_event_date"), F.datediff(now, last).alias("days_since_event")]
    if "source_tier" in events.columns:
        aggs.append(F.min("source_tier").alias("best_source_tier"))
    if "extraction_confidence" in events.columns:
        aggs.append(
            F.avg(F.coalesce(F.col("extraction_confidence"), F.lit(0))).alias("extraction_confidence")
        )
    return events.groupBy("company_id").agg(*aggs)


def funding_rollup(events: DataFrame) -> DataFrame:
    """Latest round and total per company; rounds with the same stage and amount
    count once. Amounts add up as cents, so the total is the same on every run."""
    rounds = (
        completed_funding(events)
        .groupBy("company_id", "funding_stage", "amount_usd")
        .agg(F.max("published_at").alias("published_at"))
    )
    newest = F.max(F.struct("published_at", "amount_usd", "funding_stage"))
    total = decimal_sum(F.col("amount_usd"))
    return rounds.groupBy("company_id").agg(newest.alias("_last"), total.alias("_total")).select(
        "company_id",
        F.col("_last.funding_stage").alias("latest_funding_stage"),
        F.col("_last.amount_usd").alias("latest_funding_amount_usd"),
        F.to_date("_last.published_at").alias("latest_funding_date"),
        F.nullif("_total", F.lit(0.0)).alias("total_disclosed_funding_usd"),
    )


def peer_percentile(
    df: DataFrame, amount: str = "funding_amount_usd", stage: str = "funding_stage",
    region: str = "region_bucket", min_peers: int = C.MIN_PEERS, exclude_equal: bool = True,
    row_id: str = "company_id",
) -> DataFrame:
    """Add ``n_peers`` and ``peer_percentile`` (NULL below ``min_peers``).

    ``exclude_equal``: peers are the companies of the same stage and region with a
    different amount; otherwise all of them, this one included.
    """
    has_amount = F.col(amount).isNotNull() & (F.col(amount) > 0) & F.col(stage).isNotNull()
    cohort = [F.col(stage).alias("_stage"), F.coalesce(F.col(region), F.lit("")).alias("_region")]
    ranks = cohort_ranks(
        df.filter(has_amount).select(*cohort, F.col(amount).alias("_amount")), ["_stage", "_region"], "_amount"
    )
    if exclude_equal:
        peers, below = F.col("n_cohort") - F.col("n_equal"), F.col("n_at_or_below") - F.col("n_equal")
    else:
        peers, below = F.col("n_cohort"), F.col("n_at_or_below")
    ranks = ranks.select(
        "_stage", "_region", "_amount", peers.cast("int").alias("n_peers"),
        F.when(peers >= min_peers, F.bround(100.0 * below / peers).cast("int")).alias("peer_percentile"),
    )
    # most companies may have no amount; their missing keys must not meet in one task
    match = (
        (spread_nulls(F.when(has_amount, df[stage]), df[row_id]) == ranks["_stage"])
        & (F.coalesce(df[region], F.lit("")) == ranks["_region"])
        & (df[amount] == ranks["_amount"])
    )
    return df.join(ranks, match, "left").drop("_stage", "_region", "_amount")


def stage_fallback_score(
    df: DataFrame, thresholds: DataFrame, amount: str = "funding_amount_usd", stage: str = "funding_stage",
    name: str = "fallback_score",
) -> DataFrame:
    """Points of the highest threshold of the stage that the amount reaches; 10 below
    all of them; 0 without an amount or for a stage that has no table."""
    steps = thresholds.groupBy(F.col("stage").alias("_stage")).agg(
        F.collect_list(F.struct("min_usd", "points")).alias("_steps")
    )
    reached = F.filter("_steps", lambda s: s["min_usd"] <= F.col(amount))
    points = F.coalesce(F.array_max(F.transform(reached, lambda s: s["points"])), F.lit(10))
    out = df.join(steps, df[stage] == F.col("_stage"), "left")
    score = F.when(F.col("_steps").isNull() | F.col(amount).isNull() | (F.col(amount) <= 0), 0).otherwise(points)
    return out.withColumn(name, score).drop("_stage", "_steps")


def stage_adjusted_funding(
    df: DataFrame, thresholds: DataFrame, amount: str = "funding_amount_usd", stage: str = "funding_stage",
    region: str = "region_bucket", min_peers: int = C.MIN_PEERS,
) -> DataFrame:
    """Peer percentile where the cohort is large enough, else the threshold table."""
    scored = stage_fallback_score(
        peer_percentile(df, amount, stage, region, min_peers), thresholds, amount, stage, "_fallback"
    )
    missing = F.col(amount).isNull() | (F.col(amount) <= 0) | F.col(stage).isNull() | (F.col(stage) == "unknown")
    score = F.when(missing, 0).otherwise(F.coalesce("peer_percentile", "_fallback"))
    return scored.withColumn("stage_adjusted_funding", score).drop("peer_percentile", "n_peers", "_fallback")


def hiring_momentum(df: DataFrame) -> DataFrame:
    return df.withColumn("hiring_momentum", S.hiring_momentum(F.col("hiring_status"), F.col("hiring_confidence")))


def moat_component(df: DataFrame) -> DataFrame:
    return df.withColumn("moat_differentiation", S.moat(F.col("moat_confidence")))


def corroboration_component(df: DataFrame, sources: str = "independent_sources") -> DataFrame:
    return df.withColumn("source_corroboration", S.corroboration(F.col(sources)))


def completeness(df: DataFrame, fields: Sequence[str] = tuple(C.COMPLETENESS_FIELDS)) -> DataFrame:
    """Share of the fields with a real value; a field the frame lacks is not filled."""
    present = [f for f in fields if f in df.columns]
    if not present:
        return df.withColumn("data_completeness", F.lit(0))
    share = S.completeness(present) if len(present) == len(fields) else _share(present, len(fields))
    return df.withColumn("data_completeness", share)


def _share(present: Sequence[str], tracked: int) -> Column:
    filled = sum((is_populated(F.col(c)).cast("int") for c in present), F.lit(0))
    return F.bround(100 * filled / F.lit(tracked)).cast("int")


def data_confidence(df: DataFrame, contradicted: str | None = None) -> DataFrame:
    resolution = [F.col(c) for c in ("homepage_confidence", "resolution_confidence") if c in df.columns]
    return df.withColumn(
        "data_confidence",
        S.data_confidence(
            F.col("best_source_tier"), F.col("independent_sources"), F.col("days_since_verified"),
            F.col("data_completeness"), resolution, F.col("extraction_confidence"),
            F.coalesce(F.col(contradicted), F.lit(False)) if contradicted else None,
        ),
    )


def contradicted_companies(provenance: DataFrame) -> DataFrame:
    """``company_id, contradicted``: whether for some field the best sources disagree.

    ``provenance`` has company_id, field_name, field_value, source_tier. Values of a field are compared within its best tier only (a weaker
    source that says otherwise is outvoted, not a contradiction), without case or outer blanks; words for "unknown" are no values.
    Only the smallest and largest value of each (company, field, tier) are kept, so a company with very many rows costs one row a task.
    """
    value = F.lower(F.trim(F.col("field_value").cast("string")))
    known = provenance.filter(is_populated(F.col("field_value")) & F.col("source_tier").isNotNull())
    tiers = known.groupBy("company_id", "field_name", "source_tier").agg(F.min(value).alias("low"), F.max(value).alias("high"))
    fields = tiers.groupBy("company_id", "field_name").agg(F.min_by(F.col("low") != F.col("high"), "source_tier").alias("differs"))
    return fields.groupBy("company_id").agg(F.bool_or("differs").alias("contradicted"))


def staleness_flags(df: DataFrame, days: str = "days_since_verified") -> DataFrame:
    d = F.col(days)
    return df.withColumn("stale_warning", F.coalesce(d > C.STALE_WARN_DAYS, F.lit(False))).withColumn(
        "stale_excluded", F.coalesce(d > C.STALE_EXCLUDE_DAYS, F.lit(False))
    )


def primary_domain_verified(df: DataFrame) -> DataFrame:
    ok = (F.coalesce(F.col("primary_domain"), F.lit("")) != "") & (
        F.coalesce(F.col("homepage_confidence"), F.lit(0)) >= C.HOMEPAGE_MIN_CONFIDENCE
    )
    return df.withColumn("primary_domain_verified", ok)


def momentum_score_v1(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The older four-part profile."""
    w = weights or C.WEIGHTS_V1
    parts = {
        "funding_stage": stage_points_v1(F.col("funding_stage")),
        "funding_amount": amount_points_v1(F.col("funding_amount_usd")),
        "investor_presence": F.when(F.coalesce(F.col("investors"), F.lit("")) != "", 100).otherwise(0),
        "hiring_signal": F.when(F.coalesce(F.col("hiring_status"), F.lit("")) == "Likely hiring", 100).otherwise(0),
    }
    total = sum((c * F.lit(float(w.get(k, 0.0))) for k, c in parts.items()), F.lit(0.0))
    return df.withColumn("momentum_score", S.clamp(total))


def data_confidence_v1(df: DataFrame, fields: Sequence[str] = tuple(C.CONFIDENCE_FIELDS_V1)) -> DataFrame:
    """Share of fields that are not NULL or empty; the word "Unknown" counts as filled."""
    filled = sum((F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", 1).otherwise(0) for f in fields), F.lit(0))
    return df.withColumn("data_confidence", F.bround(100 * filled / F.lit(len(fields))).cast("int"))
