"""Scoring of all companies from their event history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell.operators import ranking as G
from upswell.operators import scoring as P
from upswell.operators.events import event_sources
from upswell.operators.independence import independent_sources
from upswell.session import stored


def score_companies(
    companies: DataFrame, events: DataFrame, thresholds: DataFrame, now: Column, half_life: float = C.HALF_LIFE_DAYS, provenance: DataFrame | None = None,
    gate: C.EligibilityConfig | None = None,
) -> DataFrame:
    """All component scores, confidence and gate inputs, one row per company. Where ``provenance`` (of field values) holds
    a contradiction, the confidence of the company is lowered. With ``gate``, companies that would not pass it even with all
    sources independent are left out, after the peer comparison, and their sources are not read; the others still have to be put through the gate.

    The history is aggregated per company in one pass for the event components,
    once per round for funding, and once per source for independence; every join
    below has one row per company on its right side.
    """
    rollup = P.event_rollup(events, now, half_life)
    rounds = P.funding_rollup(events).select(
        "company_id", F.col("latest_funding_stage").alias("funding_stage"),
        F.col("latest_funding_amount_usd").alias("funding_amount_usd"),
        "latest_funding_date", "total_disclosed_funding_usd",
    )
    zero = F.lit(0)
    rows = companies.join(rollup, "company_id", "left").join(rounds, "company_id", "left")
    contradicted = None
    if provenance is not None:
        contradicted = "contradicted"
        rows = rows.join(P.contradicted_companies(provenance), "company_id", "left").withColumn(contradicted, F.coalesce(contradicted, F.lit(False)))
    for c in ("recent_verified_events", "traction", "market_expansion"):
        rows = rows.withColumn(c, F.coalesce(c, zero))

    def judged(rows: DataFrame) -> DataFrame:
        return P.primary_domain_verified(P.data_confidence(P.completeness(rows), contradicted))

    if gate is not None:
        # neither the confidence nor any test gets worse with more sources
        best = G.eligibility_gate(judged(rows.withColumn("independent_sources", F.lit(2**31 - 1))), gate)
        rows = best.select(*rows.columns, F.col("eligible").alias("_may_pass"))
    # the peer comparison reads its input several times; one row per company is stored
    # once so that none of those reads goes back to the event history
    rows = stored(rows)
    used = event_sources(events)
    if gate is not None:
        used = used.join(stored(rows.filter("_may_pass").select("company_id")), "company_id", "left_semi")
    rows = P.stage_adjusted_funding(rows, thresholds)
    if gate is not None:
        rows = rows.filter("_may_pass").drop("_may_pass")
    rows = rows.join(stored(independent_sources(used)), "company_id", "left").withColumn("independent_sources", F.coalesce("independent_sources", zero))
    return judged(P.corroboration_component(P.moat_component(P.hiring_momentum(rows))))
