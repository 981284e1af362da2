"""Quality report of a run and the decision to publish its ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions import scores as S
from upswell.functions.text import is_populated


def rejections_by_reason(gated: DataFrame) -> DataFrame:
    """How many companies failed each test; one company can add to several."""
    return gated.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def confidence_bands(df: DataFrame, bands: DataFrame, col: str = "data_confidence") -> DataFrame:
    """Companies per confidence band; an empty band is there with 0."""
    v = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(F.col(col), F.lit(0))))
    lows = [lo for _, lo, _ in C.CONFIDENCE_BANDS]
    low = F.lit(lows[0])
    for x in lows[1:]:
        low = F.when(v >= x, F.lit(x)).otherwise(low)
    counts = df.groupBy(low.alias("lo")).agg(F.count(F.lit(1)).alias("n"))
    return bands.join(counts, "lo", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


def quality_percentages(ranked: DataFrame, sources: str = "independent_sources") -> DataFrame:
    """Shares over the ranked rows only, one row, one decimal."""
    n = F.count(F.lit(1))

    def share(test, name):
        return S.percent(F.count_if(F.coalesce(test, F.lit(False))), n).alias(name)

    col = F.col
    located = F.coalesce(col("region_bucket"), F.lit("")) != ""
    return ranked.agg(
        n.alias("n_ranked"),
        share(col("data_confidence") >= 70, "pct_ranked_with_confidence_ge_70"),
        share(
            F.coalesce(col(sources) >= 2, F.lit(False)) | F.coalesce(col("best_source_tier") == 1, F.lit(False)),
            "pct_ranked_with_two_sources_or_authoritative",
        ),
        share(located, "pct_ranked_with_verified_headquarters"),
        share(col("funding_amount_usd") != 0, "pct_ranked_with_verified_funding_dates"),
        share(col("hiring_momentum") > 0, "pct_ranked_with_verified_hiring_data"),
        share(col("recent_verified_events") > 0, "pct_ranked_with_recent_verified_event"),
        share(located, "pct_ranked_with_verified_regional_assignment"),
        share(col("primary_domain_verified"), "pct_ranked_with_valid_primary_domain"),
    )


def regional_counts(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("region_bucket").agg(F.count(F.lit(1)).alias("n_ranked"))


def shortfall_by_region(ranked: DataFrame, regions: DataFrame, target: int = C.TARGET_PER_REGION) -> DataFrame:
    """Missing companies per region, empty regions included."""
    n = F.coalesce("n_ranked", F.lit(0))
    return regions.join(regional_counts(ranked), "region_bucket", "left").select(
        "region_bucket", n.alias("n_ranked"), F.greatest(F.lit(0), F.lit(target) - n).alias("shortfall")
    )


def missingness_by_field(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Percentage of rows without a real value, per field, in one pass over the frame."""
    one = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(is_populated(F.col(f))).alias(f) for f in fields]
    )
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])
    return one.select("_n", F.explode(pairs).alias("_pair")).select(
        F.col("_pair.field").alias("field"),
        S.percent(F.col("_n") - F.col("_pair.filled"), F.col("_n")).alias("pct_missing"),
    )


def source_tier_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("source_tier").agg(F.count(F.lit(1)).alias("n"))


def batch_failure_rate(parsed: DataFrame) -> DataFrame:
    """Failed batches in percent; ``all_failed`` is the hard failure of a run."""
    n, bad = F.count(F.lit(1)), F.count_if("failed")
    return parsed.agg(
        n.alias("n_batches"), bad.alias("n_failed"), S.percent(bad, n).alias("failure_rate"),
        ((n > 0) & (bad == n)).alias("all_failed"),
    )


def candidate_counts(candidates: DataFrame) -> DataFrame:
    """Candidates with an amount but no stage, and candidates verified too long ago."""
    amount = F.coalesce(F.col("funding_amount_usd") != 0, F.lit(False))
    return candidates.agg(
        F.count_if(amount & F.col("funding_stage").isNull()).alias("ambiguous_funding_count"),
        F.count_if(F.coalesce(F.col("days_since_verified") > C.STALE_EXCLUDE_DAYS, F.lit(False))).alias("stale_record_count"),
    )


def evidence_checks(events: DataFrame) -> DataFrame:
    """Share of material funding events that carry evidence, and valuations shown as funding."""
    funding = F.col("event_type").isin(C.FUNDING_TYPES)
    shown = funding & F.col("amount_usd").isNotNull() & (F.col("statement_class") == "valuation")
    with_text = funding & (F.coalesce(F.trim("evidence_text"), F.lit("")) != "")
    n = F.count_if(funding)
    return events.agg(
        F.when(n == 0, 100.0).otherwise(S.percent(F.count_if(with_text), n)).alias("pct_material_funding_claims_with_evidence"),
        F.count_if(F.coalesce(shown, F.lit(False))).alias("valuation_shown_as_funding_count"),
    )


def run_counters(articles: DataFrame, validated: DataFrame, gated: DataFrame) -> DataFrame:
    """One row with the counts a run row needs."""
    one = [
        articles.agg(F.count(F.lit(1)).alias("articles_fetched")),
        validated.agg(
            F.count_if("accepted").alias("candidates_extracted"), F.count_if(~F.col("accepted")).alias("validation_failures")
        ),
        gated.agg(
            F.count_if("eligible").alias("companies_accepted"), F.count_if(~F.col("eligible")).alias("companies_rejected")
        ),
    ]
    return side_by_side(one)


def side_by_side(rows: Sequence[DataFrame]) -> DataFrame:
    """One-row frames as one row: their rows are put below each other and folded in one aggregate. A frame without a row gives nulls."""
    parts = [r.select(F.struct(*r.columns).alias(f"_{i}")) for i, r in enumerate(rows)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    one = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    return one.select(*[F.col(f"_{i}")[c].alias(c) for i, r in enumerate(rows) for c in r.columns])


#: What the report counts of each kind of row; ``key`` names the entry of a map the row adds to.
def _report_tests(sources: str, missing: Sequence[str]) -> dict[str, dict[str, Column]]:
    col = F.col
    located = F.coalesce(col("region_bucket"), F.lit("")) != ""
    confidence = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(col("data_confidence"), F.lit(0))))
    funding = col("event_type").isin(C.FUNDING_TYPES)
    return {
        "ranked": {
            "confident": col("data_confidence") >= 70,
            "corroborated": F.coalesce(col(sources) >= 2, F.lit(False)) | F.coalesce(col("best_source_tier") == 1, F.lit(False)),
            "located": located,
            "funded": col("funding_amount_usd") != 0,
            "sized": col("employee_count_min").isNotNull() & col("employee_count_max").isNotNull(),
            "hiring": col("hiring_momentum") > 0,
            "recent": col("recent_verified_events") > 0,
            "domain": col("primary_domain_verified"),
            **{f"band_{lo}": (confidence >= lo) & (confidence <= hi) for _, lo, hi in C.CONFIDENCE_BANDS},
            **{f"filled_{f}": is_populated(col(f)) for f in missing},
        },
        "candidate": {
            "ambiguous": F.coalesce(col("funding_amount_usd") != 0, F.lit(False)) & col("funding_stage").isNull(),
            "stale": col("days_since_verified") > C.STALE_EXCLUDE_DAYS,
        },
        "event": {
            "funding": funding,
            "with_text": funding & (F.coalesce(F.trim("evidence_text"), F.lit("")) != ""),
            "valuation": funding & col("amount_usd").isNotNull() & (col("statement_class") == "valuation"),
        },
        "batch": {"failed": col("failed")},
    }


def build_quality_report(
    candidates: DataFrame, ranked: DataFrame, events: DataFrame, parsed: DataFrame, sources: str = "independent_sources",
    generated_at: Column | None = None, run_status: str = "success", missing: Sequence[str] = tuple(C.COMPLETENESS_FIELDS), first_provider: str | None = None,
) -> DataFrame:
    """The report as one row: percentages, counts and small maps.

    ``candidates`` are the gated rows, ranked or not (``n_candidates``, where it is there, says how many extracted names a company came from);
    ``parsed`` the batches of extraction with ``provider`` and ``failed``. Every frame is reduced to yes and no per test and all are counted
    together: one shuffle of a row per task, kind and map entry, and one of those few rows. A column the ranked rows lack counts as empty.
    Providers other than ``first_provider`` are fallbacks; without one no batch counts as such.
    """
    tests = _report_tests(sources, missing)

    def tagged(df: DataFrame, kind: str, key: Column, only: Sequence[str] | None = None) -> DataFrame:
        wanted = {n: t for n, t in tests[kind].items() if only is None or n in only}
        flags = [F.coalesce(t.cast("long"), F.lit(0).cast("long")).alias(n) for n, t in wanted.items()]
        return df.select(F.lit(kind).alias("kind"), key.cast("string").alias("key"), F.lit(1).cast("long").alias("n"), *flags)

    needed = {"employee_count_min", "employee_count_max", *missing} - set(ranked.columns)
    full = ranked.withColumns({c: F.lit(None).cast("string") for c in sorted(needed)}) if needed else ranked
    copies = F.col("n_candidates") - 1 if "n_candidates" in candidates.columns else F.lit(0)
    reasons = candidates.select(F.explode("reasons").alias("key"))
    rows = [
        tagged(full, "ranked", F.col("region_bucket")),
        tagged(candidates.withColumn("_copies", copies), "candidate", F.lit(None)),
        candidates.select(F.lit("copies").alias("kind"), copies.cast("long").alias("n")),
        reasons.select(F.lit("reason").alias("kind"), "key", F.lit(1).cast("long").alias("n")),
        tagged(events, "event", F.col("source_tier")),
        tagged(parsed, "batch", F.col("provider")),
    ]
    both = rows[0]
    for r in rows[1:]:
        both = both.unionByName(r, allowMissingColumns=True)
    flags = [n for kind in tests.values() for n in kind]
    few = both.groupBy("kind", "key").agg(F.sum("n").alias("n"), *[F.sum(f).alias(f) for f in flags])

    def total(kind: str, what: str = "n", key: str | None = None) -> Column:
        there = F.col("kind") == kind
        return F.coalesce(F.sum(F.when(there if key is None else there & (F.col("key") == key), F.col(what))), F.lit(0))

    def entries(kind: str, value: str = "n", kept: Column | None = None, cast: str = "string") -> Column:
        there = (F.col("kind") == kind) & F.col("key").isNotNull() & (F.lit(True) if kept is None else kept)
        pairs = F.collect_list(F.when(there, F.struct(F.col("key").cast(cast), F.col(value))))
        return F.map_from_entries(F.sort_array(pairs))

    n = total("ranked")

    def share(flag: str, kind: str = "ranked") -> Column:
        return S.percent(total(kind, flag), total(kind))

    funding, fallback = total("event", "funding"), F.lit(False) if first_provider is None else F.col("key") != first_provider
    by_region = {r: total("ranked", key=r) for r in C.REGIONS}
    pairs = lambda values: F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])
    return few.agg(
        (generated_at if generated_at is not None else F.lit(None)).cast("timestamp").alias("generated_at"),
        F.lit(C.SCORE_VERSION).alias("score_version"), F.lit(run_status).alias("run_status"),
        n.alias("n_ranked"),
        pairs(by_region).alias("qualified_company_count_by_region"),
        pairs({r: F.greatest(F.lit(0).cast("long"), F.lit(C.TARGET_PER_REGION) - v) for r, v in by_region.items()}).alias("shortfall_by_region"),
        entries("reason").alias("rejected_candidate_count_by_reason"),
        pairs({f: S.percent(n - total("ranked", f"filled_{f}"), n) for f in missing}).alias("missingness_by_field"),
        entries("event", cast="int").alias("source_tier_distribution"),
        (n - total("ranked", "domain")).alias("invalid_homepage_count"),
        total("candidate", "ambiguous").alias("ambiguous_funding_count"),
        total("event", "valuation").alias("valuation_shown_as_funding_count"),
        total("candidate", "stale").alias("stale_record_count"),
        total("copies").alias("duplicate_candidates_detected"),
        pairs({name: total("ranked", f"band_{lo}") for name, lo, _ in C.CONFIDENCE_BANDS}).alias("confidence_distribution"),
        share("confident").alias("pct_ranked_with_confidence_ge_70"),
        share("corroborated").alias("pct_ranked_with_two_sources_or_authoritative"),
        share("located").alias("pct_ranked_with_verified_headquarters"),
        share("funded").alias("pct_ranked_with_verified_funding_dates"),
        share("sized").alias("pct_ranked_with_verified_employee_ranges"),
        share("hiring").alias("pct_ranked_with_verified_hiring_data"),
        share("recent").alias("pct_ranked_with_recent_verified_event"),
        share("located").alias("pct_ranked_with_verified_regional_assignment"),
        share("domain").alias("pct_ranked_with_valid_primary_domain"),
        F.when(funding == 0, 100.0).otherwise(S.percent(total("event", "with_text"), funding)).alias("pct_material_funding_claims_with_evidence"),
        share("failed", "batch").alias("llm_extraction_failure_rate"),
        entries("batch", kept=fallback).alias("provider_fallback_usage"),
    )


def check_thresholds(report: DataFrame, rules: Sequence[tuple[str, str, float]] = tuple(C.QUALITY_RULES)) -> DataFrame:
    """Add ``threshold_failures`` and ``passed_launch_thresholds``."""
    tests = []
    for metric, op, bound in rules:
        value = F.col(metric)
        broken = value < bound if op == "min" else value > bound
        word = "below" if op == "min" else "above"
        tests.append(F.when(broken, F.concat(F.lit(f"{metric} "), value.cast("string"), F.lit(f" {word} {bound}"))))
    out = report.withColumn("threshold_failures", F.array_compact(F.array(*tests)))
    return out.withColumn("passed_launch_thresholds", F.size("threshold_failures") == 0)


def previous_report(report: DataFrame, published: DataFrame) -> DataFrame:
    """Put the two figures the decision compares next to the new report; ``published``
    has the report of the latest published run, or no row (only one of several is used)."""
    old = published.limit(1).select(
        F.col("pct_ranked_with_confidence_ge_70").alias("previous_pct_confidence"), F.col("n_ranked").alias("previous_n_ranked")
    )
    return side_by_side([report, old])


def should_publish(report: DataFrame) -> DataFrame:
    """Add ``publish`` and ``publish_reason``."""
    worse = F.coalesce(
        (F.col("pct_ranked_with_confidence_ge_70") < F.col("previous_pct_confidence") - 10)
        | (F.col("n_ranked") < F.col("previous_n_ranked") * 0.5),
        F.lit(False),
    )
    passed = F.col("passed_launch_thresholds")
    reason = (
        F.when(~passed, F.concat(F.lit("failed launch thresholds: "), F.array_join("threshold_failures", "; ")))
        .when(worse, "quality regressed against the published run")
        .otherwise("passed all launch thresholds")
    )
    return report.withColumn("publish", passed & ~worse).withColumn("publish_reason", reason)
