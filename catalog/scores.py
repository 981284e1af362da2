"""Scores, eligibility, ranking, history."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck as D
from catalog.events import indep_sql
from catalog.registry import Tables, query
from upswell import config as C
from upswell.operators import ranking as G
from upswell.operators import scoring as P
from upswell.plans.ranking import score_companies as score

ROLLUP_SQL = f""", rollup AS (SELECT company_id, {D.decayed('recent_verified_events')} AS recent_verified_events, {D.decayed('traction')} AS traction,
    {D.decayed('market_expansion')} AS market_expansion, max(published_at)::DATE AS last_event_date,
    CAST(date_diff('day', max(published_at)::DATE, {D.NOW}) AS INT) AS days_since_event, min(source_tier) AS best_source_tier,
    avg(extraction_confidence) AS extraction_confidence FROM company_events GROUP BY company_id)"""


def _component(name: str, ids: str, fn):
    @query(name, ids, "company_events", ROLLUP_SQL + f" SELECT company_id, {name.replace('_score', '').replace('recent_events', 'recent_verified_events')} AS score FROM rollup")
    def run(t: Tables):
        rows = fn(t("company_events"), t.now)
        return rows.toDF("company_id", "score")

    return run


_component("recent_events_score", "AGG-4", P.recent_events_score)
_component("traction_score", "AGG-5", P.traction_score)
_component("market_expansion_score", "AGG-6", P.market_expansion_score)

_ALL = D.quoted(t for t, _, _ in C.EVENT_VALUES)
_age = f"greatest(0, coalesce(date_diff('day', published_at::DATE, {D.NOW}), 9999))"


@query(
    "decayed_event_score", "AGG-3", "company_events",
    f"""SELECT company_id, {D.clamp(f"coalesce(sum(CASE WHEN verification_status = 'completed' AND event_type IN ({_ALL}) THEN {D.event_base()} * exp(-{_age} / 90.0) END), 0.0)")} AS score
    FROM company_events GROUP BY 1""",
)
def decayed_event_score(t: Tables):
    return P.decayed_event_score(t("company_events"), [e for e, _, _ in C.EVENT_VALUES], t.now, half_life=90.0)


@query(
    "event_rollup", "AGG-3 AGG-4 AGG-5 AGG-6 AGG-9 AGG-12", "company_events",
    ROLLUP_SQL + """ SELECT * REPLACE (CAST(last_event_date AS VARCHAR) AS last_event_date, round(extraction_confidence, 6) AS extraction_confidence) FROM rollup""",
)
def event_rollup(t: Tables):
    rows = P.event_rollup(t("company_events"), t.now)
    return rows.withColumns(
        {"last_event_date": F.col("last_event_date").cast("string"), "extraction_confidence": F.round("extraction_confidence", 6)}
    )


@query("best_source_tier", "AGG-9", "company_events", ROLLUP_SQL + " SELECT company_id, best_source_tier FROM rollup")
def best_source_tier(t: Tables):
    return P.best_source_tier(t("company_events"))


@query(
    "days_since_last_event", "AGG-12", "company_events",
    ROLLUP_SQL + " SELECT company_id, CAST(last_event_date AS VARCHAR) AS last_event_date, days_since_event FROM rollup",
)
def days_since_last_event(t: Tables):
    rows = P.days_since_last_event(t("company_events"), t.now)
    return rows.withColumn("last_event_date", F.col("last_event_date").cast("string"))


FUNDING_SQL = """, rounds AS (SELECT company_id, funding_stage, amount_usd, max(published_at) AS published_at FROM company_events
      WHERE event_type = 'funding_round_completed' AND verification_status = 'completed' AND amount_usd <> 0 GROUP BY 1, 2, 3),
  funding AS (SELECT company_id, arg_max(funding_stage, (published_at, amount_usd, funding_stage)) AS funding_stage, arg_max(amount_usd, (published_at, amount_usd, funding_stage)) AS funding_amount_usd,
      max(published_at)::DATE AS latest_funding_date, nullif(CAST(sum(CAST(amount_usd AS DECIMAL(28,2))) AS DOUBLE), 0) AS total_disclosed_funding_usd FROM rounds GROUP BY 1)"""


@query(
    "funding_rollup", "AGG-7", "company_events",
    FUNDING_SQL + """ SELECT company_id, funding_stage AS latest_funding_stage, funding_amount_usd AS latest_funding_amount_usd,
      CAST(latest_funding_date AS VARCHAR) AS latest_funding_date, total_disclosed_funding_usd FROM funding""",
)
def funding_rollup(t: Tables):
    rows = P.funding_rollup(t("company_events"))
    return rows.withColumn("latest_funding_date", F.col("latest_funding_date").cast("string"))


PEERS_SQL = FUNDING_SQL + """, cohort AS (SELECT c.company_id, c.region_bucket, f.funding_stage, f.funding_amount_usd FROM companies c LEFT JOIN funding f USING (company_id)),
  counted AS (SELECT *, count(*) OVER (PARTITION BY funding_stage, coalesce(region_bucket, '')) AS n_all,
      count(*) OVER (PARTITION BY funding_stage, coalesce(region_bucket, ''), funding_amount_usd) AS n_eq,
      count(*) OVER (PARTITION BY funding_stage, coalesce(region_bucket, '') ORDER BY funding_amount_usd RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_le
    FROM cohort WHERE funding_amount_usd > 0),
  peers AS (SELECT company_id, CAST(n_all - n_eq AS INT) AS n_peers, CASE WHEN n_all - n_eq >= 5 THEN CAST(round_even(100.0::DOUBLE * (n_le - n_eq) / (n_all - n_eq), 0) AS INT) END AS peer_percentile,
      CASE WHEN n_all >= 5 THEN CAST(round_even(100.0::DOUBLE * n_le / n_all, 0) AS INT) END AS inclusive_percentile FROM counted)"""


def cohorts(t: Tables):
    rounds = P.funding_rollup(t("company_events")).select(
        "company_id", F.col("latest_funding_stage").alias("funding_stage"),
        F.col("latest_funding_amount_usd").alias("funding_amount_usd"),
    )
    return t("companies").select("company_id", "region_bucket").join(rounds, "company_id", "left")


@query(
    "peer_percentile", "WIN-2 JOIN-10", "company_events companies",
    PEERS_SQL + " SELECT company_id, n_peers, peer_percentile FROM cohort LEFT JOIN peers USING (company_id)",
)
def peer_percentile(t: Tables):
    return P.peer_percentile(cohorts(t)).select("company_id", "n_peers", "peer_percentile")


@query(
    "inclusive_percentile", "WIN-2", "company_events companies",
    PEERS_SQL + " SELECT company_id, inclusive_percentile AS peer_percentile FROM cohort LEFT JOIN peers USING (company_id)",
)
def inclusive_percentile(t: Tables):
    return P.peer_percentile(cohorts(t), exclude_equal=False).select("company_id", "peer_percentile")


_steps = " ".join(
    f"WHEN '{s}' THEN CASE " + " ".join(f"WHEN funding_amount_usd >= {lo} THEN {p}" for lo, p in reversed(steps)) + " ELSE 10 END"
    for s, steps in C.STAGE_THRESHOLDS.items()
)
FALLBACK = f"CASE WHEN coalesce(funding_amount_usd, 0) <= 0 THEN 0 ELSE CASE funding_stage {_steps} ELSE 0 END END"


@query(
    "stage_fallback_score", "SCR-1", "company_events companies",
    FUNDING_SQL + f" SELECT c.company_id, {FALLBACK} AS fallback_score FROM companies c LEFT JOIN funding f USING (company_id)",
)
def stage_fallback_score(t: Tables):
    return P.stage_fallback_score(cohorts(t), C.stage_thresholds_frame(t.spark)).select("company_id", "fallback_score")


STAGE_SQL = PEERS_SQL + f""", adjusted AS (SELECT company_id, funding_stage, funding_amount_usd,
    CASE WHEN coalesce(funding_amount_usd, 0) <= 0 OR funding_stage IS NULL OR funding_stage = 'unknown' THEN 0 ELSE coalesce(peer_percentile, {FALLBACK}) END AS stage_adjusted_funding
    FROM cohort LEFT JOIN peers USING (company_id))"""


@query(
    "stage_adjusted_funding", "SCR-2", "company_events companies",
    STAGE_SQL + " SELECT company_id, stage_adjusted_funding FROM adjusted",
)
def stage_adjusted_funding(t: Tables):
    return P.stage_adjusted_funding(cohorts(t), C.stage_thresholds_frame(t.spark)).select("company_id", "stage_adjusted_funding")


HIRING = D.clamp(f"{D.case_map('hiring_status', C.HIRING_BASE.items(), '0')} * (coalesce(hiring_confidence, 0) / 100.0::DOUBLE)")
CORRO = "CASE WHEN coalesce(independent_sources, 0) <= 0 THEN 0 WHEN independent_sources = 1 THEN 40 WHEN independent_sources = 2 THEN 80 ELSE 100 END"


@query("hiring_momentum", "SCR-3", "companies", f"SELECT company_id, {HIRING} AS hiring_momentum FROM companies")
def hiring_momentum(t: Tables):
    return P.hiring_momentum(t("companies")).select("company_id", "hiring_momentum")


@query("moat_component", "SCR-4", "companies", "SELECT company_id, moat_confidence AS moat_differentiation FROM companies")
def moat_component(t: Tables):
    return P.moat_component(t("companies")).select("company_id", "moat_differentiation")


@query(
    "corroboration_component", "SCR-5", "company_events",
    indep_sql("company_events") + f" SELECT company_id, {CORRO} AS source_corroboration FROM indep",
)
def corroboration_component(t: Tables):
    from upswell.operators.events import event_sources
    from upswell.operators.independence import independent_sources

    rows = independent_sources(event_sources(t("company_events")))
    return P.corroboration_component(rows).select("company_id", "source_corroboration")


_filled = " + ".join(f"CAST({D.populated(f)} AS INT)" for f in C.COMPLETENESS_FIELDS)
COMPLETE = f"CAST(round_even(100.0::DOUBLE * ({_filled}) / {len(C.COMPLETENESS_FIELDS)}, 0) AS INT)"


@query("completeness", "AGG-11", "companies", f"SELECT company_id, {COMPLETE} AS data_completeness FROM companies")
def completeness(t: Tables):
    return P.completeness(t("companies")).select("company_id", "data_completeness")


_w = C.CONFIDENCE_WEIGHTS
_CONFIDENCE_SUM = (
    f"""(CASE best_source_tier WHEN 1 THEN 100.0::DOUBLE WHEN 2 THEN 65.0 WHEN 3 THEN 30.0 ELSE 0.0 END) * {_w['source_tier']}::DOUBLE
    + (CASE WHEN coalesce(independent_sources, 0) <= 0 THEN 0.0::DOUBLE WHEN independent_sources = 1 THEN 50.0 WHEN independent_sources = 2 THEN 80.0 ELSE 100.0 END) * {_w['corroboration']}::DOUBLE
    + (CASE WHEN days_since_verified IS NULL THEN 0.0::DOUBLE WHEN days_since_verified <= 30 THEN 100.0 WHEN days_since_verified >= 90 THEN 0.0
        ELSE 100.0::DOUBLE * (1 - (days_since_verified - 30) / 60.0::DOUBLE) END) * {_w['freshness']}::DOUBLE
    + data_completeness::DOUBLE * {_w['completeness']}::DOUBLE + coalesce(homepage_confidence::DOUBLE, 0.0) * {_w['resolution_confidence']}::DOUBLE
    + coalesce(extraction_confidence, 0.0) * {_w['extraction_confidence']}::DOUBLE"""
)
CONFIDENCE = D.clamp(_CONFIDENCE_SUM)
VERIFIED = "coalesce(primary_domain, '') <> '' AND coalesce(homepage_confidence, 0) >= 50"
_terms = " + ".join(f"{c} * {w}::DOUBLE" for c, w in C.WEIGHTS.items())
_REASONS = f"""list_filter([
    CASE WHEN region_bucket IS NULL OR region_bucket NOT IN ({D.quoted(C.REGIONS)}) THEN 'region not supported' END,
    CASE WHEN NOT primary_domain_verified THEN 'primary domain not verified' END,
    CASE WHEN industry IS NULL OR industry NOT IN ({D.quoted(C.SUPPORTED_INDUSTRIES)}) THEN 'industry not supported' END,
    CASE WHEN coalesce(days_since_event, 100000) > 180 THEN 'no recent qualifying event' END,
    CASE WHEN coalesce(data_confidence, 0) < 60 THEN 'data confidence too low' END,
    CASE WHEN coalesce(best_source_tier, 9) <> 1 AND coalesce(independent_sources, 0) < 1 THEN 'only weak sources' END,
    CASE WHEN company_status IN ({D.quoted(C.INELIGIBLE_STATUSES)}) THEN 'company status not rankable' END,
    CASE WHEN entity_resolution_needs_review THEN 'identity needs review' END,
    CASE WHEN days_since_verified > 90 THEN 'verification too old' END], lambda x: x IS NOT NULL)"""
SCORED_SQL = (
    ROLLUP_SQL + STAGE_SQL + indep_sql("company_events")
    + f""", joined AS (SELECT c.*, coalesce(recent_verified_events, 0) AS recent_verified_events, coalesce(traction, 0) AS traction, coalesce(market_expansion, 0) AS market_expansion,
      last_event_date, days_since_event, best_source_tier, extraction_confidence, coalesce(independent_sources, 0) AS independent_sources,
      funding_stage, funding_amount_usd, stage_adjusted_funding, {COMPLETE} AS data_completeness
    FROM companies c LEFT JOIN rollup USING (company_id) LEFT JOIN adjusted USING (company_id) LEFT JOIN indep USING (company_id)),
  scored AS (SELECT *, {HIRING} AS hiring_momentum, moat_confidence AS moat_differentiation, {CORRO} AS source_corroboration,
      {CONFIDENCE} AS data_confidence, {VERIFIED} AS primary_domain_verified FROM joined),
  gated AS (SELECT *, {_REASONS} AS reasons FROM scored),
  ranked AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY region_bucket ORDER BY momentum_score DESC, data_confidence DESC, last_event_date DESC NULLS LAST,
      independent_sources DESC, lower(trim(canonical_name)), company_id) AS INT) AS regional_rank
    FROM (SELECT *, {D.clamp(_terms)} AS momentum_score FROM gated WHERE len(reasons) = 0)) WHERE regional_rank <= 50)"""
)


@query(
    "data_confidence", "SCR-6", "company_events companies",
    SCORED_SQL + " SELECT company_id, data_confidence FROM scored",
)
def data_confidence(t: Tables):
    return scored(t).select("company_id", "data_confidence")


@query(
    "contradicted_confidence", "SCR-6", "company_events companies",
    SCORED_SQL + f""", said AS (SELECT company_id, source_tier, lower(trim(funding_stage)) AS v FROM company_events WHERE {D.populated('funding_stage')} AND source_tier IS NOT NULL),
    contra AS (SELECT company_id, count(DISTINCT v) > 1 AS contradicted FROM said WHERE (company_id, source_tier) IN (SELECT company_id, min(source_tier) FROM said GROUP BY 1) GROUP BY 1),
    judged AS (SELECT *, coalesce(contradicted, false) AS contra FROM scored LEFT JOIN contra USING (company_id))
    SELECT company_id, contra AS contradicted, {D.clamp(f"CASE WHEN contra THEN ({_CONFIDENCE_SUM}) * 0.7::DOUBLE ELSE ({_CONFIDENCE_SUM}) END")} AS data_confidence FROM judged""",
)
def contradicted_confidence(t: Tables):
    """Confidence where the best sources of a company name different funding stages."""
    said = t("company_events").select("company_id", F.lit("latest_funding_stage").alias("field_name"), F.col("funding_stage").alias("field_value"), "source_tier")
    rows = score(t("companies"), t("company_events"), C.stage_thresholds_frame(t.spark), t.now, provenance=said)
    return rows.select("company_id", "contradicted", "data_confidence")


_OWN = {**C.WEIGHTS, "recent_verified_events": 0.30, "traction": 0.15}
_own_terms = " + ".join(f"{c} * {w}::DOUBLE" for c, w in _OWN.items())


@query(
    "momentum_stored_weights", "SRC-9 SCR-7 EXT-4 SET-3", "company_events companies",
    SCORED_SQL + f" SELECT company_id, {D.clamp(_own_terms)} AS momentum_score FROM scored",
)
def momentum_stored_weights(t: Tables):
    """Scores by a stored weight table that lacks two components and has one of an unknown name: read back, completed, checked."""
    from upswell.session import stored as write
    from upswell.sources.stored import weights_with_defaults

    kept = {c: w for c, w in _OWN.items() if c not in ("market_expansion", "source_corroboration")}
    table = write(C.weights_frame(t.spark, {**kept, "unknown_component": 0.5}))
    defaults = C.weights_frame(t.spark)
    weights = G.checked_weights(weights_with_defaults(table, defaults), defaults)
    return G.momentum_score(scored(t), weights).select("company_id", "momentum_score")


def scored(t: Tables, gate: C.EligibilityConfig | None = None):
    return score(t("companies"), t("company_events"), C.stage_thresholds_frame(t.spark), t.now, gate=gate)


@query(
    "score_companies", "PIPE-5 AGG-3 AGG-7 AGG-8 AGG-11 SCR-2 SCR-6", "company_events companies",
    SCORED_SQL + f""" SELECT company_id, {', '.join(C.WEIGHTS)}, data_confidence, data_completeness, independent_sources, best_source_tier, days_since_event,
      funding_stage, funding_amount_usd, primary_domain_verified FROM scored""",
)
def score_companies(t: Tables):
    return scored(t).select(
        "company_id", *C.WEIGHTS, "data_confidence", "data_completeness", "independent_sources", "best_source_tier",
        "days_since_event", "funding_stage", "funding_amount_usd", "primary_domain_verified",
    )


@query("primary_domain_verified", "PRJ-3", "companies", f"SELECT company_id, {VERIFIED} AS primary_domain_verified FROM companies")
def primary_domain_verified(t: Tables):
    return P.primary_domain_verified(t("companies")).select("company_id", "primary_domain_verified")


@query(
    "staleness_flags", "FLT-9", "companies",
    "SELECT company_id, days_since_verified > 30 AS stale_warning, days_since_verified > 90 AS stale_excluded FROM companies",
)
def staleness_flags(t: Tables):
    return P.staleness_flags(t("companies")).select("company_id", "stale_warning", "stale_excluded")


@query(
    "eligibility_gate", "FLT-8", "company_events companies",
    SCORED_SQL + " SELECT company_id, len(reasons) = 0 AS eligible, array_to_string(reasons, '; ') AS reasons FROM gated",
)
def eligibility_gate(t: Tables):
    rows = G.eligibility_gate(scored(t))
    return rows.select("company_id", "eligible", F.array_join("reasons", "; ").alias("reasons"))


@query(
    "momentum_score", "SCR-7 EXT-4", "company_events companies",
    SCORED_SQL + f" SELECT company_id, {D.clamp(_terms)} AS momentum_score FROM scored",
)
def momentum_score(t: Tables):
    weights = G.checked_weights(C.weights_frame(t.spark), C.weights_frame(t.spark))
    return G.momentum_score(scored(t), weights).select("company_id", "momentum_score")


_labels = ", ".join(
    f"{{'k': -{c} * {w}::DOUBLE, 'i': {i}, 'z': {c} = 0, 'l': '{C.COMPONENT_LABELS[c]}'}}" for i, (c, w) in enumerate(C.WEIGHTS.items())
)
WHY = f"""CASE WHEN list_sort([{_labels}])[1].z AND list_sort([{_labels}])[2].z THEN '{C.LIMITED_SIGNAL_TEXT}'
  ELSE 'Ranked mainly on ' || list_sort([{_labels}])[1].l || ' and ' || list_sort([{_labels}])[2].l || '.' END"""


@query("why_ranked", "TOP-4", "company_events companies", SCORED_SQL + f" SELECT company_id, {WHY} AS why_ranked FROM scored")
def why_ranked(t: Tables):
    return G.why_ranked(scored(t)).select("company_id", "why_ranked")


def ranked(t: Tables):
    gate = C.EligibilityConfig()
    return G.rank_regions(G.eligibility_gate(scored(t, gate), gate).filter("eligible"))


@query(
    "rank_regions", "WIN-1", "company_events companies",
    SCORED_SQL + f""" SELECT region_bucket, regional_rank, company_id, canonical_name, momentum_score, data_confidence, independent_sources,
      CAST(last_event_date AS VARCHAR) AS last_event_date, {WHY} AS why_ranked, 'v2' AS score_version FROM ranked""",
)
def rank_regions(t: Tables):
    return ranked(t).select(
        "region_bucket", "regional_rank", "company_id", "canonical_name", "momentum_score", "data_confidence",
        "independent_sources", F.col("last_event_date").cast("string").alias("last_event_date"), "why_ranked", "score_version",
    )


@query(
    "rank_change", "WIN-3", "snapshots",
    """SELECT company_id, CAST(run_ts AS VARCHAR) AS run_ts, regional_rank, lag(regional_rank) OVER (PARTITION BY company_id ORDER BY run_ts) - regional_rank AS rank_change FROM snapshots""",
)
def rank_change(t: Tables):
    rows = G.rank_change(t("snapshots"))
    return rows.select("company_id", F.col("run_ts").cast("string").alias("run_ts"), "regional_rank", "rank_change")


@query(
    "score_trajectory", "WIN-6", "snapshots",
    """SELECT company_id, CAST(row_number() OVER w AS INT) AS run_no, momentum_score, momentum_score - lag(momentum_score) OVER w AS score_change
    FROM snapshots WINDOW w AS (PARTITION BY company_id ORDER BY run_ts)""",
)
def score_trajectory(t: Tables):
    return G.score_trajectory(t("snapshots")).select("company_id", "run_no", "momentum_score", "score_change")


@query(
    "previous_rank", "JOIN-11", "company_events companies snapshots",
    SCORED_SQL + """, old AS (SELECT company_id, arg_max(regional_rank, run_ts) AS previous_regional_rank FROM snapshots WHERE run_ts < DATE '2001-08-01' GROUP BY 1)
    SELECT company_id, regional_rank, previous_regional_rank, previous_regional_rank - regional_rank AS rank_change FROM ranked LEFT JOIN old USING (company_id)""",
)
def previous_rank(t: Tables):
    rows = G.previous_rank(ranked(t), t("snapshots"), t.now)
    return rows.select("company_id", "regional_rank", "previous_regional_rank", "rank_change")


V1_POINTS = f"""SELECT *, CASE WHEN regexp_matches(lower(coalesce(funding_stage, '')), 'pre-seed|preseed|pre seed') THEN 20 WHEN contains(lower(coalesce(funding_stage, '')), 'seed') THEN 40
    WHEN contains(lower(coalesce(funding_stage, '')), 'series a') THEN 60 WHEN contains(lower(coalesce(funding_stage, '')), 'series b') THEN 80
    WHEN regexp_matches(lower(coalesce(funding_stage, '')), 'series [cdef]|growth|late stage') THEN 100 ELSE 0 END AS p1,
    CASE WHEN coalesce(usd, 0) = 0 THEN 0 WHEN usd >= 100000000 THEN 100 WHEN usd >= 20000000 THEN 90 WHEN usd >= 5000000 THEN 70 WHEN usd >= 1000000 THEN 50 ELSE 30 END AS p2,
    CASE WHEN coalesce(investors, '') <> '' THEN 100 ELSE 0 END AS p3, CASE WHEN hiring_status = 'Likely hiring' THEN 100 ELSE 0 END AS p4
  FROM (SELECT *, CASE WHEN regexp_matches(funding_amount, '(?i)\\$\\s*([\\d,]+(?:\\.\\d+)?)\\s*([kmb])\\b') THEN CAST(trunc(CAST(replace(regexp_extract(funding_amount, '(?i)\\$\\s*([\\d,]+(?:\\.\\d+)?)\\s*([kmb])\\b', 1), ',', '') AS DOUBLE)
      * CASE lower(regexp_extract(funding_amount, '(?i)\\$\\s*([\\d,]+(?:\\.\\d+)?)\\s*([kmb])\\b', 2)) WHEN 'k' THEN 1e3 WHEN 'm' THEN 1e6 ELSE 1e9 END) AS BIGINT) END AS usd FROM startups)"""
V1_SQL = f""", points AS ({V1_POINTS})"""
V1_SCORE = D.clamp("0.0::DOUBLE + p1 * 0.35::DOUBLE + p2 * 0.3::DOUBLE + p3 * 0.15::DOUBLE + p4 * 0.2::DOUBLE")


@query("momentum_score_v1", "SCR-8 SRC-9", "startups", V1_SQL + f" SELECT ord, {V1_SCORE} AS momentum_score FROM points")
def momentum_score_v1(t: Tables):
    from upswell.operators.events import extract_amounts_v1
    from upswell.sources.stored import load_weights

    defaults = C.weights_frame(t.spark, C.WEIGHTS_V1)
    weights = {r.component: r.weight for r in load_weights(defaults.filter("false"), defaults).collect()}
    rows = extract_amounts_v1(t("startups").drop("momentum_score"))
    return P.momentum_score_v1(rows, weights).select("ord", "momentum_score")


_f1 = " + ".join(f"CASE WHEN coalesce({f}, '') <> '' THEN 1 ELSE 0 END" for f in C.CONFIDENCE_FIELDS_V1)


@query("data_confidence_v1", "SCR-9", "startups", f"SELECT ord, CAST(round_even(100.0::DOUBLE * ({_f1}) / 8, 0) AS INT) AS data_confidence FROM startups")
def data_confidence_v1(t: Tables):
    return P.data_confidence_v1(t("startups")).select("ord", "data_confidence")


_SHARE = " UNION ALL ".join(
    f"SELECT '{c}' AS component, count(*) FILTER (WHERE event_type IN ({D.quoted(t for t, _, k in C.EVENT_VALUES if k == c)})) * 1.0::DOUBLE / count(*) AS weight FROM company_events"
    for c in ("recent_verified_events", "traction", "market_expansion")
)
_DEFAULTS = "SELECT unnest([" + D.quoted(C.WEIGHTS) + "]) AS component"


@query(
    "weights_diff", "SET-3", "company_events",
    f""", shares AS ({_SHARE} UNION ALL SELECT 'no_component', count(*) FILTER (WHERE event_type IN ('layoffs', 'other')) * 1.0::DOUBLE / count(*) FROM company_events), d AS ({_DEFAULTS})
    SELECT component, 'missing' AS problem FROM d WHERE component NOT IN (SELECT component FROM shares)
    UNION ALL SELECT component, 'unexpected' FROM shares WHERE component NOT IN (SELECT component FROM d)
    UNION ALL SELECT '*', 'sum is not 1' FROM (SELECT sum(weight) AS s FROM shares) WHERE abs(s - 1) > 1e-6""",
)
def weights_diff(t: Tables):
    """Weights taken from how often each component has events, against the stored ones."""
    values = C.event_values_frame(t.spark).select("event_type", "component")
    rows = t("company_events").join(values, "event_type", "left").withColumn("component", F.coalesce("component", F.lit("no_component")))
    counts = rows.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("total")).withColumn("_k", F.lit(1))
    weights = counts.withColumn("_k", F.lit(1)).join(total, "_k").select("component", (F.col("n") / F.col("total")).alias("weight"))
    return G.weights_diff(weights, C.weights_frame(t.spark))
