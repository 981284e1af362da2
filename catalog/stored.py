"""Table maintenance, quality report, read side."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import duck as D
from catalog.events import RECONCILED_SQL
from catalog.news import ARTICLES_SQL, FAILED_SQL, RELEVANT_SQL, STAMP, VALIDATED_SQL, responses, stamp
from catalog.registry import Tables, query
from catalog.scores import SCORED_SQL, WHY, ranked, scored
from upswell import config as C
from upswell import schemas
from upswell.operators import claims as K
from upswell.operators import events as E
from upswell.operators import quality as Q
from upswell.operators import ranking as G
from upswell.operators import reads as V
from upswell.operators import tables as B
from upswell.sources import stored


@query(
    "upsert_by_key", "SNK-1", "companies",
    """SELECT company_id, CASE WHEN key % 3 = 0 THEN 'changed' ELSE description END AS description, CASE WHEN key % 3 = 0 AND key % 2 <> 0 THEN NULL ELSE industry END AS industry
    FROM companies WHERE key % 2 = 0 OR key % 3 = 0""",
)
def upsert_by_key(t: Tables):
    target = t("companies").filter("key % 2 = 0").select("company_id", "description", "industry")
    once = t("companies").filter("key % 3 = 0").select("company_id", F.lit("changed").alias("description"), F.lit(2).alias("seq"))
    stale = once.select("company_id", F.lit("older").alias("description"), F.lit(1).alias("seq"))
    return B.upsert_by_key(target, once.unionByName(stale), ["company_id"], [F.col("seq").desc()]).drop("seq")


@query(
    "upsert_by_key_all", "SNK-1", "companies",
    """SELECT company_id, CASE WHEN key % 5 = 0 OR key % 3 = 0 THEN 'changed' ELSE description END AS description, CASE WHEN key % 5 <> 0 THEN industry END AS industry
    FROM companies""",
)
def upsert_by_key_all(t: Tables):
    """All companies: multiples of 5 are new, other multiples of 3 are merged, the rest stay."""
    target = t("companies").filter("key % 5 <> 0").select("company_id", "description", "industry")
    once = t("companies").filter("key % 5 = 0 OR key % 3 = 0").select("company_id", F.lit("changed").alias("description"), F.lit(2).alias("seq"))
    stale = once.select("company_id", F.lit("older").alias("description"), F.lit(1).alias("seq"))
    return B.upsert_by_key(target, once.unionByName(stale), ["company_id"], [F.col("seq").desc()]).drop("seq")


@query(
    "upsert_events", "SNK-1 SNK-2", "company_events",
    """SELECT company_id, source_url, event_type, arg_max(ingest_ord, (published_at >= TIMESTAMP '1998-01-01', ingest_ord)) AS ingest_ord FROM company_events GROUP BY 1, 2, 3""",
)
def upsert_events(t: Tables):
    keys = ["company_id", "source_url", "event_type"]
    incoming = F.col("published_at") >= F.lit("1998-01-01").cast("timestamp")
    first = E.dedupe_events(t("company_events").filter(~incoming)).select(*keys, "ingest_ord")
    batch = t("company_events").filter(incoming).select(*keys, "ingest_ord")
    return B.upsert_by_key(first, batch, keys, [F.col("ingest_ord").desc()])


@query(
    "snapshot_rows", "SNK-6", "company_events companies",
    SCORED_SQL + """ SELECT company_id, region_bucket, regional_rank, momentum_score, data_confidence, '2001-08-01' AS run_date, traction AS traction_part FROM ranked""",
)
def snapshot_rows(t: Tables):
    rows = B.snapshot_rows(ranked(t), t.now.cast("timestamp"))
    return rows.select(
        "company_id", "region_bucket", "regional_rank", "momentum_score", "data_confidence",
        F.col("run_date").cast("string").alias("run_date"), F.col("component_scores")["traction"].alias("traction_part"),
    )


@query(
    "prune_older_than", "SNK-9", "articles",
    "SELECT item_ord FROM articles WHERE published_ts >= TIMESTAMP '2001-02-01 00:00:00' - INTERVAL 14 DAY",
)
def prune_older_than(t: Tables):
    return B.prune_older_than(t("articles"), "published_ts", F.lit("2001-02-01").cast("timestamp")).select("item_ord")


_BUCKET = "CASE WHEN region ILIKE '%india%' THEN 'INDIA' WHEN region ILIKE '%usa%' THEN 'US' WHEN region IS NOT NULL AND region <> 'Unknown' THEN 'ROW' END"


@query(
    "backfill_companies", "SNK-10", "startups companies",
    rf""", rows AS (SELECT *, lower(regexp_replace(regexp_replace(company_name, '[,.]', ' ', 'g'), '\s+', ' ', 'g')) AS nn,
      CASE WHEN regexp_matches(homepage, '^https?://[^/]+') THEN regexp_replace(regexp_replace(homepage, '^https?://(www\.)?', ''), '/.*$', '') END AS dom FROM startups WHERE company_name IS NOT NULL),
    known AS (SELECT normalized_name, primary_domain FROM companies WHERE key % 3 = 0),
    fresh AS (SELECT * FROM rows r WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.normalized_name = r.nn AND coalesce(k.primary_domain, '') = coalesce(r.dom, ''))
      AND (dom IS NULL OR NOT EXISTS (SELECT 1 FROM known k WHERE k.primary_domain = r.dom)))
    SELECT company_name AS canonical_name, nn AS normalized_name, dom AS primary_domain, {_BUCKET} AS region_bucket, momentum_score FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(dom, chr(0) || nn) ORDER BY ord) AS n FROM fresh) WHERE n = 1""",
)
def backfill_companies(t: Tables):
    rows = B.backfill_companies(t("startups"), t("companies").filter("key % 3 = 0"))
    return rows.select("canonical_name", "normalized_name", "primary_domain", "region_bucket", "momentum_score")


@query(
    "upgrade_legacy", "SNK-11", "startups",
    "SELECT ord, coalesce(industry, sector) AS industry, coalesce(momentum_score, signal_score * 20) AS momentum_score FROM startups",
)
def upgrade_legacy(t: Tables):
    return B.upgrade_legacy(t("startups")).select("ord", "industry", "momentum_score")


PUBLISHED_SQL = SCORED_SQL + f""", published AS (SELECT c.*, r.momentum_score, r.regional_rank, r.why_ranked FROM companies c
    LEFT JOIN (SELECT company_id, momentum_score, regional_rank, {WHY} AS why_ranked FROM ranked) r USING (company_id))"""


def published(t: Tables):
    return B.publish_ranking(t("companies"), ranked(t), publish=True)


@query(
    "publish_ranking", "SNK-12", "company_events companies",
    PUBLISHED_SQL + " SELECT company_id, momentum_score, regional_rank, why_ranked FROM published",
)
def publish_ranking(t: Tables):
    return published(t).select("company_id", "momentum_score", "regional_rank", "why_ranked")


@query(
    "check_constraints", "SNK-13", "company_events",
    f"""SELECT 'event_type not allowed' AS rule, count(*) FILTER (WHERE event_type NOT IN ({D.quoted(C.EVENT_TYPES)})) AS violations FROM company_events
    UNION ALL SELECT 'status not allowed', count(*) FILTER (WHERE verification_status NOT IN ({D.quoted(C.VERIFICATION_STATUSES)})) FROM company_events
    UNION ALL SELECT 'company_id missing', count(*) FILTER (WHERE company_id IS NULL) FROM company_events
    UNION ALL SELECT 'source_url missing', count(*) FILTER (WHERE source_url IS NULL) FROM company_events
    UNION ALL SELECT 'evidence_text missing', count(*) FILTER (WHERE evidence_text IS NULL) FROM company_events
    UNION ALL SELECT 'key not unique', count(*) FROM (SELECT 1 FROM company_events GROUP BY company_id, source_url, event_type HAVING count(*) > 1)""",
)
def check_constraints(t: Tables):
    return B.check_constraints(t("company_events"))


# --- quality -------------------------------------------------------------------


def gated(t: Tables):
    return G.eligibility_gate(scored(t))


@query(
    "rejections_by_reason", "AGG-13", "company_events companies",
    SCORED_SQL + " SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM gated) GROUP BY 1",
)
def rejections_by_reason(t: Tables):
    return Q.rejections_by_reason(gated(t))


_BANDS = " UNION ALL ".join(f"SELECT '{b}' AS band, count(*) FILTER (WHERE data_confidence BETWEEN {lo} AND {hi}) AS n FROM scored" for b, lo, hi in C.CONFIDENCE_BANDS)


@query("confidence_bands", "AGG-14", "company_events companies", SCORED_SQL + " " + _BANDS)
def confidence_bands(t: Tables):
    return Q.confidence_bands(scored(t), C.bands_frame(t.spark))


def _pct(test: str) -> str:
    return f"round_even(100.0::DOUBLE * count(*) FILTER (WHERE {test}) / greatest(count(*), 1), 1)"


PCT_SQL = f"""count(*) AS n_ranked, {_pct('data_confidence >= 70')} AS pct_ranked_with_confidence_ge_70,
    {_pct('independent_sources >= 2 OR best_source_tier = 1')} AS pct_ranked_with_two_sources_or_authoritative, {_pct('region_bucket IS NOT NULL')} AS pct_ranked_with_verified_headquarters,
    {_pct('funding_amount_usd <> 0')} AS pct_ranked_with_verified_funding_dates, {_pct('hiring_momentum > 0')} AS pct_ranked_with_verified_hiring_data,
    {_pct('recent_verified_events > 0')} AS pct_ranked_with_recent_verified_event, {_pct('region_bucket IS NOT NULL')} AS pct_ranked_with_verified_regional_assignment,
    {_pct('primary_domain_verified')} AS pct_ranked_with_valid_primary_domain"""


@query("quality_percentages", "AGG-15", "company_events companies", SCORED_SQL + f" SELECT {PCT_SQL} FROM ranked")
def quality_percentages(t: Tables):
    return Q.quality_percentages(ranked(t))


@query("regional_counts", "AGG-21", "company_events companies", SCORED_SQL + " SELECT region_bucket, count(*) AS n_ranked FROM ranked GROUP BY 1")
def regional_counts(t: Tables):
    return Q.regional_counts(ranked(t))


@query(
    "shortfall_by_region", "AGG-16", "company_events companies",
    SCORED_SQL + """ SELECT region_bucket, coalesce(n, 0) AS n_ranked, greatest(0, 50 - coalesce(n, 0)) AS shortfall
      FROM (SELECT unnest(['US', 'INDIA', 'ROW']) AS region_bucket) LEFT JOIN (SELECT region_bucket, count(*) AS n FROM ranked GROUP BY 1) USING (region_bucket)""",
)
def shortfall_by_region(t: Tables):
    return Q.shortfall_by_region(ranked(t), C.regions_frame(t.spark))


_FIELDS = ["primary_domain", "description", "founders", "region_bucket", "investors", "founded_year"]


@query(
    "missingness_by_field", "AGG-17", "companies",
    " UNION ALL ".join(f"SELECT '{f}' AS field, {_pct('NOT ' + D.populated(f))} AS pct_missing FROM companies" for f in _FIELDS),
)
def missingness_by_field(t: Tables):
    return Q.missingness_by_field(t("companies"), _FIELDS)


@query("source_tier_distribution", "AGG-18", "company_events", "SELECT source_tier, count(*) AS n FROM company_events GROUP BY 1")
def source_tier_distribution(t: Tables):
    return Q.source_tier_distribution(t("company_events"))


@query(
    "candidate_counts", "AGG-20", "company_events companies",
    SCORED_SQL + """ SELECT count(*) FILTER (WHERE funding_amount_usd <> 0 AND funding_stage IS NULL) AS ambiguous_funding_count,
      count(*) FILTER (WHERE days_since_verified > 90) AS stale_record_count FROM scored""",
)
def candidate_counts(t: Tables):
    return Q.candidate_counts(scored(t))


@query(
    "evidence_checks", "AGG-20 QLT-2", "evidence",
    RECONCILED_SQL + """ SELECT round_even(100.0::DOUBLE * count(*) FILTER (WHERE event_type IN ('funding_round_completed', 'funding_round_announced') AND trim(evidence_text) <> '')
        / count(*) FILTER (WHERE event_type IN ('funding_round_completed', 'funding_round_announced')), 1) AS pct_material_funding_claims_with_evidence,
      count(*) FILTER (WHERE event_type IN ('funding_round_completed', 'funding_round_announced') AND amount_usd IS NOT NULL AND statement_class = 'valuation') AS valuation_shown_as_funding_count FROM reconciled""",
)
def evidence_checks(t: Tables):
    rows = E.convert_currency(E.extract_amounts(t("evidence")), C.rates_frame(t.spark))
    return Q.evidence_checks(E.reconcile_funding_claims(E.classify_funding_text(rows)))


@query(
    "run_counters", "AGG-22", "company_events companies claims numbered articles",
    VALIDATED_SQL + ARTICLES_SQL + SCORED_SQL + """ SELECT (SELECT count(*) FROM firsts) AS articles_fetched, (SELECT count(*) FILTER (WHERE len(errors) = 0) FROM checked) AS candidates_extracted,
      (SELECT count(*) FILTER (WHERE len(errors) > 0) FROM checked) AS validation_failures, (SELECT count(*) FILTER (WHERE len(reasons) = 0) FROM gated) AS companies_accepted,
      (SELECT count(*) FILTER (WHERE len(reasons) > 0) FROM gated) AS companies_rejected""",
)
def run_counters(t: Tables):
    from upswell.sources.feeds import dedupe_links

    return Q.run_counters(dedupe_links(t("articles")), K.validate_claims(K.attach_sources(t("claims"), t("numbered"))), gated(t))


def report(t: Tables):
    """The report of a run over the derived tables; materialised gate rows feed all its parts."""
    from upswell.session import materialise

    gate = materialise(gated(t))
    top = materialise(G.rank_regions(gate.filter("eligible")))
    events = t("company_events").withColumn("statement_class", F.lit("completed"))
    return Q.build_quality_report(gate, top, events, K.parse_responses(responses(t)))


REPORT_SQL = SCORED_SQL + f""", rep AS (SELECT *, (SELECT round_even(100.0::DOUBLE * count(*) FILTER (WHERE {FAILED_SQL}) / count(*), 1) FROM (SELECT DISTINCT batch_id FROM response_parts)) AS failure_rate,
      (SELECT count(*) FILTER (WHERE len(reasons) > 0) FROM gated) AS n_rejected, 100.0::DOUBLE AS pct_evidence, 0 AS invalid_homepage_count FROM (SELECT {PCT_SQL} FROM ranked))"""
_CHECKS = [
    ("pct_ranked_with_verified_regional_assignment", "<", 100.0), ("pct_ranked_with_valid_primary_domain", "<", 100.0),
    ("pct_ranked_with_confidence_ge_70", "<", 80.0), ("pct_ranked_with_recent_verified_event", "<", 70.0),
    ("pct_ranked_with_two_sources_or_authoritative", "<", 60.0),
]
_FAILURES = "list_filter([" + ", ".join(
    f"CASE WHEN {m} {op} {b} THEN '{m} ' || CAST({m} AS VARCHAR) || ' below {b}' END" for m, op, b in _CHECKS
) + "], lambda x: x IS NOT NULL)"


@query(
    "build_quality_report", "QLT-2", "company_events companies response_parts",
    REPORT_SQL + """ SELECT n_ranked, pct_ranked_with_confidence_ge_70, pct_ranked_with_recent_verified_event, failure_rate AS llm_extraction_failure_rate,
      (SELECT count(*) FROM ranked WHERE region_bucket = 'US') AS ranked_us, (SELECT count(*) FROM gated WHERE list_contains(reasons, 'industry not supported')) AS rejected_industry,
      (SELECT count(*) FROM ranked WHERE data_confidence >= 80) AS band_80, (SELECT count(*) FROM company_events WHERE source_tier = 1) AS tier_1 FROM rep""",
)
def build_quality_report(t: Tables):
    r = report(t)
    at = lambda m, k: F.coalesce(F.try_element_at(m, F.lit(k)), F.lit(0))
    return r.select(
        "n_ranked", "pct_ranked_with_confidence_ge_70", "pct_ranked_with_recent_verified_event", "llm_extraction_failure_rate",
        at("qualified_company_count_by_region", "US").alias("ranked_us"),
        at("rejected_candidate_count_by_reason", "industry not supported").alias("rejected_industry"),
        at("confidence_distribution", "80-100").alias("band_80"), at("source_tier_distribution", 1).alias("tier_1"),
    )


@query(
    "check_thresholds", "QLT-1", "company_events companies response_parts",
    REPORT_SQL + f" SELECT len({_FAILURES}) = 0 AS passed_launch_thresholds, array_to_string({_FAILURES}, '; ') AS failures FROM rep",
)
def check_thresholds(t: Tables):
    rows = Q.check_thresholds(report(t))
    return rows.select("passed_launch_thresholds", F.array_join("threshold_failures", "; ").alias("failures"))


def earlier_report(t: Tables):
    """Figures of the latest published run, from the run table."""
    last = stored.latest_run(t("runs"), published_only=True)
    return last.select(
        (F.col("articles_fetched") % 100).cast("double").alias("pct_ranked_with_confidence_ge_70"),
        (F.col("articles_fetched") % 400).alias("n_ranked"),
    )


LATEST_SQL = """, latest AS (SELECT * FROM runs WHERE run_status IN ('success', 'success_with_warnings') AND published ORDER BY started_at DESC, run_id DESC LIMIT 1)"""


@query(
    "should_publish", "QLT-3 JOIN-12", "company_events companies response_parts runs",
    REPORT_SQL + LATEST_SQL + f""", gate AS (SELECT *, articles_fetched % 100 AS prev_pct, articles_fetched % 400 AS prev_n FROM rep, latest)
      SELECT len({_FAILURES}) = 0 AND NOT worse AS publish, CASE WHEN len({_FAILURES}) > 0 THEN 'failed launch thresholds: ' || array_to_string({_FAILURES}, '; ')
        WHEN worse THEN 'quality regressed against the published run' ELSE 'passed all launch thresholds' END AS publish_reason
      FROM (SELECT *, pct_ranked_with_confidence_ge_70 < prev_pct - 10 OR n_ranked < prev_n * 0.5 AS worse FROM gate)""",
)
def should_publish(t: Tables):
    rows = Q.should_publish(Q.previous_report(Q.check_thresholds(report(t)), earlier_report(t)))
    return rows.select("publish", "publish_reason")


# --- reads --------------------------------------------------------------------------


@query(
    "latest_run", "SRC-8", "runs",
    LATEST_SQL + " SELECT run_id, run_status, articles_fetched FROM latest",
)
def latest_run(t: Tables):
    return stored.latest_run(t("runs"), published_only=True).select("run_id", "run_status", "articles_fetched")


@query(
    "published_rankings", "FLT-11", "company_events companies",
    PUBLISHED_SQL + " SELECT company_id, region_bucket, regional_rank, industry, momentum_score FROM published WHERE active AND region_bucket IS NOT NULL AND regional_rank IS NOT NULL",
)
def published_rankings(t: Tables):
    return V.published_rankings(published(t)).select("company_id", "region_bucket", "regional_rank", "industry", "momentum_score")


_STORED = {
    "company_id", "canonical_name", "normalized_name", "primary_domain", "homepage", "homepage_confidence", "description", "industry", "company_status", "founded_year", "headquarters_country",
    "region_bucket", "founders", "moat_confidence", "hiring_status", "hiring_confidence", "momentum_score", "regional_rank", "why_ranked", "active",
}
_WIDE = [c.split()[0] for c in schemas.RANKING.split(",")]
_CLOCKS = {"last_seen", "last_verified"}


@query(
    "published_rankings_wide", "FLT-11", "company_events companies",
    PUBLISHED_SQL + " SELECT " + ", ".join(
        c if c in _STORED else f"CAST({c} AS VARCHAR) AS {c}" if c in _CLOCKS else f"'v2' AS {c}" if c == "score_version" else f"NULL AS {c}" for c in _WIDE
    ) + " FROM published WHERE active AND region_bucket IS NOT NULL AND regional_rank IS NOT NULL",
)
def published_rankings_wide(t: Tables):
    """All promised columns, those this table lacks as nulls."""
    rows = V.published_rankings(published(t))
    clock = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return rows.select(*[clock(c) if c in _CLOCKS else F.col(c) for c in _WIDE])


_RULES = [(i, m, op, b) for i, (m, op, b) in enumerate(C.QUALITY_RULES)]
_METRIC = {m: f"CASE WHEN n % {len(_RULES) + 1} = {i} THEN {b} {'-' if op == 'min' else '+'} 1.5::DOUBLE ELSE {b}::DOUBLE END" for i, m, op, b in _RULES}
_RULE_TEXTS = ", ".join(
    f"CASE WHEN {m} {'<' if op == 'min' else '>'} {b} THEN '{m} ' || CAST({m} AS VARCHAR) || ' {'below' if op == 'min' else 'above'} {b}' END" for _, m, op, b in _RULES
)


@query(
    "check_thresholds_each", "QLT-1", "runs",
    f""", reports AS (SELECT run_id, articles_fetched AS n FROM runs), metrics AS (SELECT run_id, {', '.join(f'{x} AS {m}' for m, x in _METRIC.items())} FROM reports)
    SELECT run_id, len(list_filter([{_RULE_TEXTS}], lambda x: x IS NOT NULL)) = 0 AS passed_launch_thresholds, array_to_string(list_filter([{_RULE_TEXTS}], lambda x: x IS NOT NULL), '; ') AS failures FROM metrics""",
)
def check_thresholds_each(t: Tables):
    """A report per run, whose article count says which of the rules it breaks, if any."""
    n = F.col("articles_fetched") % (len(_RULES) + 1)
    metrics = [F.when(n == i, b + (-1.5 if op == "min" else 1.5)).otherwise(float(b)).alias(m) for i, m, op, b in _RULES]
    rows = Q.check_thresholds(t("runs").select("run_id", *metrics))
    return rows.select("run_id", "passed_launch_thresholds", F.array_join("threshold_failures", "; ").alias("failures"))


@query(
    "top_companies", "TOP-5", "startups",
    """SELECT company_name, coalesce(momentum_score, signal_score * 20) AS momentum_score FROM startups
    ORDER BY coalesce(momentum_score, signal_score * 20) DESC NULLS LAST, ord % 1000 DESC, last_updated DESC, company_name LIMIT 100""",
)
def top_companies(t: Tables):
    rows = B.upgrade_legacy(t("startups")).withColumn("funding_amount_usd", F.col("ord") % 1000)
    return V.top_companies(rows).select("company_name", "momentum_score")


@query(
    "news_sidebar", "TOP-6", "articles",
    ARTICLES_SQL + f" SELECT link, {STAMP} FROM firsts WHERE {RELEVANT_SQL} ORDER BY firsts.published_ts DESC NULLS LAST, link LIMIT 20",
)
def news_sidebar(t: Tables):
    from upswell.sources.feeds import dedupe_links, filter_relevant_news

    return V.news_sidebar(filter_relevant_news(dedupe_links(t("articles")))).select("link", stamp("published_ts"))


@query(
    "filter_companies", "RD-1", "companies",
    """SELECT company_id FROM companies WHERE region_bucket = 'US' AND hiring_status = 'actively_hiring' AND list_contains(string_split(lower(investors), ', '), 'beta ventures') AND description ILIKE '%tools%'""",
)
def filter_companies(t: Tables):
    rows = V.filter_companies(t("companies"), region="US", hiring="actively_hiring", investor="Beta Ventures", text="TOOLS")
    return rows.select("company_id")


@query("sort_companies", "RD-2", "companies", "SELECT company_id, moat_confidence FROM companies ORDER BY moat_confidence DESC NULLS LAST, company_id")
def sort_companies(t: Tables):
    return V.sort_companies(t("companies"), "moat_confidence", asc=False).select("company_id", "moat_confidence")


@query(
    "scan_freshness", "RD-3", "runs",
    "SELECT CAST(max(finished_at)::DATE AS VARCHAR) AS last_run, CAST(date_diff('day', max(finished_at)::DATE, DATE '2024-02-20') AS INT) AS days_since_run, date_diff('day', max(finished_at)::DATE, DATE '2024-02-20') > 10 AS is_old FROM runs",
)
def scan_freshness(t: Tables):
    rows = V.scan_freshness(t("runs"), F.to_date(F.lit("2024-02-20")))
    return rows.withColumn("last_run", F.col("last_run").cast("string"))


@query(
    "recent_quality_reports", "RD-4", "runs",
    "SELECT run_id, quality_report FROM runs WHERE quality_report IS NOT NULL ORDER BY started_at DESC, run_id DESC LIMIT 5",
)
def recent_quality_reports(t: Tables):
    return V.recent_quality_reports(t("runs")).select("run_id", "quality_report")


@query(
    "event_drawer", "RD-5", "company_events",
    "SELECT ingest_ord, event_type, verification_status FROM company_events WHERE company_id = '7'",
)
def event_drawer(t: Tables):
    return V.event_drawer(t("company_events"), "7").select("ingest_ord", "event_type", "verification_status")


_LOOSE = [("pct_ranked_with_verified_regional_assignment", "min", 100.0), ("pct_ranked_with_confidence_ge_70", "min", 1.0)]
LOOP_SQL = SCORED_SQL + f""", runs3 AS (SELECT 'run-1' AS run_id, [{D.quoted(C.REGIONS)}] AS regs UNION ALL SELECT 'run-2', ['US'] UNION ALL SELECT 'run-3', [{D.quoted(C.REGIONS)}]),
  top3 AS (SELECT run_id, count(region_bucket) AS n_ranked, count(*) FILTER (WHERE region_bucket = 'US') AS ranked_us, greatest(0, 50 - count(*) FILTER (WHERE region_bucket = 'INDIA')) AS short_india,
      round_even(100.0::DOUBLE * count(*) FILTER (WHERE data_confidence >= 70) / greatest(count(region_bucket), 1), 1) AS pct_conf, count(*) FILTER (WHERE data_confidence >= 80) AS band_80,
      round_even(100.0::DOUBLE * count(*) FILTER (WHERE region_bucket IS NOT NULL AND NOT {D.populated('founders')}) / greatest(count(region_bucket), 1), 1) AS missing_founders
    FROM runs3 LEFT JOIN ranked ON list_contains(regs, region_bucket) GROUP BY 1),
  all3 AS (SELECT run_id, count(*) FILTER (WHERE len(reasons) = 0) AS accepted, count(*) FILTER (WHERE len(reasons) > 0) AS rejected, count(*) FILTER (WHERE days_since_verified > 90) AS stale,
      count(*) FILTER (WHERE list_contains(reasons, 'industry not supported')) AS off_industry FROM runs3 JOIN gated ON list_contains(regs, region_bucket) GROUP BY 1),
  rate AS (SELECT round_even(100.0::DOUBLE * count(*) FILTER (WHERE {FAILED_SQL}) / count(*), 1) AS failure_rate FROM (SELECT DISTINCT batch_id FROM response_parts)),
  both3 AS (SELECT *, n_ranked > 0 AND pct_conf >= 1 AS passed FROM top3 JOIN all3 USING (run_id), rate),
  first AS (SELECT *, passed AS published FROM both3 WHERE run_id = 'run-1'),
  second AS (SELECT b.*, b.passed AND NOT (first.published AND (b.pct_conf < first.pct_conf - 10 OR b.n_ranked < first.n_ranked * 0.5)) AS published FROM both3 b, first WHERE b.run_id = 'run-2'),
  before AS (SELECT * FROM (SELECT * FROM second UNION ALL SELECT * FROM first) WHERE published ORDER BY run_id DESC LIMIT 1),
  third AS (SELECT b.*, b.passed AND NOT coalesce(b.pct_conf < before.pct_conf - 10 OR b.n_ranked < before.n_ranked * 0.5, false) AS published FROM both3 b LEFT JOIN before ON true WHERE b.run_id = 'run-3')"""


@query(
    "run_report_loop", "JOIN-12 SNK-7 QLT-2 QLT-3 RD-4 AGG-17", "company_events companies response_parts",
    LOOP_SQL + """ SELECT run_id, CASE WHEN published THEN 'success' ELSE 'success_with_warnings' END AS run_status, published, accepted AS companies_accepted, rejected AS companies_rejected, n_ranked, ranked_us,
      short_india, pct_conf, band_80, missing_founders, stale, off_industry, failure_rate, passed FROM (SELECT * FROM first UNION ALL SELECT * FROM second UNION ALL SELECT * FROM third)
    UNION ALL SELECT 'run-4', 'failed', false, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
    UNION ALL SELECT 'run-5', 'running', false, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
)
def run_report_loop(t: Tables):
    """Runs over one root, each judged by what the published ones before it stored: a whole one, one that reached the US
    feeds only, a whole one again, one that fails and one still open."""
    from upswell.plans.runs import judge_run, within_run
    from upswell.session import materialise, shared_folder

    gate = materialise(gated(t))
    events = t("company_events").withColumn("statement_class", F.lit("completed"))
    parsed = materialise(K.parse_responses(responses(t)))
    root = f"{shared_folder(t.spark)}/report-loop-{uuid.uuid4().hex}"
    for day, (run_id, regions) in enumerate([("run-1", C.REGIONS), ("run-2", ["US"]), ("run-3", C.REGIONS)]):
        clock = F.date_add(t.now, day).cast("timestamp")
        part = gate.filter(F.col("region_bucket").isin(regions))
        counters = part.agg(F.count_if("eligible").alias("companies_accepted"), F.count_if(~F.col("eligible")).alias("companies_rejected"))

        def work(runs):
            judged = judge_run(part, G.rank_regions(part.filter("eligible")), events, parsed, counters, runs, run_id, clock, clock, _LOOSE)
            B.append_run_state(judged.run, root)

        within_run(t.spark, root, run_id, clock, clock, work)

    def broken(runs):
        raise RuntimeError("every extraction batch failed")

    late = F.date_add(t.now, 3).cast("timestamp")
    try:
        within_run(t.spark, root, "run-4", late, late, broken)
    except RuntimeError:
        pass
    B.append_run_state(B.open_run(t.spark, "run-5", late), root)
    r = F.col("quality_report")
    count = lambda m, k: F.when(r.isNotNull(), F.coalesce(F.try_element_at(r[m], F.lit(k)), F.lit(0))).cast("long")
    return B.read_runs(t.spark, root).select(
        "run_id", "run_status", "published", "companies_accepted", "companies_rejected", r["n_ranked"].alias("n_ranked"),
        count("qualified_company_count_by_region", "US").alias("ranked_us"), count("shortfall_by_region", "INDIA").alias("short_india"),
        r["pct_ranked_with_confidence_ge_70"].alias("pct_conf"), count("confidence_distribution", "80-100").alias("band_80"),
        r["missingness_by_field"]["founders"].alias("missing_founders"), r["stale_record_count"].alias("stale"),
        count("rejected_candidate_count_by_reason", "industry not supported").alias("off_industry"),
        r["llm_extraction_failure_rate"].alias("failure_rate"), r["passed_launch_thresholds"].alias("passed"),
    )
