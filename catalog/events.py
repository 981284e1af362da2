"""Money statements, source tiers, independence, event facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck as D
from catalog.news import GROUP_KEY, VALIDATED_SQL
from catalog.registry import Tables, query
from upswell import config as C
from upswell.functions.urls import registrable_domain
from upswell.operators import claims as K
from upswell.operators import events as E
from upswell.operators import resolve as R
from upswell.operators.common import running_totals
from upswell.operators.independence import independent_sources as count_independent

_AMT = D.amount("evidence_text")
_CUR = f"CASE WHEN {_AMT} IS NOT NULL THEN {D.currency('evidence_text')} END"
MONEY_SQL = f""", money AS (SELECT *, {_AMT} AS amount_original, {_CUR} AS currency FROM evidence),
  dollars AS (SELECT *, {D.rate('currency')} AS per_usd, round_even(amount_original / {D.rate('currency')}, 2) AS amount_usd FROM money)"""


@query("extract_amounts", "AMT-1", "evidence", MONEY_SQL + " SELECT o_orderkey, amount_original, currency FROM money")
def extract_amounts(t: Tables):
    return E.extract_amounts(t("evidence")).select("o_orderkey", "amount_original", "currency")


@query(
    "extract_amounts_v1", "AMT-2", "startups",
    r"""SELECT ord, CAST(trunc(CAST(replace(regexp_extract(funding_amount, '(?i)\$\s*([\d,]+(?:\.\d+)?)\s*([kmb])\b', 1), ',', '') AS DOUBLE)
      * CASE lower(regexp_extract(funding_amount, '(?i)\$\s*([\d,]+(?:\.\d+)?)\s*([kmb])\b', 2)) WHEN 'k' THEN 1e3 WHEN 'm' THEN 1e6 ELSE 1e9 END) AS BIGINT) AS funding_amount_usd
      FROM startups WHERE regexp_matches(funding_amount, '(?i)\$\s*([\d,]+(?:\.\d+)?)\s*([kmb])\b')
    UNION ALL SELECT ord, NULL FROM startups WHERE NOT coalesce(regexp_matches(funding_amount, '(?i)\$\s*([\d,]+(?:\.\d+)?)\s*([kmb])\b'), false)""",
)
def extract_amounts_v1(t: Tables):
    return E.extract_amounts_v1(t("startups")).select("ord", "funding_amount_usd")


@query(
    "convert_currency", "JOIN-7", "evidence",
    MONEY_SQL + " SELECT o_orderkey, currency, per_usd AS rate, CASE WHEN per_usd IS NOT NULL THEN '2026-01-01' END AS rate_date, amount_usd FROM dollars",
)
def convert_currency(t: Tables):
    rows = E.convert_currency(E.extract_amounts(t("evidence")), C.rates_frame(t.spark))
    return rows.select(
        "o_orderkey", "currency", F.col("currency_conversion_rate").alias("rate"),
        F.col("conversion_rate_date").cast("string").alias("rate_date"), "amount_usd",
    )


@query("classify_funding_text", "TXT-5", "evidence", f"SELECT o_orderkey, {D.statement_class('evidence_text')} AS statement_class FROM evidence")
def classify_funding_text(t: Tables):
    return E.classify_funding_text(t("evidence")).select("o_orderkey", "statement_class")


@query("normalize_stage", "TXT-6", "evidence", f"SELECT o_orderkey, {D.stage('value')} AS funding_stage FROM evidence")
def normalize_stage(t: Tables):
    return E.normalize_stage(t("evidence")).select("o_orderkey", "funding_stage")


RECONCILED_SQL = MONEY_SQL + f""", classed AS (SELECT *, {D.statement_class('evidence_text')} AS statement_class FROM dollars),
  reconciled AS (SELECT * REPLACE (
      CASE WHEN wrong THEN CASE WHEN statement_class = 'valuation' THEN 'valuation_report' ELSE 'other' END ELSE event_type END AS event_type,
      CASE WHEN wrong THEN 'ambiguous' ELSE verification_status END AS verification_status, CASE WHEN NOT wrong THEN amount_usd END AS amount_usd)
    FROM (SELECT *, event_type IN ('funding_round_completed', 'funding_round_announced') AND statement_class IN ('valuation', 'tam', 'fund_size') AS wrong FROM classed))"""


@query(
    "reconcile_funding_claims", "PRJ-4", "evidence",
    RECONCILED_SQL + " SELECT o_orderkey, event_type, verification_status, amount_usd FROM reconciled",
)
def reconcile_funding_claims(t: Tables):
    rows = E.convert_currency(E.extract_amounts(t("evidence")), C.rates_frame(t.spark))
    rows = E.reconcile_funding_claims(E.classify_funding_text(rows))
    return rows.select("o_orderkey", "event_type", "verification_status", "amount_usd")


@query(
    "dedupe_events", "SNK-2", "company_events",
    """SELECT company_id, source_url, event_type, max(ingest_ord) AS ingest_ord FROM company_events GROUP BY 1, 2, 3""",
)
def dedupe_events(t: Tables):
    return E.dedupe_events(t("company_events")).select("company_id", "source_url", "event_type", "ingest_ord")


_TIER = f"""CASE WHEN is_own THEN 1 WHEN domain IN ({D.quoted(C.TIER_2_DOMAINS)}) THEN 2 ELSE 3 END"""
_LABEL = f"""CASE WHEN is_own THEN 'company newsroom/official site' WHEN domain IN ({D.quoted(C.TIER_2_DOMAINS)}) THEN 'established journalism'
  WHEN domain IN ({D.quoted(C.TIER_3_DOMAINS)}) THEN 'discovery source' ELSE 'unclassified (defaults to discovery)' END"""
OWN_SQL = f""", sited AS (SELECT e.*, {D.registrable_domain('e.source_url')} AS domain, c.primary_domain FROM company_events e LEFT JOIN companies c USING (company_id)),
  owned AS (SELECT *, coalesce(domain = primary_domain, false) AS is_own FROM sited)"""


@query("own_domain_flag", "JOIN-6", "company_events companies", OWN_SQL + " SELECT ingest_ord, is_own AS is_own_domain FROM owned")
def own_domain_flag(t: Tables):
    return R.own_domain_flag(t("company_events"), t("companies")).select("ingest_ord", "is_own_domain")


@query(
    "classify_source_tiers", "URL-3", "company_events companies",
    OWN_SQL + f" SELECT ingest_ord, domain AS source_domain, {_TIER} AS source_tier, {_LABEL} AS tier_label FROM owned",
)
def classify_source_tiers(t: Tables):
    flagged = R.own_domain_flag(t("company_events").drop("source_tier"), t("companies"))
    rows = R.classify_source_tiers(flagged, C.tiers_frame(t.spark))
    return rows.select("ingest_ord", "source_domain", "source_tier", "tier_label")


def indep_sql(events: str, out: str = "indep") -> str:
    """The ordered walk, as a fold over each company's list."""
    return f""", {out}_src AS (SELECT company_id, {D.canonical_url('source_url')} AS u, {D.fingerprint('title', 'evidence_text')} AS h,
      {D.registrable_domain('source_url')} AS s, published_at, ingest_ord FROM {events} WHERE source_url <> ''),
    {out}_first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id, u ORDER BY published_at DESC NULLS FIRST, ingest_ord) AS n FROM {out}_src) WHERE n = 1),
    {out} AS (SELECT company_id, CAST(len(list_reduce(list({{'hs': []::VARCHAR[], 'ss': []::VARCHAR[], 'h': h, 's': s}} ORDER BY published_at DESC NULLS FIRST, ingest_ord),
        lambda a, x: CASE WHEN list_contains(a.hs, x.h) OR coalesce(list_contains(a.ss, x.s), false) THEN a
          ELSE {{'hs': list_append(a.hs, x.h), 'ss': list_append(a.ss, x.s), 'h': x.h, 's': x.s}} END,
        {{'hs': []::VARCHAR[], 'ss': []::VARCHAR[], 'h': '', 's': ''}}).hs) AS INT) AS independent_sources FROM {out}_first GROUP BY company_id)"""


@query(
    "independent_sources", "AGG-8", "company_events",
    indep_sql("company_events") + " SELECT company_id, independent_sources FROM indep",
)
def independent_sources(t: Tables):
    return count_independent(E.event_sources(t("company_events")))


@query(
    "independent_sources_chain", "AGG-8", "",
    """, chain AS (SELECT CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS VARCHAR) ELSE 'most' END AS company_id, o_orderkey AS i FROM orders),
    numbered_chain AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY i) - 1 AS place FROM chain)
    SELECT company_id, CAST((count(*) + 1) // 2 AS INT) AS independent_sources FROM numbered_chain GROUP BY 1""".replace(", chain AS", "WITH chain AS", 1),
)
def independent_sources_chain(t: Tables):
    """One company holds most sources, and in every company each source shares its text or its domain with the one before it: every other one counts."""
    company = F.when(F.col("o_orderstatus") == "P", F.col("o_custkey").cast("string")).otherwise("most")
    rows = running_totals(t("orders").select(company.alias("company_id"), "o_orderkey", F.lit(1).alias("one")), ["company_id"], ["o_orderkey"], "one")
    i = F.col("_upto") - 1
    half = lambda c: F.floor(c / 2).cast("string")
    sources = rows.select(
        "company_id", F.concat(F.lit("https://s"), half(i + 1), F.lit(".com/"), F.col("o_orderkey").cast("string")).alias("url"), F.lit("x").alias("title"),
        F.concat(F.lit("text "), half(i)).alias("body"), F.col("_upto").alias("ord"),
    )
    return count_independent(sources)


@query(
    "content_fingerprint", "TXT-4", "",
    f"""SELECT content_hash, count(*) AS copies, min(doc_id) AS first_id FROM (SELECT doc_id, {D.fingerprint("''", 'text')} AS content_hash FROM documents) GROUP BY 1""",
)
def content_fingerprint(t: Tables):
    docs = t("documents").select("doc_id", F.lit("").alias("title"), F.col("text").alias("body"))
    return R.mirrored_copies(R.content_fingerprint(docs), "doc_id")


@query("countable_events", "FLT-6", "company_events", f"""SELECT ingest_ord, event_type FROM company_events WHERE verification_status = 'completed'
    AND event_type IN ({D.quoted(t for t, _, c in C.EVENT_VALUES if c == 'recent_verified_events')})""")
def countable_events(t: Tables):
    from upswell.functions.scores import component_types
    from upswell.operators.scoring import countable_events as keep

    return keep(t("company_events"), component_types("recent_verified_events")).select("ingest_ord", "event_type")


@query("completed_funding", "FLT-7", "company_events", """SELECT ingest_ord, company_id, amount_usd FROM company_events
    WHERE event_type = 'funding_round_completed' AND verification_status = 'completed' AND amount_usd <> 0""")
def completed_funding(t: Tables):
    from upswell.operators.scoring import completed_funding as keep

    return keep(t("company_events")).select("ingest_ord", "company_id", "amount_usd")


@query(
    "scan_event_history", "SRC-7", "company_events companies",
    """SELECT ingest_ord, company_id, event_type FROM company_events WHERE company_id IN (SELECT company_id FROM companies WHERE industry = 'AI')""",
)
def scan_event_history(t: Tables):
    from upswell.sources.stored import scan_event_history as scan

    touched = t("companies").filter("industry = 'AI'")
    return scan(t("company_events"), touched).select("ingest_ord", "company_id", "event_type")


# Event facts of the accepted claims: company ids are the claim's name key here.
_MONEY = "coalesce(nullif(evidence_excerpt, ''), nullif(value, ''), '')"
_F_AMT = D.amount("money_text")
FACTS_SQL = VALIDATED_SQL + f""", named AS (SELECT *, {GROUP_KEY} AS company_id, {D.registrable_domain('source_url')} AS domain, {_MONEY} AS money_text,
      {D.statement_class('evidence_excerpt')} AS statement_class FROM checked WHERE len(errors) = 0 AND {D.squash('company_name')} <> ''),
  tiered AS (SELECT *, CASE WHEN domain IN ({D.quoted(C.TIER_2_DOMAINS)}) THEN 2 ELSE 3 END AS source_tier, {_F_AMT} AS amount_original,
      CASE WHEN {_F_AMT} IS NOT NULL THEN {D.currency('money_text')} END AS currency,
      event_type IN ('funding_round_completed', 'funding_round_announced') AND statement_class IN ('valuation', 'tam', 'fund_size') AS wrong FROM named),
  facts0 AS (SELECT *, CASE WHEN wrong THEN CASE WHEN statement_class = 'valuation' THEN 'valuation_report' ELSE 'other' END ELSE event_type END AS event_type1,
      CASE WHEN wrong THEN 'ambiguous' ELSE status END AS verification_status,
      CASE WHEN NOT wrong THEN round_even(amount_original / {D.rate('currency')}, 2) END AS amount_usd FROM tiered),
  facts AS (SELECT * FROM (SELECT *, CASE WHEN event_type1 IN ('funding_round_completed', 'funding_round_announced') THEN {D.stage('value')} END AS funding_stage,
      row_number() OVER (PARTITION BY company_id, source_url, event_type1 ORDER BY ord DESC) AS n FROM facts0) WHERE n = 1)"""


def build_facts(t: Tables):
    accepted = K.accepted_claims(K.validate_claims(K.attach_sources(t("claims"), t("numbered"))))
    keyed = K.with_group_key(accepted).withColumnRenamed("group_key", "company_id")
    tiered = R.classify_source_tiers(keyed, C.tiers_frame(t.spark))
    return E.dedupe_events(E.event_facts(tiered, C.rates_frame(t.spark)))


@query(
    "build_event_facts_own", "PIPE-4 JOIN-6 URL-3", "claims numbered",
    FACTS_SQL.replace("tiered AS (SELECT *, CASE WHEN domain IN", "owned AS (SELECT company_id, min(domain) AS own FROM named GROUP BY 1),\n  tiered AS (SELECT *, CASE WHEN domain = own THEN 1 WHEN domain IN").replace(
        "AS wrong FROM named)", "AS wrong FROM named JOIN owned USING (company_id))"
    ) + """ SELECT ord AS ingest_ord, company_id, event_type1 AS event_type, verification_status, amount_original, currency, amount_usd, funding_stage, source_url, source_tier, statement_class FROM facts""",
)
def build_event_facts_own(t: Tables):
    """Each company owns one of the domains that write about it."""
    accepted = K.accepted_claims(K.validate_claims(K.attach_sources(t("claims"), t("numbered"))))
    keyed = K.with_group_key(accepted).withColumnRenamed("group_key", "company_id")
    companies = keyed.groupBy("company_id").agg(F.min(registrable_domain(F.col("source_url"))).alias("primary_domain"))
    facts = E.dedupe_events(E.build_event_facts(keyed, companies, C.tiers_frame(t.spark), C.rates_frame(t.spark)))
    return facts.select(
        "ingest_ord", "company_id", "event_type", "verification_status", "amount_original", "currency", "amount_usd",
        "funding_stage", "source_url", "source_tier", "statement_class",
    )


@query(
    "build_event_facts", "PIPE-4", "claims numbered",
    FACTS_SQL + """ SELECT ord AS ingest_ord, company_id, event_type1 AS event_type, verification_status, amount_original, currency, amount_usd,
      funding_stage, source_url, source_tier, statement_class FROM facts""",
)
def build_event_facts(t: Tables):
    return build_facts(t).select(
        "ingest_ord", "company_id", "event_type", "verification_status", "amount_original", "currency", "amount_usd",
        "funding_stage", "source_url", "source_tier", "statement_class",
    )


