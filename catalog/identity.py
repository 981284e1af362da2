"""Names, entity resolution, field merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck as D
from catalog.registry import Tables, query
from upswell import config as C
from upswell.operators import resolve as R
from upswell.operators import tables as B
from upswell.sources import stored


@query("normalize_names", "TXT-1", "candidates", f"SELECT candidate_id, {D.normalize_name('company_name')} AS normalized_name FROM candidates")
def normalize_names(t: Tables):
    return R.normalize_names(t("candidates")).select("candidate_id", "normalized_name")


@query("scan_identity", "SRC-5", "known_companies", "SELECT company_id, canonical_name, normalized_name, primary_domain, headquarters_country, description FROM known_companies")
def scan_identity(t: Tables):
    return stored.scan_identity(t("known_companies"))


@query("scan_aliases", "SRC-6", "aliases", "SELECT company_id, normalized_alias FROM aliases")
def scan_aliases(t: Tables):
    return stored.scan_aliases(t("aliases"))


@query(
    "description_similarity", "TXT-3", "candidates companies",
    f"""SELECT candidate_id, round({D.jaccard('c.description', 'k.description')}, 6) AS similarity FROM candidates c JOIN companies k ON CAST(c.first_ord AS VARCHAR) = k.company_id""",
)
def description_similarity(t: Tables):
    known = t("companies").select(F.col("company_id").alias("first_id"), F.col("description").alias("known_description"))
    pairs = t("candidates").join(known, F.col("first_ord").cast("string") == F.col("first_id"))
    rows = R.description_similarity(pairs, "description", "known_description")
    return rows.select("candidate_id", F.round("similarity", 6).alias("similarity"))


RESOLVED_SQL = f""", cand AS (SELECT *, CASE WHEN primary_domain IS NULL THEN NULL ELSE {D.registrable_domain('primary_domain')} END AS dom, nullif({D.normalize_name('company_name')}, '') AS nm FROM candidates),
  bd AS (SELECT {D.registrable_domain('primary_domain')} AS d, min(company_id) AS domain_id FROM known_companies WHERE primary_domain IS NOT NULL GROUP BY 1),
  ba AS (SELECT normalized_alias AS a, min(company_id) AS alias_id FROM aliases GROUP BY 1),
  bn AS (SELECT normalized_name AS n, count(*) AS cnt, min(company_id) AS name_id, arg_min(headquarters_country, company_id) AS hq, arg_min(description, company_id) AS descr FROM known_companies GROUP BY 1),
  signals AS (SELECT cand.*, domain_id, alias_id, cnt, name_id, coalesce(headquarters_country = hq, false) AS same_hq,
      coalesce({D.jaccard('description', 'descr')} >= 0.2, false) AS similar_text FROM cand LEFT JOIN bd ON dom = d LEFT JOIN ba ON nm = a LEFT JOIN bn ON nm = n),
  kinds AS (SELECT *, CASE WHEN domain_id IS NOT NULL THEN 'domain' WHEN alias_id IS NOT NULL THEN 'alias' WHEN cnt IS NULL THEN 'new' WHEN cnt > 1 THEN 'needs_review'
      WHEN nm IN ({D.quoted(C.AMBIGUOUS_NAMES)}) AND NOT same_hq AND NOT similar_text THEN 'needs_review' ELSE 'name' END AS match_type FROM signals),
  resolved AS (SELECT *, CASE match_type WHEN 'domain' THEN domain_id WHEN 'alias' THEN alias_id WHEN 'name' THEN name_id END AS matched_id,
      CASE match_type WHEN 'domain' THEN 100 WHEN 'alias' THEN 90 WHEN 'name' THEN 60 + CASE WHEN same_hq THEN 15 ELSE 0 END + CASE WHEN similar_text THEN 15 ELSE 0 END ELSE 0 END AS resolution_confidence FROM kinds),
  identified AS (SELECT *, coalesce(matched_id, sha256(coalesce(dom, nullif(nm, ''), lower(company_name)))) AS company_id FROM resolved)"""


def resolved(t: Tables):
    return R.resolve_entities(t("candidates"), stored.scan_identity(t("known_companies")), stored.scan_aliases(t("aliases")))


@query(
    "resolve_entities", "JOIN-3", "candidates known_companies aliases",
    RESOLVED_SQL + " SELECT candidate_id, match_type, matched_id, resolution_confidence, match_type = 'needs_review' AS needs_review FROM resolved",
)
def resolve_entities(t: Tables):
    return resolved(t).select("candidate_id", "match_type", "matched_id", "resolution_confidence", "needs_review")


@query(
    "assign_company_ids", "JOIN-3 Q9", "candidates known_companies aliases",
    RESOLVED_SQL + " SELECT candidate_id, company_id FROM identified",
)
def assign_company_ids(t: Tables):
    return R.assign_company_ids(resolved(t)).select("candidate_id", "company_id")


@query(
    "attach_existing", "JOIN-5", "candidates known_companies aliases",
    RESOLVED_SQL + """ SELECT candidate_id, i.company_id, k.canonical_name AS existing_canonical_name, k.primary_domain AS existing_primary_domain
      FROM identified i JOIN known_companies k ON i.company_id = k.company_id""",
)
def attach_existing(t: Tables):
    rows = R.attach_existing(R.assign_company_ids(resolved(t)), stored.scan_identity(t("known_companies")))
    return rows.select("candidate_id", "company_id", "existing_canonical_name", "existing_primary_domain")


@query(
    "insert_new_companies", "SNK-8", "candidates known_companies aliases",
    RESOLVED_SQL + """ SELECT company_id, company_name AS canonical_name, primary_domain, 'operating' AS company_status, 'unknown' AS hiring_status, 'Not yet verified' AS moat_summary,
      0 AS moat_confidence, match_type = 'needs_review' AS entity_resolution_needs_review FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY first_ord) AS n FROM identified WHERE matched_id IS NULL) WHERE n = 1""",
)
def insert_new_companies(t: Tables):
    rows = R.assign_company_ids(resolved(t)).withColumn("group_key", F.lower("company_name")).withColumn(
        "hiring_status", F.lit(None).cast("string")
    )
    return B.insert_new_companies(rows, t.now).select(
        "company_id", "canonical_name", "primary_domain", "company_status", "hiring_status", "moat_summary", "moat_confidence",
        "entity_resolution_needs_review",
    )


DECIDED_SQL = f""", decided AS (SELECT *, CASE WHEN NOT {D.populated('new_value')} THEN 'kept: new value unknown' WHEN NOT {D.populated('existing_value')} THEN 'taken: nothing stored'
    WHEN new_value = existing_value THEN 'reconfirmed' WHEN new_tier <= existing_tier OR coalesce(new_confidence >= existing_confidence, false) OR clearly_newer THEN 'taken: equal or better evidence'
    ELSE 'kept: stored evidence is better' END AS decision FROM field_updates),
  merged AS (SELECT *, decision NOT LIKE 'kept%' AS accept, decision = 'kept: stored evidence is better' AS contradiction FROM decided)"""


@query(
    "preserve_fields", "SNK-3", "field_updates",
    DECIDED_SQL + " SELECT company_id, field, decision, accept, contradiction, CASE WHEN accept THEN new_value ELSE existing_value END AS merged_value FROM merged",
)
def preserve_fields(t: Tables):
    return B.preserve_fields(t("field_updates")).select("company_id", "field", "decision", "accept", "contradiction", "merged_value")


@query(
    "field_provenance", "SNK-5", "field_updates",
    DECIDED_SQL + f""" SELECT company_id, field AS field_name, new_value AS field_value, new_tier AS source_tier, new_confidence AS confidence,
      contradiction AS is_contradiction, '2001-08-01' AS run_date FROM merged WHERE {D.populated('new_value')}""",
)
def field_provenance(t: Tables):
    rows = B.field_provenance(B.preserve_fields(t("field_updates")), t.now)
    return rows.withColumn("run_date", F.col("run_date").cast("string"))


@query(
    "apply_timestamps", "SNK-4", "companies",
    """SELECT company_id, CAST(CASE WHEN key % 2 = 0 THEN DATE '2001-08-01' ELSE coalesce(last_seen, DATE '2001-08-01') END AS VARCHAR) AS last_seen,
      CAST(CASE WHEN key % 3 = 0 THEN DATE '2001-08-01' ELSE coalesce(CASE WHEN key % 5 <> 0 THEN last_verified END, DATE '2001-08-01') END AS VARCHAR) AS last_verified FROM companies""",
)
def apply_timestamps(t: Tables):
    rows = t("companies").withColumns(
        {
            "rediscovered": F.col("key") % 2 == 0, "fact_verified": F.col("key") % 3 == 0,
            "last_verified": F.when(F.col("key") % 5 != 0, F.col("last_verified")),
        }
    )
    out = B.apply_timestamps(rows, t.now)
    return out.select("company_id", F.col("last_seen").cast("string").alias("last_seen"), F.col("last_verified").cast("string").alias("last_verified"))
