"""Feeds, relevance, batches, claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck as D
from catalog.registry import Tables, query
from upswell import config as C
from upswell.operators import claims as K
from upswell.sources import feeds as S

ISO = "date_format({0}, 'yyyy-MM-dd HH:mm:ss')"


def stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


STAMP = "strftime(published_ts, '%Y-%m-%d %H:%M:%S') AS published_ts"

PUBLISHED_SQL = """coalesce(
  try_strptime(regexp_replace(published, '^[A-Za-z]+, ', ''), '%d %b %Y %H:%M:%S GMT'), try_strptime(published, '%Y-%m-%dT%H:%M:%SZ'))"""


@query(
    "scan_feed_items", "SRC-1 SRC-3", "feed_raw",
    f"""SELECT coalesce(title, '') AS title, md5(coalesce(summary, description, '')) AS summary_md5, coalesce(link, '') AS link,
      coalesce(published, '') AS published, strftime({PUBLISHED_SQL}, '%Y-%m-%d %H:%M:%S') AS published_ts, source_name, item_ord
    FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY item_ord) AS n FROM feed_raw) WHERE n <= 25""",
)
def scan_feed_items(t: Tables):
    items = S.feed_items(t("feed_raw"), C.FEED_ITEM_CAP)
    return items.select(
        "title", F.md5("summary").alias("summary_md5"), "link", "published", stamp("published_ts"), "source_name", "item_ord"
    )


@query(
    "scan_feed_items_all", "SRC-1 SRC-3", "feed_raw",
    f"""SELECT coalesce(title, '') AS title, md5(coalesce(summary, description, '')) AS summary_md5, coalesce(link, '') AS link,
      coalesce(published, '') AS published, strftime({PUBLISHED_SQL}, '%Y-%m-%d %H:%M:%S') AS published_ts, source_name, item_ord
    FROM feed_raw""",
)
def scan_feed_items_all(t: Tables):
    items = S.feed_items(t("feed_raw"))
    return items.select(
        "title", F.md5("summary").alias("summary_md5"), "link", "published", stamp("published_ts"), "source_name", "item_ord"
    )


@query(
    "normalize_published", "SRC-3", "feed_raw",
    f"""SELECT item_ord, coalesce(published, '') AS published, strftime({PUBLISHED_SQL}, '%Y-%m-%d %H:%M:%S') AS published_ts FROM feed_raw""",
)
def normalize_published(t: Tables):
    raw = t("feed_raw").select("item_ord", F.coalesce("published", F.lit("")).alias("published"))
    return S.normalize_published(raw).select("item_ord", "published", stamp("published_ts"))


def search_raw(t: Tables):
    """Search answers of 25 hits each, built from the documents."""
    hit = F.struct(
        F.when(F.col("doc_id") % 6 == 0, F.lit("")).otherwise(F.split("text", "\n").getItem(0)).alias("title"),
        F.when(F.col("doc_id") % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("https://hit.example.com/"), F.col("doc_id"))).alias("url"),
        F.col("doc_id").cast("string").alias("objectID"),
        F.date_format(F.timestamp_seconds(978307200 + F.col("doc_id") * 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    )
    docs = t("documents").select(F.floor(F.col("doc_id") / 25).cast("int").alias("query_ord"), "doc_id", hit.alias("hit"))
    ordered = F.sort_array(F.collect_list(F.struct("doc_id", "hit")))
    return docs.groupBy("query_ord").agg(F.transform(ordered, lambda h: h["hit"]).alias("hits"))


@query(
    "scan_search_hits", "SRC-2",
    sql="""SELECT split_part(text, chr(10), 1) AS title, split_part(text, chr(10), 1) AS summary,
      CASE WHEN doc_id % 4 = 0 THEN 'https://news.ycombinator.com/item?id=' || doc_id ELSE 'https://hit.example.com/' || doc_id END AS link,
      strftime(make_timestamp((978307200 + doc_id * 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS published_ts, 'Hacker News' AS source_name
    FROM documents WHERE doc_id % 25 < 20 AND doc_id % 6 <> 0 AND split_part(text, chr(10), 1) <> ''""",
)
def scan_search_hits(t: Tables):
    return S.search_hits(search_raw(t), C.HITS_PER_QUERY).select("title", "summary", "link", stamp("published_ts"), "source_name")


@query(
    "scan_search_hits_all", "SRC-2",
    sql="""SELECT split_part(text, chr(10), 1) AS title, split_part(text, chr(10), 1) AS summary,
      CASE WHEN doc_id % 4 = 0 THEN 'https://news.ycombinator.com/item?id=' || doc_id ELSE 'https://hit.example.com/' || doc_id END AS link,
      strftime(make_timestamp((978307200 + doc_id * 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS published_ts, 'Hacker News' AS source_name
    FROM documents WHERE doc_id % 6 <> 0 AND split_part(text, chr(10), 1) <> ''""",
)
def scan_search_hits_all(t: Tables):
    return S.search_hits(search_raw(t)).select("title", "summary", "link", stamp("published_ts"), "source_name")


ARTICLES_SQL = """, firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY source_ord, item_ord) AS n FROM articles WHERE link <> '') WHERE n = 1)"""


@query(
    "load_articles", "SRC-4 SET-1 WIN-5 EXT-1", "articles",
    ARTICLES_SQL + " SELECT link, md5(title) AS title_md5, source_name, item_ord FROM firsts",
)
def load_articles(t: Tables):
    parts = [
        lambda spark, i=i: t("articles").filter(F.pmod(F.col("source_ord"), F.lit(2)) == i) for i in (0, 1)
    ]
    return S.load_articles(t.spark, parts).select("link", F.md5("title").alias("title_md5"), "source_name", "item_ord")


RELEVANT_SQL = f"""(trim(title) <> '' AND NOT {D.has_pattern("lower(trim(title) || ' ' || summary)", C.NOISE_PATTERNS)}
  AND NOT ({D.has_pattern("lower(trim(title))", C.MARKET_PATTERNS)} AND NOT {D.contains_any("lower(trim(title) || ' ' || summary)", C.STARTUP_TERMS)}))"""


@query(
    "filter_relevant_news", "FLT-1", "articles",
    f"SELECT item_ord, link, md5(title) AS title_md5 FROM articles WHERE {RELEVANT_SQL}",
)
def filter_relevant_news(t: Tables):
    return S.filter_relevant_news(t("articles")).select("item_ord", "link", F.md5("title").alias("title_md5"))


@query(
    "latest_news", "TOP-1", "articles",
    ARTICLES_SQL + f""" SELECT link, {STAMP} FROM firsts WHERE {RELEVANT_SQL} ORDER BY firsts.published_ts DESC NULLS LAST, source_ord, item_ord, link LIMIT 60""",
)
def latest_news(t: Tables):
    return S.latest_news(S.filter_relevant_news(S.dedupe_links(t("articles")))).select("link", stamp("published_ts"))


NUMBERED_SQL = ARTICLES_SQL + """, placed AS (SELECT *, row_number() OVER (ORDER BY source_ord, item_ord, link) - 1 AS i FROM firsts)"""


@query(
    "pack_batches", "TXT-11", "articles",
    NUMBERED_SQL + """ SELECT CAST(i // 8 AS BIGINT) AS batch_id, CAST(count(*) AS INT) AS n_articles,
      md5(string_agg(CAST(i % 8 + 1 AS VARCHAR) || '. TITLE: ' || title || chr(10) || '   SUMMARY: ' || summary, chr(10) || chr(10) ORDER BY i)) AS prompt_md5
    FROM placed GROUP BY 1""",
)
def pack_batches(t: Tables):
    packed = K.pack_batches(K.number_articles(S.dedupe_links(t("articles"))))
    return packed.select("batch_id", "n_articles", F.md5("prompt").alias("prompt_md5"))


def responses(t: Tables):
    """One JSON answer per batch; some fenced, some cut short, some missing."""
    parts = F.sort_array(F.collect_list(F.struct("ord", "raw")))
    body = t("response_parts").groupBy("batch_id").agg(
        F.concat(F.lit("["), F.array_join(F.transform(parts, lambda p: p["raw"]), ", "), F.lit("]")).alias("json")
    )
    b = F.col("batch_id")
    content = (
        F.when(b % 14 == 0, None)
        .when(b % 9 == 0, F.expr("substr(json, 1, length(json) - 7)"))
        .when(b % 10 == 3, F.expr("split(json, '}, ')[0] || '}'").substr(F.lit(2), F.lit(10_000)))
        .when(b % 4 == 0, F.concat(F.lit("```json\n"), F.col("json"), F.lit("\n```")))
        .otherwise(F.col("json"))
    )
    return body.select("batch_id", F.lit("model-a").alias("provider"), content.alias("content"))


FAILED_SQL = "(batch_id % 14 = 0 OR batch_id % 9 = 0 OR batch_id % 10 = 3)"


@query(
    "explode_claims", "TXT-10", "response_parts claims",
    f"""SELECT r.batch_id, c.company_name, c.event_type, c.source_index, c.confidence, CASE WHEN c.ord % 21 = 0 THEN NULL ELSE c.status END AS status,
      'quote ' || c.ord AS evidence_excerpt, CAST(CASE WHEN c.ord % 21 = 0 THEN 5 ELSE 6 END AS INT) AS n_present
    FROM response_parts r JOIN claims c USING (ord) WHERE NOT {FAILED_SQL.replace('batch_id', 'r.batch_id')}""",
)
def explode_claims(t: Tables):
    rows = K.explode_claims(K.parse_responses(responses(t)))
    return rows.select(
        "batch_id", "company_name", "event_type", "source_index", "confidence", "status", "evidence_excerpt",
        (F.size("present") - 1).alias("n_present"),
    )


@query(
    "batch_failure_rate", "AGG-19", "response_parts",
    f"""SELECT count(*) AS n_batches, count(*) FILTER (WHERE {FAILED_SQL}) AS n_failed,
      round_even(100.0::DOUBLE * count(*) FILTER (WHERE {FAILED_SQL}) / count(*), 1) AS failure_rate, bool_and({FAILED_SQL}) AS all_failed
    FROM (SELECT DISTINCT batch_id FROM response_parts)""",
)
def batch_failure_rate(t: Tables):
    from upswell.operators.quality import batch_failure_rate as rate

    return rate(K.parse_responses(responses(t)))


ATTACHED_SQL = """, attached AS (SELECT c.*, n.link AS source_url, n.source_name, n.published_ts AS published_at,
    coalesce(n.title, '') || ' ' || coalesce(n.summary, '') AS source_text FROM claims c LEFT JOIN numbered n USING (batch_id, source_index))"""


@query(
    "attach_sources", "JOIN-1", "claims numbered",
    ATTACHED_SQL + " SELECT ord, source_url, source_name, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM attached",
)
def attach_sources(t: Tables):
    rows = K.attach_sources(t("claims"), t("numbered"))
    return rows.select("ord", "source_url", "source_name", stamp("published_at"))


@query(
    "evidence_overlap", "TXT-2", "claims numbered",
    ATTACHED_SQL + f""" SELECT ord, round({D.overlap('evidence_excerpt', 'source_text')}, 6) AS overlap FROM attached
      WHERE source_url IS NOT NULL AND trim(evidence_excerpt) <> ''""",
)
def evidence_overlap(t: Tables):
    rows = K.validate_claims(K.attach_sources(t("claims"), t("numbered")))
    return rows.filter("overlap is not null").select("ord", F.round("overlap", 6).alias("overlap"))


_q = D.squash("evidence_excerpt")
VALIDATED_SQL = ATTACHED_SQL + f""", checked AS (SELECT *, list_filter([
    CASE WHEN event_type NOT IN ({D.quoted(C.EVENT_TYPES)}) THEN 'unsupported event type' END,
    CASE WHEN status NOT IN ({D.quoted(C.CLAIM_STATUSES)}) THEN 'unsupported status' END,
    CASE WHEN source_url IS NULL THEN 'source index out of range' END,
    CASE WHEN NOT confidence BETWEEN 0 AND 100 THEN 'confidence out of range' END,
    CASE WHEN event_type IN ({D.quoted(C.MATERIAL_EVENT_TYPES)}) AND {_q} = '' THEN 'material claim without evidence' END,
    CASE WHEN event_type NOT IN ({D.quoted(C.MATERIAL_EVENT_TYPES)}) AND {_q} = '' THEN 'evidence is empty' END,
    CASE WHEN source_url IS NOT NULL AND {_q} <> '' AND {D.overlap('evidence_excerpt', 'source_text')} < 0.6 THEN 'evidence not in source' END,
    CASE WHEN status = 'ambiguous' AND event_type IN ('funding_round_completed', 'acquisition') THEN 'ambiguous completed transaction' END
  ], lambda x: x IS NOT NULL) AS errors FROM attached)"""


@query(
    "validate_claims", "FLT-5", "claims numbered",
    VALIDATED_SQL + " SELECT ord, len(errors) = 0 AS accepted, array_to_string(errors, '; ') AS errors FROM checked",
)
def validate_claims(t: Tables):
    rows = K.validate_claims(K.attach_sources(t("claims"), t("numbered")))
    return rows.select("ord", "accepted", F.array_join("errors", "; ").alias("errors"))


GROUP_KEY = f"coalesce(nullif({D.normalize_name('company_name')}, ''), nullif(lower({D.squash('company_name')}), ''))"
GROUPS_SQL = f""", keyed AS (SELECT *, {GROUP_KEY} AS group_key FROM attached WHERE {D.squash('company_name')} <> ''),
  grouped AS (SELECT group_key, arg_min({D.squash('company_name')}, ord) AS company_name, count(*) AS n_claims, min(ord) AS first_ord,
    arg_min(source_url, ord) AS source_url0,
    arg_min(business_idea, ord) FILTER (WHERE business_idea <> '') AS description, arg_min(location, ord) FILTER (WHERE location <> '') AS location,
    arg_min(industry, ord) FILTER (WHERE industry <> '') AS industry,
    arg_min(value, ord) FILTER (WHERE value <> '' AND event_type = 'other' AND contains(lower(evidence_excerpt), 'found')) AS founded_year,
    avg(confidence) AS extraction_confidence FROM keyed GROUP BY group_key)"""


@query(
    "group_claims", "AGG-1 AGG-10 WIN-4", "claims numbered",
    ATTACHED_SQL + GROUPS_SQL + """ SELECT group_key, company_name, n_claims, first_ord, description, location, industry, founded_year,
      round(extraction_confidence, 6) AS extraction_confidence FROM grouped""",
)
def group_claims(t: Tables):
    rows = K.group_claims(K.attach_sources(t("claims"), t("numbered")))
    return rows.select(
        "group_key", "company_name", "n_claims", "first_ord", "description", "location", "industry", "founded_year",
        F.round("extraction_confidence", 6).alias("extraction_confidence"),
    )


@query(
    "extraction_confidence", "AGG-10", "claims",
    f"SELECT {GROUP_KEY} AS group_key, round(avg(confidence), 6) AS extraction_confidence FROM claims WHERE {D.squash('company_name')} <> '' GROUP BY 1",
)
def extraction_confidence(t: Tables):
    from upswell.operators.scoring import extraction_confidence as mean

    rows = mean(K.with_group_key(t("claims")))
    return rows.select("group_key", F.round("extraction_confidence", 6).alias("extraction_confidence"))


_low = "lower(coalesce(location, ''))"
REGION_SQL = f"""CASE WHEN {_low} = '' THEN 'Unknown' WHEN {D.has_phrase(_low, ['chennai'])} THEN 'India (Chennai)'
  WHEN {D.has_phrase(_low, C.INDIA_TERMS)} THEN 'India' WHEN {D.has_phrase(_low, C.USA_TERMS)} THEN 'USA' ELSE 'Rest of World' END"""
LOOSE_SQL = f"""CASE WHEN {_low} = '' THEN 'Unknown' WHEN contains({_low}, 'chennai') THEN 'India (Chennai)'
  WHEN {D.contains_any(_low, C.INDIA_TERMS)} THEN 'India' WHEN {D.contains_any(_low, C.USA_TERMS)} THEN 'USA' ELSE 'Rest of World' END"""
BUCKET_SQL = "CASE {0} WHEN 'USA' THEN 'US' WHEN 'India' THEN 'INDIA' WHEN 'India (Chennai)' THEN 'INDIA' WHEN 'Rest of World' THEN 'ROW' END"


@query(
    "classify_region", "PRJ-1 PRJ-2", "claims",
    f"""SELECT ord, {REGION_SQL} AS region, {LOOSE_SQL} AS loose_region, {BUCKET_SQL.format('(' + REGION_SQL + ')')} AS region_bucket FROM claims""",
)
def classify_region(t: Tables):
    strict = K.region_bucket(K.classify_region(t("claims")))
    return strict.select("ord", "region", K.region_of(F.col("location"), substring=True).alias("loose_region"), "region_bucket")


@query(
    "dedupe_companies", "AGG-2", "claims",
    f"""SELECT ord, name_key, business_idea FROM (SELECT *, lower({D.squash('company_name')}) AS name_key,
      row_number() OVER (PARTITION BY lower({D.squash('company_name')}) ORDER BY length(coalesce(business_idea, '')) DESC, ord) AS n FROM claims)
    WHERE n = 1 AND name_key <> ''""",
)
def dedupe_companies(t: Tables):
    rows = K.dedupe_companies(t("claims"))
    return rows.select("ord", F.lower(F.trim("company_name")).alias("name_key"), "business_idea")
