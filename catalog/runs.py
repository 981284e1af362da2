"""Whole runs, the extraction hook and the streaming jobs over the given tables."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import functions as F

from catalog import duck as D
from catalog.identity import RESOLVED_SQL
from catalog.news import ARTICLES_SQL, ATTACHED_SQL, BUCKET_SQL, GROUPS_SQL, REGION_SQL, RELEVANT_SQL, VALIDATED_SQL
from catalog.pages import EMAIL_BARE, EMAIL_LINKED, ENRICH_SQL, HREF_SQL
from catalog.registry import Tables, query
from catalog.scores import SCORED_SQL, V1_POINTS, V1_SCORE
from upswell import config as C
from upswell.operators import claims as K
from upswell.operators.merge import read_merged
from upswell.operators.quality import side_by_side
from upswell.plans.legacy import refresh_v1 as run_v1_articles
from upswell.plans.legacy import run_v1_refresh as run_v1
from upswell.plans.news import run_news_refresh as run_news
from upswell.plans.refresh import RefreshInputs, run_ranking_refresh as run_ranking
from upswell.session import shared_folder
from upswell.sources.feeds import dedupe_links
from upswell.streaming import stream_event_upserts as write_events
from upswell.streaming import stream_news as news_stream


def quote_first_words(prompt: str) -> tuple[str | None, str]:
    """Rule-based stand-in for a model: one claim per snippet, quoting its summary."""
    out = []
    for part in re.split(r"\n\n(?=\d+\. TITLE: )", prompt):
        head, _, summary = part.partition("\n   SUMMARY: ")
        index = head.split(".", 1)[0]
        words = summary.split()
        out.append(
            {
                "company_name": " ".join(words[:2]), "event_type": "product_launch", "value": None,
                "evidence_excerpt": " ".join(words[:20]), "source_index": int(index), "confidence": 80, "status": "completed",
            }
        )
    return json.dumps(out), "rules"


@query(
    "apply_extractor", "EXT-2 TXT-11", "articles",
    ARTICLES_SQL + """, placed AS (SELECT *, row_number() OVER (ORDER BY source_ord, item_ord, link) - 1 AS i FROM firsts)
    SELECT CAST(i // 8 AS BIGINT) AS batch_id, count(*) AS n_claims, 'rules' AS provider FROM placed GROUP BY 1""",
)
def apply_extractor(t: Tables):
    batches = K.pack_batches(K.number_articles(dedupe_links(t("articles"))))
    parsed = K.parse_responses(K.apply_extractor(batches, quote_first_words))
    return parsed.select("batch_id", F.size("records").cast("long").alias("n_claims"), "provider")


@query(
    "pack_company_batches", "TXT-11 PIPE-2", "startups",
    """, placed AS (SELECT *, row_number() OVER (ORDER BY company_name) - 1 AS i FROM startups)
    SELECT CAST(i // 6 AS BIGINT) AS batch_id, CAST(count(*) AS INT) AS n_companies, md5(string_agg(CAST(i % 6 + 1 AS VARCHAR) || '. COMPANY: ' || company_name || chr(10) || '   DESCRIPTION: ' || business_idea
      || chr(10) || '   WEBSITE TEXT: ' || CASE WHEN ord % 2 = 0 THEN '(none found)' ELSE 'we are ' || company_name END, chr(10) || chr(10) ORDER BY i)) AS prompt_md5 FROM placed GROUP BY 1""",
)
def pack_company_batches(t: Tables):
    about = F.when(F.col("ord") % 2 == 0, "").otherwise(F.concat(F.lit("we are "), "company_name"))
    numbered = K.number_companies(t("startups").withColumn("about_text", about))
    return K.pack_company_batches(numbered).select("batch_id", "n_companies", F.md5("prompt").alias("prompt_md5"))


@query(
    "run_news_refresh", "PIPE-3", "articles",
    ARTICLES_SQL + f""", top AS (SELECT * FROM firsts WHERE {RELEVANT_SQL} ORDER BY firsts.published_ts DESC NULLS LAST, source_ord, item_ord, link LIMIT 60),
    old AS (SELECT link, min(published_ts) AS fetched_at FROM articles WHERE link <> '' GROUP BY 1 HAVING min(published_ts) < TIMESTAMP '2001-01-31')
    SELECT coalesce(top.link, old.link) AS link, old.link IS NULL AS is_new FROM old FULL JOIN top ON top.link = old.link
    WHERE old.link IS NULL OR old.fetched_at >= TIMESTAMP '2001-02-01 00:00:01' - INTERVAL 14 DAY""",
)
def run_news_refresh(t: Tables):
    stored = t("articles").filter("link <> ''").groupBy("link").agg(
        F.min("published_ts").alias("fetched_at"), F.min("title").alias("title"), F.min("source_name").alias("source_name"),
        F.min("published_ts").alias("published_ts"),
    ).filter(F.col("fetched_at") < F.lit("2001-01-31").cast("timestamp"))
    # a link seen for the first time carries a later clock, so it can be told from a stored one
    later = F.lit("2001-02-01 00:00:01").cast("timestamp")
    rows = run_news(t("articles"), stored, later, top_k=C.NEWS_TOP_K, keep_days=14)
    return rows.select("link", (F.col("fetched_at") == later).alias("is_new"))


_V1_HOST = "lower(regexp_extract(raw, '^https?://(?:www[.])?([^/]+)', 1))"


def _first_link(source: str, out: str) -> str:
    """First link of ``source(ord, html)`` that the older list allows."""
    raw = f"regexp_extract_all(html, '{HREF_SQL}', 1)"
    return f""", {out} AS (SELECT ord, arg_min(regexp_replace(raw, '(?s)[?].*$', ''), i) AS homepage FROM (SELECT ord, unnest({raw}) AS raw, generate_subscripts({raw}, 1) AS i FROM {source})
      WHERE {_V1_HOST} <> '' AND NOT {D.denylisted(_V1_HOST, C.DENYLIST_V1)} GROUP BY ord)"""


_ALL = "coalesce(h.html, '') || ' ' || coalesce(a.html, '') || ' ' || CASE WHEN coalesce(a.html, '') = '' THEN coalesce(m.html, '') ELSE '' END"
V1_RUN_SQL = (
    ", recs AS (SELECT s.*, a.link AS source_url FROM startups s LEFT JOIN site_articles a ON a.page_id = s.ord)"
    ", arts AS (SELECT link, min(summary) AS html FROM site_articles GROUP BY 1), ok AS (SELECT url, html FROM crawl WHERE status_code = 200)"
    ", sums AS (SELECT ord, html FROM recs JOIN arts ON link = source_url)" + _first_link("sums", "h1")
    + ", bodies AS (SELECT ord, html FROM recs JOIN ok ON url = source_url WHERE ord NOT IN (SELECT ord FROM h1))" + _first_link("bodies", "h2")
    + f""", homes AS (SELECT *, regexp_replace(homepage, '/+$', '') AS base FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2)),
    facts AS (SELECT homes.ord, homepage, {_ALL} AS whole, c.html AS careers FROM homes LEFT JOIN ok h ON h.url = homepage LEFT JOIN ok a ON a.url = base || '/about'
      LEFT JOIN ok m ON m.url = base || '/team' LEFT JOIN ok c ON c.url = base || '/careers'),
    found AS (SELECT ord, homepage, coalesce(nullif(regexp_extract(whole, '{EMAIL_LINKED}', 1), ''), nullif(regexp_extract(whole, '{EMAIL_BARE}', 1), '')) AS contact_email,
      CASE WHEN {D.contains_any('lower(whole)', C.HIRING_PHRASES_V1)} OR coalesce(careers, '') <> '' THEN 'Likely hiring' ELSE 'Unknown' END AS hiring_status FROM facts),
    located AS (SELECT r.* EXCLUDE (hiring_status, contact_email, homepage), r.region AS location, f.homepage, f.contact_email, coalesce(f.hiring_status, 'Unknown') AS hiring_status FROM recs r LEFT JOIN found f USING (ord)),
    points AS ({V1_POINTS.replace('FROM startups)', 'FROM located)')})"""
)
_FILLED = " + ".join(f"CASE WHEN coalesce({f}, '') <> '' THEN 1 ELSE 0 END" for f in C.CONFIDENCE_FIELDS_V1)


@query(
    "run_v1_refresh", "PIPE-2 AGG-2 TXT-7 TXT-9 AMT-2 SCR-8 SCR-9", "startups site_articles crawl",
    V1_RUN_SQL + f""" SELECT company_name, {REGION_SQL} AS region, usd AS funding_amount_usd, homepage, hiring_status, contact_email, {V1_SCORE} AS momentum_score,
      CAST(round_even(100.0::DOUBLE * ({_FILLED}) / 8, 0) AS INT) AS data_confidence FROM points""",
)
def run_v1_refresh(t: Tables):
    """Records named by customer, each citing a page of the crawl."""
    sites = t("site_articles").select(F.col("page_id").alias("ord"), F.col("link").alias("source_url"))
    records = t("startups").select(
        "company_name", "business_idea", "industry", "funding_stage", "funding_amount", "investors", "founder_name",
        "year_founded", F.col("region").alias("location"), "ord",
    ).join(sites, "ord", "left")
    articles = t("site_articles").groupBy("link").agg(F.min("summary").alias("summary"))
    out = run_v1(records, articles, t("crawl"))
    return out.select("company_name", "region", "funding_amount_usd", "homepage", "hiring_status", "contact_email", "momentum_score", "data_confidence")


_WHOLE_V1 = V1_RUN_SQL.replace(
    "recs AS (SELECT s.*, a.link AS source_url FROM startups s LEFT JOIN site_articles a ON a.page_id = s.ord)",
    "recs AS (SELECT s.*, a.link AS source_url FROM startups s LEFT JOIN run_numbered a ON a.batch_id * 8 + a.source_index - 1 = s.ord)",
).replace("FROM site_articles GROUP BY 1", "FROM run_numbered GROUP BY 1")


@query(
    "run_v1_whole", "PIPE-2 SNK-1 SNK-6 SNK-7 AGG-2", "startups run_numbered crawl",
    _WHOLE_V1 + f""", rows AS (SELECT company_name, {V1_SCORE} AS momentum_score, CAST(round_even(100.0::DOUBLE * ({_FILLED}) / 8, 0) AS INT) AS data_confidence FROM points)
    SELECT company_name, momentum_score, data_confidence, (SELECT count(*) FROM run_numbered) AS articles_scanned, (SELECT count(*) FROM rows) AS startups_found,
      (SELECT count(*) FROM rows) AS stored FROM rows""",
)
def run_v1_whole(t: Tables):
    """From articles and answers to snapshots and log; every second company is known before, with nothing but its name."""
    names = ["company_name", "business_idea", "industry", "funding_stage", "funding_amount", "investors", "founder_name", "year_founded"]
    row = F.to_json(F.struct(*names, F.col("region").alias("location"), (F.col("ord") % 8 + 1).cast("int").alias("source_index")), {"ignoreNullFields": "false"})
    batch = F.floor(F.col("ord") / 8).alias("batch_id")
    parts = F.sort_array(F.collect_list(F.struct("ord", row.alias("raw"))))
    body = t("startups").groupBy(batch).agg(F.concat(F.lit("["), F.array_join(F.transform(parts, lambda p: p["raw"]), ", "), F.lit("]")).alias("content"))
    known = t("startups").select("company_name").filter(F.crc32(F.col("company_name").cast("binary")) % 2 == 0)
    result = run_v1_articles(refresh_inputs(t).articles, t("crawl"), known, t.now.cast("timestamp"), body.select("batch_id", F.lit("model").alias("provider"), "content"))
    total = result.startups.agg(F.count(F.lit(1)).alias("stored"))
    one = side_by_side([result.log.select("articles_scanned", "startups_found"), total])
    return result.snapshots.select("company_name", "momentum_score", "data_confidence").join(one, F.lit(True))


def refresh_inputs(t: Tables) -> RefreshInputs:
    """Articles numbered the way the stored answers number them; answers, pages, known
    companies, aliases and history all come from the given tables."""
    articles = t("run_numbered").withColumn("source_ord", F.lit(0)).withColumn(
        "item_ord", (F.col("batch_id") * 8 + F.col("source_index") - 1).cast("int")
    ).drop("batch_id", "source_index")
    return RefreshInputs(
        articles=articles, pages=t("crawl"),
        companies=t("companies").withColumns(
            {
                "data_confidence": F.lit(50), "verified_open_role_count": F.lit(None).cast("int"),
            }
        ).drop("key", "days_since_verified"),
        aliases=t("aliases"), events=t("company_events"), responses=quoted_responses(t),
    )


def quoted_responses(t: Tables):
    """Answers whose quotes come from the cited document."""
    c = t("run_claims")
    fields = ["company_name", "business_idea", "industry", "location", "event_type", "value", "investors", "evidence_excerpt", "source_index", "status"]
    row = F.to_json(F.struct(*fields, F.col("confidence").cast("int").alias("confidence")), {"ignoreNullFields": "false"})
    parts = F.sort_array(F.collect_list(F.struct("ord", row.alias("raw"))))
    body = c.groupBy("batch_id").agg(
        F.concat(F.lit("["), F.array_join(F.transform(parts, lambda p: p["raw"]), ", "), F.lit("]")).alias("json")
    )
    b = F.col("batch_id")
    content = F.when(b % 14 == 0, None).when(b % 4 == 0, F.concat(F.lit("```json\n"), F.col("json"), F.lit("\n```"))).otherwise(F.col("json"))
    return body.select("batch_id", F.lit("model-a").alias("provider"), content.alias("content"))


_RUN_ATTACHED = ATTACHED_SQL.replace("claims c", "run_claims c").replace("numbered n", "run_numbered n").replace(
    "USING (batch_id, source_index))", "USING (batch_id, source_index) WHERE c.batch_id % 14 <> 0)"
)
_RUN_ENRICH = ENRICH_SQL.replace("site_groups", "g").replace("site_articles", "run_numbered").replace("signals", "careers_signals")
_RUN_RESOLVED = RESOLVED_SQL.replace("known_companies", "companies")
_F_AMT = D.amount("money_text")
_RUN_FACTS = f""", claimed AS (SELECT k.*, i.company_id, i.primary_domain AS own_domain, {D.registrable_domain('k.source_url')} AS domain,
      coalesce(nullif(evidence_excerpt, ''), nullif(value, ''), '') AS money_text, {D.statement_class('evidence_excerpt')} AS statement_class FROM keyed k JOIN identified i ON i.candidate_id = k.group_key),
  typed AS (SELECT *, CASE WHEN coalesce(domain = own_domain, false) THEN 1 WHEN domain IN ({D.quoted(C.TIER_2_DOMAINS)}) THEN 2 ELSE 3 END AS source_tier,
      event_type IN ('funding_round_completed', 'funding_round_announced') AND statement_class IN ('valuation', 'tam', 'fund_size') AS wrong,
      {_F_AMT} AS amount_original, CASE WHEN {_F_AMT} IS NOT NULL THEN {D.currency('money_text')} END AS currency FROM claimed),
  valued AS (SELECT *, CASE WHEN wrong THEN CASE WHEN statement_class = 'valuation' THEN 'valuation_report' ELSE 'other' END ELSE event_type END AS final_type,
      CASE WHEN wrong THEN 'ambiguous' ELSE status END AS final_status, CASE WHEN NOT wrong THEN round_even(amount_original / {D.rate('currency')}, 2) END AS usd FROM typed),
  new_facts AS (SELECT * FROM (SELECT *, CASE WHEN final_type IN ('funding_round_completed', 'funding_round_announced') THEN {D.stage('value')} END AS stage,
      row_number() OVER (PARTITION BY company_id, source_url, final_type ORDER BY ord DESC) AS n FROM valued) WHERE n = 1),
  history AS (SELECT company_id, event_type, verification_status, published_at, amount_usd, funding_stage, source_url, source_tier, title, evidence_text, ingest_ord FROM company_events
    UNION ALL SELECT company_id, final_type, final_status, published_at, usd, stage, source_url, source_tier, company_name, evidence_excerpt, ord FROM new_facts)"""


def _take(name: str, conf: str) -> str:
    new, old = f"i.{name}", f"k.{name}"
    return f"({D.populated(new)} AND (NOT {D.populated(old)} OR {new} = {old} OR {conf} >= 50))"


_OFFERS = [("homepage", "i.homepage_confidence"), ("primary_domain", "i.homepage_confidence"), ("description", "60"), ("industry", "60"), ("region_bucket", "70"), ("hiring_status", "i.hiring_confidence")]
_MERGED = ", ".join(f"CASE WHEN {_take(n, c)} THEN i.{n} ELSE k.{n} END AS {n}" for n, c in _OFFERS if n != "hiring_status")
_ANY = " OR ".join(_take(n, c) for n, c in _OFFERS)
_RUN_ROWS = f""", touched AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY first_ord) AS nth FROM identified) WHERE nth = 1),
  known_rows AS (SELECT k.company_id, i.company_name AS canonical_name, {_MERGED}, k.founded_year, k.founders, k.headquarters_country, i.homepage_confidence, i.hiring_status, i.hiring_confidence,
      k.moat_confidence, k.company_status, i.match_type = 'needs_review' AS entity_resolution_needs_review, CASE WHEN {_ANY} THEN 0 ELSE k.days_since_verified END AS days_since_verified, i.extraction_confidence
    FROM touched i JOIN companies k ON k.company_id = i.matched_id),
  new_rows AS (SELECT company_id, company_name AS canonical_name, homepage, primary_domain, description, industry, region_bucket, founded_year, NULL AS founders, NULL AS headquarters_country, homepage_confidence,
      hiring_status, hiring_confidence, 0 AS moat_confidence, 'operating' AS company_status, match_type = 'needs_review' AS entity_resolution_needs_review, 0 AS days_since_verified, extraction_confidence
    FROM touched WHERE matched_id IS NULL),
  run_rows AS (SELECT * FROM known_rows UNION ALL BY NAME SELECT * FROM new_rows),
  run_history AS (SELECT * FROM history WHERE company_id IN (SELECT company_id FROM run_rows))"""
_RUN_SCORED = (
    SCORED_SQL.replace("avg(extraction_confidence) AS extraction_confidence FROM company_events", "1 AS one FROM company_events")
    .replace("best_source_tier, extraction_confidence, coalesce", "best_source_tier, coalesce")
    .replace("FROM company_events", "FROM run_history").replace("companies c", "run_rows c")
)
RUN_SQL = (
    VALIDATED_SQL.replace(ATTACHED_SQL, _RUN_ATTACHED) + ", acc AS (SELECT * FROM checked WHERE len(errors) = 0)"
    + GROUPS_SQL.replace("FROM attached", "FROM acc") + ", g AS (SELECT group_key, company_name, source_url0 AS source_url FROM grouped)" + _RUN_ENRICH
    + f""", candidates AS (SELECT group_key AS candidate_id, company_name, NULL::VARCHAR AS headquarters_country, description, industry, founded_year, extraction_confidence, first_ord, homepage, homepage_confidence,
      primary_domain, coalesce(hiring_status, 'unknown') AS hiring_status, coalesce(hiring_confidence, 0) AS hiring_confidence, {BUCKET_SQL.format('(' + REGION_SQL + ')')} AS region_bucket
    FROM grouped LEFT JOIN homes USING (group_key) LEFT JOIN hiring USING (group_key))"""
    + _RUN_RESOLVED + _RUN_FACTS + _RUN_ROWS + _RUN_SCORED
)
RUN_INPUTS = "run_claims run_numbered crawl companies aliases company_events"


@query(
    "run_ranking_refresh", "PIPE-1 SNK-7 JOIN-4", RUN_INPUTS,
    RUN_SQL + """ SELECT company_id, canonical_name, region_bucket, data_confidence, independent_sources, funding_amount_usd, hiring_status, primary_domain,
      len(reasons) = 0 AS eligible, array_to_string(reasons, '; ') AS reasons FROM gated""",
)
def run_ranking_refresh(t: Tables):
    result = run_ranking(refresh_inputs(t), t.now, "run-1")
    return result.gated.select(
        "company_id", "canonical_name", "region_bucket", "data_confidence", "independent_sources", "funding_amount_usd",
        "hiring_status", "primary_domain", "eligible", F.array_join("reasons", "; ").alias("reasons"),
    )


@query(
    "run_refresh_snapshots", "PIPE-1 SNK-6 WIN-1", RUN_INPUTS,
    RUN_SQL + """ SELECT company_id, region_bucket, regional_rank, momentum_score, data_confidence, 'v2' AS score_version FROM ranked""",
)
def run_refresh_snapshots(t: Tables):
    result = run_ranking(refresh_inputs(t), t.now, "run-1")
    return result.snapshots.select("company_id", "region_bucket", "regional_rank", "momentum_score", "data_confidence", "score_version")


@query(
    "run_refresh_report", "PIPE-1 QLT-2 SNK-12 SNK-7", RUN_INPUTS,
    RUN_SQL + """ SELECT 'run-1' AS run_id, (SELECT count(*) FROM ranked) AS n_ranked, (SELECT count(*) FROM ranked WHERE region_bucket = 'US') AS ranked_us,
      (SELECT count(*) FROM gated WHERE list_contains(reasons, 'data confidence too low')) AS low_confidence, (SELECT count(*) FROM gated WHERE days_since_verified > 90) AS stale,
      (SELECT round_even(100.0::DOUBLE * count(*) FILTER (WHERE data_confidence >= 70) / greatest(count(*), 1), 1) FROM ranked) AS pct_conf,
      (SELECT count(*) FROM valued WHERE final_type IN ('funding_round_completed', 'funding_round_announced') AND usd IS NOT NULL AND statement_class = 'valuation') AS shown_valuations,
      (SELECT count(*) FROM touched) AS companies""",
)
def run_refresh_report(t: Tables):
    """The report as it is stored with the closed run row."""
    result = run_ranking(refresh_inputs(t), t.now, "run-1")
    r = F.col("quality_report")
    at = lambda m, k: F.coalesce(F.try_element_at(r[m], F.lit(k)), F.lit(0))
    return result.run.select(
        "run_id", r["n_ranked"].alias("n_ranked"), F.col("regional_result_counts")["US"].alias("ranked_us"),
        at("rejected_candidate_count_by_reason", "data confidence too low").alias("low_confidence"), r["stale_record_count"].alias("stale"),
        r["pct_ranked_with_confidence_ge_70"].alias("pct_conf"), r["valuation_shown_as_funding_count"].alias("shown_valuations"),
        (F.col("companies_accepted") + F.col("companies_rejected")).alias("companies"),
    )


@query(
    "record_run", "SNK-7 AGG-22", RUN_INPUTS,
    RUN_SQL + """ SELECT 'run-1' AS run_id, (SELECT count(*) FROM run_numbered) AS articles_fetched, (SELECT count(*) FROM acc) AS candidates_extracted,
      count(*) FILTER (WHERE len(reasons) = 0) AS companies_accepted, count(*) FILTER (WHERE len(reasons) > 0) AS companies_rejected FROM gated""",
)
def record_run(t: Tables):
    result = run_ranking(refresh_inputs(t), t.now, "run-1")
    return result.run.select("run_id", "articles_fetched", "candidates_extracted", "companies_accepted", "companies_rejected")


def fresh_folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def landed_stream(t: Tables, name: str, by: str):
    """A whole table as a stream of several micro-batches in a bad order: landed in three parts, the latest rows first."""
    rows, folder = t(name), fresh_folder(t, f"landed-{name}")
    cuts = rows.approxQuantile(by, [1 / 3, 2 / 3], 0.01) or [0.0, 0.0]
    third = F.when(F.col(by) > cuts[1], 2).when(F.col(by) > cuts[0], 1).otherwise(0)
    for k in (2, 1, 0):
        rows.filter(third == k).write.mode("append").parquet(folder)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(folder)


@query(
    "stream_news", "STR-1", "",
    f""", news AS (SELECT split_part(text, chr(10), 1) AS title, text AS summary, 'https://feed.example.com/' || md5(text) AS link FROM documents)
    SELECT DISTINCT link FROM news WHERE {RELEVANT_SQL}""".replace(", news AS", "WITH news AS", 1),
)
def stream_news(t: Tables):
    source = landed_stream(t, "documents", "doc_id").select(
        F.split("text", "\n").getItem(0).alias("title"), F.col("text").alias("summary"),
        F.concat(F.lit("https://feed.example.com/"), F.md5("text")).alias("link"),
        F.timestamp_seconds(978307200 + F.col("doc_id") * 60).alias("fetched_at"),
    )
    root = fresh_folder(t, "news")
    run = news_stream(source).writeStream.format("parquet").option("checkpointLocation", f"{root}/state").option(
        "path", f"{root}/rows"
    ).trigger(availableNow=True).start()
    run.awaitTermination()
    return t.spark.read.parquet(f"{root}/rows").select("link")


@query(
    "stream_event_upserts", "STR-2 SNK-1", "",
    """SELECT CAST(o_custkey AS VARCHAR) AS company_id, 'https://news.example.com/' || CAST(o_orderkey % 3 AS VARCHAR) AS source_url, o_orderpriority AS event_type, max(o_orderkey) AS ingest_ord
    FROM orders GROUP BY 1, 2, 3""",
)
def stream_event_upserts(t: Tables):
    source = landed_stream(t, "orders", "o_orderkey").select(
        F.col("o_custkey").cast("string").alias("company_id"),
        F.concat(F.lit("https://news.example.com/"), (F.col("o_orderkey") % 3).cast("string")).alias("source_url"),
        F.col("o_orderpriority").alias("event_type"), F.col("o_orderkey").alias("ingest_ord"),
    )
    root = fresh_folder(t, "events")
    run = write_events(source, f"{root}/table", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return read_merged(t.spark, f"{root}/table")

