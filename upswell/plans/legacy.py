"""The older refresh: one record per company name and the four-part score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell import schemas
from upswell.functions.text import contains_any, contact_email, profile_link, text_or_empty, visible_text
from upswell.operators import claims as K
from upswell.operators import pages as W
from upswell.operators import quality as Q
from upswell.operators import scoring as P
from upswell.operators.common import keep_first
from upswell.operators.events import extract_amounts_v1
from upswell.operators.tables import upsert_by_key
from upswell.session import stored
from upswell.sources.feeds import dedupe_links


def first_homepage(records: DataFrame, articles: DataFrame, pages: DataFrame) -> DataFrame:
    """First usable link of the article summary, else of the article page."""
    named = records.select("name_key", "source_url")

    def first(rows: DataFrame) -> DataFrame:
        found = W.candidate_links_v1(rows.select("name_key", "html"))
        return keep_first(found, ["name_key"], [F.col("link_ord")]).select("name_key", F.col("link").alias("homepage"))

    summaries = W.attach_articles(named, articles).withColumnRenamed("article_summary", "html")
    by_summary = stored(first(summaries))
    bodies = pages.filter("status_code = 200").select(F.col("url").alias("source_url"), "html")
    by_page = first(named.join(by_summary, "name_key", "left_anti").join(bodies, "source_url", "inner"))
    return by_summary.unionByName(by_page)


def page_facts_v1(homepages: DataFrame, pages: DataFrame) -> DataFrame:
    """Profile, e-mail, text and hiring word of the homepage with its /about page, or
    its /team page when there is no /about."""
    ok = pages.filter("status_code = 200")
    base = F.regexp_replace("homepage", "/+$", "")
    out = homepages.withColumn("_base", base)
    for name, url in {
        "_home": F.col("homepage"), "_about": F.concat("_base", F.lit("/about")),
        "_team": F.concat("_base", F.lit("/team")), "_careers": F.concat("_base", F.lit("/careers")),
    }.items():
        side = ok.select(F.col("url").alias("_u"), F.col("html").alias(name))
        out = out.join(side, url == F.col("_u"), "left").drop("_u")
    about = text_or_empty(F.col("_about"))
    team = F.when(about == "", text_or_empty(F.col("_team"))).otherwise(F.lit(""))
    out = out.withColumn("_all", F.concat_ws(" ", text_or_empty(F.col("_home")), about, team))
    hiring = contains_any(F.lower("_all"), C.HIRING_PHRASES_V1) | (text_or_empty(F.col("_careers")) != "")
    return out.select(
        "name_key", "homepage", profile_link(F.col("_all")).alias("founder_linkedin"),
        contact_email(F.col("_all")).alias("contact_email"), visible_text(F.col("_all")).alias("about_text"),
        F.when(hiring, "Likely hiring").otherwise("Unknown").alias("hiring_status"),
    )


def run_v1_refresh(
    records: DataFrame, articles: DataFrame, pages: DataFrame, startups: DataFrame | None = None,
    weights: dict[str, float] | None = None, substring_regions: bool = False, refiner: K.Extractor | None = None,
) -> DataFrame:
    """Score one record per company name and merge it into ``startups`` by name.

    ``refiner`` is the user's function for founder, year and moat, called per batch of
    companies; without it those fields stay as they came.
    """
    best = K.dedupe_companies(records).withColumn("name_key", F.lower(F.trim("company_name")))
    facts = page_facts_v1(first_homepage(best, articles, pages), pages)
    rows = best.join(facts, "name_key", "left").withColumn("hiring_status", F.coalesce("hiring_status", F.lit("Unknown")))
    if refiner is not None:
        numbered = stored(K.number_companies(rows.drop("founder_name", "year_founded", "unique_moat")))
        answers = stored(K.parse_responses(K.apply_extractor(K.pack_company_batches(numbered), refiner)))
        rows = K.attach_refined(numbered, answers)
    for c in ("founder_name", "year_founded"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    rows = extract_amounts_v1(K.classify_region(rows, substring=substring_regions))
    rows = P.data_confidence_v1(P.momentum_score_v1(rows, weights)).drop("name_key", "about_text", "ord")
    return rows if startups is None else upsert_by_key(startups, rows, ["company_name"])


@dataclass
class V1Result:
    """The merged table, a snapshot per record of this run, and the run's log row."""

    startups: DataFrame
    snapshots: DataFrame
    log: DataFrame


def refresh_v1(
    articles: DataFrame, pages: DataFrame, startups: DataFrame, run_ts: Column, responses: DataFrame | None = None, extractor: K.Extractor | None = None,
    refiner: K.Extractor | None = None, weights: dict[str, float] | None = None,
) -> V1Result:
    """The older run from articles to snapshots and log: number, extract (or take ``responses``), cite, one record per company, enrich, score, merge by name.

    A record that cites no article of its batch is kept without a source. The run fails if every extraction batch did.
    """
    unique = dedupe_links(articles)
    numbered = K.number_articles(unique)
    if responses is None:
        if extractor is None:
            raise ValueError("give responses or an extractor")
        responses = K.apply_extractor(K.pack_batches(numbered), extractor)
    parsed = stored(K.parse_responses(responses))
    failure = Q.batch_failure_rate(parsed).first()
    if failure.all_failed:
        raise RuntimeError(f"every extraction batch failed ({failure.n_failed}/{failure.n_batches})")
    records = K.attach_sources(K.explode_claims(parsed, schemas.STARTUP_RECORD), numbered)
    records = stored(records.drop("source_text", "present", "batch_id", "claim_pos", "extraction_provider", "source_index", "published_at"))
    summaries = unique.groupBy("link").agg(F.min("summary").alias("summary"))
    rows = stored(run_v1_refresh(records, summaries, pages, weights=weights, refiner=refiner))
    counted = Q.side_by_side([unique.agg(F.count(F.lit(1)).alias("articles_scanned")), rows.agg(F.count(F.lit(1)).alias("startups_found"))])
    return V1Result(
        upsert_by_key(startups, rows, ["company_name"]), rows.select("company_name", run_ts.alias("run_ts"), "momentum_score", "data_confidence"),
        counted.select(run_ts.alias("run_ts"), "articles_scanned", "startups_found"),
    )
