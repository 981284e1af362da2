"""The ranking refresh: from articles and model answers to a published ranking."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell import config as C
from upswell.operators import claims as K
from upswell.operators import events as E
from upswell.operators import pages as W
from upswell.operators import quality as Q
from upswell.operators import ranking as G
from upswell.operators import resolve as R
from upswell.operators import tables as B
from upswell.operators.common import keep_first
from upswell.operators.merge import merge_into, read_merged
from upswell.plans.ranking import score_companies
from upswell.plans.runs import judge_run, within_run
from upswell.session import stored
from upswell.sources.feeds import dedupe_links
from upswell.sources.stored import scan_aliases, scan_event_history, scan_identity

EVENT_KEY = ["company_id", "source_url", "event_type"]
PROVENANCE = ["company_id", "field_name", "field_value", "source_tier"]
MERGED_FIELDS = [
    # field, confidence of the new value, tier of the new value
    ("homepage", "homepage_confidence", 1),
    ("primary_domain", "homepage_confidence", 1),
    ("description", 60, 3),
    ("industry", 60, 3),
    ("region_bucket", 70, 2),
    ("hiring_status", "hiring_confidence", 1),
    ("verified_open_role_count", "hiring_confidence", 1),
]


# Columns a run computes anew, whatever an earlier run stored.
MEASURED = [
    "extraction_confidence", "best_source_tier", "data_confidence", "data_completeness", "days_since_verified",
    "latest_funding_stage", "latest_funding_amount_usd", "latest_funding_date", "total_disclosed_funding_usd",
]


@dataclass
class RefreshInputs:
    """Landed and stored frames of one run. Either ``responses`` (batch_id, provider,
    content; batches as numbered by the run) or ``extractor`` must be there. ``events`` is the
    stored history, or a function that gives it for the companies (company_id) of a frame."""

    articles: DataFrame
    pages: DataFrame
    companies: DataFrame
    aliases: DataFrame
    events: DataFrame | Callable[[DataFrame], DataFrame]
    responses: DataFrame | None = None
    extractor: K.Extractor | None = None
    runs: DataFrame | None = None
    provenance: DataFrame | None = None
    snapshots: DataFrame | None = None


@dataclass
class RefreshResult:
    companies: DataFrame
    events: DataFrame  # history of the companies this run touched
    ranked: DataFrame
    gated: DataFrame
    report: DataFrame
    snapshots: DataFrame
    provenance: DataFrame
    run: DataFrame
    publish: bool
    reason: str
    extras: dict[str, DataFrame] = field(default_factory=dict)


def offered_fields(found: DataFrame) -> DataFrame:
    """What this run says about each known company, one row per (company, field)."""
    parts = [
        F.struct(
            F.lit(name).alias("field"), F.col(name).cast("string").alias("new_value"),
            (F.col(conf) if isinstance(conf, str) else F.lit(conf)).cast("int").alias("new_confidence"),
            F.lit(tier).alias("new_tier"),
        )
        for name, conf, tier in MERGED_FIELDS
    ]
    rows = found.select("company_id", "first_ord", F.explode(F.array(*parts)).alias("_offer")).select("company_id", "first_ord", "_offer.*")
    known = rows.withColumn("_empty", F.col("new_value").isNull())
    return keep_first(known, ["company_id", "field"], [F.col("_empty"), F.col("first_ord")]).drop("_empty", "first_ord")


def merge_companies(found: DataFrame, companies: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Known companies with the accepted new values, and the decision rows."""
    names = [n for n, _, _ in MERGED_FIELDS]
    tier = F.col("best_source_tier") if "best_source_tier" in companies.columns else F.lit(None).cast("int")
    stored = companies.select(
        "company_id", F.col("data_confidence").alias("existing_confidence"), tier.alias("existing_tier"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("existing_value")) for n in names])).alias("_pair"),
    ).select("company_id", "_pair.field", "_pair.existing_value", "existing_confidence", "existing_tier")
    offers = offered_fields(found.filter("matched_id is not null"))
    decided = B.preserve_fields(
        offers.join(stored, ["company_id", "field"], "inner").withColumn("clearly_newer", F.lit(False))
    )
    merged = B.accepted_fields(decided, names)
    renamed = merged.select("company_id", "fact_verified", *[F.col(n).alias(f"_{n}") for n in names])
    rows = companies.join(renamed, "company_id", "left").withColumn("rediscovered", F.col("fact_verified").isNotNull())
    for n in names:
        kind = companies.schema[n].dataType
        rows = rows.withColumn(n, F.when(F.col("rediscovered"), F.col(f"_{n}").cast(kind)).otherwise(F.col(n)))
    changed = F.coalesce("fact_verified", F.lit(False))
    rows = rows.withColumn("fact_verified", changed)
    timed = B.apply_timestamps(rows.withColumns({"_seen": F.col("last_seen"), "_checked": F.col("last_verified")}), now)
    out = timed.withColumns(
        {
            "last_seen": F.when(F.col("rediscovered"), F.col("last_seen")).otherwise(F.col("_seen")),
            "last_verified": F.when(F.col("rediscovered"), F.col("last_verified")).otherwise(F.col("_checked")),
        }
    )
    return out.select(companies.columns), decided


def run_ranking_refresh(inputs: RefreshInputs, now: Column, run_id: str = "run") -> RefreshResult:
    """Run all stages; nothing is written. Frames that several stages read are stored
    once in the shared folder; the driver sees single-row decisions only."""
    spark: SparkSession = inputs.articles.sparkSession
    articles = dedupe_links(inputs.articles)
    numbered = K.number_articles(articles)

    # answers: a model call is made once per batch, so its result is stored
    answers = inputs.responses
    if answers is None:
        if inputs.extractor is None:
            raise ValueError("give responses or an extractor")
        answers = K.apply_extractor(K.pack_batches(numbered), inputs.extractor)
    parsed = stored(K.parse_responses(answers))
    failure = Q.batch_failure_rate(parsed).first()
    if failure.all_failed:
        raise RuntimeError(f"every extraction batch failed ({failure.n_failed}/{failure.n_batches})")

    # the cited texts are compared with once and not stored
    validated = stored(K.validate_claims(K.attach_sources(K.explode_claims(parsed), numbered)).drop("source_text"))
    accepted = K.with_group_key(K.accepted_claims(validated))
    groups = stored(K.group_claims(accepted))
    enriched = W.enrich_companies(groups, articles, inputs.pages).drop("company_name", "source_url")
    located = K.region_bucket(K.classify_region(R.attach_enrichment(groups, enriched)))
    candidates = located.withColumn("candidate_id", F.col("group_key")).withColumn(
        "headquarters_country", F.lit(None).cast("string")
    )
    found = stored(
        R.assign_company_ids(
            R.resolve_entities(candidates, scan_identity(inputs.companies), scan_aliases(inputs.aliases))
        )
    )

    merged, decided = merge_companies(found, inputs.companies, now)
    fresh = B.insert_new_companies(found, now)
    companies = merged.unionByName(fresh, allowMissingColumns=True)

    # event facts of this run join the stored history
    claims = accepted.join(found.select("group_key", "company_id"), "group_key", "inner")
    facts = E.build_event_facts(claims, found.select("group_key", "primary_domain"), C.tiers_frame(spark), C.rates_frame(spark), "group_key")
    # of the stored history only that of the companies this run touched is read
    known = inputs.events(found) if callable(inputs.events) else scan_event_history(inputs.events, found)
    history = stored(B.upsert_by_key(known, facts, EVENT_KEY, [F.col("ingest_ord").desc()]))

    # scores of these companies over their whole history
    names = found.groupBy("company_id").agg(F.count(F.lit(1)).alias("n_candidates"))
    touched = keep_first(found, ["company_id"], [F.col("first_ord")]).join(names, "company_id").select(
        "company_id", F.col("company_name").alias("_name"), F.col("homepage_confidence").alias("_hc"),
        F.col("hiring_status").alias("_hs"), F.col("hiring_confidence").alias("_hf"),
        F.col("needs_review").alias("_review"), "extraction_confidence", "n_candidates",
    )
    rows = companies.drop(*MEASURED)
    rows = rows.join(touched, "company_id", "inner").withColumns(
        {
            "canonical_name": F.col("_name"), "homepage_confidence": F.col("_hc"), "hiring_status": F.col("_hs"),
            "hiring_confidence": F.col("_hf"), "entity_resolution_needs_review": F.col("_review"),
            "days_since_verified": F.datediff(now, F.to_date("last_verified")),
        }
    ).drop("_name", "_hc", "_hs", "_hf", "_review", "resolution_confidence")
    said = B.field_provenance(decided, F.to_date(now)).select(*PROVENANCE)
    if inputs.provenance is not None:
        said = said.unionByName(inputs.provenance.select(*PROVENANCE).join(found.select("company_id").distinct(), "company_id", "left_semi"))
    scored = score_companies(
        rows, history.drop("extraction_confidence"), C.stage_thresholds_frame(spark), now, provenance=said
    )
    gated = stored(G.eligibility_gate(scored))
    ranked = G.rank_regions(gated.filter("eligible"))
    if inputs.snapshots is not None:
        ranked = G.previous_rank(ranked, inputs.snapshots, now)
    else:
        ranked = ranked.withColumn("rank_change", F.lit(None).cast("int"))
    ranked = stored(ranked)

    counters = Q.run_counters(articles, validated, gated)
    stamp = now.cast("timestamp")
    judged = judge_run(gated, ranked, facts, parsed, counters, inputs.runs, run_id, stamp, stamp)

    # confidence and funding facts are stored for every company; ranks only when published
    facts_cols = ["data_confidence", "data_completeness", "best_source_tier"]
    measured = gated.select(
        "company_id", *facts_cols, F.col("funding_stage").alias("latest_funding_stage"),
        F.col("funding_amount_usd").alias("latest_funding_amount_usd"), "latest_funding_date", "total_disclosed_funding_usd",
    )
    out = B.publish_ranking(B.upsert_by_key(companies, measured, ["company_id"]), ranked, judged.publish)
    return RefreshResult(
        companies=out, events=history, ranked=ranked, gated=gated, report=judged.report,
        snapshots=B.snapshot_rows(ranked, stamp), provenance=B.field_provenance(decided, F.to_date(now)),
        run=judged.run, publish=judged.publish, reason=judged.reason,
        extras={"validated": validated, "found": found, "facts": facts, "numbered": numbered},
    )


def store_refresh(result: RefreshResult, root: str, version: int) -> None:
    """Write a run: companies as a new version, the history of the companies it touched merged into their buckets, snapshots and, last of all,
    the closed run row appended. The ranking's version is made current only when the run publishes."""
    B.write_version(result.companies, f"{root}/companies", version)
    merge_into(result.events, f"{root}/events", EVENT_KEY, by=["company_id"])
    B.write_version(result.ranked, f"{root}/ranking", version, current=result.publish)
    if result.publish:
        B.append_snapshots(result.snapshots, f"{root}/snapshots", version)
    B.write_field_provenance(result.provenance, f"{root}/provenance", version)
    B.append_run_state(result.run, f"{root}/runs")


def refresh_stored(inputs: RefreshInputs, root: str, now: Column, run_id: str) -> RefreshResult:
    """One run over the tables at ``root``: opened there, read from there where they exist (companies, events), compared
    with the last published run there, and stored there. A run that raises leaves a failed row and all tables as they were."""
    spark = inputs.articles.sparkSession

    def work(runs: DataFrame) -> RefreshResult:
        known = B.read_current(spark, f"{root}/companies")
        if read_merged(spark, f"{root}/events") is None and not callable(inputs.events):
            merge_into(inputs.events, f"{root}/events", EVENT_KEY, by=["company_id"])
        history = lambda touched: read_merged(spark, f"{root}/events", touched, ["company_id"])
        events = (lambda touched: scan_event_history(history(touched), touched)) if read_merged(spark, f"{root}/events") is not None else inputs.events
        said = B.read_if_there(spark, f"{root}/provenance", "company_id string, field_name string, field_value string, source_tier int")
        said = inputs.provenance if said is None else said
        result = run_ranking_refresh(replace(inputs, runs=runs, provenance=said, companies=inputs.companies if known is None else known, events=events), now, run_id)
        latest = B.current_version(spark, f"{root}/companies")
        store_refresh(result, root, 0 if latest is None else latest + 1)
        return result

    stamp = now.cast("timestamp")
    return within_run(spark, f"{root}/runs", run_id, stamp, stamp, work, lambda: dedupe_links(inputs.articles).count())
