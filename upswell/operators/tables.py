"""Writes: merges by key, field-level merge, snapshots, run rows, publishing.

Stored tables are Parquet folders. A merge never rewrites the folder it reads: it
writes the next version folder and then appends one row naming it to a small log,
so a lost job leaves the current version as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from upswell import config as C
from upswell import schemas
from upswell.functions.text import is_populated
from upswell.operators.common import keep_first


def upsert_by_key(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None, keep: Sequence[str] = (), newest: str | None = None
) -> DataFrame:
    """Insert or merge. Columns the batch lacks keep the stored value; of two batch rows
    with one key the first in ``order`` is used.

    Columns of ``keep`` are set on insert only: a stored row keeps its own. With ``newest`` a stored row
    that has more of that column than the batch's stays as it is.
    """
    keys = list(keys)
    new = keep_first(batch, keys, order) if order else batch.dropDuplicates(keys)
    new_cols = [c for c in new.columns if c not in keys]
    t = target.withColumn("_stored", F.lit(True))
    b = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in new_cols], F.lit(True).alias("_incoming"))
    joined = t.join(b, keys, "full_outer")
    taken = F.coalesce("_incoming", F.lit(False))
    if newest is not None:
        taken = taken & F.coalesce(F.col(f"_new_{newest}") >= F.col(newest), F.lit(True))
    out = list(keys)
    for c in [x for x in target.columns if x not in keys] + [x for x in new_cols if x not in target.columns]:
        stored = F.col(c) if c in target.columns else F.lit(None)
        if c in new_cols:
            use = taken & F.col("_stored").isNull() if c in keep else taken
            out.append(F.when(use, F.col(f"_new_{c}")).otherwise(stored).alias(c))
        else:
            out.append(stored.alias(c))
    return joined.select(out)


VERSION_LOG = "version long, stream string, batch long"


def read_if_there(spark: SparkSession, root: str, schema: str) -> DataFrame | None:
    """A stored Parquet table, or None where its folder does not exist; every other error is one."""
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_version(spark: SparkSession, root: str) -> int | None:
    log = read_if_there(spark, f"{root}/log", "version long")
    return None if log is None else log.agg(F.max("version").alias("v")).first().v


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    version = current_version(spark, root)
    return None if version is None else spark.read.parquet(f"{root}/version={version}")


def batch_done(spark: SparkSession, root: str, stream: str, batch: int) -> bool:
    """Whether a version holds this micro-batch of this streaming query."""
    if current_version(spark, root) is None:
        return False
    log = spark.read.schema(VERSION_LOG).parquet(f"{root}/log")
    return not log.filter((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()


def write_version(df: DataFrame, root: str, version: int, current: bool = True, stream: str | None = None, batch: int | None = None) -> None:
    """Write one version folder; ``current=False`` stores it without publishing it.

    The log keeps which micro-batch of which streaming query made the version.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    known = current_version(spark, root)
    if current and (known is None or known < version):
        row = [F.col("id").alias("version"), F.lit(stream).cast("string").alias("stream"), F.lit(batch).cast("long").alias("batch")]
        spark.range(version, version + 1).select(row).coalesce(1).write.mode("append").parquet(
            f"{root}/log"
        )


def to_fields(rows: DataFrame, fields: Sequence[str], confidence: str = "confidence", tier: str = "tier") -> DataFrame:
    """Wide company rows as ``company_id, field, value, confidence, tier``."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return rows.select("company_id", F.explode(pairs).alias("_pair"), F.col(confidence).alias("confidence"), F.col(tier).alias("tier")).select(
        "company_id", "_pair.field", "_pair.value", "confidence", "tier"
    )


def preserve_fields(updates: DataFrame) -> DataFrame:
    """Decide each field update. Adds ``accept, decision, contradiction, merged_value``.

    Needs existing/new value, confidence and tier, and ``clearly_newer``.
    """
    old, new = F.col("existing_value"), F.col("new_value")
    yes = lambda c: F.coalesce(c, F.lit(False))
    better = (
        yes(F.col("new_tier") <= F.col("existing_tier"))
        | yes(F.col("new_confidence") >= F.col("existing_confidence"))
        | yes(F.col("clearly_newer"))
    )
    decision = (
        F.when(~is_populated(new), "kept: new value unknown")
        .when(~is_populated(old), "taken: nothing stored")
        .when(new == old, "reconfirmed")
        .when(better, "taken: equal or better evidence")
        .otherwise("kept: stored evidence is better")
    )
    out = updates.withColumn("decision", decision)
    took = F.col("decision").startswith("taken") | (F.col("decision") == "reconfirmed")
    return (
        out.withColumn("accept", took)
        .withColumn("contradiction", F.col("decision") == "kept: stored evidence is better")
        .withColumn("merged_value", F.when(F.col("accept"), new).otherwise(old))
    )


def accepted_fields(decided: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Merged values back as one row per company, and whether any fact was verified."""
    return decided.groupBy("company_id").agg(
        *[F.max(F.when(F.col("field") == f, F.col("merged_value"))).alias(f) for f in fields],
        F.bool_or("accept").alias("fact_verified"),
    )


def apply_timestamps(df: DataFrame, now: Column) -> DataFrame:
    """``last_seen`` moves when a company was seen, ``last_verified`` only when a fact was."""
    seen = F.when(F.col("rediscovered"), now).otherwise(F.coalesce("last_seen", now))
    checked = F.when(F.col("fact_verified"), now).otherwise(F.coalesce("last_verified", now))
    return df.withColumns({"last_seen": seen, "last_verified": checked})


def field_provenance(decided: DataFrame, run_date: Column) -> DataFrame:
    """One row per offered field value, contradictions marked."""
    return decided.filter(is_populated(F.col("new_value"))).select(
        "company_id", F.col("field").alias("field_name"), F.col("new_value").alias("field_value"),
        F.col("new_tier").alias("source_tier"), F.col("new_confidence").alias("confidence"),
        F.col("contradiction").alias("is_contradiction"), run_date.alias("run_date"),
    )


def append_run(rows: DataFrame, root: str, version: int, *partitions: str) -> None:
    """Add one run's rows to a log-like table. Each run has a folder of its own, so a run
    that is repeated after a failure replaces its rows instead of doubling them."""
    rows.write.mode("overwrite").partitionBy(*partitions).parquet(f"{root}/run_version={version}")


def write_field_provenance(rows: DataFrame, root: str, version: int) -> None:
    append_run(rows, root, version, "run_date")


def snapshot_rows(ranked: DataFrame, run_ts: Column) -> DataFrame:
    components = [x for c in C.WEIGHTS for x in (F.lit(c), F.col(c).cast("int"))]
    return ranked.select(
        "company_id", run_ts.alias("run_ts"), F.to_date(run_ts).alias("run_date"), "region_bucket", "regional_rank",
        "momentum_score", "data_confidence", "score_version", F.create_map(*components).alias("component_scores"),
    )


def append_snapshots(snapshots: DataFrame, root: str, version: int) -> None:
    append_run(snapshots, root, version, "run_date", "region_bucket")


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` in its order and types; those ``df`` lacks are null, others go."""
    kinds = T.StructType.fromDDL(schema)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds])


def open_run(spark: SparkSession, run_id: str, started_at: Column, workflow: str = "ranking_refresh") -> DataFrame:
    """The row of a run that has begun; the closed row has the same id."""
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(workflow).alias("workflow_type"), F.lit(C.SCORE_VERSION).alias("score_version"),
        started_at.alias("started_at"), F.lit("running").alias("run_status"), F.lit(False).alias("published"),
    )
    return conform(row, schemas.RUN)


def failed_run(opened: DataFrame, finished_at: Column, articles_fetched: int | None = None) -> DataFrame:
    """The closed row of a run that ended in an error."""
    closed = {"finished_at": finished_at.cast("timestamp"), "run_status": F.lit("failed"), "articles_fetched": F.lit(articles_fetched).cast("long")}
    return opened.withColumns(closed)


def run_states(rows: DataFrame) -> DataFrame:
    """One row per run: the latest closed one where there is one."""
    return keep_first(rows, ["run_id"], [F.col("finished_at").desc_nulls_last(), F.col("run_status")])


def append_run_state(row: DataFrame, root: str) -> None:
    """Add a state of a run. States are only ever added; ``run_states`` folds them, so one that is written twice counts once."""
    conform(row, schemas.RUN).coalesce(1).write.mode("append").parquet(root)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per run stored at ``root``; none where nothing is stored yet."""
    rows = read_if_there(spark, root, schemas.RUN)
    return run_states(spark.createDataFrame([], schemas.RUN) if rows is None else rows)


def record_run(counters: DataFrame, run_id: str, started_at: Column, finished_at: Column, status: Column, published: Column, report: Column | None = None) -> DataFrame:
    """The closed run row. ``report`` is the report as a struct; its regional counts are the run's."""
    kinds = T.StructType.fromDDL(schemas.QUALITY_REPORT)
    nested = F.lit(None).cast(kinds) if report is None else F.struct(*[report[f.name].cast(f.dataType).alias(f.name) for f in kinds])
    row = counters.select(
        F.lit(run_id).alias("run_id"), F.lit("ranking_refresh").alias("workflow_type"), F.lit(C.SCORE_VERSION).alias("score_version"),
        started_at.alias("started_at"), finished_at.alias("finished_at"), status.alias("run_status"), published.alias("published"), *counters.columns,
        nested.alias("quality_report"),
    )
    return conform(row.withColumn("regional_result_counts", F.col("quality_report.qualified_company_count_by_region")), schemas.RUN)


def insert_new_companies(resolved: DataFrame, now: Column) -> DataFrame:
    """Rows for companies not known yet, with the default field values; one per id."""
    new = keep_first(resolved.filter("matched_id is null"), ["company_id"], [F.col("first_ord")])
    take = lambda c, kind: (F.col(c) if c in resolved.columns else F.lit(None)).cast(kind).alias(c)
    return new.select(
        "company_id", F.col("company_name").alias("canonical_name"), F.col("group_key").alias("normalized_name"),
        take("primary_domain", "string"), take("homepage", "string"), take("homepage_confidence", "int"),
        take("description", "string"), take("industry", "string"), take("founded_year", "string"),
        take("region_bucket", "string"), F.coalesce("hiring_status", F.lit("unknown")).alias("hiring_status"),
        take("hiring_confidence", "int"), take("verified_open_role_count", "int"),
        F.col("needs_review").alias("entity_resolution_needs_review"),
        F.lit("operating").alias("company_status"), now.alias("last_seen"), now.alias("last_verified"),
        F.lit("Not yet verified").alias("moat_summary"), F.lit(0).alias("moat_confidence"),
        F.lit(True).alias("active"), F.lit(C.SCORE_VERSION).alias("score_version"),
    )


def prune_older_than(df: DataFrame, ts: str, now: Column, days: int = C.NEWS_KEEP_DAYS) -> DataFrame:
    return df.filter(F.col(ts) >= now - F.expr(f"interval {int(days)} days"))


def backfill_companies(startups: DataFrame, companies: DataFrame) -> DataFrame:
    """Older rows as new companies; a row that meets a known or earlier row on either
    unique key is skipped. Normalisation is the simple inline one of the backfill."""
    # blanks of the same kinds the regex class of the stored procedure knows
    name = F.lower(F.regexp_replace(F.regexp_replace("company_name", "[,.]", " "), r"\s+", " "))
    domain = F.when(
        F.col("homepage").rlike("^https?://[^/]+"),
        F.regexp_replace(F.regexp_replace("homepage", r"^https?://(www\.)?", ""), "(?s)/.*$", ""),
    )
    bucket = (
        F.when(F.col("region").ilike("%india%"), "INDIA").when(F.col("region").ilike("%usa%"), "US")
        .when(F.col("region").isNotNull() & (F.col("region") != "Unknown"), "ROW")
    )
    rows = startups.filter("company_name is not null").select(
        F.col("company_name").alias("canonical_name"), name.alias("normalized_name"), domain.alias("primary_domain"),
        "homepage", F.col("business_idea").alias("description"), "industry",
        F.col("year_founded").alias("founded_year"), bucket.alias("region_bucket"), F.col("founder_name").alias("founders"),
        "momentum_score", "ord",
    ).withColumn("_d", F.coalesce("primary_domain", F.lit("")))
    known = companies.select("normalized_name", F.coalesce("primary_domain", F.lit("")).alias("_d"), "primary_domain")
    pairs = known.select("normalized_name", "_d").distinct()
    domains = known.filter("primary_domain is not null").select("primary_domain").distinct()
    fresh = rows.join(pairs, ["normalized_name", "_d"], "left_anti")
    # A kept row is the first with its domain; without one, the first with its name. The
    # (name, domain) key adds nothing where a domain is there.
    with_domain = keep_first(
        fresh.filter("primary_domain is not null").join(domains, "primary_domain", "left_anti"), ["primary_domain"], [F.col("ord")]
    )
    without = keep_first(fresh.filter("primary_domain is null"), ["normalized_name"], [F.col("ord")])
    return with_domain.unionByName(without).drop("_d", "ord")


def upgrade_legacy(df: DataFrame) -> DataFrame:
    """Old column names to new ones; frames already in the new form pass unchanged."""
    if "sector" in df.columns:
        df = df.withColumn("industry", F.coalesce("industry", "sector")).drop("sector")
    if "signal_score" in df.columns:
        df = df.withColumn("momentum_score", F.coalesce("momentum_score", F.col("signal_score") * 20)).drop("signal_score")
    return df.drop("domain")


def publish_ranking(companies: DataFrame, ranked: DataFrame, publish: bool) -> DataFrame:
    """Replace all rank columns when publishing, else keep those already there.
    Companies that dropped out lose their rank."""
    if not publish:
        return companies
    names = {
        "momentum_score": "momentum_score", "regional_rank": "regional_rank", "why_ranked": "why_ranked",
        "score_version": "score_version", "rank_change": "rank_change_since_previous_snapshot",
    }
    new = ranked.select("company_id", *[F.col(c).alias(n) for c, n in names.items() if c in ranked.columns])
    return companies.drop(*names.values()).join(new, "company_id", "left")


def check_constraints(events: DataFrame) -> DataFrame:
    """Violation counts of an event table, one row per rule."""
    key = ["company_id", "source_url", "event_type"]
    rules = events.agg(
        F.count_if(~F.coalesce(F.col("event_type").isin(C.EVENT_TYPES), F.lit(False))).alias("event_type not allowed"),
        F.count_if(~F.coalesce(F.col("verification_status").isin(C.VERIFICATION_STATUSES), F.lit(True))).alias("status not allowed"),
        F.count_if(F.col("company_id").isNull()).alias("company_id missing"),
        F.count_if(F.col("source_url").isNull()).alias("source_url missing"),
        F.count_if(F.col("evidence_text").isNull()).alias("evidence_text missing"),
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").alias("violations")) for c in rules.columns])
    doubled = events.groupBy(*key).count().filter("count > 1").agg(F.count(F.lit(1)).alias("violations"))
    return rules.select(F.explode(pairs).alias("_pair")).select("_pair.rule", "_pair.violations").unionByName(
        doubled.select(F.lit("key not unique").alias("rule"), "violations")
    )


