"""Event facts from accepted claims: amounts, currency, statement class, stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions import money as M
from upswell.functions.text import null_if_blank
from upswell.operators.common import keep_first
from upswell.operators.resolve import classify_source_tiers, own_domain_flag


def extract_amounts(df: DataFrame, text: str = "evidence_text") -> DataFrame:
    """Add ``amount_original`` and ``currency`` from the first money-like piece."""
    parts = F.col("_parts")
    found = df.withColumn("_parts", M.amount_parts(F.col(text)))
    value = M.amount_value(parts)
    return found.withColumns(
        {"amount_original": value, "currency": F.when(value.isNotNull(), M.amount_currency(parts))}
    ).drop("_parts")


def extract_amounts_v1(df: DataFrame, text: str = "funding_amount") -> DataFrame:
    return df.withColumn("funding_amount_usd", M.dollar_amount(F.col(text)))


def convert_currency(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Add ``amount_usd``, the rate and its date; all NULL without amount or a known currency."""
    known = rates.select(
        F.col("currency").alias("_cur"), F.col("per_usd").alias("currency_conversion_rate"),
        F.col("as_of").alias("conversion_rate_date"),
    )
    usable = F.when(F.col("amount_original").isNotNull(), F.upper("currency"))
    out = df.join(known, usable == F.col("_cur"), "left").drop("_cur")
    return out.withColumn("amount_usd", F.bround(F.col("amount_original") / F.col("currency_conversion_rate"), 2))


def classify_funding_text(df: DataFrame, text: str = "evidence_text") -> DataFrame:
    return df.withColumn("statement_class", M.statement_class(F.col(text)))


def normalize_stage(df: DataFrame, text: str = "value") -> DataFrame:
    return df.withColumn("funding_stage", M.funding_stage(F.col(text)))


def reconcile_funding_claims(df: DataFrame) -> DataFrame:
    """A "funding round" whose text reads as a valuation, market size or fund size is
    relabelled, made ambiguous, and loses its dollar amount."""
    wrong = F.coalesce(
        F.col("event_type").isin(C.FUNDING_TYPES) & F.col("statement_class").isin("valuation", "tam", "fund_size"),
        F.lit(False),
    )
    relabel = F.when(F.col("statement_class") == "valuation", "valuation_report").otherwise("other")
    return (
        df.withColumn("_wrong", wrong)
        .withColumn("event_type", F.when(F.col("_wrong"), relabel).otherwise(F.col("event_type")))
        .withColumn("verification_status", F.when(F.col("_wrong"), "ambiguous").otherwise(F.col("verification_status")))
        .withColumn("amount_usd", F.when(~F.col("_wrong"), F.col("amount_usd")))
        .drop("_wrong")
    )


def dedupe_events(events: DataFrame) -> DataFrame:
    """One event per (company, source URL, type); the last written wins."""
    return keep_first(events, ["company_id", "source_url", "event_type"], [F.col("ingest_ord").desc()])


def event_facts(claims: DataFrame, rates: DataFrame) -> DataFrame:
    """Claims with ``company_id`` and ``source_tier`` as event rows, before the key dedupe."""
    text = F.coalesce(null_if_blank(F.col("evidence_excerpt")), null_if_blank(F.col("value")), F.lit(""))
    base = claims.withColumn("evidence_text", F.col("evidence_excerpt")).withColumn("_money", text).withColumnRenamed(
        "status", "verification_status"
    )
    facts = convert_currency(extract_amounts(base, "_money").drop("_money"), rates)
    facts = reconcile_funding_claims(classify_funding_text(facts))
    stage = F.when(F.col("event_type").isin(C.FUNDING_TYPES), M.funding_stage(F.col("value")))
    return facts.select(
        "company_id", "event_type", F.lit(None).cast("date").alias("event_date"), "published_at",
        F.col("company_name").alias("title"), F.col("business_idea").alias("summary"),
        "amount_original", "currency", "amount_usd", "currency_conversion_rate", "conversion_rate_date",
        stage.alias("funding_stage"), "investors", "source_url", "source_name", "source_tier", "evidence_text",
        "extraction_provider", F.col("confidence").cast("int").alias("extraction_confidence"),
        "verification_status", "statement_class", F.col("ord").alias("ingest_ord"),
    )


def build_event_facts(claims: DataFrame, companies: DataFrame, tiers: DataFrame, rates: DataFrame, key: str = "company_id") -> DataFrame:
    """Event rows of accepted claims: what a source on the company's own domain says is of tier 1, else its domain decides; amounts, stage and
    statement class come from the text.

    ``claims`` have company_id and ``key``; ``companies`` one row per ``key`` with primary_domain.
    """
    flagged = own_domain_flag(claims, companies, key)
    return event_facts(classify_source_tiers(flagged, tiers), rates)


def event_sources(events: DataFrame) -> DataFrame:
    """Source rows of the events, newest first, for the independence count."""
    return events.filter(F.coalesce("source_url", F.lit("")) != "").select(
        "company_id", F.col("source_url").alias("url"), "title", F.col("evidence_text").alias("body"),
        F.struct(
            (-F.unix_micros(F.col("published_at").cast("timestamp"))).alias("newest"), F.col("ingest_ord").alias("seq")
        ).alias("ord"),
    )

