"""Which known company a candidate is; source tiers; text copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions.text import fingerprint, jaccard, name_key, normalize_name, null_if_blank
from upswell.functions.urls import registrable_domain
from upswell.operators.common import keep_first, spread_nulls


def normalize_names(df: DataFrame, col: str = "company_name") -> DataFrame:
    return df.withColumn("normalized_name", normalize_name(F.col(col)))


def description_similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.withColumn("similarity", jaccard(F.col(a), F.col(b)))


def resolve_entities(candidates: DataFrame, companies: DataFrame, aliases: DataFrame) -> DataFrame:
    """Match by domain, then recorded alias, then name with support.

    Each right side is reduced to one row per key first, so a candidate never
    multiplies; candidates without a key are spread instead of meeting in one task.
    Adds ``match_type, matched_id, resolution_confidence, needs_review``.
    """
    c = candidates.withColumn("_domain", registrable_domain(F.col("primary_domain"))).withColumn(
        "_name", null_if_blank(normalize_name(F.col("company_name")))
    )
    by_domain = (
        companies.select(registrable_domain(F.col("primary_domain")).alias("_d"), "company_id")
        .filter("_d is not null").groupBy("_d").agg(F.min("company_id").alias("domain_id"))
    )
    by_alias = (
        aliases.filter(F.coalesce("normalized_alias", F.lit("")) != "")
        .groupBy(F.col("normalized_alias").alias("_a")).agg(F.min("company_id").alias("alias_id"))
    )
    by_name = (
        companies.filter(F.coalesce("normalized_name", F.lit("")) != "")
        .groupBy(F.col("normalized_name").alias("_n"))
        .agg(
            F.count(F.lit(1)).alias("n_same_name"),
            F.min(F.struct("company_id", "headquarters_country", "description")).alias("_known"),
        )
    )
    out = (
        c.join(by_domain, spread_nulls(c["_domain"], c["candidate_id"]) == by_domain["_d"], "left")
        .join(by_alias, spread_nulls(c["_name"], c["candidate_id"]) == by_alias["_a"], "left")
        .join(by_name, spread_nulls(c["_name"], c["candidate_id"]) == by_name["_n"], "left")
    )
    same_hq = F.coalesce(
        (F.col("headquarters_country") == F.col("_known.headquarters_country")) & (F.col("headquarters_country") != ""),
        F.lit(False),
    )
    single = (F.col("n_same_name") == 1) & F.col("domain_id").isNull() & F.col("alias_id").isNull()
    similar = F.coalesce(
        F.when(single, jaccard(F.col("description"), F.col("_known.description"))) >= 0.2, F.lit(False)
    )
    ambiguous = F.col("_name").isin(C.AMBIGUOUS_NAMES)
    kind = (
        F.when(F.col("domain_id").isNotNull(), "domain")
        .when(F.col("alias_id").isNotNull(), "alias")
        .when(F.col("n_same_name").isNull(), "new")
        .when(F.col("n_same_name") > 1, "needs_review")
        .when(ambiguous & ~same_hq & ~similar, "needs_review")
        .otherwise("name")
    )
    out = out.withColumn("_hq", same_hq).withColumn("_sim", similar).withColumn("match_type", kind)
    kind = F.col("match_type")
    return (
        out.withColumn(
            "matched_id",
            F.when(kind == "domain", F.col("domain_id")).when(kind == "alias", F.col("alias_id"))
            .when(kind == "name", F.col("_known.company_id")),
        )
        .withColumn(
            "resolution_confidence",
            F.when(kind == "domain", 100).when(kind == "alias", 90)
            .when(
                kind == "name",
                F.lit(60) + F.when(F.col("_hq"), 15).otherwise(0) + F.when(F.col("_sim"), 15).otherwise(0),
            )
            .otherwise(0),
        )
        .withColumn("needs_review", kind == "needs_review")
        .drop(
            "_domain", "_name", "_d", "_a", "_n", "_hq", "_sim", "domain_id", "alias_id", "n_same_name", "_known",
        )
    )


def assign_company_ids(resolved: DataFrame, domain: str = "primary_domain", name: str = "company_name") -> DataFrame:
    """Id of the matched company, or a hash of domain (else name) for a new one.

    Two new candidates of one run that share a domain get the same id, so they
    become one company.
    """
    identity = F.coalesce(registrable_domain(F.col(domain)), name_key(F.col(name)))
    return resolved.withColumn("company_id", F.coalesce("matched_id", F.sha2(identity, 256)))


def attach_existing(resolved: DataFrame, companies: DataFrame) -> DataFrame:
    """Stored rows of the resolved candidates; what does not match goes to
    :func:`upswell.operators.tables.insert_new_companies`."""
    stored = companies.select([F.col(c).alias(c if c == "company_id" else f"existing_{c}") for c in companies.columns])
    return resolved.join(stored, "company_id", "inner")


def attach_enrichment(groups: DataFrame, enrichment: DataFrame) -> DataFrame:
    return groups.join(enrichment, "group_key", "left")


def own_domain_flag(claims: DataFrame, companies: DataFrame, key: str = "company_id") -> DataFrame:
    """Does a claim's source sit on the company's own domain?"""
    own = companies.select(key, F.col("primary_domain").alias("_own"))
    out = claims.join(own, key, "left")
    same = F.coalesce(registrable_domain(F.col("source_url")) == F.col("_own"), F.lit(False))
    return out.withColumn("is_own_domain", same).drop("_own")


def classify_source_tiers(sources: DataFrame, tiers: DataFrame, url: str = "source_url") -> DataFrame:
    """Tier 1 by a flag column, tier 2 or 3 by the domain table, tier 3 otherwise."""
    flags = [
        ("is_government", "government/regulator filing"),
        ("is_own_domain", "company newsroom/official site"),
        ("is_investor_announcement", "official investor announcement"),
        ("is_accelerator_profile", "accelerator-controlled company profile"),
    ]
    known = tiers.select(F.col("domain").alias("source_domain"), F.col("tier").alias("_tier"))
    keyed = sources.withColumn("source_domain", registrable_domain(F.col(url)))
    out = keyed.join(known, "source_domain", "left")
    tier, label = F, F
    for name, text in flags:
        if name in sources.columns:
            flag = F.coalesce(F.col(name), F.lit(False))
            tier, label = tier.when(flag, 1), label.when(flag, text)
    tier = tier.when(F.col("_tier") == 2, 2).otherwise(3)
    label = (
        label.when(F.col("_tier") == 2, "established journalism")
        .when(F.col("_tier") == 3, "discovery source")
        .otherwise("unclassified (defaults to discovery)")
    )
    return out.withColumn("source_tier", tier).withColumn("tier_label", label).drop("_tier")


def content_fingerprint(df: DataFrame, title: str = "title", body: str = "body") -> DataFrame:
    return df.withColumn("content_hash", fingerprint(F.col(title), F.col(body)))


def mirrored_copies(hashed: DataFrame, order: str) -> DataFrame:
    """Text hashes with their number of copies and their first holder."""
    return hashed.groupBy("content_hash").agg(
        F.count(F.lit(1)).alias("copies"), F.min(order).alias("first_id")
    )
