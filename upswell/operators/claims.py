"""From articles to checked claims: batches, extraction, contract, grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell import schemas
from upswell.functions.text import any_of, evidence_overlap, has_phrase, name_key, null_if_blank, squash, strip_fences, text_or_empty
from upswell.operators.common import keep_first, with_row_index


def number_articles(articles: DataFrame, size: int = C.CLAIM_BATCH_SIZE) -> DataFrame:
    """Give each article its batch and its 1-based place in it, in source order."""
    rows = with_row_index(articles, [F.col("source_ord"), F.col("item_ord"), F.col("link")])
    return rows.withColumn("batch_id", F.floor(F.col("row_index") / size)).withColumn(
        "source_index", (F.col("row_index") % size + 1).cast("int")
    ).drop("row_index")


def snippet_text(summary_chars: int | None = None) -> Column:
    summary = text_or_empty(F.col("summary"))
    if summary_chars:
        summary = F.substring(summary, 1, summary_chars)
    return F.concat(
        F.col("source_index").cast("string"), F.lit(". TITLE: "), text_or_empty(F.col("title")),
        F.lit("\n   SUMMARY: "), summary,
    )


def pack_batches(numbered: DataFrame, summary_chars: int | None = None) -> DataFrame:
    """One text per batch from its numbered articles; a batch has a fixed small size.

    ``summary_chars`` cuts the summaries for models with a short input; whole
    summaries are the default.
    """
    lines = F.sort_array(F.collect_list(F.struct("source_index", snippet_text(summary_chars).alias("line"))))
    return numbered.groupBy("batch_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_articles"),
        F.array_join(F.transform(lines, lambda s: s["line"]), "\n\n").alias("prompt"),
    )


def number_companies(companies: DataFrame, size: int = C.COMPANY_BATCH_SIZE) -> DataFrame:
    """Give each company its batch and its 1-based place in it, in name order."""
    rows = with_row_index(companies, [F.col("company_name")])
    return rows.withColumn("batch_id", F.floor(F.col("row_index") / size)).withColumn(
        "place", (F.col("row_index") % size + 1).cast("int")
    ).drop("row_index")


def pack_company_batches(numbered: DataFrame) -> DataFrame:
    """One text per batch of companies: name, description and the text of its own site."""
    about = F.coalesce(null_if_blank(F.col("about_text")), F.lit("(none found)"))
    line = F.concat(
        F.col("place").cast("string"), F.lit(". COMPANY: "), text_or_empty(F.col("company_name")),
        F.lit("\n   DESCRIPTION: "), text_or_empty(F.col("business_idea")), F.lit("\n   WEBSITE TEXT: "), about,
    )
    lines = F.sort_array(F.collect_list(F.struct("place", line.alias("line"))))
    return numbered.groupBy("batch_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_companies"),
        F.array_join(F.transform(lines, lambda s: s["line"]), "\n\n").alias("prompt"),
    )


def attach_refined(numbered: DataFrame, parsed: DataFrame) -> DataFrame:
    """Founder, founding year and moat by place in the answer. An answer that failed or
    has another length than its batch adds nothing."""
    sizes = numbered.groupBy("batch_id").agg(F.max("place").alias("_size"))
    good = parsed.filter(~F.col("failed")).join(sizes, "batch_id").filter(F.size("records") == F.col("_size"))
    one = good.select("batch_id", F.posexplode("records").alias("_pos", "_raw"))
    facts = one.select(
        "batch_id", (F.col("_pos") + 1).alias("place"),
        F.from_json("_raw", "founder_name string, year_founded string, unique_moat string").alias("_facts"),
    ).select("batch_id", "place", "_facts.*")
    return numbered.join(facts, ["batch_id", "place"], "left").drop("batch_id", "place")


Extractor = Callable[[str], tuple[str | None, str]]


def apply_extractor(batches: DataFrame, extract_batch: Extractor) -> DataFrame:
    """Call a user's extraction function on each batch text.

    It returns JSON text (or None) and the name of the provider. This is the one
    step that runs Python in the tasks.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            answers = [extract_batch(p) for p in part["prompt"]]
            yield pd.DataFrame(
                {
                    "batch_id": part["batch_id"],
                    "provider": [a[1] for a in answers],
                    "content": [a[0] for a in answers],
                }
            )

    return batches.mapInPandas(run, "batch_id long, provider string, content string")


def parse_responses(responses: DataFrame) -> DataFrame:
    """Add ``records`` (one JSON text per claim) and ``failed``.

    A response fails when it is missing, is not valid JSON, or is not an array.
    """
    text = strip_fences(F.col("content"))
    parsed = responses.withColumn("_text", text).withColumn("records", F.from_json("_text", "array<string>"))
    whole = F.coalesce(F.col("_text").rlike(r"^\[") & F.col("_text").rlike(r"\]$"), F.lit(False))
    ok = whole & F.col("records").isNotNull() & F.col("_text").rlike(r"(?s)^\[\s*(?:\{.*\}\s*)?\]$")
    return parsed.withColumn("failed", ~ok).withColumn("records", F.when(ok, F.col("records"))).drop("_text")


def explode_claims(parsed: DataFrame, schema: str = schemas.CLAIM) -> DataFrame:
    """One row per claim (a record of ``schema``) of the responses that did not fail."""
    one = parsed.filter(~F.col("failed")).select("batch_id", "provider", F.posexplode("records").alias("claim_pos", "raw"))
    claim = one.withColumn("_claim", F.from_json("raw", schema)).withColumn("present", F.json_object_keys("raw"))
    return claim.select(
        "batch_id", F.col("provider").alias("extraction_provider"), "claim_pos", "present", "_claim.*",
        (F.shiftleft("batch_id", 24) + F.col("claim_pos")).alias("ord"),
    )


def attach_sources(claims: DataFrame, numbered: DataFrame) -> DataFrame:
    """Bring in the article a claim cites by (batch, index); an index out of range finds none."""
    cited = numbered.select(
        "batch_id", "source_index", F.col("link").alias("source_url"), "source_name",
        F.col("published_ts").alias("published_at"),
        F.concat(text_or_empty(F.col("title")), F.lit(" "), text_or_empty(F.col("summary"))).alias("source_text"),
    )
    return claims.join(cited, ["batch_id", "source_index"], "left")


def validate_claims(attached: DataFrame) -> DataFrame:
    """Add ``overlap``, ``errors`` and ``accepted``; broken claims are marked, never repaired."""
    col = F.col
    quote = squash(text_or_empty(col("evidence_excerpt")))
    cited = col("source_url").isNotNull()
    overlap = F.when((quote != "") & cited, evidence_overlap(quote, col("source_text")))
    out = attached.withColumn("overlap", overlap)
    no = lambda c: ~F.coalesce(c, F.lit(False))
    material = F.coalesce(col("event_type").isin(C.MATERIAL_EVENT_TYPES), F.lit(False))
    tests: list[tuple[Column, str]] = []
    if "present" in attached.columns:
        lacking = F.size(F.array_except(F.array(*[F.lit(f) for f in C.REQUIRED_FIELDS]), F.col("present"))) > 0
        tests.append((lacking, "missing required field"))
    tests += [
        (no(col("event_type").isin(C.EVENT_TYPES)), "unsupported event type"),
        (no(col("status").isin(C.CLAIM_STATUSES)), "unsupported status"),
        (~cited, "source index out of range"),
        (no(col("confidence").between(0, 100)), "confidence out of range"),
        (material & (quote == ""), "material claim without evidence"),
        (~material & (quote == ""), "evidence is empty"),
        (F.coalesce(col("overlap") < C.MIN_EVIDENCE_OVERLAP, F.lit(False)), "evidence not in source"),
        (
            (col("status") == "ambiguous") & col("event_type").isin("funding_round_completed", "acquisition"),
            "ambiguous completed transaction",
        ),
    ]
    errors = F.array_compact(F.array(*[F.when(t, F.lit(r)) for t, r in tests]))
    return out.withColumn("errors", errors).withColumn("accepted", F.size("errors") == 0)


def accepted_claims(validated: DataFrame) -> DataFrame:
    return validated.filter("accepted").drop("errors", "accepted", "overlap", "source_text")


def with_group_key(claims: DataFrame) -> DataFrame:
    """Claims with a usable company name, keyed by its normal form."""
    named = claims.filter(squash(text_or_empty(F.col("company_name"))) != "")
    return named.withColumn("group_key", name_key(F.col("company_name")))


def first_known(column: str, only: Column | None = None) -> Column:
    """First non-empty value in claim order, as an aggregate."""
    value = null_if_blank(F.col(column))
    usable = value.isNotNull() if only is None else value.isNotNull() & only
    return F.min_by(F.when(usable, value), F.when(usable, F.col("ord")))


def group_claims(claims: DataFrame) -> DataFrame:
    """One row per company name with the first value of each descriptive field.

    Only small aggregates are kept per group, so a company with very many claims
    costs no more memory than one with few.
    """
    founded = (F.col("event_type") == "other") & F.lower(text_or_empty(F.col("evidence_excerpt"))).contains("found")
    return with_group_key(claims).groupBy("group_key").agg(
        F.min_by(squash(F.col("company_name")), "ord").alias("company_name"),
        F.count(F.lit(1)).alias("n_claims"),
        F.min("ord").alias("first_ord"),
        F.min_by("source_url", "ord").alias("source_url"),
        first_known("business_idea").alias("description"),
        first_known("location").alias("location"),
        first_known("industry").alias("industry"),
        first_known("value", founded).alias("founded_year"),
        F.avg(F.coalesce(F.col("confidence").cast("double"), F.lit(0.0))).alias("extraction_confidence"),
    )


def dedupe_companies(records: DataFrame) -> DataFrame:
    """One record per lower-cased name: the longest description, the first on a tie."""
    keyed = records.withColumn("name_key", F.lower(squash(text_or_empty(F.col("company_name"))))).filter("name_key <> ''")
    length = F.length(text_or_empty(F.col("business_idea")))
    return keep_first(keyed, ["name_key"], [length.desc(), F.col("ord")]).drop("name_key")


def region_of(location: Column, substring: bool = False) -> Column:
    found = any_of if substring else has_phrase

    def pick(low: Column) -> Column:
        return (
            F.when(low == "", "Unknown")
            .when(found(low, ["chennai"]), "India (Chennai)")
            .when(found(low, C.INDIA_TERMS), "India")
            .when(found(low, C.USA_TERMS), "USA")
            .otherwise("Rest of World")
        )

    return F.transform(F.array(F.lower(text_or_empty(location))), pick).getItem(0)


def bucket_of(region: Column) -> Column:
    return F.when(region == "USA", "US").when(region.isin("India", "India (Chennai)"), "INDIA").when(
        region == "Rest of World", "ROW"
    )


def classify_region(df: DataFrame, col: str = "location", substring: bool = False) -> DataFrame:
    """Whole-word match by default, so that "Indiana" is not India; ``substring``
    gives the looser match."""
    return df.withColumn("region", region_of(F.col(col), substring))


def region_bucket(df: DataFrame, col: str = "region") -> DataFrame:
    return df.withColumn("region_bucket", bucket_of(F.col(col)))
