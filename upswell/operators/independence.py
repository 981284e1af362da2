"""How many of a company's sources are independent of one another."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswell.functions.text import fingerprint
from upswell.functions.urls import canonical_url, registrable_domain
from upswell.operators.common import running_totals
from upswell.session import stored

# Distinct (text, domain) pairs of one company that one task walks at a time.
BLOCK = 1_000_000
# Sources up to which a company is walked as it is, without those pairs.
SHORT = 100_000


def keyed_sources(sources: DataFrame) -> DataFrame:
    domain = F.col("domain") if "domain" in sources.columns else F.lit(None).cast("string")
    return sources.select(
        "company_id",
        canonical_url(F.col("url")).alias("link"),
        fingerprint(F.col("title"), F.col("body")).alias("text_hash"),
        F.coalesce(domain, registrable_domain(F.col("url"))).alias("site"),
        F.col("ord"),
    )


def source_pairs(sources: DataFrame) -> DataFrame:
    """First position of each distinct (company, text hash, domain).

    A source whose canonical URL came earlier never counts, and of two sources
    with the same text and domain only the first can, so both steps lose nothing.
    They are plain grouped minima and combine before the shuffle.
    """
    keyed = keyed_sources(sources)
    first_use = keyed.groupBy("company_id", "link").agg(
        F.min(F.struct("ord", "text_hash", "site")).alias("_first")
    )
    return first_use.groupBy(
        "company_id", F.col("_first.text_hash").alias("text_hash"), F.col("_first.site").alias("site")
    ).agg(F.min(F.struct(F.col("_first.ord").alias("ord"), "link")).alias("pos"))


def _walk(counts_only: bool):
    """The ordered walk over rows sorted by company and position: the pairs that count, or how many per company.

    What was used is kept for the company at hand only. Rows with a ``link`` are whole sources: of each link only the first is looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        company, links, texts, sites = None, set(), set(), set()
        for batch in batches:
            names, hashes, places = (batch.column(c).to_pylist() for c in ("company_id", "text_hash", "site"))
            urls = batch.column("link").to_pylist() if "link" in batch.schema.names else repeat(None)
            kept = []
            for i, (name, text, site, url) in enumerate(zip(names, hashes, places, urls)):
                if name != company:
                    company, links, texts, sites = name, set(), set(), set()
                if url is not None:
                    if url in links:
                        continue
                    links.add(url)
                if text in texts or site in sites:
                    continue
                texts.add(text)
                if site is not None:
                    sites.add(site)
                kept.append(i)
            chosen = batch.take(pa.array(kept, pa.int64()))
            if counts_only:
                yield chosen.select(["company_id"])
            else:
                yield chosen.select(["company_id", "text_hash", "site"])

    return run


def _spanning(pairs: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` that a company has in more than one round, with the last of these; most values have one round only."""
    last = F.max("_round").alias("_last")
    return stored(pairs.filter(F.col(key).isNotNull()).groupBy("company_id", key).agg(F.min("_round").alias("_first"), last).filter("_last > _first").drop("_first"))


def independent_sources(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """``company_id, independent_sources`` from ``company_id, url, title, body, ord``.

    Walks a company's sources in ``ord`` order; one counts unless its URL, text or
    domain was seen on a counted one. Companies of few sources, as nearly all are, are walked after one shuffle; the others go
    through ``_in_rounds``.
    """
    many = sources.groupBy("company_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min(block, SHORT))
    many = stored(many.select(F.col("company_id").alias("_many")))
    has_many = F.col("company_id").eqNullSafe(F.col("_many"))
    if many.isEmpty():
        return _counts(_walked(keyed_sources(sources), True))
    few = _walked(keyed_sources(sources.join(many, has_many, "left_anti")), True)
    return _counts(few.unionAll(_in_rounds(sources.join(many, has_many, "left_semi"), block)))


def _counts(counted: DataFrame) -> DataFrame:
    return counted.groupBy("company_id").agg(F.count(F.lit(1)).cast("int").alias("independent_sources"))


def _walked(rows: DataFrame, counts_only: bool) -> DataFrame:
    order = [c for c in ("company_id", "ord", "pos", "link", "text_hash", "site") if c in rows.columns]
    ordered = rows.repartition("company_id").sortWithinPartitions(*order).drop("ord", "pos")
    return ordered.mapInArrow(_walk(counts_only), "company_id string" if counts_only else "company_id string, text_hash string, site string")


def _in_rounds(sources: DataFrame, block: int) -> DataFrame:
    """``company_id`` once for each source that counts, of companies of any size.

    Each source depends on all earlier ones, so the walk is in order, but in blocks: block k of every
    company is walked in round k, all companies at once, after the pairs that share a text or domain with what earlier rounds counted are taken out.
    There are as many rounds as the largest company has blocks of distinct (text, domain) pairs, one for up to ``block`` of them, and no
    task holds more than a block of one company. A round reads its own pairs, and of the texts and domains counted before only those that
    some pair of this or a later round has.
    """
    pairs = stored(source_pairs(sources))
    most = pairs.groupBy("company_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 0
    rounds = max(1, -(-most // block))
    used: dict[str, DataFrame | None] = {"text_hash": None, "site": None}
    spanning: dict[str, DataFrame] = {}
    if rounds > 1:
        numbered = running_totals(pairs.withColumn("_one", F.lit(1)), ["company_id"], ["pos"], "_one")
        pairs = stored(numbered.withColumn("_round", F.floor((F.col("_upto") - 1) / block).cast("int")).drop("_one", "_upto", "_total"), by=["_round"])
        spanning = {key: _spanning(pairs, key) for key in used}
    else:
        pairs = pairs.withColumn("_round", F.lit(0))
    counted = None
    for k in range(rounds):
        live = pairs.filter(F.col("_round") == k)
        for key, seen in used.items():
            if seen is not None:
                live = live.join(seen.select("company_id", key), ["company_id", key], "left_anti")
        last = k == rounds - 1
        chosen = _walked(live.select("company_id", "pos", "text_hash", "site"), last)
        if not last:
            chosen = stored(chosen)
            for key, seen in used.items():
                new = spanning[key].filter(F.col("_last") > k).join(chosen.select("company_id", key), ["company_id", key], "left_semi")
                used[key] = stored(new if seen is None else seen.filter(F.col("_last") > k).unionByName(new))
        ids = chosen.select("company_id")
        counted = ids if counted is None else counted.unionAll(ids)
    return counted
