"""Landed news: feed items, search hits, their union, and the relevance filter."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell import config as C
from upswell import schemas
from upswell.functions.text import any_of, has_pattern, null_if_blank, once, strip, text_or_empty
from upswell.operators.common import keep_first

ARTICLE_COLUMNS = ["title", "summary", "link", "published", "published_ts", "source_name", "source_ord", "item_ord"]


def published_time(c: Column) -> Column:
    """UTC time of a feed date: RFC 822 with any weekday, or ISO 8601; NULL when neither."""
    bare = F.trim(F.regexp_replace(c, r"^\s*[A-Za-z]{3,9},\s*", ""))
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(bare),
    )


def normalize_published(df: DataFrame, col: str = "published") -> DataFrame:
    return df.withColumn("published_ts", published_time(F.col(col)))


def cap_per_feed(items: DataFrame, cap: int | None = None) -> DataFrame:
    """The first ``cap`` entries of each feed, in feed order; all without a cap."""
    if cap is None:
        return items
    w = Window.partitionBy("source_name").orderBy("item_ord")
    return items.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") <= cap).drop("_nth")


def feed_items(raw: DataFrame, per_feed_cap: int | None = None) -> DataFrame:
    capped = cap_per_feed(raw, per_feed_cap)
    return normalize_published(
        capped.select(
            text_or_empty(F.col("title")).alias("title"),
            F.coalesce("summary", "description", F.lit("")).alias("summary"),
            text_or_empty(F.col("link")).alias("link"),
            text_or_empty(F.col("published")).alias("published"),
            "source_name", "source_ord", "item_ord",
        )
    ).select(ARTICLE_COLUMNS)


def scan_feed_items(spark: SparkSession, path: str, per_feed_cap: int | None = None) -> DataFrame:
    return feed_items(spark.read.schema(schemas.FEED_ITEM).json(path), per_feed_cap)


def search_hits(raw: DataFrame, hits_per_query: int | None = None, source_ord: int = 1000) -> DataFrame:
    hit = raw.select("query_ord", F.posexplode("hits").alias("_pos", "_hit"))
    if hits_per_query is not None:
        hit = hit.filter(F.col("_pos") < hits_per_query)
    link = F.coalesce(null_if_blank(F.col("_hit.url")), F.concat(F.lit(C.ITEM_URL_PREFIX), F.col("_hit.objectID")))
    return normalize_published(
        hit.filter(text_or_empty(F.col("_hit.title")) != "").select(
            F.col("_hit.title").alias("title"),
            F.col("_hit.title").alias("summary"),
            link.alias("link"),
            text_or_empty(F.col("_hit.created_at")).alias("published"),
            F.lit(C.SEARCH_SOURCE_NAME).alias("source_name"),
            (F.lit(source_ord) + F.col("query_ord")).alias("source_ord"),
            F.col("_pos").alias("item_ord"),
        )
    ).select(ARTICLE_COLUMNS)


def scan_search_hits(spark: SparkSession, path: str, hits_per_query: int | None = None) -> DataFrame:
    return search_hits(spark.read.schema(schemas.SEARCH_RESPONSE).json(path), hits_per_query)


Source = Callable[[SparkSession], DataFrame]
_SOURCES: dict[str, Source] = {}


def register_source(name: str, source: Source) -> None:
    """Add a source: a function from a session to a frame with the article columns."""
    _SOURCES[name] = source


def registered_sources() -> list[Source]:
    return list(_SOURCES.values())


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedupe_links(articles: DataFrame) -> DataFrame:
    """One article per link, the first in source order; articles without a link go."""
    linked = articles.filter(text_or_empty(F.col("link")) != "")
    return keep_first(linked, ["link"], [F.col("source_ord"), F.col("item_ord")])


def load_articles(spark: SparkSession, sources: Sequence[Source] | None = None) -> DataFrame:
    chosen = registered_sources() if sources is None else sources
    return dedupe_links(union_sources([s(spark) for s in chosen]))


def relevant(title: Column, summary: Column) -> Column:
    """Not empty, no noise phrase, and not a pure market headline."""
    head = F.lower(strip(text_or_empty(title)))
    both = F.struct(head.alias("head"), F.concat(head, F.lit(" "), F.lower(text_or_empty(summary))).alias("text"))

    def keep(a: Column) -> Column:
        market_only = has_pattern(a["head"], C.MARKET_PATTERNS) & ~any_of(a["text"], C.STARTUP_TERMS)
        return (a["head"] != "") & ~has_pattern(a["text"], C.NOISE_PATTERNS) & ~market_only

    return once(both, keep)


def filter_relevant_news(articles: DataFrame) -> DataFrame:
    return articles.filter(relevant(F.col("title"), F.col("summary")))


def latest_news(articles: DataFrame, n: int = C.NEWS_TOP_K) -> DataFrame:
    """Newest first, articles without a time last; a top-k per task, then one merge."""
    return articles.orderBy(F.col("published_ts").desc_nulls_last(), "source_ord", "item_ord", "link").limit(n)


