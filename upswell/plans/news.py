"""The daily news refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell.operators.tables import prune_older_than, upsert_by_key
from upswell.sources.feeds import dedupe_links, filter_relevant_news, latest_news


def run_news_refresh(
    articles: DataFrame, news: DataFrame, now: Column, top_k: int | None = None, keep_days: int = C.NEWS_KEEP_DAYS
) -> DataFrame:
    """Relevant headlines (the newest ``top_k``, or all) merged into the stored news by link; old ones dropped.

    ``news`` has ``link, title, source_name, published_ts, fetched_at``. ``fetched_at`` is when a link was first seen: a headline that
    stays in a feed is dropped ``keep_days`` after that.
    """
    top = filter_relevant_news(dedupe_links(articles))
    if top_k is not None:
        top = latest_news(top, top_k)
    batch = top.select("link", "title", "source_name", "published_ts", now.alias("fetched_at"))
    return prune_older_than(upsert_by_key(news, batch, ["link"], keep=["fetched_at"]), "fetched_at", now, keep_days)
