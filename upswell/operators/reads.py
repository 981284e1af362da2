"""Read side: published rankings, company filters, news, run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import schemas
from upswell.operators.tables import conform

def published_rankings(companies: DataFrame, ordered: bool = True) -> DataFrame:
    """Active companies with a region and a rank, in rank order: the 40 columns of ``schemas.RANKING``, null where the table has no such column."""
    rows = conform(companies.filter("active and region_bucket is not null and regional_rank is not null"), schemas.RANKING)
    return rows.orderBy("region_bucket", "regional_rank") if ordered else rows


def top_companies(startups: DataFrame, n: int = 100) -> DataFrame:
    return startups.orderBy(
        F.col("momentum_score").desc_nulls_last(), F.col("funding_amount_usd").desc_nulls_last(),
        F.col("last_updated").desc_nulls_last(), "company_name",
    ).limit(n)


def news_sidebar(news: DataFrame, n: int = 20) -> DataFrame:
    return news.orderBy(F.col("published_ts").desc_nulls_last(), "link").limit(n)


def filter_companies(
    df: DataFrame, region: str | None = None, industry: str | None = None, stage: str | None = None,
    investor: str | None = None, founded_year: str | None = None, hiring: str | None = None, text: str | None = None,
) -> DataFrame:
    """Only the given filters are applied; ``investor`` is one name of a comma-separated list."""
    equal = {
        "region_bucket": region, "industry": industry, "latest_funding_stage": stage,
        "founded_year": founded_year, "hiring_status": hiring,
    }
    for column, wanted in equal.items():
        if wanted is not None:
            df = df.filter(F.col(column) == wanted)
    if investor is not None:
        names = F.transform(F.split(F.lower("investors"), ","), lambda n: F.trim(n))
        df = df.filter(F.array_contains(names, investor.strip().lower()))
    if text is not None:
        like = "%" + text.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_") + "%"
        df = df.filter(F.col("canonical_name").ilike(like) | F.col("description").ilike(like))
    return df


def sort_companies(df: DataFrame, col: str, asc: bool = True) -> DataFrame:
    c = F.col(col)
    return df.orderBy(c.asc_nulls_last() if asc else c.desc_nulls_last(), "company_id")


def scan_freshness(runs: DataFrame, now: Column, max_days: int = 10) -> DataFrame:
    last = F.max("finished_at")
    days = F.datediff(now, last)
    return runs.agg(
        F.to_date(last).alias("last_run"), days.alias("days_since_run"), (days > max_days).alias("is_old")
    )


def recent_quality_reports(runs: DataFrame, n: int = 5) -> DataFrame:
    return runs.filter("quality_report is not null").orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def event_drawer(events: DataFrame, company_id: str) -> DataFrame:
    """All events of one company, rumors included, newest first."""
    return events.filter(F.col("company_id") == company_id).orderBy(F.col("published_at").desc_nulls_last(), "ingest_ord")


