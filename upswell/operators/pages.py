"""Crawled pages: links, homepages, careers signals, page facts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswell import config as C
from upswell.functions import text as X
from upswell.functions import urls as U
from upswell.operators.common import keep_first
from upswell.session import stored


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per absolute link, in page order, query strings cut."""
    return pages.select("*", F.posexplode(U.absolute_links(F.col(html))).alias("link_ord", "link")).drop(html)


def denylist_links(links: DataFrame, denylist: Iterable[str] | None = None, col: str = "link") -> DataFrame:
    """Drop links on a listed domain or below one."""
    return links.filter(~U.denylisted(U.registrable_domain(F.col(col)), denylist))


def candidate_links_v1(pages: DataFrame, html: str = "html") -> DataFrame:
    """Older profile: the host as it stands (without www) against the shorter list."""
    links = pages.select("*", F.posexplode(F.regexp_extract_all(X.text_or_empty(F.col(html)), F.lit(U.HREF), F.lit(1))).alias("link_ord", "raw")).drop(html)
    site = F.lower(X.extract(F.col("raw"), r"^https?://(?:www\.)?([^/]+)", 1))
    return links.filter(site.isNotNull() & ~U.denylisted(site, C.DENYLIST_V1)).withColumn(
        "link", F.regexp_replace("raw", r"(?s)\?.*$", "")
    ).drop("raw")


def union_denylists(denylist: DataFrame, links: DataFrame, col: str = "link") -> DataFrame:
    """Links per denylist category. The list side is config-sized."""
    site = links.select(F.explode(U.parent_domains(U.host(F.col(col)))).alias("domain"))
    return site.join(denylist, "domain").groupBy("category").agg(F.count(F.lit(1)).alias("n_links"))


def drop_asset_and_tracking_links(links: DataFrame, col: str = "link") -> DataFrame:
    c = F.col(col)
    return links.filter(~U.has_asset_extension(c) & ~U.is_tracking(c))


def final_site(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.withColumn(
        "final_domain", F.coalesce(U.registrable_domain(F.col("final_url")), U.registrable_domain(F.col(url)))
    )


def drop_non_html(pages: DataFrame) -> DataFrame:
    """Responses that are pages: status below 400, an HTML-like type, and no redirect
    to a listed domain."""
    return final_site(pages).filter(
        (F.col("status_code") < 400) & ~U.is_non_html(F.col("content_type")) & ~U.denylisted(F.col("final_domain"))
    )


def canonical_urls(pages: DataFrame, col: str = "url") -> DataFrame:
    return pages.withColumn("canonical_url", U.canonical_url(F.col(col)))


def registrable_domains(df: DataFrame, col: str = "url") -> DataFrame:
    return df.withColumn("domain", U.registrable_domain(F.col(col)))


def link_safety_audit(pages: DataFrame, http_hosts: Iterable[str] = (), html: str = "html") -> DataFrame:
    """Links of every kind per page domain, and how many could be unsafe to show."""
    links = pages.select(
        U.registrable_domain(F.col("url")).alias("domain"), F.explode(U.all_hrefs(F.col(html))).alias("href")
    )
    v = links.withColumn("verdict", U.href_verdict(F.col("href"), http_hosts))
    return v.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n_links"),
        *[
            F.count_if(F.col("verdict") == name).alias(f"n_{name}")
            for name in ("safe", "plain_http", "dangerous_scheme", "no_scheme")
        ],
    )


def extract_page_facts(pages: DataFrame, html: str = "html", about_chars: int | None = None) -> DataFrame:
    """Profile link, e-mail and visible text; the whole text unless a cut is asked for."""
    h = F.col(html)
    about = X.visible_text(h)
    return (
        pages.withColumn("founder_linkedin", X.profile_link(h))
        .withColumn("contact_email", X.contact_email(h))
        .withColumn("about_text", F.substring(about, 1, about_chars) if about_chars else about)
    )


def detect_hiring_keywords(pages: DataFrame, crawled: DataFrame, html: str = "html") -> DataFrame:
    """Older profile: a hiring phrase, or a /careers page that was crawled."""
    careers = (
        crawled.filter("status_code = 200").select(F.col("url").alias("_careers")).distinct().withColumn("_found", F.lit(True))
    )
    target = F.concat(F.regexp_replace("url", "/+$", ""), F.lit("/careers"))
    out = pages.join(careers, target == F.col("_careers"), "left")
    says = X.contains_any(F.lower(X.text_or_empty(F.col(html))), C.HIRING_PHRASES_V1)
    return out.withColumn(
        "hiring_status", F.when(says | F.col("_found").isNotNull(), "Likely hiring").otherwise("Unknown")
    ).drop("_careers", "_found")


def attach_articles(companies: DataFrame, articles: DataFrame) -> DataFrame:
    """The article a company's first claim came from, for its summary."""
    return companies.join(
        articles.select(F.col("link").alias("source_url"), F.col("summary").alias("article_summary")), "source_url", "left"
    )


def _name_in_domain(strongest: Column, root: Column) -> Column:
    return F.coalesce(root.contains(strongest) | strongest.contains(root), F.lit(False))


def homepage_candidates(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links of a company that could be its homepage, with the crawled response.

    Cheap tests on the URL come before the join. Needs ``group_key, company_name,
    link, link_ord`` and one crawled row per URL.
    """
    web = links.filter(F.col("link").rlike("^https?://") & U.registrable_domain(F.col("link")).isNotNull())
    usable = denylist_links(drop_asset_and_tracking_links(web))
    once = usable.groupBy("group_key", "company_name", "link").agg(F.min("link_ord").alias("link_ord"))
    return once.join(pages.withColumnRenamed("url", "link"), "link", "inner")


def homepage_confidence(candidates: DataFrame) -> DataFrame:
    """Score each fetched candidate: 40 for a page, 5 for https, 25 when its domain fits
    the name, 20 when its text does. Adds ``confidence, valid, reasons``."""
    c = final_site(candidates, "link").withColumn("_token", X.strongest_token(F.col("company_name")))
    products = F.col("product_names") if "product_names" in candidates.columns else F.array().cast("array<string>")
    root = F.split(F.col("final_domain"), r"\.").getItem(0)
    fits = _name_in_domain(F.col("_token"), root)
    low = F.lower(X.text_or_empty(F.col("html")))
    named = F.coalesce(low.contains(F.col("_token")), F.lit(False)) | F.coalesce(
        F.exists(products, lambda p: low.contains(X.strongest_token(p))), F.lit(False)
    )
    https = F.col("link").startswith("https://")
    failed = (
        F.when(F.col("status_code") >= 400, "resolved with an error status")
        .when(U.is_non_html(F.col("content_type")), "content type not HTML")
        .when(U.denylisted(F.col("final_domain")), "redirected to a listed domain")
    )
    score = F.lit(40) + F.when(https, 5).otherwise(0) + F.when(fits, 25).otherwise(0) + F.when(named, 20).otherwise(0)
    confidence = F.when(failed.isNotNull(), 0).otherwise(F.least(score, F.lit(100)))
    moved = F.col("final_domain") != U.registrable_domain(F.col("link"))
    good = F.array_compact(
        F.array(
            F.lit("resolved as HTML"), F.when(https, "served over https"), F.when(fits, "domain fits the name"),
            F.when(named, "text names the company"), F.when(moved, "followed a redirect"),
            F.when(score < C.HOMEPAGE_MIN_CONFIDENCE, "confidence below the minimum"),
        )
    )
    return (
        c.withColumn("confidence", confidence)
        .withColumn("valid", F.col("confidence") >= C.HOMEPAGE_MIN_CONFIDENCE)
        .withColumn("reasons", F.when(failed.isNotNull(), F.array(failed)).otherwise(good))
        .drop("_token")
    )


def best_homepage(scored: DataFrame) -> DataFrame:
    """The most certain valid candidate per company; shorter URL, then page order on ties."""
    best = F.min_by(
        F.struct("link", "confidence", "final_domain"), F.struct(-F.col("confidence"), F.length("link"), F.col("link_ord"), F.col("link"))
    )
    return (
        scored.filter("valid").groupBy("group_key").agg(best.alias("_best")).select(
            "group_key", F.col("_best.link").alias("homepage"), F.col("_best.confidence").alias("homepage_confidence"),
            F.col("_best.final_domain").alias("primary_domain"),
        )
    )


def careers_pages(homepages: DataFrame, pages: DataFrame) -> DataFrame:
    """Crawled careers pages below each homepage (three fixed paths)."""
    base = F.regexp_replace("homepage", "/+$", "")
    paths = F.array(*[F.lit(p) for p in C.CAREERS_PATHS])
    wanted = homepages.select("*", F.posexplode(paths).alias("path_ord", "path")).withColumn(
        "careers_url", F.concat(base, F.col("path"))
    )
    found = pages.filter("status_code < 400").select(F.col("url").alias("careers_url"), F.col("html").alias("careers_html"))
    return wanted.join(found, "careers_url", "inner")


def careers_signal(df: DataFrame, html: str = "careers_html") -> DataFrame:
    """Hiring status of a careers page by what it shows, not by its being there."""
    raw = X.text_or_empty(F.col(html))
    low = F.lower(raw)
    plain = X.squash(F.regexp_replace(low, "<[^>]+>", " "))
    out = df.withColumn("_plain", plain)
    blank = X.squash(raw) == ""
    soft = X.contains_any(F.col("_plain"), C.SOFT_404_MARKERS) & (F.length("_plain") < 2000)
    flags = {
        "_blank": blank, "_soft": soft,
        "_ats": X.contains_any(low, C.ATS_DOMAINS),
        "_schema": X.contains_any(low, C.JOB_SCHEMA_MARKERS),
        "_phrase": X.contains_any(low, C.OPEN_ROLE_PHRASES),
        "_count": X.extract(raw, r"(?i)(\d+)\s+(?:open\s+)?(?:job|position|role)s?\b", 1).try_cast("int"),
    }
    out = out.withColumns(flags)
    n = F.coalesce("_count", F.lit(0))
    usable = ~F.col("_blank") & ~F.col("_soft")
    evidence = F.col("_ats") | F.col("_schema") | F.col("_phrase") | (n > 0)
    status = (
        F.when(~usable, "unknown")
        .when(~evidence, "no_verified_openings")
        .when(F.col("_count") == 0, "no_verified_openings")
        .when(F.col("_ats") | F.col("_schema") | (n >= 3), "actively_hiring")
        .otherwise("limited_hiring")
    )
    points = (
        F.lit(20) + F.when(F.col("_ats"), 35).otherwise(0) + F.when(F.col("_schema"), 35).otherwise(0)
        + F.when(F.col("_phrase"), 15).otherwise(0) + F.when(F.col("_count").isNotNull(), 10).otherwise(0)
    )
    return (
        out.withColumn("hiring_status", status)
        .withColumn(
            "hiring_confidence",
            F.when(F.col("_blank"), 0).when(F.col("_soft"), 10).otherwise(F.least(points, F.lit(100))),
        )
        .withColumn("open_role_count", F.when(usable & evidence, F.col("_count")))
        .drop("_plain", *flags)
    )


def best_careers_page(scored: DataFrame) -> DataFrame:
    """Best page per company by status, then confidence, then path order."""
    rank = (
        F.when(F.col("hiring_status") == "actively_hiring", 3).when(F.col("hiring_status") == "limited_hiring", 2)
        .when(F.col("hiring_status") == "no_verified_openings", 1).otherwise(0)
    )
    best = F.max_by(
        F.struct("hiring_status", "hiring_confidence", "open_role_count"),
        F.struct(rank, F.col("hiring_confidence"), -F.col("path_ord")),
    )
    return scored.groupBy("group_key").agg(best.alias("_best")).select(
        "group_key", F.col("_best.hiring_status").alias("hiring_status"),
        F.col("_best.hiring_confidence").alias("hiring_confidence"),
        F.col("_best.open_role_count").alias("verified_open_role_count"),
    )


def page_features(pages: DataFrame) -> DataFrame:
    """One narrow row per crawled URL, that of its last fetch: response, links, and what a careers page shows.

    All of it is computed where a page is read; bodies are not shuffled. ``fetch_ord`` orders the fetches of a URL; where it is
    missing, or equal, the choice follows the response. ``_fetch`` and ``_body`` find the row again among the pages.
    """
    last = F.coalesce(F.col("fetch_ord"), F.lit(-1)) if "fetch_ord" in pages.columns else F.lit(-1)
    keyed = pages.withColumns({"_fetch": last.cast("long"), "_body": F.xxhash64("html")})
    # only pages at one of the fixed paths can be careers pages; the text of others is not looked at
    at_path = F.coalesce(F.col("url").rlike("(?:" + "|".join(C.CAREERS_PATHS) + ")$"), F.lit(False))
    signal = careers_signal(keyed.withColumn("_careers", F.when(at_path, F.col("html"))), "_careers")
    narrow = signal.select(
        "url", "final_url", "status_code", "content_type", "_fetch", "_body", U.absolute_links(F.col("html")).alias("links"),
        *[F.when(at_path, F.col(c)).alias(c) for c in ("hiring_status", "hiring_confidence", "open_role_count")],
    )
    return keep_first(narrow, ["url"], [F.col("_fetch").desc(), F.col("status_code"), F.col("final_url"), F.col("_body")])


def _usable_links(named: DataFrame) -> DataFrame:
    """Candidate links of (group_key, company_name, phase, links), each once a company and phase."""
    links = named.select("group_key", "company_name", "phase", F.posexplode("links").alias("link_ord", "link"))
    web = links.filter(F.col("link").rlike("^https?://") & U.registrable_domain(F.col("link")).isNotNull())
    usable = denylist_links(drop_asset_and_tracking_links(web))
    return usable.groupBy("group_key", "company_name", "link", "phase").agg(F.min("link_ord").alias("link_ord"))


def enrich_companies(groups: DataFrame, articles: DataFrame, pages: DataFrame) -> DataFrame:
    """Homepage, its confidence and domain, and the hiring signal of each company.

    Links of the article summary come first; the links of the article page count
    only for companies that got no valid homepage from the summary. A URL that was crawled more than once counts as last fetched.

    What does not depend on a company is computed per page or article before any join (``page_features``). Bodies cross one shuffle, to the
    candidate links whose response is a page: only there is the text searched for a company's name.
    """
    named = groups.select("group_key", "company_name", "source_url")
    features = stored(page_features(pages))
    summaries = articles.select(F.col("link").alias("source_url"), U.absolute_links(F.col("summary")).alias("links"), F.lit(1).alias("phase"))
    bodies = features.select(F.col("url").alias("source_url"), "links", F.lit(2).alias("phase"))
    found = _usable_links(named.join(summaries.unionAll(bodies), "source_url"))
    response = features.select(F.col("url").alias("link"), "final_url", "status_code", "content_type", "_fetch", "_body")
    candidates = found.join(response, "link")
    last = F.coalesce(F.col("fetch_ord"), F.lit(-1)) if "fetch_ord" in pages.columns else F.lit(-1)
    texts = pages.filter("status_code < 400").select(F.col("url").alias("link"), last.cast("long").alias("_fetch"), F.xxhash64("html").alias("_body"), "html")
    fetched = candidates.filter("status_code < 400").join(texts, ["link", "_fetch", "_body"])
    scored = homepage_confidence(fetched).filter("valid")
    best = F.min_by(
        F.struct("link", "confidence", "final_domain"),
        F.struct("phase", -F.col("confidence"), F.length("link"), F.col("link_ord"), F.col("link")),
    )
    homepages = stored(
        scored.groupBy("group_key").agg(best.alias("_best")).select(
            "group_key", F.col("_best.link").alias("homepage"), F.col("_best.confidence").alias("homepage_confidence"), F.col("_best.final_domain").alias("primary_domain"),
        )
    )
    paths = F.array(*[F.lit(p) for p in C.CAREERS_PATHS])
    wanted = homepages.select("group_key", F.posexplode(paths).alias("path_ord", "path"), F.regexp_replace("homepage", "/+$", "").alias("_base"))
    signals = features.filter("status_code < 400 AND hiring_status IS NOT NULL").select(F.col("url").alias("_url"), "hiring_status", "hiring_confidence", "open_role_count")
    hiring = best_careers_page(wanted.join(signals, F.concat("_base", "path") == F.col("_url")))
    out = named.join(homepages, "group_key", "left").join(hiring, "group_key", "left")
    return out.withColumn("hiring_status", F.coalesce("hiring_status", F.lit("unknown"))).withColumn(
        "hiring_confidence", F.coalesce("hiring_confidence", F.lit(0))
    )
