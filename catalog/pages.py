"""Crawled pages, links, homepages, careers."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from catalog import duck as D
from catalog.registry import Tables, query
from upswell import config as C
from upswell.operators import pages as W

HREF_SQL = """href=["''](https?://[^"'']+)["'']"""
_RAW = f"regexp_extract_all(html, '{HREF_SQL}', 1)"
LINKS_SQL = f""", links AS (SELECT page_id, label, site, url, raw, ord - 1 AS link_ord, regexp_replace(raw, '(?s)[?].*$', '') AS link
    FROM (SELECT page_id, label, site, url, unnest({_RAW}) AS raw, generate_subscripts({_RAW}, 1) AS ord FROM site_pages))"""


def links(t: Tables):
    return W.extract_links(t("site_pages"))


@query("extract_links", "TXT-8", "site_pages", LINKS_SQL + " SELECT page_id, CAST(link_ord AS INT) AS link_ord, link FROM links")
def extract_links(t: Tables):
    return links(t).select("page_id", "link_ord", "link")


@query(
    "denylist_links", "FLT-2", "site_pages",
    LINKS_SQL + f" SELECT page_id, CAST(link_ord AS INT) AS link_ord, link FROM links WHERE NOT {D.denylisted(D.registrable_domain('link'))}",
)
def denylist_links(t: Tables):
    return W.denylist_links(links(t)).select("page_id", "link_ord", "link")


_V1_HOST = "lower(regexp_extract(raw, '^https?://(?:www[.])?([^/]+)', 1))"


@query(
    "candidate_links_v1", "FLT-2", "site_pages",
    LINKS_SQL + f" SELECT page_id, CAST(link_ord AS INT) AS link_ord, link FROM links WHERE {_V1_HOST} <> '' AND NOT {D.denylisted(_V1_HOST, C.DENYLIST_V1)}",
)
def candidate_links_v1(t: Tables):
    return W.candidate_links_v1(t("site_pages")).select("page_id", "link_ord", "link")


def _category_case(e: str) -> str:
    seen: set[str] = set()
    whens = []
    for name, domains in C.DENYLIST.items():
        fresh = [d for d in domains if d not in seen]
        seen.update(domains)
        whens.append((name, fresh))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS category, count(*) AS n_links FROM links, (SELECT unnest([{D.quoted(ds)}]) AS d) WHERE {e} = d OR ends_with({e}, '.' || d)"
        for name, ds in whens
    )


@query(
    "union_denylists", "SET-2", "site_pages",
    LINKS_SQL + f" SELECT * FROM ({_category_case(D.host('link'))}) WHERE n_links > 0",
)
def union_denylists(t: Tables):
    return W.union_denylists(C.denylist_frame(t.spark), links(t))


_PATH = r"lower(regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1))"
_ASSET = f"regexp_matches({_PATH}, '[.](?:{'|'.join(C.ASSET_EXTENSIONS)})$')"


@query(
    "drop_asset_and_tracking_links", "FLT-3", "site_pages",
    LINKS_SQL + f" SELECT page_id, CAST(link_ord AS INT) AS link_ord, link FROM links WHERE NOT {_ASSET} AND NOT {D.contains_any('lower(link)', C.TRACKING_MARKERS)}",
)
def drop_asset_and_tracking_links(t: Tables):
    return W.drop_asset_and_tracking_links(links(t)).select("page_id", "link_ord", "link")


_NON_HTML = f"coalesce(regexp_matches(trim(lower(content_type)), '^(?:{'|'.join(re.escape(p).replace(chr(92) + '/', '/') for p in C.NON_HTML_TYPES)})'), false)"
FINAL_SQL = f"""coalesce({D.registrable_domain('final_url')}, {D.registrable_domain('url')})"""


@query(
    "drop_non_html", "FLT-4", "crawl",
    f", finals AS (SELECT *, {FINAL_SQL} AS final_domain FROM crawl) SELECT url, final_domain FROM finals WHERE status_code < 400 AND NOT {_NON_HTML} AND NOT {D.denylisted('final_domain')}",
)
def drop_non_html(t: Tables):
    return W.drop_non_html(t("crawl")).select("url", "final_domain")


@query("registrable_domains", "URL-1", "", f"SELECT page_id, {D.registrable_domain('url')} AS domain FROM pages")
def registrable_domains(t: Tables):
    return W.registrable_domains(t("pages")).select("page_id", "domain")


@query("canonical_urls", "URL-2", "", f"SELECT page_id, {D.canonical_url('url')} AS canonical_url FROM pages")
def canonical_urls(t: Tables):
    return W.canonical_urls(t("pages")).select("page_id", "canonical_url")


_ALL_HREFS = """regexp_extract_all(html, '(?i)href=["'']([^"'']*)["'']', 1)"""


@query(
    "link_safety_audit", "FLT-10", "site_pages",
    f""", hrefs AS (SELECT {D.registrable_domain('url')} AS domain, lower(trim(unnest({_ALL_HREFS}))) AS h FROM site_pages)
    SELECT domain, count(*) AS n_links, count(*) FILTER (WHERE starts_with(h, 'https:')) AS n_safe, count(*) FILTER (WHERE starts_with(h, 'http:')) AS n_plain_http,
      count(*) FILTER (WHERE regexp_matches(h, '^(?:javascript|data|vbscript|file):')) AS n_dangerous_scheme,
      count(*) FILTER (WHERE NOT regexp_matches(h, '^(?:https|http|javascript|data|vbscript|file):')) AS n_no_scheme FROM hrefs GROUP BY 1""",
)
def link_safety_audit(t: Tables):
    return W.link_safety_audit(t("site_pages"))


EMAIL_LINKED = r"(?i)mailto:([\p{L}\p{N}_.\-+]+@[\p{L}\p{N}_\-]+\.[\p{L}\p{N}_.\-]+)"
EMAIL_BARE = (
    r"(?i)(?:^|[^\p{L}\p{N}_])([\p{L}\p{N}_][\p{L}\p{N}_.\-+]*@[\p{L}\p{N}_\-]+\.[a-z]{2,})(?:[^\p{L}\p{N}_]|$)"
)


@query(
    "extract_page_facts", "TXT-7", "site_pages",
    rf"""SELECT page_id, nullif(regexp_extract(html, 'https?://(?:www\.)?linkedin\.com/in/[\p{{L}}\p{{N}}_\-/]+', 0), '') AS founder_linkedin,
      coalesce(nullif(regexp_extract(html, '{EMAIL_LINKED}', 1), ''), nullif(regexp_extract(html, '{EMAIL_BARE}', 1), '')) AS contact_email,
      md5({D.strip_tags('html')}) AS about_md5 FROM site_pages""",
)
def extract_page_facts(t: Tables):
    rows = W.extract_page_facts(t("site_pages"))
    return rows.select("page_id", "founder_linkedin", "contact_email", F.md5("about_text").alias("about_md5"))


@query(
    "detect_hiring_keywords", "TXT-9", "crawl",
    f"""SELECT p.url, CASE WHEN {D.contains_any('lower(p.html)', C.HIRING_PHRASES_V1)} OR c.url IS NOT NULL THEN 'Likely hiring' ELSE 'Unknown' END AS hiring_status
    FROM crawl p LEFT JOIN (SELECT DISTINCT url FROM crawl WHERE status_code = 200) c ON c.url = regexp_replace(p.url, '/+$', '') || '/careers'""",
)
def detect_hiring_keywords(t: Tables):
    return W.detect_hiring_keywords(t("crawl"), t("crawl")).select("url", "hiring_status")


@query(
    "attach_articles", "JOIN-2", "site_groups site_articles",
    "SELECT group_key, source_url, md5(summary) AS summary_md5 FROM site_groups LEFT JOIN (SELECT link, any_value(summary) AS summary FROM site_articles GROUP BY link) ON link = source_url",
)
def attach_articles(t: Tables):
    rows = W.attach_articles(t("site_groups"), t("site_articles"))
    return rows.select("group_key", "source_url", F.md5("article_summary").alias("summary_md5"))


def candidate_sql(source: str, name: str) -> str:
    """``source`` gives group_key, company_name, link, link_ord."""
    return f""", {name} AS (SELECT l.group_key, l.company_name, l.link, l.link_ord, c.final_url, c.status_code, c.content_type, c.html, coalesce({D.registrable_domain('c.final_url')}, {D.registrable_domain('l.link')}) AS final_domain
    FROM (SELECT group_key, company_name, link, min(link_ord) AS link_ord FROM {source}
      WHERE regexp_matches(link, '^https?://') AND NOT {_ASSET} AND NOT {D.contains_any('lower(link)', C.TRACKING_MARKERS)} AND NOT {D.denylisted(D.registrable_domain('link'))} GROUP BY 1, 2, 3) l
    JOIN crawl c ON c.url = l.link)"""


_TOKEN = (
    f"list_reduce(list_prepend('', list_filter(string_split({D.normalize_name('company_name')}, ' '), lambda w: length(w) >= 3)),"
    " lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END)"
)
_BAD = f"(status_code >= 400 OR {_NON_HTML} OR {D.denylisted('final_domain')})"


def confidence_sql(name: str, out: str) -> str:
    return f""", {out} AS (SELECT *, confidence >= 50 AS valid FROM (SELECT *, CASE WHEN {_BAD} THEN 0 ELSE 40 + CASE WHEN starts_with(link, 'https://') THEN 5 ELSE 0 END
      + CASE WHEN token <> '' AND (contains(split_part(final_domain, '.', 1), token) OR contains(token, split_part(final_domain, '.', 1))) THEN 25 ELSE 0 END
      + CASE WHEN token <> '' AND contains(lower(html), token) THEN 20 ELSE 0 END END AS confidence FROM (SELECT *, {_TOKEN} AS token FROM {name})))"""


PAGE_LINKS_SQL = LINKS_SQL + ", page_links AS (SELECT site AS group_key, label AS company_name, link, link_ord FROM links)"


def page_candidates(t: Tables):
    rows = links(t).select(F.col("site").alias("group_key"), F.col("label").alias("company_name"), "link", "link_ord")
    return W.homepage_candidates(rows, t("crawl"))


@query(
    "homepage_candidates", "JOIN-8 EXT-3", "site_pages crawl",
    PAGE_LINKS_SQL + candidate_sql("page_links", "cand") + " SELECT group_key, link, CAST(link_ord AS INT) AS link_ord, status_code FROM cand",
)
def homepage_candidates(t: Tables):
    return page_candidates(t).select("group_key", "link", "link_ord", "status_code")


SCORED_PAGES_SQL = PAGE_LINKS_SQL + candidate_sql("page_links", "cand") + confidence_sql("cand", "scored_links")
BEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY confidence DESC, length(link), link_ord, link) AS n FROM {0} WHERE valid) WHERE n = 1"


@query("homepage_confidence", "SCR-10", "site_pages crawl", SCORED_PAGES_SQL + " SELECT group_key, link, confidence, valid FROM scored_links")
def homepage_confidence(t: Tables):
    return W.homepage_confidence(page_candidates(t)).select("group_key", "link", "confidence", "valid")


@query(
    "best_homepage", "TOP-2", "site_pages crawl",
    SCORED_PAGES_SQL + f" SELECT group_key, link AS homepage, confidence AS homepage_confidence, final_domain AS primary_domain FROM ({BEST.format('scored_links')})",
)
def best_homepage(t: Tables):
    return W.best_homepage(W.homepage_confidence(page_candidates(t)))


_PLAIN = D.squash("regexp_replace(lower(html), '<[^>]+>', ' ', 'g')")
_COUNT = r"try_cast(nullif(regexp_extract(html, '(?i)(\d+)\s+(?:open\s+)?(?:job|position|role)s?\b', 1), '') AS INT)"


def careers_sql(name: str, out: str) -> str:
    """``name`` gives one careers page per row with ``html``."""
    return f""", {out}_flags AS (SELECT *, {D.squash('html')} = '' AS blank, {D.contains_any(_PLAIN, C.SOFT_404_MARKERS)} AND length({_PLAIN}) < 2000 AS soft,
      {D.contains_any('lower(html)', C.ATS_DOMAINS)} AS ats, {D.contains_any('lower(html)', C.JOB_SCHEMA_MARKERS)} AS job_schema,
      {D.contains_any('lower(html)', C.OPEN_ROLE_PHRASES)} AS phrase, {_COUNT} AS cnt FROM {name}),
    {out} AS (SELECT *, CASE WHEN blank OR soft THEN 'unknown' WHEN NOT evidence THEN 'no_verified_openings' WHEN cnt = 0 THEN 'no_verified_openings'
        WHEN ats OR job_schema OR coalesce(cnt, 0) >= 3 THEN 'actively_hiring' ELSE 'limited_hiring' END AS hiring_status,
      CASE WHEN blank THEN 0 WHEN soft THEN 10 ELSE least(100, 20 + CASE WHEN ats THEN 35 ELSE 0 END + CASE WHEN job_schema THEN 35 ELSE 0 END
        + CASE WHEN phrase THEN 15 ELSE 0 END + CASE WHEN cnt IS NOT NULL THEN 10 ELSE 0 END) END AS hiring_confidence,
      CASE WHEN NOT blank AND NOT soft AND evidence THEN cnt END AS open_role_count
    FROM (SELECT *, ats OR job_schema OR phrase OR coalesce(cnt, 0) > 0 AS evidence FROM {out}_flags))"""


CAREERS_SQL = """, wanted AS (SELECT site AS group_key, 'https://' || site AS homepage, unnest(['/careers', '/jobs', '/about/careers']) AS path, unnest([0, 1, 2]) AS path_ord FROM site_ends),
  career_pages AS (SELECT w.*, c.url AS careers_url, c.html FROM wanted w JOIN crawl c ON c.url = homepage || path WHERE status_code < 400)"""


def site_homepages(t: Tables):
    return t("site_ends").select(F.col("site").alias("group_key"), F.concat(F.lit("https://"), "site").alias("homepage"))


@query("careers_pages", "JOIN-9", "site_ends crawl", CAREERS_SQL + " SELECT group_key, careers_url, path_ord FROM career_pages")
def careers_pages(t: Tables):
    return W.careers_pages(site_homepages(t), t("crawl")).select("group_key", "careers_url", "path_ord")


@query(
    "careers_signal", "SCR-11", "site_ends crawl",
    CAREERS_SQL + careers_sql("career_pages", "signals") + " SELECT careers_url, hiring_status, hiring_confidence, open_role_count FROM signals",
)
def careers_signal(t: Tables):
    rows = W.careers_signal(W.careers_pages(site_homepages(t), t("crawl")))
    return rows.select("careers_url", "hiring_status", "hiring_confidence", "open_role_count")


_RANK = "CASE hiring_status WHEN 'actively_hiring' THEN 3 WHEN 'limited_hiring' THEN 2 WHEN 'no_verified_openings' THEN 1 ELSE 0 END"


def best_careers_sql(name: str) -> str:
    return f"SELECT group_key, hiring_status, hiring_confidence, open_role_count AS verified_open_role_count FROM (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY {_RANK} DESC, hiring_confidence DESC, path_ord) AS n FROM {name}) WHERE n = 1"


@query(
    "best_careers_page", "TOP-3", "site_ends crawl",
    CAREERS_SQL + careers_sql("career_pages", "signals") + " " + best_careers_sql("signals"),
)
def best_careers_page(t: Tables):
    return W.best_careers_page(W.careers_signal(W.careers_pages(site_homepages(t), t("crawl"))))


def _explode(source: str, html: str, out: str) -> str:
    raw = f"regexp_extract_all({html}, '{HREF_SQL}', 1)"
    return f""", {out} AS (SELECT group_key, company_name, regexp_replace(raw, '(?s)[?].*$', '') AS link, ord - 1 AS link_ord
      FROM (SELECT group_key, company_name, unnest({raw}) AS raw, generate_subscripts({raw}, 1) AS ord FROM {source}))"""


ENRICH_SQL = (
    ", sums AS (SELECT g.*, summary FROM site_groups g LEFT JOIN site_articles a ON a.link = g.source_url)"
    + _explode("sums", "summary", "l1") + candidate_sql("l1", "c1") + confidence_sql("c1", "s1") + f", b1 AS ({BEST.format('s1')})"
    + ", rest AS (SELECT g.*, c.html FROM site_groups g JOIN crawl c ON c.url = g.source_url WHERE g.group_key NOT IN (SELECT group_key FROM b1))"
    + _explode("rest", "html", "l2") + candidate_sql("l2", "c2") + confidence_sql("c2", "s2") + f", b2 AS ({BEST.format('s2')})"
    + ", homes AS (SELECT group_key, link AS homepage, confidence AS homepage_confidence, final_domain AS primary_domain FROM (SELECT * FROM b1 UNION ALL BY NAME SELECT * FROM b2))"
    + """, wanted AS (SELECT group_key, homepage, unnest(['/careers', '/jobs', '/about/careers']) AS path, unnest([0, 1, 2]) AS path_ord FROM homes),
  career_pages AS (SELECT w.*, c.url AS careers_url, c.html FROM wanted w JOIN crawl c ON c.url = regexp_replace(homepage, '/+$', '') || path WHERE status_code < 400)"""
    + careers_sql("career_pages", "signals")
    + f", hiring AS ({best_careers_sql('signals')})"
)


@query(
    "enrich_companies", "PIPE-6 JOIN-2 JOIN-8 JOIN-9", "site_groups site_articles crawl",
    ENRICH_SQL + """ SELECT group_key, homepage, homepage_confidence, primary_domain, coalesce(hiring_status, 'unknown') AS hiring_status,
      coalesce(hiring_confidence, 0) AS hiring_confidence, verified_open_role_count FROM site_groups LEFT JOIN homes USING (group_key) LEFT JOIN hiring USING (group_key)""",
)
def enrich_companies(t: Tables):
    rows = W.enrich_companies(t("site_groups"), t("site_articles"), t("crawl"))
    return rows.select(
        "group_key", "homepage", "homepage_confidence", "primary_domain", "hiring_status", "hiring_confidence",
        "verified_open_role_count",
    )


@query(
    "enrich_recrawled", "PIPE-6 JOIN-8 JOIN-9", "site_groups site_articles crawl",
    ENRICH_SQL + """ SELECT group_key, homepage, homepage_confidence, primary_domain, coalesce(hiring_status, 'unknown') AS hiring_status,
      coalesce(hiring_confidence, 0) AS hiring_confidence, verified_open_role_count FROM site_groups LEFT JOIN homes USING (group_key) LEFT JOIN hiring USING (group_key)""",
)
def enrich_recrawled(t: Tables):
    """Every page was crawled before, with another response and another text: only the last fetch counts."""
    now = t("crawl").withColumn("fetch_ord", F.lit(2))
    status = F.when(F.col("status_code") < 400, 404).otherwise(200)
    before = now.withColumns({"fetch_ord": F.lit(1), "status_code": status, "html": F.concat(F.lit("<p>we are hiring, 9 open roles</p>"), F.coalesce("html", F.lit("")))})
    rows = W.enrich_companies(t("site_groups"), t("site_articles"), before.unionByName(now))
    return rows.select(
        "group_key", "homepage", "homepage_confidence", "primary_domain", "hiring_status", "hiring_confidence",
        "verified_open_role_count",
    )
