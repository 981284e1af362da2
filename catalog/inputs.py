"""Operator inputs derived from the given tables.

Each input is one SELECT in the part of SQL that Spark and DuckDB share, so the
same text feeds the Spark query and its SQL check. ``{name}`` is a given table or
another input. Small macros cover what the dialects write differently.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from upswell.session import shared_folder, spread

NOW = "2001-08-01"

TABLES = ["customer", "nation", "region", "supplier", "orders", "events", "documents", "pages"]

MACROS = {
    "spark": {
        "ts": "timestamp_seconds({0})",
        # Spark's round drops the sign of a zero, which shows in text
        "tenths": "abs(round({0}, 1)) * signum({0})",
        "line": "substring_index({0}, chr(10), 1)",
        "rfc": "date_format({0}, 'EEE, dd MMM yyyy HH:mm:ss') || ' GMT'",
        "iso": "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    },
    "duckdb": {
        "ts": "make_timestamp(({0}) * 1000000)",
        "tenths": "round({0}, 1)",
        "line": "split_part({0}, chr(10), 1)",
        "rfc": "strftime({0}, '%a, %d %b %Y %H:%M:%S') || ' GMT'",
        "iso": "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')",
    },
}

INPUTS: dict[str, str] = {}

INPUTS["companies"] = f"""
SELECT cast(c_custkey AS string) AS company_id, c_custkey AS key, c_name AS canonical_name,
  'customer ' || lpad(cast(c_custkey AS string), 9, '0') AS normalized_name,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'c' || cast(c_custkey AS string) || '.com' END AS primary_domain,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'https://c' || cast(c_custkey AS string) || '.com' END AS homepage,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE cast(40 + c_custkey % 51 AS int) END AS homepage_confidence,
  n_name AS headquarters_country,
  'maker of ' || lower(c_mktsegment) || ' tools in ' || lower(n_name) AS description,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AI' WHEN 'BUILDING' THEN 'PropTech'
    WHEN 'MACHINERY' THEN 'Technology' WHEN 'HOUSEHOLD' THEN 'FinTech' ELSE 'Retail' END AS industry,
  CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN r_name = 'AMERICA' THEN 'US'
    WHEN r_name = 'ASIA' THEN 'INDIA' ELSE 'ROW' END AS region_bucket,
  CASE WHEN c_custkey % 29 = 0 THEN 'shut_down' ELSE 'operating' END AS company_status,
  CASE c_custkey % 4 WHEN 0 THEN 'actively_hiring' WHEN 1 THEN 'limited_hiring'
    WHEN 2 THEN 'no_verified_openings' ELSE 'unknown' END AS hiring_status,
  cast(c_custkey % 101 AS int) AS hiring_confidence,
  cast(c_custkey % 40 AS int) AS moat_confidence,
  c_custkey % 23 = 0 AS entity_resolution_needs_review,
  cast(1990 + c_custkey % 30 AS string) AS founded_year,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' ELSE 'A. Founder' END AS founders,
  CASE c_custkey % 3 WHEN 0 THEN 'Alpha Capital, Beta Ventures' WHEN 1 THEN 'Gamma Fund' ELSE NULL END AS investors,
  cast(DATE '{NOW}' - cast(c_custkey % 45 AS int) AS date) AS last_seen,
  cast(DATE '{NOW}' - cast(c_custkey % 120 AS int) AS date) AS last_verified,
  cast(c_custkey % 120 AS int) AS days_since_verified,
  c_custkey % 50 <> 0 AS active
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
"""

INPUTS["company_events"] = """
SELECT cast(o_custkey AS string) AS company_id,
  CASE o_orderkey % 12 WHEN 0 THEN 'funding_round_completed' WHEN 1 THEN 'funding_round_announced'
    WHEN 2 THEN 'acquisition' WHEN 3 THEN 'major_product_release' WHEN 4 THEN 'product_launch'
    WHEN 5 THEN 'customer_win' WHEN 6 THEN 'partnership' WHEN 7 THEN 'geographic_expansion'
    WHEN 8 THEN 'executive_change' WHEN 9 THEN 'hiring_growth' WHEN 10 THEN 'layoffs' ELSE 'other' END AS event_type,
  CASE WHEN o_orderkey % 5 < 3 THEN 'completed' WHEN o_orderkey % 5 = 3 THEN 'proposed' ELSE 'rumored' END AS verification_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'pre-seed' WHEN '2-HIGH' THEN 'seed' WHEN '3-MEDIUM' THEN 'series a'
    WHEN '4-NOT SPECIFIED' THEN 'series b' ELSE 'series c' END AS funding_stage,
  round(o_totalprice * 100, 2) AS amount_usd,
  o_orderdate AS published_at,
  'https://' || CASE o_orderkey % 8 WHEN 0 THEN 'techcrunch.com' WHEN 1 THEN 'www.reuters.com' WHEN 2 THEN 'prnewswire.com'
    WHEN 3 THEN 'blog.example.co.in' WHEN 4 THEN 'news.ycombinator.com' WHEN 5 THEN 'forbes.com' WHEN 6 THEN 'medium.com'
    ELSE 'c' || cast(o_custkey AS string) || '.com' END || '/a/' || cast(o_orderkey % 5 AS string)
    || CASE WHEN o_orderkey % 3 = 0 THEN '?utm_source=x&id=' || cast(o_orderkey % 2 AS string) ELSE '' END AS source_url,
  CASE o_orderkey % 8 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 5 THEN 2 WHEN 7 THEN 1 ELSE 3 END AS source_tier,
  'update ' || cast(o_orderkey % 9 AS string) AS title,
  'raised  a round ' || cast(o_orderkey % 4 AS string) AS evidence_text,
  cast(o_orderkey % 101 AS int) AS extraction_confidence,
  o_orderkey AS ingest_ord
FROM {orders}
"""

INPUTS["evidence"] = """
SELECT o_orderkey, cast(o_custkey AS string) AS company_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'funding_round_completed' WHEN 1 THEN 'funding_round_announced' WHEN 2 THEN 'acquisition' ELSE 'other' END AS event_type,
  CASE WHEN o_orderkey % 3 = 0 THEN 'proposed' ELSE 'completed' END AS verification_status,
  CASE o_orderkey % 9 WHEN 0 THEN 'Series A, led by X' WHEN 1 THEN 'Pre Seed round' WHEN 2 THEN 'seed' WHEN 3 THEN 'Series D'
    WHEN 4 THEN 'late-stage growth' WHEN 5 THEN 'Series B extension' WHEN 6 THEN '' WHEN 7 THEN 'bridge' ELSE NULL END AS value,
  'Company ' || CASE o_orderkey % 11 WHEN 0 THEN 'raised' WHEN 1 THEN 'is in talks to raise' WHEN 2 THEN 'is now valued at' WHEN 3 THEN 'reportedly wants'
    WHEN 4 THEN 'acquired the firm for' WHEN 5 THEN 'launched a new fund of' WHEN 6 THEN 'called off a raise of' WHEN 7 THEN 'has a total addressable market of'
    WHEN 8 THEN 'closed new funding of' WHEN 9 THEN 'praised worthy' ELSE 'spent' END || ' '
    || CASE o_orderkey % 10 WHEN 0 THEN '$' WHEN 1 THEN '€' WHEN 2 THEN '£' WHEN 3 THEN '₹' WHEN 4 THEN 'Rs. ' WHEN 5 THEN 'INR ' WHEN 6 THEN '¥' WHEN 7 THEN 'US$ ' WHEN 8 THEN 'SGD' ELSE '' END
    || cast(@tenths[o_totalprice / 1000] AS string)
    || CASE o_orderkey % 7 WHEN 0 THEN 'K' WHEN 1 THEN 'M' WHEN 2 THEN ' million' WHEN 3 THEN ' crore' WHEN 4 THEN 'bn' WHEN 5 THEN ' lakh' ELSE '' END
    || CASE WHEN o_orderkey % 13 = 0 THEN ' EUR' ELSE '' END || ' on 1,250 terms' AS evidence_text,
  o_orderpriority, o_orderdate
FROM {orders}
"""

INPUTS["feed_raw"] = """
SELECT source AS source_name, cast(substr(source, 4) AS int) AS source_ord, cast(doc_id AS int) AS item_ord,
  CASE WHEN doc_id % 23 = 0 THEN NULL ELSE @line[text] END AS title,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE text END AS summary,
  CASE WHEN doc_id % 8 = 0 THEN NULL ELSE text END AS description,
  CASE WHEN doc_id % 31 = 0 THEN NULL ELSE 'https://feed.example.com/' || md5(text) END AS link,
  CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'soon' WHEN 2 THEN @iso[@ts[978307200 + doc_id * 3600]] ELSE @rfc[@ts[978307200 + doc_id * 3600]] END AS published
FROM {documents}
"""

INPUTS["articles"] = """
SELECT CASE WHEN doc_id % 11 = 0 THEN 'Webinar: ' WHEN doc_id % 19 = 0 THEN 'Dow Jones update ' WHEN doc_id % 37 = 0 THEN 'Dow Jones and the startup ' ELSE '' END
    || @line[text] AS title,
  text AS summary,
  CASE WHEN doc_id % 29 = 0 THEN '' ELSE coalesce(url, 'https://wire.example.com/a/' || md5(text)) END AS link,
  @ts[978307200 + doc_id * 3600] AS published_ts,
  source AS source_name, cast(substr(source, 4) AS int) AS source_ord, cast(doc_id AS int) AS item_ord
FROM {documents} LEFT JOIN {pages} ON doc_id = page_id
"""

INPUTS["numbered"] = """
SELECT cast(floor(doc_id / 8) AS bigint) AS batch_id, cast(doc_id % 8 + 1 AS int) AS source_index,
  @line[text] AS title, text AS summary,
  'https://' || CASE doc_id % 4 WHEN 0 THEN 'techcrunch.com' WHEN 1 THEN 'forbes.com' WHEN 2 THEN 'medium.com' ELSE 'c' || cast(doc_id - doc_id % 3 AS string) || '.com' END
    || '/n/' || cast(doc_id AS string) AS link,
  source AS source_name, @ts[978307200 + (doc_id % 5000) * 3600] AS published_ts
FROM {documents}
"""

INPUTS["claims"] = """
SELECT cast(floor(d.doc_id / 8) AS bigint) AS batch_id,
  CASE WHEN d.doc_id % 13 = 0 THEN 0 WHEN d.doc_id % 17 = 0 THEN 9 ELSE cast(d.doc_id % 8 + 1 AS int) END AS source_index,
  CASE WHEN d.doc_id % 43 = 0 THEN ' ' WHEN d.doc_id % 41 = 0 THEN 'Spark' ELSE 'Customer#' || lpad(cast(d.doc_id - d.doc_id % 3 AS string), 9, '0')
    || CASE d.doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN ' Inc.' ELSE ', Labs' END END AS company_name,
  CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE 'idea ' || cast(d.doc_id % 10 AS string) END AS business_idea,
  CASE d.doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'AI' WHEN 2 THEN 'FinTech' WHEN 3 THEN 'PropTech' ELSE 'Technology' END AS industry,
  CASE d.doc_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Chennai, India' WHEN 2 THEN 'Mumbai' WHEN 3 THEN 'Austin, Texas' WHEN 4 THEN 'Indiana'
    WHEN 5 THEN 'Lausanne' WHEN 6 THEN 'Berlin' WHEN 7 THEN 'San Francisco, USA' ELSE 'u.s. east' END AS location,
  CASE d.doc_id % 5 WHEN 0 THEN 'funding_round_completed' WHEN 1 THEN 'product_launch' WHEN 2 THEN 'acquisition' WHEN 3 THEN 'partnership'
    ELSE CASE WHEN d.doc_id % 10 = 4 THEN 'ipo' ELSE 'other' END END AS event_type,
  CASE d.doc_id % 3 WHEN 0 THEN 'Series A, $8 million' WHEN 1 THEN 'seed' ELSE NULL END AS value,
  CASE WHEN d.doc_id % 2 = 0 THEN 'Alpha Capital, Beta Ventures' ELSE NULL END AS investors,
  CASE WHEN d.doc_id % 31 = 0 THEN '' WHEN d.doc_id % 7 = 0 THEN coalesce(substr(n.text, 10, 120), 'none found') ELSE substr(d.text, 10, 120) END AS evidence_excerpt,
  cast(d.doc_id % 108 AS double) AS confidence,
  CASE d.doc_id % 6 WHEN 0 THEN 'completed' WHEN 1 THEN 'completed' WHEN 2 THEN 'proposed' WHEN 3 THEN 'rumored' WHEN 4 THEN 'ambiguous' ELSE 'maybe' END AS status,
  'model-a' AS extraction_provider, d.doc_id AS ord
FROM {documents} d LEFT JOIN {documents} n ON n.doc_id = d.doc_id + 1
"""

# Responses as a model would send them: one JSON array per batch, some fenced, cut or missing.
INPUTS["response_parts"] = """
SELECT batch_id, ord, chr(123) || '"company_name": "' || company_name || '", "event_type": "' || event_type || '", "value": null, "evidence_excerpt": "quote '
    || cast(ord AS string) || '", "source_index": ' || cast(source_index AS string) || ', "confidence": ' || cast(cast(confidence AS int) AS string)
    || CASE WHEN ord % 21 = 0 THEN '' ELSE ', "status": "' || status || '"' END || chr(125) AS raw
FROM {claims}
"""

INPUTS["page_sites"] = """
SELECT page_id, url, html, replace(replace(regexp_extract(lower(url), '^https?://([^/?#:]+)', 1), '.example.', '.'), 'www.', '') AS site FROM {pages}
"""

INPUTS["site_pages"] = """
SELECT page_id, url, site, regexp_extract(site, '([^.]+)[.][^.]+$', 1) AS label,
  replace(html, '</body>', '<p>' || CASE page_id % 6 WHEN 0 THEN 'We are hiring: 5 open roles <a href="https://boards.greenhouse.io/' || site || '">apply now</a>'
      WHEN 1 THEN chr(123) || '"@type":"JobPosting"' || chr(125) WHEN 2 THEN 'Apply now' WHEN 3 THEN '0 positions today' WHEN 4 THEN 'Oops, page not found' ELSE 'hello' END || '</p>'
    || '<a href="https://' || site || '?utm_medium=x">home</a><a href="https://cdn.jsdelivr.net/app.js">s</a><a href=''http://twitter.com/' || site || '''>t</a>'
    || '<a href="javascript:void(0)">j</a><a href="https://' || site || '/logo.png">l</a><a href="https://www.linkedin.com/in/team-' || cast(page_id AS string) || '">p</a>'
    || CASE WHEN page_id % 3 = 0 THEN '<a href="mailto:team@' || site || '">m</a>' WHEN page_id % 3 = 1 THEN 'write to info@' || site || ' now' ELSE '' END || '</body>') AS html
FROM {page_sites}
"""

INPUTS["site_ends"] = """
SELECT site, min(page_id) AS first_page, max(page_id) AS last_page FROM {site_pages} GROUP BY site
"""

# Pages as crawled: the given ones, a homepage per site, and up to two careers pages per site.
INPUTS["crawl_all"] = """
SELECT url, CASE WHEN page_id % 29 = 0 THEN 'https://twitter.com/moved' ELSE url END AS final_url,
  CASE WHEN page_id % 17 = 0 THEN 404 ELSE 200 END AS status_code,
  CASE WHEN page_id % 13 = 0 THEN 'image/avif' WHEN page_id % 14 = 0 THEN NULL ELSE 'text/html; charset=utf-8' END AS content_type,
  html, page_id AS fetch_ord FROM {site_pages}
UNION ALL
SELECT 'https://' || p.site, CASE WHEN page_id % 29 = 0 THEN 'https://twitter.com/moved' ELSE 'https://' || p.site END, CASE WHEN page_id % 17 = 0 THEN 404 ELSE 200 END,
  CASE WHEN page_id % 13 = 0 THEN 'image/avif' ELSE 'text/html' END, html, page_id FROM {site_pages} p JOIN {site_ends} e ON p.site = e.site AND page_id = first_page
UNION ALL
SELECT 'https://' || p.site || '/careers', 'https://' || p.site || '/careers', CASE WHEN page_id % 19 = 0 THEN 500 ELSE 200 END, 'text/html',
  CASE WHEN page_id % 6 = 4 THEN '<h1>Oops, page not found</h1>' WHEN page_id % 11 = 0 THEN '' ELSE html END, page_id FROM {site_pages} p JOIN {site_ends} e ON p.site = e.site AND page_id = first_page
UNION ALL
SELECT 'https://' || p.site || '/jobs', 'https://' || p.site || '/jobs', 200, 'text/html', html, page_id FROM {site_pages} p JOIN {site_ends} e ON p.site = e.site AND page_id = last_page
"""

INPUTS["crawl"] = """
SELECT url, final_url, status_code, content_type, html, fetch_ord FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetch_ord DESC, final_url, content_type, status_code, html) AS nth FROM {crawl_all}) x WHERE nth = 1
"""

INPUTS["site_groups"] = """
SELECT p.site AS group_key, label AS company_name, url AS source_url FROM {site_pages} p JOIN {site_ends} e ON p.site = e.site AND page_id = first_page
"""

INPUTS["site_articles"] = """
SELECT url AS link, CASE WHEN page_id % 2 = 0 THEN '<p>News <a href="https://' || site || '?x=1">site</a> <a href="https://cdn.jsdelivr.net/a.js">x</a></p>' ELSE 'no link here' END AS summary,
  site, page_id FROM {site_pages}
"""

# A whole run: documents that have a page of the same number name that page's site and
# link to it; their claims are about the site's company.
INPUTS["run_numbered"] = """
SELECT n.batch_id, n.source_index, n.title, n.summary || CASE WHEN s.site IS NULL THEN '' ELSE ' <a href="https://' || s.site || '?ref=n">' || s.label || '</a>' END AS summary,
  n.link, n.source_name, n.published_ts
FROM {numbered} n LEFT JOIN {site_pages} s ON s.page_id = n.batch_id * 8 + n.source_index - 1
"""

INPUTS["run_claims"] = """
SELECT c.batch_id, c.source_index, coalesce(s.label, c.company_name) AS company_name, c.business_idea, c.industry, c.location, c.event_type, c.value, c.investors,
  c.evidence_excerpt, c.confidence, c.status, c.batch_id * 16777216 + c.ord % 8 AS ord
FROM {claims} c LEFT JOIN {site_pages} s ON s.page_id = c.ord
"""

INPUTS["candidates"] = """
SELECT 'k' || cast(c_custkey AS string) AS candidate_id,
  CASE c_custkey % 5 WHEN 0 THEN 'Other Spelling ' || cast(c_custkey AS string) WHEN 1 THEN 'Alias ' || cast(c_custkey AS string) || ', Inc.'
    WHEN 2 THEN c_name || ' Ltd' WHEN 3 THEN 'Spark' ELSE 'Unseen ' || cast(c_custkey AS string) END AS company_name,
  CASE WHEN c_custkey % 5 = 0 THEN 'https://www.c' || cast(c_custkey + 1 AS string) || '.com/about' WHEN c_custkey % 35 = 4 THEN 'shared.io' ELSE NULL END AS primary_domain,
  n_name AS headquarters_country,
  CASE WHEN c_custkey % 2 = 0 THEN 'maker of ' || lower(c_mktsegment) || ' tools in ' || lower(n_name) ELSE 'something else entirely' END AS description,
  c_custkey AS first_ord
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

# One more known company, named "Spark", and one name held by two companies.
INPUTS["known_companies"] = """
SELECT company_id, canonical_name, CASE WHEN key = 1 THEN 'spark' WHEN key % 50 = 7 THEN 'customer 000000002' ELSE normalized_name END AS normalized_name,
  primary_domain, headquarters_country, description FROM {companies}
"""

INPUTS["aliases"] = """
SELECT cast(c_custkey AS string) AS company_id, 'alias ' || cast(c_custkey AS string) AS normalized_alias, 'Alias ' || cast(c_custkey AS string) AS alias
FROM {customer} WHERE c_custkey % 2 = 1
"""

INPUTS["field_updates"] = """
SELECT cast(c_custkey AS string) AS company_id, 'headquarters_country' AS field,
  CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' ELSE n_name END AS existing_value,
  CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN n_name ELSE 'NATION_' || cast(c_custkey % 25 AS string) END AS new_value,
  cast(c_custkey % 101 AS int) AS existing_confidence, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE cast(c_custkey * 7 % 101 AS int) END AS new_confidence,
  cast(c_custkey % 3 + 1 AS int) AS existing_tier, cast(c_custkey % 2 + 2 AS int) AS new_tier, c_custkey % 40 = 0 AS clearly_newer
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

INPUTS["snapshots"] = """
SELECT company_id, run_ts, region_bucket, momentum_score,
  cast(row_number() OVER (PARTITION BY region_bucket, run_ts ORDER BY momentum_score DESC, company_id) AS int) AS regional_rank
FROM (
  SELECT c.company_id, cast(cast(extract(year FROM o_orderdate) AS string) || '-12-31' AS date) AS run_ts, coalesce(region_bucket, 'ROW') AS region_bucket,
    cast(least(100, floor(max(o_totalprice) / 5000)) AS int) AS momentum_score
  FROM {orders} JOIN {companies} c ON cast(o_custkey AS string) = c.company_id GROUP BY 1, 2, 3) y
"""

INPUTS["runs"] = """
SELECT 'run-' || cast(d AS string) AS run_id, d AS started_at, d AS finished_at,
  CASE WHEN extract(day FROM d) % 9 = 0 THEN 'failed' WHEN extract(day FROM d) % 4 = 0 THEN 'success_with_warnings' ELSE 'success' END AS run_status,
  extract(day FROM d) % 4 <> 0 AS published, n AS articles_fetched, CASE WHEN n % 2 = 0 THEN 'report of ' || cast(n AS string) ELSE NULL END AS quality_report
FROM (SELECT cast(ts AS date) AS d, count(*) AS n FROM {events} GROUP BY 1) z
"""

INPUTS["startups"] = """
SELECT CASE WHEN c_custkey % 9 = 0 THEN upper(c_name) || '.' ELSE c_name END AS company_name,
  CASE c_custkey % 4 WHEN 0 THEN 'India (Chennai)' WHEN 1 THEN 'USA' WHEN 2 THEN 'Rest of World' ELSE 'Unknown' END AS region,
  CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'http://www.shared' || cast(c_custkey % 30 AS string) || '.io/x' WHEN 2 THEN 'c' || cast(c_custkey AS string) || '.com' ELSE 'https://c' || cast(c_custkey AS string) || '.com/' END AS homepage,
  'idea ' || cast(c_custkey % 1000 AS string) AS business_idea,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS industry, c_mktsegment AS sector,
  cast(1990 + c_custkey % 30 AS string) AS year_founded, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'A. Founder' END AS founder_name,
  CASE c_custkey % 7 WHEN 0 THEN 'Pre-seed' WHEN 1 THEN 'Seed' WHEN 2 THEN 'Series A' WHEN 3 THEN 'Series B' WHEN 4 THEN 'Series E' WHEN 5 THEN NULL ELSE 'bridge' END AS funding_stage,
  CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN '$8 million' ELSE '$' || cast(@tenths[c_acctbal / 10] AS string) || CASE c_custkey % 3 WHEN 0 THEN 'K' WHEN 1 THEN 'M' ELSE 'b' END END AS funding_amount,
  CASE WHEN c_custkey % 2 = 0 THEN 'Alpha Capital' ELSE NULL END AS investors,
  CASE WHEN c_custkey % 3 = 0 THEN 'Likely hiring' ELSE 'Unknown' END AS hiring_status,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'a@c.com' END AS contact_email,
  CASE WHEN c_custkey % 11 = 0 THEN cast(c_custkey % 100 AS int) ELSE NULL END AS momentum_score, cast(c_custkey % 6 AS int) AS signal_score,
  cast(DATE '2001-08-01' - cast(c_custkey % 45 AS int) AS date) AS last_updated, c_custkey AS ord
FROM {customer}
"""

_NAME = re.compile(r"\{(\w+)\}")


def _expand(sql: str, dialect: str) -> str:
    macros = MACROS[dialect]
    inner = re.compile(r"@(\w+)\[([^\[\]]*)\]")
    while inner.search(sql):
        sql = inner.sub(lambda m: macros[m.group(1)].format(m.group(2)), sql)
    return sql


# Inputs that stand for a landed table but take several joins to derive; they are
# written once per query, so that each later scan reads only the columns it needs.
LANDED = {"crawl"}
# Tables with costly work per row, given here as one file each.
WIDE = {"documents", "orders", "pages"}


def load(spark: SparkSession, sf_dir: str, name: str, cache: dict[str, DataFrame] | None = None) -> DataFrame:
    """The frame of an input or a given table."""
    seen = {} if cache is None else cache
    if name not in seen:
        if name in INPUTS:
            sql = _expand(INPUTS[name], "spark")
            frames = {n: load(spark, sf_dir, n, seen) for n in _NAME.findall(sql)}
            df = spark.sql(sql, **frames)
            if name in LANDED:
                path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
                df.write.parquet(path)
                df = spark.read.schema(df.schema).parquet(path)
            seen[name] = df
        else:
            df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            seen[name] = spread(df) if name in WIDE else df
    return seen[name]


def with_clause(names: list[str]) -> str:
    """``WITH`` list of the named inputs and all they need, in order."""
    done: list[str] = []

    def add(name: str) -> None:
        if name in INPUTS and name not in done:
            for n in _NAME.findall(INPUTS[name]):
                add(n)
            done.append(name)

    for n in names:
        add(n)
    return ",\n".join(f"{n} AS ({_NAME.sub(lambda m: m.group(1), _expand(INPUTS[n], 'duckdb'))})" for n in done)
