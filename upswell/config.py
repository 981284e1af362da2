"""Fixed values of the data model, and the small config frames made from them.

Every operator that uses one of these takes it as an argument, so a caller can
pass another list or frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SCORE_VERSION = "v2"

# --- fixed values: landed feeds -------------------------------------------------
FEED_ITEM_CAP = 25
HITS_PER_QUERY = 20
ITEM_URL_PREFIX = "https://news.ycombinator.com/item?id="
SEARCH_SOURCE_NAME = "Hacker News"
NEWS_TOP_K = 60
NEWS_KEEP_DAYS = 14
CLAIM_BATCH_SIZE = 8
COMPANY_BATCH_SIZE = 6

# --- fixed values: headline noise (matched as whole words, any case) --------------
NOISE_PATTERNS = [
    "webinar", "register now", "call for (?:speakers|papers|applications)",
    "early[- ]bird (?:tickets|pricing)", "sponsored", "promo(?:tion)?",
    "watch now", "live stream", "podcast episode", "horoscope",
    "recipe", "movie review", "tv review", "now streaming",
    "job openings? at", "discount code", "coupon", "black friday", "cyber monday",
]
MARKET_PATTERNS = [
    "fed(?:eral reserve)? (?:raises|cuts|holds) rates", "stock market (?:rises|falls|closes)",
    "dow jones", "nasdaq (?:closes|rises|falls)", "s&p 500",
]
STARTUP_TERMS = [
    "startup", "funding round", "seed round", "series a", "series b",
    "series c", "venture capital", "vc firm", "valuation", "co-founder",
    "acquisition", "product launch", "ai company", "fintech", "proptech",
    "unicorn",
]

# --- fixed values: links that are never a homepage ---------------------------------
ASSET_EXTENSIONS = [
    "js", "mjs", "css", "png", "jpg", "jpeg", "gif", "svg", "webp", "avif", "ico",
    "woff", "woff2", "ttf", "otf", "eot", "pdf", "mp4", "mp3", "zip", "json", "xml", "csv",
]
NON_HTML_TYPES = [
    "image/", "font/", "video/", "audio/", "application/javascript", "text/javascript",
    "text/css", "application/json", "application/pdf", "application/octet-stream",
    "application/zip",
]
TRACKING_MARKERS = [
    "/gtm.js", "/gtag/", "/analytics.js", "/pixel", "/track?", "/beacon",
    "/collect?", "/ga.js", "utm_source=", "fbclid=",
]
DENYLIST = {
    "cdn": [
        "cloudfront.net", "akamaized.net", "akamaihd.net", "fastly.net", "cloudflare.com",
        "jsdelivr.net", "unpkg.com", "gstatic.com", "googleusercontent.com", "wp.com",
        "imgix.net", "cdninstagram.com", "bootstrapcdn.com", "jquery.com", "polyfill.io",
    ],
    "ad_tracking": [
        "doubleclick.net", "googlesyndication.com", "googletagmanager.com",
        "googletagservices.com", "google-analytics.com", "googleadservices.com",
        "adservice.google.com", "adnxs.com", "taboola.com", "outbrain.com", "criteo.com",
        "scorecardresearch.com", "quantserve.com", "hotjar.com", "segment.io", "segment.com",
        "mixpanel.com", "amplitude.com", "chartbeat.com", "moatads.com",
        "amazon-adsystem.com", "pubmatic.com", "rubiconproject.com", "openx.net",
        "bidswitch.net", "adsrvr.org",
    ],
    "social": [
        "twitter.com", "x.com", "facebook.com", "instagram.com", "linkedin.com",
        "youtube.com", "tiktok.com", "pinterest.com", "reddit.com", "threads.net",
        "mastodon.social", "medium.com", "substack.com",
    ],
    "publication": [
        "techcrunch.com", "venturebeat.com", "fastcompany.com", "yourstory.com", "inc42.com",
        "entrackr.com", "eu-startups.com", "siliconcanals.com", "techinasia.com",
        "prnewswire.com", "businesswire.com", "globenewswire.com", "news.ycombinator.com",
        "ycombinator.com", "github.com", "wikipedia.org", "crunchbase.com", "bloomberg.com",
        "reuters.com", "forbes.com", "theverge.com", "wired.com", "axios.com", "cnbc.com",
        "wsj.com", "nytimes.com", "economictimes.indiatimes.com", "livemint.com",
        "moneycontrol.com", "apple.com", "play.google.com", "apps.apple.com", "google.com",
        "amazon.com",
    ],
    "platform": [
        "apps.apple.com", "play.google.com", "chrome.google.com", "producthunt.com",
        "angel.co", "wellfound.com", "glassdoor.com", "indeed.com", "ziprecruiter.com",
    ],
}
DENYLIST_V1 = [
    "twitter.com", "x.com", "linkedin.com", "facebook.com", "instagram.com", "youtube.com",
    "medium.com", "crunchbase.com", "techcrunch.com", "venturebeat.com", "fastcompany.com",
    "yourstory.com", "inc42.com", "entrackr.com", "eu-startups.com", "siliconcanals.com",
    "techinasia.com", "prnewswire.com", "businesswire.com", "news.ycombinator.com",
    "github.com", "wikipedia.org", "apple.com", "google.com", "play.google.com",
    "apps.apple.com",
]
TWO_PART_SUFFIXES = [
    "co.in", "co.uk", "co.jp", "com.au", "com.br", "com.sg", "com.cn", "co.nz", "co.za",
    "com.mx", "ne.jp", "or.jp", "org.uk", "net.in",
]
TRACKING_QUERY_KEYS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid",
    "gclid", "mc_cid", "mc_eid", "ref", "ref_src",
]
DANGEROUS_SCHEMES = ["javascript", "data", "vbscript", "file"]

# --- fixed values: names ---------------------------------------------------------
NAME_SUFFIXES = [
    "incorporated", "inc", "ltd", "limited", "llc", "llp", "pvt", "pte", "corp",
    "corporation", "co", "gmbh", "plc", "sas", "pbc", "holdings?", "group",
    "technologies", "technology", "solutions", "labs", "ai",
]
AMBIGUOUS_NAMES = [
    "clay", "warp", "preview", "notion", "linear", "ramp", "brex", "arc", "float", "flow",
    "pulse", "spark", "atlas", "compass", "anchor", "base", "core", "edge", "grid", "loop",
    "orbit", "prism", "vault", "zenith", "current", "range", "scale", "shift", "wave",
    "beam", "nova", "echo",
]
UNKNOWN_WORDS = ["unknown", "n/a", "na", "none", "not yet verified", "not available", "tbd", ""]

# --- fixed values: claims and events -----------------------------------------------
EVENT_TYPES = [
    "funding_round_completed", "funding_round_announced", "proposed_funding",
    "valuation_report", "acquisition", "product_launch", "major_product_release",
    "customer_win", "partnership", "geographic_expansion", "executive_change",
    "hiring_growth", "layoffs", "shutdown", "other",
]
MATERIAL_EVENT_TYPES = [
    "funding_round_completed", "funding_round_announced", "proposed_funding",
    "valuation_report", "acquisition", "customer_win", "layoffs", "shutdown",
]
CLAIM_STATUSES = ["completed", "proposed", "rumored", "abandoned", "ambiguous"]
VERIFICATION_STATUSES = CLAIM_STATUSES + ["unverified"]
REQUIRED_FIELDS = ["confidence", "event_type", "evidence_excerpt", "source_index", "status", "value"]
MIN_EVIDENCE_OVERLAP = 0.6
FUNDING_TYPES = ["funding_round_completed", "funding_round_announced"]

# event type, base value, component it feeds
EVENT_VALUES = [
    ("funding_round_completed", 100, "recent_verified_events"),
    ("funding_round_announced", 70, "recent_verified_events"),
    ("acquisition", 90, "recent_verified_events"),
    ("major_product_release", 70, "traction"),
    ("product_launch", 55, "traction"),
    ("customer_win", 60, "traction"),
    ("partnership", 50, "market_expansion"),
    ("geographic_expansion", 50, "market_expansion"),
    ("executive_change", 25, "recent_verified_events"),
    ("hiring_growth", 35, "recent_verified_events"),
]
COUNTABLE_STATUSES = ["completed"]
HALF_LIFE_DAYS = 45.0
MISSING_AGE_DAYS = 9999

# --- fixed values: money --------------------------------------------------------------
RATES_DATE = "2026-01-01"
RATES_PER_USD = {
    "USD": 1.0, "EUR": 0.92, "GBP": 0.79, "INR": 83.0, "SGD": 1.34, "AUD": 1.52,
    "CAD": 1.36, "JPY": 149.0, "AED": 3.67, "CNY": 7.24,
}
CURRENCY_SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP", "₹": "INR", "¥": "JPY"}
AMOUNT_UNITS = {
    "k": 1e3, "thousand": 1e3, "m": 1e6, "mn": 1e6, "million": 1e6, "b": 1e9, "bn": 1e9,
    "billion": 1e9, "cr": 1e7, "crore": 1e7, "lakh": 1e5, "lac": 1e5,
}
# statement classes, first match wins
STATEMENT_MARKERS = [
    ("valuation", [
        "valued at", "valuation of", "valuing the company", "post-money valuation",
        "pre-money valuation", "worth", "valuation reaches", "valuation",
    ]),
    ("acquisition", [
        "acquired", "acquires", "acquisition of", "to be acquired", "buys", "bought by",
        "acqui-hire",
    ]),
    ("tam", [
        "total addressable market", "tam of", "market opportunity of", "market size of",
    ]),
    ("fund_size", [
        "fund of", "new fund", "raised a fund", "launches a", "vc fund", "debut fund",
        "flagship fund", "million fund", "billion fund",
    ]),
    ("abandoned", [
        "called off", "abandoned", "shelved", "fell through", "no longer pursuing",
    ]),
    ("rumored", [
        "reportedly", "sources say", "according to sources", "rumored", "rumoured",
        "said to be", "understood to be",
    ]),
    ("proposed", [
        "in talks", "in discussions", "is seeking", "looking to raise", "planning to raise",
        "reportedly seeking", "may raise", "considering", "exploring a raise",
        "hopes to raise", "targets a raise", "in the process of raising",
    ]),
    ("completed", [
        "raised", "closes", "closed", "secures", "secured", "completes", "completed",
        "announced today", "has raised",
    ]),
]

# --- fixed values: source tiers ----------------------------------------------------------
TIER_2_DOMAINS = [
    "techcrunch.com", "venturebeat.com", "fastcompany.com", "theverge.com", "wired.com",
    "bloomberg.com", "reuters.com", "forbes.com", "axios.com", "cnbc.com", "wsj.com",
    "nytimes.com", "businessinsider.com", "yourstory.com", "inc42.com", "entrackr.com",
    "economictimes.indiatimes.com", "livemint.com", "moneycontrol.com", "eu-startups.com",
    "siliconcanals.com", "techinasia.com", "sifted.eu", "tech.eu",
]
TIER_3_DOMAINS = [
    "news.ycombinator.com", "prnewswire.com", "businesswire.com", "globenewswire.com",
    "medium.com", "substack.com", "reddit.com",
]

# --- fixed values: regions ------------------------------------------------------------------
INDIA_TERMS = [
    "india", "bangalore", "bengaluru", "mumbai", "new delhi", "delhi", "hyderabad", "pune",
    "gurgaon", "gurugram", "noida", "kolkata", "ahmedabad", "chennai",
]
USA_TERMS = [
    "usa", "u.s.", "united states", "california", "new york", "san francisco", "seattle",
    "boston", "chicago", "austin", "los angeles", "miami", "silicon valley", "texas",
    "washington", "denver", "atlanta",
]
REGIONS = ["US", "INDIA", "ROW"]
SUPPORTED_INDUSTRIES = [
    "AI", "Enterprise & Developer Tech", "FinTech", "PropTech", "Real Estate Technology",
    "Technology",
]
INELIGIBLE_STATUSES = ["shut_down", "acquired", "public_incumbent"]
TARGET_PER_REGION = 50

# --- fixed values: careers and homepage pages ---------------------------------------------
CAREERS_PATHS = ["/careers", "/jobs", "/about/careers"]
ATS_DOMAINS = [
    "greenhouse.io", "lever.co", "ashbyhq.com", "workable.com", "bamboohr.com",
    "smartrecruiters.com", "myworkdayjobs.com", "breezy.hr", "jazzhr.com", "recruitee.com",
    "rippling.com", "wellfound.com/company", "join.com",
]
JOB_SCHEMA_MARKERS = ['"@type":"jobposting"', '"@type": "jobposting"', "schema.org/jobposting"]
OPEN_ROLE_PHRASES = [
    "open position", "open positions", "open role", "open roles", "current openings",
    "we're hiring", "we are hiring", "join our team", "apply now", "view all jobs",
    "view open roles", "current opportunities",
]
SOFT_404_MARKERS = [
    "page not found", "404 not found", "oops", "nothing here", "this page doesn't exist",
    "we couldn't find that page", "coming soon",
]
HIRING_PHRASES_V1 = [
    "we're hiring", "were hiring", "open positions", "join our team", "open roles",
    "current openings", "we are hiring",
]
HOMEPAGE_MIN_CONFIDENCE = 50

# --- fixed values: scores ----------------------------------------------------------------------
WEIGHTS = {
    "recent_verified_events": 0.25, "traction": 0.20, "stage_adjusted_funding": 0.15,
    "hiring_momentum": 0.15, "market_expansion": 0.10, "moat_differentiation": 0.10,
    "source_corroboration": 0.05,
}
COMPONENT_LABELS = {
    "recent_verified_events": "recent verified events",
    "traction": "product/customer traction",
    "stage_adjusted_funding": "stage-adjusted funding momentum",
    "hiring_momentum": "verified hiring momentum",
    "market_expansion": "market expansion/partnerships",
    "moat_differentiation": "technology differentiation/moat",
    "source_corroboration": "independent source corroboration",
}
LIMITED_SIGNAL_TEXT = "Ranked on limited verified signal; see component scores."
WEIGHTS_V1 = {
    "funding_stage": 0.35, "funding_amount": 0.30, "investor_presence": 0.15,
    "hiring_signal": 0.20,
}
CONFIDENCE_FIELDS_V1 = [
    "funding_stage", "funding_amount", "investors", "founder_name", "year_founded",
    "homepage", "contact_email", "hiring_status",
]
COMPLETENESS_FIELDS = [
    "primary_domain", "description", "industry", "founded_year", "founders",
    "headquarters_country", "homepage", "hiring_status",
]
CONFIDENCE_WEIGHTS = {
    "source_tier": 0.30, "corroboration": 0.20, "freshness": 0.15, "completeness": 0.15,
    "resolution_confidence": 0.10, "extraction_confidence": 0.10,
}
HIRING_BASE = {"actively_hiring": 90, "limited_hiring": 50, "no_verified_openings": 10, "unknown": 0}
MIN_PEERS = 5
STAGE_THRESHOLDS = {
    "pre-seed": [(100_000, 40), (300_000, 60), (750_000, 80), (1_500_000, 100)],
    "seed": [(500_000, 40), (1_500_000, 60), (3_000_000, 80), (6_000_000, 100)],
    "series a": [(3_000_000, 40), (8_000_000, 60), (18_000_000, 80), (35_000_000, 100)],
    "series b": [(10_000_000, 40), (25_000_000, 60), (50_000_000, 80), (90_000_000, 100)],
    "series c": [(25_000_000, 40), (60_000_000, 60), (120_000_000, 80), (250_000_000, 100)],
    "growth": [(75_000_000, 40), (150_000_000, 60), (300_000_000, 80), (600_000_000, 100)],
}
STALE_WARN_DAYS = 30
STALE_EXCLUDE_DAYS = 90
CONFIDENCE_BANDS = [("0-19", 0, 19), ("20-39", 20, 39), ("40-59", 40, 59), ("60-79", 60, 79), ("80-100", 80, 100)]

# --- fixed values: launch gate (metric, min or max, bound) -----------------------------------
QUALITY_RULES = [
    ("pct_ranked_with_verified_regional_assignment", "min", 100.0),
    ("pct_ranked_with_valid_primary_domain", "min", 100.0),
    ("pct_material_funding_claims_with_evidence", "min", 100.0),
    ("invalid_homepage_count", "max", 0.0),
    ("pct_ranked_with_confidence_ge_70", "min", 80.0),
    ("pct_ranked_with_recent_verified_event", "min", 70.0),
    ("pct_ranked_with_two_sources_or_authoritative", "min", 60.0),
    ("valuation_shown_as_funding_count", "max", 0.0),
]


@dataclass(frozen=True)
class EligibilityConfig:
    """Bounds of the eligibility gate."""

    event_window_days: int = 180
    min_confidence: int = 60
    min_sources: int = 1
    stale_exclude_days: int = STALE_EXCLUDE_DAYS


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{v!r}D" if isinstance(v, float) else str(v)


def _frame(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A frame of literals. The planner knows its exact size, so it broadcasts it by its
    own size check; no hint is needed anywhere."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def weights_frame(spark: SparkSession, weights: dict[str, float] | None = None) -> DataFrame:
    return _frame(spark, [(c, float(w)) for c, w in (weights or WEIGHTS).items()], "component, weight")


def rates_frame(spark: SparkSession) -> DataFrame:
    rows = [(c, r, RATES_DATE) for c, r in RATES_PER_USD.items()]
    return _frame(spark, rows, "currency, per_usd, as_of").selectExpr(
        "currency", "per_usd", "cast(as_of as date) as as_of"
    )


def tiers_frame(spark: SparkSession) -> DataFrame:
    rows = [(d, 2) for d in TIER_2_DOMAINS] + [(d, 3) for d in TIER_3_DOMAINS]
    return _frame(spark, rows, "domain, tier")


def denylist_frame(spark: SparkSession) -> DataFrame:
    """Union of the category lists; a domain listed twice keeps its first category."""
    seen: dict[str, str] = {}
    for category, domains in DENYLIST.items():
        for d in domains:
            seen.setdefault(d, category)
    return _frame(spark, list(seen.items()), "domain, category")


def event_values_frame(spark: SparkSession) -> DataFrame:
    return _frame(spark, EVENT_VALUES, "event_type, base, component")


def stage_thresholds_frame(spark: SparkSession) -> DataFrame:
    rows = [(s, float(lo), p) for s, steps in STAGE_THRESHOLDS.items() for lo, p in steps]
    return _frame(spark, rows, "stage, min_usd, points")


def regions_frame(spark: SparkSession) -> DataFrame:
    return _frame(spark, [(r,) for r in REGIONS], "region_bucket")


def bands_frame(spark: SparkSession) -> DataFrame:
    return _frame(spark, CONFIDENCE_BANDS, "band, lo, hi")
