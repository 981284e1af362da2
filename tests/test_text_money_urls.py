"""Known answers of the column expressions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from upswell.functions import money as M
from upswell.functions import text as X
from upswell.functions import urls as U
from upswell.operators.claims import region_of
from upswell.sources.feeds import published_time, relevant


def test_amounts(column):
    texts = [
        "raised $4.2M in seed funding", "a $500K pre-seed round", "secured $1.1B in Series C", "closed a €12 million round",
        "raised £3.5m", "raised ₹35 crore", "raised INR 2.5 Cr", "raised Rs 50 lakh", "raised 50 million in funding",
        "no amount mentioned here", "Rs. 1,250", "12 million EUR", None,
    ]
    want = [
        (4_200_000, "USD"), (500_000, "USD"), (1.1e9, "USD"), (12e6, "EUR"), (3.5e6, "GBP"), (350e6, "INR"), (25e6, "INR"),
        (5e6, "INR"), (50e6, None), (None, None), (1250, "INR"), (12e6, "EUR"), (None, None),
    ]
    amounts = column(lambda c: M.amount_value(M.amount_parts(c)), texts)
    currencies = column(lambda c: M.amount_currency(M.amount_parts(c)), texts)
    assert amounts == [a for a, _ in want]
    assert [c if a is not None else None for a, c in zip(amounts, currencies)] == [c for _, c in want]


def test_dollar_amount_keeps_the_narrow_form(column):
    assert column(M.dollar_amount, ["$4.2M", "$8 million", "$500k now", "€5M"]) == [4_200_000, None, 500_000, None]


def test_statement_classes(column):
    cases = {
        "The company is now valued at $2 billion after the round.": "valuation",
        "The startup raised $10 million in a Series A round led by Acme Ventures.": "completed",
        "It raised its Series B at a $500 million valuation.": "valuation",
        "Acme Corp acquired the startup for $80 million.": "acquisition",
        "The company operates in a market with a total addressable market of $50 billion.": "tam",
        "The VC firm launched a new $200 million fund focused on fintech.": "fund_size",
        "The startup is reportedly in talks to raise $20 million.": "rumored",
        "The proposed funding round was called off after due diligence concerns.": "abandoned",
        "The company is planning to raise $5 million in seed funding.": "proposed",
        "seeks new funding": "ambiguous", "": "ambiguous", "praised by all": "ambiguous", "éraised": "ambiguous",
    }
    assert column(M.statement_class, list(cases)) == list(cases.values())


def test_stages(column):
    cases = {
        "Pre Seed": "pre-seed", "preseed": "pre-seed", "Seed": "seed", "Series A ext": "series a", "Series B": "series b",
        "Series D": "series c", "Series G": "series c", "late-stage": "growth", "Growth": "growth", "bridge": "unknown", "": "unknown",
    }
    assert column(M.funding_stage, list(cases)) == list(cases.values())


def test_names(column):
    cases = {
        "OpenAI, Inc.": "openai", "Acme Labs Pvt. Ltd.": "acme", "Beta-AI Technologies": "beta", "AI": "", "Éclair Group": "clair",
        "Main Holdings": "main", "Incline": "incline", None: "",
    }
    assert column(X.normalize_name, list(cases)) == list(cases.values())
    assert column(X.name_key, ["AI", "Acme Inc"]) == ["ai", "acme"]


def test_overlap_jaccard_fingerprint(one):
    assert one(X.evidence_overlap, "Raised $8 million", "it RAISED 8 million today") == 1.0
    assert one(X.evidence_overlap, "!!", "text") == 0.0
    assert one(X.jaccard, "a b c", "B c d") == pytest.approx(0.5)
    assert one(X.jaccard, "", "x") == 0.0
    want = hashlib.sha256(b"acme raises full article body").hexdigest()
    assert one(X.fingerprint, "Acme  raises", "full  article\n body ") == want


def test_page_text_and_contacts(one):
    html = "<script>x@y.com</script><style>p{}</style><p>Hello <b>there</b></p><a href='MAILTO:team@acme.io'>m</a> info@b.co"
    assert one(X.visible_text, html) == "Hello there m info@b.co"
    assert one(X.contact_email, html) == "team@acme.io"
    assert one(X.contact_email, "write info@b.co now") == "info@b.co"
    assert one(X.contact_email, "nothing") is None
    assert one(X.profile_link, "see https://www.linkedin.com/in/jo-do/ ok") == "https://www.linkedin.com/in/jo-do/"


def test_registrable_domains(column):
    cases = {
        "https://www.Acme.com/x": "acme.com", "acme.co.in": "acme.co.in", "https://a.b.acme.co.uk:8080/": "acme.co.uk",
        "blog.acme.io": "acme.io", "http://user:pw@x.acme.io/p": "acme.io", "localhost": "localhost", "": None, None: None,
        "foo.com/?u=http://bar.com": None, " https://acme.com ": "acme.com", "https://acme.com": "acme.com",
    }
    assert column(U.registrable_domain, list(cases)) == list(cases.values())


def test_denylist(column):
    names = ["techcrunch.com", "x.com", "notx.com", "adservice.google.com", "a.adservice.google.com", "acme.com", None]
    assert column(U.denylisted, names) == [True, True, False, True, True, False, False]


def test_links(column):
    assert column(U.has_asset_extension, ["https://a.com/x.PNG?v=1", "https://a.com/png", "/a/b.css", None]) == [True, False, True, False]
    assert column(U.is_tracking, ["https://a.com/Pixel/1", "https://a.com/?UTM_source=1", "https://a.com", None]) == [True, True, False, False]
    assert column(U.is_non_html, ["image/avif", "text/html; charset=utf-8", None, "application/json"]) == [True, False, False, True]
    html = """<a href="https://a.com/p?x=1">1</a><a href='http://b.com'>2</a><a href="/rel">3</a>"""
    assert column(U.absolute_links, [html, None]) == [["https://a.com/p", "http://b.com"], []]
    hrefs = ["https://a.com", "http://a.com", "javascript:alert(1)", "JavaScript:x", "/rel", "data:text"]
    verdicts = ["safe", "plain_http", "dangerous_scheme", "dangerous_scheme", "no_scheme", "dangerous_scheme"]
    assert column(U.href_verdict, hrefs) == verdicts
    assert column(lambda c: U.href_verdict(c, ["ok.com"]), ["http://ok.com/x", "http://no.com"]) == ["safe", "plain_http"]


def test_canonical_urls(column):
    cases = {
        "https://Example.com/article?utm_source=twitter&id=5": "https://example.com/article?id=5",
        "https://example.com/article/#comments": "https://example.com/article",
        "HTTPS://Example.com": "https://example.com/", "https://e.com/a?b=2&a=1&REF=x&c=": "https://e.com/a?a=1&b=2",
        "https://e.com/a?q=a+b&r=%7Ex*": "https://e.com/a?q=a+b&r=~x%2A", "https://e.com/?a=%zz": "https://e.com/?a=%25zz",
        "https://e.com/a?x=1=2": "https://e.com/a?x=1%3D2", "": "", None: "",
    }
    assert column(U.canonical_url, list(cases)) == list(cases.values())


def test_regions(column):
    places = ["Chennai, India", "Mumbai", "Austin, Texas", "Indiana", "Lausanne", None, "u.s. east"]
    strict = ["India (Chennai)", "India", "USA", "Rest of World", "Rest of World", "Unknown", "USA"]
    loose = ["India (Chennai)", "India", "USA", "India", "USA", "Unknown", "USA"]
    assert column(region_of, places) == strict
    assert column(lambda c: region_of(c, substring=True), places) == loose


def test_feed_dates(column):
    values = ["Wed, 02 Oct 2002 13:00:00 GMT", "2 Oct 2002 13:00:00 +0200", "2002-10-02T13:00:00Z", "soon", None]
    got = [None if v is None else v.strftime("%F %T") for v in column(lambda c: F.date_format(published_time(c), "yyyy-MM-dd HH:mm:ss").cast("timestamp"), values)]
    assert got == ["2002-10-02 13:00:00", "2002-10-02 11:00:00", "2002-10-02 13:00:00", None, None]


def test_relevance(spark):
    rows = [
        ("Acme raises $5M", "seed round", True), ("Register now: AI webinar", "", False), ("Dow Jones closes", "markets", False),
        ("Dow Jones falls as startup index rises", "", True), ("  ", "text", False), ("Compromotion", "x", True),
        ("S&P 500 hits high", "nothing", False), ("News", "Early-bird tickets here", False), ("Fed cuts rates", "fintech hit", True),
        ("Promo", None, False),
    ]
    df = spark.createDataFrame(rows, "title string, summary string, want boolean")
    got = df.select("title", "want", relevant(F.col("title"), F.col("summary")).alias("got")).collect()
    assert [(r.title, r.got) for r in got] == [(r.title, r.want) for r in got]


def test_amounts_in_sentences(column):
    """What follows the number (comma, full stop, bracket, line end) is not a currency."""
    texts = ["raised $4,200,000, led by X", "raised $50, the", "$5 million.", "(€3.5m) and", "₹ 10 crore\nnext", "5,000,000 EUR, x", "none here", None]

    def read(c):
        parts = M.amount_parts(c)
        return F.struct(M.amount_value(parts).alias("v"), M.amount_currency(parts).alias("c"))

    assert [tuple(r) for r in column(read, texts)] == [
        (4.2e6, "USD"), (50.0, "USD"), (5e6, "USD"), (3.5e6, "EUR"), (1e8, "INR"), (5e6, "EUR"), (None, None), (None, None),
    ]


def test_overlap_finds_the_words_of_each_text_once(spark):
    import re

    from pyspark.sql import functions as F

    from upswell.functions.text import evidence_overlap

    texts = ["", None, "a b a", "É x1", "...", "A,b", "x1 É b", "b..a", "-"]
    pairs = spark.createDataFrame([(q, s) for q in texts for s in texts], "q string, s string")
    rows = pairs.select("q", "s", evidence_overlap(F.col("q"), F.col("s")).alias("got"))
    words = lambda t: set(re.findall("[a-z0-9]+", (t or "").lower()))
    for r in rows.collect():
        assert r.got == (len(words(r.q) & words(r.s)) / len(words(r.q)) if words(r.q) else 0.0)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("split(") == 1
