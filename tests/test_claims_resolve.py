"""Claim contract, answer parsing, grouping, entity resolution, field merge."""

import json

import pytest
from pyspark.sql import functions as F

from upswell import config as C
from upswell.operators import claims as K
from upswell.operators import resolve as R
from upswell.operators import tables as B

ARTICLE = "Acme raised $8 million in a Series A round led by Acme Ventures"


def _numbered(spark):
    rows = [(0, 1, "Acme raises", ARTICLE, "https://techcrunch.com/a", "TC"), (0, 2, "Beta", "Beta launched a product", "https://b.com/x", "B")]
    df = spark.createDataFrame(rows, "batch_id long, source_index int, title string, summary string, link string, source_name string")
    return df.withColumn("published_ts", F.lit("2026-02-20").cast("timestamp"))


def _claim(**over):
    base = {
        "company_name": "Acme", "event_type": "funding_round_completed", "value": "Series A", "evidence_excerpt": "raised $8 million in a Series A round",
        "source_index": 1, "confidence": 90, "status": "completed",
    }
    base.update(over)
    return {k: v for k, v in base.items() if v != "drop"}


@pytest.mark.parametrize(
    "over, error",
    [
        ({}, None), ({"event_type": "ipo"}, "unsupported event type"), ({"status": "maybe"}, "unsupported status"),
        ({"source_index": 0}, "source index out of range"), ({"source_index": 3}, "source index out of range"),
        ({"source_index": "1x"}, "source index out of range"), ({"confidence": 101}, "confidence out of range"),
        ({"confidence": None}, "confidence out of range"), ({"evidence_excerpt": " "}, "material claim without evidence"),
        ({"event_type": "other", "evidence_excerpt": ""}, "evidence is empty"),
        ({"evidence_excerpt": "zebra quantum lattice pineapple"}, "evidence not in source"),
        ({"status": "ambiguous"}, "ambiguous completed transaction"), ({"value": "drop"}, "missing required field"),
        ({"value": None}, None),
    ],
)
def test_contract(spark, over, error):
    text = json.dumps([_claim(**over)])
    answers = spark.createDataFrame([(0, "m", text)], "batch_id long, provider string, content string")
    rows = K.validate_claims(K.attach_sources(K.explode_claims(K.parse_responses(answers)), _numbered(spark))).collect()
    assert len(rows) == 1
    assert rows[0].accepted == (error is None)
    if error:
        assert error in rows[0].errors


def test_answer_parsing(spark):
    good = json.dumps([_claim(), _claim(company_name="B}, {C")])
    rows = [
        (0, good), (1, "```json\n" + good + "\n```"), (2, good[:-9]), (3, None), (4, json.dumps(_claim())), (5, "[]"),
        (6, "no json"), (7, "```\n" + good + "```"), (8, "[1, 2]"), (9, ""),
    ]
    answers = spark.createDataFrame([(i, "m", c) for i, c in rows], "batch_id long, provider string, content string")
    parsed = K.parse_responses(answers)
    failed = {r.batch_id for r in parsed.filter("failed").collect()}
    assert {2, 3, 4, 6, 9} <= failed and not failed & {0, 1, 5, 7}
    counts = {r.batch_id: r["count"] for r in K.explode_claims(parsed).groupBy("batch_id").count().collect()}
    assert counts == {0: 2, 1: 2, 7: 2}


def test_groups_keep_first_values(spark):
    rows = [
        ("Acme Inc.", None, "", "Berlin", "other", "2019", "founded in 2019", 80.0, "u1", 1),
        ("acme", "makes robots", "AI", "Paris", "other", "x", "none", 60.0, "u2", 2), (" ", "x", "AI", "x", "other", "x", "x", 1.0, "u3", 3),
        ("AI", "x", "AI", "x", "other", "x", "x", 1.0, "u4", 4), ("Labs", "x", "AI", "x", "other", "x", "x", 1.0, "u5", 5),
    ]
    df = spark.createDataFrame(
        rows, "company_name string, business_idea string, industry string, location string, event_type string, value string, evidence_excerpt string, confidence double, source_url string, ord long"
    )
    got = {r.group_key: r for r in K.group_claims(df).collect()}
    assert set(got) == {"acme", "ai", "labs"}
    a = got["acme"]
    assert (a.company_name, a.n_claims, a.description, a.industry, a.location, a.founded_year, a.extraction_confidence) == (
        "Acme Inc.", 2, "makes robots", "AI", "Berlin", "2019", 70.0,
    )


def test_extractor_hook(spark):
    batches = spark.createDataFrame([(0, "p0"), (1, "p1")], "batch_id long, prompt string")
    out = K.apply_extractor(batches, lambda p: (None, "none") if p == "p1" else ("[]", "m")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.provider, r.content) for r in out] == [(0, "m", "[]"), (1, "none", None)]


COMPANIES = [
    ("1", "OpenAI", "openai", "openai.com", "US", "ai research lab"), ("2", "Clay", "clay", "clay.com", "US", "sales data tool"),
    ("3", "Twin", "twin", None, "US", None), ("4", "Twin", "twin", "twin.io", "IN", None), ("5", "Solo", "solo", None, "DE", "cargo bikes for cities"),
]


def _resolve(spark, *candidate):
    companies = spark.createDataFrame(
        COMPANIES, "company_id string, canonical_name string, normalized_name string, primary_domain string, headquarters_country string, description string"
    )
    aliases = spark.createDataFrame([("1", "open artificial")], "company_id string, normalized_alias string")
    c = spark.createDataFrame([("k", *candidate)], "candidate_id string, company_name string, primary_domain string, headquarters_country string, description string")
    r = R.resolve_entities(c, companies, aliases).first()
    return r.match_type, r.matched_id, r.resolution_confidence


def test_resolution_order(spark):
    assert _resolve(spark, "Other Name", "https://www.openai.com", None, None) == ("domain", "1", 100)
    assert _resolve(spark, "Open Artificial, Inc.", None, None, None) == ("alias", "1", 90)
    assert _resolve(spark, "Solo Ltd", None, None, None) == ("name", "5", 60)
    assert _resolve(spark, "Solo", None, "DE", "cargo bikes for cities") == ("name", "5", 90)
    assert _resolve(spark, "Twin", None, None, None) == ("needs_review", None, 0)
    assert _resolve(spark, "Clay", None, None, "pottery") == ("needs_review", None, 0)
    assert _resolve(spark, "Clay", None, "US", None) == ("name", "2", 75)
    assert _resolve(spark, "Brand New", None, None, None) == ("new", None, 0)
    assert _resolve(spark, "", None, None, None) == ("new", None, 0)


def test_source_tiers(spark):
    rows = [
        ("https://techcrunch.com/x", False), ("https://news.ycombinator.com/item?id=1", False), ("https://acme.io/news", True),
        ("https://unknown.example/x", False), ("https://medium.com/p", False), (None, False),
    ]
    df = spark.createDataFrame(rows, "source_url string, is_own_domain boolean")
    got = [(r.source_url, r.source_tier) for r in R.classify_source_tiers(df, C.tiers_frame(spark)).collect()]
    want = {rows[0][0]: 2, rows[1][0]: 3, rows[2][0]: 1, rows[3][0]: 3, rows[4][0]: 3, None: 3}
    assert dict(got) == want


def test_field_merge(spark):
    rows = [
        (None, "x", None, None, None, None, False, "x", False), ("a", None, 10, 90, 3, 1, True, "a", False),
        ("a", "Unknown", 10, 90, 3, 1, True, "a", False), ("a", "a", 90, 10, 1, 3, False, "a", False),
        ("a", "b", 90, 10, 1, 3, False, "a", True), ("a", "b", 90, 10, 2, 2, False, "b", False),
        ("a", "b", 50, 50, 1, 3, False, "b", False), ("a", "b", 90, 10, 1, 3, True, "b", False), ("a", "b", None, None, None, None, False, "a", True),
    ]
    df = spark.createDataFrame(
        [(str(i), "f", *r[:7]) for i, r in enumerate(rows)],
        "company_id string, field string, existing_value string, new_value string, existing_confidence int, new_confidence int, existing_tier int, new_tier int, clearly_newer boolean",
    )
    got = {r.company_id: (r.merged_value, r.contradiction) for r in B.preserve_fields(df).collect()}
    assert got == {str(i): r[7:] for i, r in enumerate(rows)}
