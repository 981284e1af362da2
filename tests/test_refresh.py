"""The ranking refresh from end to end on a small fixture."""

import json

import pytest
from pyspark.sql import functions as F

from upswell.operators import quality as Q
from upswell.operators import tables as B
from upswell.operators.merge import read_merged
from upswell.plans.legacy import run_v1_refresh
from upswell.plans.refresh import RefreshInputs, refresh_stored, run_ranking_refresh, store_refresh
from upswell.plans.runs import judge_run, published_report

COMPANY = (
    "company_id string, canonical_name string, normalized_name string, primary_domain string, homepage string, homepage_confidence int,"
    " headquarters_country string, description string, industry string, founded_year string, founders string, region_bucket string, company_status string,"
    " hiring_status string, hiring_confidence int, verified_open_role_count int, moat_confidence int, data_confidence int,"
    " entity_resolution_needs_review boolean, last_seen date, last_verified date, active boolean"
)
EVENT = (
    "company_id string, event_type string, event_date date, published_at timestamp, title string, amount_usd double, funding_stage string,"
    " source_url string, source_tier int, evidence_text string, extraction_confidence int, verification_status string, ingest_ord long"
)
ARTICLES = [
    ("Acme Robotics raises $8M Series A", 'Acme Robotics announced today it raised $8 million in a Series A round. <a href="https://acmerobotics.ai">site</a>', "https://techcrunch.com/acme", "2026-02-20"),
    ("Beta Fintech launches", 'Beta Fintech launched a new payments product in India. <a href="https://betafintech.in">site</a>', "https://yourstory.com/beta", "2026-02-15"),
    ("Gamma", "Gamma AI is now valued at $2 billion after its latest round.", "https://techcrunch.com/gamma", "2026-02-18"),
    ("Delta", "Delta Drones raised $5 million in a Series A round.", "https://eu-startups.com/delta", "2026-02-19"),
    ("Delta again", "Delta Drones raised $5 million in a Series A round.", "https://eu-startups.com/delta", "2026-02-19"),
]
CLAIMS = [
    ("Acme Robotics", "AI", "San Francisco, USA", "funding_round_completed", "Series A, $8 million", "raised $8 million in a Series A round", 1, 90),
    ("Beta Fintech", "FinTech", "Mumbai, India", "product_launch", None, "launched a new payments product", 2, 80),
    ("Gamma AI", "AI", "New York, USA", "funding_round_completed", "$2 billion valuation", "Gamma AI is now valued at $2 billion after its latest round.", 3, 70),
    ("Delta Drones", "AI", "Berlin, Germany", "funding_round_completed", "Series A", "raised $5 million in a Series A round", 4, 85),
    ("Fake", "AI", "Berlin", "acquisition", None, "zebra quantum pineapple lattice", 4, 85),
]


def _answer():
    keys = ["company_name", "industry", "location", "event_type", "value", "evidence_excerpt", "source_index", "confidence"]
    return json.dumps([{**dict(zip(keys, c)), "status": "completed", "business_idea": f"{c[0]} idea"} for c in CLAIMS])


def _inputs(spark, companies=None, events=None, answer=None):
    articles = spark.createDataFrame([(*a, "S", 0, i) for i, a in enumerate(ARTICLES)], "title string, summary string, link string, t string, source_name string, source_ord int, item_ord int")
    articles = articles.withColumn("published_ts", F.col("t").cast("timestamp")).drop("t")
    page = lambda u, h: (u, u, 200, "text/html", h)
    pages = spark.createDataFrame(
        [
            page("https://acmerobotics.ai", "<title>Acme Robotics</title>"), page("https://betafintech.in", "Beta payments"),
            page("https://acmerobotics.ai/careers", "5 open roles <a href='https://jobs.lever.co/acme'>apply now</a>"),
        ],
        "url string, final_url string, status_code int, content_type string, html string",
    )
    return RefreshInputs(
        articles=articles, pages=pages, companies=companies if companies is not None else spark.createDataFrame([], COMPANY),
        aliases=spark.createDataFrame([], "company_id string, normalized_alias string"),
        events=events if events is not None else spark.createDataFrame([], EVENT),
        responses=spark.createDataFrame([(0, "m", _answer() if answer is None else answer)], "batch_id long, provider string, content string"),
    )


def test_refresh_and_second_run(spark, tmp_path):
    now = F.to_date(F.lit("2026-02-21"))
    result = run_ranking_refresh(_inputs(spark), now, "r1")
    companies = {r.canonical_name: r for r in result.companies.collect()}
    assert set(companies) == {"Acme Robotics", "Beta Fintech", "Gamma AI", "Delta Drones"}
    acme, beta, gamma, delta = (companies[n] for n in ("Acme Robotics", "Beta Fintech", "Gamma AI", "Delta Drones"))
    assert (acme.region_bucket, beta.region_bucket, delta.region_bucket) == ("US", "INDIA", "ROW")
    assert (acme.homepage, acme.primary_domain, acme.hiring_status, acme.verified_open_role_count) == ("https://acmerobotics.ai", "acmerobotics.ai", "actively_hiring", 5)
    assert (acme.latest_funding_stage, acme.latest_funding_amount_usd, acme.total_disclosed_funding_usd) == ("series a", 8e6, 8e6)
    assert all(c.data_confidence is not None for c in companies.values())
    events = {r.title: r for r in result.events.collect()}
    assert len(events) == 4 and events["Acme Robotics"].amount_usd == 8e6
    assert events["Gamma AI"].event_type == "valuation_report" and events["Gamma AI"].amount_usd is None
    assert gamma.latest_funding_amount_usd is None
    assert {r.canonical_name for r in result.ranked.collect()} == {"Acme Robotics", "Beta Fintech"}
    report = result.report.first()
    assert report.pct_ranked_with_verified_regional_assignment == 100.0 and report.pct_ranked_with_valid_primary_domain == 100.0
    run = result.run.first()
    assert (run.candidates_extracted, run.articles_fetched, run.companies_accepted) == (4, 4, 2)
    store_refresh(result, str(tmp_path / "out"), 1)
    assert B.read_current(spark, str(tmp_path / "out/companies")).count() == 4

    again = run_ranking_refresh(
        _inputs(spark, B.read_current(spark, str(tmp_path / "out/companies")), read_merged(spark, str(tmp_path / "out/events"))), now, "r2"
    )
    assert again.companies.count() == 4 and again.events.count() == 4
    second = {(r.canonical_name, r.momentum_score, r.regional_rank) for r in again.ranked.collect()}
    assert second == {(r.canonical_name, r.momentum_score, r.regional_rank) for r in result.ranked.collect()}


def test_all_batches_failed(spark):
    with pytest.raises(RuntimeError):
        run_ranking_refresh(_inputs(spark, answer="no json"), F.to_date(F.lit("2026-02-21")))


def test_older_refresh_with_refiner(spark):
    records = spark.createDataFrame(
        [("Acme", "robots", "AI", "Series A", "$8M", "Alpha", "Austin, Texas", "https://news.x/1", 1), ("acme", "robots for all", "AI", "Seed", None, None, None, "https://news.x/1", 2), ("Beta", "pay", "FinTech", None, "$8 million", None, "Mumbai", "https://news.x/2", 3)],
        "company_name string, business_idea string, industry string, funding_stage string, funding_amount string, investors string, location string, source_url string, ord long",
    )
    articles = spark.createDataFrame([("https://news.x/1", '<a href="https://acme.com?x=1">a</a>')], "link string, summary string")
    pages = spark.createDataFrame(
        [("https://acme.com", 200, "We are hiring"), ("https://acme.com/about", 200, "write to hi@acme.com")], "url string, status_code int, html string"
    )

    def refine(prompt):
        n = prompt.count("COMPANY:")
        return json.dumps([{"founder_name": "F", "year_founded": "2020", "unique_moat": None}] * n), "rules"

    got = {r.company_name: r for r in run_v1_refresh(records, articles, pages, refiner=refine).collect()}
    assert set(got) == {"acme", "Beta"}
    acme, beta = got["acme"], got["Beta"]
    assert (acme.homepage, acme.contact_email, acme.hiring_status, acme.founder_name) == ("https://acme.com", "hi@acme.com", "Likely hiring", "F")
    assert (acme.momentum_score, acme.data_confidence) == (34, 75)
    assert (beta.region, beta.funding_amount_usd, beta.hiring_status, beta.momentum_score) == ("India", None, "Unknown", 0)


def test_run_rows(spark):
    opened = B.open_run(spark, "r1", F.lit("2026-02-21").cast("timestamp"))
    closed = opened.withColumns({"finished_at": F.col("started_at"), "run_status": F.lit("success"), "published": F.lit(True)})
    assert [r.run_status for r in B.run_states(opened.unionByName(closed)).collect()] == ["success"]


def test_runs_over_one_root(spark, tmp_path, monkeypatch):
    """The second run reads what the first stored, companies, events and report; a failing run leaves all as it was."""
    root = str(tmp_path / "root")
    rules = [("pct_ranked_with_verified_headquarters", "max", 100.0)]  # any report passes
    monkeypatch.setattr("upswell.plans.refresh.judge_run", lambda *a: judge_run(*a, rules=rules))
    day = lambda d: F.to_date(F.lit(f"2026-02-{d}"))
    first = refresh_stored(_inputs(spark), root, day(21), "r1")
    assert first.publish and first.run.first().quality_report.n_ranked == 2
    with pytest.raises(RuntimeError):
        refresh_stored(_inputs(spark, answer="no json"), root, day(22), "r2")
    one = json.dumps(json.loads(_answer())[2:])  # no rankable company is found any more
    held = refresh_stored(_inputs(spark, answer=one), root, day(23), "r3")
    third = refresh_stored(_inputs(spark), root, day(24), "r4")
    assert not held.publish and third.publish
    assert third.report.first().previous_n_ranked == 2  # that of r1, the latest that published
    runs = {r.run_id: r for r in B.read_runs(spark, f"{root}/runs").collect()}
    assert {k: r.run_status for k, r in runs.items()} == {"r1": "success", "r2": "failed", "r3": "success_with_warnings", "r4": "success"}
    assert runs["r2"].articles_fetched == 4 and runs["r2"].finished_at is not None and runs["r2"].quality_report is None
    assert runs["r1"].regional_result_counts == {"US": 1, "INDIA": 1, "ROW": 0} and runs["r1"].workflow_type == "ranking_refresh"
    report = runs["r4"].quality_report
    assert report.threshold_failures == [] and report.passed_launch_thresholds and report.duplicate_candidates_detected == 0
    assert report.rejected_candidate_count_by_reason and report.missingness_by_field["founders"] == 100.0
    assert published_report(B.read_runs(spark, f"{root}/runs")).first().generated_at == report.generated_at
    assert B.read_current(spark, f"{root}/companies").count() == 4 and read_merged(spark, f"{root}/events").count() == 4
    assert B.current_version(spark, f"{root}/ranking") == 2


def test_report_of_nothing_and_its_plan(spark):
    gate = spark.createDataFrame([], "company_id string, region_bucket string, reasons array<string>, funding_amount_usd double, funding_stage string, days_since_verified int")
    ranked = spark.createDataFrame(
        [], "region_bucket string, data_confidence int, independent_sources int, best_source_tier int, funding_amount_usd double, hiring_momentum int, recent_verified_events int, primary_domain_verified boolean"
    )
    events = spark.createDataFrame([], "event_type string, evidence_text string, amount_usd double, statement_class string, source_tier int")
    parsed = spark.createDataFrame([("a", False), ("b", True), ("b", False), (None, True)], "provider string, failed boolean")
    report = Q.build_quality_report(gate, ranked, events, parsed, first_provider="a")
    row = report.first()
    assert (row.n_ranked, row.pct_ranked_with_confidence_ge_70, row.pct_material_funding_claims_with_evidence, row.llm_extraction_failure_rate) == (0, 0.0, 100.0, 50.0)
    assert row.provider_fallback_usage == {"b": 2} and row.rejected_candidate_count_by_reason == {} and row.shortfall_by_region == {"US": 50, "INDIA": 50, "ROW": 50}
    plan = report._jdf.queryExecution().sparkPlan().toString()
    full = report._jdf.queryExecution().executedPlan().toString()
    assert full.count("Exchange") <= 4 and "Join" not in plan


def test_missing_folder_is_no_version_but_a_broken_one_fails(spark, tmp_path):
    assert B.current_version(spark, str(tmp_path / "none")) is None and B.read_current(spark, str(tmp_path / "none")) is None
    (tmp_path / "t" / "log").mkdir(parents=True)
    (tmp_path / "t" / "log" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        B.current_version(spark, str(tmp_path / "t"))
