"""Scores, gate, ranking, pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from upswell import config as C
from upswell.operators import pages as W
from upswell.operators import quality as Q
from upswell.operators import ranking as G
from upswell.operators import scoring as P
from upswell.sources.stored import weights_with_defaults


def now():
    return F.to_date(F.lit("2026-02-21"))


def _events(spark, rows):
    df = spark.createDataFrame(rows, "company_id string, event_type string, verification_status string, published_at string")
    return df.withColumn("published_at", F.col("published_at").cast("timestamp"))


def test_decay(spark):
    rows = [
        ("a", "funding_round_completed", "completed", "2026-02-21"), ("b", "acquisition", "completed", "2026-01-07"),
        ("c", "acquisition", "rumored", "2026-02-21"), ("d", "layoffs", "completed", "2026-02-21"), ("e", "hiring_growth", "completed", None),
        ("f", "acquisition", "completed", "2027-01-01"), ("g", "funding_round_completed", "completed", "2026-02-21"), ("g", "acquisition", "completed", "2026-02-21"),
    ]
    got = {r.company_id: r.recent_verified_events for r in P.recent_events_score(_events(spark, rows), now()).collect()}
    assert got == {"a": 100, "b": 33, "c": 0, "d": 0, "e": 0, "f": 90, "g": 100}
    with pytest.raises(ValueError):
        P.recent_events_score(_events(spark, rows), now(), half_life=0)


def test_stage_fallback(spark):
    rows = [("seed", 499_999.0, 10), ("seed", 500_000.0, 40), ("seed", 7e6, 100), ("unknown", 1e9, 0), ("seed", None, 0), ("growth", -1.0, 0), ("series b", 30e6, 60)]
    df = spark.createDataFrame(rows, "funding_stage string, funding_amount_usd double, want int")
    got = P.stage_fallback_score(df, C.stage_thresholds_frame(spark)).collect()
    assert [r.fallback_score for r in got] == [r.want for r in got]


def test_component_scores(spark):
    df = spark.createDataFrame([("actively_hiring", 80, 72), ("limited_hiring", 50, 25), (None, 90, 0), ("unknown", None, 0), ("limited_hiring", 45, 22)], "hiring_status string, hiring_confidence int, want int")
    got = P.hiring_momentum(df).collect()
    assert [r.hiring_momentum for r in got] == [r.want for r in got]
    df = spark.createDataFrame([(None, 0), (0, 0), (1, 40), (2, 80), (9, 100)], "independent_sources int, want int")
    assert all(r.source_corroboration == r.want for r in P.corroboration_component(df).collect())


def test_confidence_and_completeness(spark):
    df = spark.createDataFrame(
        [(1, 3, 0, 100, 100, 100.0, False, 100), (None, 0, None, 0, None, None, False, 0), (2, 1, 60, 50, 80, 50.0, False, 58), (1, 3, 0, 100, 100, 100.0, True, 70)],
        "best_source_tier int, independent_sources int, days_since_verified int, data_completeness int, homepage_confidence int, extraction_confidence double, contradicted boolean, want int",
    )
    got = P.data_confidence(df, "contradicted").collect()
    assert [r.data_confidence for r in got] == [r.want for r in got]
    rows = spark.createDataFrame([("acme.com", "Unknown", None, "x")], "primary_domain string, description string, industry string, homepage string")
    assert P.completeness(rows).first().data_completeness == 25
    assert P.completeness(rows, []).first().data_completeness == 0


def _pool(spark, rows):
    cols = "company_id string, canonical_name string, region_bucket string, points int, data_confidence int, last_event_date string, independent_sources int"
    df = spark.createDataFrame(rows, cols)
    for c in C.WEIGHTS:
        df = df.withColumn(c, F.col("points"))
    return df.withColumn("last_event_date", F.to_date("last_event_date"))


def test_rank_ties_and_order_invariance(spark):
    rows = [
        ("1", "Zeta", "US", 50, 70, "2026-01-01", 2), ("2", "alpha", "US", 50, 70, "2026-01-01", 2), ("3", "B", "US", 50, 70, None, 9),
        ("4", "C", "US", 50, 80, None, 0), ("5", "D", "US", 90, 10, None, 0), ("6", "E", "INDIA", 1, 1, None, 0),
    ]
    pool = _pool(spark, rows)
    want = [("US", 1, "5"), ("US", 2, "4"), ("US", 3, "2"), ("US", 4, "1"), ("US", 5, "3"), ("INDIA", 1, "6")]
    for df in (pool, pool.orderBy(F.rand(3)).repartition(5)):
        got = {(r.region_bucket, r.regional_rank, r.company_id) for r in G.rank_regions(df).collect()}
        assert got == set(want)
    assert G.rank_regions(pool, top_n=2).filter("region_bucket = 'US'").count() == 2


def test_rank_plan_limits_before_the_shuffle(spark):
    pool = _pool(spark, [("1", "A", "US", 5, 5, None, 1)])
    plan = G.rank_regions(pool)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_momentum_rejects_bad_input(spark):
    with pytest.raises(ValueError):
        G.momentum_score(_pool(spark, [("1", "A", "US", 5, 5, None, 1)]), {"traction": 1.0})
    with pytest.raises(Exception, match="outside 0..100"):
        G.momentum_score(_pool(spark, [("1", "A", "US", 500, 5, None, 1)])).collect()


def test_why_ranked(spark):
    df = _pool(spark, [("1", "A", "US", 10, 5, None, 1), ("2", "B", "US", 0, 5, None, 1)])
    got = {r.company_id: r.why_ranked for r in G.why_ranked(df).collect()}
    assert got["1"] == "Ranked mainly on recent verified events and product/customer traction."
    assert got["2"] == C.LIMITED_SIGNAL_TEXT


def test_weights(spark):
    good = C.weights_frame(spark)
    assert G.checked_weights(good, good) == C.WEIGHTS
    bad = C.weights_frame(spark, {**{k: v for k, v in C.WEIGHTS.items() if k != "traction"}, "luck": 0.2, "hiring_momentum": -0.1})
    problems = {(r.component, r.problem) for r in G.weights_diff(bad, good).collect()}
    assert problems == {("traction", "missing"), ("luck", "unexpected"), ("hiring_momentum", "negative"), ("*", "sum is not 1")}
    with pytest.raises(ValueError):
        G.checked_weights(bad, good)


def test_gate(spark):
    ok = {
        "region_bucket": "US", "primary_domain_verified": True, "industry": "AI", "days_since_event": 10, "data_confidence": 60,
        "independent_sources": 1, "best_source_tier": 3, "company_status": "operating", "entity_resolution_needs_review": False, "days_since_verified": None,
    }
    cases = [
        ({}, None), ({"region_bucket": None}, "region not supported"), ({"primary_domain_verified": False}, "primary domain not verified"),
        ({"industry": "Retail"}, "industry not supported"), ({"days_since_event": None}, "no recent qualifying event"), ({"days_since_event": 180}, None),
        ({"days_since_event": 181}, "no recent qualifying event"), ({"data_confidence": 59}, "data confidence too low"),
        ({"independent_sources": 0}, "only weak sources"), ({"independent_sources": 0, "best_source_tier": 1}, None),
        ({"company_status": "acquired"}, "company status not rankable"), ({"entity_resolution_needs_review": True}, "identity needs review"),
        ({"days_since_verified": 91}, "verification too old"), ({"days_since_verified": 90}, None),
    ]
    ddl = "region_bucket string, primary_domain_verified boolean, industry string, days_since_event int, data_confidence int, independent_sources int, best_source_tier int, company_status string, entity_resolution_needs_review boolean, days_since_verified int, want string"
    df = spark.createDataFrame([(*{**ok, **over}.values(), want) for over, want in cases], ddl)
    for r in G.eligibility_gate(df).collect():
        assert r.reasons == ([r.want] if r.want else []) and r.eligible == (r.want is None)


CAREERS = {
    "": ("unknown", 0, None), "<html>Oops, page not found</html>": ("unknown", 10, None),
    "<a href='https://boards.greenhouse.io/x'>jobs</a> 12 open positions": ("actively_hiring", 80, 12),
    '<script>{"@type": "JobPosting"}</script>': ("actively_hiring", 55, None), "<p>Apply now</p>": ("limited_hiring", 35, None),
    "<p>We are hiring: 2 roles</p>": ("limited_hiring", 45, 2), "<p>hiring is in our DNA</p>": ("no_verified_openings", 20, None),
    "<p>0 jobs</p>": ("no_verified_openings", 30, None), "<p>join our team, 0 open roles</p>": ("no_verified_openings", 45, 0),
}


def test_careers(spark):
    df = spark.createDataFrame([(k,) for k in CAREERS], "careers_html string")
    got = {r.careers_html: (r.hiring_status, r.hiring_confidence, r.open_role_count) for r in W.careers_signal(df).collect()}
    assert got == CAREERS


def test_homepages(spark):
    links = spark.createDataFrame(
        [
            ("acme", "Acme Robotics", "https://cdn.jsdelivr.net/x", 0), ("acme", "Acme Robotics", "https://robotics.io/deep/page", 1),
            ("acme", "Acme Robotics", "https://robotics.io", 2), ("acme", "Acme Robotics", "https://robotics.io/a.png", 3),
            ("beta", "Beta", "https://parked.com", 0), ("gone", "Gone", "https://gone.com", 0), ("pic", "Picco", "https://picco.com", 0), ("weak", "Nomatch", "http://zzz.com", 0),
        ],
        "group_key string, company_name string, link string, link_ord int",
    )
    page = lambda u, f=None, s=200, t="text/html", h="": (u, f or u, s, t, h)
    pages = spark.createDataFrame(
        [
            page("https://robotics.io/deep/page", h="ROBOTICS"), page("https://robotics.io", h="robotics for all"), page("https://parked.com", "https://twitter.com/x", h="beta"),
            page("https://gone.com", s=404, h="gone"), page("https://picco.com", t="image/png", h="picco"), page("http://zzz.com", h="none"), page("https://cdn.jsdelivr.net/x"),
        ],
        "url string, final_url string, status_code int, content_type string, html string",
    )
    scored = W.homepage_confidence(W.homepage_candidates(links, pages))
    by_link = {r.link: r for r in scored.collect()}
    assert by_link["https://robotics.io"].confidence == 90 and by_link["http://zzz.com"].confidence == 40
    assert by_link["https://parked.com"].reasons == ["redirected to a listed domain"]
    best = {r.group_key: r.homepage for r in W.best_homepage(scored).collect()}
    assert best == {"acme": "https://robotics.io"}


def test_quality_gate(spark):
    metrics = {m: (b if op == "min" else 0.0) for m, op, b in C.QUALITY_RULES}
    row = {**metrics, "n_ranked": 100, "previous_pct_confidence": None, "previous_n_ranked": None}
    ddl = ", ".join(f"{k} double" for k in row)

    def verdict(**over):
        df = spark.createDataFrame([tuple(None if v is None else float(v) for v in {**row, **over}.values())], ddl)
        return Q.should_publish(Q.check_thresholds(df)).first()

    assert verdict().publish
    bad = verdict(pct_ranked_with_confidence_ge_70=79.9, invalid_homepage_count=1)
    assert not bad.publish and len(bad.threshold_failures) == 2
    assert not verdict(previous_pct_confidence=90.1).publish and verdict(previous_pct_confidence=90.0).publish
    assert not verdict(previous_n_ranked=201).publish and verdict(previous_n_ranked=200).publish


def test_bands_and_shortfall(spark):
    df = spark.createDataFrame([(0, "US"), (19, "US"), (20, "ROW"), (100, "US"), (None, "US")], "data_confidence int, region_bucket string")
    bands = {r.band: r.n for r in Q.confidence_bands(df, C.bands_frame(spark)).collect()}
    assert bands == {"0-19": 3, "20-39": 1, "40-59": 0, "60-79": 0, "80-100": 1}
    short = {r.region_bucket: r.shortfall for r in Q.shortfall_by_region(df, C.regions_frame(spark)).collect()}
    assert short == {"US": 46, "INDIA": 50, "ROW": 49}


def test_rank_history(spark):
    rows = [("a", dt.date(2025, 1, 1), 9, 10), ("a", dt.date(2025, 2, 1), 4, 30), ("b", dt.date(2025, 2, 1), 1, 5)]
    snaps = spark.createDataFrame(rows, "company_id string, run_ts date, regional_rank int, momentum_score int")
    assert {(r.company_id, r.run_ts.month, r.rank_change) for r in G.rank_change(snaps).collect()} == {("a", 1, None), ("a", 2, 5), ("b", 2, None)}
    ranked = spark.createDataFrame([("a", 1), ("c", 2)], "company_id string, regional_rank int")
    got = {r.company_id: r.rank_change for r in G.previous_rank(ranked, snaps, F.to_date(F.lit("2025-03-01"))).collect()}
    assert got == {"a": 3, "c": None}


def test_contradictions_of_the_best_tier_only(spark):
    rows = [
        ("same", "industry", "AI", 1), ("same", "industry", " ai ", 1), ("same", "industry", "FinTech", 3),
        ("differs", "industry", "AI", 2), ("differs", "industry", "FinTech", 2), ("differs", "industry", "x", 3),
        ("unknown", "industry", "AI", 1), ("unknown", "industry", "Unknown", 1), ("unknown", "region", None, 1), ("none", "industry", "AI", None),
    ]
    got = {r.company_id: r.contradicted for r in P.contradicted_companies(spark.createDataFrame(rows, "company_id string, field_name string, field_value string, source_tier int")).collect()}
    assert got == {"same": False, "differs": True, "unknown": False}


def test_stored_weights(spark):
    defaults = C.weights_frame(spark)
    frame = lambda rows: spark.createDataFrame(rows, "component string, weight double")
    checked = lambda rows: G.checked_weights(weights_with_defaults(rows, defaults), defaults)
    assert checked(None) == checked(frame([])) == C.WEIGHTS
    swapped = [("recent_verified_events", 0.20), ("traction", 0.25), ("other", 3.0), ("hiring_momentum", None)]
    assert checked(frame(swapped)) == {**C.WEIGHTS, "recent_verified_events": 0.20, "traction": 0.25}
    for wrong in ([("traction", 0.9)], [("traction", -0.2), ("recent_verified_events", 0.65)]):
        with pytest.raises(ValueError):
            checked(frame(wrong))
