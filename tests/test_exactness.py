"""Distributed forms against brute force on small random data."""

import random
from bisect import bisect_right

from pyspark.sql import functions as F

from upswell.operators.common import with_row_index
from upswell.operators.independence import independent_sources
from upswell.operators.scoring import peer_percentile


def _walk(rows):
    urls, texts, sites, n = set(), set(), set(), 0
    for _, url, text, site in sorted(rows):
        if url in urls:
            continue
        urls.add(url)
        if text in texts or site in sites:
            continue
        texts.add(text)
        sites.add(site)
        n += 1
    return n


def _sources(spark, companies, per_company, texts, sites, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for c in range(companies):
        mine = []
        for i in range(rng.randint(1, per_company)):
            site = f"s{rng.randrange(sites)}.com"
            mine.append((i, f"https://{site}/p{rng.randrange(per_company)}", f"t{rng.randrange(texts)}", site))
        want[str(c)] = _walk(mine)
        rows += [(str(c), u, "x", t, i) for i, u, t, _ in mine]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "company_id string, url string, title string, body string, ord long"), want


def test_fold_and_rounds_agree_with_the_walk(spark):
    df, want = _sources(spark, 40, 60, 12, 12, 7)
    for limit in (256, 20, 7):
        got = {r.company_id: r.independent_sources for r in independent_sources(df, limit).collect()}
        assert got == want


def test_one_company_with_most_sources(spark):
    df, want = _sources(spark, 2, 900, 300, 200, 3)
    got = {r.company_id: r.independent_sources for r in independent_sources(df, 150).collect()}
    assert got == want


def test_sources_without_a_domain(spark):
    rows = [("1", "/rel-a", "x", "one", 1), ("1", "/rel-b", "x", "two", 2), ("1", "/rel-c", "x", "one", 3)]
    df = spark.createDataFrame(rows, "company_id string, url string, title string, body string, ord long")
    # a URL without a host still gives a registrable form of its text; compare both ways
    for limit in (256, 1):
        assert independent_sources(df, limit).first().independent_sources == independent_sources(df).first().independent_sources


def test_a_long_chain_of_copies(spark):
    """Each source is blocked by the one before it only, over all blocks."""
    n = 400
    rows = [("most", f"https://s{(i + 1) // 2}.com/{i}", "x", f"t{i // 2}", i) for i in range(n)] + [("few", "https://a.com/1", "x", "t", 1), (None, "https://a.com/1", "x", "t", 1)]
    df = spark.createDataFrame(rows, "company_id string, url string, title string, body string, ord long").repartition(4)
    for block in (1000, 130):
        got = {r.company_id: r.independent_sources for r in independent_sources(df, block).collect()}
        assert got == {"most": n // 2, "few": 1, None: 1}


def test_companies_of_few_sources_take_no_rounds(spark, monkeypatch):
    from upswell.operators import independence

    df, want = _sources(spark, 60, 60, 12, 12, 11)
    frames, store = [], independence.stored

    def watched(frame, **how):
        frames.append(store(frame, **how))
        return frames[-1]

    monkeypatch.setattr(independence, "stored", watched)
    got = {r.company_id: r.independent_sources for r in independent_sources(df).collect()}
    # nothing but the list of companies of many sources, here none, is written before the walk
    assert got == want and [f.columns for f in frames] == [["_many"]] and frames[0].count() == 0
    # some companies go either way; so does a missing company
    monkeypatch.setattr(independence, "SHORT", 30)
    rows = [(None, f"https://s{i}.com/{i % 5}", "x", f"t{i // 2}", i) for i in range(40)]
    both = df.unionByName(spark.createDataFrame(rows, df.schema))
    got = {r.company_id: r.independent_sources for r in independent_sources(both).collect()}
    assert got == {**want, None: 20} and 1 < frames[1].count() < 60


def test_percentile_over_many_slices(spark):
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        stage = "seed" if rng.random() < 0.8 else "growth"
        region = rng.choice(["US", None, "ROW"])
        amount = None if rng.random() < 0.1 else float(rng.choice([100, 200, rng.randrange(1, 100000)]))
        rows.append((str(i), stage, region, amount))
    rows.append(("lonely", "series a", "US", 5.0))
    df = spark.createDataFrame(rows, "company_id string, funding_stage string, region_bucket string, funding_amount_usd double")
    cohorts: dict = {}
    for _, s, r, a in rows:
        if a is not None:
            cohorts.setdefault((s, r), []).append(a)
    for values in cohorts.values():
        values.sort()

    def want(s, r, a, exclude):
        if a is None:
            return None
        values = cohorts[s, r]
        le = bisect_right(values, a)
        eq = values.count(a)
        n, below = (len(values) - eq, le - eq) if exclude else (len(values), le)
        return round(100.0 * below / n) if n >= 5 else None

    for coalesced in ("true", "false"):  # one range partition, or eight
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
        for exclude in (True, False):
            got = {r.company_id: r.peer_percentile for r in peer_percentile(df, exclude_equal=exclude).collect()}
            assert got == {c: want(s, r, a, exclude) for c, s, r, a in rows}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_plan_of_the_percentile(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id as string) company_id", "'seed' funding_stage", "'US' region_bucket", "cast(id % 90 as double) funding_amount_usd")
    df.write.parquet(str(tmp_path / "rows"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = peer_percentile(spark.read.parquet(str(tmp_path / "rows")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one shuffle to count and one to range-partition come before, in the stored frame
    assert plan.count("Exchange") + 2 <= 12 and plan.count("FileScan") <= 3


def test_row_index_is_gap_free_and_ordered(spark):
    df = spark.range(5000).select(F.col("id"), F.xxhash64("id").alias("h")).repartition(7)
    rows = with_row_index(df, [F.col("h")]).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(5000))
    assert [r.h for r in rows] == sorted(r.h for r in rows)


def test_a_round_reads_its_own_block_and_few_earlier_keys(spark, monkeypatch):
    from upswell.operators import independence

    n, block = 1000, 100
    chain = [("most", f"https://s{(i + 1) // 2}.com/{i}", "x", f"text {i // 2}", i) for i in range(n)]
    df = spark.createDataFrame(chain, "company_id string, url string, title string, body string, ord long")
    frames, store = [], independence.stored

    def watched(frame, **how):
        out = store(frame, **how)
        frames.append((how.get("by"), set(out.columns), out))
        return out

    monkeypatch.setattr(independence, "stored", watched)
    assert independent_sources(df, block).first().independent_sources == n // 2
    # of what earlier rounds counted only the texts and domains of a later round are kept: in a chain at most one between two blocks
    kept = [f.count() for _, names, f in frames if "_last" in names]
    assert len(kept) == 2 + 2 * (n // block - 1) and max(kept[2:]) <= 1
    parts = [f for by, _, f in frames if by == ["_round"]]
    assert len(parts) == 1 and parts[0].filter("_round = 3").count() == block
