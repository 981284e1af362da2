"""Every registered query against its SQL on the smallest given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import QUERIES

SF = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda x: "nan" if isinstance(x, float) and math.isnan(x) else repr(x)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == _rows(columns, cur.fetchall())


def test_an_upsert_query_covers_all_companies(spark):
    companies = entry.Tables(spark, SF)("companies").select("company_id").distinct().count()
    upserts = [n for n in QUERIES if n.startswith("upsert_by_key")]
    assert companies in [entry.queries()[n](spark, SF).select("company_id").distinct().count() for n in upserts]


def test_a_ranking_reads_the_sources_of_companies_that_may_pass(spark, monkeypatch):
    from catalog import scores
    from upswell import config as C
    from upswell.operators import ranking as G
    from upswell.plans import ranking

    read, count = [], ranking.independent_sources

    def watched(sources, **how):
        read.append({r.company_id for r in sources.select("company_id").distinct().collect()})
        return count(sources, **how)

    monkeypatch.setattr(ranking, "independent_sources", watched)
    tables = entry.Tables(spark, SF)
    # the second gate leans on the number of sources, most companies pass the third
    for cfg in (C.EligibilityConfig(), C.EligibilityConfig(min_sources=4, event_window_days=9999), C.EligibilityConfig(min_confidence=0, min_sources=0, event_window_days=9999)):
        whole = G.eligibility_gate(scores.scored(tables), cfg).filter("eligible")
        early = G.eligibility_gate(scores.scored(tables, cfg), cfg).filter("eligible").select(*whole.columns)
        want = _rows(whole.columns, [tuple(r) for r in whole.collect()])
        assert want and _rows(early.columns, [tuple(r) for r in early.collect()]) == want
        every, some = read[-2:]
        passed = {r.company_id for r in whole.select("company_id").collect()}
        assert some < every and passed & every <= some


def test_uncapped_scans_return_all_items(spark):
    tables, queries = entry.Tables(spark, SF), entry.queries()
    assert queries["scan_feed_items_all"](spark, SF).count() == tables("feed_raw").count()
    assert queries["scan_search_hits_all"](spark, SF).count() > queries["scan_search_hits"](spark, SF).count()


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
