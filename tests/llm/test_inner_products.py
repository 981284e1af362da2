"""Exact top-k search against all inner products."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from upswell.llm import inner_products as I
from upswell.llm.queries import QUERIES, SQL


def expected(rows, k=10):
    whole = []
    for uid, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((uid, i, [math.floor(1024 * x) for x in v]))
    out = []
    for u, i, q in whole:
        if i is None or i % 100:
            continue
        scores = sorted((-max(min(sum(x * y for x, y in zip(q, v)), 2**63 - 1), -(2**63)), j is None, j or 0, w) for w, j, v in whole if w != u)
        out += [(i, r, None if none else j, -s) for r, (s, none, j, _) in enumerate(scores[:k], 1)]
    return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def vectors(kind, n=1500, d=12):
    rnd = np.random.default_rng(3)
    m = rnd.normal(size=(n, d)) / 3
    if kind == "lengths":  # few long vectors, low rank
        m = (rnd.normal(size=(n, 3)) @ rnd.normal(size=(3, d))) * rnd.pareto(1.5, size=(n, 1))
    if kind == "copies":  # a third is one vector
        m[rnd.random(n) < 0.35] = m[0]
    if kind == "few values":
        m = rnd.integers(-1, 2, size=(n, d)).astype(float)
    if kind == "large":
        m *= 1e9
    return [(int(i), [float(x) for x in v]) for i, v in zip(rnd.permutation(n), m)]


def searched(spark, tmp_path, rows, **more):
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, uid int, norm double").repartition(5)
    frame.write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    if not more:
        return ordered(I.op13(spark, str(tmp_path)).collect())
    table = spark.read.parquet(f"{tmp_path}/embeddings.parquet").selectExpr("vec_id AS id", "embedding")
    found = I.search(table.select("id", I.scaled(table["embedding"]).alias("v")), F.col("id") % 100 == 0, **more)
    return ordered(found.select("query_id", "rank", "id", "score").collect())


@pytest.mark.parametrize("kind", ["plain", "lengths", "copies", "few values", "large"])
def test_all_scores(spark, tmp_path, kind):
    rows = vectors(kind)
    assert searched(spark, tmp_path, rows) == expected(rows)
    # several slices of lengths and blocks of queries
    assert searched(spark, tmp_path, rows, first=20, block_bytes=400) == expected(rows)


def test_cases(spark, tmp_path):
    rows = vectors("plain", 300, 4)
    rows += [(300, None), (400, [0.1, None, 0.2, 0.3]), (500, [float("nan"), 0.0, 0.0, 1.0]), (None, [9.0, 1.0, 0.5, -2.0]), (700, [0.0] * 4), (900, [1.5]), (1000, [])]
    rows += [rows[0], rows[1], (100, [0.1, 0.1, 0.1, 0.1]), (100, [0.1, 0.1, 0.1, 0.1]), (1100, [float("-inf"), 0.0, 0.0, 0.0])]
    assert searched(spark, tmp_path, rows) == expected(rows)
    assert searched(spark, tmp_path, [(100, [1.0, 2.0])]) == []
    assert searched(spark, tmp_path, [(100, [1.0]), (7, [1e300])]) == expected([(100, [1.0]), (7, [float(2**63 - 1) / 1024])])
    assert searched(spark, tmp_path, []) == []
    assert searched(spark, tmp_path, [(1, [1.0])]) == []


def test_long_vectors_are_read_no_further_than_needed(spark):
    """With falling lengths only the first slices can hold a query's best."""
    rnd = np.random.default_rng(1)
    m = rnd.normal(size=(4000, 16)) / np.arange(1, 4001)[:, None]
    rows = [(i, [int(1e6 * x) for x in v]) for i, v in enumerate(m)]
    seen = []
    real = I._scan
    try:
        I._scan = lambda part, *more: (seen.append(part.count()), real(part, *more))[1]
        frame = spark.createDataFrame(rows, "id long, v array<long>")
        got = I.search(frame, F.col("id") == 100, first=200).collect()
    finally:
        I._scan = real
    v = np.array([r[1] for r in rows])
    scores = v @ v[100]
    scores[100] = -(2**62)
    assert [r.score for r in sorted(got, key=lambda r: r.rank)] == sorted(scores.tolist(), reverse=True)[:10]
    assert sum(seen) < 600


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    assert ordered(con.sql(SQL["op13_inner_products"]).fetchall()) == ordered(QUERIES["op13_inner_products"](spark, sf).collect())
