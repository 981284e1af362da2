"""Inputs that Spark and the SQL checks derive from the same text."""

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.mark.parametrize("name", ["extract_amounts_v1", "momentum_score_v1"])
def test_balances_that_round_to_a_negative_zero(spark, tmp_path, name):
    con = duckdb.connect()
    balances = "[-0.01, -0.3, -0.49, -0.5, -12.34, 0.0, 0.01, 0.5, 4.45, 9999.8, NULL]"
    con.execute(
        f"""CREATE TABLE customer AS SELECT row_number() OVER (ORDER BY b, k) + 1 AS c_custkey, 'Customer' AS c_name, 1 AS c_nationkey, CAST(b AS DOUBLE) AS c_acctbal,
        'MACHINERY' AS c_mktsegment FROM (SELECT unnest({balances}) AS b), range(24) r(k)"""
    )
    con.execute(f"COPY customer TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    got = sorted(map(tuple, entry.queries()[name](spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(con.execute(entry.oracle_sql()[name]).fetchall(), key=repr)
