"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs


class Tables:
    """Gives a query its inputs by name and the fixed clock."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._seen: dict[str, DataFrame] = {}
        # clocks in the SQL checks are UTC
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __call__(self, name: str) -> DataFrame:
        return inputs.load(self.spark, self.sf_dir, name, self._seen)

    @property
    def now(self):
        return F.to_date(F.lit(inputs.NOW))


@dataclass(frozen=True)
class Query:
    name: str
    survey_ids: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, ids: str, needs: str = "", sql: str | None = None):
    """Register a query. ``needs`` names the inputs the SQL text refers to; a SQL text
    that starts with more common table expressions begins with ``,``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        full = None
        if sql is not None:
            head = inputs.with_clause(needs.split())
            body = sql.strip()
            if body.startswith(","):
                full = f"WITH {head}{body}"
            else:
                full = f"WITH {head}\n{body}" if head else body
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = Query(name, ids, fn, full)
        return fn

    return wrap
