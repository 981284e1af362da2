"""URL filter: rules by host and path, and logistic regression where no rule fits.

The model looks at hashed character n-grams of host and path, each with buckets of its own. It is fitted on a small table of
labelled URLs: the one in ``url_labels`` or the caller's, of which at most ``labelled_rows`` of each verdict count, chosen by a
hash. Every URL is judged by the rules and the model; the model decides where no rule fits.

Cases: a null URL or one without ``://`` has an empty host and path, no rule, and the model judges its
empty text (the intercept and nothing else); an empty path starts with no rule's path; labels of
one verdict only give that verdict; without labels everything is allowed; repeated rows are judged alike;
further columns are ignored. Verdicts are strings, rules need distinct names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm import grams
from upswell.llm.linear import fit_logistic, probability
from upswell.llm.url_labels import LABELLED

BITS = 12
LONGEST = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path) to verdict
RULES = (
    (("com", "/"), "allow"),
    (("example.com", "/en/"), "block"),
    (("www.example.com", "/en/"), "allow"),
    (("net", "/es/"), "block"),
    (("net", "/fr/"), "block"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    fits = []
    for (h, p), verdict in sorted(rules, key=lambda r: (-len(r[0][0] + r[0][1]), -len(r[0][0]))):
        ok = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fits.append(F.when(ok, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.coalesce(*fits)
    return best["rule"], best["verdict"]


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of the character n-grams; a gram of a host and the same gram of a path have different buckets."""
    both = []
    for side, texts in enumerate((hosts, paths)):
        points, starts = grams.code_points(texts)
        buckets, places = grams.char_grams(points, LONGEST, BITS - 1, points != 32)
        rows = np.searchsorted(starts, places, side="right") - 1
        both.append(rows.astype(np.int64) << BITS | side << (BITS - 1) | buckets.astype(np.int64))
    pairs = np.unique(np.concatenate(both))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def fit(hosts: list[str], paths: list[str], blocked: np.ndarray, used: int = 400) -> tuple[np.ndarray, float]:
    """Bucket weights and intercept. The regression sees the ``used`` buckets that differ most between the classes."""
    weights = np.zeros(1 << BITS)
    if not len(hosts):
        return weights, -1.0
    rows, buckets = features(hosts, paths)
    n = np.bincount(buckets, minlength=1 << BITS)
    pos = np.bincount(buckets[blocked[rows]], minlength=1 << BITS)
    off = (pos * (len(hosts) - blocked.sum()) - (n - pos) * blocked.sum()) ** 2 / np.maximum(n * (len(hosts) - n + 0.5), 1)
    chosen = np.sort(np.argsort(-off, kind="stable")[:used])
    x = np.zeros((len(hosts), len(chosen)))
    at = np.minimum(np.searchsorted(chosen, buckets), len(chosen) - 1)
    hit = chosen[at] == buckets
    x[rows[hit], at[hit]] = 1
    w = fit_logistic(x, blocked.astype(float))
    weights[chosen] = w[:-1]
    return weights, float(w[-1])


def block_probability(model: tuple[np.ndarray, float], hosts: list[str], paths: list[str]) -> np.ndarray:
    weights, intercept = model
    rows, buckets = features(hosts, paths)
    return probability(np.bincount(rows, weights[buckets], len(hosts)) + intercept)


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence = RULES, labelled_rows: int = 2000) -> DataFrame:
    """page_id, host, path, rule, verdict and p_block of every row. ``labelled``: url, verdict (allow or block)."""
    spark = pages.sparkSession
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("rule", rule).withColumn("by_rule", verdict)
    if labelled is None:
        labelled = spark.createDataFrame(list(LABELLED), "url string, verdict string")
    known = labelled.select(host.alias("host"), path.alias("path"), "verdict")
    hosts, paths, blocked = [], [], []
    for v in ("allow", "block"):
        few = known.filter(F.col("verdict") == v).select("host", "path").distinct().orderBy(F.xxhash64("host", "path"), "host", "path").limit(labelled_rows).collect()
        hosts += [r.host for r in few]
        paths += [r.path for r in few]
        blocked += [v == "block"] * len(few)
    model = spark.sparkContext.broadcast(fit(hosts, paths, np.array(blocked, bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for first, some in grams.slices(batch.column("path")):
                hosts = batch.column("host").slice(first, len(some)).to_pylist()
                scores.append(block_probability(model.value, hosts, some))
            p = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, p], [*batch.schema.names, "p_block"])

    scored = parsed.mapInArrow(run, parsed.withColumn("p_block", F.lit(0.0)).schema)
    by_model = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "p_block")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
