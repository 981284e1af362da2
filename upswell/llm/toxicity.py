"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over hashed words; each model
also sees the probabilities of the categories before it. In training these are out-of-fold predictions, so
a later model meets them as good, or as bad, as they will be on new documents.

The `labels` table gives two categories: ``junk`` (quality 0) and ``toxic``; any list of 0/1 columns will do.

The sample to fit on is bounded: ``docs_per_class`` labelled documents for each value of the last category, chosen by a
hash of the id. Its words are counted in the tasks; the driver gets the ``features`` most telling
buckets and a table of sample x features. Every document is then scored over its whole text.

Cases: null, empty text or one without letters: no word, so the models' intercepts decide; labels without a document are ignored; a document labelled more than once
counts once, with its highest labels; without a labelled document nothing is flagged; where no word is in three of them the intercepts decide; repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm import grams
from upswell.llm.common import store
from upswell.llm.linear import fit_logistic, probability

BITS = 20
FOLDS = 5


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    buckets: np.ndarray  # selected word buckets, ascending
    weights: tuple[np.ndarray, ...]  # per category: words, earlier probabilities, intercept


def _word_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word."""
    points, starts = grams.code_points(texts)
    h, at = grams.word_hashes(points)
    return (h >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(starts, at, side="right") - 1


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word buckets of each text."""
    for batch in batches:
        out: list[np.ndarray] = []
        for _, texts in grams.slices(batch.column("text")):
            b, r = _word_buckets(texts)
            both = np.unique(r << BITS | b)
            cut = np.searchsorted(both, np.arange(1, len(texts)) << BITS)
            out += [x & ((1 << BITS) - 1) for x in np.split(both, cut)]
        keep = [batch.column(n) for n in batch.schema.names if n != "text"]
        names = [n for n in batch.schema.names if n != "text"] + ["buckets"]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(out, pa.list_(pa.int64()))], names)


def presence(model_buckets: np.ndarray, texts: list[str]) -> np.ndarray:
    """texts x selected buckets: 1 where the text has such a word, else 0."""
    b, r = _word_buckets(texts)
    at = np.searchsorted(model_buckets, b)
    hit = np.flatnonzero(model_buckets[np.minimum(at, len(model_buckets) - 1)] == b) if len(model_buckets) else np.zeros(0, np.int64)
    n = np.bincount(r[hit] * len(model_buckets) + at[hit], minlength=len(texts) * len(model_buckets))
    return (n.reshape(len(texts), len(model_buckets)) > 0).astype(np.float64)


def chain_probabilities(model: Chain, x: np.ndarray) -> np.ndarray:
    """Probability of each category, each fed to the ones after it."""
    out = np.zeros((len(x), 0))
    for w in model.weights:
        p = probability(np.hstack([x, out]) @ w[:-1] + w[-1])
        out = np.hstack([out, p[:, None]])
    return out


def fit_weights(x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> tuple[np.ndarray, ...]:
    weights, earlier = [], np.zeros((len(x), 0))
    for k in range(y.shape[1]):
        seen = np.hstack([x, earlier])
        weights.append(fit_logistic(seen, y[:, k]))
        fresh = np.zeros(len(x))
        for f in range(FOLDS):
            w = fit_logistic(seen[folds != f], y[folds != f, k])
            fresh[folds == f] = probability(seen[folds == f] @ w[:-1] + w[-1])
        earlier = np.hstack([earlier, fresh[:, None]])
    return tuple(weights)


def nothing_known(categories: Sequence[str]) -> Chain:
    """The chain without a labelled document: nothing is flagged."""
    return Chain(tuple(categories), np.zeros(0, np.int64), tuple(np.array([0.0] * k + [-6.0]) for k in range(len(categories))))


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[str], docs_per_class: int = 4000, features: int = 256) -> Chain:
    """``labels``: doc_id and one 0/1 column per category."""
    spark = docs.sparkSession
    last = categories[-1]
    own = labels.groupBy("doc_id").agg(*[(F.max(c) > 0).cast("int").alias(c) for c in categories]).dropna()
    sizes = {r[0]: r[1] for r in own.groupBy(last).count().collect()}
    if not sizes:
        return nothing_known(categories)
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, docs_per_class / v))])
    sample = own.filter(u < F.element_at(share, F.col(last)))
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    # at most about 2 x docs_per_class narrow rows by the line above
    texts = docs.select("doc_id", "text")
    picked = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "fold", *categories, "text")
    schema = ", ".join(["doc_id long", "fold int", *[f"`{c}` int" for c in categories], "buckets array<long>"])
    sets = store(picked.mapInArrow(_distinct, schema), "toxicity-sample")

    total = sets.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    counts = sets.select(*categories, F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories])
    chosen: set[int] = set()
    for c in categories:  # chi-square of (word, category) tables
        n, pos = float(total["n"] or 0), float(total[c] or 0)
        a, b = F.col(c).cast("double"), F.col("n") - F.col(c)
        top = (a * (n - pos) - b * pos) ** 2 / (F.col("n") * (n - F.col("n") + 0.5))
        chosen |= {r.bucket for r in counts.filter("n >= 3").orderBy(top.desc(), "bucket").limit(features // len(categories)).select("bucket").collect()}
    buckets = np.array(sorted(chosen), np.int64)

    wanted = spark.sparkContext.broadcast(buckets)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.isin(wanted.value, np.asarray(b)).astype(np.uint8).tobytes() for b in batch.column("buckets").to_pylist()]
            keep = [batch.column(n) for n in batch.schema.names if n != "buckets"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(x, pa.binary())], [*batch.schema.names[:-1], "x"])

    table = sets.mapInArrow(project, schema.replace("buckets array<long>", "x binary")).orderBy("doc_id").toArrow()
    if not table.num_rows:
        return nothing_known(categories)
    x = np.frombuffer(b"".join(table["x"].to_pylist()), np.uint8).reshape(table.num_rows, len(buckets)).astype(np.float64)
    y = np.stack([table[c].to_numpy() for c in categories], axis=1).astype(float)
    return Chain(tuple(categories), buckets, fit_weights(x, y, table["fold"].to_numpy()))


def predict(docs: DataFrame, model: Chain) -> DataFrame:
    """doc_id and the probability of each category, ``p_<category>``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"p_{c}" for c in model.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [chain_probabilities(shared.value, presence(shared.value.buckets, texts)) for _, texts in grams.slices(batch.column("text"))]
            p = np.concatenate(parts) if parts else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(p[:, k]) for k in range(len(names))]], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(["doc_id long", *[f"`{n}` double" for n in names]]))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, p_junk, p_toxic, toxic (p_toxic of at least one half) and kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    out = predict(docs, fit(docs, labels, ["junk", "toxic"]))
    toxic = F.col("p_toxic") >= 0.5
    return out.select("doc_id", "p_junk", "p_toxic", toxic.alias("toxic"), (~toxic).alias("kept"))
