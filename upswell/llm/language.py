"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts grams per (language, bucket) in the tasks, adds the counts up in a shuffle and
brings languages x buckets numbers to the driver, whatever the corpus. The log-probability
matrix is broadcast, and tasks score whole texts in batches: the sparse gram counts of a batch
times the matrix is a gather of rows and a sum per text.

The sample to learn from is bounded: ``docs_per_lang`` labelled documents per language,
chosen by a hash of the id. Languages are a list of at most ``MAX_LANGS``.

Cases: null text, or one without a letter: ``und`` with score 0; a language with one document is learned; without labelled documents
everything is ``und``; rows that repeat are scored alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm import grams

BITS = 16
LONGEST = 3
MAX_LANGS = 1000


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    matrix: np.ndarray  # buckets x languages, float32 log-probabilities
    prior: np.ndarray


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in grams.slices(batch.column("text")):
            points, starts = grams.code_points(texts)
            buckets, places = grams.char_grams(points, LONGEST, BITS)
            names = langs[first : first + len(texts)]
            codes = {x: i for i, x in enumerate(dict.fromkeys(names))}
            of = np.array([codes[x] for x in names])[np.searchsorted(starts, places, side="right") - 1]
            got = np.bincount(of * (1 << BITS) + buckets, minlength=len(codes) << BITS).reshape(len(codes), -1)
            for lang, i in codes.items():
                seen[lang] = seen.get(lang, 0) + got[i]
    for lang, n in seen.items():
        at = np.flatnonzero(n)
        yield pa.record_batch({"lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at, pa.int64()), "n": pa.array(n[at], pa.int64())})


def fit(labelled: DataFrame, docs_per_lang: int = 4000) -> LanguageModel:
    """A model of the labelled rows (doc_id, text, lang) with text and lang."""
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    per = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS + 1).collect()}
    if len(per) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not per:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    langs = tuple(sorted(per))
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, docs_per_lang / per[k]))])
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = rows.filter(u < F.element_at(share, F.col("lang"))).select("text", "lang")
    counts = sample.mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((1 << BITS, len(langs)))
    at = {x: i for i, x in enumerate(langs)}
    table[counts["bucket"].to_numpy(), [at[x] for x in counts["lang"].to_pylist()]] = counts["n"].to_numpy()
    table += 0.5
    log = np.log(table) - np.log(table.sum(axis=0))
    prior = np.array([per[x] for x in langs], float)
    return LanguageModel(langs, log.astype(np.float32), np.log(prior / prior.sum()))


def score_texts(model: LanguageModel, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Most probable language and its posterior probability for each text."""
    points, starts = grams.code_points(texts)
    buckets, places = grams.char_grams(points, LONGEST, BITS)
    sums, n = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts), np.int64)
    # the places of each gram length ascend; each length is one sorted stretch
    for a, b in _stretches(places):
        rows = np.searchsorted(starts, places[a:b], side="right") - 1
        sums += grams.row_sums(model.matrix[buckets[a:b]], rows, len(texts))
        n += np.bincount(rows, minlength=len(texts))
    if not model.langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    total = sums + model.prior
    best = total.argmax(axis=1)
    p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    has = n > 0
    return [model.langs[k] if ok else "und" for k, ok in zip(best, has)], np.where(has, p, 0.0)


def _stretches(places: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(places) < 0) + 1), len(places)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def predict(docs: DataFrame, model: LanguageModel, *keep: Column, with_text: bool = False) -> DataFrame:
    """``keep`` columns (and the text as ``__text``) with lang_pred and score; only the text is looked at."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = (rows if with_text else rows.drop("__text")).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, texts in grams.slices(batch.column("__text")):
                a, b = score_texts(shared.value, texts)
                langs += a
                scores.append(b)
            own = batch.num_columns - (not with_text)
            rest = [batch.column(i) for i in range(own)]
            names = [*batch.schema.names[:own], "lang_pred", "score"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names)

    return rows.mapInArrow(run, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(docs: DataFrame) -> LanguageModel:
    """The model of the documents that are not held out."""
    return fit(docs.filter(~held_out()))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, fit_on(docs), F.col("doc_id"), held_out().alias("held_out"))


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with at least this probability; all their columns."""
    names = docs.columns
    # the text goes through the tasks once, beside the other columns
    others = F.struct(F.lit(0).alias("__none"), *[docs[f"`{c}`"] for c in names if c != "text"]).alias("__row")
    scored = predict(docs, fit_on(docs), others, with_text=True).filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return scored.select(*[(F.col("__text") if c == "text" else F.col("__row")[c]).alias(c) for c in names])
