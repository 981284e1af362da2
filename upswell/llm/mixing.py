"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Targets: source ``i`` with size ``s_i`` and weight ``w_i`` gets ``min(max_epochs * s_i, level * w_i)``. Sources at
their limit are clamped and their excess is shared anew by weight, until none is above. Every
document of a source is taken ``floor(target / size)`` whole times; the rest of the target is
a fractional epoch: documents in the order of a seeded hash, until the rest is used up.

The order is never sorted as a whole. Sums per (source, hash prefix) find the prefix in which
the rest runs out; only documents of that prefix are ordered. The cut is a key, so a document
is taken or not by comparing its own key with its source's, and no join by document is
needed. One more document, the one whose size comes nearest to what is left, closes the gap.

Rows that agree in doc_id and size have one key and are counted before anything is ordered. Where the rest runs out within
such a key, as many of its rows are taken as fit, the first in the table. Only rows of that key, and of the closing document's, are
numbered: within the parts of the table they lie in, with the counts of the parts before.

Sources are few (one row each in a configuration): the frame of sources is the only one that
meets in one task. Documents are only ever summed per source and prefix, before the shuffle.

Cases: a null source is a source, ordered last; a null text has size 0; sources of size 0 get
target 0; rows that repeat are taken one by one; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell.llm.common import n_words, store


def _key(seed: int) -> Column:
    """Seeded place of a document in its source's order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """Adds ``target`` to rows of source, source_size and weight. One row per source.

    The final clamped set is the sources with the smallest ``limit / weight``: with these in
    order, it is the longest beginning whose next limit lies below the level that the rest would get.
    """
    limit = F.col("source_size") * F.lit(float(max_epochs))
    ranked = sources.withColumn("limit", limit).withColumn("at", F.col("limit") / F.col("weight"))
    before = Window.orderBy("at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy(F.lit(0))
    ranked = ranked.withColumn("used", F.coalesce(F.sum("limit").over(before), F.lit(0.0))).withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ranked = ranked.withColumn("level", (F.sum("source_size").over(everything) - F.col("used")) / (F.sum("weight").over(everything) - F.col("gone")))
    # levels rise up to the first source that keeps within its limit and fall after it
    level = F.max(F.when(F.col("at") >= F.col("level"), F.col("level"))).over(everything)
    return ranked.withColumn("level", level).withColumn("target", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))).drop("limit", "at", "used", "gone", "level")


def plan_mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: float = 3.0, seed: int = 1) -> DataFrame:
    """One row per source: source, source_size, target, whole (repetitions of each document), cut (the last key taken
    once more; null: none), edge (the next key) with more (how many of its rows are taken once more) and extra (the key of the closing row; null: none).

    ``docs``: doc_id, source, size. Sources in code-point order, null last, get the weights in turn.
    """
    docs = docs.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    docs = store(docs.select("doc_id", "source", "size", "n", (F.col("size") * F.col("n")).alias("words"), _key(seed).alias("h")), "mix-sizes")
    sources = docs.groupBy("source").agg(F.sum("words").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    filled = water_fill(sources.withColumn("weight", turn), max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    filled = store(filled.withColumn("whole", whole.cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    # as many prefixes that a source's documents fall into about the square root of their number of groups
    most = filled.agg(F.max("n_docs")).first()[0] or 1
    digits = max(1, min(8, (most.bit_length() + 7) // 8))
    prefix = F.substring("h", 1, digits)
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    sums = docs.groupBy("source", prefix.alias("prefix")).agg(F.sum("words").alias("words"))
    upto = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    edge = sums.alias("a").join(filled.select("source", "rest").alias("b"), same).filter("before <= rest AND rest < before + words")
    edge = edge.select(F.col("a.source").alias("source"), "prefix", "before", "rest")
    inside = docs.alias("a").join(edge.alias("b"), same & (prefix == F.col("prefix"))).select("a.source", "h", "doc_id", "size", "a.words", "before", "rest")
    own = Window.partitionBy("source").orderBy("h", "doc_id", "size").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("used", F.col("before") + F.sum("words").over(own))
    key = F.struct(F.col("a.h").alias("h"), F.col("a.doc_id").alias("doc_id"), F.col("a.size").alias("size"))
    fits = F.col("used") <= F.col("rest")
    cuts = inside.alias("a").groupBy("source").agg(
        F.max(F.when(fits, key)).alias("cut"), F.max(F.when(fits, F.col("used"))).alias("used"), F.min(F.when(~fits, key)).alias("edge")
    )
    # where no document of the edge's prefix fits, everything before that prefix is taken
    cuts = edge.alias("b").join(cuts.alias("a"), same, "left").select(
        F.col("b.source").alias("source"), F.coalesce("a.used", "b.before").alias("used"), F.coalesce(F.col("cut"), _before("prefix")).alias("cut"), "edge"
    )
    # the edge's rows cross the rest, so it has words and more rows than fit
    more = F.coalesce(F.floor((F.col("rest") - F.col("used")) / F.col("edge.size")), F.lit(0)).cast("long")
    cut = filled.alias("b").join(cuts.alias("a"), same, "left").select("b.*", "used", "cut", "edge").withColumn("more", more)
    plan = store(cut.withColumn("used", F.col("used") + F.col("more") * F.coalesce("edge.size", F.lit(0))), "mix-cuts")

    left = F.col("rest") - F.col("used")
    off = F.abs(F.col("a.size") - left)
    rest = docs.alias("a").join(plan.alias("b"), same).filter(key > F.col("cut")).filter((off < left) & (F.col("a.size") > 0))
    closing = rest.groupBy(F.col("b.source").alias("source")).agg(F.min_by(key, F.struct(off, F.col("a.h"), F.col("a.doc_id"))).alias("extra"))
    out = plan.alias("b").join(closing.alias("a"), same, "left")
    return store(out.select("b.source", "source_size", "target", "whole", "cut", "edge", "more", "extra"), "mix-plan")


def _before(prefix: str) -> Column:
    """A key just below all keys with this prefix."""
    return F.struct(F.col(prefix).alias("h"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("size"))


def _planned(plan: DataFrame, docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with their source's plan and wanted: null, or how many rows of the document's key are taken once more where not all or none are."""
    key = F.struct(_key(seed).alias("h"), F.col("doc_id"), F.col("size"))
    p = plan.select(F.col("source").alias("of"), "source_size", "target", "whole", "cut", "edge", "more", "extra")
    joined = docs.join(p, docs["source"].eqNullSafe(p["of"])).withColumn("key", key)
    some = F.when(F.col("key") == F.col("edge"), F.col("more")).otherwise(0) + F.when(F.col("key") == F.col("extra"), 1).otherwise(0)
    return joined.withColumn("wanted", F.when(some > 0, some))


def _all_or_none(plan: DataFrame, docs: DataFrame, seed: int) -> DataFrame:
    more = F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    rows = _planned(plan, docs, seed).filter("wanted IS NULL").withColumn("copies", F.col("whole") + more)
    return rows.select(*docs.columns, "source_size", "target", "copies")


def _one_by_one(plan: DataFrame, docs: DataFrame, seed: int) -> DataFrame:
    """The rows of keys of which some are taken, numbered by their place: the part of the table, then the row in it."""
    rows = _planned(plan, docs, seed).filter("wanted IS NOT NULL").withColumn("place", F.monotonically_increasing_id())
    rows = store(rows.withColumn("part", F.shiftright("place", 33)), "mix-some")
    before = Window.partitionBy("source", "key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("source", "key", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select(F.col("source").alias("of_source"), F.col("key").alias("of_key"), F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("source", "key", "part").orderBy("place"))
    same = F.col("source").eqNullSafe(F.col("of_source")) & F.col("key").eqNullSafe(F.col("of_key")) & (F.col("part") == F.col("of_part"))
    numbered = rows.withColumn("own", own).join(parts, same)
    copies = F.col("whole") + F.when(F.col("before") + F.col("own") <= F.col("wanted"), 1).otherwise(0)
    return numbered.withColumn("copies", copies).select(*docs.columns, "source_size", "target", "copies")


def copies(plan: DataFrame, docs: DataFrame, seed: int = 1) -> DataFrame:
    """``docs`` (doc_id, source, size and whatever else) with source_size, target and copies: whole repetitions and the fractional one."""
    return _all_or_none(plan, docs, seed).unionAll(_one_by_one(plan, docs, seed))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: float = 3.0, seed: int = 1) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, all columns kept."""
    names = docs.columns
    plan = plan_mix(store(sized(docs), "mix-words"), weights, max_epochs, seed)

    def wide(rows: DataFrame) -> DataFrame:
        row = F.struct(*[rows[f"`{c}`"] for c in names]).alias("row")
        return rows.select(row, rows["doc_id"].cast("long").alias("doc_id"), rows["source"].cast("string").alias("source"), n_words(rows["text"]).alias("size"))

    # rows to be numbered are found by their ids, at most two a source
    some = plan.select("source", F.explode(F.array("edge.doc_id", "extra.doc_id")).alias("doc_id")).distinct().select(F.struct("source", "doc_id").alias("k"))
    own = F.struct(docs["source"].cast("string").alias("source"), docs["doc_id"].cast("long").alias("doc_id"))
    few = docs.join(some, own.eqNullSafe(some["k"]), "left_semi")
    taken = _all_or_none(plan, wide(docs), seed).unionAll(_one_by_one(plan, wide(few), seed)).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col("row")[c].alias(c) for c in names])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = store(sized(spark.read.parquet(f"{sf_dir}/documents.parquet")), "mix-words")
    out = copies(plan_mix(measured), measured)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('1:' || doc_id) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT *, 3.0::DOUBLE * source_size AS lim, (3.0::DOUBLE * source_size) / weight AS at_level FROM (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source)),
r AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY at_level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY at_level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s),
t AS (SELECT source, source_size, least(lim, weight * (SELECT max(level) FROM r WHERE at_level >= level)) AS target FROM r),
w AS (
  SELECT *, target - whole * source_size AS rest FROM (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t)),
c AS (
  SELECT d.*, source_size, target, whole, rest, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size) AS used
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source),
u AS (SELECT *, rest - coalesce(max(CASE WHEN used <= rest THEN used END) OVER (PARTITION BY source), 0) AS gap FROM c),
x AS (
  SELECT *, CASE WHEN used > rest AND size > 0 AND abs(size - gap) < gap THEN row_number() OVER (
    PARTITION BY source ORDER BY CASE WHEN used > rest AND size > 0 AND abs(size - gap) < gap THEN 0 ELSE 1 END, abs(size - gap), h, doc_id) END AS place FROM u)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN used <= rest OR place = 1 THEN 1 ELSE 0 END))::BIGINT AS taken FROM x
"""
