"""Exact top-k inner products: vectors by descending length, rotated partial sums, Cauchy-Schwarz bounds.

The vectors are stored sorted by length. The search goes down the lengths in slices (the ``FIRST`` longest, then ``GROWTH`` times as many, and
so on); after every slice each query has its k best so far, and their last score is its threshold. A score is at most
the product of the lengths, so a slice is read only down to the length that some query may still need (a filter that Parquet
skips row groups by), and a query whose threshold is beyond reach is done. Within a task lengths fall too and thresholds rise.

Vectors are rotated by the eigenvectors of their Gram matrix (added up over all vectors in Spark): the first coordinates then carry most of
the length. A partial sum over them plus the product of the remaining lengths bounds the score; what the bound cannot
exclude is computed from the integers. Floating point is exact there as long as the product of the lengths is below 2**53;
above, Python integers are used, and a score beyond 64 bits is returned as the nearest 64-bit number. The rotation decides
only how much is pruned, never a result.

Queries are taken in blocks of about ``BLOCK_BYTES``, each broadcast to the tasks that read the vectors in place; at most k candidates a task and
query are shuffled, and what a block has found is stored, so a lost executor costs its tasks alone. Rows of equal length are dealt out by a hash.

Cases: vectors that are null or hold a null or a component that is not finite take no part; shorter vectors count as filled up with zeros;
ties go to the smaller id, a null id is the largest (and never a query); rows that repeat, of one id too, are rows of their own, and only the query's own
row is left out; a query without other rows has no result; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell.llm.common import new_folder

K = 10
FIRST = 16_384
GROWTH = 16
BLOCK_BYTES = 8_000_000
#: Rows of one task when the vectors are stored, about.
PART_ROWS = 50_000
#: Share of the squared length that the first coordinates carry.
ENERGY = 0.8
#: Partial sums held at once by a task.
PRODUCTS = 1 << 21
NO_ID = 2**63 - 1
FOUND = "query long, score long, id long, uid long"


def scaled(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of every component; null where the vector takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * factor)))


def prepare(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Rows (uid, id, v, norm) of ``vectors`` (id long, v array<long>), stored by descending length, and how many there are."""
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("v").isNotNull()).select(F.monotonically_increasing_id().alias("uid"), F.coalesce("id", F.lit(NO_ID)).alias("id"), "v")
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
    n = vectors.filter(F.col("v").isNotNull()).count()
    parts = max(spark.sparkContext.defaultParallelism, n // PART_ROWS)
    path = new_folder(spark, "by-length")
    rows.repartitionByRange(parts, F.desc("norm"), F.xxhash64("uid")).sortWithinPartitions(F.desc("norm"), "id").write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), n


def _matrix(lists: pa.ListArray, d: int) -> np.ndarray:
    """Vectors of one batch as rows of floating point numbers, filled up with zeros."""
    sizes, flat = np.asarray(lists.value_lengths()), np.asarray(lists.flatten(), np.float64)
    if len(sizes) and (sizes == d).all():
        return flat.reshape(len(sizes), d)
    out = np.zeros((len(sizes), d))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def rotation(rows: DataFrame, d: int) -> tuple[np.ndarray, int]:
    """Eigenvectors of the Gram matrix of all vectors, largest first, and how many carry ``ENERGY`` of the squared length."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            m = _matrix(batch.column("v"), d)
            total += m.T @ m
        i, j = np.triu_indices(d)
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "x": pa.array(total[i, j])})

    sums = rows.select("v").mapInArrow(gram, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    table = np.zeros((d, d))
    i, j, x = (sums[c].to_numpy() for c in ("i", "j", "x"))
    table[i, j] = table[j, i] = x
    values, vectors = np.linalg.eigh(table)
    values = np.maximum(values[::-1], 0)
    share = np.cumsum(values) / (values.sum() or 1.0)
    return np.ascontiguousarray(vectors[:, ::-1]), int(min(d, np.searchsorted(share, ENERGY) + 1))


@dataclass
class Block:
    """Queries of a block with the last of their k best so far (score, id); -inf where there are fewer."""

    uid: np.ndarray
    v: np.ndarray
    norm: np.ndarray
    score: np.ndarray
    id: np.ndarray
    turn: np.ndarray
    first: int
    k: int


def _below(score: np.ndarray) -> np.ndarray:
    """Scores as floating point numbers: exact below 2**53, a little less above."""
    near = score.astype(np.float64)
    return np.where(np.abs(near) < 2**53, near, np.nextafter(near, -np.inf))


class _Best:
    """The k best candidates of every query seen by one task."""

    def __init__(self, block: Block):
        self.block = block
        self.last_score, self.last_id = block.score.copy(), block.id.copy()
        self.q, self.score, self.id, self.uid = (np.zeros(0, np.int64) for _ in range(4))
        self.seen = 0
        self.turned = block.v @ block.turn
        self.rest = np.sqrt(np.maximum((self.turned[:, block.first :] ** 2).sum(axis=1), 0))

    def look_at(self, uid: np.ndarray, ids: np.ndarray, v: np.ndarray, norm: np.ndarray) -> None:
        """Vectors by descending length."""
        b, at = self.block, 0
        while at < len(uid):
            active = np.flatnonzero(b.norm * norm[at] * (1 + 1e-9) >= self.last_score)
            if not len(active):
                return
            # few vectors first: without a threshold nothing is pruned
            to = min(len(uid), at + min(max(64, PRODUCTS // len(active)), max(64, self.seen)))
            self._chunk(active, uid[at:to], ids[at:to], v[at:to], norm[at:to])
            self.seen += to - at
            at = to

    def _chunk(self, active, uid, ids, v, norm) -> None:
        b = self.block
        turned = v @ b.turn
        rest = np.sqrt((turned[:, b.first :] ** 2).sum(axis=1))
        most = self.turned[active, : b.first] @ turned[:, : b.first].T
        most += self.rest[active][:, None] * rest
        most += 1e-9 * b.norm[active][:, None] * norm
        own = np.searchsorted(uid, b.uid[active], sorter=(by := np.argsort(uid)))
        own = by[np.minimum(own, len(uid) - 1)]
        same = uid[own] == b.uid[active]
        most[np.flatnonzero(same), own[same]] = np.nan  # reaches no threshold
        q, c = np.nonzero(most >= self.last_score[active][:, None])
        q = active[q]
        for some in range(0, len(q), PRODUCTS // 16):
            self._exact(q[some : some + PRODUCTS // 16], c[some : some + PRODUCTS // 16], uid, ids, v, norm)

    def _exact(self, q, c, uid, ids, v, norm) -> None:
        b = self.block
        if b.norm.max() * norm[0] < 2**53:
            score = np.einsum("ij,ij->i", b.v[q], v[c]).astype(np.int64)
        else:
            score = np.array([sum(int(x) * int(y) for x, y in zip(b.v[i], v[j])) for i, j in zip(q, c)], object)
            score = np.clip(score, -(2**63), 2**63 - 1).astype(np.int64)
        better = (score > self.last_score[q]) | ((score == self.last_score[q]) & (ids[c] <= self.last_id[q]))
        q, c, score = q[better], c[better], score[better]
        if not len(q):
            return
        touched = np.zeros(len(b.uid), bool)
        touched[q] = True
        old = touched[self.q]
        q = np.concatenate([self.q[old], q])
        score, i, u = np.concatenate([self.score[old], score]), np.concatenate([self.id[old], ids[c]]), np.concatenate([self.uid[old], uid[c]])
        # ascending ~score is descending score, without overflow
        order = np.lexsort((u, i, ~score, q))
        q, score, i, u = q[order], score[order], i[order], u[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top, last = rank < b.k, rank == b.k - 1
        self.last_score[q[last]], self.last_id[q[last]] = _below(score[last]), i[last]
        now = ((self.q, q), (self.score, score), (self.id, i), (self.uid, u))
        self.q, self.score, self.id, self.uid = (np.concatenate([x[~old], y[top]]) for x, y in now)

    def found(self) -> pa.RecordBatch:
        return pa.record_batch({"query": pa.array(self.block.uid[self.q]), "score": pa.array(self.score), "id": pa.array(self.id), "uid": pa.array(self.uid)})


def _scan(vectors: DataFrame, block: Block, d: int) -> DataFrame:
    """The k best of every task for the queries of a block, where they may be among the best of all."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(shared.value)
        for batch in batches:
            norm = batch.column("norm").to_numpy()
            order = np.argsort(-norm, kind="stable")
            best.look_at(*(batch.column(c).to_numpy()[order] for c in ("uid", "id")), _matrix(batch.column("v"), d)[order], norm[order])
        yield best.found()

    return vectors.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = K, block_bytes: int = BLOCK_BYTES, first: int = FIRST) -> DataFrame:
    """query_id, rank (from 1), id and score: the k largest inner products of every query with all other rows.

    ``vectors`` has id and v (integer components), ``is_query`` is a condition on id.
    """
    spark = vectors.sparkSession
    rows, n = prepare(vectors)
    named = F.col("id") != NO_ID
    facts = rows.agg(F.max(F.size("v")).alias("d"), F.count_if(named & is_query).alias("queries")).first()
    path, d = new_folder(spark, "top"), max(facts.d or 0, 1)
    blocks = -(-facts.queries // max(1, block_bytes // (8 * d)))
    if blocks:
        turn, carry = rotation(rows, d)
        ranks = [first * GROWTH**i for i in range(40) if first * GROWTH**i < n]
        at = rows.agg(F.percentile_approx("norm", [1 - r / n for r in ranks], 100_000)).first()[0] if ranks else []
        cuts = [float("inf"), *sorted(set(at), reverse=True), -1.0]
    for number in range(blocks):
        of = F.pmod(F.xxhash64("uid"), F.lit(blocks)) == number
        table = rows.filter(named & is_query & of).select("uid", "v", "norm").orderBy("uid").toArrow()
        m = table.num_rows
        if not m:
            continue
        v = np.concatenate([_matrix(x, d) for x in table["v"].chunks])
        block = Block(table["uid"].to_numpy(), v, table["norm"].to_numpy(), np.full(m, -np.inf), np.full(m, NO_ID), turn, carry, k)
        before = None
        for high, low in zip(cuts, cuts[1:]):
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(block.score > 0, block.score / block.norm, -1.0).min() * (1 - 1e-9)
            if need > high:
                break
            part = rows.filter((F.col("norm") <= high) & (F.col("norm") > low) & (F.col("norm") >= float(need)))
            found = _scan(part, block, d)
            step = f"{path}/steps/{number}-{len(cuts)}-{low}"
            _ranked(found if before is None else before.unionAll(found), k).select("query", "score", "id", "uid").write.parquet(step)
            before = spark.read.schema(FOUND).parquet(step)
            last = before.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max_by("id", F.struct(F.bitwise_not("score"), "id")).alias("id"), F.min("score").alias("score"))
            last = last.filter(F.col("n") == k).orderBy("query").toArrow()  # at most one row a query of the block
            where = np.searchsorted(block.uid, last["query"].to_numpy())
            block.score[where], block.id[where] = _below(last["score"].to_numpy()), last["id"].to_numpy()
        before.write.parquet(f"{path}/found/block={number}")
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    ids = rows.filter(named & is_query).select(F.col("uid").alias("query"), F.col("id").alias("query_id"))
    found = _ranked(spark.read.schema(FOUND).parquet(f"{path}/found"), k).join(ids, "query")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.when(named, F.col("id")).alias("id"), "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = table.select(F.col("vec_id").cast("long").alias("id"), scaled(F.col("embedding")).alias("v"))
    return search(vectors, F.col("id") % 100 == 0).withColumnRenamed("id", "vec_id")


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, row_number() OVER () AS uid, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, q.uid AS q_uid, c.vec_id, c.uid,
    list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM whole q JOIN whole c ON q.uid <> c.uid
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q_uid ORDER BY score DESC, vec_id NULLS LAST, uid) AS rank FROM scores
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
