"""Alignment of two tokenizers: the smallest groups of tokens that both cut at the same bytes.

A text is encoded by both. Places where a token of either ends are common cuts. They are found by divide and conquer: the common
end next to the middle of an interval is located by bisecting the other side's ends, then both halves are
treated alike; an interval without a common end inside is a group. All intervals of a batch go down together, one numpy step a level.

Tokens of one group are linked, each with each. For an id pair the corpus counts the documents that hold it linked. Frequent
pairs are looked up in a broadcast table: those with at least one ``HEAVY``-th of all (document, pair) rows,
hence never more than ``HEAVY`` of them. All other pairs are joined in a shuffle, where none of them can be hot.

Both tokenizers run without special tokens, whose strings are ordinary text. The byte-level side sees a space before the text, the
sentence-piece side adds its own.

Cases: a null or empty text, or one whose token bytes on either side are not those of the space and the text (as with U+2581, or
characters the sentence-piece side rewrites): no tokens, all numbers 0, groups ''; rows that repeat count as documents of their own; null ids are
kept; an empty table gives an empty result; further columns are ignored. One group without a common end may be as long as its text: only its
distinct id pairs are made.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell.llm import octets, packing
from upswell.llm.common import store

BATCH_BYTES = 300_000
#: Most pairs that are looked up in a broadcast table (17 bytes each).
HEAVY = 1 << 17
#: Links of one group from which its distinct ids are paired first.
LARGE_GROUP = 4096
SIDES = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """Ids and token bytes of a byte-level vocabulary."""

    def __init__(self, path: str):
        self.encoder = packing.Encoder(path, special=False)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
        chars = packing.byte_characters()
        self.table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.table[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoder(" " + t) for t in texts]


class Pieces:
    """Ids and token bytes of a sentence-piece vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode(texts, num_threads=1)]


class Aligner:
    """Aligns batches of texts; one per worker process and pair of files."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.sizes = [np.array([len(t) for t in side.table], np.int64) for side in (self.a, self.b)]
        names = [[str(i) for i in range(len(side.table))] for side in (self.a, self.b)]
        # every id followed by each mark it may need
        self.marked = [n + m for n in names[0] for m in ",|"] + [n + m for n in names[1] for m in (",", ";", "")]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        nothing = np.zeros(0, np.uint32)
        for text, a, b in zip(texts, self.a(texts), self.b(texts)):
            whole = b" " + text.encode()
            same = text and all(b"".join(map(side.table.__getitem__, ids.tolist())) == whole for side, ids in ((self.a, a), (self.b, b)))
            out.append((a, b) if same else (nothing, nothing))
        return out

    def __call__(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """The columns of ``SIDES`` for these texts."""
        coded = self.encode(texts)
        ids = [np.concatenate([np.zeros(0, np.uint32), *(c[k] for c in coded)]).astype(np.int64) for k in (0, 1)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids)]
        first = [np.concatenate([[0], np.cumsum([len(c[k]) for c in coded])]).astype(np.int64) for k in (0, 1)]
        a_cut, b_cut = common_cuts(ends[0], ends[1], first[0], first[1])
        a_from, b_from = np.concatenate([[0], a_cut[:-1]]), np.concatenate([[0], b_cut[:-1]])
        a_from, b_from = a_from[: len(a_cut)], b_from[: len(b_cut)]
        of = np.searchsorted(first[0], a_cut, side="left") - 1  # the document of a group
        links = (a_cut - a_from) * (b_cut - b_from)
        n = len(texts)
        pairs, times, offsets = self._pairs(ids, (a_from, a_cut, b_from, b_cut), of, n)
        return {
            "n_a": np.diff(first[0]),
            "n_b": np.diff(first[1]),
            "n_groups": np.bincount(of, minlength=n),
            "n_links": _sums(of, links, n),
            "groups": self._written(ids, first, (a_from, a_cut, b_from, b_cut)),
            "pairs": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(pairs)),
            "times": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(times)),
        }

    def _written(self, ids, first, groups) -> list[str]:
        """Per document its groups as ``a1,a2|b1;a3|b2,b3``."""
        a_from, a_cut, b_from, b_cut = groups
        of_a, of_b = np.repeat(np.arange(len(a_cut)), a_cut - a_from), np.repeat(np.arange(len(b_cut)), b_cut - b_from)
        a, b = np.arange(len(ids[0])), np.arange(len(ids[1]))
        order = np.empty(len(a) + len(b), np.int64)
        order[a + b_from[of_a]] = 2 * ids[0] + (a + 1 == a_cut[of_a])
        closes = (b + 1 == b_cut[of_b]).astype(np.int64)
        closes[first[1][1:][np.diff(first[1]) > 0] - 1] = 2
        order[b + a_cut[of_b]] = 2 * len(self.a.table) + 3 * ids[1] + closes
        edge = (first[0] + first[1]).tolist()
        return ["".join(map(self.marked.__getitem__, order[x:y].tolist())) for x, y in zip(edge, edge[1:])]

    @staticmethod
    def _pairs(ids, groups, of, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked id pairs (a << 32 | b) of each document, how often each is linked, and the documents' offsets."""
        a_from, a_cut, b_from, b_cut = groups
        large = (a_cut - a_from) * (b_cut - b_from) > LARGE_GROUP
        small = np.flatnonzero(~large)
        at, group = ragged(a_from[small], a_cut[small])
        group = small[group]
        other, row = ragged(b_from[group], b_cut[group])
        keys = [ids[0][at[row]] << 32 | ids[1][other]]
        docs, times = [of[group[row]]], [np.ones(len(other), np.int64)]
        for g in np.flatnonzero(large):
            a, many_a = np.unique(ids[0][a_from[g] : a_cut[g]], return_counts=True)
            b, many_b = np.unique(ids[1][b_from[g] : b_cut[g]], return_counts=True)
            keys.append((a[:, None] << 32 | b[None, :]).ravel())
            times.append((many_a[:, None] * many_b[None, :]).ravel())
            docs.append(np.full(len(keys[-1]), of[g]))
        key, doc, time = np.concatenate(keys), np.concatenate(docs), np.concatenate(times)
        by = np.lexsort((key, doc))
        key, doc, time = key[by], doc[by], time[by]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(fresh)
        return key[head], np.add.reduceat(time, head) if len(head) else time, np.searchsorted(doc[head], np.arange(n + 1))


def _sums(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, of, values)
    return out


def ragged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the intervals [low, high), and the interval of each."""
    many = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(low)), many)
    return np.arange(len(owner)) - (np.cumsum(many) - many)[owner] + low[owner], owner


def _near_middle(a_ends: np.ndarray, b_ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the token of a in [low, high) nearest to its middle whose end is an end of b too, and that token of b; -1 if none."""
    middle = (low + high - 1) // 2
    cut, partner = np.full(len(low), -1), np.full(len(low), -1)
    open_ = np.arange(len(low))
    inner, outer = 0, 1  # distances tried in this round: inner <= distance < outer
    while len(open_):
        m, lo, hi = middle[open_], low[open_], high[open_]
        right, left_owner = np.minimum(m + outer, hi), None
        at, owner = ragged(m + inner, right)
        if inner:
            left, left_owner = ragged(np.maximum(m - outer + 1, lo), m - inner + 1)
            at, owner = np.concatenate([at, left]), np.concatenate([owner, left_owner])
        found = np.searchsorted(b_ends, a_ends[at])
        hit = np.flatnonzero(b_ends[found] == a_ends[at])
        # the nearest hit of every interval, the right one of two
        hit = hit[np.lexsort((-at[hit], np.abs(at[hit] - m[owner[hit]]), owner[hit]))]
        hit = hit[np.flatnonzero(np.diff(owner[hit], prepend=-1))]
        cut[open_[owner[hit]]], partner[open_[owner[hit]]] = at[hit], found[hit]
        more = (cut[open_] < 0) & ((m - outer >= lo) | (m + outer < hi))
        open_ = open_[more]
        inner, outer = outer, 2 * outer
    return cut, partner


def common_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end: numbers of the first token of a, and of b, after each group, ascending.

    The ends ascend over all documents; document d holds tokens first[d] to first[d + 1] - 1, and its last tokens end together.
    """
    some = np.flatnonzero(np.diff(a_first) > 0)
    a_low, a_high, b_low, b_high = a_first[some], a_first[some + 1], b_first[some], b_first[some + 1]
    a_cuts, b_cuts = [a_high], [b_high]
    while len(a_low):
        splits = (a_high - a_low > 1) & (b_high - b_low > 1)
        a_low, a_high, b_low, b_high = a_low[splits], a_high[splits], b_low[splits], b_high[splits]
        # the last token of a ends with the interval: it is no cut inside
        cut, partner = _near_middle(a_ends, b_ends, a_low, a_high - 1)
        has = cut >= 0
        a_low, a_high, b_low, b_high = a_low[has], a_high[has], b_low[has], b_high[has]
        a_at, b_at = cut[has] + 1, partner[has] + 1
        a_cuts.append(a_at)
        b_cuts.append(b_at)
        a_low, a_high = np.concatenate([a_low, a_at]), np.concatenate([a_at, a_high])
        b_low, b_high = np.concatenate([b_low, b_at]), np.concatenate([b_at, b_high])
    return np.sort(np.concatenate(a_cuts)), np.sort(np.concatenate(b_cuts))


@cache
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document: uid (a number of the row), doc_id and the columns of ``SIDES``.

    ``groups`` writes the ids, a side first; ``pairs`` are the distinct linked id pairs (a << 32 | b), ``times`` how often each is linked.
    """
    default = default_tokenizers()
    a_path, b_path = a_path or default[0], b_path or default[1]
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align_texts = _aligner(a_path, b_path)
        for whole in batches:
            for batch in octets.chunks(whole, "text", BATCH_BYTES):
                out = align_texts([t or "" for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), *map(pa.array, out.values())], ["uid", "doc_id", *out])

    return rows.mapInArrow(run, "uid long, doc_id long, " + SIDES)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per linked id pair: pair, n (documents that hold it), best (no pair of its first id has more)."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    # one id of a has at most as many pairs as b has ids
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def score_links(aligned: DataFrame, counts: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """uid, n_best and count_sum of every document, from stored ``aligned`` rows and stored ``counts``."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * heavy >= total
    table = counts.filter(often).orderBy("pair").toArrow()  # at most ``heavy`` rows, as their n add up to no more than the total
    known = aligned.sparkSession.sparkContext.broadcast([table[c].to_numpy() for c in ("pair", "n", "best")])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            lists = batch.column("pairs")
            keys, times = np.asarray(lists.flatten()), np.asarray(batch.column("times").flatten())
            of = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            hit = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            rest = np.flatnonzero(~hit)
            of_hit, at, many = of[hit], at[hit], times[hit]
            offsets = pa.array(np.searchsorted(of[rest], np.arange(batch.num_rows + 1)).astype(np.int32))
            others = pa.StructArray.from_arrays([pa.array(keys[rest]), pa.array(times[rest])], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid"),
                    pa.array(_sums(of_hit, many * best[at], batch.num_rows)),
                    pa.array(_sums(of_hit, many * n[at], batch.num_rows)),
                    pa.ListArray.from_arrays(offsets, others),
                ],
                ["uid", "n_best", "count_sum", "rest"],
            )

    looked = aligned.select("uid", "pairs", "times").mapInArrow(look_up, "uid long, n_best long, count_sum long, rest array<struct<pair:long,times:long>>")
    rare = looked.select("uid", F.explode("rest").alias("r")).select("uid", "r.pair", "r.times")
    joined = rare.join(counts.filter(~often), "pair")
    added = joined.select("uid", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    both = looked.select("uid", "n_best", "count_sum").unionAll(added)
    return both.groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256")
    aligned = store(aligned.select("uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"), "aligned")
    counts = store(pair_counts(aligned), "pair-counts")
    rows = aligned.select("uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return rows.join(score_links(aligned, counts), "uid").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
