"""Periodic runs of words: maximal stretches that repeat themselves at a period, found through multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least
max(``min_length``, 2 q) words, which no neighbouring word extends. All runs of a document are found:

- Periods below ``FIRST`` (24): every lag is scanned directly, all documents of a batch at once.
- Periods of a scale, W to 2 W - 1 with W = 24, 48, 96, ...: grams of W / 2 words have hashes, and a window of W words chooses its
  smallest gram. Inside a run windows one period apart are equal, so their chosen grams are equal and one period apart: pairs of equal
  chosen grams at a distance of the scale are the seeds. Grams that lie in a run of period W / 4 or less (known from
  smaller scales) are not chosen; equal grams are then more than W / 4 apart, so a gram has at most 8 partners.
- A run whose windows hold only such grams lies in two runs of one small period that touch: seeds are the distances of the
  scale at which those two agree.

A seed is extended both ways by bisecting hashes of stretches; every run is then compared word by word, and scanned
directly where a hash was wrong. Words are numbered exactly within a batch, so hashes decide nothing.

Work and memory are bounded by the batch (``BATCH_BYTES`` of text, or one longer document): documents are independent and nothing is shuffled.

Cases: null or empty text, or white space alone: no words, no runs, the collapsed text is ''; fewer than ``min_length`` words: no runs; rows that
repeat are treated each by itself; a null doc_id is kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm import octets

#: Periods below this are found by scanning every lag.
FIRST = 24
MIN_LENGTH = 12
BATCH_BYTES = 500_000
OUT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_NEVER = np.uint64(2**64 - 1)


def split_words(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of a text: maximal runs of other characters than the six white-space characters."""
    return (text or "").encode().split()


class Sequences:
    """The words of several documents as one array of numbers, a number that occurs nowhere else after each document."""

    def __init__(self, documents: list[list[bytes]]):
        number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.sizes = np.array([len(d) for d in documents], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes + 1)]).astype(np.int64)
        self.x = np.empty(self.first[-1], np.int64)
        self.x[self.first[1:] - 1] = -1 - np.arange(len(documents))
        for at, words in zip(self.first.tolist(), documents):
            self.x[at : at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1


def _stretches_of_lag(x: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (of the words) of every maximal stretch with period ``lag`` and at least ``least`` words."""
    equal = np.zeros(max(len(x) - lag, 0) + 2, bool)
    np.equal(x[:-lag], x[lag:], out=equal[1:-1])
    edge = np.flatnonzero(equal[1:] != equal[:-1])
    start, end = edge[::2], edge[1::2] + lag
    long = end - start >= least
    return start[long], end[long]


def _primitive(found: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), one for each stretch: that of its smallest period."""
    if not len(found):
        return found.reshape(0, 3)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[fresh]


def _chosen(order: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest value, the leftmost of equal ones, of every window of ``width``; each place once, ascending."""
    # value in the upper half, place in the lower: the smallest pair is the leftmost smallest value
    low = (order >> np.uint64(32) << np.uint64(32)) | np.arange(len(order), dtype=np.uint64)
    low[order == _NEVER] = _NEVER
    have = 1
    while have < width and len(low):
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        have += step
    low = low[low != _NEVER]
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return place[np.flatnonzero(np.diff(place, prepend=-1))]


class _Finder:
    def __init__(self, texts: Sequences, min_length: int):
        self.all, self.x, self.min_length = texts, texts.x, min_length
        self.hash = octets.Stretches(self.x.astype(np.uint64))

    def find(self) -> np.ndarray:
        """All runs as rows (start, end, period), places within ``x``."""
        found = [np.zeros((0, 3), np.int64)]
        for lag in range(1, FIRST):
            start, end = _stretches_of_lag(self.x, lag, max(self.min_length, 2 * lag))
            found.append(np.stack([start, end, np.full(len(start), lag)], axis=1))
        runs = _primitive(np.concatenate(found))
        scale = FIRST
        while (self.all.sizes >= 2 * scale).any():
            seeds = np.concatenate([self._equal_grams(scale, runs), self._touching(scale, runs)])
            runs = _primitive(np.concatenate([runs, self._extend(seeds)]))
            scale *= 2
        return runs

    def _equal_grams(self, scale: int, runs: np.ndarray) -> np.ndarray:
        """Seeds (place, distance): chosen grams that are equal at a distance of the scale."""
        gram = scale // 2
        n = len(self.x) - gram + 1
        if n <= 0:
            return np.zeros((0, 2), np.int64)
        at = np.arange(n)
        order = self.hash(at, at + gram)
        order[order == _NEVER] -= np.uint64(1)
        # grams that never count: across the end of a document, in one too short for the scale, or in a run of small period
        step = np.zeros(n + 1, np.int32)
        ends = self.all.first[1:] - 1
        lo = np.where(self.all.sizes >= 2 * scale, ends - gram + 1, self.all.first[:-1])
        np.add.at(step, np.clip(lo, 0, n), 1)
        np.add.at(step, np.clip(ends + 1, 0, n), -1)
        small = runs[(runs[:, 2] <= gram // 2) & (runs[:, 1] - runs[:, 0] >= gram)]
        np.add.at(step, small[:, 0], 1)
        np.add.at(step, small[:, 1] - gram + 1, -1)
        order[np.cumsum(step[:-1]) > 0] = _NEVER
        place = _chosen(order, scale - gram + 1)
        place = place[np.lexsort((place, order[place]))]
        value = order[place]
        seeds, ahead = [np.zeros((0, 2), np.int64)], 1
        while ahead < len(place):
            distance = place[ahead:] - place[:-ahead]
            near = (value[ahead:] == value[:-ahead]) & (distance < 2 * scale)
            if not near.any():
                break
            near = np.flatnonzero(near & (distance >= scale))
            seeds.append(np.stack([place[near], distance[near]], axis=1))
            ahead += 1
        return np.concatenate(seeds)

    def _touching(self, scale: int, runs: np.ndarray) -> np.ndarray:
        """Seeds from two runs of one small period, the second beginning before the first one's end or at it."""
        some = runs[(runs[:, 2] <= scale // 4) & (runs[:, 1] - runs[:, 0] >= scale)]
        some = some[np.lexsort((some[:, 0], some[:, 2]))]
        pairs = np.flatnonzero((some[1:, 2] == some[:-1, 2]) & (some[1:, 0] <= some[:-1, 1])) if len(some) > 1 else []
        seeds = [np.zeros((0, 2), np.int64)]
        for k in pairs:
            (s1, e1, p), (s2, e2, _) = some[k].tolist(), some[k + 1].tolist()
            turns = np.arange(p)
            turn = np.flatnonzero(self.hash(s1 + turns, s1 + turns + p) == self.hash(np.array([s2]), np.array([s2 + p]))[0])
            if not len(turn):
                continue
            distance = np.arange(scale + (s2 - s1 - int(turn[0]) - scale) % p, 2 * scale, p)
            start = np.maximum(s1, s2 - distance)
            fits = np.minimum(e1, e2 - distance) - start >= distance
            seeds.append(np.stack([start[fits], distance[fits]], axis=1))
        return np.concatenate(seeds)

    def _extend(self, seeds: np.ndarray) -> np.ndarray:
        """Runs around the seeds, as rows (start, end, distance)."""
        if not len(seeds):
            return np.zeros((0, 3), np.int64)
        at, lag = seeds[:, 0], seeds[:, 1]
        document = self.all.document(at)
        first, last = self.all.first[document], self.all.first[document + 1] - 1
        ahead = self._reach(at, lag, np.maximum(last - lag - at, 0), 1)
        back = self._reach(at, lag, at - first, -1)
        start, end = at - back, at + ahead + lag
        long = (ahead > 0) & (end - start >= np.maximum(self.min_length, 2 * lag))
        runs = np.unique(np.stack([start, end, lag], axis=1)[long], axis=0)
        return np.array([run for r in runs.tolist() if (run := self._checked(*r)) is not None], np.int64).reshape(-1, 3)

    def _reach(self, at: np.ndarray, lag: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words from ``at`` on (``way`` 1) or before it (-1) equal those ``lag`` later, by bisection over hashes; at most ``most``."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            # reaches grow by doubling until one fails, then halve
            mid = np.minimum(2 * low[open_] + 1, (low[open_] + high[open_] + 1) // 2)
            a = at[open_] if way > 0 else at[open_] - mid
            b = a + mid
            same = self.hash(a, b) == self.hash(a + lag[open_], b + lag[open_])
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1

    def _checked(self, start: int, end: int, lag: int) -> tuple[int, int, int] | None:
        """The run itself if its words agree and it cannot be extended, else what a direct scan from its middle finds."""
        x = self.x
        inside = np.array_equal(x[start : end - lag], x[start + lag : end])
        if inside and (start == 0 or x[start - 1] != x[start - 1 + lag]) and x[end] != x[end - lag]:
            return start, end, lag
        document = int(self.all.document(np.array([start]))[0])
        a, b = int(self.all.first[document]), int(self.all.first[document + 1]) - 1
        starts, ends = _stretches_of_lag(x[a:b], lag, max(self.min_length, 2 * lag))
        over = np.flatnonzero((starts + a < end) & (ends + a > start))
        return (int(starts[over[0]]) + a, int(ends[over[0]]) + a, lag) if len(over) else None


def runs_of(documents: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """For each document its runs as rows (start, length, period), by start, then period."""
    texts = Sequences(documents)
    # shorter runs than asked for guide the search of longer ones
    runs = _Finder(texts, min(min_length, MIN_LENGTH)).find()
    runs = runs[runs[:, 1] - runs[:, 0] >= min_length]
    of = texts.document(runs[:, 0])
    runs = np.stack([runs[:, 0] - texts.first[of], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    by = np.lexsort((runs[:, 2], runs[:, 0], of))
    return np.split(runs[by], np.searchsorted(of[by], np.arange(1, len(documents)))) if documents else []


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words no run holds after its first period, joined by single spaces."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(itertools.compress(words, (np.cumsum(step[:-1]) == 0).tolist()))


def detect(docs: DataFrame, min_length: int = MIN_LENGTH, words: Callable[[int | None, str | None], list[bytes]] = split_words) -> DataFrame:
    """doc_id, n_words, all runs, and the text with every run collapsed to its first period.

    ``words(doc_id, text)`` gives the words of a document as UTF-8.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in octets.chunks(whole, "text", BATCH_BYTES):
                documents = [words(d, t) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
                found = runs_of(documents, min_length)
                flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32))
                values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(d) for d in documents], pa.int64()),
                        pa.ListArray.from_arrays(offsets, values),
                        pa.array([collapse(d, r) for d, r in zip(documents, found)], pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, " + OUT)


def summary(found: DataFrame) -> DataFrame:
    """Digest columns of detected runs: their number, the longest one (then smallest start, then period), and hashes of all."""
    runs = F.col("runs")
    key: Column = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.select("doc_id", "collapsed", runs, lines.alias("lines"), F.array_min(key).alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("(1000 * -best.l) div best.p").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join("lines", "\n"), F.when(F.size("lines") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def planted_words(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words of the query: those of one document in ten repeat from a place on; a null doc_id counts as the empty string."""
    words = split_words(doc_id, text)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(detect(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=planted_words))
