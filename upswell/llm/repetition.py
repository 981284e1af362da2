"""Quality rules: repetition measured with a suffix array over the words of each text.

The words of a batch of texts become numbers, and suffixes are sorted by prefix doubling: the
first rank is (text, word), so suffixes of different texts are never equal and all texts of a
batch are sorted at once. Suffixes whose rank is unique are settled and leave the doubling, which stops when
none is left. The longest common prefix of neighbours comes from the ranks of all doubling
levels. A stack scan over them gives the prefix intervals; those whose occurrences differ on the left are the maximal
repeated substrings. The union of their spans is what is covered. Intervals come from the deepest up and a
suffix is given its span by the first that holds it (those around it are shorter), so the work grows with the words.

A document is dropped for its base figures, if the share of its words that lie in repeats of
at least ``MIN_REPEAT`` words is above ``MAX_COVERED``, or if one repeat is longer than ``MAX_REPEAT`` words and covers more
than ``MAX_REPEAT_SHARE`` of the words together with its first occurrence.

Cases: null or white space alone: no words, all figures 0, not kept (fewer than 50 words); a text of any length is sorted as a whole; repeated rows are judged alike; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm.repeats import intervals

BATCH_BYTES = 1_000_000
MIN_REPEAT = 8
MAX_COVERED = 0.5
MAX_REPEAT = 40
MAX_REPEAT_SHARE = 0.2
MIN_WORDS = 50
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long"
)


def suffix_array(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all rows in order, and each one's common prefix (in words) with the one before it.

    ``words``: numbers of the words; ``rows``: ascending row of each.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = rows.astype(np.int64) * (int(words.max()) + 1) + words
    # rank 0 stands for the end of a row; the first rank that a key has is its place in the order
    levels: list[np.ndarray] = []
    rank = np.zeros(n + 1, np.int64)
    order = np.argsort(key)
    sorted_key = key[order]
    first = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = start + 1
    levels.append(rank[:n].copy())
    size = np.diff(np.append(np.flatnonzero(first), n))
    alone = np.repeat(size == 1, size)
    place = np.flatnonzero(~alone)  # places of the order that are not settled
    sa = order
    step = 1
    row_end = np.searchsorted(rows, rows, side="right")
    while len(place):
        at = sa[place]
        after = at + step
        second = np.where(after < row_end[at], rank[np.minimum(after, n)], 0)
        group = rank[at]
        by = np.argsort(group * (n + 1) + second)
        at, second, group = at[by], second[by], group[by]
        sa[place] = at
        first = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        begins = np.flatnonzero(first)
        size = np.diff(np.append(begins, len(at)))
        rank[at] = np.repeat(place[begins] + 1, size)
        levels.append(rank[:n].copy())
        place = place[np.repeat(size > 1, size)]
        step *= 2
    # common prefix of neighbours, from the longest level down: equal ranks at level k mean 2**k equal words
    a, b = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(n - 1, np.int64)
    live = np.flatnonzero(rows[a] == rows[b])
    for k in range(len(levels) - 1, -1, -1):
        x, y = a[live], b[live]
        ok = (x < row_end[sa[live]]) & (y < row_end[sa[live + 1]])
        same = ok.copy()
        same[ok] = levels[k][x[ok]] == levels[k][y[ok]]
        hit = live[same]
        common[hit] += 1 << k
        a[hit] += 1 << k
        b[hit] += 1 << k
    return sa, np.concatenate([[0], common])


def repeat_lengths(sa: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For every word, the longest repeat (in words) that starts there and occurs elsewhere in its row: the larger of its two neighbours' prefixes."""
    longest = common.copy()
    longest[:-1] = np.maximum(common[:-1], common[1:])
    out = np.zeros(len(sa), np.int64)
    out[sa] = longest
    return out


def maximal_repeats(words: np.ndarray, rows: np.ndarray, sa: np.ndarray, common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) among the suffixes of every maximal repeated substring of at least ``least`` words, deeper ones before those around them."""
    before = np.where(sa > 0, words[sa - 1], -1)
    before[(sa == 0) | (rows[sa - 1] != rows[sa])] = -1
    return intervals(common, before, least)


def maximal_spans(found: Iterator[tuple[int, int, int]], sa: np.ndarray) -> np.ndarray:
    """For every word, the length of the longest of these repeats that starts there; 0 where none does."""
    out, following = np.zeros(len(sa), np.int64), list(range(len(sa) + 1))

    def next_open(i: int) -> int:
        path = []
        while following[i] != i:
            path.append(i)
            i = following[i]
        for j in path:
            following[j] = i
        return i

    for first, last, length in found:
        i = next_open(first)
        while i <= last:
            out[sa[i]] = length
            following[i] = i + 1
            i = next_open(i + 1)
    return out


def covered(lengths: np.ndarray, least: int, span: int | None = None) -> np.ndarray:
    """Whether each word lies in a repeat of at least ``least`` words; ``span``: count only so many words of each."""
    n = len(lengths)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(lengths >= least)
    edge[at] += 1
    np.add.at(edge, at + (lengths[at] if span is None else span), -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The figures of every text, as columns."""
    n = len(texts)
    texts = pc.fill_null(texts, "")
    parts = pc.ascii_split_whitespace(texts)
    flat, rows = pc.list_flatten(parts), np.asarray(pc.list_parent_indices(parts), np.int64)
    real = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.zeros(0, bool)
    if not real.all():
        flat, rows = flat.filter(pa.array(real)), rows[real]
    words = np.asarray(flat.dictionary_encode().indices, np.int64) if len(flat) else np.zeros(0, np.int64)
    sa, common = suffix_array(words, rows)
    lengths = repeat_lengths(sa, common)
    spans = maximal_spans(maximal_repeats(words, rows, sa, common, MIN_REPEAT), sa)
    count = lambda mask: np.bincount(rows[mask], minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows, lengths)
    lines = pc.split_pattern(texts, "\n")
    line, of = pc.list_flatten(lines), np.asarray(pc.list_parent_indices(lines), np.int64)
    full = np.asarray(pc.match_substring_regex(line, r"[^\x20\x09-\x0D]"))
    line, of = line.filter(pa.array(full)), of[full]
    codes = np.asarray(line.dictionary_encode().indices, np.int64) if len(line) else np.zeros(0, np.int64)
    distinct = np.unique(of * (len(line) + 1) + codes) // (len(line) + 1)
    return {
        "n_words": np.bincount(rows, minlength=n),
        "word_chars": np.bincount(rows, np.asarray(pc.utf8_length(flat)), n).astype(np.int64),
        "n_symbols": np.asarray(pc.count_substring_regex(texts, r"[#*$%&|<>]"), np.int64),
        "n_dup_lines": np.bincount(of, minlength=n) - np.bincount(distinct, minlength=n),
        "n_repeat_words": count(covered(lengths, 3, 3)),
        "covered_words": count(covered(spans, MIN_REPEAT)),
        "longest_repeat": longest,
    }


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("text")
        sizes = np.asarray(pc.fill_null(pc.binary_length(text), 0), np.int64)
        part = (np.cumsum(sizes) - sizes) // BATCH_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            got = measure(text.slice(a, b - a))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *[pa.array(v, pa.int64()) for v in got.values()]], ["doc_id", *got])


def figures(docs: DataFrame) -> DataFrame:
    """The figures of every document, over its whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_run, SCHEMA)


def judged(docs: DataFrame) -> DataFrame:
    out = figures(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    too_much = F.col("covered_words") > MAX_COVERED * F.col("n_words")
    too_long = (F.col("longest_repeat") > MAX_REPEAT) & (2 * F.col("longest_repeat") > MAX_REPEAT_SHARE * F.col("n_words"))
    return out.withColumn("kept", ~failed & ~too_much & ~too_long)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat")
