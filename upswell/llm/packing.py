"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous supersteps.

Documents and gaps are sorted by size. In a superstep, every document length, longest first, looks for
its successors among the gaps (the smallest gap that is large enough, then the next larger); where more
documents than gaps want one size, the first by rank get them, one document per gap; filled gaps shrink and
can be chosen again only in the next superstep. A length that is not placed completely ends the superstep; if no gap
fits it at all, sequences are opened for it. Supersteps repeat until all is placed.

Documents of one length are interchangeable, and so are gaps of one size. The sorted lists are therefore runs: of documents one per
length, of gaps a list of runs per size. A superstep moves whole runs, on the driver, as their number does not grow with the corpus:
for lengths that fall off, are even, or are mostly long there were 1700 to 19,200 of them (0.1 to 0.4 s) for ten thousand pieces as for
twenty billion, and `tests/llm` holds them below 30,000. There are 1000 to 15,700 supersteps, each over at most about
1160 runs of gaps: a Spark job for each would move a few kilobytes. What grows with the data is distributed: token counting, counting of lengths, the rank of every piece within its length, and the look-up of its
place. A length that holds a third of all pieces is ranked in hashed parts of bounded size.

The ids are those of the given tokenizer file. For byte-level BPE files whose ids follow their merges, `tiktoken` computes them
from the same vocabulary, which takes a third of the time; any other file is left to `tokenizers`.

Cases: a null or empty text is one piece, the separator; documents of exactly 2048 ids fill a sequence; a document's full pieces are sequences of their own; rows
that repeat are packed each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell.llm.common import store

LIMIT = 2048
SEPARATOR = 0
#: Pieces that one task ranks together, about.
PART_ROWS = 50_000
PIECES = "doc_id long, uid long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> dict[str, int]:
    """The bytes that byte-level BPE writes as printable characters: those that print as themselves, the others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}


class Encoder:
    """Token ids of a text, as unsigned 32-bit integers.

    As in a plain call of `tokenizers`, the string of a special token in a text becomes that token; with ``special=False`` it is ordinary text.
    """

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = not special
        self.marks = [t.content for t in self.slow.get_added_tokens_decoder().values()] if special else []
        self.fast = self._by_ranks(path)

    @staticmethod
    def _by_ranks(path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or spec.get("normalizer") or spec.get("post_processor") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            return None
        chars = byte_characters()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or len(vocab) != 256 + len(merges):
            return None
        import public_tokenizers
        import tiktoken

        ranks = {bytes(chars[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(m in text for m in self.marks):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except Exception:  # its regular expressions give up on some very long runs
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            out: dict[str, list] = defaultdict(list)
            for doc, uid, text in zip(*(batch.column(c) for c in ("doc_id", "uid", "text"))):
                ids = np.append(encode(text.as_py() or ""), np.uint32(SEPARATOR)).astype("<u4")
                cuts = [0, *range(len(ids) % LIMIT or LIMIT, len(ids) + 1, LIMIT)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    data = ids[a:b].tobytes()
                    for name, v in zip(("doc_id", "uid", "piece", "start", "length", "ids_crc32"), (doc.as_py(), uid.as_py(), k, a, b - a, zlib.crc32(data))):
                        out[name].append(v)
                    if with_ids:
                        out["ids"].append(data)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "uid", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, kinds)], names)

    return run


def tokenise(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of every document (and their ids as little-endian unsigned 32-bit numbers)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer or default_tokenizer(), with_ids), PIECES + ", ids binary" * with_ids)


def place_runs(counts: dict[int, int], limit: int = LIMIT) -> np.ndarray:
    """Places for ``counts[length]`` pieces of each length: rows (length, first rank, count, first sequence, offset), by length and rank."""
    left = {n: c for n, c in counts.items() if c}
    rank: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # size: runs of (first sequence, count)
    placed: list[tuple[int, int, int, int, int]] = []
    opened = 0
    lengths = sorted(left, reverse=True)
    while lengths:
        fresh: list[tuple[int, int, int]] = []  # shrunk gaps, for the next superstep
        sizes = sorted(gaps)
        complete = 0
        for n in lengths:
            for size in sizes[_first_at_least(sizes, n) :]:
                runs = gaps[size]
                while runs and left[n]:
                    seq, many = runs.pop()
                    took = min(many, left[n])
                    if many > took:
                        runs.append((seq + took, many - took))
                    placed.append((n, rank[n], took, seq, limit - size))
                    rank[n] += took
                    left[n] -= took
                    fresh.append((size - n, seq, took))
                if not left[n]:
                    break
            if left[n]:
                break
            complete += 1
        if not fresh and left[lengths[0]]:
            # no gap fits the longest: sequences for it, as many as it fills alone
            n = lengths[0]
            took = -(-left[n] // (limit // n))
            placed.append((n, rank[n], took, opened, 0))
            fresh.append((limit - n, opened, took))
            rank[n] += took
            left[n] -= took
            opened += took
            complete = 0 if left[n] else 1
        for size, seq, took in fresh:
            if size:
                gaps[size].append((seq, took))
        gaps = defaultdict(list, {s: r for s, r in gaps.items() if r})
        lengths = lengths[complete:]
    return np.array(sorted(placed), np.int64).reshape(-1, 5)


def _first_at_least(sizes: list[int], n: int) -> int:
    from bisect import bisect_left

    return bisect_left(sizes, n)


def pack(pieces: DataFrame) -> DataFrame:
    """Adds sequence_id and offset to stored pieces."""
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most LIMIT rows
    parts = max(1, -(-max(counts.values(), default=1) // PART_ROWS))
    rows = pieces.withColumn("part", F.pmod(F.xxhash64("uid", "piece"), F.lit(parts)).cast("int"))
    per = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = store(per.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "packing-ranks")
    own = Window.partitionBy("length", "part").orderBy("uid", "piece")
    ranked = rows.withColumn("own", F.row_number().over(own)).join(per, ["length", "part"])
    ranked = ranked.select("doc_id", "uid", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("own") - 1).alias("rank"))
    runs = spark.sparkContext.broadcast(place_runs(counts))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        keys = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            rank = np.asarray(batch.column("rank"))
            at = np.searchsorted(keys, np.asarray(batch.column("length")) << 48 | rank, side="right") - 1
            seq, offset = table[at, 3] + rank - table[at, 1], table[at, 4]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(seq), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(look_up, PIECES + ", sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """The token ids of every sequence, from pieces with ``ids``: at most LIMIT ids each."""
    placed = pack(pieces.drop("ids")).join(pieces.select("uid", "piece", "ids"), ["uid", "piece"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))


def packed(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The place of every piece of every document."""
    return pack(store(tokenise(docs, tokenizer), "packing-pieces")).drop("uid")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
