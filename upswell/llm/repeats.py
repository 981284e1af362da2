"""Repeated passages by the prefix-interval tree of an enhanced suffix array, and documents without them.

A suffix array of the whole corpus fits nowhere, and most of a corpus repeats nowhere. Three steps find what does:

1. Anchors. Every window of ``width`` bytes has an anchor, the leftmost of its grams with the smallest hash, so equal
   windows have equal anchors at equal places. Consecutive windows with one anchor are a context (the bytes
   that they span). Anchors meet by hash, packed. Of equal contexts the earliest stays, and the others are
   repeats as a whole: copies are combined within a batch before the shuffle and once more after it.
2. Intervals. Contexts that share an anchor but differ hold the ends of repeats. Their suffixes are sorted (ranks
   of 8 bytes, doubled) and a stack scan over the common prefixes of neighbours yields the intervals
   of the tree, deepest first. An interval of depth ``width`` or more whose occurrences have different left neighbours is a maximal repeat:
   all its occurrences are one group, and all but the earliest are repeats.
3. Removal. A document's spans, at most as many as it has windows, are joined to its text and united.

An anchor with more than ``HOT`` different contexts (a common phrase in ever new surroundings) is not gathered:
hashes of its windows are grouped in Spark, where the earliest of each is a combined minimum.

``spans`` needs only the earliest of equal contexts; ``groups`` adds the copies of each to the groups it is in.

Order: doc_id (null first), then the row's place in the table, then the start. Equal hashes of 64 bits count as equal bytes in step 1.

Cases: a null or empty text has no bytes and nothing removed; a text shorter than ``width`` is left alone; a very long
text is a batch of its own; of repeated rows (also with one doc_id) the first keeps its bytes; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswell.llm import octets
from upswell.llm.common import new_folder, store

WIDTH = 100
#: Different contexts of one anchor that one task sorts together.
HOT = 2000
#: Bytes of text whose anchors meet in one task, and bytes of contexts that one task sorts, about.
MEET_BYTES = 64_000_000
SORT_BYTES = 2_000_000
_PLACE = np.uint64((1 << 34) - 1)
FIRST = -(2**63)

ANCHORS = "kind int, number long, data binary"
#: what anchors that met say: a span to remove (many 0), the context of which such spans are copies (many -1; an earliest of some batch,
#: perhaps also a span), or a context (first window, number of windows) of an anchor with ``many`` different ones
SPANS = "uid long, doc long, anchor long, ctx long, start long, stop long, many long"
COLUMNS = np.dtype([("h", "<u8"), ("ctx", "<u8"), ("doc", "<i8"), ("uid", "<i8"), ("start", "<i8"), ("n", "<i2")])


# --- step 1 ---------------------------------------------------------------------------------


def gram_of(width: int) -> int:
    return max(1, width * 3 // 10)


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: of a block's end and the next block's beginning."""
    n = len(values)
    if n < width:
        return values[:0]
    full = np.full(-(-n // width) * width, ~np.uint64(0))
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def contexts(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Row, first window (in the row), number of windows, anchor hash and context hash of every context."""
    gram = gram_of(width)
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    stretch = octets.Stretches(data.astype(np.uint64))
    at = np.arange(len(data) - gram + 1)
    h = stretch(at, at + gram)
    first = (least_in((h >> np.uint64(34) << np.uint64(34)) | at.astype(np.uint64), width - gram + 1) & _PLACE).astype(np.int64)
    windows = np.maximum(np.diff(offsets) - width + 1, 0)
    row = np.repeat(np.arange(len(windows)), windows)
    p = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[:-1][row]
    anchor = first[p]
    new = np.ones(len(p), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    lead = np.flatnonzero(new)
    n = np.diff(np.append(lead, len(p)))
    start, anchor, row = p[lead], anchor[lead], row[lead]
    whole = octets.mix(stretch(start, start + n + width - 1) ^ octets.mix((anchor - start).astype(np.uint64) + np.uint64(1)))
    return row, start - offsets[:-1][row], n, h[anchor], whole


def earliest(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by anchor, context and order; whether each is the first of its context."""
    t = t[np.lexsort((t["start"], t["uid"], t["doc"], t["ctx"], t["h"]))]
    lead = np.ones(len(t), bool)
    lead[1:] = (t["h"][1:] != t["h"][:-1]) | (t["ctx"][1:] != t["ctx"][:-1])
    return t, lead


def copied(lead: np.ndarray) -> np.ndarray:
    """Whether a row of ``earliest`` is the first of its context and others follow."""
    return lead & ~np.append(lead[1:], True)


def _anchors(width: int, parts: int):
    """Rows of kind 1: contexts of one part of the shuffle; of kind 0: contexts repeated within the batch; of kind 2: the first of each of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in octets.chunks(whole, "text"):
                row, start, n, h, ctx = contexts(*octets.octets(batch.column("text")), width)
                t = np.empty(len(row), COLUMNS)
                t["h"], t["ctx"], t["start"], t["n"] = h, ctx, start, n
                t["doc"], t["uid"] = np.asarray(batch.column("doc"))[row], np.asarray(batch.column("uid"))[row]
                t, lead = earliest(t)
                again, source, t = t[~lead], t[copied(lead)], t[lead]
                part = (t["h"] % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((t["start"], t["uid"], t["doc"], part))
                t, part = t[order], part[order]
                used = np.unique(part)
                cut = np.searchsorted(part, [*used, parts])
                data = [_packed(t[a:b]) for a, b in zip(cut, cut[1:])] + [_packed(again), _packed(source)] * (len(again) > 0)
                kind = [1] * len(used) + [0, 2] * (len(again) > 0)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array([*used.tolist(), *[0] * (len(data) - len(used))], pa.int64()), pa.array(data, pa.binary())], ["kind", "number", "data"])

    return run


def _packed(t: np.ndarray) -> bytes:
    """Column by column, which compresses better."""
    return b"".join(np.ascontiguousarray(t[c]).tobytes() for c in COLUMNS.names)


def _unpacked(data: bytes) -> np.ndarray:
    n, at = len(data) // COLUMNS.itemsize, 0
    t = np.empty(n, COLUMNS)
    for c in COLUMNS.names:
        t[c] = np.frombuffer(data, COLUMNS[c], n, at)
        at += n * COLUMNS[c].itemsize
    return t


def _span_batch(t: np.ndarray, width: int, many: np.ndarray) -> pa.RecordBatch:
    stop = np.where(many > 0, t["n"], t["start"] + t["n"] + width - 1)
    columns = [t["uid"], t["doc"], t["h"].view(np.int64), t["ctx"].view(np.int64), t["start"], stop, many]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], SPANS.replace(" long", "").split(", "))


def _again(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, x in zip(batch.column("kind").to_pylist(), batch.column("data")):
                t = _unpacked(x.as_py())
                yield _span_batch(t, width, np.full(len(t), 0 if kind == 0 else -1))

    return run


def _meet(width: int):
    def run(table: pa.Table) -> pa.Table:
        t, lead = earliest(np.concatenate([_unpacked(x.as_py()) for x in table.column("data")]))
        again, source, t = t[~lead], t[copied(lead)], t[lead]
        new = np.ones(len(t), bool)
        new[1:] = t["h"][1:] != t["h"][:-1]
        per = np.diff(np.append(np.flatnonzero(new), len(t)))
        many = np.repeat(per, per)
        known = [_span_batch(x, width, np.full(len(x), k)) for x, k in ((again, 0), (source, -1))]
        return pa.Table.from_batches([*known, _span_batch(t[many > 1], width, many[many > 1])])

    return run


# --- step 2 ---------------------------------------------------------------------------------


def suffixes(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Enhanced suffix array: the wanted places by their suffix (up to the row's end), and each one's common prefix with the one before it."""
    n = len(data)
    end = np.repeat(offsets[1:], np.diff(offsets))
    at = np.arange(n)
    word = np.zeros(n, np.uint64)
    padded = np.append(data.astype(np.uint64) + np.uint64(0), np.zeros(8, np.uint64))
    for k in range(8):
        word = word << np.uint64(8) | np.where(at + k < end, padded[k : k + n], np.uint64(0))
    # shorter suffixes first where padding makes words equal
    left = np.minimum(end - at, 8)
    order = np.lexsort((left, word))
    ranks, step = [], 8
    fresh = np.ones(n, bool)
    fresh[1:] = (word[order][1:] != word[order][:-1]) | (left[order][1:] != left[order][:-1])
    while True:
        rank = np.zeros(n + 1, np.int64)
        rank[order] = np.cumsum(fresh)
        ranks.append(rank)
        if fresh.all() or step > (np.diff(offsets).max() if len(offsets) > 1 else 0):
            break
        second = np.where(at + step < end, rank[np.minimum(at + step, n)], 0)
        key = rank[:n] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        fresh[1:] = key[order][1:] != key[order][:-1]
        step *= 2
    sa = wanted[np.argsort(rank[wanted], kind="stable")]
    a, b = sa[:-1].copy(), sa[1:].copy()
    ends = end[sa[:-1]], end[sa[1:]]
    common = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        size = 8 << k
        same = (a + size <= ends[0]) & (b + size <= ends[1])
        same &= ranks[k][np.minimum(a, n)] == ranks[k][np.minimum(b, n)]
        for x in (a, b, common):
            x[same] += size
        if k == len(ranks) - 1:  # more than one stretch of the longest size may agree
            while same.any():
                same &= (a + size <= ends[0]) & (b + size <= ends[1])
                same &= ranks[k][np.minimum(a, n)] == ranks[k][np.minimum(b, n)]
                for x in (a, b, common):
                    x[same] += size
    open_ = np.ones(len(a), bool)
    for _ in range(8):
        open_ &= (a < ends[0]) & (b < ends[1])
        open_ &= data[np.minimum(a, n - 1)] == data[np.minimum(b, n - 1)]
        for x in (a, b, common):
            x[open_] += 1
    return sa, np.concatenate([[0], common])


def intervals(common: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, depth) of the intervals of the tree with at least this depth whose occurrences differ on the left.

    ``before``: the byte before each suffix, or a negative number where there is none, which differs from all.
    """
    MIXED = -2
    # stretches in which all have one left neighbour hold no such interval
    differs = np.ones(len(before), bool)
    differs[1:] = before[1:] != before[:-1]
    alone = np.concatenate([[0], np.cumsum(before < 0)])
    changes = np.cumsum(differs)
    for a, b in _deep(common, least):
        if alone[b + 1] == alone[a - 1] and changes[b] == changes[a - 1]:
            continue
        stack: list[list[int]] = []  # depth, first, left neighbour of all so far
        for i in range(a, b + 2):
            depth = int(common[i]) if i <= b else 0
            first, left = i - 1, int(before[i - 1])
            while stack and stack[-1][0] > depth:
                d, first, l2 = stack.pop()
                left = l2 if l2 == left and left >= 0 else MIXED
                if left < 0:
                    yield first, i - 1, d
            if depth < least:
                continue
            if stack and stack[-1][0] == depth:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == left and left >= 0 else MIXED
            else:
                stack.append([depth, first, left])


def _deep(common: np.ndarray, least: int) -> list[tuple[int, int]]:
    """First and last place of each stretch of ``common`` that is at least ``least``."""
    edge = np.diff((common >= least).astype(np.int8), prepend=0, append=0)
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


GROUPS = "repeat string, length long, uid long, doc long, start long"
#: Groups of contexts without their copies: where in which context an occurrence is.
OWN_GROUPS = GROUPS + ", anchor long, ctx long, shift long"


def _sorted_suffixes(table: pa.Table, width: int):
    """Windows of the contexts of a table by their suffix: context, start, common prefix with the one before, byte before, and rank by place in the corpus."""
    uid, doc, start, n = (table.column(c).to_numpy() for c in ("uid", "doc", "start", "n"))
    data, offsets = octets.octets(table.column("data"))
    of = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    wanted = offsets[:-1][of] + place
    sa, common = suffixes(data, offsets, wanted)
    row = np.searchsorted(offsets, sa, side="right") - 1
    begin = start[row] + sa - offsets[:-1][row]
    before = np.where(sa > offsets[:-1][row], data[np.maximum(sa - 1, 0)].astype(np.int64), -1)
    rank = np.empty(len(sa), np.int64)
    rank[np.lexsort((begin, uid[row], doc[row]))] = np.arange(len(sa))
    return row, begin, common, before, rank


def repeat_groups(table: pa.Table, width: int) -> pa.Table:
    """Maximal repeats within the contexts of a table (uid, doc, anchor, ctx, start, n, data), each with all its occurrences there; the earliest comes first."""
    uid, doc, anchor, ctx, start = (table.column(c).to_numpy() for c in ("uid", "doc", "anchor", "ctx", "start"))
    row, begin, common, before, rank = _sorted_suffixes(table, width)
    at, sizes, lengths = [], [], []
    for a, b, depth in intervals(common, before, width):
        own = np.arange(a, b + 1)
        at.append(own[np.argsort(rank[a : b + 1])])
        sizes.append(b - a + 1)
        lengths.append(depth)
    at = np.concatenate(at) if at else np.zeros(0, np.int64)
    name = uuid.uuid4().hex
    names = pa.array([f"{name}-{i}" for i in range(len(sizes))], pa.string()).take(pa.array(np.repeat(np.arange(len(sizes)), sizes).astype(np.int64)))
    out = [np.repeat(np.array(lengths, np.int64), sizes) if sizes else at, uid[row][at], doc[row][at], begin[at], anchor[row][at], ctx[row][at], (begin - start[row])[at]]
    return pa.table([names, *[pa.array(x, pa.int64()) for x in out]], names=OWN_GROUPS.replace(" long", "").replace(" string", "").split(", "))


def repeat_spans(table: pa.Table, width: int) -> pa.Table:
    """uid, start and stop of the longest maximal repeat at every window that is not its earliest occurrence.

    Intervals come from the deepest up. One occurrence of an interval, the earliest, stays open for the intervals around it; the others
    get their span there and are never looked at again, so the work grows with the windows, however deep the tree is.
    """
    uid = table.column("uid").to_numpy()
    row, begin, common, before, rank = _sorted_suffixes(table, width)
    ranks, following = rank.tolist(), list(range(len(rank) + 1))  # following: the next place that is open, itself if it is
    length = np.zeros(len(rank), np.int64)

    def next_open(i: int) -> int:
        path = []
        while following[i] != i:
            path.append(i)
            i = following[i]
        for j in path:
            following[j] = i
        return i

    for a, b, depth in intervals(common, before, width):
        least = next_open(a)
        i = next_open(least + 1)
        while i <= b:
            least, later = (least, i) if ranks[least] < ranks[i] else (i, least)
            length[later] = depth
            following[later] = later + 1
            i = next_open(i + 1)
    at = np.flatnonzero(length)
    return pa.table([pa.array(x, pa.int64()) for x in (uid[row][at], begin[at], begin[at] + length[at])], names=["uid", "start", "stop"])


def _cut_out(width: int):
    """Contexts (uid, doc, anchor, ctx, many, start, n) with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in octets.chunks(whole, "text"):
                data, offsets = octets.octets(batch.column("text"))
                asked = batch.column("asked")
                row, flat = np.asarray(pa.compute.list_parent_indices(asked), np.int64), pa.compute.list_flatten(asked)
                anchor, ctx, start, n, many = (np.asarray(flat.field(c)) for c in ("anchor", "ctx", "start", "stop", "many"))
                text = data.tobytes()
                pieces = [text[a : a + k] for a, k in zip((offsets[:-1][row] + start).tolist(), (n + width - 1).tolist())]
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("uid").take(rows), batch.column("doc").take(rows), *[pa.array(x, pa.int64()) for x in (anchor, ctx, start, n, many)], pa.array(pieces, pa.binary())],
                    ["uid", "doc", "anchor", "ctx", "start", "n", "many", "data"],
                )

    return run


WINDOWS = "uid long, doc long, anchor long, ctx long, start long, h long, shift long"


def _windows(width: int):
    """Hash of every window of a context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in octets.chunks(whole, "data"):
                data, offsets = octets.octets(batch.column("data"))
                n = np.asarray(batch.column("n"))
                of = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                p = offsets[:-1][of] + place
                h = octets.Stretches(data.astype(np.uint64))(p, p + width)
                rows = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(rows) for c in ("uid", "doc", "anchor", "ctx")], *[pa.array(x, pa.int64()) for x in (np.asarray(batch.column("start"))[of] + place, h.view(np.int64), place)]],
                    WINDOWS.replace(" long", "").split(", "),
                )

    return run


# --- the operator ---------------------------------------------------------------------------


def numbered(docs: DataFrame) -> DataFrame:
    """A stored table of uid, doc (its order), doc_id and text, bucketed by uid: later joins shuffle spans, not texts."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = new_folder(spark, "numbered")
    table = f"numbered_{uuid.uuid4().hex}"
    rows.repartition(buckets, "uid").write.bucketBy(buckets, "uid").format("parquet").option("compression", "zstd").option("path", path).saveAsTable(table)
    return spark.table(table)


class Repeats:
    """Repeats of ``width`` bytes or more among the texts of a ``numbered`` table."""

    def __init__(self, texts: DataFrame, width: int = WIDTH, hot: int = HOT):
        self.texts, self.width, self.hot = texts, width, hot
        spark = texts.sparkSession
        total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // MEET_BYTES))
        found = store(texts.select("uid", "doc", "text").mapInArrow(_anchors(width, parts), ANCHORS), "anchors")
        met = found.filter("kind = 1").select("number", "data").groupBy("number").applyInArrow(_meet(width), SPANS)
        self.met = store(met.unionByName(found.filter("kind <> 1").select("kind", "data").mapInArrow(_again(width), SPANS)), "met")
        asked = self.met.filter("many > 0").groupBy("uid").agg(F.collect_list(F.struct("anchor", "ctx", "start", "stop", "many")).alias("asked"))
        cut = texts.select("uid", "doc", "text").join(asked, "uid").mapInArrow(_cut_out(width), "uid long, doc long, anchor long, ctx long, start long, n long, many long, data binary")
        self.open = store(cut, "contexts")

    def groups(self) -> DataFrame:
        """Maximal repeats within contexts: repeat (a name), length, and uid, doc and start of every occurrence.

        Every window that occurs more than once has a group that holds all its occurrences at one distance from its own. Equal
        contexts are groups as a whole; contexts of hot anchors give groups of single windows instead of maximal repeats.
        """
        named = ["repeat", "length", "uid", "doc", "start"]
        copies = store(self.met.filter("many <= 0").select("anchor", "ctx", "uid", "doc", "start", "stop").distinct(), "copies")
        windows = self._hot_windows()
        again = windows.groupBy("h").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("h")
        hot = windows.join(again, "h").select(F.concat(F.lit("w"), F.hex("h")).alias("repeat"), F.lit(self.width).cast("long").alias("length"), "uid", "doc", "start", "anchor", "ctx", "shift")
        # an occurrence in a context that has copies is one in each of them; the copies of a context include itself
        at = copies.select("anchor", "ctx", F.col("uid").alias("c_uid"), F.col("doc").alias("c_doc"), F.col("start").alias("c_start"))
        own = self._own_groups().unionByName(hot).join(at, ["anchor", "ctx"], "left")
        own = own.select("repeat", "length", F.coalesce("c_uid", "uid").alias("uid"), F.coalesce("c_doc", "doc").alias("doc"), F.coalesce(F.col("c_start") + F.col("shift"), "start").alias("start"))
        whole = copies.select(F.concat(F.lit("c"), F.hex("anchor"), F.lit("-"), F.hex("ctx")).alias("repeat"), (F.col("stop") - F.col("start")).alias("length"), "uid", "doc", "start")
        return own.unionByName(whole).select(named)

    def _cold(self) -> DataFrame:
        """The earliest of equal contexts, for anchors that are not hot, dealt out by anchor."""
        cold = self.open.filter(F.col("many") <= self.hot)
        bins = max(1, (cold.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // SORT_BYTES)
        return cold.select(F.pmod(F.xxhash64("anchor"), F.lit(bins)).alias("bin"), "uid", "doc", "anchor", "ctx", "start", "n", "data")

    def _own_groups(self) -> DataFrame:
        """Maximal repeats within these contexts."""
        width = self.width
        return self._cold().groupBy("bin").applyInArrow(lambda t: repeat_groups(t, width), OWN_GROUPS)

    def _own_spans(self) -> DataFrame:
        """Of the same repeats, what each window that is not the earliest is covered by."""
        width = self.width
        return self._cold().groupBy("bin").applyInArrow(lambda t: repeat_spans(t, width), "uid long, start long, stop long")

    def _hot_windows(self) -> DataFrame:
        return store(self.open.filter(F.col("many") > self.hot).mapInArrow(_windows(self.width), WINDOWS), "hot-windows")

    def spans(self) -> DataFrame:
        """uid, start and stop of every repeat that starts earlier elsewhere; spans may overlap."""
        order = F.struct("doc", "uid", "start")
        later = self._own_spans()
        windows = self._hot_windows()
        first = windows.groupBy("h").agg(F.min(order).alias("first"))
        hot = windows.join(first, "h").filter(order > F.col("first")).select("uid", "start", (F.col("start") + self.width).alias("stop"))
        return self.met.filter("many = 0").select("uid", "start", "stop").unionByName(later).unionByName(hot)


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in octets.chunks(whole, "text"):
                data, offsets = octets.octets(batch.column("text"))
                row = np.asarray(pa.compute.list_parent_indices(batch.column("spans")), np.int64)
                flat = pa.compute.list_flatten(batch.column("spans"))
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, offsets[:-1][row] + np.asarray(flat.field("start")), 1)
                np.add.at(edge, offsets[:-1][row] + np.asarray(flat.field("stop")), -1)
                gone = np.cumsum(edge[:-1]) > 0
                out = []
                for a, b in zip(offsets, offsets[1:]):
                    mine = gone[a:b]
                    left = data[a:b][~mine].tobytes()
                    runs = int(np.count_nonzero(mine[1:] & ~mine[:-1]) + (len(mine) > 0 and mine[0]))
                    out.append((int(b - a), int(mine.sum()), runs, hashlib.sha256(left).hexdigest(), left))
                columns = [pa.array([x[k] for x in out], t) for k, t in enumerate([pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_text])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text])

    return run


def without_repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """What is left of every document; ``with_text`` adds the bytes themselves as ``kept``."""
    texts = numbered(docs)
    spans = Repeats(texts, width, hot).spans().groupBy("uid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = texts.join(spans, "uid", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_remove(with_text), OUT + ", kept binary" * with_text)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
