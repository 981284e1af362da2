"""Exact Jaccard join of word shingles in metric space, and the classes that its links make.

Jaccard distance is a metric, so distances to pivots bound distances between documents. But documents that have nothing to do with
each other are all at distance 1 from any pivot: pivots alone would replicate the whole corpus into every
region. The join therefore has two steps, both exact.

1. Cells. Sets within the threshold differ in at most ``d`` shingles, ``d`` known from their sizes. The
   universe of shingles is hashed into more than ``d / 2`` parts, so two such sets differ in at most one shingle in at least one part.
   Each part has three thirds: one difference leaves two thirds that agree completely. Sets that agree in two thirds of a part
   with ``STRONG`` shingles or more are joined to the first of them. Fewer shingles may agree by a short common passage: there two sets are
   joined only if the counts of their shingles by bucket (more buckets for larger sets) do not differ by more than ``d`` altogether, as they cannot in linked sets.
   Connected sets form a cell; no link leaves a cell. Sizes are
   classed so that sets of one or of neighbouring classes meet. Thirds that are empty do not count; a (small) set that has more
   parts with such thirds than were added for that also meets others by the pairs of its smallest hashes, of which linked sets share one.
2. Regions. Within a cell, pivots are chosen and every document goes to the region of its nearest pivot, and
   also into each region whose pivot is at most two thresholds further away than its nearest one: of any linked pair, one region then
   holds both. Regions are joined recursively; distances to pivots link documents, and bound the distance of
   pairs. Pairs that links already connect need not be compared, and a region whose documents are all
   connected is done, so a group of many near copies costs one comparison each.

A cell with more shingles than a task should hold is cut into blocks: pivots are compared with every
block first; what they do not connect to the cell's largest class is then compared, in blocks, with all blocks.
Equal sets are one set, combined before the shuffle as equal parts are, so copies and very common parts cost a row per task and batch.

Cases: a null text or one without words has no shingles and links with nothing; with fewer words than a shingle has, the whole
sequence is one shingle; repeated rows and equal texts are linked; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswell.llm import octets
from upswell.llm.common import KEY, row_key, rows_of, store, text_key
from upswell.llm.components import components

#: Shingles that one task holds at once in the second step, about.
BLOCK = 1_000_000
#: Bytes of text that are described together.
DESCRIBE_BYTES = 500_000
PIVOTS = 8
LEAF = 24
#: Shingles by which an agreement is taken without a look at the counts by bucket.
STRONG = 6
BUCKETS = 128
#: Rows of agreements by few shingles in a task, about.
WEAK_ROWS = 50_000
#: Sets of one weak key that one task compares with each other; more are dealt out in blocks of so many, every two of which meet in a task.
WEAK_BLOCK = 4000
#: Pivots that a cell of many blocks is first compared with.
FIRST_PIVOTS = 64


# --- shingle sets ---------------------------------------------------------------------------


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, by row and hash, and the rows' offsets among them."""
    n = len(offsets) - 1
    _, row, h = octets.words(data, offsets)
    per = np.bincount(row, minlength=n)
    ends = np.cumsum(per)
    first = ends - per
    count = np.where(per >= width, per - width + 1, np.minimum(per, 1))
    length = np.where(per >= width, width, per)
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    of = np.repeat(np.arange(n), count)
    value = octets.Stretches(h)(at, at + length[of]) if len(at) else np.zeros(0, np.uint64)
    order = np.lexsort((value, of)) if len(at) else np.zeros(0, np.int64)
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    value, of = value[new], of[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int64)


def fingerprints(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers of every set: sums of differently scrambled hashes."""
    out = np.zeros((len(offsets) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        for k, salt in enumerate((np.uint64(0x51ED270B), np.uint64(0xA3C59AC2F1))):
            out[full, k] = np.add.reduceat(octets.mix(value ^ salt), offsets[full])
    return out


def as_bytes(pairs: np.ndarray) -> list[bytes]:
    data, width = np.ascontiguousarray(pairs).tobytes(), pairs.shape[1] * pairs.itemsize
    return [data[i : i + width] for i in range(0, len(data), width)]


def histograms(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of shingles of every set by bucket of their hashes, 255 at most: sums of differences bound how much sets differ."""
    n = len(offsets) - 1
    bucket = (octets.mix(value ^ np.uint64(0x2B7E151628AED2A6)) % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * BUCKETS + bucket, minlength=n * BUCKETS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(n, BUCKETS)


def fine_histograms(value: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """``histograms`` with at least a bucket for 8 shingles: unlike sets of very many shingles differ too little in few buckets."""
    sizes, out = np.diff(offsets), as_bytes(histograms(value, offsets))
    scrambled = octets.mix(value ^ np.uint64(0x2B7E151628AED2A6))
    for i in np.flatnonzero(sizes > 8 * BUCKETS).tolist():
        buckets = BUCKETS << int(np.ceil(np.log2(sizes[i] / (8 * BUCKETS))))
        counts = np.bincount((scrambled[offsets[i] : offsets[i + 1]] % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        out[i] = np.minimum(counts, 255).astype(np.uint8).tobytes()
    return out


def folded(counts: np.ndarray, buckets: int) -> np.ndarray:
    """Counts by bucket in fewer buckets, as ``histograms`` has them there."""
    return np.minimum(counts.reshape(-1, buckets).sum(axis=0, dtype=np.int64), 255)


LINK = "a long, b long"


# --- step 1: cells --------------------------------------------------------------------------


@cache
def size_classes(percent: int, upto: int) -> np.ndarray:
    """Lower bounds of the size classes: sets of sizes a <= b with 100 a >= percent b are in one class or in neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= upto:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds, np.int64)


@cache
def parts_for(percent: int, low: int, high: int) -> tuple[int, int, int]:
    """(difference allowed, parts, parts with empty thirds provided for) for sets of sizes from low to below high."""
    differ = 2 * (high - 1) * (100 - percent) // (100 + percent)
    need = differ // 2 + 1
    best = (-1e9, 0)
    for spare in range(0, 2 * low + 2):
        parts = need + spare
        empty = parts * min(1.0, 3 * exp(-2 * low / (3 * parts)))
        room = (spare - empty) / sqrt(empty + 1e-3)  # in standard deviations
        best = max(best, (room, spare), key=lambda x: x[0])
        if room >= 4:
            break
    return differ, need + best[1], best[1]


def smallest_pairs(scrambled: np.ndarray, offsets: np.ndarray, rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for every two of the smallest hashes of each of the rows: linked sets of three shingles or more share two of these."""
    keys, owners = [], []
    for row in rows.tolist():
        own = np.sort(scrambled[offsets[row] : offsets[row + 1]])
        own = own[: len(own) - -(-percent * len(own) // 100) + 2]
        a, b = np.triu_indices(len(own), 1)
        keys.append(octets.mix(own[a] ^ octets.mix(own[b] + np.uint64(1))))
        owners.append(np.full(len(a), row))
    return (np.concatenate(keys), np.concatenate(owners)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def part_keys(value: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every set and the row of each: equal keys, two equal thirds of a part (of sets that may be linked).

    Odd keys stand for less than ``STRONG`` shingles.
    """
    sizes = np.diff(offsets)
    if not len(value):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bounds = size_classes(percent, int(sizes.max()) + 1)
    cls = np.searchsorted(bounds, sizes, side="right") - 1
    scrambled = octets.mix(value ^ np.uint64(0x1F2E3D4C5B6A7988))
    place = octets.mix(value ^ np.uint64(0x77A1C3E592B4D6F8))
    high, third = place >> np.uint64(32), ((place & np.uint64(0xFFFFFFFF)) * np.uint64(3) >> np.uint64(32)).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    keys, owners = [], []
    for step in (0, 1):  # as the larger of a pair, and as the smaller one of the next class
        group = cls + step
        some = np.flatnonzero(sizes > 0)
        parts, spare, skip = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), np.ones(len(sizes), bool)
        for g in np.unique(group[some]):
            low = int(bounds[max(g - 1, 0)])
            top = int(bounds[g + 1]) if g + 1 < len(bounds) else int(bounds[g]) * 100 // percent + 1
            differ, p, s = parts_for(percent, low, top)
            here = group == g
            parts[here], spare[here], skip[here] = p, s, differ == 0
        use = ~skip & (sizes > 0)
        parts = np.where(use, parts, 0)
        first = np.cumsum(parts) - parts
        mine = use[rows]
        of = rows[mine]
        part = (high[mine] * parts[of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        slot = 3 * (first[of] + part) + third[mine]
        total = int(parts.sum())
        sums = np.zeros(3 * total, np.uint64)
        np.add.at(sums, slot, scrambled[mine])
        sums = sums.reshape(total, 3)
        filled = np.bincount(slot, minlength=3 * total).reshape(total, 3)
        owner = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(total) - first[owner]
        bare = np.zeros(total, bool)
        for left_out in range(3):
            many = filled[:, (left_out + 1) % 3] + filled[:, (left_out + 2) % 3]
            full = many > 0
            bare |= ~full
            tag = octets.mix((group[owner].astype(np.uint64) << np.uint64(40)) + (4 * number + left_out + 1).astype(np.uint64))
            kept = sums[:, (left_out + 1) % 3] + sums[:, (left_out + 2) % 3]
            keys.append((octets.mix(kept + tag) & ~np.uint64(1) | (many < STRONG).astype(np.uint64))[full])
            owners.append(owner[full])
        thin = np.flatnonzero(use & (np.bincount(owner[bare], minlength=len(sizes)) > spare))
        key, of = smallest_pairs(scrambled, offsets, thin, percent)
        keys.append(octets.mix(key + octets.mix(group[of].astype(np.uint64) << np.uint64(40))) | np.uint64(1))
        owners.append(of)
    return np.concatenate(keys), np.concatenate(owners)


def stars(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the smallest node of each, and distinct edges (node, smallest node) as pairs."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    head = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))] if len(key) else node
    pairs = np.stack([node, head], axis=1)[node != head]
    pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
    return key[first], node[first], pairs


def _packed_owners(owner: np.ndarray) -> bytes:
    """Owners of consecutive keys: number of runs, their nodes and lengths; as they are after a 0 where that is shorter."""
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    if 12 * len(first) >= 8 * len(owner):
        return np.int64(0).tobytes() + owner.tobytes()
    return np.int64(len(first)).tobytes() + owner[first].tobytes() + np.diff(np.append(first, len(owner))).astype(np.uint32).tobytes()


def _owners(data: bytes) -> np.ndarray:
    runs = int(np.frombuffer(data, np.int64, 1)[0])
    if not runs:
        return np.frombuffer(data, np.int64, offset=8)
    return np.repeat(np.frombuffer(data, np.int64, runs, 8), np.frombuffer(data, np.uint32, runs, 8 + 8 * runs))


def _describe(width: int):
    """A row a document: doc_id, text_key, number of shingles, counts by bucket and set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in octets.chunks(whole, "text", DESCRIBE_BYTES):
                value, at = _sets(batch, width)
                node = fingerprints(value, at)[:, 0].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(at), pa.int64()), pa.array(fine_histograms(value, at), pa.binary()), pa.array(node, pa.int64())],
                    ["doc_id", "text_key", "n", "counts", "node"],
                )

    return run


DESCRIBED = "doc_id long, text_key long, n long, counts binary, node long"


def _keys(width: int, percent: int, parts: int):
    """Rows of two kinds: keys of one part of the shuffle with their sets, and, without ``owners``, edges found in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in octets.chunks(whole, "text", DESCRIBE_BYTES):
                value, at = _sets(batch, width)
                sizes = np.diff(at)
                node = fingerprints(value, at)[:, 0].view(np.int64)
                _, once = np.unique(node, return_index=True)
                once = np.sort(once[sizes[once] > 0])
                pick = np.zeros(len(sizes), bool)
                pick[once] = True
                keep = np.repeat(pick, sizes)
                some = np.concatenate([[0], np.cumsum(sizes[once])]).astype(np.int64)
                key, owner = part_keys(value[keep], some, percent)
                owner = node[once][owner]
                weak = key % np.uint64(2) == 1
                few, of_few = key[weak], owner[weak]
                key, owner, pairs = stars(key[~weak], owner[~weak])
                key, owner = np.concatenate([key, few]), np.concatenate([owner, of_few])
                part = ((key >> np.uint64(1)) % np.uint64(parts)).astype(np.int64)
                # keys of one set together: its number is then written once
                order = np.lexsort((owner, part))
                key, owner, part = key[order], owner[order], part[order]
                used = np.flatnonzero(np.bincount(part, minlength=parts)) if len(part) else np.zeros(0, np.int64)
                cut = np.searchsorted(part, [*used, parts])
                packed = [key[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                owners = [_packed_owners(owner[a:b]) for a, b in zip(cut, cut[1:])]
                edges = [pairs.tobytes()] if len(pairs) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*used.tolist(), *[int(p[0]) % parts for p in pairs[:1]]], pa.int64()),
                        pa.array([*packed, *edges], pa.binary()),
                        pa.array([*owners, *[None] * len(edges)], pa.binary()),
                    ],
                    ["number", "data", "owners"],
                )

    return run


KEYS = "number long, data binary, owners binary"


def _agreements(pairs: np.ndarray, weak: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64()), pa.array([weak] * len(pairs), pa.bool_())], ["a", "b", "weak"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between sets that share a strong key, and (set, key) where sets share a weak one; all rows of a key are in this task.

    Edges that a batch of texts has found pass unchanged.
    """
    keys, nodes = [], []
    for batch in batches:
        for data, owners in zip(batch.column("data"), batch.column("owners")):
            if owners.is_valid:
                keys.append(np.frombuffer(data.as_buffer(), np.uint64))
                nodes.append(_owners(owners.as_buffer()))
            else:
                yield _agreements(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, 2), False)
    if keys:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        del keys, nodes
        weak = key % np.uint64(2) == 1
        pairs = stars(key[~weak], node[~weak])[2]
        key, node = key[weak], node[weak]
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        same = key[1:] == key[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(key) else np.zeros(0, bool)
        members = np.stack([node[shared], key[shared].view(np.int64)], axis=1)
        yield _agreements(pairs, False)
        yield _agreements(members, True)


def _weak_edges(percent: int):
    """Edges between sets of one weak key whose counts by bucket differ as little as those of linked sets.

    With a column ``side`` only sets of unlike sides are compared: two blocks of one key.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("key")
        key, node, root, n = (table.column(c).to_numpy() for c in ("key", "node", "root", "n"))
        side = table.column("side").to_numpy() if "side" in table.column_names else None
        fine = [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]
        counts = np.array([folded(x, BUCKETS) for x in fine], np.int16).reshape(-1, BUCKETS)
        large = np.array([len(x) > BUCKETS for x in fine], bool)

        def near(i, j) -> np.ndarray:
            """Whether sets i and j may be linked."""
            may, same = (n[i] + n[j]) * (100 - percent), root[i] == root[j]
            ok = np.abs(counts[i] - counts[j]).sum(axis=1, dtype=np.int64) * (100 + percent) <= may
            for k in np.flatnonzero(ok & ~same & large[i] & large[j]):
                a, b = fine[i[k]], fine[j[k]]
                buckets = min(len(a), len(b))
                ok[k] = np.abs(folded(a, buckets) - folded(b, buckets)).sum() * (100 + percent) <= may[k]
            return ok | same

        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
        two = cuts[:-1][np.diff(cuts) == 2]
        two = two if side is None else two[side[two] != side[two + 1]]
        two = two[near(two, two + 1)]
        found = [np.stack([node[two], node[two + 1]], axis=1)]
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 3:
                continue
            rest, open_ = np.arange(a, b), []
            while len(rest):
                at = open_.pop() if open_ else None
                if at is None:
                    at, rest = rest[0], rest[1:]
                others = np.arange(len(rest)) if side is None else np.flatnonzero(side[rest] != side[at])
                hit = np.zeros(len(rest), bool)
                hit[others] = near(np.full(len(others), at), rest[others])
                found.append(np.stack([np.full(hit.sum(), node[at]), node[rest[hit]]], axis=1))
                open_ += rest[hit].tolist()
                rest = rest[~hit]
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return run


def weak_links(members: DataFrame, strong: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges of weak agreements. ``members``: (node, key); ``strong``: components (node, root); ``sets``: node, n, counts."""
    rooted = members.join(strong, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = store(rooted, "weak-members")
    open_keys = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    rows = store(rooted.join(open_keys, "key", "left_semi"), "weak-open")
    blocks = F.ceil(F.col("many") / WEAK_BLOCK).cast("int").alias("blocks")
    large = store(rows.groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > WEAK_BLOCK).select("key", blocks), "weak-large")
    small = rows.join(large, "key", "left_anti")
    bins = max(1, ceil(small.count() / WEAK_ROWS))
    dealt = small.join(sets, "node").select(F.pmod(F.xxhash64("key"), F.lit(bins)).alias("bin"), "key", "node", "root", "n", "counts")
    links = dealt.groupBy("bin").applyInArrow(_weak_edges(percent), LINK)
    if large.isEmpty():
        return links
    # every block of a large key is compared in itself and with each of the others
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    own = store(rows.join(large, "key").select("key", "node", "root", "blocks", block).join(sets, "node"), "weak-blocks")
    fields = ["key", "node", "root", "n", "counts"]
    within = own.select(*fields, "block").groupBy("key", "block").applyInArrow(_weak_edges(percent), LINK)
    pairs = own.select(*fields, "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).filter("other <> block")
    pairs = pairs.select(*fields, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    across = pairs.groupBy("key", "low", "high").applyInArrow(_weak_edges(percent), LINK)
    return links.unionByName(within).unionByName(across)


# --- step 2: regions ------------------------------------------------------------------------


class Cell:
    """Sets of one cell, or of two blocks of one, and the links found among them."""

    def __init__(self, value: np.ndarray, offsets: np.ndarray, percent: int):
        self.ids = np.unique(value, return_inverse=True)[1] if len(value) else np.zeros(0, np.int64)
        self.offsets, self.sizes, self.percent = offsets, np.diff(offsets), percent
        self.reach = 1 - percent / 100
        self.mark = np.zeros(int(self.ids.max()) + 1 if len(self.ids) else 0, np.int32)
        self.parent = np.arange(len(self.sizes))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self, rows: np.ndarray) -> np.ndarray:
        found = self.parent[rows]
        while True:
            up = self.parent[found]
            if (up == found).all():
                return found
            found = up

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))

    def distances(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        """Distances of rows to a pivot; rows within the threshold are linked with it."""
        own = self.ids[self.offsets[pivot] : self.offsets[pivot + 1]]
        self.mark[own] = 1
        size = self.sizes[rows]
        first = np.cumsum(size) - size
        at = np.repeat(self.offsets[rows] - first, size) + np.arange(size.sum())
        common = np.add.reduceat(self.mark[self.ids[at]], first)
        self.mark[own] = 0
        union = size + self.sizes[pivot] - common
        for k in np.flatnonzero(100 * common >= self.percent * union):
            self.join(int(rows[k]), pivot)
        return 1 - common / union

    def connect(self, rows: np.ndarray, depth: int = 0) -> None:
        """Find links until every linked pair of rows is connected."""
        if len(rows) <= LEAF:
            self.scan(rows, rows)
            return
        pivots = rows[:: len(rows) // PIVOTS][:PIVOTS]
        d = np.stack([self.distances(int(p), rows) for p in pivots], axis=1)
        if self.connected(rows):
            return
        inside = d <= d.min(axis=1)[:, None] + 2 * self.reach + 1e-9
        for j in range(len(pivots)):
            region = rows[inside[:, j]]
            if self.connected(region):
                continue
            if len(region) > 0.7 * len(rows) or depth > 40:
                # the pivots do not tell these apart
                self.scan(region, region)
            else:
                self.connect(region, depth + 1)

    def connected(self, rows: np.ndarray) -> bool:
        roots = self.roots(rows)
        return len(rows) < 2 or bool((roots == roots[0]).all())

    def scan(self, pivots: np.ndarray, rows: np.ndarray) -> None:
        """Compare pivots (a part of rows) with the rows that sizes and the triangle inequality leave.

        Where all rows are pivots, those that are connected with the class that is largest at the start are left out: of a
        link between two classes, one end is outside of it and finds the other. Where some rows are no pivots, nothing is left
        out: the other end may be among these.
        """
        anchor = -1
        if len(pivots) == len(rows):
            kinds, many = np.unique(self.roots(rows), return_counts=True)
            anchor = int(kinds[many.argmax()]) if many.max() > 1 else -1
        marks = np.zeros((0, len(rows)))
        place = np.searchsorted(rows, pivots)
        for p, at in zip(pivots.tolist(), place.tolist()):
            if anchor >= 0 and self.root(p) == self.root(anchor):
                continue
            size = self.sizes[rows]
            near = (self.roots(rows) != self.root(p)) & (100 * np.minimum(size, self.sizes[p]) >= self.percent * np.maximum(size, self.sizes[p]))
            if len(marks) < 4 and len(rows) > LEAF:
                marks = np.vstack([marks, self.distances(p, rows)])
                continue
            for d in marks:
                near &= np.abs(d - d[at]) <= self.reach + 1e-9
            if near.any():
                self.distances(p, rows[near])


def _sets(batch: pa.Table | pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    return shingles(*octets.octets(batch.column("text")), width)


def _join_cells(width: int, percent: int):
    """Links within a group of whole cells (role 0), of pivots with a block (1), or of a block of outsiders with a block (2)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role, names, node, root = (table.column(c).to_numpy() for c in ("role", "cell", "node", "root"))
        order = np.lexsort((node, role, names))
        table = table.take(pa.array(order))
        role, names, node = role[order], names[order], node[order]
        known = np.unique(root, return_inverse=True)[1][order] if len(root) and role.max() == 2 else np.full(len(role), -1)
        value, offsets = _sets(table, width)
        found: list[np.ndarray] = []
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            cell = Cell(value[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], percent)
            for root in np.unique(known[a:b][known[a:b] >= 0]):  # what an earlier round has connected
                rows = np.flatnonzero(known[a:b] == root)
                cell.parent[rows] = rows[0]
            guests = np.flatnonzero(role[a:b] > 0)
            if len(guests):
                cell.scan(guests, np.arange(b - a))
            else:
                cell.connect(np.arange(b - a))
            if cell.links:
                found.append(node[a:b][np.array(cell.links)])
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))


def described(docs: DataFrame, width: int) -> DataFrame:
    """Stored rows of ``_describe``."""
    return store(_texts(docs).mapInArrow(_describe(width), DESCRIBED), "shingles")


def agreements(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Stored rows of ``_meet``. The keys are about as large as the texts: they go from the batches straight through the shuffle and are written nowhere else."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = _texts(docs).select("text").mapInArrow(_keys(width, percent, 4 * parts), KEYS)
    return store(keys.repartition(parts, "number").drop("number").mapInArrow(_meet, f"{LINK}, weak boolean"), "met")


def _join(rows: DataFrame, by: list[str], width: int, percent: int) -> DataFrame:
    return rows.groupBy(*by).applyInArrow(_join_cells(width, percent), LINK)


def cell_links(members: DataFrame, width: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links that connect all linked sets of every cell. ``members``: stored rows of cell, node, n (shingles) and text."""
    sizes = members.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    sizes = store(sizes, "cell-sizes")
    total = sizes.agg(F.sum(F.when(F.col("blocks") == 1, F.col("n"))).alias("small"), F.count_if(F.col("blocks") > 1).alias("large")).first()
    placed = members.join(sizes.drop("n"), "cell")
    none = F.lit(0).cast("long").alias("root")
    bins = max(1, ceil(2 * (total.small or 0) / block))
    small = placed.filter("blocks = 1").select(F.pmod(F.xxhash64("cell"), F.lit(bins)).alias("bin"), "cell", "node", F.lit(0).alias("role"), none, "text")
    links = _join(small, ["bin"], width, percent)
    if not total.large:
        return links
    large = store(placed.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "large-cells")
    first = Window.partitionBy("cell").orderBy(F.xxhash64("node", F.lit(1)), "node")
    pivots = large.select("cell", "node", "blocks").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= FIRST_PIVOTS).drop("r")
    pivots = large.join(pivots.select("cell", "node"), ["cell", "node"], "left_semi")
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    guests = pivots.select("cell", "node", F.lit(1).alias("role"), none, "text", everywhere)
    links = store(links.unionByName(_join(large.select("cell", "node", F.lit(0).alias("role"), none, "text", "block").unionByName(guests), ["cell", "block"], width, percent)), "links")

    # whatever is not connected with its cell's largest class is compared with the whole cell, block by block
    roots = components(links)
    named = store(large.select("cell", "node", "n", "blocks").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "large-roots")
    classes = named.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("many"))
    main = classes.groupBy("cell").agg(F.max_by("root", F.struct("many", "root")).alias("main"))
    outside = named.join(main, "cell").filter("root <> main")
    wide = store(outside.groupBy("cell").agg(F.ceil(F.sum("n") / block).cast("int").alias("others")), "outsiders")
    outside = outside.join(wide, "cell").select("cell", "node", F.pmod(F.xxhash64("node", F.lit(2)), F.col("others")).cast("int").alias("other"))
    with_root = large.join(named.select("cell", "node", "root"), ["cell", "node"]).join(wide, "cell")
    hosts = with_root.select("cell", "node", F.lit(0).alias("role"), "root", "text", "block", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other"))
    guests = with_root.join(outside, ["cell", "node"]).select("cell", "node", F.lit(2).alias("role"), "root", "text", everywhere, "other")
    return links.unionByName(_join(hosts.unionByName(guests), ["cell", "block", "other"], width, percent))


def classes(docs: DataFrame, width: int = 3, percent: int = 90, block: int = BLOCK) -> DataFrame:
    """doc_id, text_key, n_shingles and root (a number of the class; null without shingles) of every document."""
    rows = described(docs, width)
    sets = rows.drop("counts")
    met = agreements(docs, width, percent)
    known = met.filter("NOT weak").drop("weak")
    counted = rows.filter("n > 0").groupBy("node").agg(F.max("n").alias("n"), F.max("counts").alias("counts"))
    members = met.filter("weak").select(F.col("a").alias("node"), F.col("b").alias("key"))
    cells = store(components(known.unionByName(weak_links(members, components(known), counted, percent))), "cells")

    one = sets.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("one"), F.max("n").alias("n"))
    members = one.join(cells, "node").select(F.col("root").alias("cell"), "node", "n", *row_key(F.col("one.doc_id"), F.col("one.text_key")))
    texts = docs.select(*row_key(F.col("doc_id"), text_key(F.col("text"))), F.col("text").cast("string").alias("text"))
    members = texts.join(members, KEY).dropDuplicates(KEY).select("cell", "node", "n", "text")
    roots = components(cell_links(store(members, "cell-texts"), width, percent, block))
    out = sets.join(roots, "node", "left")
    return store(out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("root")), "classes")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, 90 percent."""
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    least = found.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return found.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The row with the smallest doc_id of every class, and all rows without words; all columns kept."""
    found = classes(docs, width, percent)
    first = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("k")).select("k.*")
    keep = first.unionByName(found.filter("root IS NULL").select("doc_id", "text_key"))
    return rows_of(docs, keep.select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text")))
