"""Near-duplicate join and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from upswell.llm import jaccard_join, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, node string, n long"


def frame(spark, rows):
    """Documents with two more columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)


# --- near duplicates ------------------------------------------------------------------------


def shingle_set(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(rows, width, percent):
    sets = [shingle_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def near_rows(seed=3, vocabulary=400):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocabulary)}"
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, "one two"), (906, "ONE\ttwo"), (907, "naïve café x y z")]
    doc = 0
    for size in (4, 8, 12, 20, 40, 90, 200):
        for _ in range(5):
            base = [word() for _ in range(size)]
            for changes in (0, 0, 1, 1, 2, max(1, size // 60), max(1, size // 40)):
                own = list(base)
                for _ in range(changes):
                    own[rnd.randrange(size)] = word()
                rows.append((doc, " ".join(own)))
                doc += 1
    chain = [word() for _ in range(120)]
    for k in range(30):  # each is near to the next one only
        chain = chain[:k] + [f"c{k}"] + chain[k + 1 :]
        rows.append((doc, " ".join(chain)))
        doc += 1
    rows.append((doc, "long " * 3 + " ".join(str(i % 5000) for i in range(20000))))
    return rows


def classes_of(spark, rows, width, percent, **more):
    found = jaccard_join.classes(frame(spark, rows), width, percent, **more).collect()
    least = {}
    for r in found:
        if r.root is not None:
            least[r.root] = min(least.get(r.root, r.doc_id), r.doc_id)
    return sorted((r.doc_id, r.n_shingles, least.get(r.root, r.doc_id)) for r in found)


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_classes_are_those_of_all_pairs(spark, width, percent):
    rows = near_rows()
    assert classes_of(spark, rows, width, percent) == sorted(components(rows, width, percent))


def test_cells_of_many_blocks(spark):
    """A block of few shingles: every cell is joined by pivots and outsiders, block by block."""
    rows = [r for r in near_rows(5, 60) if r[0] < 220 or r[0] >= 900]
    assert classes_of(spark, rows, 3, 90, block=150) == sorted(components(rows, 3, 90))


@pytest.mark.parametrize("guests", [range(4, 10), range(4, 5)])
def test_guests_are_compared_with_rows_that_are_no_pivots(guests):
    """Hosts of the main class 0 to 3, a connected larger class 4 to 9 of guests; 4 is near to 3."""
    sets = [[*range(20), 100 + i] for i in range(4)] + [[*range(20), 104]] + [[*range(50, 70), 200 + i] for i in range(5)]
    value, offsets = np.array([v for x in sets for v in x], np.uint64), np.arange(11) * 21
    cell = jaccard_join.Cell(value, offsets, 90)
    cell.parent[:4], cell.parent[4:] = 0, 4
    cell.scan(np.array(guests), np.arange(10))
    assert cell.root(9) == cell.root(0)


def test_repeated_rows_and_an_empty_table(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, None), (3, None)]
    assert classes_of(spark, rows, 3, 90) == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (3, 0, 3)]
    assert jaccard_join.classes(frame(spark, [])).count() == 0


def test_one_of_each_keeps_columns(spark):
    rows = near_rows(8)
    kept = jaccard_join.one_of_each(frame(spark, rows), 5, 80)
    assert kept.columns == ["doc_id", "text", "node", "n"]
    expected = {c for _, n, c in components(rows, 5, 80) if n} | {d for d, n, _ in components(rows, 5, 80) if not n}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_large_sets_by_finer_counts():
    """Unlike sets of 5000 shingles that share a weak key are kept apart, linked ones joined, also where their bucket numbers differ."""
    rng = np.random.default_rng(4)
    base = rng.integers(1, 2**63, 8200).astype(np.uint64)
    sets = [base, base[:8190], np.append(base[:7900], base[:90] + np.uint64(1)), rng.integers(1, 2**63, 8000).astype(np.uint64), rng.integers(1, 2**63, 8195).astype(np.uint64)]
    counts = jaccard_join.fine_histograms(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    assert len(counts[0]) == 2 * len(counts[1]) and (jaccard_join.folded(np.frombuffer(counts[0], np.uint8), len(counts[1])).sum() == 8200)
    rows = pa.table({"key": [1] * 5, "node": range(5), "root": range(5), "n": [len(x) for x in sets], "counts": counts})
    found = jaccard_join._weak_edges(80)(rows)
    assert {x for p in zip(*found.to_pydict().values()) for x in p} == {0, 1, 2} and found.num_rows >= 2


def test_keys_are_written_by_the_shuffle_only(spark, monkeypatch):
    """Nothing as large as the texts is stored before the cells, and no shuffle file outlives the write it served."""
    rnd, names = random.Random(6), []
    rows = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(400))) for i in range(120)]
    stored = jaccard_join.store

    def watched(df, name):
        out = stored(df, name)
        names.append((name, sum(os.path.getsize(f[len("file:") :].replace("//", "")) for f in out.inputFiles())))
        return out

    monkeypatch.setattr(jaccard_join, "store", watched)
    folders = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for _, _, fs in os.walk(d) for f in fs if f.endswith(".data")}
    before = files()
    jaccard_join.agreements(frame(spark, rows), 5, 80)
    jaccard_join.described(frame(spark, rows), 5)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert {n for n, _ in names} == {"met", "shingles"} and sum(n for _, n in names) < sum(len(t) for _, t in rows) / 5


def test_pairs_within_the_difference_share_a_key():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 9, 15, 30, 77, 300):
        for percent in (80, 90):
            for _ in range(20):
                a = rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64) * np.uint64(2)
                gone = int(rng.integers(0, size + 1))
                b = np.concatenate([a[gone:], rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.int64).astype(np.uint64)])
                common, union = len(set(a) & set(b)), len(set(a) | set(b))
                if not len(b) or set(a) == set(b) or 100 * common < percent * union:
                    continue
                values = np.concatenate([np.unique(a), np.unique(b)])
                keys, owner = jaccard_join.part_keys(values, np.array([0, len(set(a)), len(values)]), percent)
                assert set(keys[owner == 0]) & set(keys[owner == 1]), (size, percent, len(b))


@pytest.mark.parametrize("percent", [80, 90])
def test_weak_agreements_keep_linked_pairs_connected(percent):
    """Groups of two, of many and of few sets under one key: linked pairs end up in one class, sets far apart do not."""
    rng = np.random.default_rng(4)
    sets, keys = [], []
    for key, many in enumerate((2, 2, 12, 40)):
        base = set(rng.integers(0, 2**63, 200).tolist())
        for i in range(many):
            own = list(base)[int(rng.integers(0, 30)) :] if i % 3 else rng.integers(0, 2**63, 200).tolist()
            sets.append(sorted(set(own) | set(rng.integers(0, 2**63, 4).tolist())))
            keys.append(key)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    counts = jaccard_join.histograms(np.array([v for x in sets for v in x], np.uint64), offsets)
    nodes = np.arange(len(sets))
    rows = pa.table({"key": keys, "node": nodes, "root": nodes, "n": [len(x) for x in sets], "counts": jaccard_join.as_bytes(counts)})
    found = jaccard_join._weak_edges(percent)(rows.take(pa.array(rng.permutation(len(sets)))))
    group = list(nodes)
    for a, b in zip(found["a"].to_pylist(), found["b"].to_pylist()):
        group = [group[a] if g == group[b] else g for g in group]
    for i in nodes:
        for j in nodes[:i]:
            common = len(set(sets[i]) & set(sets[j]))
            if keys[i] == keys[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                assert group[i] == group[j]
            if keys[i] != keys[j]:
                assert group[i] != group[j]
    assert len(set(group)) > 10


def test_a_weak_key_of_many_sets_is_dealt_out(spark, monkeypatch):
    """No task sees more than two blocks of a key's sets, and linked pairs are connected as in one task."""
    rng = np.random.default_rng(9)
    bases = [rng.integers(0, 2**63, 100).tolist() for _ in range(200)]
    sets = [sorted(set(b[:98] + rng.integers(0, 2**63, 2).tolist())) for b in bases for _ in range(2)]
    counts = jaccard_join.as_bytes(jaccard_join.histograms(np.array([v for x in sets for v in x], np.uint64), np.arange(401) * 100))
    members = spark.createDataFrame([(i, 7) for i in range(400)], "node long, key long")
    described = spark.createDataFrame([(i, 100, bytearray(c)) for i, c in enumerate(counts)], "node long, n long, counts binary")
    strong = spark.createDataFrame([], "node long, root long")
    edges = jaccard_join._weak_edges

    def watched(percent):
        run = edges(percent)

        def watch(table):
            assert table.num_rows <= 150, f"{table.num_rows} sets of one key in a task"
            return run(table)

        return watch

    monkeypatch.setattr(jaccard_join, "WEAK_BLOCK", 50, raising=False)
    monkeypatch.setattr(jaccard_join, "_weak_edges", watched)
    pairs = {(min(r.a, r.b), max(r.a, r.b)) for r in jaccard_join.weak_links(members, strong, described, 90).collect() if r.a != r.b}
    assert pairs == {(2 * i, 2 * i + 1) for i in range(200)}


# --- repeated passages ----------------------------------------------------------------------


def brute(rows, width):
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            w = data[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(w)
        left = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def passage_rows(seed, alphabet="abcdefgh ", docs=60):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    shared = [text(n) for n in (99, 100, 101, 130, 170, 260, 900)]
    rows = []
    for doc in range(docs):
        parts = []
        for _ in range(rnd.randrange(5)):
            parts.append(text(rnd.choice((0, 1, 5, 80, 300))))
            passage = rnd.choice(shared)
            cut = rnd.randrange(40) if rnd.random() < 0.5 else 0
            parts.append(passage[cut : len(passage) - rnd.randrange(30)] if rnd.random() < 0.5 else passage)
        rows.append((doc, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * 99), (103, "a" * 700), (104, "ab" * 300), (105, "éü" * 200), (106, rows[7][1]), (107, rows[9][1])]
    rows.append((108, text(60_000) + shared[6] + text(10) + shared[6][50:400]))
    return rows


def removed(spark, rows, **more):
    out = repeats.without_repeats(frame(spark, rows), **more).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("hot", [0, 2, 2000])
def test_removal_is_that_of_all_windows(spark, hot):
    """Also where every anchor, or those of three different contexts, count as hot."""
    rows = passage_rows(hot)
    assert removed(spark, rows, hot=hot) == brute(rows, 100)


def test_a_small_width(spark):
    rows = passage_rows(11, "ab", 25)[:33]
    assert removed(spark, rows, width=12) == sorted(brute(rows, 12))


def test_rows_with_one_id_and_an_empty_table(spark):
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdefgh") for _ in range(300))
    got = removed(spark, [(1, text), (1, text), (None, text)][:2])
    assert sorted(r[2] for r in got) == [0, 300]
    assert removed(spark, []) == []
    first = {r.doc_id: r.n_removed for r in repeats.without_repeats(frame(spark, [(1, text), (None, text)])).collect()}
    assert first == {None: 0, 1: 300}


def test_kept_bytes(spark):
    rows = passage_rows(4)
    for r in repeats.without_repeats(frame(spark, rows), with_text=True).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed


@pytest.mark.parametrize("hot", [0, 2000])
def test_groups_hold_every_occurrence(spark, hot):
    """Each window that repeats, also within copies of a document, has a group with all its places and nothing else."""
    rows = [r for r in passage_rows(7, docs=20) if r[0] != 108]
    rows += [(200 + i, rows[3][1] + rows[4][1]) for i in range(5)]
    texts = {d: (t or "").encode() for d, t in rows}
    places = {}
    for d, data in texts.items():
        for p in range(len(data) - 99):
            places.setdefault(data[p : p + 100], set()).add((d, p))
    found = {}
    for r in repeats.Repeats(repeats.numbered(frame(spark, rows)), hot=hot).groups().collect():
        found.setdefault((r.repeat, r.length), []).append((r.doc, r.start))
    whole = set()
    for (_, length), own in found.items():
        assert len(own) == len(set(own)) > 1 and len({texts[d][p : p + length] for d, p in own}) == 1
        whole |= {frozenset((d, p + k) for d, p in own) for k in range(length - 99)}
    again = [x for x in places.values() if len(x) > 1]
    lost = sum(frozenset(x) not in whole for x in again)
    assert again and lost == 0, f"{lost} of {len(again)} windows"


def test_suffix_array_and_intervals():
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 60))) for _ in range(12)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    sa, common = repeats.suffixes(data, offsets, np.arange(len(data)))
    rest = [texts[r][i - offsets[r] :] for i in sa for r in [int(np.searchsorted(offsets, i, side="right")) - 1]]
    assert rest == sorted(rest)
    for i in range(1, len(rest)):
        a, b = rest[i - 1], rest[i]
        k = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
        assert common[i] == k
    row = np.searchsorted(offsets, sa, side="right") - 1
    before = np.where(sa > offsets[:-1][row], data[np.maximum(sa - 1, 0)].astype(np.int64), -1)
    got = {(rest[a][:d], b - a + 1) for a, b, d in repeats.intervals(common, before, 4)}
    expected = set()
    for word in {r[:n] for r in rest for n in range(4, len(r) + 1)}:
        places = [(t, i) for t in range(len(texts)) for i in range(len(texts[t])) if texts[t].startswith(word, i)]
        if len(places) < 2:
            continue
        left = [texts[t][i - 1] if i else (t, "start") for t, i in places]
        right = [texts[t][i + len(word)] if i + len(word) < len(texts[t]) else (t, "end") for t, i in places]
        if len(set(left)) > 1 and len(set(right)) > 1:
            expected.add((word, len(places)))
    assert got == expected


def test_spans_of_a_deep_tree_grow_with_the_windows():
    """Copies that each agree with the one before a little longer: the tree is one long path, the spans are one a window."""
    rnd = random.Random(8)
    whole = bytes(rnd.randrange(97, 123) for _ in range(700))
    texts = [whole[: 60 + 2 * i] + b"#%d" % i for i in range(300)]
    n = [len(t) - 20 + 1 for t in texts]
    table = pa.table({"uid": list(range(300)), "doc": list(range(300)), "anchor": [1] * 300, "ctx": list(range(300)), "start": [0] * 300, "n": n, "data": pa.array(texts, pa.binary())})
    spans = repeats.repeat_spans(table, 20).to_pylist()
    assert len(spans) <= sum(n)
    covered = [set() for _ in texts]
    for s in spans:
        covered[s["uid"]] |= set(range(s["start"], s["stop"]))
    for i in range(1, 300):
        assert covered[i] == set(range(60 + 2 * (i - 1)))
    assert not covered[0]
