"""Periodic runs against a plain scan of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from upswell.llm import periodic_runs as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """Every run as (start, length, period)."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def thue_morse(n):
    return ["ab"[bin(i).count("1") % 2] for i in range(n)]


def samples():
    rnd = random.Random(11)
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 700, fibonacci(900), thue_morse(700), (["a"] * 60 + ["b"]) * 7]
    root = ["a", "b"] * 20 + ["a"]
    out += [root * 2, root * 3 + ["c"], (["a", "b", "c"] * 30 + ["a"]) * 2 + ["a", "b"] * 50, (["a"] * 90 + ["b"] * 90) * 4]
    for _ in range(120):
        k = rnd.choice([1, 2, 2, 3, 50])
        words = []
        while len(words) < rnd.randrange(20, 600):
            part = [rnd.choice("abcdefghijklmnopqrstuvwxyz"[: min(k, 26)]) + (str(rnd.randrange(9)) if k > 26 else "") for _ in range(rnd.randrange(1, 90))]
            n = int(len(part) * rnd.choice([0.7, 1, 2, 2.3, 3, 5]))
            words += (part * 6)[:n]
        out.append(words)
    for _ in range(60):  # words of words, for runs inside runs
        words = [rnd.choice("ab") for _ in range(rnd.randrange(2, 9))]
        for _ in range(rnd.randrange(2, 6)):
            words = words * rnd.randrange(1, 4) + words[: rnd.randrange(len(words))]
        out.append(words[:900])
    return out


@pytest.mark.parametrize("at_once", [1, 1000])
def test_all_runs_and_no_other(at_once):
    words = [[w.encode() for w in d] for d in samples()]
    got = [r for i in range(0, len(words), at_once) for r in P.runs_of(words[i : i + at_once])]
    assert len(got) == len(words)
    for d, runs in zip(words, got):
        assert [tuple(r) for r in runs.tolist()] == brute(d)


@pytest.mark.parametrize("least", [2, 40])
def test_another_least_length(least):
    for d in samples()[:80]:
        words = [w.encode() for w in d]
        assert [tuple(r) for r in P.runs_of([words], least)[0].tolist()] == brute(words, least)


def test_wrong_hashes_change_nothing(monkeypatch):
    """Hashes of four bits: seeds and reaches are often wrong, runs never."""
    real = P.octets.Stretches.__call__
    monkeypatch.setattr(P.octets.Stretches, "__call__", lambda self, a, b: np.where((b - a) % 7 < 6, real(self, a, b), real(self, a, b) & np.uint64(7)))
    for d in samples()[5:60]:
        words = [w.encode() for w in d]
        got, want = [tuple(r) for r in P.runs_of([words])[0].tolist()], brute(words)
        assert set(got) <= set(want)


def test_highly_periodic_documents_stay_cheap():
    words = [b"a"] * 200_000
    assert P.runs_of([words])[0].tolist() == [[0, 200_000, 1]]
    words = ([b"a"] * 5000 + [b"b"]) * 30
    runs = P.runs_of([words])[0].tolist()
    assert [0, len(words), 5001] in runs and len(runs) == 31


def expected(doc, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def test_the_query_and_its_cases(spark):
    rows = [(i, " ".join(d)) for i, d in enumerate(samples()[:90])]
    rnd = random.Random(5)
    rows += [(1000 + i, " ".join(rnd.choice("the of and to in is été straße".split()) for _ in range(rnd.randrange(200)))) for i in range(120)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n\x0b\x0c\r "), (2003, "a b " * 40), (2004, "x y\x85 " * 30), (2000, None), (17, rows[17][1])]
    frame = spark.createDataFrame([(d, t, 1, "z", 2) for d, t in rows], "doc_id long, text string, runs int, n_words string, collapsed int").repartition(3)
    got = P.summary(P.detect(frame, words=P.planted_words)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted((expected(d, t) for d, t in rows), key=key)


def test_collapsed_text_and_null_id(spark):
    frame = spark.createDataFrame([(None, "so " * 15 + "it goes"), (3, "one two")], "doc_id long, text string")
    got = {r.doc_id: r for r in P.detect(frame).collect()}
    assert got[None].collapsed == "so it goes" and [tuple(r) for r in got[None].runs] == [(0, 15, 1)]
    assert got[3].collapsed == "one two" and got[3].runs == [] and got[3].n_words == 2
    assert P.detect(frame.limit(0)).count() == 0
