"""Cross-tokenizer alignment against a plain merge of token ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from upswell.llm import alignment as A
from upswell.llm import packing
from upswell.llm.common import store

TEXTS = [
    None, "", " ", "a", "Hello, world!", "hello <|endoftext|> world <s> </s> <0x41>", "under_score ▁ mark", "ﬁne ① ２ ½", "日本語のテキスト と English", "😀😀 👩‍👩‍👧 x",
    "tabs\tand\n\n\nlines   \r\n end ", "=" * 3000, " " * 500 + "x", "naïve café Ångström ﷺ", "а б в кириллица " * 20, "\x00 zero", "1234567890" * 40, "é combining",
]


def texts(seed=2):
    rnd = random.Random(seed)
    words = "the of and unbelievably 1984 über-cool été http://x.y/z?a=b {code} \t \n don't we'll ??? 中文 tokenization".split(" ")
    return TEXTS + [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60))) for _ in range(150)]


def ends(parts):
    return np.cumsum([len(p) for p in parts]).tolist()


@pytest.fixture(scope="module")
def sides():
    a_path, b_path = A.default_tokenizers()
    tokenizer, model = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    tokenizer.encode_special_tokens = True
    chars = packing.byte_characters()

    def encode(text):
        if not text:
            return [], [], [], []
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        a_bytes = [bytes(chars[c] for c in tokenizer.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(model.id_to_piece, b)]
        whole = (" " + text).encode()
        return (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == whole == b"".join(b_bytes) else ([], [], [], [])

    return encode


def groups_of(encoded):
    a, b, a_bytes, b_bytes = encoded
    a_ends, b_ends = ends(a_bytes), ends(b_bytes)
    both = sorted(set(a_ends) & set(b_ends))
    out, i, j = [], 0, 0
    for cut in both:
        x, y = a_ends.index(cut) + 1, b_ends.index(cut) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def expected(rows, encode):
    groups = [groups_of(encode(t)) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, _), g, c in zip(rows, groups, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append(
            (
                doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == most[p[0]]),
                sum(n * count[p] for p, n in c.items()), hashlib.sha256(written.encode()).hexdigest() if g else "",
            )
        )
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_the_query(spark, sides, tmp_path):
    rows = [*enumerate(texts()), (5, "Hello, world!"), (5, "Hello, world!"), (None, "of the"), (7, "long " * 30_000 + "x" * 5000)]
    frame = spark.createDataFrame([(d, t, 1, "u", 2) for d, t in rows], "doc_id long, text string, uid int, pairs string, n int").repartition(4)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = A.op11(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ordered(tuple(r) for r in got.collect()) == ordered(expected(rows, sides))


@pytest.mark.parametrize("heavy", [1, 40, 400])
def test_rare_pairs_are_joined(spark, sides, heavy):
    rows = list(enumerate(texts(8)))
    aligned = store(A.align(spark.createDataFrame(rows, "doc_id long, text string")), "aligned")
    scores = {r.uid: (r.n_best, r.count_sum) for r in A.score_links(aligned, store(A.pair_counts(aligned), "counts"), heavy).collect()}
    got = {r.doc_id: scores[r.uid] for r in aligned.select("doc_id", "uid").collect()}
    assert got == {r[0]: r[5:7] for r in expected(rows, sides)}


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert A.op11(spark, str(tmp_path)).count() == 0


def test_cuts_of_random_ends():
    rnd = random.Random(1)
    for density in (0.02, 0.3, 0.9):
        docs = []
        for _ in range(60):
            n = rnd.randrange(0, 80)
            a = sorted({*(i for i in range(1, n) if rnd.random() < 0.5), n} - {0})
            b = sorted({*(i for i in range(1, n) if rnd.random() < density), n} - {0})
            docs.append((a, b))
        base, a_all, b_all, want_a, want_b, a_first, b_first = 0, [], [], [], [], [0], [0]
        for a, b in docs:
            for e in sorted(set(a) & set(b)):
                want_a.append(len(a_all) + a.index(e) + 1)
                want_b.append(len(b_all) + b.index(e) + 1)
            a_all += [base + e for e in a]
            b_all += [base + e for e in b]
            base += max(a, default=0)
            a_first.append(len(a_all))
            b_first.append(len(b_all))
        got = A.common_cuts(*map(np.array, (a_all, b_all, a_first, b_first)))
        assert got[0].tolist() == want_a and got[1].tolist() == want_b


def test_ids_are_those_of_the_tokenizer():
    """The fast way gives the ids of a plain call, special tokens included or not."""
    path = packing.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    for special in (True, False):
        tokenizer.encode_special_tokens = not special
        encode = packing.Encoder(path, special)
        for text in texts(3)[1:] + ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "x" * 20_000, " \n" * 4000]:
            assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
