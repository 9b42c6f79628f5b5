"""Kneser-Ney scores against the formula computed from dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwave.llm import lm_scoring as LM
from tagwave.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Plain:
    def __init__(self, rows):
        docs = [["<s>", *LM.words_of(t or ""), None] for i, t in rows if not held(i)]
        self.c = Counter(w for d in docs for w in d[1:])
        self.b = Counter(p for d in docs for p in zip(d, d[1:]))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.before = Counter(w for _, w in self.b)
        self.total, self.kinds = Counter(), defaultdict(lambda: [0, 0, 0])
        for (v, _), x in self.b.items():
            self.total[v] += x
            self.kinds[v][min(x, 3) - 1] += 1
        self.d2, self.d1 = (LM.discounts(*(sum(x == k for x in t.values()) for k in (1, 2, 3, 4)))
                            for t in (self.b, self.before))
        self.t = sum(self.before.values())
        self.mass = sum(self.d1[min(x, 3) - 1] for x in self.before.values()) / self.t if self.t else 1.0

    def p(self, v, w):
        x = self.before.get(w, 0)
        low = (x - self.d1[min(x, 3) - 1] if x else 0) / max(1, self.t) + self.mass / (self.v + 1)
        if not self.total.get(v):
            return low
        x = self.b.get((v, w), 0)
        left = sum(d * k for d, k in zip(self.d2, self.kinds[v])) / self.total[v]
        return (x - self.d2[min(x, 3) - 1] if x else 0) / self.total[v] + left * low

    def row(self, i, t):
        d = ["<s>", *LM.words_of(t or ""), None]
        return (i, held(i), len(d) - 1, sum(w in self.c for w in d[1:]), self.n,
                sum(math.log10((self.c.get(w, 0) + 1) / (self.n + self.v + 1)) for w in d[1:]),
                sum(math.log10(self.p(v, w)) for v, w in zip(d, d[1:])))


def same(got, rows):
    model = Plain(rows)
    want = sorted((model.row(i, t) for i, t in rows), key=lambda r: str(r[:5]))
    got = sorted(map(tuple, got), key=lambda r: str(r[:5]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_documents(spark):
    docs = read_table(spark, SMALL, "documents")
    same(LM.lm_scores(docs).collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows_and_small_blocks(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(LM, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(LM, "BLOCK_WORDS", 20)
    monkeypatch.setattr(LM, "_CHUNK", 200)
    monkeypatch.setattr(LM, "FILE_TOKENS", 1000)
    rows = odd_rows + [(20 + k, f"a b c d {k % 5} e a b") for k in range(30)]
    docs = make_docs(rows).withColumn("score", F.lit("clash")).withColumn("shard", F.lit(1))
    same(LM.lm_scores(docs).collect(), rows)


def test_no_training_rows(make_docs):
    i = next(k for k in range(100) if held(k))
    rows = [(i, "only a held-out row"), (i, None)]
    same(LM.lm_scores(make_docs(rows)).collect(), rows)
    assert LM.lm_scores(make_docs(rows).limit(0)).count() == 0


def test_probabilities_sum_to_one(make_docs):
    rows = [(k, f"x y {'z' * (k % 4 + 1)} y x") for k in range(40)]
    model = Plain(rows)
    for v in ["<s>", b"x", b"y", b"unseen"]:
        seen = sum(model.p(v, w) for w in model.c)
        assert seen + model.p(v, b"never") == pytest.approx(1.0)


def test_held_out_texts_gain_over_word_frequencies(spark):
    got = [r for r in LM.lm_scores(read_table(spark, "/root/testdata/sf0.01", "documents")).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)  # both negative


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        counts = rng.integers(1, 2**40, len(keys), dtype=np.uint64)
        k, c = LM.unpack_block(LM.pack_block(keys, counts))
        assert (k == keys).all() and (c == counts).all()
    x = rng.integers(0, 2**64, 1000, dtype=np.uint64)
    assert (LM._unmix(LM.splitmix(x)) == x).all()
