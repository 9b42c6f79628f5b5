"""Mixing: targets against repeated resharing, permutations, draws, and the
whole mix against a plain loop over word lists."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tagwave.llm import mixing as M
from tagwave.llm.catalog import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA).repartition(3)


def plain_targets(sizes, weights, cap=3):
    """Shares, cut and reshared until none is above."""
    total = sum(sizes)
    share = [Fraction(total * w, sum(weights)) for w in weights]
    while True:
        excess = sum(max(t - cap * s, 0) for t, s in zip(share, sizes))
        if not excess:
            return share
        share = [min(t, Fraction(cap * s)) for t, s in zip(share, sizes)]
        below = [i for i, s in enumerate(sizes) if share[i] < cap * s]
        for i in below:
            share[i] += excess * Fraction(weights[i], sum(weights[j] for j in below))


def test_targets_equal_resharing():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 5, 100, 3000]) * rng.randint(0, 9) for _ in range(rng.randint(1, 9))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        got = M.targets(sizes, weights)
        # resharing in steps tends to the same shares; all below reach a common unit
        assert sum(got) == sum(sizes) and all(t <= 3 * s for t, s in zip(got, sizes))
        units = {t / w for t, w, s in zip(got, weights, sizes) if t < 3 * s}
        assert len(units) <= 1
        if units:
            assert all(3 * s <= units_ * w for units_ in units for t, w, s in zip(got, weights, sizes) if t == 3 * s)
        assert [round(float(t), 6) for t in plain_targets(sizes, weights)] == [round(float(t), 6) for t in got]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_and_inverse(n):
    p = M.Permutation(n, f"k{n}")
    x = np.arange(n)
    y = p(x)
    assert sorted(y.tolist()) == x.tolist()
    assert (p(y, back=True) == x).all()
    if n > 100:
        assert (y != x).mean() > 0.9 and (M.Permutation(n, "other")(x) != y).mean() > 0.9


def test_draws_meet_totals_and_vary():
    mix = M.Mix(shard=50)
    totals = [5000, 1203, 0, 77]
    draws = M.Draws(totals, mix)
    whole = list(draws.between(0, draws.shards))
    assert [s for s, _, _ in whole] == list(range(126))
    assert (sum(c for _, c, _ in whole) == totals).all()
    assert all(c.sum() == 50 for _, c, _ in whole[:-1])
    seen = np.zeros(4, dtype=int)
    for _, counts, start in whole:
        assert (start == seen).all()
        seen += counts
    # any task finds the same draws
    part = list(draws.between(40, 71))
    assert all((a[1] == b[1]).all() and (a[2] == b[2]).all() for a, b in zip(whole[40:71], part, strict=True))
    spread = np.array([c[0] for _, c, _ in whole[:-1]])
    p = 5000 / 6280  # close to a multinomial's spread
    assert 0.6 < spread.std() / (50 * p * (1 - p)) ** 0.5 < 1.4 and abs(spread.mean() - 50 * p) < 1.5


def test_large_mixes_are_dealt_in_parts(monkeypatch):
    monkeypatch.setattr(M, "PART_SLOTS", 1000)
    draws = M.Draws([5000, 1203, 0, 77], M.Mix(shard=50))
    whole = list(draws.between(0, draws.shards))
    assert len(draws.slots) == 7 and (sum(c for _, c, _ in whole) == [5000, 1203, 0, 77]).all()
    assert all((b[2] == a[2] + a[1]).all() for a, b in zip(whole, whole[1:]))


def corpus(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "B", "é", "tiny", None, ""])
        words = rng.choice([0, 1, 3, 20, 90]) if source != "tiny" else 1
        rows.append((i, rng.choice([" ", "\n\t"]).join(f"w{i}x{j}" for j in range(words)), source))
    return rows


def plain_mix(rows, mixture):
    """Words taken per document: every slot reads its block of the source's
    whole word list."""
    order = sorted({s for _, _, s in rows if s is not None}) + [None]
    words = {s: [] for s in order}
    for i, t, s in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words[s] += [i] * len((t or "").split())
    taken, per_source, slots = Counter(), Counter(), mixture.slots().collect()
    for r in slots:
        name, n = mixture.sources[r.no].name, mixture.mix.block
        part = words[name][r.block * n:(r.block + 1) * n][:r.take]
        assert len(part) == r.take > 0
        taken.update(part)
        per_source[name] += len(part)
    assert len({(r.shard, r.slot) for r in slots}) == len(slots)
    assert all(v <= 1 for v in Counter((r.no, r.epoch, r.block) for r in slots).values())
    return taken, per_source


@pytest.mark.parametrize("block, shard", [(16, 8), (1, 4), (7, 1000), (100_000, 5)])
def test_whole_mix_equals_plain_loop(spark, block, shard):
    rows = corpus(block)
    mixture = M.Mixture(frame(spark, rows), M.Mix(block=block, shard=shard))
    taken, per_source = plain_mix(rows, mixture)
    got = mixture.document_counts().collect()
    sizes = {i: len(t.split()) for i, t, _ in rows}
    by_source = Counter()
    for i, _, s in rows:
        by_source[s] += sizes[i]
    assert {r.doc_id: r["size"] for r in got} == sizes
    assert {r.doc_id: r.taken for r in got} == {i: taken[i] for i in sizes}
    assert all(r.taken <= 3 * r["size"] for r in got)
    where = {i: s for i, _, s in rows}
    goal = {}
    for r in got:
        assert r.source_size == by_source[where[r.doc_id]]
        goal[where[r.doc_id]] = r.target
    order = sorted(s for s in by_source if s is not None) + [None]
    want = plain_targets([by_source[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))])
    for s, t in zip(order, want):
        assert abs(goal[s] - float(t)) < 1e-6 and abs(per_source[s] - t) <= Fraction(1, 2)


def test_reruns_agree(spark):
    rows = corpus(5)
    first = {(r.doc_id, r.taken) for r in M.mix_counts(frame(spark, rows), M.Mix(block=8, shard=16)).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        again = M.mix_counts(frame(spark, rows[::-1]).repartition(11), M.Mix(block=8, shard=16)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {(r.doc_id, r.taken) for r in again} == first
    other = M.mix_counts(frame(spark, rows), M.Mix(block=8, shard=16, seed=12)).collect()
    assert {(r.doc_id, r.taken) for r in other} != first


def test_texts_hold_the_drawn_words(spark):
    rows = corpus(9)
    mixture = M.Mixture(frame(spark, rows), M.Mix(block=16, shard=8), texts=True)
    out = mixture.slot_texts().collect()
    taken, per_source = plain_mix(rows, mixture)
    got, by_source = Counter(), Counter()
    for r in out:
        words = r.text.split(" ")
        assert len(words) == r.n_words <= 16
        got.update(int(w[1:].split("x")[0]) for w in words)
        by_source[r.source] += len(words)
    assert got == taken and by_source == per_source


def test_odd_rows(spark, odd_rows):
    rows = [(i, t, None if k % 4 == 0 else "s" if k % 4 == 1 else "") for k, (i, t) in enumerate(odd_rows)]
    docs = frame(spark, rows).selectExpr("*", "1 as size", "2 as no", "'x' as target", "0 as block")
    got = M.mix_counts(docs, M.Mix(block=5, shard=3)).collect()
    assert sorted((repr(r.doc_id), r["size"]) for r in got) == sorted(
        (repr(i), len((t or "").encode().split())) for i, t, _ in rows)
    assert sum(r.taken for r in got) == sum(r["size"] for r in got)
    assert all(r.taken <= 3 * r["size"] for r in got)


def test_empty_and_wordless(spark):
    assert M.mix_counts(frame(spark, [])).collect() == []
    got = M.mix_counts(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_too_many_sources_is_an_error(spark):
    with pytest.raises(ValueError):
        M.mix_counts(frame(spark, [(i, "a", f"s{i}") for i in range(4)]), M.Mix(max_sources=3))


def test_query_meets_targets(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op11_mixing"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").toPandas()
    docs["n"] = [len((t or "").encode().split()) for t in docs.text]
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs) == len(got) and (both["size"] == both.n).all()
    per = both.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"))
    assert (abs(per.taken - per.target) <= 0.5).all() and (both.taken <= 3 * both["size"]).all()
    order = sorted(per.index)
    want = plain_targets([int(per["size"][s]) for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))])
    assert all(abs(per.target[s] - float(t)) < 1e-6 for s, t in zip(order, want))
