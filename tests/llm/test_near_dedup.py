"""Near-duplicate groups against all pairs."""

import random

import numpy as np
import pytest

from tagwave.llm import near_dedup as ND
from tagwave.llm.components import components


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(rows)), key=str)


def family(rng, first_id, size, words, edits):
    """A text and copies of it with a few words replaced, one at a time, so
    that similarities run from above the threshold to below it."""
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    rows = [(first_id, " ".join(base))]
    for k in range(1, size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
        rows.append((first_id + k, " ".join(copy)))
    return rows


@pytest.mark.parametrize("n", [4, 5])
def test_equal_to_all_pairs(make_docs, odd_rows, n):
    rng = random.Random(n)
    rows = list(odd_rows)
    for k in range(4):
        rows += family(rng, 1000 * (k + 1), 40, (30, 80, 150, 300)[k], (1, 4, 8, 16)[k])
    shared = " ".join(f"s{k}" for k in range(60))  # a passage that many documents share
    rows += [(9000 + k, shared + " " + " ".join(f"u{k}x{j}" for j in range(k % 60))) for k in range(80)]
    got = ND.near_groups(make_docs(rows), shingle=n).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, n)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chain_in_one_bucket_is_followed(make_docs):
    """Neighbours are similar, ends are not: no single centre links them all."""
    words = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(words[2 * k:2 * k + 60])) for k in range(30)]
    got = ND.near_groups(make_docs(rows), shingle=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 4)
    assert {r.component_id for r in got} == {0}


def test_estimates_do_not_hide_counted_links(spark):
    """A pair too long to be counted whole, with a high estimate and a low true
    similarity, stands beside a true link to the same component."""
    rng = np.random.default_rng(4)
    pool = np.unique(rng.integers(0, 2**64, 9000, dtype=np.uint64))
    rng.shuffle(pool)
    text, fresh = pool[:2400], pool[2400:]
    sets = {1: text,
            2: np.concatenate([text[:2191], fresh[:409]]),       # 2,600; 2191 / 2809 = 0.78
            3: np.concatenate([text[:2148], fresh[500:752]])}    # 2,400; 2148 / 2652 = 0.81
    marks = {1: bytes(200), 2: bytes(166) + b"\1" * 34, 3: bytes(162) + b"\1" * 38}
    rows = [(r, len(x), marks[r], np.sort(x).tobytes()) for r, x in sets.items()]
    held = spark.createDataFrame(rows, "rep long, n long, sketch binary, members binary")
    buckets = spark.createDataFrame([(7, r, 2, 3) for r in sets], "key long, rep long, centre long, size long")
    labels = ND.dimension(spark.createDataFrame([(2, 2), (3, 2)], "node long, root long"))
    across = ND._across(buckets, held, ND.dimension(held.select("rep", "n")), labels, 80)
    assert [(r.a, r.b) for r in ND._confirmed(across, held, 80).collect()] == [(1, 3)]


def test_hashes_that_share_half_their_bits_hide_no_link(spark):
    """Member 2 shares the low halves of nearly all hashes with document 1, but
    few hashes; member 3 of the same component is the true link."""
    base = np.arange(1, 1001, dtype=np.uint64) << np.uint64(33)
    low = base + np.arange(1, 1001, dtype=np.uint64)
    sets = {1: low, 2: np.concatenate([low[:800], low[800:] + (np.uint64(1) << np.uint64(62))]),
            3: np.concatenate([low[:900], np.arange(5, 105, dtype=np.uint64) << np.uint64(50)])}
    held = spark.createDataFrame([(r, len(x), np.sort(x).tobytes()) for r, x in sets.items()],
                                 "rep long, n long, members binary")
    buckets = spark.createDataFrame([(7, r, 2, 3) for r in sets], "key long, rep long, centre long, size long")
    labels = ND.dimension(spark.createDataFrame([(2, 2), (3, 2)], "node long, root long"))
    across = ND._across(buckets, held, ND.dimension(held.select("rep", "n")), labels, 80)
    assert [(r.a, r.b) for r in across.collect()] == [(1, 3)]


def test_hot_bucket_of_long_copies_lists_no_pairs(spark, monkeypatch):
    """Long sets of one bucket that no star links: a link per document and
    component at most, whatever the number of blocks, and the same components."""
    monkeypatch.setattr(ND, "BLOCK_SET", 100)
    monkeypatch.setattr(ND, "BLOCK", 40)
    rng = np.random.default_rng(3)
    core = np.unique(rng.integers(0, 2**64, 950, dtype=np.uint64))
    sets = {k: np.sort(np.unique(np.concatenate([core, rng.integers(0, 2**64, 20 + 20 * (k % 6), dtype=np.uint64)])))
            for k in range(60)}
    held = spark.createDataFrame([(r, len(x), x.tobytes()) for r, x in sets.items()], "rep long, n long, members binary")
    buckets = spark.createDataFrame([(7, r, 0, 60) for r in sets], "key long, rep long, centre long, size long")
    labels = ND.dimension(spark.createDataFrame([(r, r // 20) for r in range(60)], "node long, root long"))
    across = ND._across(buckets, held, ND.dimension(held.select("rep", "n")), labels, 80)
    got = {(r.a, r.b) for r in across.collect()}
    blocks = -(-60 * 11 // 40)
    assert 0 < len(got) <= 40 * 2 * blocks < 60 * 59 // 2 * 2
    like = {(a, b) for a in sets for b in sets if a < b and a // 20 != b // 20
            and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert got <= like and {(a // 20, b // 20) for a, b in got} == {(a // 20, b // 20) for a, b in like}


def test_family_on_both_sides_of_the_block_set(make_docs, monkeypatch):
    monkeypatch.setattr(ND, "BLOCK_SET", 60)
    rng = random.Random(8)
    rows = []
    for k, words in enumerate((60, 64, 68, 140)):
        rows += family(rng, 1000 * (k + 1), 30, words, 8)
        rows += [(r[0] + 500, r[1] + "".join(f" t{j}" for j in range(r[0] % 9))) for r in rows[-30:]]
    got = ND.near_groups(make_docs(rows), shingle=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 4)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    orders = ND.probe_orders(200)
    pool = np.unique(rng.integers(0, 2**64, 1200, dtype=np.uint64))
    for size in (10, 100, 1000):
        a, b = np.sort(pool[:size]), np.sort(pool[size // 9:size + size // 9])
        same = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = ND.signatures([a, b], 200, orders)
        assert abs((sig[0] == sig[1]).mean() - same) < 4 * (same * (1 - same) / min(size, 200)) ** 0.5 + 0.02
    single = ND.signatures([pool[:1]], 200, orders)
    assert (single == pool[0]).all()  # every empty bin finds the filled one


def test_dropping_keeps_one_row_each(make_docs, odd_rows):
    docs = make_docs([*odd_rows, (5, "another text under a used id"), (70, "another text under a used id")])
    out = ND.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    ids = sorted((str(r.doc_id) for r in out.collect()))
    assert ids == sorted(map(str, [1, 2, 3, None, 5, 5, 6, 8, 9, 10, 11]))
    assert ND.drop_near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    pairs = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
