"""Containment search against every pair."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tagwave.llm import decontamination as DC


def shingles(text, n=5):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items):
    out = set()
    for d, t in docs:
        have = shingles(t)
        for i, x in items:
            want = shingles(x)
            if want and 100 * len(want & have) >= 80 * len(want):
                out.add((d, i, len(want), len(want & have)))
    return out


@pytest.fixture
def cases(spark, make_docs, odd_rows):
    rng = random.Random(3)
    items = [(k, " ".join(f"q{rng.randrange(300)}" for _ in range(rng.choice([3, 5, 6, 9, 17, 40, 90])))) for k in range(40)]
    items += [(90, None), (91, ""), (None, "an item whose id is null and words"), (5, items[5][1])]
    docs = list(odd_rows)
    for k in range(150):
        words = [f"q{rng.randrange(300)}" for _ in range(rng.randrange(400))]
        passage = rng.choice(items)[1] or ""
        part = passage.split()[:rng.choice([1000, 1000, 30, 14, 6])]
        at = rng.randrange(len(words) + 1)
        docs.append((1000 + k, " ".join(words[:at] + ["Said:"] + [w.upper() + "," for w in part] + words[at:])))
    docs += [(5000 + k, f"Very common line {k}. " + items[7][1]) for k in range(60)]
    return docs, items, make_docs(docs), spark.createDataFrame(items, "item_id long, text string")


def test_equal_to_all_pairs(cases):
    docs, items, d, b = cases
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in DC.contaminated(d, b).collect()}
    assert got == brute(docs, items) and len(got) > 60


def test_without_broadcast(spark, cases):
    docs, items, d, b = cases
    spark.conf.set("spark.tagwave.maxBroadcastRows", "0")
    try:
        got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in DC.contaminated(d, b).collect()}
    finally:
        spark.conf.unset("spark.tagwave.maxBroadcastRows")
    assert got == brute(docs, items)


def test_sketches_cannot_all_be_missed(cases):
    _, _, _, b = cases
    for r in DC.item_sketches(b, 5, 80).collect():
        assert len(r.sketch) == min(r.n, int((2 ** (r.size_class + 1) - 1) * 0.2) + 1) > r.n * 0.2 - 1e-9 or len(r.sketch) == r.n


def test_items_without_a_shingle_are_reported(cases):
    _, items, _, b = cases
    got = DC.unsearched_items(b).collect()
    want = [(i, len((t or "").split())) for i, t in items if len((t or "").split()) < 5]
    assert sorted((r.item_id, r.n_words) for r in got) == sorted(want)
    assert {90, 91} < {i for i, _ in want} and any(n == 3 for _, n in want)
    assert not {r.item_id for r in got} & {r.item_id for r in DC.item_sketches(b, 5, 80).collect() if r.n > 0}


def test_dropping(cases):
    docs, items, d, b = cases
    out = DC.drop_contaminated(d.withColumn("item_id", F.lit("clash")), b)
    bad = {i for i, *_ in brute(docs, items)}
    assert out.columns == [*d.columns, "item_id"]
    assert sorted((str(r.doc_id) for r in out.collect())) == sorted(str(i) for i, _ in docs if i not in bad)
    assert DC.drop_contaminated(d.limit(0), b).count() == 0
    assert DC.drop_contaminated(d, b.limit(0)).count() == len(docs)


def test_main_path_is_native(cases):
    _, _, d, b = cases
    assert "Python" not in DC.contaminated(d, b)._jdf.queryExecution().toString()
