"""Quality scores: the identity, the gradient, held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwave.llm import quality as Q
from tagwave.llm.common import read_table

MID = "/root/testdata/sf0.1"


def batch(texts):
    return Q.Features()(texts, [len(t) for t in texts])


def small_model(texts, seed=0):
    rng = np.random.default_rng(seed)
    n = Q.BUCKETS + Q.STATISTICS
    stats = batch(texts)[3]
    return Q.FactorisationMachine(0.1, rng.normal(0, 0.3, n), rng.normal(0, 0.3, (n, Q.FACTORS)),
                                  stats.mean(axis=0), stats.std(axis=0) + 1e-6)


def test_sum_of_squares_identity():
    texts = ["some words here", "other words, more!", "", "a a a"]
    fm = small_model(texts)
    row, index, value = fm.entries(*batch(texts))
    logit, _, _ = fm.forward(row, index, value, len(texts))
    for k in range(len(texts)):
        i, x = index[row == k], value[row == k]
        pairs = sum(fm.factors[i[a]] @ fm.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert logit[k] == pytest.approx(fm.bias + fm.linear[i] @ x + pairs)


def test_a_text_scores_alike_alone_and_in_a_batch():
    texts = ["some words here", "", "x " * 1000, "ÄÖ"]
    fm = small_model(texts)
    together = fm.score(*batch(texts))
    assert together == pytest.approx([fm.score(*batch([t]))[0] for t in texts])


def test_held_out_accuracy(spark):
    docs, labels = (read_table(spark, MID, t) for t in ("documents", "labels"))
    rows = Q.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) > 50
    assert sum(r.predicted for r in good) / len(good) > 0.995
    assert sum(r.predicted for r in bad) / len(bad) < 0.05


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    held = Q.crc_mod("doc_id", 5) == 0
    spoiled = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in Q.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in Q.quality_scores(docs.withColumn("lang", F.lit("x")), spoiled).collect()}
    assert a == pytest.approx(b)


def test_sample_is_bounded(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    assert Q.labelled_features(docs, labels, F.lit(True), sample=60).num_rows == 60


def test_sample_of_repeated_ids(spark, make_docs):
    """An id 5,000 times, in documents and in labels, is one row of the sample."""
    texts = [f"some words {k}" for k in range(5000)]
    docs = make_docs([(7, t) for t in texts] + [(7, "equal text")] * 100 + [(8, "other words!"), (None, "no id")])
    labels = spark.createDataFrame([(7, 0)] * 5000 + [(7, 1), (8, 0), (9, 1), (None, 1)], "doc_id long, quality int")
    assert sorted((r.doc_id, r.quality) for r in Q.labelled_ids(labels, F.lit(True), 50).collect()) == [(7, 1), (8, 0), (9, 1)]
    got = Q.labelled_features(docs, labels, F.lit(True), sample=50)
    assert sorted(got.column("quality").to_pylist()) == [0, 1]
    # the features are those of the row of smallest hash
    first = docs.where("doc_id = 7").orderBy(F.xxhash64("text", "n_chars")).first()
    _, bucket, value, stats = Q.Features()([first.text], [first.n_chars])
    row = next(r for r in got.to_pylist() if r["quality"] == 1)
    assert row["buckets"] == bucket.tolist() and row["vals"] == pytest.approx(value) and row["stats"] == pytest.approx(stats[0])
    scores = Q.quality_scores(docs, labels, F.lit(False)).collect()
    assert len(scores) == 5102 and len({r.score for r in scores}) > 1


def test_null_ids_only(spark, make_docs):
    docs = make_docs([(None, f"text {k}") for k in range(50)])
    labels = spark.createDataFrame([(None, k % 2) for k in range(50)], "doc_id long, quality int")
    assert [r.score for r in Q.quality_scores(docs, labels).collect()] == [0.5] * 50


def test_features_of_a_batch_equal_those_of_each_text(spark, make_docs):
    texts = ["some words here here", "", "x " * 1000, "ÄÖ ü", "| a | b |\n| a | b |"]
    docs = make_docs(list(enumerate(texts))).coalesce(1)
    labels = spark.createDataFrame([(k, k) for k in range(len(texts))], "doc_id long, quality int")
    rows = {r["quality"]: r for r in Q.labelled_features(docs, labels, F.lit(True)).to_pylist()}
    for k, t in enumerate(texts):
        _, bucket, value, stats = Q.Features()([t], [len(t)])
        assert rows[k]["buckets"] == bucket.tolist()
        assert rows[k]["vals"] == pytest.approx(value) and rows[k]["stats"] == pytest.approx(stats[0])


def test_odd_rows(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([(i, 1 if i % 2 else 0, 0) for i, _ in odd_rows if i] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = make_docs(odd_rows).withColumn("score", F.lit(3)).withColumn("quality", F.lit("clash"))
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    kept = Q.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.predicted)
    assert [r.score for r in Q.quality_scores(docs, labels.limit(0)).collect()] == [0.5] * len(odd_rows)
    assert Q.quality_scores(docs.limit(0), labels).count() == 0
    assert Q.quality_scores(docs.drop("n_chars"), labels).count() == len(odd_rows)
