"""Language identification: held-out accuracy and the kernel itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwave.llm import language_id as LI
from tagwave.llm.common import read_table

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    docs = read_table(spark, SMALL, "documents")
    return LI.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()


def test_held_out_accuracy(predicted):
    held = [r for r in predicted if r.held_out]
    assert len(predicted) == 1000 and 200 < len(held) < 300
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in predicted)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = read_table(spark, SMALL, "documents")
    held = LI.crc_mod("doc_id", 4) == 2
    spoiled = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a = {r.doc_id: r.lang_pred for r in LI.languages(docs).collect()}
    b = {r.doc_id: r.lang_pred for r in LI.languages(spoiled).collect()}
    assert a == b


def test_odd_rows(make_docs, odd_rows):
    rows = [(*r, "aa" if k % 2 else None) for k, r in enumerate(odd_rows)] + [
        (100 + k, "le chat est sur la table", "fr") for k in range(8)] + [
        (200 + k, "the cat sits on the table", "en") for k in range(8)]
    got = {(r.doc_id, r.lang_pred) for r in LI.languages(make_docs(rows).withColumn("score", F.lit(1))).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (11, "und"), (100, "fr"), (200, "en")} <= got
    assert LI.languages(make_docs(rows).limit(0)).count() == 0


def test_nothing_to_learn_from(make_docs):
    got = LI.languages(make_docs([(1, "some text", None), (3, None, "en")])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


FR, EN = "le chat est sur la table", "the cat sits on the table"


def sampled(docs, per_language):
    got = LI.labelled_sample(docs, F.lit(True), per_language).collect()
    return {lang: sorted(r.text for r in got if r.lang == lang) for lang in {r.lang for r in got}}


@pytest.mark.parametrize("doc_id", [7, None])
def test_sample_of_repeated_ids(make_docs, doc_id):
    """One id (or none) 5,000 times: equal rows count once, different texts are
    bounded in rows, and either way the language is learned."""
    same = make_docs([(doc_id, FR, "fr")] * 5000 + [(doc_id, EN, "en")] * 3)
    assert sampled(same, 40) == {"fr": [FR], "en": [EN]}
    assert {r.lang_pred for r in LI.languages(same, F.lit(False)).collect()} == {"fr", "en"}
    different = sampled(make_docs([(doc_id, f"{FR} {k}", "fr") for k in range(5000)] + [(1, EN, "en")]), 40)
    assert len(different["fr"]) == len(set(different["fr"])) == 40 and different["en"] == [EN]


def test_sample_is_the_smallest_hashes(make_docs):
    docs = make_docs([(k % 50, f"{FR} {k}", "fr") for k in range(2000)])
    marks = docs.select("text", F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(3)), 1).alias("m"))
    assert sampled(docs, 30)["fr"] == sorted(r.text for r in marks.orderBy("m").limit(30).collect())


def test_letters_counted_in_tasks(make_docs):
    texts = [FR, EN, "ÄÖ ß 日本", ""]
    docs = make_docs([(k, t, "x") for k, t in enumerate(texts)])
    assert LI._letters_of(docs) == LI.letter_counts(texts)


def test_null_ids_only(make_docs):
    rows = [(None, f"{t} {k}", lang) for k in range(300) for t, lang in ((FR, "fr"), (EN, "en"))]
    got = LI.languages(make_docs(rows)).collect()
    assert len(got) == 600 and {r.held_out for r in got} == {False} and {r.lang_pred for r in got} == {"fr", "en"}


def test_prediction_equals_kernel_formula():
    """The collapsed product is the kernel against every landmark, weighted."""
    sample = [("a", "abab abba baab"), ("b", "cdcd dccd ddcc"), ("a", "aabb abab"), ("b", "ccdd cdcd")]
    alphabet = LI.learn_alphabet(LI.letter_counts([t for _, t in sample]))
    presence = LI.Presence(alphabet)
    model = LI.fit(alphabet, [(lang, presence(t)) for lang, t in sample], landmarks=2, ridge=0.01)

    def kernel(x, y):
        return len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y))

    grams = [presence(t) for _, t in sample]
    k = np.array([[kernel(x, y) for y in grams] for x in grams])
    y = np.array([[1, -1], [-1, 1], [1, -1], [-1, 1]], float)
    beta = np.linalg.solve(k.T @ k + 0.01 * 4 * k + 4e-9 * np.eye(4), k.T @ y)
    for text in ("abba", "cdc abab", "dd"):
        x = presence(text)
        values = np.array([kernel(x, g) for g in grams]) @ beta
        (lang, score), = model.predict([text])
        assert lang == "ab"[values.argmax()] and abs(score - np.clip((values.max() + 1) / 2, 0, 1)) < 1e-5


def test_presence_counts_every_gram_once():
    alphabet = LI.learn_alphabet(LI.letter_counts(["abc"]))
    grams = {("", *s)[-n:] if False else s for n in (1, 2, 3) for s in
             ["_ab!! ab_".replace("!! ", "_")[i:i + n] for i in range(len("_ab_ab_") - n + 1)]}
    assert len(LI.Presence(alphabet)("AB!! ab")) == len(grams)
    assert len(LI.Presence(alphabet)("!!! 12")) == 0
