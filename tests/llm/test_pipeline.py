"""Pipeline stages, each against a brute-force version on its own input, and
the registered queries."""

import re
from functools import partial

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as CP
from compare import duck, duck_digest, spark_digest
from tagwave.llm import near_dedup, packing, quality
from tagwave.llm.quality import drop_low_quality, quality_scores
from tagwave.operators.stage import stage
from tagwave.session import BATCH_BYTES, text_batches

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


def words(text):
    return (text or "").encode().lower().split()


def grams(w, n=5):
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before each stage, and the last result."""
    out = [spark.read.parquet(f"{MID}/documents.parquet")]
    for name, step in CP.STAGES:
        out.append(stage(step(spark, out[-1], MID), name))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert before.columns == after.columns and after.schema == before.schema


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    want = sorted(r.doc_id for r in quality_scores(stages[0], labels).where("predicted = 1").collect())
    assert ids(stages[1]) == want == ids(drop_low_quality(stages[0], labels))


def test_exact_stage(stages):
    groups = {}
    for i, t in texts(stages[1]).items():
        groups.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""), []).append(i)
    assert ids(stages[2]) == sorted(max(g) for g in groups.values())


def test_near_stage(stages):
    docs = {i: grams(words(t)) for i, t in texts(stages[2]).items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i in sorted(docs):
        shared = {}
        for g in docs[i]:
            for j in holders.get(g, ()):
                shared[j] = shared.get(j, 0) + 1
            holders.setdefault(g, []).append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(docs[i]) + len(docs[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert ids(stages[3]) == sorted(i for i in docs if find(i) == i)


def test_decontamination_stage(spark, stages):
    plain = partial(re.split, r"[\W_]+")
    items = [grams([w for w in plain(r.text.lower()) if w])
             for r in spark.read.parquet(f"{MID}/benchmark.parquet").collect()]
    keep = []
    for i, t in texts(stages[3]).items():
        have = grams([w for w in plain((t or "").lower()) if w])
        if not any(100 * len(x & have) >= 80 * len(x) for x in items):
            keep.append(i)
    assert ids(stages[4]) == sorted(keep)


def test_packing_stage(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(ids(stages[4]))
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert sum(r.length for r in rows) == sum(tokens.values())


def test_odd_rows(spark, make_docs, odd_rows):
    """Null ids and texts, repeated rows, a long text and columns that clash with
    names used inside: every stage keeps whole rows and all columns."""
    docs = make_docs(odd_rows)
    for name in ("text_key", "score", "kept", "rid", "quality", "item_id"):
        docs = docs.withColumn(name, F.lit("clash"))
    for name, step in CP.STAGES[:-1]:
        before = docs.collect()
        docs = stage(step(spark, docs, SMALL), f"odd-{name}")
        after = docs.collect()
        assert docs.columns == list(before[0].asDict()) and all(r in before for r in after), name
        if name == "exact_dedup":
            assert len(after) == len({(r.text or "").lower() for r in before})
    packed = CP.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_empty_table(spark, make_docs):
    docs = make_docs([(1, "x")]).limit(0)
    for name, step in CP.STAGES:
        assert step(spark, docs, SMALL).count() == 0, name


@pytest.mark.parametrize("name,module", [("quality", quality), ("near_dedup", near_dedup), ("packing", packing)])
def test_batches_are_bounded_in_bytes(spark, monkeypatch, name, module):
    """No worker gets a partition of long texts in one piece; the session's setting comes back."""
    docs = spark.range(0, 80, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 25000) AS text",
                                               "'en' AS lang", "'s' AS source", "id AS n_chars")
    inner, most, key = module.text_chunks, BATCH_BYTES + 400_000, "spark.sql.execution.arrow.maxBytesPerBatch"

    def checked(ids, texts):
        if texts.nbytes > most:
            raise ValueError(f"a batch of {texts.nbytes} bytes")
        return inner(ids, texts)

    monkeypatch.setattr(module, "text_chunks", checked)
    assert dict(CP.STAGES)[name](spark, docs, SMALL).select("doc_id").distinct().count() > 0
    assert spark.conf.get(key, None) is None


def test_batch_limit_of_the_session_stays(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, "1000000")
    try:
        with text_batches(spark):
            assert spark.conf.get(key) == "1000000"
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.unset(key)


def test_run(spark):
    got = CP.run(spark, SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0
    assert [n for n, _ in CP.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "packing"]


def test_registered():
    keys = [k for k in E.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in keys) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("key", ["op1_decontamination", "op7_exact_dedup"])
def test_oracles(spark, key):
    assert spark_digest(E.queries()[key](spark, SMALL)) == duck_digest(duck(SMALL), E.oracle_sql()[key])
