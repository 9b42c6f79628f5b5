"""Fill-in-middle: boundary sets against plain sorting, cuts against a plain
rewriting, exact round trips."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import duck_digest, spark_digest
from tagwave.llm import fill_middle as FM
from tagwave.llm.catalog import QUERIES


def plain(doc_id, text, seed=7):
    """The rule, line by line."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    head, mid, tail = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return (doc_id, n, "spm", len(head), len(mid), f"<S>{tail}<P>{head}<M>{mid}")
    return (doc_id, n, "psm", len(head), len(mid), f"<P>{head}<S>{tail}<M>{mid}")


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("offsets, kinds", [
    (np.arange(1, 200_000, 31), {"ArrayContainer"}),
    (np.arange(0, 3 * 65_536, 3), {"BitmapContainer"}),
    (np.arange(5, 300_000), {"RunContainer"}),
    (np.array([0]), {"ArrayContainer"}),
    (np.concatenate([np.arange(0, 65_536, 2), np.arange(65_536, 131_072), [200_000, 900_001, 900_002]]),
     {"BitmapContainer", "RunContainer", "ArrayContainer"}),
])
def test_boundary_set_selects_and_ranks(offsets, kinds):
    s = FM.BoundarySet(offsets.astype(np.int64))
    assert {type(c).__name__ for c in s.containers} == kinds
    assert len(s) == len(offsets)
    for k in {0, len(offsets) - 1, len(offsets) // 2, *np.random.default_rng(1).integers(0, len(offsets), 200)}:
        assert s.select(int(k)) == offsets[k]
        assert s.rank(int(offsets[k])) == k + 1
        assert s.rank(int(offsets[k]) - 1) == k
    with pytest.raises(IndexError):
        s.select(len(offsets))
    assert s.rank(1 << 40) == len(offsets)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400_000), max_size=300), st.integers(0, 400_000))
def test_boundary_set_equals_sorted_list(values, probe):
    members = sorted(values)
    s = FM.BoundarySet(np.array(members, dtype=np.int64))
    assert [s.select(k) for k in range(len(s))] == members
    assert s.rank(probe) == sum(v <= probe for v in members)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10_000), st.text(alphabet="ab\n\r <PSM>é日\U0001f600", max_size=60))
def test_cut_equals_plain_rule(doc_id, text):
    got = FM.FillMiddle().cut(str(doc_id), text.encode())
    assert (doc_id, *got[:4], got[4].decode()) == plain(doc_id, text)


def test_rates_and_markers(spark, make_docs):
    docs = make_docs([(i, f"a{i}\nb\nc") for i in range(400)])
    half = FM.fill_in_middle(docs, FM.FillMiddle(seed=1, rate=50, spm_rate=0)).collect()
    forms = [r.form for r in half]
    assert set(forms) == {"plain", "psm"} and 140 < forms.count("plain") < 260
    with pytest.raises(ValueError):
        FM.fill_in_middle(docs, FM.FillMiddle(suffix="<P>"))


def test_whole_rows_equal_plain_rule(spark, make_docs, odd_rows):
    rows = [*odd_rows, (20, "\n"), (21, "\n\n\n"), (22, "a\nb\nc\n"), (23, "holds <M> itself\nb"), (24, "no newline"),
            (25, "\r\n\r\nx\r"), (26, "é\n日本\n\U0001f600\n" * 40_000), (27, "\n" * 100_000), (28, "<P\n>S><\nM")]
    docs = make_docs(rows).selectExpr("*", "'x' as form", "1 as n", "'y' as output")
    got = FM.fill_in_middle(docs).collect()
    assert key(tuple(r) for r in got) == key(plain(i, t) for i, t in rows)
    sums = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in FM.fill_in_middle_digest(docs).collect()}
    want = {(i, hashlib.sha256(plain(i, t)[5].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t in rows}
    assert sums == want


def test_empty_table(spark, make_docs):
    assert FM.fill_in_middle_digest(make_docs([])).collect() == []


def test_query_matches_sql(spark):
    from compare import duck
    sf = "/root/testdata/sf0.01"
    got = spark_digest(QUERIES["op13_fill_middle"](spark, sf))
    assert got == duck_digest(duck(sf), FM.ORACLE_SQL)
