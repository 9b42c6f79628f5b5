"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

import __spark_entry__ as E
from compare import duck, duck_digest, spark_digest
from tagwave.plans.catalog import QUERIES
from tagwave.plans.oracle import ORACLES

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con_small():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle_small(spark, con_small, key):
    df = E.queries()[key](spark, SMALL)
    assert spark_digest(df) == duck_digest(con_small, E.oracle_sql()[key])


@pytest.mark.parametrize("key", ["qa_full", "load_locs", "import_status", "timeline_unpivot",
                                 "nsb_histos_raw"])
def test_query_matches_oracle_mid(spark, key):
    df = E.queries()[key](spark, MID)
    assert spark_digest(df) == duck_digest(duck(MID), E.oracle_sql()[key])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["seq", "qa_status", "data_status", "data_explain"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["qa_full", "load_locs", "nsb_locs", "import_status"])
def test_query_matches_oracle_without_broadcasts(spark, con_small, key):
    """Size checks fail -> sort-merge joins; results must not change."""
    keys = ("spark.tagwave.maxBroadcastRows", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in keys]
    spark.conf.set(keys[0], "0")
    spark.conf.set(keys[1], "-1")
    try:
        df = E.queries()[key](spark, SMALL)
        assert spark_digest(df) == duck_digest(con_small, E.oracle_sql()[key])
    finally:
        for k, v in zip(keys, before):
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_column_types_match_oracle(spark, con_small, key):
    got = {c: SPARK_TO_DUCK.get(t, t) for c, t in E.queries()[key](spark, SMALL).dtypes}
    want = {r[0]: r[1] for r in con_small.execute(f"describe {E.oracle_sql()[key]}").fetchall()}
    assert got == want
