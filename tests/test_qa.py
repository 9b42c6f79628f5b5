"""QA rule set: hand-made cases and the one-pass form against the
sequential update statements."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.operators import qa as Q

D = dt.datetime
DEP_SCHEMA = "id long, deployid string, deploy_dt timestamp_ntz, end_dt timestamp_ntz"
REC_SCHEMA = "id long, deployid string, locs_dt timestamp_ntz, type string"


def _qa(spark, deps, recs, rules=()):
    d = spark.createDataFrame(deps, DEP_SCHEMA)
    r = spark.createDataFrame(recs, REC_SCHEMA)
    out = Q.apply_qa(r, d, "locs_dt", "User", list(rules))
    return {row.id: (row.qa_status, row.data_status, row.data_explain) for row in out.collect()}


def test_hand_made_cases(spark):
    deps = [
        (1, "A", D(2020, 1, 10), D(2020, 2, 1)),
        (2, "B", D(2020, 1, 10), None),            # open deployment
        (3, "C", D(2020, 1, 10), D(2020, 2, 1)),   # two rows for C
        (4, "C", D(2020, 1, 20), D(2020, 3, 1)),
    ]
    recs = [
        (1, "A", D(2020, 1, 15), "Argos"),   # inside -> unreviewed
        (2, "A", D(2020, 1, 5), "Argos"),    # before
        (3, "A", D(2020, 2, 5), "Argos"),    # after
        (4, "A", D(2020, 1, 5), "User"),     # User before: exempt
        (5, "A", D(2020, 2, 5), "User"),     # User after: flagged
        (6, "A", D(2020, 1, 5), None),       # null type before: not flagged
        (7, "Z", D(2020, 1, 5), "Argos"),    # no deployment: actively transmitting
        (8, "B", D(2020, 1, 15), "Argos"),   # open: actively transmitting
        (9, "B", D(2020, 1, 5), "Argos"),    # open but before: reviewed
        (10, "C", D(2020, 1, 15), "Argos"),  # before one of two deployments: flagged
        (11, "A", D(2020, 1, 10), "Argos"),  # equal to deploy_dt: strict, not flagged
        (12, "A", D(2020, 2, 1), "Argos"),   # equal to end_dt: not flagged
        (13, "C", D(2020, 2, 15), "Argos"),  # after the earliest end of C
        (14, "A", None, "Argos"),            # null time: nothing applies
    ]
    got = _qa(spark, deps, recs)
    ok = (S.QA_UNREVIEWED, S.DATA_USE, S.EXPLAIN_UNREVIEWED)
    before = (S.QA_REVIEWED, S.DATA_DO_NOT_USE, S.EXPLAIN_BEFORE)
    after = (S.QA_REVIEWED, S.DATA_DO_NOT_USE, S.EXPLAIN_AFTER)
    active = (S.QA_ACTIVE, S.DATA_USE, S.EXPLAIN_UNREVIEWED)
    assert got[1] == ok and got[2] == before and got[3] == after
    assert got[4] == ok and got[5] == after and got[6] == ok
    assert got[7] == active and got[8] == active and got[9] == before
    assert got[10] == before and got[11] == ok and got[12] == ok
    assert got[13] == after and got[14] == ok


def test_known_issue_rules_later_wins_and_boundaries(spark):
    deps = [(1, "T", D(2010, 1, 1), None)]
    recs = [(1, "T", D(2010, 4, 1), "Argos"), (2, "T", D(2010, 3, 31, 23, 59, 59), "Argos"),
            (3, "T", D(2010, 5, 1), "Argos"), (4, "T", D(2009, 12, 1), "Argos")]
    rules = [("locs", "T", ">=", "2010-04-01 00:00:00", "first"),
             ("locs", "T", ">=", "2010-05-01 00:00:00", "second"),
             ("locs", "T", "=", "2009-12-01 00:00:00", S.EXPLAIN_BAD_LOCATION)]
    got = _qa(spark, deps, recs, rules)
    assert got[1] == (S.QA_REVIEWED, S.DATA_DO_NOT_USE, "first")      # start instant: >=
    assert got[2] == (S.QA_ACTIVE, S.DATA_USE, S.EXPLAIN_UNREVIEWED)
    assert got[3][2] == "second"                                       # later rule wins
    assert got[4][2] == S.EXPLAIN_BAD_LOCATION                         # known beats before


def test_real_rule_list_shape():
    assert len(Q.rules_for("timeline")) == 8 and len(Q.rules_for("locs")) == 1


def _sequential(deps, recs, rules):
    """The update statements one after another, in plain Python."""
    state = {r[0]: ["unreviewed", "use", "unreviewed"] for r in recs}
    by_dep = {}
    for d in deps:
        by_dep.setdefault(d[1], []).append(d)

    def joined(r):
        return by_dep.get(r[1], [(None, r[1], None, None)])

    for r in recs:  # active: some joined row has end_dt null
        if any(d[3] is None for d in joined(r)):
            state[r[0]][0] = "tag_actively_transmitting"
    for r in recs:  # before (User exempt; null comparisons false)
        if r[2] is not None and r[3] is not None and r[3] != "User" and any(
                d[2] is not None and r[2] < d[2] for d in joined(r)):
            state[r[0]] = ["reviewed", "do_not_use", "records before deploy_dt"]
    for r in recs:  # after
        if r[2] is not None and any(d[3] is not None and r[2] > d[3] for d in joined(r)):
            state[r[0]] = ["reviewed", "do_not_use", "records after end_dt"]
    for _t, dep, op, instant, explain in rules:
        ts = D.fromisoformat(instant)
        for r in recs:
            if r[1] == dep and r[2] is not None and (r[2] == ts if op == "=" else r[2] >= ts):
                state[r[0]] = ["reviewed", "do_not_use", explain]
    return {k: tuple(v) for k, v in state.items()}


def test_one_pass_equals_sequential_updates(spark):
    rnd = random.Random(7)
    tags = ["T%d" % i for i in range(12)]

    def t():
        return None if rnd.random() < 0.1 else D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))

    deps = [(i, rnd.choice(tags[:9]), t(), t()) for i in range(15)]
    recs = [(i, rnd.choice(tags), t(), rnd.choice(["User", "Argos", "FastGPS", None]))
            for i in range(600)]
    rules = [("locs", "T1", ">=", "2020-02-01 00:00:00", "x"),
             ("locs", "T2", "=", "2020-01-15 00:00:00", "y"),
             ("locs", "T1", ">=", "2020-02-20 00:00:00", "z")]
    assert _qa(spark, deps, recs, rules) == _sequential(deps, recs, rules)


def test_single_steps(spark):
    deps = spark.createDataFrame([(1, "A", D(2020, 1, 10), D(2020, 2, 1))], DEP_SCHEMA)
    recs = spark.createDataFrame([(1, "A", D(2020, 1, 5), "Argos"), (2, "B", D(2020, 1, 5), "x"),
                                  (3, "A", D(2020, 3, 5), "Argos")], REC_SCHEMA)
    assert {r.id for r in Q.flag_active(recs, deps).collect()} == {2}
    assert {r.id for r in Q.flag_before(recs, deps, "locs_dt").collect()} == {1}
    assert {r.id for r in Q.flag_after(recs, deps, "locs_dt").collect()} == {3}
    assert Q.reset(recs).where(F.col("qa_status") != "unreviewed").count() == 0


def test_registry_tables_with_real_fault_list(spark):
    deps = spark.createDataFrame(
        [(1, "EB2009_3000_09S0188", D(2009, 10, 1), None),
         (2, "HF2010_1007_06L0129", D(2010, 4, 1), D(2010, 9, 1))], DEP_SCHEMA)
    tl = spark.createDataFrame(
        [(1, "EB2009_3000_09S0188", D(2010, 4, 1)), (2, "EB2009_3000_09S0188", D(2010, 3, 31, 23)),
         (3, "HF2010_1007_06L0129", D(2010, 4, 2))],
        "id long, deployid string, timeline_start_dt timestamp_ntz")
    got = {r.id: (r.qa_status, r.data_explain) for r in Q.qa_table(tl, deps, S.TIMELINE).collect()}
    assert got == {1: (S.QA_REVIEWED, S.EXPLAIN_BAD_SENSOR), 2: (S.QA_ACTIVE, S.EXPLAIN_UNREVIEWED),
                   3: (S.QA_UNREVIEWED, S.EXPLAIN_UNREVIEWED)}
    locs = spark.createDataFrame(
        [(1, "HF2010_1007_06L0129", D(2010, 5, 11, 12, 49, 1), "Argos"),
         (2, "HF2010_1007_06L0129", D(2010, 3, 1), "User"),
         (3, "HF2010_1007_06L0129", D(2010, 3, 1), "Argos")], REC_SCHEMA)
    got = {r.id: r.data_explain for r in Q.qa_table(locs, deps, S.LOCS).collect()}
    assert got == {1: S.EXPLAIN_BAD_LOCATION, 2: S.EXPLAIN_UNREVIEWED, 3: S.EXPLAIN_BEFORE}
    behav = spark.createDataFrame([(1, "HF2010_1007_06L0129", D(2010, 10, 1))],
                                  "id long, deployid string, end_dt timestamp_ntz")
    assert Q.qa_table(behav, deps, S.BEHAV).first().data_explain == S.EXPLAIN_AFTER
