"""The stand-in tables contain every case the pipeline has to handle, so the
oracle checks exercise each branch (a rule with no row to apply to would
pass vacuously)."""

from pyspark.sql import functions as F

from tagwave.operators import status as ST
from tagwave.operators.deploy import eligible_tags
from tagwave.plans import bindings as B
from tagwave.plans import catalog as CAT

SF = "/root/testdata/sf0.01"


def test_deployment_cases_present(spark):
    d = B.deployments(spark, SF)
    assert d.where("deploy_dt is null").count() > 0            # never eligible
    assert d.where("end_dt is null").count() > 0               # open
    assert d.where("deploy_dt = end_dt").count() > 0           # zero length
    r = B.records(spark, SF)
    orphans = r.join(d, "deployid", "left_anti")
    assert orphans.count() > 0                                 # records without a deployment
    assert eligible_tags(d).count() < d.count()


def test_routing_cases_present(spark):
    _tags, _rows, outcomes = CAT._routing(spark, SF)
    states = {(r.state, r.outcome) for r in outcomes.select("state", "outcome").distinct().collect()}
    assert ("present", "loaded") in states and ("absent", "missing") in states
    assert ("error", "failed") in states and ("present", "failed") in states  # short circuit
    assert outcomes.where((F.col("state") == "absent") & (F.col("outcome") == ST.OUT_FAILED)).count() > 0


def test_location_and_histogram_cases_present(spark):
    src = B.location_sources(spark, SF)
    prefs = {r.pref for r in src.select("pref").distinct().collect()}
    assert prefs == {1, 2}
    kept = CAT.QUERIES["locs_source_pref"](spark, SF)
    assert {r.pref for r in kept.select("pref").distinct().collect()} == {1, 2}
    wide = B.wide_histograms(spark, SF)
    assert wide.where("bin01 is null").count() > 0 and wide.where("bin01 is not null").count() > 0


def test_qa_rules_have_rows(spark):
    """The flagged tables hold rows of every rule the stand-ins can reach."""
    locs = CAT.QUERIES["qa_loaded_locs"](spark, SF)
    assert {(r.data_explain) for r in locs.select("data_explain").distinct().collect()} >= {
        "records before deploy_dt", "records after end_dt", "unreviewed"}
    assert locs.where("type = 'User'").count() > 0 and locs.where("type is null").count() > 0
    faults = CAT.QUERIES["qa_loaded_timeline"](spark, SF).where("data_explain like 'wet-dry%'")
    assert faults.count() > 0
    assert locs.where("data_explain = 'erroneous location'").count() > 0    # the rule with =
    listed = eligible_tags(B.deployments(spark, SF)).groupBy("deployid").count()
    assert listed.where("count > 1").count() > 0                            # fetched twice
    report = CAT.QUERIES["import_status"](spark, SF)
    assert report.where("deployid = ''").count() == 6                       # the blank id
    assert report.where("deployid = '' and status not like 'failed%'").count() == 0
    _tags, _rows, outcomes = CAT._routing(spark, SF)
    assert outcomes.where("deployid = '' and outcome = 'missing'").count() > 0
    d = B.deployments(spark, SF)
    assert d.groupBy("deployid").count().where("count > 1").count() > 0
