"""Task balance of the id numbering when one tag holds a third of the rows.

    python tools/skew_report.py [sf_dir]

Remaps the events so every third user becomes one hot tag, numbers the rows
with ``surrogate_ids`` and, for contrast, with a per-tag window, then runs
the one-pass QA with every broadcast refused (sort-merge join with the hot
tag salted).  Spark's event log goes to a fresh
scratch folder; printed per stage that reads a shuffle: the task count and
the largest task's share of the rows.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tagwave.operators.qa import apply_qa  # noqa: E402
from tagwave.operators.sequence import surrogate_ids  # noqa: E402
from tagwave.operators.histogram import timeline_unpivot  # noqa: E402
from tagwave.plans.bindings import deployments, wide_histograms  # noqa: E402
from tagwave.session import build_session  # noqa: E402


def main(sf_dir: str) -> None:
    log_dir = tempfile.mkdtemp(prefix="tagwave-eventlog-")
    # AQE's partition coalescing is off: at this size it would merge all 16
    # partitions into one or two tasks and hide how the keys are spread.
    spark = build_session(shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = e.select(F.when(F.col("user_id") % 3 == 0, F.lit("hot"))
                    .otherwise(F.col("user_id").cast("string")).alias("deployid"),
                    F.col("event_id").alias("seq"))
    spark.sparkContext.setJobGroup("range-numbering", "surrogate_ids")
    surrogate_ids(rows, "deployid", ["seq"]).write.format("noop").mode("overwrite").save()
    # Timeline numbering with one hot deploy_id: the range partitioning on
    # (deploy_id, timeline_start_dt, ...) splits it by time.
    wide = wide_histograms(spark, sf_dir).where(F.col("hist_type") == "click").drop("hist_type")
    hot_wide = wide.withColumn("deploy_id", F.when(F.col("deploy_id") % 3 == 0, F.lit(0))
                               .otherwise(F.col("deploy_id")))
    spark.sparkContext.setJobGroup("timeline-numbering", "timeline_unpivot, one hot deploy_id")
    timeline_unpivot(hot_wide).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("per-tag-window", "row_number over (partition by deployid)")
    w = Window.partitionBy("deployid").orderBy("seq")
    rows.withColumn("rn", F.row_number().over(w)).write.format("noop").mode("overwrite").save()

    # QA with every broadcast refused: the records join the deployment
    # summary in a sort-merge join whose hot tag is salted (joins.py).
    for k, v in {"spark.tagwave.maxBroadcastRows": "0",
                 "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(k, v)
    recs = e.select(F.col("event_id").alias("seq"), F.when(
        F.col("user_id") % 3 == 0, F.lit("1")).otherwise(F.col("user_id").cast("string")).alias("deployid"),
        F.col("ts").alias("dt"), F.col("event_type").alias("type"))
    spark.sparkContext.setJobGroup("qa-salted-sort-merge", "apply_qa without broadcasts")
    apply_qa(recs, deployments(spark, sf_dir), "dt", "error").write.format("noop").mode("overwrite").save()
    spark.stop()

    group, tasks = {}, collections.defaultdict(list)
    for f in glob.glob(f"{log_dir}/*/events_*"):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        for line in text.splitlines():
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerJobStart":
                for sid in ev.get("Stage IDs", []):
                    group[sid] = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            elif ev.get("Event") == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                tasks[ev["Stage ID"]].append(
                    (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
    for sid, recs in sorted(tasks.items()):
        if sum(recs):
            print(f"{group.get(sid)}: stage {sid}: {len(recs)} tasks, rows {sum(recs)}, "
                  f"largest task {max(recs)} ({max(recs) / sum(recs):.0%})")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
