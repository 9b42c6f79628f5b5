"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for tests and the bench.  Times are zone-less (TIMESTAMP_NTZ) end
# to end and no transform reads the session zone; UTC keeps printed values
# plain.  AQE coalesces small shuffles and splits skewed sort-merge joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tagwave", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, pass the cluster's
    own master and keep its ``spark.checkpoint.dir``."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def job_session(app: str = "tagwave") -> SparkSession:
    """Session for a job: whatever master, partition count and checkpoint
    folder it was submitted with; only the session zone is fixed."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)  # fails at once when the cluster names none
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see: ``spark.checkpoint.dir`` as the
    cluster names it.

    Only when it is unset is one chosen: the context's checkpoint folder if
    code set one, else, with a local master only, a fresh local folder, which is
    registered as the checkpoint folder and remembered in the session under
    ``spark.tagwave.sharedDir`` (``spark.checkpoint.dir`` itself cannot change at
    run time).
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.tagwave.sharedDir", None)
    if d:
        return d
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tagwave-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
    spark.conf.set("spark.tagwave.sharedDir", d)
    return d


def _context(spark: SparkSession):
    """The SparkContext, or ``None`` on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions have no context
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path inside the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tagwave-{name}-{uuid.uuid4().hex}"


#: Bytes of a batch of rows that is sent to Python, see ``text_batches``.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def text_batches(spark: SparkSession):
    """For jobs run inside that send texts to Python: a batch ends at
    ``BATCH_BYTES``, not only at a number of rows (10,000 long texts), so that
    neither the JVM nor the worker holds a whole partition at once.  A limit that
    the session sets itself stays.  Only jobs that end inside are bounded: stage
    what Python returns."""
    own = spark.conf.get(_BATCH_LIMIT, None)
    if own is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_BATCH_LIMIT)


@contextlib.contextmanager
def many_columns(spark: SparkSession):
    """For jobs run inside that make dozens of columns per row: a method of
    more than 8000 bytes, which the JVM would interpret row by row, is split."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def local_scratch() -> str:
    """Fresh local folder, for tests only."""
    return tempfile.mkdtemp(prefix="tagwave-", dir=os.environ.get("TMPDIR", "/tmp"))
