"""Session and scratch-location helpers.

Shared scratch space always comes from ``spark.checkpoint.dir`` (the cluster's
shared folder).  Only when that setting is missing and the master is ``local`` a
fresh temporary folder is configured, once per session; elsewhere it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Python keeps the last of duplicate JSON keys; so does the variant parser with this on.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, app: str = "reportlake", **conf) -> SparkSession:
    """Return the active session, or build one.

    The local defaults (partitions, memory) apply only if the master is a local one:
    the one asked for, or, where neither an argument, ``SPARK_MASTER`` nor a submit
    tool names one, ``local``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        _session_defaults(active)
        return active
    builder = SparkSession.builder.appName(app)
    submitted = os.environ.get("SPARK_MASTER") or os.environ.get("PYSPARK_GATEWAY_PORT")
    if master is None and not submitted:
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        builder = builder.master(master)
    local = master is not None and master.startswith("local") and not master.startswith("local-cluster")
    for k, v in {**(_LOCAL_DEFAULTS if local else {}), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 -- no SparkContext on Spark Connect
        pass
    _session_defaults(spark)
    return spark


def _session_defaults(spark: SparkSession) -> None:
    json_parity(spark)


def json_parity(spark: SparkSession) -> None:
    """Parse JSON objects with repeated keys as Python does: the last one wins.

    Without this, Spark's VARIANT parser turns such an object into NULL, which
    would make an entry look malformed or a capture unreadable.
    """
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


@contextmanager
def exact_case(spark: SparkSession):
    """Within the block names are told apart by case, for tables whose columns need it."""
    before = spark.conf.get("spark.sql.caseSensitive", "false")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; configured locally only when unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- e.g. a Spark Connect session has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reportlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def task_count(spark: SparkSession) -> int:
    """Tasks for a step that costs much more than its bytes tell: three a core, the shuffle partitions at least."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        return max(n, 3 * spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 -- no SparkContext on Spark Connect
        return n


def spread(df, *keys):
    """Deal the rows of ``df`` over ``task_count`` tasks, by the hash of ``keys`` (none: in turn).

    Tasks are sized by bytes otherwise: a small file is one split, and adaptive execution
    joins shuffle partitions up to its target size.  A row of a page or of a capture is small, but
    decoding or cutting it takes long, so by bytes such a step may run in one task.  A count that is
    asked for stays as it is.
    """
    return df.repartition(task_count(df.sparkSession), *keys)


def stage(df, name: str):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where several downstream branches read the same costly result: the
    work runs once, the lineage is cut (a lost executor re-reads files instead
    of recomputing), and later reads are column-pruned Parquet scans.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
