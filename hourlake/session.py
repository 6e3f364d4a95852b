"""Session defaults and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every hourlake job relies on. Hours are cut in UTC, AQE re-plans the
# shuffles at run time (coalesces small partitions, splits skewed ones), and a
# plain overwrite only ever replaces the hours present in the written frame.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "hourlake",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with hourlake's defaults.

    ``master`` is only set when given, so ``spark-submit --master`` wins on a
    cluster. Explicit ``conf`` entries override the defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide scratch folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS, object store), and
    a session without one is an error. Only where driver and executors are one
    process (a ``local`` master) is a fresh local folder created and registered
    as the checkpoint directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no context handle
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc is None or not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, never reused folder under :func:`shared_root`."""
    return f"{shared_root(spark)}/hourlake/{name}-{uuid.uuid4().hex[:12]}"
