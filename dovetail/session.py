"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (coalescing, skew splits,
# runtime broadcast conversion), dynamic partition overwrite, UTC clock.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "dovetail") -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The checkpoint directory is read from the session (``spark.checkpoint.dir``
    or the SparkContext's checkpoint dir). Where neither is set, a session in
    local mode gets a private folder, registered as its checkpoint dir; on a
    cluster executors could not see one, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = jdir.get() if jdir.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="dovetail-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(str(base), "dovetail", f"{name}-{uuid.uuid4().hex[:12]}")


def shared_dir(spark: SparkSession, *names: str) -> str:
    """A folder under the shared checkpoint directory that is the same one for
    the same names, in this session and later ones."""
    return os.path.join(os.path.dirname(scratch_dir(spark, "x")), *names)


def job_dir(spark: SparkSession, name: str, run: str | None = None) -> str:
    """The folder of a job: the same one for the same ``run`` (a stopped job
    finds its checkpoint and outputs there), a fresh one without."""
    fresh = scratch_dir(spark, name)
    return fresh if run is None else os.path.join(os.path.dirname(fresh), "jobs", name, run)
