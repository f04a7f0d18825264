"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every pageflow session needs. Event time is UTC, ANSI stays on
# (bad input is handled with try_* functions, not by switching ANSI off),
# and AQE re-plans joins / coalesces partitions from runtime statistics.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pageflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with pageflow's settings.

    On a cluster call it without ``master`` and let spark-submit decide. The
    shuffle partition count should be sized so one partition of the largest
    shuffle stays around 128-256 MB; AQE coalesces what is left over.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event time is UTC wall clock throughout pageflow; pin the session zone before planning."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Streaming checkpoints, keyed tables and lineage cuts all live below it. A
    local fallback is only used where the setting is unset (tests); it is then
    written back into the session so everything agrees on one root.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") and fallback is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares "
                               "(a machine-local folder does not survive executor loss)")
        root = fallback or os.path.join("/tmp", "pageflow-checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique directory below the checkpoint root."""
    return f"{checkpoint_root(spark)}/pageflow/{kind}/{uuid.uuid4().hex}"


def materialize(df):
    """Write ``df`` below the checkpoint root and return a DataFrame reading it back.

    Used where one intermediate result feeds two branches of a plan: the input
    is read once, and the lineage is cut so a lost executor does not recompute
    it from the raw data. (Never ``localCheckpoint``: executor-local storage
    does not survive executor loss.)
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)
