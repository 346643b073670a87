"""Session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job here assumes. AQE re-plans joins from measured sizes
# (broadcast only under the size threshold, splitting of skewed partitions).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidewright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master, where driver and
    executors share one disk; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewright-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def settled(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a plan that is run once: the shuffle files behind it go when it
    is written, not whenever the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        # the setting holds for plans made under it
        return cut_lineage(df.select("*"))
    finally:
        if before is None:
            conf.unset(RELEASE)
        else:
            conf.set(RELEASE, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder that does not exist yet, under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir().rstrip("/")
    return f"{base}/{name}-{os.urandom(6).hex()}"
