"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings the jobs rely on: wall clocks are read and written in UTC, a
# partitioned overwrite replaces only the partitions it holds, and AQE sizes
# shuffle partitions and splits skewed ones at run time. Wide cleaning projections
# compile to methods the JVM will not optimise above 8000 bytes of code, so such
# stages are generated in smaller pieces.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "quarrylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with `SETTINGS`; on a cluster the submit command names the master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="quarrylake-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which every executor can reach.

    Only a local-mode session without that setting falls back to a temporary
    folder of this machine; on a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_folder()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
