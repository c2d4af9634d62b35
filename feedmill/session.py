"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the operator above it then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Top-k per key is cut to k rows per task before the shuffle, for any k one may ask for.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "feedmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, which every string/timestamp conversion here relies on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its executor, so an unset name is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="feedmill-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
