"""Session settings the library is designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "hourledger", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, adaptive execution and skew handling.

    On a cluster the shuffle width is left to ``spark.sql.shuffle.partitions`` as submitted;
    adaptive execution coalesces what turns out small.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot key even where that costs a shuffle later on.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # With more than 2000 shuffle partitions block sizes are averaged; report hot ones exactly.
        .config("spark.shuffle.accurateBlockSkewedFactor", "5")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    fallback = tempfile.mkdtemp(prefix="hourledger-")
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback
