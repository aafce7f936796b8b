"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the jobs rely on. All can change at run time, so a session made elsewhere can take them.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the next aggregate could have reused the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Java only interprets methods beyond this size, as fused steps over wide rows become; unfused, they are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_local_scratch: list[tempfile.TemporaryDirectory] = []


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, app: str = "premia", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.TemporaryDirectory(prefix="premia-"))
        base = _local_scratch[0].name
    return f"{base.rstrip('/')}/premia-{uuid.uuid4().hex}"
