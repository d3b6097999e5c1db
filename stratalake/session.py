"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# A join side is broadcast when its size, measured at run time, is at most 50 MB. Estimates from
# file sizes can be far too small, so on them alone only sides up to 10 MB are broadcast.
MEASURED_BROADCAST = "50mb"
ESTIMATED_BROADCAST = "10mb"
TIME_ZONE = "spark.sql.session.timeZone"

# Skewed joins are split even where that costs another shuffle: one hot key may hold much of a table.
RUNTIME_SETTINGS = {
    TIME_ZONE: "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": ESTIMATED_BROADCAST,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": MEASURED_BROADCAST,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "stratalake", **extra: str) -> SparkSession:
    """Session with the settings above; ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built.

    Settings the session was started with stay, but for the time zone, on which results depend.
    """
    started_with = spark.sparkContext.getConf()
    for key, value in RUNTIME_SETTINGS.items():
        if key == TIME_ZONE or not started_with.contains(key):
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a new temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stratalake-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
