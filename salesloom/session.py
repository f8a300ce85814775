"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SPARK_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(master: str, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("salesloom").master(master)
    # A local master runs its tasks in the driver, whose heap is one gigabyte by default.
    local = {"spark.driver.memory": "8g"} if master.startswith("local") else {}
    for key, value in {**SPARK_CONF, **local, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local master without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="salesloom-")
    return _LOCAL_ROOTS[app]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder name nobody has used yet, below the shared root."""
    return f"{shared_root(spark)}/salesloom/{label}-{uuid.uuid4().hex}"
