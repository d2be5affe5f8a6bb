"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC rendering, adaptive execution, and
# generated methods that the JVM compiles (one of more than 8000 bytes runs
# interpreted; a stage that needs one is generated in smaller pieces instead).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app: str = "vitaldf", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators assume (safe on an existing session)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location is read from the session (``spark.checkpoint.dir`` or the
    SparkContext checkpoint dir).  Without one a cluster has no folder that
    all executors see, so this raises; a local master gets one of its own.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            base = None
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vitaldf-ckpt-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
