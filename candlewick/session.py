"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import SparkSession

# Large streaming state (one row per open trade id) must live off-heap and checkpoint
# incrementally; everything else is left to adaptive execution.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "candlewick", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch conversions of zone-less timestamps read the session zone, so it must be UTC.

    Another zone is replaced, with a warning.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != "UTC":
        warnings.warn(f"session time zone changed from {zone} to UTC", stacklevel=3)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach, for one intermediate table.

    It lies below ``spark.checkpoint.dir``. Where that is unset, a local session uses its warehouse;
    on a cluster, where executors would each write their own copy, it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
