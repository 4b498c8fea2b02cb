"""Spark sessions for this engine."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_TZ = "Asia/Ho_Chi_Minh"


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution, skew handling and a RocksDB state store; conf overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    } | conf
    builder = SparkSession.builder.appName(app).config(map=settings)
    return (builder.master(master) if master else builder).getOrCreate()


def work_dir(s: SparkSession) -> str:
    """A new folder in the shared one, spark.checkpoint.dir. Where that is unset, one of this machine, which only a local master can use; else an error."""
    shared, master = s.conf.get("spark.checkpoint.dir", None), s.conf.get("spark.master", "")
    if not shared:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = "file://" + tempfile.gettempdir()
    return f"{shared.rstrip('/')}/work-{uuid.uuid4().hex}"
