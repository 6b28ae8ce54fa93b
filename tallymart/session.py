"""Session and scratch-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, name: str = "tallymart") -> SparkSession:
    """Session for tests and the bench. On a cluster, the submitted session is used."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TALLYMART_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables and stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to
    a machine-local temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tallymart-")


def new_workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder below the scratch root."""
    return f"{scratch_root(spark)}/tallymart/{purpose}-{uuid.uuid4().hex[:12]}"
