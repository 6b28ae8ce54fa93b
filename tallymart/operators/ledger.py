"""Run ledger: what was processed, what has to be processed again."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import PARTITION, RUN_TIMEOUT_HOURS
from ..functions.stamps import utc_stamp
from .cleaning import keep_first

LEDGER_TYPES = {
    "layer": "string",
    "dt": "date",
    "store": "string",
    "status": "string",
    "in_count": "bigint",
    "out_count": "bigint",
    "dlq_rows": "bigint",
    "dlq_files": "bigint",
    "job_run_id": "string",
    "recorded_at": "timestamp",
    "lock_expires_at": "timestamp",
}
FILE_LEDGER_TYPES = {
    "layer": "string",
    "dt": "date",
    "store": "string",
    "file_path": "string",
    "fingerprint": "string",
    "job_run_id": "string",
    "recorded_at": "timestamp",
}
STATE_KEY = ["layer", *PARTITION]


def ledger_rows(
    counts: DataFrame, layer: str, status, run_id: str, at: datetime
) -> DataFrame:
    """Ledger entries for a frame of partitions; absent counts are zero.

    A ``running`` entry carries the time after which the run counts as dead.
    """
    def count(name):
        return F.col(name).cast("bigint") if name in counts.columns else F.lit(0).cast("bigint")

    state = F.lit(status) if isinstance(status, str) else status
    return counts.select(
        F.lit(layer).alias("layer"),
        *PARTITION,
        state.alias("status"),
        *[F.coalesce(count(c), F.lit(0)).alias(c) for c in ("in_count", "out_count", "dlq_rows", "dlq_files")],
        F.lit(run_id).alias("job_run_id"),
        utc_stamp(at).alias("recorded_at"),
        F.when(state == "running", utc_stamp(at + timedelta(hours=RUN_TIMEOUT_HOURS))).alias(
            "lock_expires_at"
        ),
    )


def file_rows(manifest: DataFrame, layer: str, run_id: str, at: datetime, *more: str) -> DataFrame:
    return manifest.select(
        F.lit(layer).alias("layer"),
        *PARTITION,
        "file_path",
        "fingerprint",
        F.lit(run_id).alias("job_run_id"),
        utc_stamp(at).alias("recorded_at"),
        *more,
    )


def run_ledger(entries: DataFrame) -> DataFrame:
    """Current state per layer and partition: its newest entry.

    A run's start and end may carry the same time; then the end is the newer one.
    """
    finished = (F.col("status") != "running").desc()
    newest = [F.col("recorded_at").desc(), F.col("job_run_id").desc(), finished, F.col("status").asc()]
    return keep_first(entries, STATE_KEY, newest)


def previous_files(file_entries: DataFrame, state: DataFrame) -> DataFrame:
    """Files as the newest run of each partition saw them."""
    return file_entries.join(state.select(*STATE_KEY, "job_run_id"), [*STATE_KEY, "job_run_id"], "left_semi")


def restate_detect(
    manifest: DataFrame, state: DataFrame, seen: DataFrame, now: datetime | None = None
) -> DataFrame:
    """Why each partition of the manifest does or does not need work.

    ``manifest``: dt, store, file_path, fingerprint as of now. ``state``: newest ledger entry
    per partition. ``seen``: the files that entry was made from. A file added, removed or
    changed makes the partition ``changed``. With ``now``, a partition another run started
    on and may still be working on is ``locked`` and left alone.
    """
    present = manifest.select(*PARTITION, "file_path", F.col("fingerprint").alias("now"))
    known = seen.select(*PARTITION, "file_path", F.col("fingerprint").alias("was"))
    files = present.join(known, [*PARTITION, "file_path"], "full")
    per_partition = files.groupBy(*PARTITION).agg(
        F.count("now").alias("files"),
        F.count_if(F.col("was").isNull()).alias("added"),
        F.count_if(F.col("now").isNull()).alias("removed"),
        F.count_if(F.col("now") != F.col("was")).alias("changed"),
    )
    moved = F.col("added") + F.col("removed") + F.col("changed") > 0
    locked = F.lit(False)
    if now is not None:
        locked = (F.col("status") == "running") & (F.col("lock_expires_at") >= utc_stamp(now))
    reason = (
        F.when(F.col("status").isNull(), "new")
        .when(locked, "locked")
        .when(F.col("status") != "succeeded", "failed")
        .when(moved, "changed")
        .otherwise("unchanged")
    )
    # A partition that vanished altogether has no files to read, hence nothing to redo.
    return (
        per_partition.where("files > 0")
        .join(state.select(*PARTITION, "status", "lock_expires_at"), PARTITION, "left")
        .select(
            *PARTITION,
            "files",
            "added",
            "removed",
            "changed",
            reason.alias("reason"),
            (~reason.isin("unchanged", "locked")).alias("needs_work"),
        )
    )


def upstream_gate(rows: DataFrame, state: DataFrame, layer: str = "bronze") -> DataFrame:
    """Rows of partitions whose newest upstream run succeeded."""
    ready = state.where((F.col("layer") == layer) & (F.col("status") == "succeeded"))
    return rows.join(ready.select(*PARTITION), PARTITION, "left_semi")


def empty_partitions(partitions: DataFrame, counts: DataFrame) -> DataFrame:
    """Partitions that exist as files but hold no row: succeeded, with nothing to write."""
    filled = counts.where("in_count > 0").select(*PARTITION)
    empty = partitions.select(*PARTITION).distinct().join(filled, PARTITION, "left_anti")
    zero = F.lit(0).cast("bigint")
    return empty.select(
        *PARTITION, F.lit("succeeded").alias("status"), zero.alias("in_count"), zero.alias("out_count")
    )


def stale_silver(state: DataFrame) -> DataFrame:
    """Partitions whose Bronze success is newer than their Silver success.

    Rebuilding all others would only append identical versions downstream.
    """
    done = state.where("status = 'succeeded'")
    bronze = done.where("layer = 'bronze'").select(*PARTITION, F.col("recorded_at").alias("bronze_at"))
    silver = done.where("layer = 'silver'").select(*PARTITION, F.col("recorded_at").alias("silver_at"))
    return (
        bronze.join(silver, PARTITION, "left")
        .where(F.col("silver_at").isNull() | (F.col("bronze_at") > F.col("silver_at")))
        .select(*PARTITION)
    )
