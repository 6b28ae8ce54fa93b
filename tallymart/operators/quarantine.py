"""Rejected rows and error records, and their way back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import PARTITION
from ..functions.stamps import utc_stamp

# Error types.
SCHEMA_MISMATCH = "SCHEMA_MISMATCH"
PROCESSING_ERROR = "PROCESSING_ERROR"
SILVER_PROCESSING_ERROR = "SILVER_PROCESSING_ERROR"
DQ_BLOCK = "DQ_BLOCK"

ERROR_TYPES = {
    "error_type": "string",
    "error_message": "string",
    "recorded_at": "timestamp",
    "job_run_id": "string",
    "source_file": "string",
    "original_key": "string",
    "dt": "date",
    "store": "string",
    "failed_at": "date",
}


#: One row per quarantined file, by the run that rejected it.
QUARANTINED_TYPES = {
    "failed_at": "date",
    "job_run_id": "string",
    "dt": "date",
    "store": "string",
    "source_file": "string",
    "fingerprint": "string",
    "modified_at": "timestamp",
    "signature": "string",
    "row_count": "bigint",
}
FILE_ID = "file_id"


def file_id(path: Column) -> Column:
    """A folder name for a file; the prefix keeps it from being read as a number."""
    return F.concat(F.lit("file-"), F.md5(path))


def replay_actions(entries: DataFrame, live: DataFrame) -> DataFrame:
    """``entries`` (raw files of rejected partitions) with what a replay does with each.

    ``live`` lists what the drop holds now. ``present``: the file is there, as it was or corrected
    under its name. ``superseded``: its partition holds a file of another name that came after everything
    the rejecting run saw. ``lost``: no rows of it could be kept. Else ``replay``. A partition is
    looked at as one run rejected it, so entries of different runs do not mix.
    """
    key = ["job_run_id", *PARTITION]
    there = live.select(F.col("file_path").alias("source_file")).distinct().withColumn("there", F.lit(True))
    newest = entries.groupBy(*key).agg(F.max("modified_at").alias("newest"))
    # Files under quarantined names may be what an earlier replay put back.
    other = live.join(entries.select(F.col("source_file").alias("file_path")).distinct(), "file_path", "left_anti")
    arrived = other.groupBy(*PARTITION).agg(F.max("modified_at").alias("arrived"))
    later = newest.join(arrived, [newest[c].eqNullSafe(arrived[c]) for c in PARTITION]).where("arrived > newest")
    later = later.select(*[newest[c].alias(f"_{c}") for c in key]).withColumn("later", F.lit(True))
    found = entries.join(there, "source_file", "left")
    found = found.join(later, [found[c].eqNullSafe(later[f"_{c}"]) for c in key], "left")
    action = (
        F.when(F.col("there"), "present")
        .when(F.col("later"), "superseded")
        .when(F.col("row_count") == 0, "lost")
        .otherwise("replay")
    )
    return found.select(*[found[c] for c in entries.columns], action.alias("action"))


def error_records(
    failed: DataFrame, error_type: str | Column, message: Column, source_file: Column, run_id: str, at: datetime
) -> DataFrame:
    """One record per failed input. ``failed_at`` is the day of the failure, not of the data."""
    key = F.concat_ws("/", F.concat(F.lit("dt="), F.date_format("dt", "yyyy-MM-dd")), F.concat(F.lit("store="), "store"))
    kind = F.lit(error_type) if isinstance(error_type, str) else error_type
    return failed.select(
        kind.alias("error_type"),
        message.alias("error_message"),
        utc_stamp(at).alias("recorded_at"),
        F.lit(run_id).alias("job_run_id"),
        source_file.alias("source_file"),
        key.alias("original_key"),
        *PARTITION,
        F.lit(at.date()).alias("failed_at"),
    )


def quarantine_frame(wide: DataFrame, error_type: str, run_id: str, at: datetime) -> DataFrame:
    """Blocked wide rows with why, by which run and when.

    The partition includes the store: two stores that fail on one day must not overwrite
    each other.
    """
    return wide.select(
        "*",
        F.lit(error_type).alias("_dlq_error_type"),
        F.lit(run_id).alias("_dlq_job_run_id"),
        utc_stamp(at).alias("_dlq_timestamp"),
        F.lit(at.date()).alias("failed_at"),
    )


def quarantine_rows(raw: DataFrame, at: datetime) -> DataFrame:
    """Rows of a rejected drop partition, keeping ``_source_file``."""
    return raw.withColumn("failed_at", F.lit(at.date()))


def parse_failure_day(text: str) -> date:
    """A replay that silently matches nothing is worse than an error."""
    try:
        return date.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"failure day must be YYYY-MM-DD, got {text!r}") from error


def dlq_replay_plan(entries: DataFrame, failed_at: date) -> DataFrame:
    """What a replay does with each entry of one failure day.

    Raw drop rows go back to the drop. Error records and blocked wide frames cannot be fed
    to the narrow pipeline; they are only archived. Everything is archived.
    """
    action = F.when(F.col("kind") == "raw", "replay").otherwise("archive_only")
    return entries.where(F.col("failed_at") == F.lit(failed_at)).withColumn("action", action)
