"""Jobs that rewrite what other jobs wrote: version dedup and quarantine replay."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import PARTITION, WINDOWS, ddl
from ..functions.stamps import utc_stamp
from ..operators.quarantine import FILE_ID, QUARANTINED_TYPES, file_id, parse_failure_day, replay_actions
from ..operators.versions import dedup_versions, touched_by_dedup
from ..sources.commits import CommitConflict, Live, LiveFolder, read_folders, write_attempt
from ..sources.drop import SOURCE_FILE
from ..sources.folders import children, move
from ..sources.manifest import file_manifest
from ..sources.tables import append_rows
from ..streaming.append_load import BATCH, STORED_VERSIONS, VERSIONS, LoadTarget, utc_now
from .bronze import BronzeRun, bronze_build
from .layout import Layout, read_errors, read_or_empty
from .silver import silver_build

REPLAY_TYPES = {
    "failed_at": "date",
    "kind": "string",
    "job_run_id": "string",
    "dt": "date",
    "store": "string",
    "source_file": "string",
    "row_count": "bigint",
    "action": "string",
    "replayed_at": "timestamp",
}


def dedup_in_place(
    spark: SparkSession, target: LoadTarget, as_of: date, at: datetime | None = None, days: int = WINDOWS.dedup_days
) -> list[date]:
    """Drop superseded versions from the days that have any; returns those days.

    Survivors are written beside the table in one go. One commit then makes their folders live
    and drops those they were made from, for all days together: whoever reads, and whenever the
    job dies, the days are whole, as they were or as they will be. Batches that arrive meanwhile
    stay live. If another job has replaced one of the folders, nothing is changed.
    """
    log = target.log(spark)
    cutoff = as_of - timedelta(days=days)
    recent = [f for f in log.live(VERSIONS) if f.dt is not None and f.dt >= cutoff]
    touched = sorted(r.dt for r in touched_by_dedup(_versions(spark, target, recent), as_of, days).collect())
    if not touched:
        return []
    used = [f for f in recent if f.dt in touched]
    survivors = dedup_versions(_versions(spark, target, used), as_of, days)
    adds = write_attempt(survivors, target.table, VERSIONS, ["dt", BATCH])
    before = {f.folder for f in used}

    def replaced(live: Live) -> set[str]:
        if not before <= live.keys():
            raise CommitConflict("folders of a day were replaced while it was deduplicated")
        return before

    log.commit(adds, replaced, at or utc_now())
    return touched


def _versions(spark: SparkSession, target: LoadTarget, live: list[LiveFolder]) -> DataFrame:
    return read_folders(spark, target.table, live, ddl(STORED_VERSIONS)).select(*STORED_VERSIONS)


ENTRY_KEY = ["failed_at", "kind", "job_run_id", *PARTITION, "source_file"]


def quarantine_entries(spark: SparkSession, layout: Layout, failed_at: date | None = None) -> DataFrame:
    """What the quarantine holds, of one failure day or in all: raw files, error records and
    blocked wide partitions, each by the run that put it there.

    ``failed_at, kind, job_run_id, dt, store, source_file, row_count, modified_at, signature``.
    """
    def of_day(rows: DataFrame) -> DataFrame:
        return rows if failed_at is None else rows.where(F.col("failed_at") == F.lit(failed_at))

    raw = of_day(read_or_empty(spark, layout.quarantine_index, QUARANTINED_TYPES)).select(
        "failed_at", F.lit("raw").alias("kind"), "job_run_id", *PARTITION, "source_file", "row_count", "modified_at", "signature"
    )
    held = {"dt": "date", "store": "string", "_dlq_job_run_id": "string", "failed_at": "date"}
    wide = of_day(read_or_empty(spark, f"{layout.quarantine}/wide", held))
    wide = wide.groupBy("failed_at", F.col("_dlq_job_run_id").alias("job_run_id"), *PARTITION).agg(F.count("*").alias("row_count"))
    errors = of_day(read_errors(spark, layout)).groupBy("failed_at", "job_run_id", *PARTITION, "source_file").agg(
        F.count("*").alias("row_count")
    )
    return (
        raw.unionByName(wide.withColumn("kind", F.lit("wide")), allowMissingColumns=True)
        .unionByName(errors.withColumn("kind", F.lit("error")), allowMissingColumns=True)
    )


def dlq_replay(spark: SparkSession, layout: Layout, failed_at: str, at: datetime) -> DataFrame:
    """Put files of one failure day back into the drop, each under its own name; log every entry.

    A file that is there again, or whose partition has had a newer delivery since, is left as the
    drop has it. Entries handled before are not handled again, entries of a later rejection of
    the same day are. A replay that died is run again: files that it had put back are present then.
    Returns this replay's log rows.
    """
    entries = quarantine_entries(spark, layout, parse_failure_day(failed_at))
    done = read_or_empty(spark, layout.replays, REPLAY_TYPES).select(*[F.col(c).alias(f"_{c}") for c in ENTRY_KEY])
    fresh = entries.join(done, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ENTRY_KEY], "left_anti")
    raw = fresh.where("kind = 'raw'")
    days = {row.dt for row in raw.select("dt").distinct().collect()}
    live = file_manifest(spark, layout.drop, wanted=days.__contains__)
    acted = replay_actions(raw, live).unionByName(fresh.where("kind <> 'raw'").withColumn("action", F.lit("archive_only")))
    # The decision is written down before anything is moved, and is what is carried out.
    plan = layout.staging(uuid.uuid4().hex[:12], "replay")
    acted.withColumn("replayed_at", utc_stamp(at)).write.parquet(f"{plan}/entries")
    decided = spark.read.parquet(f"{plan}/entries")
    _restore(spark, layout, decided.where("action = 'replay'"), plan)
    log = decided.select(*REPLAY_TYPES)
    append_rows(log, layout.replays)
    return log


def _restore(spark: SparkSession, layout: Layout, entries: DataFrame, plan: str) -> None:
    """Copy the rows of each file by Spark, then move what was written to the file's own name.

    One copy per run and signature, so that rows keep the types they came with. A file that was
    written in several parts gets numbered ones beside its own name; that comes last, so a file
    is present only once it is whole. The driver sees names of files and no rows.
    """
    groups: dict[tuple, dict[str, str]] = {}
    named = entries.select("failed_at", "job_run_id", "signature", "source_file", file_id(F.col("source_file")).alias(FILE_ID))
    for row in named.collect():
        groups.setdefault((row.failed_at, row.job_run_id, row.signature), {})[row[FILE_ID]] = row.source_file
    for number, ((day, run, signature), files) in enumerate(sorted(groups.items(), key=lambda g: g[0])):
        root = f"{layout.quarantine}/raw/failed_at={day.isoformat()}/job_run_id={run}/signature={signature}"
        rows = spark.read.option("basePath", root).parquet(root).where(F.col(FILE_ID).isin(list(files)))
        copy = f"{plan}/copy-{number}"
        rows.drop(*PARTITION, SOURCE_FILE).write.partitionBy(FILE_ID).parquet(copy)
        for folder in children(spark, copy):
            if folder.name.startswith(f"{FILE_ID}="):
                _move_parts(spark, folder.path, files[folder.name.split("=", 1)[1]])


def _move_parts(spark: SparkSession, folder: str, target: str) -> None:
    parts = [e.path for e in children(spark, folder) if not e.is_folder and e.size]
    stem, dot, ending = target.rpartition(".parquet")
    for number, part in reversed(list(enumerate(parts))):
        name = target if number == 0 else f"{stem}-{number}{dot}{ending}" if dot else f"{target}-{number}.parquet"
        move(spark, part, name)


def backfill_days(spark: SparkSession, layout: Layout, run_id: str, at: datetime, start: date, end: date, **options) -> None:
    """Bronze and Silver anew for every partition of the days, whatever the ledger says of them."""
    if end < start:
        raise ValueError(f"backfill end {end} lies before start {start}")
    bronze_build(spark, layout, BronzeRun(run_id, at, end, days=(start, end)), **options)
    silver_build(spark, layout, run_id, at, force=True, window=(start, end))
