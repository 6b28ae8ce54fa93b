"""Append load: every new wide file is loaded once into the versioned table.

Rows and load history of a batch are written to folders of their own and become readable with one
commit, together. A batch that is run again replaces what it committed before; one that died has
left nothing readable, so its files may as well be loaded by hand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import LOADED_AT, PARTITION, VERSIONED_TYPES, WIDE_TYPES, ddl
from ..operators.loading import HISTORY_TYPES, ROW_INDEX, load_history, load_on_error, stamp_load
from ..sources.commits import CommitConflict, CommitLog, Live, LiveFolder, read_folders, write_attempt
from ..sources.drop import SOURCE_FILE
from ..sources.manifest import file_manifest, plain_path, reload_missing
from ..sources.tables import read_partitions

BATCH = "load_batch"
STORED_VERSIONS = {**VERSIONED_TYPES, BATCH: "bigint"}
STORED_HISTORY = {**HISTORY_TYPES, BATCH: "bigint"}


VERSIONS, HISTORY = "versions", "history"


@dataclass(frozen=True)
class LoadTarget:
    """Folders of one versioned table, its history and the log that says which are live."""

    table: str
    history: str
    checkpoint: str
    commits: str

    @classmethod
    def under(cls, root: str) -> LoadTarget:
        return cls(f"{root}/versions", f"{root}/load_history", f"{root}/load_checkpoint", f"{root}/commits")

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.commits)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def arrivals(
    spark: SparkSession,
    source: str,
    types: dict[str, str] = WIDE_TYPES,
    max_files: int = 1000,
) -> DataFrame:
    """Stream of wide rows from a partitioned folder, each file once by name.

    A file that its partition's next overwrite removed before it was read is passed over:
    the new files of that partition replace it. No file is passed over for its age.
    """
    rows = (
        spark.readStream.schema(_stored(types))
        .option("maxFilesPerTrigger", max_files)
        .option("ignoreMissingFiles", True)
        .option("maxFileAge", "36500d")
        .parquet(source)
    )
    return _named(rows)


def _stored(types: dict[str, str]) -> str:
    body = {c: t for c, t in types.items() if c not in PARTITION}
    return ddl({**body, "dt": "date", "store": "string"})


def _named(rows: DataFrame) -> DataFrame:
    place = F.col("_metadata.row_index").alias(ROW_INDEX)
    return rows.select("*", plain_path(F.col("_metadata.file_path")).alias(SOURCE_FILE), place)


def append_load(
    spark: SparkSession,
    source: str,
    target: LoadTarget,
    *,
    types: dict[str, str] = WIDE_TYPES,
    on_error: str = "skip_file",
    limit: int | None = None,
    max_files: int = 1000,
    clock: Callable[[int], datetime] | None = None,
    after_batch: Callable[[DataFrame, int], None] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start the load. Without ``every`` it takes what is there and stops.

    ``types`` are the types as stored in the files; rows are cast to the contract.
    ``after_batch`` gets the loaded rows of the batch as read back from the table.
    """
    at_time = clock or (lambda batch_id: utc_now())

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = _not_reloaded(session, batch, target)
        days = _load_batch(fresh, target, batch_id, at_time(batch_id), on_error, limit)
        if after_batch is not None:
            after_batch(read_versions(session, target, days).where(F.col(BATCH) == batch_id), batch_id)

    writer = (
        arrivals(spark, source, types, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", target.checkpoint)
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_versions(
    spark: SparkSession, target: LoadTarget, days: Iterable[date | None] | None = None
) -> DataFrame:
    """All live versions, or those of some days; only their folders are listed."""
    live = target.log(spark).live(VERSIONS, days)
    return read_folders(spark, target.table, live, ddl(STORED_VERSIONS)).select(*VERSIONED_TYPES, BATCH)


def read_history(spark: SparkSession, target: LoadTarget) -> DataFrame:
    live = target.log(spark).live(HISTORY)
    return read_folders(spark, target.history, live, ddl(STORED_HISTORY)).select(*STORED_HISTORY)


def _publish(
    rows: DataFrame, history: list[LiveFolder], target: LoadTarget, batch_id: int, at: datetime, again: bool
) -> list[date | None]:
    """Write a batch's rows and make them live with its history; returns the days whose rows it changed.

    ``again``: what is live under the batch's number goes with the same commit. Otherwise the
    number has to be free.
    """
    spark = rows.sparkSession
    numbered = F.lit(batch_id).cast("bigint").alias(BATCH)
    adds = write_attempt(rows.select(*VERSIONED_TYPES, numbered), target.table, VERSIONS, ["dt", BATCH])
    adds += history
    days = {a.dt for a in adds if a.part == VERSIONS}

    def own(live: Live) -> list[str]:
        taken = [f for f in live.values() if f.batch == batch_id]
        if taken and not again:
            raise CommitConflict(f"batch {batch_id} was loaded by another run")
        days.update(f.dt for f in taken if f.part == VERSIONS)
        return [f.folder for f in taken]

    target.log(spark).commit(adds, own, at)
    return list(days)


def _load_batch(
    rows: DataFrame,
    target: LoadTarget,
    batch_id: int,
    at: datetime,
    on_error: str,
    limit: int | None,
    again: bool = True,
) -> list[date | None]:
    """The history is written first: it has each file's errors, which decide what is loaded."""
    history = load_history(rows, at, on_error, limit)
    kept = write_attempt(history.withColumn(BATCH, F.lit(batch_id).cast("bigint")), target.history, HISTORY, [BATCH])
    errors = read_folders(rows.sparkSession, target.history, kept, ddl(STORED_HISTORY))
    loaded = stamp_load(load_on_error(rows, on_error, limit, errors=errors), at)
    return _publish(loaded, kept, target, batch_id, at, again)


def _not_reloaded(spark: SparkSession, batch: DataFrame, target: LoadTarget) -> DataFrame:
    """Leave out files that were loaded by hand before the stream got to them."""
    by_hand = read_history(spark, target).where(F.col(BATCH) < 0)
    return batch.join(by_hand.select(F.col("file_name").alias(SOURCE_FILE)).distinct(), SOURCE_FILE, "left_anti")


def reload_files(
    spark: SparkSession,
    source: str,
    target: LoadTarget,
    at: datetime,
    *,
    modified_after: datetime | None = None,
    types: dict[str, str] = WIDE_TYPES,
    on_error: str = "skip_file",
    limit: int | None = None,
) -> int:
    """Load what lies in the source but not in the history; returns the number of files.

    Loads by hand are numbered downwards from -1, apart from the stream's batches; two at the same
    time do not both succeed. Days come to the driver, names of files do not.
    """
    history = read_history(spark, target)
    missing = reload_missing(file_manifest(spark, source), history, modified_after)
    found = missing.groupBy(*PARTITION).agg(F.count("*").alias("files")).collect()
    if not found:
        return 0
    number = min([f.batch for f in target.log(spark).live(HISTORY)] + [0]) - 1
    stored = _named(read_partitions(spark, source, _stored(types), [(r.dt, r.store) for r in found]))
    names = missing.select(F.col("file_path").alias(SOURCE_FILE))
    _load_batch(stored.join(names, SOURCE_FILE, "left_semi"), target, number, at, on_error, limit, again=False)
    return sum(r.files for r in found)


def append_batch(
    spark: SparkSession, rows: DataFrame, target: LoadTarget, batch_id: int, at: datetime
) -> None:
    """Load a frame directly (first fill) as its own batch; loading it again replaces it."""
    stamped = stamp_load(rows, at) if LOADED_AT not in rows.columns else rows
    _publish(stamped, [], target, batch_id, at, again=True)
