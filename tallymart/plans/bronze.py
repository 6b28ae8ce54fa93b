"""Drop folder to Bronze, for all partitions that need it in one job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import DROP_TYPES, NARROW_KEY, PARTITION, WINDOWS, ddl
from ..functions.stamps import utc_stamp
from ..operators.cleaning import (
    cast_contract,
    dedup_pk,
    newest_first,
    schema_gate,
    stamp_ingest,
    trim_strings,
)
from ..operators.evolution import evolution_problems, settle, undeclared
from ..operators.ledger import (
    FILE_LEDGER_TYPES,
    empty_partitions,
    file_rows,
    ledger_rows,
    restate_detect,
)
from ..operators.quarantine import (
    FILE_ID,
    PROCESSING_ERROR,
    QUARANTINED_TYPES,
    SCHEMA_MISMATCH,
    error_records,
    file_id,
)
from ..sources.drop import SOURCE_FILE, SOURCE_MTIME, backfill_range, partition_window, scan_drop, with_source
from ..sources.footers import UNREADABLE, write_footers
from ..sources.manifest import file_manifest, folder_value, odd_folders, plain_path
from ..sources.tables import append_rows, in_partitions, overwrite_partitions, read_table
from .layout import (
    ALERT_TYPES,
    Layout,
    append_log,
    known_columns,
    layer_state,
    read_bronze,
    record_failure,
    register,
    seen_files,
)

LAYER = "bronze"


@dataclass(frozen=True)
class BronzeRun:
    run_id: str
    at: datetime
    as_of: date
    backfill: bool = False
    target_dt: date | None = None
    target_store: str | None = None
    lookback_days: int = WINDOWS.lookback_days
    by_content: bool = False
    #: First and last day of a backfill; every partition in it is taken.
    days: tuple[date, date] | None = None

    def wants(self, day: date) -> bool:
        """Whether a day's folder has to be listed at all."""
        if self.days is not None:
            return self.days[0] <= day <= self.days[1]
        if self.target_dt is not None:
            return day == self.target_dt
        return self.backfill or day >= self.as_of - timedelta(days=self.lookback_days)

    def window(self, rows: DataFrame) -> DataFrame:
        if self.days is not None:
            rows = backfill_range(rows, *self.days)
            return rows if self.target_store is None else rows.where(F.col("store") == self.target_store)
        return partition_window(
            rows,
            self.as_of,
            target_dt=self.target_dt,
            target_store=self.target_store,
            backfill=self.backfill,
            lookback_days=self.lookback_days,
        )


def clean(
    raw: DataFrame, at: datetime, types: dict[str, str], order: list[Column] | None = None
) -> DataFrame:
    """Cast, trim and stamp in one projection, then one row per key and folder."""
    stamped = stamp_ingest(trim_strings(cast_contract(raw, types)), at)
    ranked = order or newest_first(stamped, SOURCE_MTIME, SOURCE_FILE)
    return dedup_pk(stamped, ranked, [*NARROW_KEY, "store"])


def _keys(rows: DataFrame) -> list[tuple]:
    # One entry per partition of the run, never per row or file.
    return [(row.dt, row.store) for row in rows.select(*PARTITION).collect()]


def _count(rows: DataFrame, name: str) -> DataFrame:
    # Grouping by folder columns alone reads footers, no column data.
    return rows.groupBy(*PARTITION).agg(F.count("*").alias(name))


def _list_files(spark: SparkSession, layout: Layout, run: BronzeRun) -> DataFrame:
    """List the run's days once and keep the list: files may arrive while the run works, and what
    the ledger records must be what the decision was made from."""
    listed = run.window(file_manifest(spark, layout.drop, by_content=run.by_content, wanted=run.wants))
    path = layout.staging(run.run_id, "files")
    rows = file_rows(listed, LAYER, run.run_id, run.at, "modified_at")
    rows.hint("rebalance").write.mode("overwrite").parquet(path)
    return read_table(spark, path, ddl({**FILE_LEDGER_TYPES, "modified_at": "timestamp"}))


def _report_odd_folders(spark: SparkSession, layout: Layout, run: BronzeRun) -> None:
    """A folder that stands for no day is never read; its name goes to the error records."""
    odd = odd_folders(spark, layout.drop)
    if odd:
        found = spark.createDataFrame([(None, None, path) for path in odd], "dt date, store string, path string")
        message = F.lit("the folder's name is no day")
        append_rows(error_records(found, PROCESSING_ERROR, message, F.col("path"), run.run_id, run.at), layout.errors, ["failed_at"])


def bronze_build(
    spark: SparkSession,
    layout: Layout,
    run: BronzeRun,
    *,
    types: dict[str, str] = DROP_TYPES,
    extra: dict[str, str] | None = None,
    order: list[Column] | None = None,
) -> None:
    """Process what is new, failed before or changed; reject what breaks the contract.

    A backfill takes every partition of its window. Columns beyond the contract are kept: all
    files are read with the union of their columns, and a file that cannot be read as the type the
    others agree on rejects its partition. ``extra`` declares types of such columns beforehand.
    ``order`` decides which of several rows of a key stays; by default the newest file's.
    """
    _report_odd_folders(spark, layout, run)
    listed = _list_files(spark, layout, run)
    decision = restate_detect(
        listed,
        run.window(layer_state(spark, layout, LAYER, run.wants)),
        run.window(seen_files(spark, layout, LAYER, run.wants)),
        run.at,
    )
    wanted = F.col("reason") != "locked" if run.backfill or run.days else F.col("needs_work")
    todo = _keys(decision.where(wanted))
    if not todo:
        return
    files = listed.where(in_partitions(todo))
    append_log(files.select(*FILE_LEDGER_TYPES), layout.file_ledger)
    todo_frame = spark.createDataFrame(todo, "dt date, store string")
    append_log(ledger_rows(todo_frame, LAYER, "running", run.run_id, run.at), layout.ledger)

    try:
        # Each footer is opened once; the gate and the quarantine both need them.
        footers = write_footers(files, layout.staging(run.run_id, "footers"))
        found = undeclared(footers, types).collect()  # one row per undeclared column and type
        known = {**known_columns(spark, layout), **(extra or {})}
        settled = settle([(r.column_name, r.column_type, r.files) for r in found], known)
        verdicts = schema_gate(footers, types, evolution_problems(footers, settled)).collect()  # one row per partition
    except Exception as error:
        record_failure(spark, layout, LAYER, PROCESSING_ERROR, todo, error, run.run_id, run.at)
        raise
    good = [(v.dt, v.store) for v in verdicts if v.error_message is None]
    bad = [
        (v.dt, v.store, v.error_message, PROCESSING_ERROR if v.unreadable_files else SCHEMA_MISMATCH)
        for v in verdicts
        if v.error_message is not None
    ]
    if bad:
        _reject(spark, layout, run, bad, files, footers)
    if good:
        try:
            here = {r.column_name.lower() for r in found} | {c.lower() for c in extra or {}}
            further = {c: t for c, t in settled.items() if c.lower() in here}
            _remember(spark, layout, run, {c: t for c, t in further.items() if known.get(c) != t or c in (extra or {})})
            _write_good(spark, layout, run, good, files, {**types, **further}, order)
        except Exception as error:
            record_failure(spark, layout, LAYER, PROCESSING_ERROR, good, error, run.run_id, run.at)
            raise


def _remember(spark: SparkSession, layout: Layout, run: BronzeRun, columns: dict[str, str]) -> None:
    if columns:
        rows = spark.createDataFrame(list(columns.items()), "column_name string, column_type string")
        stamped = rows.select("*", F.lit(run.run_id).alias("job_run_id"), utc_stamp(run.at).alias("recorded_at"))
        append_rows(stamped.coalesce(1), layout.columns)


def _write_good(spark, layout, run, good, files, types, order) -> None:
    raw = scan_drop(spark, layout.drop, types, good)
    cleaned = clean(with_source(raw), run.at, types, order).drop(SOURCE_FILE, SOURCE_MTIME)
    overwrite_partitions(cleaned, layout.bronze)
    register(spark, layout, layout.bronze_table, layout.bronze, dict(cleaned.dtypes), good, run.at)

    taken = _count(raw, "in_count")
    written = _count(read_bronze(spark, layout, good), "out_count")
    empty = empty_partitions(files.where(in_partitions(good)), taken)
    counts = taken.join(written, PARTITION).unionByName(empty.drop("status"))
    append_log(ledger_rows(counts, LAYER, "succeeded", run.run_id, run.at), layout.ledger)


def _reject(spark, layout, run, bad, files, footers) -> None:
    """Keep rows, reasons, ledger entries and alerts of rejected partitions."""
    reasons = spark.createDataFrame(
        bad, "dt date, store string, error_message string, error_type string"
    )
    held = in_partitions([(dt, store) for dt, store, *_ in bad])
    rejected = files.where(held)
    errors = error_records(
        rejected.join(reasons, PARTITION),
        F.col("error_type"),
        F.col("error_message"),
        F.col("file_path"),
        run.run_id,
        run.at,
    )
    append_rows(errors, layout.errors, ["failed_at"])
    counts = quarantine_files(spark, layout, run, rejected, footers.where(held))
    append_log(ledger_rows(counts, LAYER, "failed", run.run_id, run.at), layout.ledger)
    place = F.concat_ws("/", F.date_format("dt", "yyyy-MM-dd"), "store")
    subject = F.concat(F.lit("Daily counters: contract broken "), place)
    alerts = reasons.select(
        F.col("dt").alias("partition_dt"),
        "store",
        F.substring(subject, 1, 100).alias("subject"),
        F.col("error_message").alias("message"),
        utc_stamp(run.at).alias("raised_at"),
    )
    append_rows(alerts.select(*ALERT_TYPES), layout.alerts)


def quarantine_files(
    spark: SparkSession, layout: Layout, run: BronzeRun, rejected: DataFrame, footers: DataFrame
) -> DataFrame:
    """Copy the rows of rejected files, each file to a folder of its own below the run that rejected it.

    Files with equal columns and types are read together: there are as many reads as different
    signatures, and what comes to the driver are the names of rejected files. Tasks write what
    they read, so nothing is shuffled and a large file is written by several. The index has one
    row per file; a retry of the run replaces its rows and its index. Returns rows and files per partition.
    """
    column = F.concat_ws(":", "column_name", "column_type")
    # The prefix keeps a folder name from being read as a number.
    columns = F.concat_ws(",", F.sort_array(F.collect_list(column)))
    signature = F.concat(F.lit("columns-"), F.md5(columns))
    # The rows of an unreadable file cannot be copied; its error record names it.
    readable = footers.where(F.col("column_name") != UNREADABLE)
    signed = readable.groupBy("file_path").agg(signature.alias("signature"))
    groups: dict[str, list[str]] = {}
    for row in signed.collect():
        groups.setdefault(row.signature, []).append(row.file_path)
    root = f"{layout.quarantine}/raw/failed_at={run.at:%Y-%m-%d}/job_run_id={run.run_id}"
    for name, paths in groups.items():
        rows = with_source(spark.read.option("basePath", layout.drop).parquet(*paths)).drop(SOURCE_MTIME)
        kept = rows.withColumn(SOURCE_FILE, plain_path(F.col(SOURCE_FILE))).withColumn(FILE_ID, file_id(F.col(SOURCE_FILE)))
        day = folder_value(F.col(SOURCE_FILE), "dt").try_cast("date")
        kept = kept.withColumn("dt", day).withColumn("store", folder_value(F.col(SOURCE_FILE), "store"))
        kept.write.mode("overwrite").partitionBy(*PARTITION, FILE_ID).parquet(f"{root}/signature={name}")
    # Only folder columns are read back, so differing signatures do not matter.
    folders = f"signature string, dt date, store string, {FILE_ID} string"
    copied = spark.createDataFrame([], folders)
    if groups:
        stored = spark.read.schema(folders).option("basePath", root)
        copied = stored.parquet(*[f"{root}/signature={name}" for name in groups])
    counted = copied.groupBy(FILE_ID).agg(F.count("*").alias("row_count"))
    index = (
        rejected.join(signed, "file_path", "left")
        .withColumn(FILE_ID, file_id(F.col("file_path")))
        .join(counted, FILE_ID, "left")
        .select(
            F.lit(run.at.date()).alias("failed_at"),
            F.lit(run.run_id).alias("job_run_id"),
            *PARTITION,
            F.col("file_path").alias("source_file"),
            "fingerprint",
            "modified_at",
            "signature",
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        )
    )
    overwrite_partitions(index, layout.quarantine_index, ["failed_at", "job_run_id"])
    stored = read_table(spark, layout.quarantine_index, ddl(QUARANTINED_TYPES))
    own = stored.where((F.col("failed_at") == F.lit(run.at.date())) & (F.col("job_run_id") == run.run_id))
    return own.groupBy(*PARTITION).agg(
        F.count("*").alias("dlq_files"), F.sum("row_count").alias("dlq_rows"), F.sum("row_count").alias("in_count")
    )
