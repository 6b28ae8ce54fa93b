"""Folders of one deployment, all below a root every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..contracts import NARROW_TYPES, WIDE_TYPES, ddl
from ..functions.stamps import utc_stamp
from ..operators.evolution import SEEN_TYPES
from ..operators.ledger import FILE_LEDGER_TYPES, LEDGER_TYPES, ledger_rows, previous_files, run_ledger
from ..operators.quarantine import ERROR_TYPES, error_records
from ..sources.folders import children, day_folders, remove
from ..sources.tables import add_partitions, append_rows, read_partitions, read_table

ALERT_TYPES = {
    "partition_dt": "date",
    "store": "string",
    "subject": "string",
    "message": "string",
    "raised_at": "timestamp",
}


@dataclass(frozen=True)
class Layout:
    """Folders below one root. With table names given, every write also enters its partitions in the catalog."""

    root: str
    bronze_table: str | None = None
    silver_table: str | None = None

    @property
    def drop(self) -> str:
        return f"{self.root}/drop"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def file_ledger(self) -> str:
        return f"{self.root}/file_ledger"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def errors(self) -> str:
        return f"{self.root}/errors"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def replays(self) -> str:
        return f"{self.root}/replays"

    @property
    def quarantine_index(self) -> str:
        return f"{self.quarantine}/files"

    @property
    def columns(self) -> str:
        return f"{self.root}/bronze_columns"

    @property
    def dq(self) -> str:
        return f"{self.root}/dq_results"

    def staging(self, run_id: str, step: str) -> str:
        return f"{self.root}/staging/{step}-{run_id}"


def read_or_empty(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """A log that nothing was written to yet reads as empty."""
    try:
        return read_table(spark, path, ddl(types))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], ddl(types))


LOG_FOLDERS = ["layer", "dt"]


def append_log(rows: DataFrame, path: str) -> None:
    """Append to the run or file ledger: a folder per layer and day."""
    append_rows(rows, path, LOG_FOLDERS)


def log_folders(spark: SparkSession, path: str, layer: str | None, wants: Callable[[date], bool] | None) -> list[str]:
    layers = [e for e in children(spark, path) if e.name == f"layer={layer}" or layer is None and e.name.startswith("layer=")]
    days = [found for e in layers for found in day_folders(spark, e.path)]
    return [e.path for day, e in days if day is None or wants is None or wants(day)]


def read_log(
    spark: SparkSession, path: str, types: dict[str, str], layer: str | None = None, wants: Callable[[date], bool] | None = None
) -> DataFrame:
    """Entries of a ledger; only folders of the layer and of the days asked for are listed."""
    found = log_folders(spark, path, layer, wants)
    if not found:
        return spark.createDataFrame([], ddl(types))
    return spark.read.schema(ddl(types)).option("basePath", path).parquet(*found).select(*types)


def ledger_state(
    spark: SparkSession, layout: Layout, layer: str | None = None, wants: Callable[[date], bool] | None = None
) -> DataFrame:
    """Newest entry of each partition, whether it was folded already or not."""
    return run_ledger(read_log(spark, layout.ledger, LEDGER_TYPES, layer, wants))


def layer_state(spark: SparkSession, layout: Layout, layer: str, wants: Callable[[date], bool] | None = None) -> DataFrame:
    return ledger_state(spark, layout, layer, wants)


def seen_files(spark: SparkSession, layout: Layout, layer: str, wants: Callable[[date], bool] | None = None) -> DataFrame:
    files = read_log(spark, layout.file_ledger, FILE_LEDGER_TYPES, layer, wants)
    return previous_files(files, layer_state(spark, layout, layer, wants))


def fold_ledgers(spark: SparkSession, layout: Layout, before: date) -> int:
    """Sum up the ledgers of days before a day: newest entries, and the files these were made from.

    The sum is added to a day's folder before the entries it stands for are deleted. Both may be
    there after a crash: the newest entry counts, so they say the same, and the next fold goes on.
    Runs that still work on such days have to end first. Returns the number of files deleted.
    """
    def old(day: date) -> bool:
        return day < before

    def files(path: str) -> list[str]:
        found = log_folders(spark, path, None, old)
        per_day = [[e.path for e in children(spark, f) if e.name.endswith(".parquet")] for f in found]
        return [name for day in per_day if len(day) > 1 for name in day]

    def read(paths: list[str], root: str, types: dict[str, str]) -> DataFrame:
        return spark.read.schema(ddl(types)).option("basePath", root).parquet(*paths).select(*types)

    gone = 0
    state = ledger_state(spark, layout, wants=old)
    # The file ledger first: it is cut by the state that is still there in full.
    for root, types in ((layout.file_ledger, FILE_LEDGER_TYPES), (layout.ledger, LEDGER_TYPES)):
        names = files(root)
        if not names:
            continue
        entries = read(names, root, types)
        kept = run_ledger(entries) if types is LEDGER_TYPES else previous_files(entries, state).distinct()
        path = layout.staging(uuid.uuid4().hex[:12], "fold")
        kept.write.parquet(path)
        append_log(read_table(spark, path, ddl(types)).repartition(*LOG_FOLDERS), root)
        for name in names:
            gone += remove(spark, name)
    return gone


STORED_NARROW = {**NARROW_TYPES, "store": "string"}


def known_columns(spark: SparkSession, layout: Layout) -> dict[str, str]:
    """Columns beyond the contract that Bronze holds, as the newest run settled them."""
    log = read_or_empty(spark, layout.columns, SEEN_TYPES)
    newest = log.groupBy("column_name").agg(F.max_by("column_type", F.struct("recorded_at", "job_run_id")).alias("t"))
    return {row.column_name: row.t for row in newest.orderBy("column_name").collect()}


def read_bronze(
    spark: SparkSession, layout: Layout, keys: list[tuple] | None = None, *, every_column: bool = False
) -> DataFrame:
    """The contract's columns, or ``every_column`` that was delivered."""
    stored = ddl({**(known_columns(spark, layout) if every_column else {}), **STORED_NARROW})
    if keys is not None:
        return read_partitions(spark, layout.bronze, stored, keys)
    return read_table(spark, layout.bronze, stored)


def read_silver(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout.silver, ddl({**WIDE_TYPES, "store": "string"}))


def record_failure(
    spark: SparkSession,
    layout: Layout,
    layer: str,
    error_type: str,
    keys: list[tuple],
    error: Exception,
    run_id: str,
    at: datetime,
) -> None:
    """Mark all partitions of a step that raised as failed, so that the next run takes them."""
    failed = spark.createDataFrame(keys, "dt date, store string")
    message = F.lit(str(error))
    source = F.concat_ws("/", F.lit(layer), "store")
    append_rows(error_records(failed, error_type, message, source, run_id, at), layout.errors, ["failed_at"])
    append_log(ledger_rows(failed, layer, "failed", run_id, at), layout.ledger)
    alerts = failed.select(
        F.col("dt").alias("partition_dt"),
        "store",
        F.lit(f"Daily counters: {layer} failed"[:100]).alias("subject"),
        message.alias("message"),
        utc_stamp(at).alias("raised_at"),
    )
    append_rows(alerts.select(*ALERT_TYPES), layout.alerts)


def read_errors(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_or_empty(spark, layout.errors, ERROR_TYPES)


def register(
    spark: SparkSession,
    layout: Layout,
    name: str | None,
    path: str,
    types: dict[str, str],
    keys: list[tuple],
    at: datetime,
) -> None:
    """Enter the partitions of a finished write in the catalog, where the layout names a table.

    The data are published already. A catalog that fails leaves an alert and stops nothing.
    """
    if name is None or not keys:
        return
    try:
        add_partitions(spark, name, path, types, keys)
    except Exception as error:  # whatever the catalog raises
        alert = spark.createDataFrame([(None, None)], "partition_dt date, store string").select(
            "partition_dt",
            "store",
            F.lit(f"Daily counters: {name} not registered"[:100]).alias("subject"),
            F.lit(str(error)[:4000]).alias("message"),
            utc_stamp(at).alias("raised_at"),
        )
        append_rows(alert.select(*ALERT_TYPES), layout.alerts)
