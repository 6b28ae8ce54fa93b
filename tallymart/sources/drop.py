"""Reading the drop folder (``dt=…/store=…``) and choosing partitions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import DROP_TYPES, PARTITION, WINDOWS, ddl
from .tables import read_partitions

CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
SOURCE_MTIME = "_source_mtime"


def _layout(root: str) -> str:
    # Folders lacking either level do not match and are skipped.
    return f"{root}/dt=*/store=*"


def scan_drop(
    spark: SparkSession,
    root: str,
    types: dict[str, str] = DROP_TYPES,
    keys: list[tuple] | None = None,
) -> DataFrame:
    """One scan over every partition of a Parquet drop folder, or over the given ones.

    ``dt`` and ``store`` come from the path, so filters on them prune folders before any
    file is opened.
    """
    body = {c: t for c, t in types.items() if c not in PARTITION}
    schema = ddl({**body, "dt": "date", "store": "string"})
    if keys is not None:
        return read_partitions(spark, root, schema, keys)
    return spark.read.schema(schema).option("basePath", root).parquet(_layout(root))


def scan_drop_csv(spark: SparkSession, root: str, types: dict[str, str] = DROP_TYPES) -> DataFrame:
    """Same contract from (gzip) CSV; unparsable rows keep their text.

    The header must name the contract's columns in order, else the scan fails.
    A gzip file is one task whatever its size, so its rows are spread out before the
    first wide step uses them.
    """
    body = {c: t for c, t in types.items() if c not in PARTITION}
    schema = ddl({**body, CORRUPT: "string", "dt": "date", "store": "string"})
    rows = (
        spark.read.schema(schema)
        .option("basePath", root)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(_layout(root))
    )
    return rows.hint("rebalance")


def with_source(rows: DataFrame) -> DataFrame:
    """Add the file a row came from and that file's modification time."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(SOURCE_MTIME),
    )


def partition_window(
    rows: DataFrame,
    as_of: date,
    *,
    target_dt: date | None = None,
    target_store: str | None = None,
    backfill: bool = False,
    lookback_days: int = WINDOWS.lookback_days,
) -> DataFrame:
    """Partitions one run looks at: the target day, or the days since the cutoff.

    The cutoff day itself is included. A backfill or a target day ignores the cutoff.
    """
    if target_dt is not None:
        rows = rows.where(F.col("dt") == F.lit(target_dt))
    elif not backfill:
        rows = rows.where(F.col("dt") >= F.lit(as_of - timedelta(days=lookback_days)))
    if target_store is not None:
        rows = rows.where(F.col("store") == target_store)
    return rows


def backfill_range(rows: DataFrame, start: date, end: date) -> DataFrame:
    """Every day of [start, end], whatever the run ledger says about it."""
    if end < start:
        raise ValueError(f"backfill end {end} lies before start {start}")
    return rows.where(F.col("dt").between(F.lit(start), F.lit(end)))
