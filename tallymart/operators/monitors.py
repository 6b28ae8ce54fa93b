"""Monitors: queries over ledgers and manifests whose rows are what to look at."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import PARTITION, STORES
from ..functions.stamps import utc_stamp
from .gold import refresh_failures


def expected_partitions(
    spark: SparkSession, first: date, last: date, stores: list[str] = STORES
) -> DataFrame:
    days = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1).select(F.explode(days).alias("dt")).select(
        "dt", F.explode(F.array(*[F.lit(s) for s in stores])).alias("store")
    )


def mon_missing_partitions(
    manifest: DataFrame, check_day: date, days: int = 1, stores: list[str] = STORES
) -> DataFrame:
    """Store and day without any file, for ``days`` days ending at ``check_day``."""
    expected = expected_partitions(
        manifest.sparkSession, check_day - timedelta(days=days - 1), check_day, stores
    )
    return expected.join(manifest.select(*PARTITION).distinct(), PARTITION, "left_anti")


def mon_stale_runs(state: DataFrame, now: datetime) -> DataFrame:
    """Runs still marked running after their lock ran out."""
    dead = (F.col("status") == "running") & (F.col("lock_expires_at") < utc_stamp(now))
    return state.where(dead).select("layer", *PARTITION, "job_run_id", "recorded_at", "lock_expires_at")


def mon_dlq_weekly(errors: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    """Error records of the last days by type. Unreadable ones count as ``READ_ERROR``.

    ``errors`` may carry ``readable``; without it every record counts as read.
    """
    readable = F.col("readable") if "readable" in errors.columns else F.lit(True)
    kind = F.when(~readable, "READ_ERROR").otherwise(F.coalesce("error_type", F.lit("UNKNOWN")))
    return (
        errors.where(F.col("recorded_at") >= utc_stamp(now - timedelta(days=days)))
        .groupBy(kind.alias("error_type"))
        .agg(F.count("*").alias("records"), F.max("recorded_at").alias("last_seen"))
        .orderBy(F.col("records").desc(), "error_type")
    )


def mon_dlq_entries(entries: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    """All that was put into quarantine in the last days: raw files, blocked wide partitions and
    error records by kind, with the rows behind them and the runs that put them there."""
    since = (now - timedelta(days=days)).date()
    return (
        entries.where(F.col("failed_at") >= F.lit(since))
        .groupBy("kind")
        .agg(
            F.count("*").alias("entries"),
            F.sum("row_count").alias("rows_held"),
            F.count_distinct("job_run_id").alias("runs"),
            F.max("failed_at").alias("last_failed"),
        )
    )


def mon_dlq_recent(errors: DataFrame, now: datetime, days: int = 7, top: int = 20) -> DataFrame:
    """The newest records for the weekly report; ``more`` says how many it leaves out."""
    recent = errors.where(F.col("recorded_at") >= utc_stamp(now - timedelta(days=days)))
    total = recent.agg(F.count("*")).scalar()
    first = recent.orderBy(F.col("recorded_at").desc(), "source_file", "error_type").limit(top)
    return first.select(
        "error_type", "source_file", "recorded_at", F.greatest(total - top, F.lit(0)).alias("more")
    )


def mon_load_freshness(history: DataFrame, today: date) -> DataFrame:
    """One row when nothing was loaded on ``today`` (UTC), none otherwise."""
    loads = history.where(F.to_date("last_load_time") == F.lit(today))
    return loads.agg(F.count("*").alias("loads_today")).where("loads_today = 0").select(
        F.lit(today).alias("day"), "loads_today"
    )


def mon_refresh_failed(refreshes: DataFrame, now: datetime) -> DataFrame:
    return refresh_failures(refreshes, now)


def mon_load_errors(history: DataFrame) -> DataFrame:
    return history.where(F.col("status") != "Loaded")


def load_history_window(history: DataFrame, now: datetime, hours: int = 12) -> DataFrame:
    """Files loaded in the last hours, newest first."""
    since = utc_stamp(now - timedelta(hours=hours))
    return history.where(F.col("last_load_time") >= since).orderBy(
        F.col("last_load_time").desc(), "file_name"
    )


def load_history_by_day(history: DataFrame) -> DataFrame:
    return (
        history.groupBy(F.to_date("last_load_time").alias("load_day"))
        .agg(F.count("*").alias("files_loaded"), F.sum("row_count").alias("rows_loaded"))
        .orderBy("load_day")
    )




def mon_key_skew(rows: DataFrame, key: list[str], factor: int = 10) -> DataFrame:
    """Largest against median rows per key value; suspicious from ``factor`` times on.

    The median is taken over the histogram of counts, which stays small however many keys
    there are.
    """
    per_key = rows.groupBy(*key).agg(F.count("*").alias("n"))
    histogram = per_key.groupBy("n").agg(F.count("*").alias("keys"))
    summary = histogram.agg(
        F.sum("keys").alias("keys"),
        F.max("n").alias("max_rows"),
        F.expr("percentile(n, 0.5, keys)").alias("median_rows"),
    )
    return summary.select("*", (F.col("max_rows") >= factor * F.col("median_rows")).alias("suspicious"))
