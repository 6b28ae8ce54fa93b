"""Gold aggregates over the versioned table, and their refresh history."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import LEAVES, WINDOWS
from ..functions import safe_ratio
from ..functions.stamps import utc_stamp
from .cleaning import keep_first
from .versions import latest_view

TOTALS = ["downloads_total", "downloads_featured", "downloads_organic"]


def _sums(columns: list[str]):
    return [F.sum(c).alias(c) for c in columns]


def _mean(column: str):
    # The plain mean of the rows' shares, not weighted by downloads. The decimal sum is exact,
    # so the mean does not depend on the order in which tasks finish.
    return safe_ratio(F.sum(column), F.count(column)).alias(f"avg_{column}")


def gold_daily_by_app(versions: DataFrame, dedup: bool = False) -> DataFrame:
    """Per day, product and store. Repeated versions count repeatedly unless ``dedup``."""
    rows = latest_view(versions) if dedup else versions
    return rows.groupBy("dt", "product_id", "app_store").agg(
        *_sums(TOTALS), _mean("paid_share"), _mean("featured_share"), F.count("*").alias("row_count")
    )


def gold_daily_by_country(versions: DataFrame, dedup: bool = False) -> DataFrame:
    rows = latest_view(versions) if dedup else versions
    return rows.groupBy("dt", "country", "app_store").agg(*_sums(TOTALS), F.count("*").alias("row_count"))


def gold_trend_all_days(versions: DataFrame, dedup: bool = False) -> DataFrame:
    """Sums and ratios per day and store for all days; cut to a window when read."""
    rows = latest_view(versions) if dedup else versions
    sums = rows.groupBy("dt", "app_store").agg(*_sums(TOTALS + LEAVES))
    paid = F.col("downloads_paid_featured") + F.col("downloads_paid_organic")
    total = F.col("downloads_total")
    return sums.select(
        "*",
        F.round(safe_ratio(paid, total), 6).alias("paid_ratio"),
        F.round(safe_ratio(F.col("downloads_featured"), total), 6).alias("featured_ratio"),
    )


def trend_window(rows: DataFrame, as_of: date, days: int = WINDOWS.trend_days) -> DataFrame:
    return rows.where(F.col("dt") >= F.lit(as_of - timedelta(days=days)))


def gold_paid_vs_organic_trend(versions: DataFrame, as_of: date, dedup: bool = False) -> DataFrame:
    """The trailing window, cut before the aggregate so that older days are not read."""
    return gold_trend_all_days(trend_window(versions, as_of), dedup)


def refresh_history(entries: DataFrame) -> DataFrame:
    """Newest refresh per table; one that never ended sorts last."""
    newest = [F.col("refresh_end_time").desc_nulls_last(), F.col("refresh_start_time").desc()]
    return keep_first(entries, ["name"], newest)


def gold_staleness(entries: DataFrame, now: datetime, limit_minutes: int = 60) -> DataFrame:
    """Tables whose newest refresh never ended or ended too long ago."""
    age = F.expr(f"timestampdiff(MINUTE, refresh_end_time, TIMESTAMP '{now:%Y-%m-%d %H:%M:%S}')")
    stale = F.col("refresh_end_time").isNull() | (age > limit_minutes)
    return (
        refresh_history(entries)
        .select("name", "state", "refresh_start_time", "refresh_end_time", F.coalesce(stale, F.lit(True)).alias("is_stale"))
        .orderBy(F.col("is_stale").desc(), "name")
    )


def refresh_failures(entries: DataFrame, now: datetime, hours: int = 1) -> DataFrame:
    since = utc_stamp(now - timedelta(hours=hours))
    return entries.where((F.col("state") == "FAILED") & (F.col("refresh_start_time") >= since))

