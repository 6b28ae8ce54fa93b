"""Gold tables kept up to date by re-aggregating only the days a batch touched."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.gold import gold_daily_by_app, gold_daily_by_country, gold_trend_all_days
from ..sources.folders import children, day_folders, read_text, remove, write_new
from ..sources.tables import append_rows, overwrite_partitions, read_table
from .append_load import VERSIONS, LoadTarget, append_load, read_versions, utc_now

GOLD_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_by_app": gold_daily_by_app,
    "daily_by_country": gold_daily_by_country,
    "paid_vs_organic_trend": gold_trend_all_days,
}
# How far a table may lag behind, in minutes.
TARGET_LAG = {"daily_by_app": 30, "daily_by_country": 30, "paid_vs_organic_trend": 60}
REFRESH_DDL = (
    "name string, state string, refresh_action string, "
    "refresh_start_time timestamp, refresh_end_time timestamp, days bigint"
)


@dataclass(frozen=True)
class GoldTarget:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def history(self) -> str:
        return f"{self.root}/refresh_history"

    def state(self, name: str) -> str:
        return f"{self.root}/refresh_state/{name}"


def refresh(
    spark: SparkSession,
    versions: DataFrame,
    target: GoldTarget,
    days: list[date] | None = None,
    now: Callable[[], datetime] = utc_now,
) -> None:
    """Recompute the given days of every Gold table, or all days (a forced refresh).

    All rows of a day come from the versioned table again, so the result equals a full
    recompute, repeated versions and restated days included. Only the days' own folders are
    read and written.
    """
    if days == []:
        return
    detail = versions if days is None else versions.where(F.col("dt").isin(days))
    action, count = ("FULL", None) if days is None else ("INCREMENTAL", len(days))
    log = []
    try:
        for name, aggregate in GOLD_TABLES.items():
            started, state = now(), "FAILED"
            try:
                overwrite_partitions(aggregate(detail), target.path(name), ["dt"])
                state = "SUCCEEDED"
            finally:
                log.append((name, state, action, started, now(), count))
    finally:
        append_rows(spark.createDataFrame(log, REFRESH_DDL).coalesce(1), target.history)


def _seen(spark: SparkSession, target: GoldTarget, name: str) -> tuple[int, datetime | None]:
    """Version of the loads that a table was made from last, and when."""
    files = [e.name for e in children(spark, target.state(name)) if e.name.endswith(".json")]
    if not files:
        return -1, None
    held = json.loads(read_text(spark, f"{target.state(name)}/{files[-1]}"))
    return held["version"], datetime.fromisoformat(held["at"])


def refresh_due(
    spark: SparkSession,
    load: LoadTarget,
    target: GoldTarget,
    now: Callable[[], datetime] = utc_now,
    *,
    lag: dict[str, int] = TARGET_LAG,
) -> dict[str, int | None]:
    """Refresh each Gold table that has changes and whose own lag, in minutes, has run out.

    What changed is read off the commits since the version the table was made from: folders of
    these days alone are listed and read, however many batches brought them. A day that has no
    rows any more leaves the table. A refresh that died is made again, with the same result. Returns
    the days refreshed by table, None for all.
    """
    log, done = load.log(spark), {}
    for name, aggregate in GOLD_TABLES.items():
        version, at = _seen(spark, target, name)
        started = now()
        if at is not None and started < at + timedelta(minutes=lag.get(name, 0)):
            continue
        newest, days = log.changed_since(version, VERSIONS)
        if newest == version:
            continue
        live = {f.dt for f in log.live(VERSIONS)}
        state = "FAILED"
        try:
            if days is None or days:
                rows = read_versions(spark, load, days)
                overwrite_partitions(aggregate(rows), target.path(name), ["dt"])
                for day, folder in day_folders(spark, target.path(name)):
                    if day not in live and (days is None or day in days):
                        remove(spark, folder.path)
            text = json.dumps({"version": newest, "at": started.isoformat()})
            write_new(spark, f"{target.state(name)}/{newest + 1:012d}.json", text)
            state, done[name] = "SUCCEEDED", None if days is None else len(days)
        finally:
            action = "FULL" if days is None else "INCREMENTAL"
            entry = [(name, state, action, started, now(), None if days is None else len(days))]
            append_rows(spark.createDataFrame(entry, REFRESH_DDL).coalesce(1), target.history)
    return done


def load_and_refresh(
    spark: SparkSession, source: str, load: LoadTarget, gold: GoldTarget, *, forever: bool = False, **options
) -> StreamingQuery:
    """Append load with Gold kept up to date.

    ``forever`` looks for new files as often as the tightest target lag asks, and refreshes every
    table by its own lag; otherwise the stream takes what is there, refreshes and stops.
    """
    every = f"{min(TARGET_LAG.values())} minutes" if forever else None
    clock = options.get("clock") or (lambda batch_id: utc_now())

    def hook(batch: DataFrame, batch_id: int) -> None:
        lag = TARGET_LAG if forever else {}
        refresh_due(batch.sparkSession, load, gold, lambda: clock(batch_id), lag=lag)

    return append_load(spark, source, load, after_batch=hook, every=every, **options)


def read_refreshes(spark: SparkSession, target: GoldTarget) -> DataFrame:
    return read_table(spark, target.history, REFRESH_DDL)
