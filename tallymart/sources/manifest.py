"""File manifests: one row per file, read as a table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stamps import utc_stamp
from .folders import DEFAULT_FOLDER, day_folders


def plain_path(path: Column) -> Column:
    """One spelling for local files, which appear as ``file:/`` and as ``file:///``."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def folder_value(path: Column, name: str) -> Column:
    """A partition value as text from a file's path: never read as a number, null from the default folder."""
    raw = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
    value = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when((raw != "") & (raw != DEFAULT_FOLDER), value)


#: Bytes up to which a file is hashed; Spark reads content no further than 2 GiB.
MOST_HASHED = (1 << 31) - (1 << 16)
MANIFEST = "dt date, store string, file_path string, file_bytes bigint, modified_at timestamp, fingerprint string"


def file_manifest(
    spark: SparkSession,
    root: str,
    *,
    by_content: bool = False,
    modified_after: datetime | None = None,
    wanted: Callable[[date], bool] | None = None,
) -> DataFrame:
    """``dt, store, file_path, file_bytes, modified_at, fingerprint`` of a drop folder.

    Only folders of ``wanted`` days are listed, under the names they have: ``dt=2024-1-3`` is the
    third of January too. A folder whose day is no date is no partition (see ``odd_folders``).

    The default fingerprint is size and modification time; no file is opened for it.
    ``by_content`` hashes the bytes of files up to 2 GiB; larger ones keep size and time.
    """
    paths = [e.path for day, e in day_folders(spark, root) if day is not None and (wanted is None or wanted(day))]
    if not paths:
        return spark.createDataFrame([], MANIFEST)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if modified_after is not None:
        files = files.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    by_stat = F.concat_ws(":", F.col("length"), F.unix_micros("modificationTime"))

    def described(listed: DataFrame, fingerprint: Column) -> DataFrame:
        day = F.regexp_replace(folder_value(F.col("path"), "dt"), "^ +| +$", "")
        return listed.where(F.col("path").rlike("/dt=[^/]*/store=[^/]*/")).select(
            day.try_cast("date").alias("dt"),
            folder_value(F.col("path"), "store").alias("store"),
            plain_path(F.col("path")).alias("file_path"),
            F.col("length").alias("file_bytes"),
            F.col("modificationTime").alias("modified_at"),
            fingerprint.alias("fingerprint"),
        )

    listed = files.load(paths)
    if not by_content:
        return described(listed, by_stat)
    # The size is looked at before a file is opened.
    small, large = listed.where(F.col("length") <= MOST_HASHED), listed.where(F.col("length") > MOST_HASHED)
    return described(small, F.md5("content")).unionByName(described(large, by_stat))


def odd_folders(spark: SparkSession, root: str) -> list[str]:
    """Folders ``dt=…`` whose name is no day; nothing below them is ever read."""
    return [e.path for day, e in day_folders(spark, root) if day is None and e.name != f"dt={DEFAULT_FOLDER}"]


def pending_files(manifest: DataFrame, history: DataFrame) -> DataFrame:
    """Files present but not in the load history, by name."""
    done = history.select(F.col("file_name").alias("file_path")).distinct()
    return manifest.join(done, "file_path", "left_anti")


def reload_missing(
    manifest: DataFrame, history: DataFrame, modified_after: datetime | None = None
) -> DataFrame:
    """Files a catch-up load has to take; files loaded before are never taken again."""
    todo = pending_files(manifest, history)
    if modified_after is not None:
        todo = todo.where(F.col("modified_at") > utc_stamp(modified_after))
    return todo
