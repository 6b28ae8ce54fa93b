"""Partitioned Parquet tables: overwrite by partition, append, register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import PARTITION
from .folders import DEFAULT_FOLDER, day_folders


def overwrite_partitions(rows: DataFrame, path: str, by: list[str] = PARTITION) -> None:
    """Replace exactly the partitions present in ``rows``; leave all others alone.

    The rebalance hint gathers a partition into files of the advisory size and splits a
    partition that is too big for one task, so one hot day or store does not end up in one
    writer. Running the same input twice leaves the same table.
    """
    (
        rows.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def append_rows(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Append to a log-like table. Small record tables stay unpartitioned."""
    writer = rows.write.mode("append").option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read with a declared schema: no footer is inspected to plan the query."""
    return spark.read.schema(schema).parquet(path)


def in_partitions(keys: list[tuple]) -> Column:
    """Filter on folders from a list of (dt, store): pruned before any file is opened.

    Stores wanted for the same days are one condition, and conditions are joined as a balanced
    tree, so the filter stays shallow for any number of keys.
    """
    days_of: dict[str | None, set] = {}
    for dt, store in keys:
        days_of.setdefault(store, set()).add(dt)
    stores_of: dict[tuple, list] = {}
    for store, days in days_of.items():
        stores_of.setdefault(tuple(sorted(days)), []).append(store)
    parts = [F.lit(False)]
    for days, stores in stores_of.items():
        named = F.coalesce(F.col("store").isin([s for s in stores if s is not None]), F.lit(False))
        chosen = named | F.col("store").isNull() if None in stores else named
        parts.append(chosen & F.col("dt").isin(list(days)))
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    return parts[0]


def read_partitions(spark: SparkSession, path: str, schema: str, keys: list[tuple]) -> DataFrame:
    """Rows of the given partitions; those without a folder have none.

    Only the folders of the days named are listed, under their own names, so a daily run does not
    pay for the table's history and no spelling of a day is missed; stores are told apart by their
    value, whatever characters their folders hold. One way for any number of keys.
    """
    days = {dt for dt, _ in keys}
    paths = [e.path for day, e in day_folders(spark, path) if day in days] if keys else []
    if None in days:
        paths += [e.path for _, e in day_folders(spark, path) if e.name == f"dt={DEFAULT_FOLDER}"]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*paths)
    return rows.where(in_partitions(keys))


def register_table(
    spark: SparkSession, name: str, path: str, types: dict[str, str]
) -> DataFrame:
    """Declare an external table over a partitioned folder and list its partitions.

    Registering a known partition again is not an error.
    """
    body = ", ".join(f"`{c}` {t}" for c, t in types.items() if c not in PARTITION)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}, dt date, store string) "
        f"USING parquet PARTITIONED BY (dt, store) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.sql(f"SHOW PARTITIONS {name}")


def add_partition(spark: SparkSession, name: str, dt: str, store: str) -> None:
    spark.sql(
        f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (dt = DATE '{dt}', store = '{store}')"
    )


def add_partitions(
    spark: SparkSession, name: str, path: str, types: dict[str, str], keys: list[tuple], at_once: int = 500
) -> None:
    """Declare the table where it is new, and its partitions; known ones are no error.

    Only the given partitions are named: nothing is listed, whatever the size of the table.
    """
    body = ", ".join(f"`{c}` {t}" for c, t in types.items() if c not in PARTITION)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}, dt date, store string) "
        f"USING parquet PARTITIONED BY (dt, store) LOCATION '{path}'"
    )

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    parts = [
        f"PARTITION (dt = {f"DATE '{dt}'" if dt else 'null'}, store = {text(store) if store is not None else 'null'})"
        for dt, store in keys
    ]
    for k in range(0, len(parts), at_once):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts[k : k + at_once])}")
