"""Bronze: contract checks, casts, trimming, stamping, key dedup."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import DROP_TYPES, NARROW_KEY, PARTITION
from ..functions.stamps import utc_stamp
from ..sources.footers import UNREADABLE


def contract_table(spark: SparkSession, types: dict[str, str] = DROP_TYPES) -> DataFrame:
    return spark.createDataFrame(list(types.items()), "column_name string, want string")


def schema_missing_cols(
    footers: DataFrame, types: dict[str, str] = DROP_TYPES
) -> DataFrame:
    """Contract columns a file lacks: ``dt, store, file_path, column_name``.

    ``dt`` and ``store`` may live in the path alone, so they are never missing.
    """
    wanted = F.array(*[F.lit(c) for c in types if c not in PARTITION])
    # The collected set is bounded by the columns of one file.
    files = footers.groupBy(*PARTITION, "file_path").agg(
        F.collect_set("column_name").alias("present")
    )
    lacking = F.explode(F.array_except(wanted, "present")).alias("column_name")
    readable = ~F.array_contains("present", UNREADABLE)
    return files.where(readable).select(*PARTITION, "file_path", lacking)


def schema_type_mismatch(
    footers: DataFrame, types: dict[str, str] = DROP_TYPES
) -> DataFrame:
    """Columns whose stored type is not exactly the contract's: adds ``got`` and ``want``."""
    wanted = contract_table(footers.sparkSession, types)
    return (
        footers.join(F.broadcast(wanted), "column_name")
        .where(F.col("column_type") != F.col("want"))
        .select(*PARTITION, "file_path", "column_name", F.col("column_type").alias("got"), "want")
    )


def schema_gate(
    footers: DataFrame, types: dict[str, str] = DROP_TYPES, further: DataFrame | None = None
) -> DataFrame:
    """Verdict per partition: one bad file rejects the whole partition, and only that one.

    ``further`` are problems found elsewhere: ``dt, store, file_path, problem``.

    ``dt, store, files, bad_files, unreadable_files, error_message`` (message NULL when the
    partition passes).
    """
    broken = footers.where(F.col("column_name") == UNREADABLE).select(
        *PARTITION, "file_path", F.concat(F.lit("unreadable file: "), "column_type").alias("problem")
    )
    missing = schema_missing_cols(footers, types).select(
        *PARTITION, "file_path", F.concat(F.lit("missing "), "column_name").alias("problem")
    )
    mistyped = schema_type_mismatch(footers, types).select(
        *PARTITION,
        "file_path",
        F.format_string("%s is %s, not %s", "column_name", "got", "want").alias("problem"),
    )
    found = missing.unionByName(mistyped).unionByName(broken)
    problems = (
        (found if further is None else found.unionByName(further))
        .groupBy(*PARTITION)
        .agg(
            F.countDistinct("file_path").alias("bad_files"),
            F.count_if(F.startswith("problem", F.lit("unreadable"))).alias("unreadable_files"),
            F.concat_ws("; ", F.sort_array(F.collect_set("problem"))).alias("error_message"),
        )
    )
    files = footers.groupBy(*PARTITION).agg(F.countDistinct("file_path").alias("files"))
    return files.join(problems, PARTITION, "left").select(
        *PARTITION,
        "files",
        F.coalesce("bad_files", F.lit(0)).cast("bigint").alias("bad_files"),
        F.coalesce("unreadable_files", F.lit(0)).cast("bigint").alias("unreadable_files"),
        "error_message",
    )


def cast_contract(rows: DataFrame, types: dict[str, str] = DROP_TYPES) -> DataFrame:
    """Cast contract columns in one projection; columns beyond the contract pass through."""
    return rows.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in rows.columns])


def trim_strings(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes])


def stamp_ingest(rows: DataFrame, at: datetime | None = None) -> DataFrame:
    """One ingestion time for the whole run: the given one, or the query's start."""
    stamp = utc_stamp(at) if at is not None else F.current_timestamp()
    return rows.withColumn("ingest_ts", stamp)


def keep_first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark puts a per-task group limit below the shuffle, so a key that holds a large part
    of all rows sends one row per task, not all of them.
    """
    ranked = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def newest_first(rows: DataFrame, *leading: str) -> list[Column]:
    """Total order for a dedup: leading columns newest first, then every other that has an order."""
    ordered = [c for c, t in rows.dtypes if "map<" not in t and "variant" not in t]
    rest = [c for c in ordered if c not in leading and c not in NARROW_KEY]
    return [F.col(c).desc_nulls_last() for c in [*leading, *rest]]


def dedup_pk(
    rows: DataFrame, order: list[Column] | None = None, key: list[str] = NARROW_KEY
) -> DataFrame:
    """Newest row per narrow key. Ties on ``ingest_ts`` fall back to the other columns."""
    return keep_first(rows, key, order or newest_first(rows, "ingest_ts"))


def dedup_metrics(rows: DataFrame) -> DataFrame:
    """Rows in, rows out and rows removed by the key dedup, per partition.

    Counting per key first lets one aggregate give both numbers; the count per partition
    is combined before it is shuffled.
    """
    per_key = rows.groupBy("store", *NARROW_KEY).agg(F.count("*").alias("n"))
    return per_key.groupBy(*PARTITION).agg(
        F.sum("n").alias("in_count"),
        F.count("*").alias("out_count"),
        (F.sum("n") - F.count("*")).alias("dedup_removed"),
    )
