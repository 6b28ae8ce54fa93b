"""Columns beyond the contract: which type each has, and which files disagree.

Files deliver further columns at any time. All that agree on a column's type are read by one scan
with the union of their schemas; files without the column give nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import PARTITION
from ..sources.footers import UNREADABLE

# Each type can be read as any that follows it in its row.
WIDENING = [["tinyint", "smallint", "int", "bigint"], ["float", "double"]]
SEEN_TYPES = {"column_name": "string", "column_type": "string", "job_run_id": "string", "recorded_at": "timestamp"}


def undeclared(footers: DataFrame, declared: dict[str, str]) -> DataFrame:
    """``column_name, column_type, files`` of the columns the contract does not name."""
    known = [c.lower() for c in [*declared, *PARTITION, UNREADABLE]]
    more = footers.where(~F.lower("column_name").isin(known))
    return more.groupBy("column_name", "column_type").agg(F.countDistinct("file_path").alias("files"))


def wider(a: str, b: str) -> str | None:
    """The type both can be read as, if there is one."""
    if a == b:
        return a
    for row in WIDENING:
        if a in row and b in row:
            return row[max(row.index(a), row.index(b))]
    return None


def settle(found: list[tuple[str, str, int]], known: dict[str, str]) -> dict[str, str]:
    """One type per column from (name, type, files) and the types of earlier runs.

    An earlier type stays, widened where that is enough. Else the type most files have wins, the
    first by name among equals, widened by the others it can take in. Names are compared without
    case, as scans do; the first spelling stays.
    """
    settled = {name.lower(): (name, kind) for name, kind in known.items()}
    for name, kind, _ in sorted(found, key=lambda f: (-f[2], f[0], f[1])):
        spelt, had = settled.setdefault(name.lower(), (name, kind))
        settled[name.lower()] = (spelt, wider(had, kind) or had)
    return dict(settled.values())


def evolution_problems(footers: DataFrame, settled: dict[str, str]) -> DataFrame:
    """``dt, store, file_path, problem``: columns that cannot be read as the settled type, and names
    that one file has twice but for case."""
    spark = footers.sparkSession
    wanted = spark.createDataFrame([(n.lower(), t) for n, t in settled.items()], "lowered string, want string")
    fits = [(t, w) for row in WIDENING for i, t in enumerate(row) for w in row[i:]]
    readable = F.struct("column_type", "want").isin([F.struct(F.lit(t), F.lit(w)) for t, w in fits])
    # The table has a row for each undeclared column.
    met = footers.withColumn("lowered", F.lower("column_name")).join(F.broadcast(wanted), "lowered")
    mistyped = met.where((F.col("column_type") != F.col("want")) & ~readable).select(
        *PARTITION, "file_path", F.format_string("%s is %s, not %s", "column_name", "column_type", "want").alias("problem")
    )
    twice = met.groupBy(*PARTITION, "file_path", "lowered").agg(F.count("*").alias("n")).where("n > 1").select(
        *PARTITION, "file_path", F.format_string("%s is there %d times", "lowered", "n").alias("problem")
    )
    return mistyped.unionByName(twice)
