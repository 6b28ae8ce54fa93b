"""What a load does with bad rows, and the history it leaves."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import LOADED_AT, WIDE_TYPES
from ..functions.stamps import utc_stamp
from ..sources.drop import SOURCE_FILE
from .versions import load_cast, misfits

MODES = ("abort", "continue", "skip_file", "skip_file_n")

HISTORY_TYPES = {
    "file_name": "string",
    "dt": "date",
    "status": "string",
    "row_count": "bigint",
    "row_parsed": "bigint",
    "error_count": "bigint",
    "first_error_message": "string",
    "last_load_time": "timestamp",
}


#: Place of a row in its file, where the reader knows it.
ROW_INDEX = "_row_index"
#: Characters of a value that a message shows.
MESSAGE_CHARS = 100


def _checked(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Adds the first column of each row that does not fit, and its value as text."""
    column, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, wrong in reversed(misfits(rows, types)):
        column = F.when(wrong, F.lit(name)).otherwise(column)
        value = F.when(wrong, F.substring(F.col(name).cast("string"), 1, MESSAGE_CHARS)).otherwise(value)
    return rows.select("*", column.alias("_bad_column"), value.alias("_bad_value"))


def file_errors(rows: DataFrame, types: dict[str, str] = WIDE_TYPES) -> DataFrame:
    """``file_name, dt, row_parsed, error_count`` and the first error: ``place, bad_column, bad_value``.

    One pass: rows are counted by file, column and value that does not fit, with the least place of
    each; what is left is one row for a file and one for each of its wrong values. Where places
    are not known, the first error is the first by column of the contract, then by value.
    """
    known = ROW_INDEX in rows.columns and not _fits(rows, types)
    place = F.col(ROW_INDEX) if known else F.lit(None).cast("bigint")
    by_value = _checked(rows, types).groupBy(
        F.col(SOURCE_FILE).alias("file_name"), "dt", F.col("_bad_column").alias("bad_column"), F.col("_bad_value").alias("bad_value")
    ).agg(F.count("*").alias("n"), F.min(place).alias("place"))
    wrong = F.col("bad_column").isNotNull()
    rank = F.array_position(F.array(*[F.lit(c) for c in types]), F.col("bad_column"))
    first = F.min(F.when(wrong, F.struct(F.coalesce("place", F.lit(0)).alias("at"), rank.alias("rank"), "bad_value", "bad_column", "place")))
    found = by_value.groupBy("file_name", "dt").agg(
        F.sum("n").alias("row_parsed"), F.sum(F.when(wrong, F.col("n")).otherwise(0)).alias("error_count"), first.alias("first")
    )
    return found.select("file_name", "dt", "row_parsed", "error_count", "first.place", "first.bad_column", "first.bad_value")


def _fits(rows: DataFrame, types: dict[str, str]) -> bool:
    """Whether the source is typed as the contract, so that no cast can fail."""
    source = dict(rows.dtypes)
    return all(source[c] == t for c, t in types.items())


def _check_mode(mode: str, limit: int | None) -> None:
    if mode not in MODES:
        raise ValueError(f"on_error must be one of {MODES}, got {mode!r}")
    if mode == "skip_file_n" and limit is None:
        raise ValueError("skip_file_n needs the number of bad rows a file may have")


def load_on_error(
    rows: DataFrame,
    mode: str = "skip_file",
    limit: int | None = None,
    types: dict[str, str] = WIDE_TYPES,
    errors: DataFrame | None = None,
) -> DataFrame:
    """Rows a load takes, typed, with ``_source_file``.

    ``abort`` fails the query on the first bad row, ``continue`` leaves bad rows out,
    ``skip_file`` leaves out every file with a bad row and ``skip_file_n`` every file with
    more than ``limit`` of them (bad rows of the files it keeps are left out).
    ``errors`` are the files' errors where they are known already; otherwise they are counted.
    """
    _check_mode(mode, limit)
    typed = {SOURCE_FILE: "string", **types}
    if _fits(rows, types):
        return rows.select(*typed)
    checked = _checked(rows, types)
    if mode == "abort":
        stop = F.raise_error(F.concat(F.lit("load aborted, bad row in "), F.col(SOURCE_FILE)))
        checked = checked.where(F.when(F.col("_bad_column").isNotNull(), stop.cast("boolean")).otherwise(True))
    else:
        if mode != "continue":
            allowed = 0 if mode == "skip_file" else limit
            counted = errors if errors is not None else file_errors(rows, types)
            skipped = counted.where(F.col("error_count") > allowed).select(F.col("file_name").alias(SOURCE_FILE))
            checked = checked.join(skipped.distinct(), SOURCE_FILE, "left_anti")
        checked = checked.where("_bad_column IS NULL")
    return load_cast(checked, typed, tolerant=True)


def load_history(
    rows: DataFrame,
    at: datetime,
    mode: str = "skip_file",
    limit: int | None = None,
    types: dict[str, str] = WIDE_TYPES,
) -> DataFrame:
    """One row per file of a load: what was parsed, what was taken, what was wrong and where first."""
    _check_mode(mode, limit)
    counts = file_errors(rows, types)
    allowed = {"skip_file": F.lit(0), "skip_file_n": F.lit(limit)}.get(mode, F.col("row_parsed"))
    skipped = F.col("error_count") > allowed
    status = (
        F.when(F.col("error_count") == 0, "Loaded").when(skipped, "Load failed").otherwise("Partially loaded")
    )
    taken = F.when(skipped, F.lit(0)).otherwise(F.col("row_parsed") - F.col("error_count"))
    where = F.when(F.col("place").isNotNull(), F.format_string(" in row %d", F.col("place") + 1)).otherwise("")
    text = F.format_string("%d rows do not fit the contract; first%s: %s is '%s'", "error_count", where, "bad_column", "bad_value")
    message = F.when(F.col("error_count") > 0, text)
    values = {
        "status": status,
        "row_count": taken,
        "first_error_message": message,
        "last_load_time": F.lit(at),
    }
    return counts.select(
        *[values.get(c, F.col(c)).cast(t).alias(c) for c, t in HISTORY_TYPES.items()]
    )


def stamp_load(rows: DataFrame, at: datetime) -> DataFrame:
    """Version column of the load."""
    return rows.withColumn(LOADED_AT, utc_stamp(at))
