"""The append-only versioned table: load casts, dedup, latest view."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import LOADED_AT, MEASURES, WIDE_KEY, WIDE_TYPES, WINDOWS
from ..functions import bool_load_rule
from .cleaning import keep_first


def load_cast(rows: DataFrame, types: dict[str, str] = WIDE_TYPES, *, tolerant: bool = False) -> DataFrame:
    """Typed projection of a load. Tolerant casts give NULL where strict ones raise; both take the
    same spellings of a flag."""
    source = dict(rows.dtypes)

    def cast(column: str, wanted: str):
        value = F.col(column)
        if wanted == "boolean":
            held = bool_load_rule(value, source[column])
            if tolerant or source[column] == "boolean":
                return held
            wrong = F.raise_error(F.concat(F.lit(f"{column} is no flag: "), value.cast("string"))).cast("boolean")
            return F.when(value.isNotNull() & held.isNull(), wrong).otherwise(held)
        return value.try_cast(wanted) if tolerant else value.cast(wanted)

    return rows.select(*[cast(c, t).alias(c) for c, t in types.items()])


def misfits(rows: DataFrame, types: dict[str, str] = WIDE_TYPES) -> list[tuple[str, Column]]:
    """For each contract column of another type, whether a row holds a value that the contract's cannot."""
    source = dict(rows.dtypes)
    found = []
    for column, wanted in types.items():
        if source[column] == wanted:
            continue
        value = F.col(column)
        held = bool_load_rule(value, source[column]) if wanted == "boolean" else value.try_cast(wanted)
        found.append((column, F.coalesce(value.isNotNull() & held.isNull(), F.lit(False))))
    return found


def _newest(rows: DataFrame) -> list:
    rest = [c for c in rows.columns if c not in WIDE_KEY and c != LOADED_AT]
    return [F.col(LOADED_AT).desc(), *[F.col(c).desc_nulls_last() for c in rest]]


def latest_view(versions: DataFrame) -> DataFrame:
    """Newest version per wide key. Equal load times are settled by the other columns."""
    return keep_first(versions, WIDE_KEY, _newest(versions))


def dedup_versions(versions: DataFrame, as_of: date, days: int = WINDOWS.dedup_days) -> DataFrame:
    """Only the newest version within the window; older days as they are, repeats included."""
    cutoff = F.lit(as_of - timedelta(days=days))
    recent = latest_view(versions.where(F.col("dt") >= cutoff))
    return recent.unionByName(versions.where(F.col("dt") < cutoff))


def touched_by_dedup(versions: DataFrame, as_of: date, days: int = WINDOWS.dedup_days) -> DataFrame:
    """Days a dedup has to rewrite: those with a key that has more than one version."""
    recent = versions.where(F.col("dt") >= F.lit(as_of - timedelta(days=days)))
    per_key = recent.groupBy(*WIDE_KEY).agg(F.count("*").alias("n"))
    return per_key.where("n > 1").select("dt").distinct()


#: Parts that the versions of one key are dealt into where they meet their key's first final version.
SALTS = 32


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_part", F.pmod(F.xxhash64(LOADED_AT, *MEASURES), F.lit(SALTS)).cast("int"))


def _in_every_part(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def finalized_changed(versions: DataFrame) -> DataFrame:
    """Versions whose numbers differ from the key's first final version.

    A final row must not change again. Of several first ones with one load time, the one with the
    least numbers counts. A combining aggregate over plain numbers first finds the keys that have
    a final version and more than one value of some measure; all others are done. The versions of
    those keys meet the first final one in parts, so a key with very many versions is never
    gathered in one task, whether or not tables are broadcast.
    """
    final = F.when(F.col("is_estimate_final"), F.col(LOADED_AT))
    extremes = [
        F.struct(F.min(c).alias("least"), F.max(c).alias("most"), F.count(c).alias("some")).alias(f"_{c}") for c in MEASURES
    ]
    per_key = versions.groupBy(*WIDE_KEY).agg(F.min(final).alias("_first"), F.count("*").alias("_n"), *extremes)
    moved = F.lit(False)
    for c in MEASURES:
        seen = F.col(f"_{c}")
        moved = moved | (seen["least"] != seen["most"]) | ((seen["some"] > 0) & (seen["some"] < F.col("_n")))
    suspects = _in_every_part(per_key.where(F.col("_first").isNotNull() & moved).select(*WIDE_KEY, "_first"))
    held = _dealt(versions).join(suspects, [*WIDE_KEY, "_part"])
    at_first = held.where(F.col("is_estimate_final") & (F.col(LOADED_AT) == F.col("_first")))
    first = keep_first(at_first, WIDE_KEY, [F.col(c) for c in MEASURES])
    first = _in_every_part(first.select(*WIDE_KEY, *[F.col(c).alias(f"_final_{c}") for c in MEASURES]))
    later = held.where(F.col(LOADED_AT) > F.col("_first")).join(first, [*WIDE_KEY, "_part"])
    same = F.lit(True)
    for c in MEASURES:
        same = same & F.col(c).eqNullSafe(F.col(f"_final_{c}"))
    return later.where(~same).select(
        *WIDE_KEY,
        F.col("_first").alias("final_loaded_at"),
        F.col("_final_downloads_total").alias("final_total"),
        LOADED_AT,
        "downloads_total",
        (F.col("downloads_total") - F.col("_final_downloads_total")).alias("delta"),
    )


def finalized_only(versions: DataFrame) -> DataFrame:
    """Rows strict reports may use."""
    return versions.where("is_estimate_final")
