"""Single-table audits of the narrow and the wide table.

Each audit covers every day it is given; filter on ``dt`` first to look at one day and
let Spark prune the rest.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import CHANNELS, MEASURES, NARROW_KEY, WIDE_KEY, WINDOWS
from ..functions import count_where, pct, safe_ratio

TOLERANCE = 1e-4


def _c(name: str) -> Column:
    return F.col(f"downloads_{name}")


def _split() -> Column:
    return _c("featured") + _c("organic")


def _paid() -> Column:
    return _c("paid_featured") + _c("paid_organic")


def _unpaid() -> Column:
    return _c("unpaid_featured") + _c("unpaid_organic")


def _featured_leaves() -> Column:
    return _c("paid_featured") + _c("unpaid_featured")


def _organic_leaves() -> Column:
    return _c("paid_organic") + _c("unpaid_organic")


def _top(rows: DataFrame, by: Column, limit: int | None) -> DataFrame:
    # All rows come as they are; a report of the first ones has the key to settle ties.
    return rows if limit is None else rows.orderBy(by, *WIDE_KEY).limit(limit)


def audit_total_split(wide: DataFrame, limit: int | None = None) -> DataFrame:
    """Largest gaps between the total and featured + organic."""
    gap = _c("total") - _split()
    bad = wide.where(_c("total") != _split()).select(
        *WIDE_KEY, *MEASURES[:3], _split().alias("sum_split"), gap.alias("delta")
    )
    return _top(bad, F.abs("delta").desc(), limit)


def audit_paid_unpaid_split(wide: DataFrame, limit: int | None = None) -> DataFrame:
    """Largest gaps between the total and paid + unpaid."""
    bad = wide.where(_c("total") != _paid() + _unpaid()).select(
        *WIDE_KEY,
        "downloads_total",
        _paid().alias("paid_total"),
        _unpaid().alias("unpaid_total"),
        (_c("total") - _paid() - _unpaid()).alias("delta"),
    )
    return _top(bad, F.abs("delta").desc(), limit)


def audit_featured_leaves(wide: DataFrame) -> DataFrame:
    return wide.agg(count_where(_c("featured") != _featured_leaves()).alias("featured_eq_violations"))


def audit_organic_leaves(wide: DataFrame) -> DataFrame:
    return wide.agg(count_where(_c("organic") != _organic_leaves()).alias("organic_eq_violations"))


def audit_violation_rate_by_dt(
    wide: DataFrame, as_of: date, days: int = WINDOWS.lookback_days
) -> DataFrame:
    recent = wide.where(F.col("dt") >= F.lit(as_of - timedelta(days=days)))
    unequal = _c("total") != _split()
    return (
        recent.groupBy("dt")
        .agg(
            F.count("*").alias("total_rows"),
            count_where(unequal).alias("eq1_violations"),
            count_where(_c("featured") != _featured_leaves()).alias("eq2_violations"),
            count_where(_c("organic") != _organic_leaves()).alias("eq3_violations"),
            pct(count_where(unequal), F.count("*"), 4).alias("eq1_violation_pct"),
        )
        .orderBy(F.col("dt").desc())
    )


def _recalc(wide: DataFrame) -> DataFrame:
    return wide.where(_c("total") > 0).select(
        "*",
        F.round(safe_ratio(_paid(), _c("total")), 4).alias("paid_again"),
        F.round(safe_ratio(_c("featured"), _c("total")), 4).alias("featured_again"),
    )


def _off(stored: str, again: str) -> Column:
    return F.abs(F.col(stored).cast("double") - F.col(again))


def audit_paid_share_recalc(wide: DataFrame, limit: int | None = None) -> DataFrame:
    """Stored paid shares furthest from the ratio of the stored downloads."""
    bad = _recalc(wide).where(_off("paid_share", "paid_again") > TOLERANCE).select(
        *WIDE_KEY,
        "downloads_total",
        "downloads_paid_featured",
        "downloads_paid_organic",
        F.col("paid_share").alias("paid_share_stored"),
        F.col("paid_again").alias("paid_share_recomputed"),
        F.round(_off("paid_share", "paid_again"), 6).alias("delta"),
    )
    return _top(bad, F.col("delta").desc(), limit)


def audit_featured_share_recalc(wide: DataFrame) -> DataFrame:
    return _recalc(wide).where(_off("featured_share", "featured_again") > TOLERANCE).select(
        *WIDE_KEY,
        "downloads_total",
        "downloads_featured",
        F.col("featured_share").alias("featured_share_stored"),
        F.col("featured_again").alias("featured_share_recomputed"),
    )


def audit_both_shares_recalc(wide: DataFrame) -> DataFrame:
    wrong = (_off("paid_share", "paid_again") > TOLERANCE) | (
        _off("featured_share", "featured_again") > TOLERANCE
    )
    return _recalc(wide).where(wrong).select(
        *WIDE_KEY,
        "paid_share",
        F.col("paid_again").alias("paid_share_recalc"),
        "featured_share",
        F.col("featured_again").alias("featured_share_recalc"),
    )


def _out_of_bounds(column: str) -> Column:
    return (F.col(column) < 0) | (F.col(column) > 1)


def audit_share_bounds(wide: DataFrame) -> DataFrame:
    return wide.agg(
        count_where(_out_of_bounds("paid_share")).alias("paid_share_oob"),
        count_where(_out_of_bounds("featured_share")).alias("featured_share_oob"),
        count_where(F.col("paid_share").isNull()).alias("paid_share_null"),
        count_where(F.col("featured_share").isNull()).alias("featured_share_null"),
        count_where(_c("total") == 0).alias("zero_total_rows"),
    )


def _repeats(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("dup_count")).where("dup_count > 1")


def audit_wide_duplicates(wide: DataFrame, limit: int | None = None) -> DataFrame:
    """The most repeated wide keys."""
    return _top(_repeats(wide, WIDE_KEY), F.col("dup_count").desc(), limit)


def audit_wide_null_pct(wide: DataFrame) -> DataFrame:
    names = {"product": "product_id", "country": "country", "store": "app_store", "device": "device", "dt": "dt"}
    return wide.agg(
        F.count("*").alias("total_rows"),
        *[
            pct(count_where(F.col(c).isNull()), F.count("*"), 6).alias(f"pct_null_{n}")
            for n, c in names.items()
        ],
    )


def audit_dt_profile(versions: DataFrame) -> DataFrame:
    return (
        versions.groupBy("dt")
        .agg(
            F.count("*").alias("row_count"),
            F.min("ingest_ts").alias("first_write"),
            F.max("ingest_ts").alias("last_write"),
            F.max("_loaded_at").alias("last_load"),
            F.sum("downloads_total").alias("total_downloads"),
            count_where(F.col("is_estimate_final")).alias("finalized_rows"),
            count_where(~F.col("is_estimate_final")).alias("preview_rows"),
        )
        .orderBy(F.col("dt").desc())
    )


def audit_wide_negatives(wide: DataFrame) -> DataFrame:
    return wide.agg(*[count_where(F.col(c) < 0).alias(c.replace("downloads", "neg")) for c in MEASURES])


def audit_narrow_coverage(
    narrow: DataFrame, as_of: date, days: int = WINDOWS.lookback_days, approx: bool = False
) -> DataFrame:
    """Rows, products and countries per partition, and rows whose store is not the folder's.

    ``approx`` swaps the exact distinct counts for sketches.
    """
    distinct = F.approx_count_distinct if approx else F.countDistinct
    return (
        narrow.where(F.col("dt") >= F.lit(as_of - timedelta(days=days)))
        .groupBy("dt", "store")
        .agg(
            F.count("*").alias("row_count"),
            distinct("product_id").alias("distinct_products"),
            distinct("country").alias("distinct_countries"),
            F.min("ingest_ts").alias("first_ingest"),
            F.max("ingest_ts").alias("last_ingest"),
            count_where(F.col("store") != F.col("app_store")).alias("misplaced_rows"),
        )
        .orderBy(F.col("dt").desc(), "store")
    )


def audit_channel_domain(narrow: DataFrame) -> DataFrame:
    """Rows per channel value, with a flag for values outside the domain."""
    return (
        narrow.groupBy("channel")
        .agg(F.count("*").alias("row_count"))
        .select("*", F.coalesce(F.col("channel").isin(CHANNELS), F.lit(False)).alias("in_domain"))
        .orderBy(F.col("row_count").desc(), "channel")
    )


def audit_channel_completeness(narrow: DataFrame) -> DataFrame:
    """How many groups have one, two, … channels."""
    per_channel = narrow.select(*NARROW_KEY).where(F.col("channel").isNotNull()).distinct()
    per_group = per_channel.groupBy(*WIDE_KEY).agg(F.count("*").alias("channel_count"))
    return per_group.groupBy("channel_count").agg(F.count("*").alias("group_count")).orderBy(
        F.col("channel_count").desc()
    )


def audit_share_sum(narrow: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Groups whose channel shares do not add up to one."""
    return (
        narrow.groupBy(*WIDE_KEY)
        .agg(F.sum("share_pct").alias("share_sum"), F.count("*").alias("channel_count"))
        .where(F.abs(F.col("share_sum").cast("double") - 1) > tolerance)
        .select(*WIDE_KEY, F.col("share_sum").cast("double").alias("share_sum"), "channel_count")
    )


def audit_narrow_quality(narrow: DataFrame) -> DataFrame:
    def nulls(column):
        return pct(count_where(F.col(column).isNull()), F.count("*"), 6)

    return narrow.agg(
        F.count("*").alias("total"),
        nulls("product_id").alias("pct_null_product"),
        nulls("channel").alias("pct_null_channel"),
        nulls("downloads").alias("pct_null_downloads"),
        count_where(F.col("downloads") < 0).alias("neg_downloads"),
        count_where(_out_of_bounds("share_pct")).alias("oob_share"),
    )


def audit_narrow_duplicates(narrow: DataFrame) -> DataFrame:
    return _repeats(narrow, NARROW_KEY)


def audit_wide_key_summary(wide: DataFrame) -> DataFrame:
    per_key = wide.groupBy(*WIDE_KEY).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_groups"),
        count_where(F.col("n") > 1).alias("duplicate_groups"),
    )


def audit_equations(wide: DataFrame) -> DataFrame:
    leaves = reduce(add, [_c(c) for c in CHANNELS])
    return wide.agg(
        F.count("*").alias("total_rows"),
        count_where(_c("total") != _split()).alias("eq1_violations"),
        count_where(_c("total") != leaves).alias("eq2_violations"),
        count_where(_c("featured") != _featured_leaves()).alias("eq3_violations"),
        count_where(_c("organic") != _organic_leaves()).alias("eq4_violations"),
    )


def smoke_wide(wide: DataFrame) -> DataFrame:
    """Eight named checks as rows; all zero when the table is sound.

    Row counts are summed per key first, which gives the repeated keys and every other
    check from one scan and one shuffle.
    """
    leaves = reduce(add, [_c(c) for c in CHANNELS])
    checks = {
        "eq_total_split1": _c("total") != _split(),
        "eq_total_split2": _c("total") != leaves,
        "eq_featured": _c("featured") != _featured_leaves(),
        "eq_organic": _c("organic") != _organic_leaves(),
        "paid_share_oob": _out_of_bounds("paid_share"),
        "featured_share_oob": _out_of_bounds("featured_share"),
        "null_product": F.col("product_id").isNull(),
    }
    per_key = wide.groupBy(*WIDE_KEY).agg(
        F.count("*").alias("copies"), *[count_where(cond).alias(n) for n, cond in checks.items()]
    )
    sums = per_key.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in checks],
        count_where(F.col("copies") > 1).alias("duplicate_pk"),
    )
    names = [*checks, "duplicate_pk"]
    return sums.unpivot([], names, "check_name", "n").orderBy(F.col("n").desc(), "check_name")
