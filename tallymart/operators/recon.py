"""Reconciliation between layers."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import MEASURES, WIDE_KEY, WINDOWS
from ..functions import safe_ratio
from .gold import trend_window
from .pivot import pivot_wide

# Short names the reconciliation reports give the measures.
SHORT = {
    "downloads_total": "total",
    "downloads_featured": "featured",
    "downloads_organic": "organic",
    "downloads_paid_featured": "pf",
    "downloads_paid_organic": "po",
    "downloads_unpaid_featured": "uf",
    "downloads_unpaid_organic": "uo",
}


def recon_row_count(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    """Distinct narrow groups against wide rows."""
    groups = narrow.select(*WIDE_KEY).distinct().agg(F.count("*").alias("bronze_distinct_groups"))
    rows = wide.agg(F.count("*").alias("silver_rows"))
    both = groups.unionByName(rows, allowMissingColumns=True).agg(
        F.max("bronze_distinct_groups").alias("bronze_distinct_groups"),
        F.max("silver_rows").alias("silver_rows"),
    )
    return both.select("*", (F.col("bronze_distinct_groups") - F.col("silver_rows")).alias("delta"))


def _pivot_pairs(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    # The pivot comes out partitioned by the key, so only the wide side is shuffled.
    return wide.alias("s").join(pivot_wide(narrow).alias("b"), WIDE_KEY)


def _differs(columns: list[str]):
    return reduce(or_, [F.col(f"s.{c}") != F.col(f"b.{c}") for c in columns])


def recon_pivot_rows(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    """Wide rows that differ from a fresh pivot in any measure, with all differences."""
    bad = _pivot_pairs(narrow, wide).where(_differs([*MEASURES, "is_estimate_final"]))
    return bad.select(
        *WIDE_KEY,
        F.col("s.downloads_total").alias("s_total"),
        F.col("b.downloads_total").alias("b_total"),
        *[(F.col(f"s.{c}") - F.col(f"b.{c}")).alias(f"d_{n}") for c, n in SHORT.items()],
        F.col("s.is_estimate_final").alias("s_final"),
        F.col("b.is_estimate_final").alias("b_final"),
    )


def recon_smoke_pivot(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    measures = [c for c in MEASURES if c != "downloads_organic"]
    bad = _pivot_pairs(narrow, wide).where(_differs(measures))
    return bad.agg(F.count("*").alias("pivot_mismatch"))


def recon_missing_in_silver(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    return narrow.select(*WIDE_KEY).distinct().join(wide.select(*WIDE_KEY), WIDE_KEY, "left_anti")


def recon_extra_in_silver(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    keys = narrow.select(*WIDE_KEY).distinct()
    return wide.select(*WIDE_KEY).join(keys, WIDE_KEY, "left_anti")


def recon_share_sums(narrow: DataFrame, wide: DataFrame, tolerance: float = 2e-4) -> DataFrame:
    """Wide shares against the sums of the narrow shares."""
    def summed(*channels):
        return F.sum(F.when(F.col("channel").isin(*channels), F.col("share_pct")).otherwise(0)).cast("double")

    sums = narrow.groupBy(*WIDE_KEY).agg(
        summed("paid_featured", "paid_organic").alias("b_paid_share"),
        summed("paid_featured", "unpaid_featured").alias("b_featured_share"),
    )
    off = {
        "d_paid": F.abs(F.col("paid_share").cast("double") - F.col("b_paid_share")),
        "d_featured": F.abs(F.col("featured_share").cast("double") - F.col("b_featured_share")),
    }
    return (
        wide.join(sums, WIDE_KEY)
        .where(reduce(or_, [v > tolerance for v in off.values()]))
        .select(
            *WIDE_KEY,
            "paid_share",
            F.round("b_paid_share", 4).alias("b_paid_share"),
            "featured_share",
            F.round("b_featured_share", 4).alias("b_featured_share"),
            *[F.round(v, 6).alias(n) for n, v in off.items()],
        )
    )


def recon_counts_by_dt(wide: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows and totals per day in the published and in the loaded table."""
    def per_day(rows, side):
        return rows.groupBy("dt").agg(
            F.count("*").alias(f"{side}_rows"), F.sum("downloads_total").alias(f"{side}_total")
        )

    both = per_day(wide, "silver").join(per_day(versions, "loaded"), "dt", "full")
    zero = F.lit(0)
    return both.select(
        "dt",
        "silver_rows",
        "loaded_rows",
        (F.coalesce("loaded_rows", zero) - F.coalesce("silver_rows", zero)).alias("d_rows"),
        "silver_total",
        "loaded_total",
        (F.coalesce("loaded_total", zero) - F.coalesce("silver_total", zero)).alias("d_total"),
    ).orderBy(F.col("dt").desc())


def recon_gold_app(gold: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows of the by-app aggregate that no longer match the detail."""
    key = ["dt", "product_id", "app_store"]
    again = versions.groupBy(*key).agg(F.sum("downloads_total").alias("s_total"), F.count("*").alias("s_rows"))
    wrong = (F.col("g_total") != F.col("s_total")) | (F.col("g_rows") != F.col("s_rows"))
    stored = gold.select(*key, F.col("downloads_total").alias("g_total"), F.col("row_count").alias("g_rows"))
    return stored.join(again, key).where(wrong).select(*key, "g_total", "s_total", "g_rows", "s_rows")


def recon_gold_country(gold: DataFrame, versions: DataFrame) -> DataFrame:
    """Same for the by-country aggregate; detail is summed before the join."""
    key = ["dt", "country", "app_store"]
    again = versions.groupBy(*key).agg(F.sum("downloads_total").alias("recalc"))
    return (
        gold.select(*key, "downloads_total")
        .join(again, key)
        .where(F.col("downloads_total") != F.col("recalc"))
    )


def recon_gold_trend(trend: DataFrame, as_of: date, limit: int | None = None) -> DataFrame:
    """Stored ratios next to recomputed ones, newest days first."""
    paid = F.col("downloads_paid_featured") + F.col("downloads_paid_organic")
    total = F.col("downloads_total")
    report = (
        trend_window(trend, as_of, WINDOWS.trend_days)
        .select(
            "dt",
            "app_store",
            "downloads_total",
            paid.alias("recalc_paid"),
            "paid_ratio",
            F.round(safe_ratio(paid, total), 4).alias("recalc_paid_ratio"),
            "featured_ratio",
            F.round(safe_ratio(F.col("downloads_featured"), total), 4).alias("recalc_featured_ratio"),
        )
        .orderBy(F.col("dt").desc(), "app_store")
    )
    return report if limit is None else report.limit(limit)


def recon_load_vs_table(history: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows loaded per day by the load history against rows now in the table."""
    loaded = history.groupBy("dt").agg(F.sum("row_count").alias("history_rows"), F.count("*").alias("files"))
    present = versions.groupBy("dt").agg(F.count("*").alias("table_rows"))
    return loaded.join(present, "dt", "full").select(
        "dt",
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("history_rows", F.lit(0)).alias("history_rows"),
        F.coalesce("table_rows", F.lit(0)).alias("table_rows"),
        (F.coalesce("history_rows", F.lit(0)) - F.coalesce("table_rows", F.lit(0))).alias("delta"),
    )


def recon_file_manifest(manifest: DataFrame, history: DataFrame) -> DataFrame:
    """Files written per day against files and rows loaded per day."""
    written = manifest.groupBy("dt").agg(F.count("*").alias("files_written"))
    loaded = history.groupBy("dt").agg(
        F.countDistinct("file_name").alias("files_loaded"), F.sum("row_count").alias("rows_loaded")
    )
    missing = F.col("files_written") - F.coalesce("files_loaded", F.lit(0))
    return written.join(loaded, "dt", "left").select(
        "dt",
        "files_written",
        F.coalesce("files_loaded", F.lit(0)).alias("files_loaded"),
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
        missing.alias("files_missing"),
    )
