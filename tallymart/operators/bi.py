"""Business reports over the latest versions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_where, pct


def _paid():
    return F.col("downloads_paid_featured") + F.col("downloads_paid_organic")


def _day(rows: DataFrame, day: date | None) -> DataFrame:
    return rows if day is None else rows.where(F.col("dt") == F.lit(day))


def bi_top_apps(rows: DataFrame, day: date | None = None, top: int = 10) -> DataFrame:
    """Best products per day and store, with their paid part."""
    sums = _day(rows, day).groupBy("dt", "app_store", "product_id").agg(
        F.sum("downloads_total").alias("total_dl"), F.sum(_paid()).alias("paid_dl")
    )
    best = Window.partitionBy("dt", "app_store").orderBy(F.col("total_dl").desc_nulls_last(), "product_id")
    return (
        sums.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= top)
        .select(
            "dt", "app_store", "product_id", "total_dl", "paid_dl",
            pct(F.col("paid_dl"), F.col("total_dl"), 2).alias("paid_pct"),
        )
        .orderBy("dt", "app_store", F.col("total_dl").desc_nulls_last(), "product_id")
    )


def bi_country_store_matrix(rows: DataFrame, day: date | None = None, limit: int = 20) -> DataFrame:
    """Totals per country with one column per store; no rows for a store gives NULL."""
    def store_total(store):
        return F.sum(F.when(F.col("app_store") == store, F.col("downloads_total")))

    return (
        _day(rows, day)
        .groupBy("country")
        .agg(store_total("ios").alias("ios_total"), store_total("google-play").alias("gp_total"))
        .orderBy(F.col("ios_total").desc_nulls_last(), "country")
        .limit(limit)
    )


def bi_weekly_paid_trend(rows: DataFrame, as_of: date, days: int = 56) -> DataFrame:
    return (
        rows.where(F.col("dt") >= F.lit(as_of - timedelta(days=days)))
        .groupBy(F.date_trunc("week", "dt").cast("date").alias("week_start"), "app_store")
        .agg(
            F.sum("downloads_total").alias("total"),
            pct(F.sum(_paid()), F.sum("downloads_total"), 2).alias("paid_pct"),
        )
        .orderBy(F.col("week_start").desc(), "app_store")
    )


def bi_wow(rows: DataFrame, day: date, limit: int = 20) -> DataFrame:
    """Seven days up to ``day`` against the seven before, in one scan.

    Products without a row in the newer week are left out.
    """
    def week(first: int, last: int):
        inside = F.col("dt").between(F.lit(day - timedelta(days=first)), F.lit(day - timedelta(days=last)))
        return F.sum(F.when(inside, F.col("downloads_total")))

    weeks = (
        rows.where(F.col("dt").between(F.lit(day - timedelta(days=13)), F.lit(day)))
        .groupBy("product_id", "app_store")
        .agg(week(6, 0).alias("this_week"), week(13, 7).alias("prior_week"))
    )
    change = pct(F.col("this_week") - F.col("prior_week"), F.col("prior_week"), 2)
    return (
        weeks.where(F.col("this_week").isNotNull())
        .select("*", change.alias("wow_pct"))
        .orderBy(F.col("wow_pct").desc_nulls_last(), "product_id", "app_store")
        .limit(limit)
    )


def daily_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("dt", "product_id", "app_store").agg(F.sum("downloads_total").alias("total"))


def _week_earlier(values: DataFrame, measure: str) -> DataFrame:
    # Joined on the date: an offset in rows would be wrong where days are missing.
    return values.select(
        F.date_add("dt", 7).alias("dt"), "product_id", "app_store", F.col(measure).alias("prior")
    )


def bi_dod7(rows: DataFrame, day: date | None = None) -> DataFrame:
    """Each day (or one day) against the same weekday a week before."""
    if day is not None:
        rows = rows.where(F.col("dt").isin(day, day - timedelta(days=7)))
    daily = daily_totals(rows)
    return (
        _day(daily, day)
        .join(_week_earlier(daily, "total"), ["dt", "product_id", "app_store"], "left")
        .select(
            "dt", "product_id", "app_store",
            F.col("total").alias("this_dt"),
            F.col("prior").alias("prior_dt"),
            pct(F.col("total") - F.col("prior"), F.col("prior"), 2).alias("dow7_pct"),
        )
    )


def bi_rolling7(rows: DataFrame) -> DataFrame:
    """Mean of the last seven daily totals a product has in a store."""
    week = Window.partitionBy("product_id", "app_store").orderBy("dt").rowsBetween(-6, 0)
    return daily_totals(rows).select("*", F.round(F.avg("total").over(week), 4).alias("rolling7"))


def bi_rolling7_vs_prior(rows: DataFrame) -> DataFrame:
    """Rolling mean against the rolling mean of exactly seven days before."""
    rolling = bi_rolling7(rows)
    return (
        rolling.join(_week_earlier(rolling, "rolling7"), ["dt", "product_id", "app_store"], "left")
        .select(
            "dt", "product_id", "app_store", "rolling7",
            F.col("prior").alias("prior_rolling7"),
            F.round(F.col("rolling7") - F.col("prior"), 4).alias("rolling7_delta"),
        )
    )


def bi_finalization(rows: DataFrame) -> DataFrame:
    final = count_where(F.col("is_estimate_final"))
    return (
        rows.groupBy("dt")
        .agg(
            final.alias("finalized_rows"),
            count_where(~F.col("is_estimate_final")).alias("preview_rows"),
            pct(final, F.count("*"), 1).alias("pct_finalized"),
        )
        .orderBy(F.col("dt").desc())
    )


def enrich_country(rows: DataFrame, countries: DataFrame) -> DataFrame:
    """Add what a country lookup knows; rows with an unknown country stay.

    No broadcast is forced: Spark broadcasts a lookup below its size limit and shuffles a
    larger one.
    """
    return rows.join(countries, "country", "left")
