"""Narrow, wide, versioned and side tables derived from the given tables.

``events`` becomes a narrow drop with repeated keys and one channel outside the domain,
30 days and two stores. ``lineitem`` becomes the larger narrow table. Everything else is
built from these two by the package's own operators, whole tables at a time; defects sit in
whole days, stores or devices.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import DROP_TYPES, LOADED_AT, MEASURES, NARROW_TYPES, PARTITION, WIDE_KEY, WIDE_TYPES
from ..functions import share
from ..functions.stamps import utc_stamp
from ..operators.cleaning import dedup_pk
from ..operators.pivot import conform_columns, pivot_wide, to_wide, with_shares

AS_OF = date(2024, 1, 31)
INGEST_AT = datetime(2024, 1, 31, 10, 0)
LOAD_1 = datetime(2024, 1, 31, 10, 5)
LOAD_2 = datetime(2024, 2, 1, 10, 5)
PREVIOUS_RUN = datetime(2024, 1, 25, 12, 0)
NOW = datetime(2024, 2, 1, 12, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow rows as delivered: repeats, restates and the channel ``error`` included."""
    user = F.col("user_id")
    country = F.element_at(F.array(*[F.lit(c) for c in ("US", "GB", "DE", "JP", "BR")]), (user % 5 + 1).cast("int"))
    device = F.element_at(
        F.array(*[F.lit(d) for d in ("iphone", "android-phone", "ipad", "android-tablet")]), (user % 4 + 1).cast("int")
    )
    channel = (
        F.when(F.col("event_type") == "click", "paid_featured")
        .when(F.col("event_type") == "view", "paid_organic")
        .when(F.col("event_type") == "signup", "unpaid_featured")
        .when(F.col("event_type") == "purchase", "unpaid_organic")
        .otherwise(F.col("event_type"))
    )
    store = F.when(user % 2 == 0, "ios").otherwise("google-play")
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("dt"),
        user.alias("product_id"),
        store.alias("app_store"),
        country.alias("country"),
        device.alias("device"),
        channel.alias("channel"),
        F.floor("value").cast("bigint").alias("downloads"),
        (F.col("event_id") % 10 != 0).alias("is_estimate_final"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
        "event_id",
        store.alias("store"),
    )


def with_share_pct(rows: DataFrame) -> DataFrame:
    """Share of a row in its group, by aggregate and join so that no group has to fit a task."""
    totals = rows.groupBy(*WIDE_KEY).agg(F.sum("downloads").alias("_group"))
    return rows.join(totals, WIDE_KEY).withColumn(
        "share_pct", share(F.col("downloads"), F.col("_group"))
    ).drop("_group")


def newest_event() -> list:
    return [F.col("ingest_ts").desc(), F.col("event_id").desc()]


def oldest_event() -> list:
    return [F.col("ingest_ts").asc(), F.col("event_id").asc()]


def bronze_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow table without its share column: newest delivery per key."""
    return dedup_pk(raw_events(spark, sf_dir), newest_event())


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_share_pct(bronze_core(spark, sf_dir)).select(*NARROW_TYPES, "store")


def drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the drop folder: the contract plus when each row was delivered."""
    rows = with_share_pct(raw_events(spark, sf_dir))
    return rows.select(
        *[c for c in DROP_TYPES], F.col("ingest_ts").alias("delivered_at"), "event_id", "store"
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_wide(bronze_core(spark, sf_dir), INGEST_AT)


def lagging_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide table that disagrees with Bronze: built from each key's first delivery, and
    not yet built for the newest day."""
    first = dedup_pk(raw_events(spark, sf_dir), oldest_event())
    rows = to_wide(first, INGEST_AT)
    return rows.where(F.col("dt") < F.lit(date(2024, 1, 30)))


def bronze_without_first_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow table that lost a day which the wide table still has."""
    return bronze(spark, sf_dir).where(F.col("dt") > F.lit(date(2024, 1, 1)))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned table. First load: all days. Second load: the iOS partitions of the last
    week restated (one more paid featured download per iPhone row, all rows final) and the
    iOS partitions before January 10 delivered again unchanged."""
    base = wide(spark, sf_dir)
    ios = F.col("app_store") == "ios"
    more = F.when(F.col("device") == "iphone", 1).otherwise(0)
    grown = ("downloads_total", "downloads_featured", "downloads_paid_featured")
    restated = base.where(ios & (F.col("dt") >= F.lit(date(2024, 1, 24)))).select(
        *WIDE_KEY,
        *[(F.col(c) + more).alias(c) if c in grown else F.col(c) for c in MEASURES],
        F.lit(True).alias("is_estimate_final"),
        "ingest_ts",
    )
    restated = conform_columns(with_shares(restated))
    again = base.where(ios & (F.col("dt") < F.lit(date(2024, 1, 10))))

    def loaded(rows, at):
        return rows.select(*WIDE_TYPES, utc_stamp(at).alias(LOADED_AT))

    return loaded(base, LOAD_1).unionByName(loaded(restated.unionByName(again), LOAD_2))


def dirty_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows with one kind of defect per stretch of days; clean from January 26 on.

    1-5 iOS iPad: dates 30 days off. 6-10 Google Play, Japan: no product. 11-15 iOS, US:
    negative totals. 16-20 Google Play tablets: rows lost. Until the 25th the channel
    ``error`` breaks the total.
    """
    narrow = bronze_core(spark, sf_dir).where(
        (F.col("channel") != "error") | (F.col("dt") < F.lit(date(2024, 1, 26)))
    )
    rows = to_wide(narrow, INGEST_AT)

    def days(first, last):
        return F.col("dt").between(F.lit(date(2024, 1, first)), F.lit(date(2024, 1, last)))

    off = days(1, 5) & (F.col("device") == "ipad")
    nameless = days(6, 10) & (F.col("app_store") == "google-play") & (F.col("country") == "JP")
    negative = days(11, 15) & (F.col("app_store") == "ios") & (F.col("country") == "US")
    lost = days(16, 20) & (F.col("device") == "android-tablet")
    changed = {
        "dt": F.when(off, F.date_add("dt", 30)).otherwise(F.col("dt")),
        "product_id": F.when(~nameless, F.col("product_id")),
        "downloads_total": F.when(negative, -F.col("downloads_total")).otherwise(F.col("downloads_total")),
    }
    return rows.where(~lost).select(
        F.col("dt").alias("partition_dt"),
        F.col("app_store").alias("store"),
        *[changed.get(c, F.col(c)).alias(c) for c in WIDE_TYPES],
    )


def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-count baseline of the dirty table, from Bronze."""
    keys = pivot_wide(bronze_core(spark, sf_dir).where(
        (F.col("channel") != "error") | (F.col("dt") < F.lit(date(2024, 1, 26)))
    ))
    return keys.groupBy(F.col("dt").alias("partition_dt"), F.col("app_store").alias("store")).agg(
        F.count("*").alias("expected_count")
    )


def copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two copies of the wide table that differ in a few days.

    The right one has padded countries and sub-second stamps (no difference), misses the
    iPads of January 3, has other organic numbers for Brazil on the 5th, no paid share on
    the 7th and slightly other featured shares on the 9th; the left one misses the 11th.
    """
    left = wide(spark, sf_dir)

    def on(day):
        return F.col("dt") == F.lit(date(2024, 1, day))

    nudged = F.col("featured_share") + F.lit(0.0001).cast("decimal(6,4)")
    changed = {
        "country": F.rpad("country", 4, " "),
        "downloads_organic": F.when(on(5) & (F.col("country") == "BR"), F.col("downloads_organic") + 1).otherwise(
            F.col("downloads_organic")
        ),
        "paid_share": F.when(~on(7), F.col("paid_share")),
        "featured_share": F.when(on(9), nudged).otherwise(F.col("featured_share")),
        "ingest_ts": F.col("ingest_ts") + F.expr("INTERVAL '0.25' SECOND"),
    }
    right = left.where(~(on(3) & (F.col("device") == "ipad"))).select(
        *[changed.get(c, F.col(c)).cast(t).alias(c) for c, t in WIDE_TYPES.items()]
    )
    return left.where(~on(11)), right


def bulk_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow rows from ``lineitem``. The two lookups are given no join hint: Spark
    broadcasts them while they are small and shuffles them when they are not. They are joined
    one by one, as the size of a join of both would be taken for the product of theirs."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus", "l_returnflag", "l_quantity", "l_shipdate", "l_extendedprice"
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    open_line = F.col("l_linestatus") == "O"
    even = F.col("l_suppkey") % 2 == 0
    device = (
        F.when(open_line & even, "iphone")
        .when(open_line, "ipad")
        .when(even, "android-phone")
        .otherwise("android-tablet")
    )
    channel = F.element_at(
        F.array(*[F.lit(c) for c in ("paid_featured", "paid_organic", "unpaid_featured", "unpaid_organic")]),
        F.col("l_linenumber") % 4 + 1,
    )
    placed = line.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return placed.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.to_date("l_shipdate").alias("dt"),
        F.col("l_suppkey").alias("product_id"),
        F.when(open_line, "ios").otherwise("google-play").alias("app_store"),
        "country",
        device.alias("device"),
        channel.alias("channel"),
        F.col("l_quantity").cast("bigint").alias("downloads"),
        (F.col("l_returnflag") != "N").alias("is_estimate_final"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.when(open_line, "ios").otherwise("google-play").alias("store"),
    )


#: Rows of the large narrow table that one task sorts and sums up, about.
TASK_ROWS = 1 << 18


def bulk_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bulk_raw`` dealt by wide key over as many tasks as it has rows for.

    Dedup, pivot and counts of channels all go by that key, so no further shuffle follows and a
    task holds about ``TASK_ROWS`` rows, however many there are. Left to Spark, a task has 64 MB
    of compressed rows, or as many as the fixed number of shuffle partitions leaves it. What one
    task can hold is not dealt; there Spark limits and combines keys before its own shuffle.
    """
    rows = table(spark, sf_dir, "lineitem").count()
    raw = bulk_raw(spark, sf_dir)
    if rows <= TASK_ROWS:
        return raw
    return raw.repartition(max(-(-rows // TASK_ROWS), spark.sparkContext.defaultParallelism), *WIDE_KEY)


def bulk_order() -> list:
    return [
        F.col(c).desc()
        for c in ("l_orderkey", "l_linenumber", "l_extendedprice", "downloads", "is_estimate_final")
    ]


def bulk_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_pk(bulk_dealt(spark, sf_dir), bulk_order())


def bulk_stale_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table built from the first instead of the last delivery of each key."""
    oldest = [
        F.col(c).asc()
        for c in ("l_orderkey", "l_linenumber", "l_extendedprice", "downloads", "is_estimate_final")
    ]
    return to_wide(dedup_pk(bulk_dealt(spark, sf_dir), oldest), INGEST_AT)


def drop_files(spark: SparkSession, sf_dir: str, until: datetime | None = None) -> DataFrame:
    """Manifest of a drop with one file per channel and partition, as of a point in time."""
    rows = raw_events(spark, sf_dir)
    if until is not None:
        rows = rows.where(F.col("ingest_ts") < utc_stamp(until))
    return rows.groupBy("dt", "store", F.concat(F.lit("part-"), "channel").alias("file_path")).agg(
        F.md5(F.concat_ws(":", F.count("*"), F.sum("downloads"))).alias("fingerprint")
    )


def previous_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files the run of January 25 noon saw; on the 10th there was one file more."""
    seen = drop_files(spark, sf_dir, PREVIOUS_RUN)
    gone = seen.where(F.col("dt") == F.lit(date(2024, 1, 10))).select(
        *PARTITION, F.lit("part-withdrawn").alias("file_path"), F.lit("x").alias("fingerprint")
    ).distinct()
    return seen.unionByName(gone)


def ledger_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of two Bronze runs, a Silver run and one run that never ended.

    Run 1 on January 25 (all days so far; the 20th failed), run 2 on the 31st (the lookback
    window), Silver after run 1, and a Bronze retry of the 30th left running.
    """
    rows = raw_events(spark, sf_dir)

    def entries(layer, part, run_id, at, status, out):
        counts = part.groupBy(*PARTITION).agg(F.count("*").alias("in_count"), out.alias("out_count"))
        running = F.col("status") == "running"
        return counts.select(
            F.lit(layer).alias("layer"),
            *PARTITION,
            status.alias("status"),
            "in_count",
            "out_count",
            F.lit(0).cast("bigint").alias("dlq_rows"),
            F.lit(0).cast("bigint").alias("dlq_files"),
            F.lit(run_id).alias("job_run_id"),
            utc_stamp(at).alias("recorded_at"),
        ).withColumn(
            "lock_expires_at",
            F.when(running, F.col("recorded_at") + F.expr("INTERVAL 2 HOURS")),
        )

    key = F.countDistinct("product_id", "country", "device", "channel")
    failed = F.when(F.col("dt") == F.lit(date(2024, 1, 20)), "failed").otherwise("succeeded")
    seen = rows.where(F.col("ingest_ts") < utc_stamp(PREVIOUS_RUN))
    recent = rows.where(F.col("dt") >= F.lit(date(2024, 1, 17)))
    newest = rows.where(F.col("dt") == F.lit(date(2024, 1, 30)))
    return (
        entries("bronze", seen, "run-1", PREVIOUS_RUN, failed, key)
        .unionByName(entries("silver", seen, "run-1s", datetime(2024, 1, 25, 13, 0), F.lit("succeeded"), key))
        .unionByName(entries("bronze", recent, "run-2", INGEST_AT, F.lit("succeeded"), key))
        .unionByName(entries("bronze", newest, "run-3", datetime(2024, 2, 1, 9, 0), F.lit("running"), key))
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load history of the versioned table: one file per day, store and load.

    A file with rows that have no paid share counts as partially loaded.
    """
    files = versions(spark, sf_dir).groupBy("dt", "app_store", LOADED_AT).agg(
        F.count("*").alias("row_parsed"), F.count_if(F.col("paid_share").isNull()).alias("error_count")
    )
    name = F.concat_ws(
        "/", F.date_format("dt", "yyyy-MM-dd"), "app_store", F.date_format(LOADED_AT, "yyyyMMddHHmm")
    )
    bad = F.col("error_count") > 0
    return files.select(
        name.alias("file_name"),
        "dt",
        F.when(bad, "Partially loaded").otherwise("Loaded").alias("status"),
        (F.col("row_parsed") - F.col("error_count")).alias("row_count"),
        "row_parsed",
        "error_count",
        F.when(bad, F.format_string("%d rows do not fit the contract", "error_count")).alias("first_error_message"),
        F.col(LOADED_AT).alias("last_load_time"),
    )


def refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh history: each aggregate refreshed after each load of each day; the trend's
    refreshes after the second load failed, the country table's newest one never ended."""
    loads = versions(spark, sf_dir).groupBy("dt", LOADED_AT).agg(F.count("*").alias("n"))
    second = F.col(LOADED_AT) == utc_stamp(LOAD_2)
    names = F.explode(F.array(*[F.lit(n) for n in ("daily_by_app", "daily_by_country", "paid_vs_organic_trend")]))
    rows = loads.select("dt", LOADED_AT, "n", names.alias("name"))
    failed = second & (F.col("name") == "paid_vs_organic_trend")
    endless = second & (F.col("name") == "daily_by_country") & (F.col("dt") == F.lit(date(2024, 1, 30)))
    start = F.col(LOADED_AT) + F.make_dt_interval(mins=F.dayofmonth("dt") * 3)
    return rows.select(
        "name",
        F.when(failed, "FAILED").when(endless, "EXECUTING").otherwise("SUCCEEDED").alias("state"),
        F.lit("INCREMENTAL").alias("refresh_action"),
        start.alias("refresh_start_time"),
        F.when(~endless, start + F.make_dt_interval(secs=F.lit(30).cast("decimal(18,6)"))).alias("refresh_end_time"),
    )


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error records, one per drop file: contract breaks on the 24th, processing errors on
    the 28th, records without a type on the 29th and unreadable ones on the 30th."""
    files = drop_files(spark, sf_dir)
    day = F.dayofmonth("dt")
    kind = F.when(day == 24, "SCHEMA_MISMATCH").when(day == 28, "PROCESSING_ERROR").when(day < 24, "DQ_BLOCK")
    return files.select(
        kind.alias("error_type"),
        F.concat_ws("/", F.date_format("dt", "yyyy-MM-dd"), "store", "file_path").alias("source_file"),
        (F.date_add("dt", 1).cast("timestamp") + F.expr("INTERVAL 10 HOURS")).alias("recorded_at"),
        (day != 30).alias("readable"),
    )


def wrong_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned rows whose shares are off on three days."""
    def on(day):
        return F.col("dt") == F.lit(date(2024, 1, day))

    def dec(text):
        return F.lit(text).cast("decimal(6,4)")

    paid = F.when(on(12), F.col("paid_share") + dec("0.0200")).when(on(13), dec("1.5")).otherwise(F.col("paid_share"))
    featured = F.when(on(14), F.col("featured_share") - dec("0.0300")).otherwise(F.col("featured_share"))
    return versions(spark, sf_dir).withColumns(
        {"paid_share": paid.cast("decimal(6,4)"), "featured_share": featured.cast("decimal(6,4)")}
    )


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), "n_regionkey")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("country", "region")


def text_flag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows as a careless writer delivers them: the flag is text, ``N/A`` where there
    were no downloads. One file per day and store."""
    flag = (
        F.when(F.col("downloads_total") == 0, "N/A").when(F.col("is_estimate_final"), "TRUE").otherwise("no")
    )
    name = F.concat_ws("/", F.date_format("dt", "yyyy-MM-dd"), "app_store")
    return wide(spark, sf_dir).withColumn("is_estimate_final", flag).withColumn("_source_file", name)
