"""The registered queries: name -> function of (session, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import DROP_TYPES, MEASURES, NARROW_KEY, NARROW_TYPES, PARTITION, SHARES, VERSIONED_TYPES, WIDE_KEY, WIDE_TYPES, ddl
from ..functions import bool_load_rule
from ..functions.stamps import utc_stamp
from ..operators import audits, bi, cleaning, gold, ledger, loading, monitors, parity, pivot, quality, quarantine, recon, versions
from ..plans import upkeep
from ..plans.bronze import BronzeRun, bronze_build
from ..plans.layout import Layout, layer_state, read_bronze, read_silver
from ..plans.layout import fold_ledgers as fold_ledgers_of
from ..plans.layout import ledger_state as plain_state
from ..plans.silver import silver_build, stage_and_check
from ..session import new_workspace
from ..sources import drop, folders, manifest, seed, tables
from ..sources.commits import write_attempt
from ..sources.footers import footer_columns
from ..streaming import append_load as load
from ..streaming import gold_refresh
from . import inputs as i

Query = Callable[[SparkSession, str], DataFrame]
DELIVERED = {"delivered_at": "timestamp", "event_id": "bigint"}
REGISTRY: dict[str, Query] = {}


def query(name: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Days and stamps are UTC, whatever zone the session was started in.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        REGISTRY[name or fn.__name__] = run
        return fn

    return register


def over(source, fn, *args, name: str, **kwargs) -> None:
    """Register ``fn`` applied to one derived table."""
    query(name)(lambda spark, sf_dir: fn(source(spark, sf_dir), *args, **kwargs))


def over_two(left, right, fn, *args, name: str, **kwargs) -> None:
    query(name)(lambda spark, sf_dir: fn(left(spark, sf_dir), right(spark, sf_dir), *args, **kwargs))


# Drop folder, manifests, sinks.


def write_drop(spark: SparkSession, sf_dir: str, root: str, broken: bool = False) -> None:
    """Deliver the drop; ``broken`` drops a column on January 5 and mistypes it on the 6th."""
    rows = i.drop_rows(spark, sf_dir)
    if not broken:
        tables.overwrite_partitions(rows, root)
        return
    fifth, sixth = F.lit(date(2024, 1, 5)), F.lit(date(2024, 1, 6))
    tables.overwrite_partitions(rows.where(~F.col("dt").isin(fifth, sixth)), root)
    tables.overwrite_partitions(rows.where(F.col("dt") == fifth).drop("is_estimate_final"), root)
    mistyped = rows.where(F.col("dt") == sixth).withColumn(
        "is_estimate_final", F.col("is_estimate_final").cast("string")
    )
    tables.overwrite_partitions(mistyped, root)


DROP_VIEW = [*DROP_TYPES, "store"]


@query()
def scan_drop(spark, sf_dir):
    root = new_workspace(spark, "drop")
    write_drop(spark, sf_dir, root)
    return drop.scan_drop(spark, root).select(*DROP_VIEW)


@query()
def scan_drop_csv(spark, sf_dir):
    root = new_workspace(spark, "csv")
    rows = i.drop_rows(spark, sf_dir).select(*DROP_VIEW)
    writer = rows.hint("rebalance", *[F.col(c) for c in PARTITION]).write.partitionBy(*PARTITION)
    writer.option("header", True).option("compression", "gzip").csv(root)
    return drop.scan_drop_csv(spark, root).select(*DROP_VIEW)


KEYS_SEEN = [*NARROW_KEY, "downloads", "event_id", "store"]


@query()
def partition_window(spark, sf_dir):
    return drop.partition_window(i.raw_events(spark, sf_dir), i.AS_OF).select(*KEYS_SEEN)


@query()
def partition_window_target(spark, sf_dir):
    rows = i.raw_events(spark, sf_dir)
    return drop.partition_window(rows, i.AS_OF, target_dt=date(2024, 1, 3), target_store="ios").select(*KEYS_SEEN)


@query()
def backfill_range(spark, sf_dir):
    rows = i.raw_events(spark, sf_dir)
    return drop.backfill_range(rows, date(2024, 1, 5), date(2024, 1, 12)).select(*KEYS_SEEN)


@query()
def file_manifest(spark, sf_dir):
    """Every file with its content hash, beside what Spark reads from the same file.

    One file a partition, written sorted: rows and their hash say whether the file is the right one.
    """
    root = new_workspace(spark, "manifest")
    write_drop(spark, sf_dir, root)
    files = manifest.file_manifest(spark, root, by_content=True)
    rows = drop.with_source(drop.scan_drop(spark, root)).withColumn("file_path", manifest.plain_path(F.col(drop.SOURCE_FILE)))
    held = rows.groupBy("file_path").agg(F.count("*").alias("row_count"), F.sum("downloads").alias("downloads"))
    hashed = F.col("fingerprint").rlike("^[0-9a-f]{32}$") & (F.col("file_bytes") > 0)
    return files.join(held, "file_path").groupBy(*PARTITION).agg(
        F.bool_and(hashed).alias("all_hashed"),
        F.sum("row_count").alias("row_count"),
        F.sum("downloads").alias("downloads"),
        (F.count_distinct("fingerprint") == F.count("*")).alias("all_different"),
    )


def run_1_state(spark, sf_dir):
    entries = i.ledger_entries(spark, sf_dir).where("job_run_id IN ('run-1', 'run-3') AND layer = 'bronze'")
    return ledger.run_ledger(entries)


@query()
def restate_detect(spark, sf_dir):
    return ledger.restate_detect(
        i.drop_files(spark, sf_dir),
        run_1_state(spark, sf_dir),
        i.previous_manifest(spark, sf_dir),
        now=datetime(2024, 2, 1, 10),
    )


def ledger_state(spark, sf_dir):
    return ledger.run_ledger(i.ledger_entries(spark, sf_dir))


query("run_ledger")(ledger_state)


@query()
def upstream_gate(spark, sf_dir):
    rows = ledger.upstream_gate(i.raw_events(spark, sf_dir), ledger_state(spark, sf_dir))
    return rows.select(*PARTITION, "product_id", "channel", "downloads", "event_id")


over(ledger_state, ledger.stale_silver, name="stale_silver")


@query()
def empty_partition(spark, sf_dir):
    rows = i.raw_events(spark, sf_dir)
    early = rows.where(F.col("ingest_ts") < utc_stamp(i.PREVIOUS_RUN))
    counts = early.groupBy(*PARTITION).agg(F.count("*").alias("in_count"))
    return ledger.empty_partitions(i.drop_files(spark, sf_dir), counts)


@query()
def overwrite_partition(spark, sf_dir):
    """Write all partitions, then replace the restated ones twice."""
    root = new_workspace(spark, "overwrite")
    tables.overwrite_partitions(i.wide(spark, sf_dir).withColumn("store", F.col("app_store")), root)
    restated = i.versions(spark, sf_dir).where(
        (F.col("_loaded_at") == utc_stamp(i.LOAD_2)) & (F.col("dt") >= F.lit(date(2024, 1, 24)))
    )
    for _ in range(2):
        tables.overwrite_partitions(
            restated.select(*WIDE_TYPES, F.col("app_store").alias("store")), root
        )
    return tables.read_table(spark, root, ddl({**WIDE_TYPES, "store": "string"})).select(*WIDE_TYPES)


@query()
def register_table(spark, sf_dir):
    root = new_workspace(spark, "registered")
    tables.overwrite_partitions(i.wide(spark, sf_dir).withColumn("store", F.col("app_store")), root)
    name = "wide_" + root.rsplit("-", 1)[1]
    tables.register_table(spark, name, root, WIDE_TYPES)
    tables.add_partition(spark, name, "2024-01-15", "ios")
    return tables.register_table(spark, name, root, WIDE_TYPES)


def deliver_wide(rows: DataFrame, source: str) -> None:
    """Write wide rows as new files beside the ones already delivered."""
    by = F.col("app_store").alias("store")
    (
        rows.select(*WIDE_TYPES, by)
        .hint("rebalance", *[F.col(c) for c in PARTITION])
        .write.mode("append")
        .partitionBy(*PARTITION)
        .parquet(source)
    )


def loaded_versions(spark, sf_dir, root, gold_target=None) -> load.LoadTarget:
    """Deliver and load both loads of the versioned table with the file stream."""
    target = load.LoadTarget.under(root)
    source = f"{root}/source"
    both = i.versions(spark, sf_dir)
    for at in (i.LOAD_1, i.LOAD_2):
        rows = both.where(F.col("_loaded_at") == utc_stamp(at))
        deliver_wide(rows, source)

        def clock(batch_id, at=at):
            return at

        if gold_target is None:
            load.append_load(spark, source, target, clock=clock).awaitTermination()
        else:
            gold_refresh.load_and_refresh(spark, source, target, gold_target, clock=clock).awaitTermination()
    return target


@query("append_load")
def append_load_query(spark, sf_dir):
    target = loaded_versions(spark, sf_dir, new_workspace(spark, "load"))
    return load.read_versions(spark, target).select(*VERSIONED_TYPES)


@query()
def append_load_after_crash(spark, sf_dir):
    """Rows of a load: its first batch dies before its commit, the files are reloaded by hand, then
    the stream takes the batch again."""
    root = new_workspace(spark, "load-crash")
    target, source = load.LoadTarget.under(root), f"{root}/source"
    rows = i.versions(spark, sf_dir).where(F.col("_loaded_at") == utc_stamp(i.LOAD_1))
    deliver_wide(rows, source)
    write_attempt(rows.withColumn(load.BATCH, F.lit(0).cast("bigint")), target.table, load.VERSIONS, ["dt", load.BATCH])
    load.reload_files(spark, source, target, i.LOAD_1)
    load.append_load(spark, source, target, clock=lambda batch_id: i.LOAD_2).awaitTermination()
    return load.read_versions(spark, target).select(*VERSIONED_TYPES)


@query()
def load_cast(spark, sf_dir):
    text = i.wide(spark, sf_dir)
    return versions.load_cast(text.select(*[F.col(c).cast("string").alias(c) for c in text.columns]))


def on_error(mode, limit=None):
    def run(spark, sf_dir):
        return loading.load_on_error(i.text_flag_rows(spark, sf_dir), mode, limit)

    return run


query("load_on_error")(on_error("skip_file"))
query("load_on_error_continue")(on_error("continue"))
query("load_on_error_skip_file_n")(on_error("skip_file_n", 1))
over(i.text_flag_rows, loading.load_history, i.LOAD_1, name="load_history_of_load")


@query()
def bool_cast_matrix(spark, sf_dir):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", "TRUE").when(kind == "view", "no").when(kind == "signup", " YES ")
        .when(kind == "purchase", "maybe").otherwise("")
    )
    number = ((F.col("user_id") % 4) - 1).cast("int")
    raw = i.table(spark, sf_dir, "events").select(text.alias("raw_text"), number.alias("raw_int"))
    counted = raw.groupBy("raw_text", "raw_int").agg(F.count("*").alias("n"))
    return counted.select(
        "raw_text",
        "raw_int",
        bool_load_rule(F.col("raw_text"), "string").alias("from_text"),
        bool_load_rule(F.col("raw_int"), "int").alias("from_int"),
        "n",
    )


over(i.history, monitors.load_history_window, i.NOW, name="load_history")
over(i.history, monitors.load_history_by_day, name="load_history_by_day")


def _full_name():
    return F.concat_ws("/", F.date_format("dt", "yyyy-MM-dd"), "store", "file_path")


def _seen_names(spark, sf_dir):
    return i.drop_files(spark, sf_dir, i.PREVIOUS_RUN).select(_full_name().alias("file_name"))


@query()
def pending_files(spark, sf_dir):
    files = i.drop_files(spark, sf_dir).select(*PARTITION, F.col("file_path").alias("part"), _full_name().alias("file_path"))
    pending = manifest.pending_files(files, _seen_names(spark, sf_dir))
    return pending.select(*PARTITION, F.col("part").alias("file_path"))


@query()
def reload_missing(spark, sf_dir):
    files = i.raw_events(spark, sf_dir).groupBy(
        *PARTITION, F.concat(F.lit("part-"), "channel").alias("part")
    ).agg(F.max("ingest_ts").alias("modified_at"))
    files = files.withColumn("file_path", F.concat_ws("/", F.date_format("dt", "yyyy-MM-dd"), "store", "part"))
    todo = manifest.reload_missing(files, _seen_names(spark, sf_dir), datetime(2024, 1, 28))
    return todo.select(*PARTITION, F.col("part").alias("file_path"))


RUN = BronzeRun("run-1", i.INGEST_AT, i.AS_OF, backfill=True)


def newest_delivery():
    return [F.col("delivered_at").desc(), F.col("event_id").desc()]


def built_bronze(spark, sf_dir, purpose, broken=False) -> Layout:
    layout = Layout(new_workspace(spark, purpose))
    write_drop(spark, sf_dir, layout.drop, broken)
    bronze_build(spark, layout, RUN, extra=DELIVERED, order=newest_delivery())
    return layout


@query("bronze_build")
def bronze_build_query(spark, sf_dir):
    layout = built_bronze(spark, sf_dir, "bronze")
    return read_bronze(spark, layout).select(*NARROW_TYPES, "store")


@query()
def quarantine_files(spark, sf_dir):
    layout = built_bronze(spark, sf_dir, "quarantine", broken=True)
    return layer_state(spark, layout, "bronze").select(*PARTITION, "status", "in_count", "out_count", "dlq_rows")


def replayed(spark, sf_dir) -> tuple[Layout, DataFrame]:
    """Two rejected days; the first is cleared from the drop before the replay, the second still there."""
    layout = built_bronze(spark, sf_dir, "replay", broken=True)
    folders.remove(spark, f"{layout.drop}/dt=2024-01-05")
    return layout, upkeep.dlq_replay(spark, layout, "2024-01-31", i.NOW)


@query()
def dlq_replay(spark, sf_dir):
    """Entries of a replay by partition; how many files one has depends on its size."""
    _, log = replayed(spark, sf_dir)
    key = ["failed_at", "kind", "job_run_id", *PARTITION, "action"]
    count = F.when(F.col("kind") == "error", F.lit(1)).otherwise(F.sum("row_count"))
    return log.groupBy(*key).agg(count.cast("bigint").alias("row_count"))


@query()
def dlq_replay_rows(spark, sf_dir):
    """Rows of the rejected days as the drop holds them after the replay."""
    layout, _ = replayed(spark, sf_dir)
    days = [spark.read.parquet(f"{layout.drop}/dt=2024-01-0{d}") for d in (5, 6)]
    flag = F.lit(None).cast("string").alias("is_estimate_final")
    return days[0].select(F.lit(date(2024, 1, 5)).alias("dt"), "store", "event_id", "downloads", flag).unionByName(
        days[1].select(F.lit(date(2024, 1, 6)).alias("dt"), "store", "event_id", "downloads", "is_estimate_final")
    )


@query()
def backfill_build(spark, sf_dir):
    """A drop that was processed and then restated; a backfill of some days takes them again."""
    layout = built_bronze(spark, sf_dir, "backfill")
    silver_build(spark, layout, "silver-1", i.INGEST_AT)
    upkeep.backfill_days(spark, layout, "run-2", i.NOW, date(2024, 1, 5), date(2024, 1, 12), order=newest_delivery())
    return plain_state(spark, layout).select("layer", *PARTITION, "status", "in_count", "out_count", "job_run_id")


@query()
def fold_ledgers(spark, sf_dir):
    """State of all partitions after two runs and a fold of the first half's ledgers."""
    layout = built_bronze(spark, sf_dir, "fold")
    bronze_build(spark, layout, BronzeRun("run-2", i.NOW, i.AS_OF, backfill=True), order=newest_delivery())
    fold_ledgers_of(spark, layout, date(2024, 1, 16))
    return plain_state(spark, layout).select("layer", *PARTITION, "status", "in_count", "out_count", "job_run_id")


@query()
def schema_evolution(spark, sf_dir):
    """A column beyond the contract in the files of odd days, narrower in some: Bronze holds it for all."""
    layout = Layout(new_workspace(spark, "evolution"))
    rows = i.drop_rows(spark, sf_dir)
    day = F.dayofmonth("dt")
    tables.overwrite_partitions(rows.where(day % 2 == 0), layout.drop)
    campaign = F.pmod(F.col("event_id"), F.lit(7))
    for left, kind in ((1, "int"), (3, "bigint")):
        some = rows.where((day % 4 == left)).withColumn("campaign", campaign.cast(kind))
        tables.overwrite_partitions(some, layout.drop)
    bronze_build(spark, layout, RUN, order=newest_delivery())
    return read_bronze(spark, layout, every_column=True).select(*NARROW_KEY, "downloads", "campaign", "event_id")


@query()
def dlq_replay_plan(spark, sf_dir):
    kind = (
        F.when(F.col("error_type").isin("SCHEMA_MISMATCH", "PROCESSING_ERROR"), "raw")
        .when(F.col("error_type") == "DQ_BLOCK", "wide")
        .otherwise("error")
    )
    entries = i.error_log(spark, sf_dir).select(
        F.to_date("recorded_at").alias("failed_at"), kind.alias("kind"), "source_file"
    )
    return quarantine.dlq_replay_plan(entries, date(2024, 1, 25))


@query()
def seed_narrow(spark, sf_dir):
    ids = i.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return seed.seed_narrow(ids, date(2024, 1, 15), "ios")


# Contract checks and cleaning.


def broken_footers(spark, sf_dir):
    root = new_workspace(spark, "contract")
    write_drop(spark, sf_dir, root, broken=True)
    return footer_columns(manifest.file_manifest(spark, root))


@query()
def schema_missing_cols(spark, sf_dir):
    return cleaning.schema_missing_cols(broken_footers(spark, sf_dir)).drop("file_path").distinct()


@query()
def schema_type_mismatch(spark, sf_dir):
    return cleaning.schema_type_mismatch(broken_footers(spark, sf_dir)).drop("file_path").distinct()


@query()
def schema_gate(spark, sf_dir):
    verdicts = cleaning.schema_gate(broken_footers(spark, sf_dir))
    return verdicts.select(*PARTITION, (F.col("bad_files") == 0).alias("passed"), "error_message")


@query()
def cast_contract(spark, sf_dir):
    kept = [*NARROW_KEY, "downloads", "is_estimate_final"]
    raw = i.raw_events(spark, sf_dir)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in kept], "event_id")
    return cleaning.cast_contract(text)


@query()
def trim_strings(spark, sf_dir):
    raw = i.raw_events(spark, sf_dir).select(*NARROW_KEY, "downloads", "event_id")
    padded = raw.select(*[F.concat(F.lit("  "), c, F.lit(" ")).alias(c) if t == "string" else F.col(c) for c, t in raw.dtypes])
    return cleaning.trim_strings(padded)


@query()
def stamp_ingest(spark, sf_dir):
    raw = i.raw_events(spark, sf_dir).select(*NARROW_KEY, "downloads", "event_id")
    return cleaning.stamp_ingest(raw, i.INGEST_AT)


@query()
def dedup_pk(spark, sf_dir):
    return i.bronze(spark, sf_dir).drop("store")


@query()
def dedup_pk_bulk(spark, sf_dir):
    return i.bulk_bronze(spark, sf_dir).drop("store")


over(i.raw_events, cleaning.dedup_metrics, name="dedup_metrics")

# Pivot and shares.

over(i.bronze_core, pivot.pivot_wide, name="pivot_wide")


@query()
def pivot_wide_bulk(spark, sf_dir):
    return pivot.with_shares(pivot.pivot_wide(i.bulk_bronze(spark, sf_dir)))


@query()
def finalized_flag(spark, sf_dir):
    return i.bronze_core(spark, sf_dir).groupBy(*WIDE_KEY).agg(pivot.finalized_flag())


@query()
def paid_share(spark, sf_dir):
    return pivot.pivot_wide(i.bronze_core(spark, sf_dir)).select(*WIDE_KEY, pivot.paid_share())


@query()
def featured_share(spark, sf_dir):
    return pivot.pivot_wide(i.bronze_core(spark, sf_dir)).select(*WIDE_KEY, pivot.featured_share())


over(i.bronze_core, pivot.expected_wide_keys, name="expected_wide_keys")


@query()
def conform_columns(spark, sf_dir):
    shuffled = i.wide(spark, sf_dir).select(*sorted(WIDE_TYPES), F.lit(1).alias("helper"))
    return pivot.conform_columns(shuffled)


@query("silver_build")
def silver_build_query(spark, sf_dir):
    """Drop to Silver with both jobs. The channel outside the domain only warns."""
    layout = built_bronze(spark, sf_dir, "silver")
    silver_build(spark, layout, "run-2", i.INGEST_AT)
    return read_silver(spark, layout)


@query()
def silver_build_bulk(spark, sf_dir):
    """Pivot, staging and checks on the larger narrow table: verdicts per partition."""
    layout = Layout(new_workspace(spark, "silver-bulk"))
    i.bulk_bronze(spark, sf_dir).write.parquet(layout.bronze)
    narrow = spark.read.parquet(layout.bronze)
    return stage_and_check(spark, layout, narrow, "run-1", i.INGEST_AT).gate


@query()
def silver_build_bulk_rows(spark, sf_dir):
    """The staged rows behind the verdicts."""
    layout = Layout(new_workspace(spark, "silver-bulk"))
    i.bulk_bronze(spark, sf_dir).write.parquet(layout.bronze)
    narrow = spark.read.parquet(layout.bronze)
    return stage_and_check(spark, layout, narrow, "run-1", i.INGEST_AT).rows.select(*WIDE_KEY, *MEASURES, *SHARES, "is_estimate_final", "store")


# Quality.


def dq(*checks):
    def run(spark, sf_dir):
        metrics = quality.dq_metrics(i.dirty_wide(spark, sf_dir), i.expected_counts(spark, sf_dir))
        return quality.dq_results(metrics, list(checks))

    return run


for check in ("row_count", "null_rate", "date_range", "non_negative", "equation"):
    query(f"dq_{check}")(dq(check))

over_two(i.dirty_wide, i.expected_counts, quality.dq_run_all, name="dq_run_all")


def gate(spark, sf_dir):
    return quality.dq_gate(dq()(spark, sf_dir))


query("dq_gate")(gate)
over(gate, quality.alert_records, name="alert_records")


@query()
def error_records(spark, sf_dir):
    blocked = gate(spark, sf_dir).where("verdict = 'block'").withColumn("dt", F.col("partition_dt"))
    source = F.concat_ws("/", F.lit("silver"), "store")
    return quarantine.error_records(blocked, quarantine.DQ_BLOCK, F.col("failures"), source, "run-1", i.INGEST_AT)


@query()
def quarantine_frame(spark, sf_dir):
    blocked = gate(spark, sf_dir).where("verdict = 'block'").select("partition_dt", "store")
    rows = i.dirty_wide(spark, sf_dir).join(blocked, ["partition_dt", "store"], "left_semi")
    return quarantine.quarantine_frame(rows, quarantine.DQ_BLOCK, "run-1", i.INGEST_AT)


# Versions and Gold.

over(i.versions, versions.dedup_versions, i.AS_OF, name="dedup_versions")
over(i.versions, versions.latest_view, name="latest_view")
over(i.versions, versions.finalized_changed, name="finalized_changed")


def latest(spark, sf_dir):
    return versions.latest_view(i.versions(spark, sf_dir))


@query()
def dedup_versions_in_place(spark, sf_dir):
    """Load both batches as tables do, then rewrite the days that have superseded rows."""
    root = new_workspace(spark, "dedup")
    target = load.LoadTarget.under(root)
    both = i.versions(spark, sf_dir)
    for number, at in enumerate((i.LOAD_1, i.LOAD_2)):
        rows = both.where(F.col("_loaded_at") == utc_stamp(at))
        load.append_batch(spark, rows, target, number, at)
    upkeep.dedup_in_place(spark, target, i.AS_OF)
    return load.read_versions(spark, target).select(*VERSIONED_TYPES)


over(i.versions, gold.gold_daily_by_app, name="gold_daily_by_app")
over(i.versions, gold.gold_daily_by_country, name="gold_daily_by_country")
over(i.versions, gold.gold_paid_vs_organic_trend, i.AS_OF, name="gold_paid_vs_organic_trend")
over(i.versions, gold.gold_trend_all_days, name="gold_trend_all_days")
over(i.versions, gold.gold_daily_by_app, name="gold_from_latest", dedup=True)
over(i.versions, gold.gold_daily_by_country, name="gold_from_latest_country", dedup=True)


@query()
def gold_refresh_incremental(spark, sf_dir):
    """Stream both loads; after each, only the days it touched are aggregated again."""
    root = new_workspace(spark, "gold")
    target = gold_refresh.GoldTarget(f"{root}/gold")
    loaded_versions(spark, sf_dir, root, target)
    return spark.read.parquet(target.path("daily_by_app"))


def incremental(table: str):
    def run(spark, sf_dir):
        root = new_workspace(spark, "gold")
        target = gold_refresh.GoldTarget(f"{root}/gold")
        loaded_versions(spark, sf_dir, root, target)
        return spark.read.parquet(target.path(table))

    return run


def forced(table: str):
    def run(spark, sf_dir):
        target = gold_refresh.GoldTarget(new_workspace(spark, "gold-full"))
        gold_refresh.refresh(spark, i.versions(spark, sf_dir), target)
        return spark.read.parquet(target.path(table))

    return run


query("gold_refresh_incremental_country")(incremental("daily_by_country"))
query("gold_refresh_incremental_trend")(incremental("paid_vs_organic_trend"))
query("force_refresh")(forced("daily_by_country"))
query("force_refresh_app")(forced("daily_by_app"))
query("force_refresh_trend")(forced("paid_vs_organic_trend"))


over(i.refreshes, gold.refresh_history, name="refresh_history")
over(i.refreshes, gold.gold_staleness, i.NOW, name="gold_staleness")

# Audits.

over(i.wide, audits.audit_total_split, name="audit_total_split")
over(i.wide, audits.audit_paid_unpaid_split, name="audit_paid_unpaid_split")
over(i.dirty_wide, audits.audit_featured_leaves, name="audit_featured_leaves")
over(lambda s, d: i.copies(s, d)[1], audits.audit_organic_leaves, name="audit_organic_leaves")
over(i.wide, audits.audit_violation_rate_by_dt, i.AS_OF, name="audit_violation_rate_by_dt")
over(i.wrong_shares, audits.audit_paid_share_recalc, name="audit_paid_share_recalc")
over(i.wrong_shares, audits.audit_featured_share_recalc, name="audit_featured_share_recalc")
over(i.wrong_shares, audits.audit_both_shares_recalc, name="audit_both_shares_recalc")
over(lambda s, d: i.copies(s, d)[1], audits.audit_share_bounds, name="audit_share_bounds")
over(i.versions, audits.audit_wide_duplicates, name="audit_wide_duplicates")
over(i.dirty_wide, audits.audit_wide_null_pct, name="audit_wide_null_pct")
over(i.versions, audits.audit_dt_profile, name="audit_dt_profile")
over(i.dirty_wide, audits.audit_wide_negatives, name="audit_wide_negatives")
over(i.bronze_core, audits.audit_narrow_coverage, i.AS_OF, name="audit_narrow_coverage")
over(i.bronze_core, audits.audit_channel_domain, name="audit_channel_domain")
over(i.raw_events, audits.audit_channel_completeness, name="audit_channel_completeness")
over(i.bulk_dealt, audits.audit_channel_completeness, name="audit_channel_completeness_bulk")
over(i.bronze, audits.audit_share_sum, name="audit_share_sum")
over(
    lambda s, d: i.bronze(s, d).withColumn("channel", F.nullif(F.col("channel"), F.lit("error"))),
    audits.audit_narrow_quality,
    name="audit_narrow_quality",
)
over(i.raw_events, audits.audit_narrow_duplicates, name="audit_narrow_duplicates")
over(i.versions, audits.audit_wide_key_summary, name="audit_wide_key_summary")
over(lambda s, d: i.copies(s, d)[1], audits.audit_equations, name="audit_equations")
over(i.wrong_shares, audits.smoke_wide, name="smoke_wide")

# Reconciliation.

over_two(i.bronze_without_first_day, i.lagging_wide, recon.recon_row_count, name="recon_row_count")
over_two(i.bronze_core, i.lagging_wide, recon.recon_pivot_rows, name="recon_pivot_rows")
over_two(i.bulk_bronze, i.bulk_stale_wide, recon.recon_pivot_rows, name="recon_pivot_rows_bulk")
over_two(i.bronze_without_first_day, i.lagging_wide, recon.recon_missing_in_silver, name="recon_missing_in_silver")
over_two(i.bronze_without_first_day, i.lagging_wide, recon.recon_extra_in_silver, name="recon_extra_in_silver")
over_two(i.bronze, i.lagging_wide, recon.recon_share_sums, name="recon_share_sums")
over_two(i.lagging_wide, i.versions, recon.recon_counts_by_dt, name="recon_counts_by_dt")
over_two(
    lambda s, d: gold.gold_daily_by_app(i.versions(s, d)), latest, recon.recon_gold_app, name="recon_gold_app"
)
over_two(
    lambda s, d: gold.gold_daily_by_country(i.versions(s, d)), latest, recon.recon_gold_country, name="recon_gold_country"
)
over(lambda s, d: gold.gold_trend_all_days(i.versions(s, d)), recon.recon_gold_trend, i.AS_OF, name="recon_gold_trend")
over_two(i.bronze_core, i.lagging_wide, recon.recon_smoke_pivot, name="recon_smoke_pivot")
over_two(i.history, latest, recon.recon_load_vs_table, name="recon_load_vs_table")
over_two(i.drop_files, i.history, recon.recon_file_manifest, name="recon_file_manifest")

# Business reports.

over(latest, bi.bi_top_apps, name="bi_top_apps")
over(latest, bi.bi_country_store_matrix, name="bi_country_store_matrix")
over(latest, bi.bi_weekly_paid_trend, i.AS_OF, name="bi_weekly_paid_trend")
over(latest, bi.bi_wow, date(2024, 1, 30), name="bi_wow")
over(latest, bi.bi_dod7, name="bi_dod7")
over(latest, bi.bi_rolling7, name="bi_rolling7")
over(latest, bi.bi_rolling7_vs_prior, name="bi_rolling7_vs_prior")
over(i.versions, bi.bi_finalization, name="bi_finalization")
over(latest, versions.finalized_only, name="bi_finalized_only")


@query()
def enrich_country(spark, sf_dir):
    rows = i.bulk_raw(spark, sf_dir).select(*NARROW_KEY, "downloads")
    return bi.enrich_country(rows, i.country_lookup(spark, sf_dir)).select(*NARROW_KEY, "downloads", "region")


# Parity.

over(lambda s, d: i.copies(s, d)[0], parity.parity_checksum, name="parity_checksum")
over(i.bulk_stale_wide, parity.parity_checksum, name="parity_checksum_bulk")


@query()
def parity_stats(spark, sf_dir):
    # Shares have four decimals and their squares eight; rounding there takes off what the
    # order of summation adds.
    digits = {"sum": 6, "sumsq": 8}
    stats = parity.parity_stats(i.copies(spark, sf_dir)[1])
    kinds = {c: digits.get(c.rsplit("_", 1)[1]) for c in stats.columns if c != "dt"}
    return stats.select("dt", *[F.round(c, n).alias(c) if n else F.col(c) for c, n in kinds.items()])


query("parity_compare")(lambda spark, sf_dir: parity.parity_compare(*i.copies(spark, sf_dir)))


query("parity_diff_rows")(lambda spark, sf_dir: parity.parity_diff_rows(*i.copies(spark, sf_dir)))
query("parity_leaves")(
    lambda spark, sf_dir: parity.parity_diff_rows(*parity.in_leaves(*i.copies(spark, sf_dir))).select("dt", "issue")
)
query("parity_validate")(lambda spark, sf_dir: parity.parity_validate(*i.copies(spark, sf_dir)))

# Monitors.

over(i.drop_files, monitors.mon_missing_partitions, i.AS_OF, days=4, name="mon_missing_partitions")
over(ledger_state, monitors.mon_stale_runs, i.NOW, name="mon_stale_runs")
over(i.error_log, monitors.mon_dlq_weekly, datetime(2024, 2, 1, 10), name="mon_dlq_weekly")


@query()
def mon_dlq_entries(spark, sf_dir):
    """Quarantine of a run with two rejected days; entries are counted by partition."""
    layout = built_bronze(spark, sf_dir, "weekly", broken=True)
    entries = upkeep.quarantine_entries(spark, layout)
    per_partition = entries.groupBy("failed_at", "kind", "job_run_id", *PARTITION).agg(F.sum("row_count").alias("row_count"))
    errors = F.when(F.col("kind") == "error", F.lit(1)).otherwise(F.col("row_count")).cast("bigint")
    return monitors.mon_dlq_entries(per_partition.withColumn("row_count", errors), i.NOW)


over(i.error_log, monitors.mon_dlq_recent, datetime(2024, 2, 1, 10), name="mon_dlq_recent")
over(i.history, monitors.mon_load_freshness, date(2024, 2, 2), name="mon_load_freshness")
over(i.refreshes, monitors.mon_refresh_failed, i.NOW, name="mon_refresh_failed")
over(i.history, monitors.mon_load_errors, name="mon_load_errors")
over(i.raw_events, monitors.mon_key_skew, ["product_id", "country"], name="mon_key_skew")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
