"""Folded ledgers, hot keys, leaves of differing days, first errors, and Gold tables with lags of their own."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import DAY, narrow_rows, version, wide
from test_commits import AS_OF, OTHER, two_versions
from test_jobs import NEXT, RUN, deliver, state
from test_plans import plan
from test_streams import T1, T2, TEXT, run

from tallymart.catalogue import inputs, queries
from tallymart.contracts import MEASURES, WIDE_KEY
from tallymart.operators import loading, parity, versions
from tallymart.plans import layout as layouts
from tallymart.plans import upkeep
from tallymart.plans.bronze import bronze_build
from tallymart.plans.layout import Layout
from tallymart.sources import folders
from tallymart.streaming import append_load as load
from tallymart.streaming import gold_refresh


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ledgers


def test_a_daily_run_reads_the_ledgers_of_its_window_only(spark, root):
    layout = Layout(root)
    old = date(2024, 1, 2)
    deliver(spark, layout, narrow_rows([1, 0, 0, 0]) + narrow_rows([2, 0, 0, 0], day=old))
    bronze_build(spark, layout, RUN.__class__("run-0", RUN.at, RUN.as_of, backfill=True))
    for path, types in ((layout.ledger, layouts.LEDGER_TYPES), (layout.file_ledger, layouts.FILE_LEDGER_TYPES)):
        files = layouts.read_log(spark, path, types, "bronze", RUN.wants).inputFiles()
        assert files and all(f"dt={DAY}" in f for f in files)
    bronze_build(spark, layout, RUN)
    assert {r.job_run_id for r in state(spark, layout).values()} == {"run-0"}


@pytest.mark.parametrize("dies", [None, "write", "remove"])
def test_a_fold_that_dies_changes_no_state(spark, root, monkeypatch, dies):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]) + narrow_rows([5, 0, 0, 0], day=OTHER))
    for turn in (RUN, NEXT.__class__("run-2", NEXT.at, NEXT.as_of, backfill=True)):
        bronze_build(spark, layout, turn)
    before = state(spark, layout)
    seen = {tuple(r) for r in layouts.seen_files(spark, layout, "bronze").collect()}

    def stops(*args):
        raise RuntimeError("lost")

    if dies:
        with monkeypatch.context() as patch:
            patch.setattr(layouts, "append_log" if dies == "write" else "remove", stops)
            with pytest.raises(RuntimeError):
                layouts.fold_ledgers(spark, layout, date(2024, 4, 25))
        assert state(spark, layout) == before
    assert layouts.fold_ledgers(spark, layout, date(2024, 4, 25)) > 0
    assert state(spark, layout) == before
    assert {tuple(r) for r in layouts.seen_files(spark, layout, "bronze").collect()} == seen
    for path in (layout.ledger, layout.file_ledger):
        for day in layouts.log_folders(spark, path, None, None):
            assert len([e for e in folders.children(spark, day) if e.name.endswith(".parquet")]) == 1
    assert layouts.fold_ledgers(spark, layout, date(2024, 4, 25)) == 0


# change detection


def test_change_detection_deals_a_hot_key_out(spark, no_broadcast):
    base = version(spark, narrow_rows([100, 0, 0, 0]) + narrow_rows([7, 0, 0, 0], product=2), T1)
    hot = base.where("product_id = 12345").crossJoin(spark.range(1, 4001).toDF("k"))
    hot = hot.withColumn("_loaded_at", F.col("_loaded_at") + F.make_dt_interval(mins=F.col("k").cast("int")))
    hot = hot.withColumn("downloads_total", F.col("downloads_total") + F.col("k") % 2).drop("k")
    rows = base.unionByName(hot.select(base.columns)).unionByName(base)
    found = versions.finalized_changed(rows)
    assert "SortAggregate" not in plan(found)
    assert found.count() == 2000 and {r.delta for r in found.select("delta").distinct().collect()} == {1}
    parts = versions._dealt(rows).groupBy(*WIDE_KEY, "_part").count()
    assert parts.agg(F.max("count")).first()[0] < 400


def test_change_detection_counts_nulls_and_settles_ties(spark):
    one = version(spark, narrow_rows([5, 0, 0, 0]), T1)
    tied = one.withColumn("downloads_total", F.lit(9).cast("bigint"))
    lost = version(spark, narrow_rows([5, 0, 0, 0]), T2).withColumn("downloads_total", F.lit(None).cast("bigint"))
    found = versions.finalized_changed(one.unionByName(tied).unionByName(lost)).collect()
    assert [(r.final_total, r.downloads_total) for r in found] == [(5, None)]


# parity


def test_one_changed_row_is_looked_for_in_its_leaf_only(spark, no_broadcast):
    rows = [r for p in range(3000) for r in narrow_rows([p % 7, 1, 1, 1], product=p)]
    left = wide(spark, rows)
    right = left.withColumn("downloads_total", F.col("downloads_total") + (F.col("product_id") == 77).cast("bigint"))
    assert parity.parity_leaves(left, right).count() == 1
    kept, _ = parity.in_leaves(left, right)
    assert kept.count() <= 10
    found = parity.parity_validate(left, right)
    assert [(r.product_id, r.issue) for r in found.collect()] == [(77, "value_diff:downloads_total")]
    assert "SortAggregate" not in plan(parity.parity_diff_rows(left, right))


def test_leaves_miss_no_kind_of_difference(spark):
    rows = [r for p in range(200) for r in narrow_rows([p, 1, 1, 1], product=p)]
    left = wide(spark, rows)
    share = F.when(F.col("product_id") == 5, F.col("paid_share") + F.lit("0.1").cast("decimal(6,4)")).otherwise(F.col("paid_share"))
    right = left.withColumn("paid_share", share.cast("decimal(6,4)")).where("product_id <> 9")
    right = right.unionByName(left.where("product_id = 11")).unionByName(left.where("product_id = 12").withColumn("product_id", F.lit(9999).cast("bigint")))
    whole = {(r.product_id, r.issue) for r in parity.parity_diff_rows(left, right).collect()}
    assert whole == {(r.product_id, r.issue) for r in parity.parity_validate(left, right).collect()}
    assert {p for p, _ in whole} == {5, 9, 11, 9999}


# first errors


def test_history_names_row_column_and_value(spark, root):
    bad = wide(spark, [r for p in range(6) for r in narrow_rows([p, 0, 0, 0], product=p)])
    flag = F.when(F.col("product_id") == 3, "maybe").when(F.col("product_id") == 4, "never").otherwise("yes")
    rows = bad.withColumn("is_estimate_final", flag).withColumn("store", F.col("app_store"))
    ordered = rows.coalesce(1).sortWithinPartitions("product_id")
    ordered.write.partitionBy("dt", "store").parquet(f"{root}/source")
    target = run(spark, root, T1, types=TEXT)
    (entry,) = load.read_history(spark, target).collect()
    assert entry.first_error_message == "2 rows do not fit the contract; first in row 4: is_estimate_final is 'maybe'"
    assert (entry.row_parsed, entry.error_count, entry.row_count) == (6, 2, 0)


def test_errors_are_counted_in_one_pass(spark, sf_dir):
    from tallymart.catalogue import inputs

    rows = inputs.text_flag_rows(spark, sf_dir)
    text = plan(loading.file_errors(rows))
    assert text.count("FileScan") == plan(rows).count("FileScan")
    # Text is a group's key on the large side; only what is left of it is sorted.
    assert text.count("SortAggregate") <= 2


# Gold


def test_each_gold_table_has_its_own_lag(spark, root):
    target, gold = load.LoadTarget.under(root), gold_refresh.GoldTarget(f"{root}/gold")
    rows = narrow_rows([1, 0, 0, 0]) + narrow_rows([5, 0, 0, 0], day=OTHER)
    load.append_batch(spark, version(spark, rows, T1), target, 0, T1)
    assert set(gold_refresh.refresh_due(spark, target, gold, lambda: T1)) == set(gold_refresh.GOLD_TABLES)
    for number, day in ((1, DAY), (2, OTHER)):
        load.append_batch(spark, version(spark, narrow_rows([2, 0, 0, 0], day=day), T2), target, number, T2)
    def due(minutes):
        return gold_refresh.refresh_due(spark, target, gold, lambda: T1 + timedelta(minutes=minutes))

    assert due(29) == {}
    assert due(31) == {"daily_by_app": 2, "daily_by_country": 2}
    assert due(61) == {"paid_vs_organic_trend": 2}
    assert due(500) == {}
    for name, aggregate in gold_refresh.GOLD_TABLES.items():
        want = aggregate(load.read_versions(spark, target))
        got = spark.read.parquet(gold.path(name)).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def test_gold_follows_dedup_and_days_that_vanish(spark, root):
    target, gold = load.LoadTarget.under(root), gold_refresh.GoldTarget(f"{root}/gold")
    two_versions(spark, target)
    gold_refresh.refresh_due(spark, target, gold, lambda: T1, lag={})
    upkeep.dedup_in_place(spark, target, AS_OF)
    for number in (0, 1):  # both batches are loaded again, without the other day
        load.append_batch(spark, version(spark, narrow_rows([number, 0, 0, 0]), T1), target, number, T2)
    gold_refresh.refresh_due(spark, target, gold, lambda: T2, lag={})
    rows = spark.read.parquet(gold.path("daily_by_app")).collect()
    assert {r.dt: r.downloads_total for r in rows} == {DAY: 1}


def test_a_log_that_was_cut_gives_a_full_refresh(spark, root):
    target, gold = load.LoadTarget.under(root), gold_refresh.GoldTarget(f"{root}/gold")
    two_versions(spark, target)
    log = target.log(spark)
    log.fold()
    load.append_batch(spark, version(spark, narrow_rows([3, 0, 0, 0]), T2), target, 2, T2)
    log.fold()
    log.vacuum([], datetime.now() + timedelta(days=2))
    assert gold_refresh.refresh_due(spark, target, gold, lambda: T1, lag={})["daily_by_app"] is None
    assert sum(r.downloads_total for r in spark.read.parquet(gold.path("daily_by_app")).collect()) == 1 + 2 + 10 + 11 + 3


def test_strict_and_tolerant_loads_take_the_same_flags(spark):
    rows = wide(spark, narrow_rows([1, 0, 0, 0])).withColumn("is_estimate_final", F.lit("on"))
    assert versions.load_cast(rows).first().is_estimate_final is True
    with pytest.raises(Exception, match="no flag"):
        versions.load_cast(rows.withColumn("is_estimate_final", F.lit(" yes "))).collect()
    assert MEASURES


# the large narrow table


@pytest.mark.parametrize("make", [inputs.bulk_bronze, inputs.bulk_stale_wide])
def test_tasks_of_the_large_table_hold_bounded_rows(make, spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(inputs, "TASK_ROWS", 2000, raising=False)
    per_task = make(spark, "/root/testdata/sf0.01").groupBy(F.spark_partition_id().alias("task")).count()
    assert per_task.agg(F.max("count")).first()[0] < 2500


@pytest.mark.parametrize(
    "name", ["audit_channel_completeness_bulk", "pivot_wide_bulk", "recon_pivot_rows_bulk", "parity_checksum_bulk"]
)
def test_queries_of_the_large_table_deal_their_rows_by_number(name, spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(inputs, "TASK_ROWS", 2000, raising=False)
    text = plan(queries.queries()[name](spark, "/root/testdata/sf0.01"))
    # Of shuffles by the wide key only the one with a number of tasks of its own is left.
    by_key = [line for line in text.splitlines() if "hashpartitioning(dt" in line and "device" in line]
    assert by_key and all("REPARTITION_BY_NUM" in line for line in by_key)
