"""Properties of physical plans that matter when the data is large."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymart.catalogue import inputs
from tallymart.catalogue import queries as base
from tallymart.contracts import WIDE_TYPES, ddl
from tallymart.operators import audits, bi, cleaning, gold, recon, versions
from tallymart.sources import drop, tables

# Complete jobs write and read tables; their plans are looked at through the operators.
JOBS = {
    "scan_drop", "scan_drop_csv", "file_manifest", "overwrite_partition", "register_table", "append_load", "append_load_after_crash",
    "dlq_replay_rows", "backfill_build", "schema_evolution",
    "bronze_build", "quarantine_files", "dlq_replay", "schema_missing_cols", "schema_type_mismatch",
    "schema_gate", "silver_build", "silver_build_bulk", "dedup_versions_in_place",
    "gold_refresh_incremental", "gold_refresh_incremental_country", "gold_refresh_incremental_trend", "force_refresh",
    "force_refresh_app", "force_refresh_trend", "parity_validate", "fold_ledgers", "silver_build_bulk_rows",
}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(base.queries()) - JOBS))
def test_no_pairwise_join_and_no_python(name, spark, sf_dir):
    text = plan(base.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInArrow"):
        assert operator not in text, operator


@pytest.mark.parametrize("make", [inputs.bronze_core, inputs.bulk_bronze])
def test_dedup_limits_groups_before_the_shuffle(make, spark, sf_dir):
    text = plan(make(spark, sf_dir))
    assert ", 1, Partial" in text and ", 1, Final" in text


def test_latest_and_top_k_limit_before_the_shuffle(spark, sf_dir):
    rows = inputs.versions(spark, sf_dir)
    assert "Partial" in plan(versions.latest_view(rows))
    assert ", 10, Partial" in plan(bi.bi_top_apps(rows))


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    text = plan(gold.gold_daily_by_app(inputs.versions(spark, sf_dir)))
    assert "partial_sum" in text


def test_reports_take_their_first_rows_without_a_full_sort(spark, sf_dir):
    wide = inputs.wide(spark, sf_dir)
    assert "TakeOrderedAndProject" in plan(audits.audit_total_split(wide, limit=50))
    assert "rangepartitioning" not in plan(audits.audit_total_split(wide))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "wide")
    tables.overwrite_partitions(inputs.wide(spark, sf_dir).withColumn("store", F.col("app_store")), path)
    return path


def test_days_are_pruned_and_columns_cut(spark, stored):
    rows = tables.read_table(spark, stored, ddl({**WIDE_TYPES, "store": "string"}))
    text = plan(gold.gold_paid_vs_organic_trend(rows, date(2024, 1, 31)))
    partition_filters = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "dt" in partition_filters
    assert "country" not in text.split("ReadSchema")[1]


def test_listed_partitions_are_the_only_ones_read(spark, stored):
    keys = [(date(2024, 1, 3), "ios"), (date(2024, 1, 4), "google-play"), (date(2030, 1, 1), "ios")]
    rows = tables.read_partitions(spark, stored, ddl({**WIDE_TYPES, "store": "string"}), keys)
    assert {(r.dt, r.store) for r in rows.select("dt", "store").distinct().collect()} == set(keys[:2])
    assert len(rows.inputFiles()) == len({f for f in rows.inputFiles() if "2024-01-03" in f or "2024-01-04" in f})
    assert tables.read_partitions(spark, stored, ddl({**WIDE_TYPES, "store": "string"}), keys[2:]).count() == 0


def test_window_prunes_the_drop(spark, sf_dir, tmp_path):
    root = str(tmp_path / "drop")
    tables.overwrite_partitions(inputs.drop_rows(spark, sf_dir), root)
    text = plan(drop.partition_window(drop.scan_drop(spark, root), date(2024, 1, 31)))
    assert "dt" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_only_the_wide_side_is_shuffled_for_the_pivot_comparison(spark, sf_dir, tmp_path):
    narrow_path, wide_path = str(tmp_path / "n"), str(tmp_path / "w")
    inputs.bronze_core(spark, sf_dir).write.parquet(narrow_path)
    inputs.wide(spark, sf_dir).write.parquet(wide_path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(recon.recon_pivot_rows(spark.read.parquet(narrow_path), spark.read.parquet(wide_path)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange hashpartitioning") == 2


def test_dedup_metrics_share_one_pass(spark, sf_dir):
    assert plan(cleaning.dedup_metrics(inputs.raw_events(spark, sf_dir))).count("FileScan") == 1
