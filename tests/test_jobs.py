"""Bronze, Silver, quarantine, replay: what the jobs leave behind."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from rows import DAY, as_dicts, drop_frame, narrow_rows, write_part

from tallymart.operators.ledger import ledger_rows
from tallymart.plans import upkeep
from tallymart.plans.bronze import BronzeRun, bronze_build
from tallymart.plans.layout import (
    ALERT_TYPES,
    Layout,
    append_log,
    layer_state,
    ledger_state,
    read_bronze,
    read_errors,
    read_or_empty,
    read_silver,
)
from tallymart.plans.silver import silver_build
from tallymart.sources import folders

RUN = BronzeRun("run-1", datetime(2024, 4, 25, 10), date(2024, 4, 25))
NEXT = replace(RUN, run_id="run-2", at=datetime(2024, 4, 26, 10), as_of=date(2024, 4, 26))
OTHER = date(2024, 4, 23)


def deliver(spark, layout, rows, mode="append"):
    write_part(drop_frame(spark, rows), layout.drop, mode)


def state(spark, layout, layer="bronze"):
    return {(r.dt, r.store): r for r in layer_state(spark, layout, layer).collect()}


def totals(frame):
    return {
        (r.dt, r.app_store): r.n for r in frame.groupBy("dt", "app_store").agg(F.sum("downloads").alias("n")).collect()
    }


def test_first_run_takes_everything_in_the_window(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]) + narrow_rows([5, 0, 0, 0], day=date(2024, 4, 10)))
    bronze_build(spark, layout, RUN)
    found = state(spark, layout)
    # The cutoff day is the fourteenth before the run, so April 10 lies outside by one.
    assert set(found) == {(DAY, "ios")}
    assert (found[DAY, "ios"].in_count, found[DAY, "ios"].out_count, found[DAY, "ios"].status) == (4, 4, "succeeded")


def test_cutoff_day_is_included_and_backfill_ignores_it(spark, root):
    layout = Layout(root)
    days = [date(2024, 4, 10), date(2024, 4, 11)]
    deliver(spark, layout, [r for d in days for r in narrow_rows([1, 0, 0, 0], day=d)])
    bronze_build(spark, layout, RUN)
    assert set(state(spark, layout)) == {(days[1], "ios")}
    bronze_build(spark, layout, replace(NEXT, backfill=True))
    assert set(state(spark, layout)) == {(d, "ios") for d in days}


def test_unchanged_partitions_are_skipped_and_changed_ones_replaced(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]) + narrow_rows([9, 0, 0, 0], day=OTHER))
    bronze_build(spark, layout, RUN)
    bronze_build(spark, layout, NEXT)
    assert {r.job_run_id for r in state(spark, layout).values()} == {"run-1"}
    deliver(spark, layout, narrow_rows([10, 2, 3, 4]), "overwrite")
    bronze_build(spark, layout, NEXT)
    found = state(spark, layout)
    assert (found[DAY, "ios"].job_run_id, found[OTHER, "ios"].job_run_id) == ("run-2", "run-1")
    assert totals(read_bronze(spark, layout)) == {(DAY, "ios"): 19, (OTHER, "ios"): 9}


def test_newest_file_wins_within_a_partition(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    deliver(spark, layout, narrow_rows([7, 2, 3, 4]))
    bronze_build(spark, layout, RUN)
    assert totals(read_bronze(spark, layout)) == {(DAY, "ios"): 16}
    assert state(spark, layout)[DAY, "ios"].in_count == 8


def test_failed_partition_is_tried_again(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    bronze_build(spark, layout, RUN)
    failed = spark.createDataFrame([(DAY, "ios")], "dt date, store string")
    append_log(ledger_rows(failed, "bronze", "failed", "run-x", datetime(2024, 4, 25, 11)), layout.ledger)
    bronze_build(spark, layout, NEXT)
    assert state(spark, layout)[DAY, "ios"].job_run_id == "run-2"


def test_running_partition_is_left_alone_until_its_lock_runs_out(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    started = spark.createDataFrame([(DAY, "ios")], "dt date, store string")
    append_log(ledger_rows(started, "bronze", "running", "run-x", datetime(2024, 4, 25, 9)), layout.ledger)
    bronze_build(spark, layout, RUN)
    assert state(spark, layout)[DAY, "ios"].job_run_id == "run-x"
    bronze_build(spark, layout, replace(RUN, at=datetime(2024, 4, 25, 11, 1)))
    assert state(spark, layout)[DAY, "ios"].job_run_id == "run-1"


def test_text_is_trimmed_and_extra_columns_stay(spark, root):
    layout = Layout(root)
    rows = drop_frame(spark, narrow_rows([1, 2, 3, 4], country=" US ")).withColumn("batch", F.lit(7))
    write_part(rows, layout.drop)
    bronze_build(spark, layout, RUN, extra={"batch": "int"})
    stored = spark.read.parquet(layout.bronze)
    assert {(r.country, r.batch) for r in stored.collect()} == {("US", 7)}


def test_empty_partition_succeeds_and_writes_nothing(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    empty = drop_frame(spark, narrow_rows([1, 2, 3, 4])).where("false").drop("dt", "store")
    empty.coalesce(1).write.parquet(f"{layout.drop}/dt={OTHER}/store=ios")
    bronze_build(spark, layout, RUN)
    found = state(spark, layout)[OTHER, "ios"]
    assert (found.status, found.in_count, found.out_count) == ("succeeded", 0, 0)
    silver_build(spark, layout, "silver-1", RUN.at)
    assert state(spark, layout, "silver")[OTHER, "ios"].status == "succeeded"
    assert {r.dt for r in read_silver(spark, layout).select("dt").collect()} == {DAY}


def break_contract(spark, layout):
    """April 24 sound; April 23 with two bad files of different kinds and a good one."""
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    rows = drop_frame(spark, narrow_rows([5, 6, 7, 8], day=OTHER))
    write_part(rows.drop("is_estimate_final"), layout.drop)
    write_part(rows.withColumn("downloads", F.col("downloads").cast("string")), layout.drop)
    write_part(drop_frame(spark, narrow_rows([1, 1, 1, 1], day=OTHER, product=2)), layout.drop)


def test_contract_break_rejects_its_partition_only(spark, root):
    layout = Layout(root)
    break_contract(spark, layout)
    bronze_build(spark, layout, RUN)
    found = state(spark, layout)
    assert (found[DAY, "ios"].status, found[OTHER, "ios"].status) == ("succeeded", "failed")
    assert (found[OTHER, "ios"].dlq_rows, found[OTHER, "ios"].dlq_files) == (12, 3)
    assert set(totals(read_bronze(spark, layout))) == {(DAY, "ios")}
    errors = read_errors(spark, layout).collect()
    message = "downloads is string, not bigint; missing is_estimate_final"
    assert {(e.error_type, e.error_message) for e in errors} == {("SCHEMA_MISMATCH", message)}
    assert len({e.source_file for e in errors}) == 3
    (alert,) = read_or_empty(spark, layout.alerts, ALERT_TYPES).collect()
    assert alert.message == message


def held_rows(spark, layout):
    counted = spark.read.schema("dt date, store string").parquet(layout.drop).groupBy("dt").count()
    return {r.dt: r["count"] for r in counted.collect()}


def test_replay_restores_every_row_once(spark, root):
    layout = Layout(root)
    break_contract(spark, layout)
    bronze_build(spark, layout, RUN)
    files = {e.name for e in folders.children(spark, f"{layout.drop}/dt={OTHER}/store=ios")}
    folders.remove(spark, f"{layout.drop}/dt={OTHER}")
    log = upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at)
    assert sorted((r.kind, r.action, r.row_count) for r in log.collect()) == [("error", "archive_only", 1)] * 3 + [("raw", "replay", 4)] * 3
    assert held_rows(spark, layout) == {DAY: 4, OTHER: 12}
    assert files == {e.name for e in folders.children(spark, f"{layout.drop}/dt={OTHER}/store=ios")}
    assert upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at).count() == 0
    assert upkeep.dlq_replay(spark, layout, "2024-04-24", NEXT.at).count() == 0


def test_replay_wants_a_date(spark, root):
    with pytest.raises(ValueError):
        upkeep.dlq_replay(spark, Layout(root), "yesterday", NEXT.at)


def test_silver_follows_bronze_and_does_not_rebuild(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([400, 100, 300, 200]) + narrow_rows([5, 0, 0, 0], day=OTHER, store="google-play", device="android-phone"))
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    first = {r.asDict()["dt"]: r for r in read_silver(spark, layout).collect()}
    assert str(first[DAY].paid_share) == "0.5000" and first[OTHER].store == "google-play"
    silver_build(spark, layout, "silver-2", NEXT.at)
    assert {r.job_run_id for r in state(spark, layout, "silver").values()} == {"silver-1"}
    silver_build(spark, layout, "silver-3", NEXT.at, force=True)
    assert {r.job_run_id for r in state(spark, layout, "silver").values()} == {"silver-3"}
    assert read_silver(spark, layout).count() == 2


def test_blocked_stores_of_one_day_do_not_overwrite_each_other(spark, root):
    layout = Layout(root)
    # A file column product_id that is NULL blocks the partition.
    rows = narrow_rows([1, 0, 0, 0], product=None) + narrow_rows([2, 0, 0, 0], product=None, store="google-play")
    deliver(spark, layout, rows + narrow_rows([3, 0, 0, 0], day=OTHER))
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    found = state(spark, layout, "silver")
    assert {k: v.status for k, v in found.items()} == {
        (DAY, "ios"): "failed", (DAY, "google-play"): "failed", (OTHER, "ios"): "succeeded",
    }
    assert {r.dt for r in read_silver(spark, layout).collect()} == {OTHER}
    held = spark.read.parquet(f"{layout.quarantine}/wide")
    assert {(r.store, r._dlq_error_type) for r in held.collect()} == {("ios", "DQ_BLOCK"), ("google-play", "DQ_BLOCK")}
    subjects = as_dicts(read_or_empty(spark, layout.alerts, ALERT_TYPES), "subject")
    assert len([s for s in subjects if "block" in s["subject"]]) == 2
    log = upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at)
    assert {(r.kind, r.action) for r in log.collect()} == {("wide", "archive_only")}


def test_restate_reaches_silver(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1000, 0, 0, 0]))
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    deliver(spark, layout, narrow_rows([1050, 0, 0, 0]), "overwrite")
    bronze_build(spark, layout, NEXT)
    silver_build(spark, layout, "silver-2", NEXT.at)
    (row,) = read_silver(spark, layout).collect()
    assert row.downloads_total == 1050
    assert ledger_state(spark, layout).where("status = 'succeeded'").count() == 2


def test_a_broken_file_rejects_its_partition_only(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]) + narrow_rows([5, 0, 0, 0], day=OTHER))
    with open(f"{layout.drop}/dt={OTHER}/store=ios/part-broken.parquet", "wb") as handle:
        handle.write(b"not a parquet file")
    bronze_build(spark, layout, RUN)
    found = state(spark, layout)
    assert (found[DAY, "ios"].status, found[OTHER, "ios"].status) == ("succeeded", "failed")
    assert (found[OTHER, "ios"].dlq_files, found[OTHER, "ios"].dlq_rows) == (2, 4)
    kinds = {(e.error_type, e.error_message.split(":")[0]) for e in read_errors(spark, layout).collect()}
    assert kinds == {("PROCESSING_ERROR", "unreadable file")}


def test_a_step_that_raises_is_recorded_and_tried_again(spark, root, monkeypatch):
    from tallymart.plans import silver

    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    bronze_build(spark, layout, RUN)
    real = silver.publish

    def dies(*args):
        raise RuntimeError("out of disk")

    monkeypatch.setattr(silver, "publish", dies)
    with pytest.raises(RuntimeError):
        silver_build(spark, layout, "silver-1", RUN.at)
    assert state(spark, layout, "silver")[DAY, "ios"].status == "failed"
    (error,) = read_errors(spark, layout).collect()
    assert (error.error_type, error.error_message) == ("SILVER_PROCESSING_ERROR", "out of disk")
    monkeypatch.setattr(silver, "publish", real)
    silver_build(spark, layout, "silver-2", NEXT.at)
    assert state(spark, layout, "silver")[DAY, "ios"].status == "succeeded"


def test_rows_filed_under_another_store_stay_there(spark, root):
    layout = Layout(root)
    misfiled = drop_frame(spark, narrow_rows([1, 0, 0, 0], store="google-play")).withColumn("store", F.lit("ios"))
    own = drop_frame(spark, narrow_rows([2, 0, 0, 0], store="google-play"))
    write_part(misfiled.unionByName(own), layout.drop)
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    found = {(r.store, r.app_store, r.downloads_total) for r in read_silver(spark, layout).collect()}
    assert found == {("ios", "google-play", 1), ("google-play", "google-play", 2)}


def test_rows_without_a_store_block_the_folder_they_lie_in(spark, root):
    layout = Layout(root)
    nameless = drop_frame(spark, narrow_rows([1, 0, 0, 0])).withColumn("app_store", F.lit(None).cast("string"))
    write_part(nameless, layout.drop)
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    assert state(spark, layout, "silver")[DAY, "ios"].status == "failed"
