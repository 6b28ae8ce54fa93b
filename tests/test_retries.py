"""Odd folder names, old files, second runs and other time zones."""

import os
import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from rows import DAY, drop_frame, narrow_rows, version, wide, write_part
from test_streams import T1, T2, deliver, run, totals

from tallymart.contracts import VERSIONED_TYPES
from tallymart.functions.stamps import utc_stamp
from tallymart.operators import audits
from tallymart.operators.ledger import ledger_rows
from tallymart.plans import upkeep
from tallymart.plans.bronze import BronzeRun, bronze_build
from tallymart.plans.layout import Layout, append_log, layer_state, read_bronze, read_silver
from tallymart.plans.silver import silver_build, stage_and_check
from tallymart.sources.manifest import file_manifest
from tallymart.sources.tables import overwrite_partitions, read_partitions
from tallymart.streaming import append_load as load

STORES = ["ios", "ios,eu", "a}b", "{a", "01", "a+b c", "a:b%", None]
RUN = BronzeRun("run-1", datetime(2024, 4, 25, 10), date(2024, 4, 25))


@pytest.mark.parametrize("more", [0, 1100])
def test_any_store_name_is_read_back(spark, root, more):
    rows = spark.createDataFrame([(k, DAY, s) for k, s in enumerate(STORES)], "n int, dt date, store string")
    overwrite_partitions(rows, root)
    keys = [(DAY, s) for s in STORES] + [(DAY, f"absent-{k}") for k in range(more)]
    found = read_partitions(spark, root, "n int, dt date, store string", keys)
    assert sorted(r.n for r in found.collect()) == list(range(len(STORES)))
    only = read_partitions(spark, root, "n int, dt date, store string", [(DAY, "01"), (date(2020, 1, 1), "ios")])
    assert [(r.n, r.store) for r in only.collect()] == [(4, "01")]
    listed = {(r.dt, r.store) for r in file_manifest(spark, root).collect()}
    assert listed == {(DAY, s) for s in STORES}


def test_odd_stores_reach_silver_whole(spark, root):
    layout = Layout(root)
    for store in ("ios", "ios,eu", "a}b", "01"):
        frame = drop_frame(spark, narrow_rows([1, 2, 3, 4])).withColumn("store", F.lit(store))
        write_part(frame, layout.drop)
    os.makedirs(f"{layout.drop}/dt=tmp/store=x")
    spark.range(1).write.parquet(f"{layout.drop}/dt=tmp/store=x/y")
    bronze_build(spark, layout, RUN)
    counts = {r.store: (r.status, r.in_count) for r in layer_state(spark, layout, "bronze").collect()}
    assert counts == {s: ("succeeded", 4) for s in ("ios", "ios,eu", "a}b", "01")}
    silver_build(spark, layout, "silver-1", RUN.at)
    assert {r.store for r in read_silver(spark, layout).collect()} == {"ios", "ios,eu", "a}b", "01"}


def test_an_old_file_that_arrives_late_is_loaded(spark, root):
    deliver(spark, f"{root}/source", narrow_rows([1, 0, 0, 0]))
    target = run(spark, root, T1)
    deliver(spark, f"{root}/source", narrow_rows([2, 0, 0, 0]))
    nine_days = time.time() - 9 * 86400
    for folder, _, names in os.walk(f"{root}/source"):
        for name in names:
            path = os.path.join(folder, name)
            if name.endswith(".parquet") and os.path.getmtime(path) > time.time() - 3 and path not in loaded(spark, target):
                os.utime(path, (nine_days, nine_days))
    run(spark, root, T2)
    assert totals(spark, target) == [1, 2]


def loaded(spark, target):
    return {r.file_name.removeprefix("file:") for r in load.read_history(spark, target).collect()}


def test_dedup_stages_apart_from_earlier_runs(spark, root):
    target = load.LoadTarget.under(root)
    for number, at in enumerate((T1, T2)):
        load.append_batch(spark, version(spark, narrow_rows([number + 1, 0, 0, 0]), at), target, number, at)
    assert upkeep.dedup_in_place(spark, target, date(2024, 4, 27)) == [DAY]
    load.append_batch(spark, version(spark, narrow_rows([9, 0, 0, 0]), datetime(2024, 4, 27, 1)), target, 2, T2)
    assert upkeep.dedup_in_place(spark, target, date(2024, 4, 28)) == [DAY]
    versions = load.read_versions(spark, target).select(*VERSIONED_TYPES)
    assert [r.downloads_total for r in versions.collect()] == [9]


def test_a_retry_replaces_its_check_results(spark, root):
    layout = Layout(root)
    deliver_drop = drop_frame(spark, narrow_rows([1, 2, 3, 4]))
    write_part(deliver_drop, layout.drop)
    bronze_build(spark, layout, RUN)
    narrow = read_bronze(spark, layout)
    once = stage_and_check(spark, layout, narrow, "same", RUN.at).results.count()
    assert stage_and_check(spark, layout, narrow, "same", RUN.at).results.count() == once


def test_silver_leaves_a_partition_of_a_running_run_alone(spark, root):
    layout = Layout(root)
    write_part(drop_frame(spark, narrow_rows([1, 2, 3, 4])), layout.drop)
    bronze_build(spark, layout, RUN)
    busy = spark.createDataFrame([(DAY, "ios")], "dt date, store string")
    append_log(ledger_rows(busy, "silver", "running", "other", RUN.at), layout.ledger)
    silver_build(spark, layout, "silver-1", RUN.at)
    assert {r.job_run_id for r in layer_state(spark, layout, "silver").collect()} == {"other"}


def test_audits_report_all_rows(spark):
    rows = [r for k in range(130) for r in narrow_rows([1, 0, 0, 0], product=k)]
    bad = wide(spark, rows).withColumn("downloads_total", F.lit(7).cast("bigint"))
    assert audits.audit_total_split(bad).count() == 130
    assert audits.audit_total_split(bad, limit=5).count() == 5


def test_stamps_are_utc_in_any_zone(spark, monkeypatch):
    at = datetime(2024, 4, 25, 10, 0)
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        micros = spark.range(1).select(F.unix_micros(utc_stamp(at)).alias("n")).first().n
    finally:
        monkeypatch.undo()
        time.tzset()
    assert micros == at.replace(tzinfo=timezone.utc).timestamp() * 1e6
