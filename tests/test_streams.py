"""Append load and Gold refresh."""

from datetime import date, datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from rows import DAY, WIDE_COLUMNS, narrow_rows, wide, write_part

from tallymart.contracts import VERSIONED_TYPES, WIDE_TYPES
from tallymart.operators import gold
from tallymart.plans import upkeep
from tallymart.sources.manifest import file_manifest, pending_files
from tallymart.streaming import append_load as load
from tallymart.streaming import gold_refresh

T1, T2 = datetime(2024, 4, 25, 10, 5), datetime(2024, 4, 26, 10, 5)


def deliver(spark, source, rows, **changed):
    frame = wide(spark, rows).withColumn("store", F.col("app_store"))
    for column, value in changed.items():
        frame = frame.withColumn(column, value)
    write_part(frame, source)


def run(spark, root, at, **options):
    target = load.LoadTarget.under(root)
    load.append_load(spark, f"{root}/source", target, clock=lambda batch: at, **options).awaitTermination()
    return target


def totals(spark, target):
    return sorted(r.downloads_total for r in load.read_versions(spark, target).collect())


def test_each_file_is_loaded_once(spark, root):
    deliver(spark, f"{root}/source", narrow_rows([1000, 0, 0, 0]))
    target = run(spark, root, T1)
    run(spark, root, T1)
    assert totals(spark, target) == [1000]
    deliver(spark, f"{root}/source", narrow_rows([1050, 0, 0, 0]))
    run(spark, root, T2)
    assert totals(spark, target) == [1000, 1050]
    history = load.read_history(spark, target).collect()
    assert {(r.status, r.row_count, r.last_load_time) for r in history} == {("Loaded", 1, T1), ("Loaded", 1, T2)}


def test_a_batch_that_died_half_way_is_not_loaded_twice(spark, root, monkeypatch):
    deliver(spark, f"{root}/source", narrow_rows([1000, 0, 0, 0]))
    real = load.load_history

    def dies(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(load, "load_history", dies)
    with pytest.raises(StreamingQueryException):
        run(spark, root, T1)
    target = load.LoadTarget.under(root)
    assert totals(spark, target) == []
    monkeypatch.setattr(load, "load_history", real)
    run(spark, root, T2)
    assert totals(spark, target) == [1000]
    assert [r.row_count for r in load.read_history(spark, target).collect()] == [1]


def test_small_batches_give_the_same_table(spark, root):
    rows = [r for p in range(3) for d in (23, 24) for r in narrow_rows([p, 1, 1, 1], product=p, day=date(2024, 4, d))]
    deliver(spark, f"{root}/source", rows)
    target = run(spark, root, T1, max_files=1)
    got = load.read_versions(spark, target).select(*WIDE_COLUMNS)
    want = wide(spark, rows)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert load.read_history(spark, target).select("load_batch").distinct().count() == 2


TEXT = {**WIDE_TYPES, "is_estimate_final": "string"}


def flag():
    return F.when(F.col("product_id") == 1, "maybe").otherwise("yes")


@pytest.mark.parametrize(
    "mode, limit, loaded, status",
    [
        ("skip_file", None, [7], "Load failed"),
        ("continue", None, [2, 3, 7], "Partially loaded"),
        ("skip_file_n", 1, [2, 3, 7], "Partially loaded"),
        ("skip_file_n", 0, [7], "Load failed"),
    ],
)
def test_bad_rows(mode, limit, loaded, status, spark, root):
    bad = [r for p in (1, 2, 3) for r in narrow_rows([p, 0, 0, 0], product=p)]
    deliver(spark, f"{root}/source", bad, is_estimate_final=flag())
    deliver(spark, f"{root}/source", narrow_rows([7, 0, 0, 0], product=7, day=date(2024, 4, 23)), is_estimate_final=flag())
    target = run(spark, root, T1, types=TEXT, on_error=mode, limit=limit)
    assert totals(spark, target) == loaded
    assert sorted(r.status for r in load.read_history(spark, target).collect()) == sorted(["Loaded", status])


def test_abort_loads_nothing(spark, root):
    deliver(spark, f"{root}/source", narrow_rows([1, 0, 0, 0], product=1), is_estimate_final=flag())
    with pytest.raises(StreamingQueryException, match="bad row"):
        run(spark, root, T1, types=TEXT, on_error="abort")


def test_reload_takes_only_what_is_missing_and_the_stream_knows(spark, root):
    source = f"{root}/source"
    deliver(spark, source, narrow_rows([1, 0, 0, 0]))
    target = run(spark, root, T1)
    deliver(spark, source, narrow_rows([2, 0, 0, 0], product=2))
    history = load.read_history(spark, target)
    assert pending_files(file_manifest(spark, source), history).count() == 1
    assert load.reload_files(spark, source, target, T2) == 1
    assert load.reload_files(spark, source, target, T2) == 0
    run(spark, root, T2)
    assert totals(spark, target) == [1, 2]
    assert pending_files(file_manifest(spark, source), load.read_history(spark, target)).count() == 0


def gold_rows(spark, target, name):
    return spark.read.parquet(target.path(name))


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_gold_follows_loads_and_dedup(spark, root):
    source, target, gold_target = f"{root}/source", load.LoadTarget.under(root), gold_refresh.GoldTarget(f"{root}/gold")

    def step(rows, at):
        deliver(spark, source, rows)
        gold_refresh.load_and_refresh(spark, source, target, gold_target, clock=lambda b: at).awaitTermination()

    other = date(2024, 4, 23)
    step(narrow_rows([1000, 0, 0, 0]) + narrow_rows([5, 0, 0, 0], day=other), T1)
    step(narrow_rows([1050, 0, 0, 0]), T2)
    versions = load.read_versions(spark, target).select(*VERSIONED_TYPES)
    for name, aggregate in gold_refresh.GOLD_TABLES.items():
        assert same(aggregate(versions), gold_rows(spark, gold_target, name)), name
    total = {r.dt: r.downloads_total for r in gold_rows(spark, gold_target, "daily_by_app").collect()}
    assert total == {DAY: 2050, other: 5}
    refreshed = gold_refresh.read_refreshes(spark, gold_target).where("name = 'daily_by_app'")
    assert sorted(r.days for r in refreshed.collect()) == [1, 2]

    days = upkeep.dedup_in_place(spark, target, date(2024, 4, 27))
    assert days == [DAY]
    versions = load.read_versions(spark, target).select(*VERSIONED_TYPES)
    assert sorted(r.downloads_total for r in versions.collect()) == [5, 1050]
    gold_refresh.refresh(spark, versions, gold_target, days)
    total = {r.dt: r.downloads_total for r in gold_rows(spark, gold_target, "daily_by_app").collect()}
    assert total == {DAY: 1050, other: 5}
    assert same(gold.gold_daily_by_country(versions), gold_rows(spark, gold_target, "daily_by_country"))
    assert upkeep.dedup_in_place(spark, target, date(2024, 4, 27)) == []


def test_failed_refresh_is_logged(spark, root, monkeypatch):
    gold_target = gold_refresh.GoldTarget(f"{root}/gold")
    deliver(spark, f"{root}/source", narrow_rows([1, 0, 0, 0]))
    target = run(spark, root, T1)

    def dies(rows):
        raise RuntimeError("no space")

    monkeypatch.setitem(gold_refresh.GOLD_TABLES, "daily_by_country", dies)
    with pytest.raises(RuntimeError):
        gold_refresh.refresh(spark, load.read_versions(spark, target), gold_target)
    states = {r.name: r.state for r in gold_refresh.read_refreshes(spark, gold_target).collect()}
    assert states == {"daily_by_app": "SUCCEEDED", "daily_by_country": "FAILED"}
