"""Columns that come and go, odd folders, footers, replays by file, registration, backfills."""

import os
import time
from dataclasses import replace
from datetime import date, datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from rows import DAY, drop_frame, narrow_rows, write_part
from test_jobs import NEXT, OTHER, RUN, break_contract, held_rows, state

from tallymart.operators import evolution
from tallymart.plans import upkeep
from tallymart.plans.bronze import bronze_build
from tallymart.plans.layout import ALERT_TYPES, Layout, known_columns, read_bronze, read_errors, read_or_empty, read_silver
from tallymart.plans.silver import silver_build
from tallymart.sources import folders, manifest, tables
from tallymart.sources.footers import FooterReader, footer_columns

THIRD = date(2024, 4, 22)


def deliver(spark, layout, rows, **more):
    frame = drop_frame(spark, rows)
    for name, value in more.items():
        frame = frame.withColumn(name, value)
    write_part(frame, layout.drop)


# columns beyond the contract


def test_a_column_of_half_the_files_reaches_bronze(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]), campaign=F.lit("spring"))
    deliver(spark, layout, narrow_rows([1, 2, 3, 4], product=2))
    bronze_build(spark, layout, RUN)
    assert known_columns(spark, layout) == {"campaign": "string"}
    found = {(r.product_id, r.campaign) for r in read_bronze(spark, layout, every_column=True).collect()}
    assert found == {(12345, "spring"), (2, None)}
    assert "campaign" not in read_bronze(spark, layout).columns
    silver_build(spark, layout, "silver-1", RUN.at)
    assert read_silver(spark, layout).count() == 2


def test_a_column_is_widened_and_a_conflict_is_a_verdict(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 0, 0, 0]), campaign=F.lit(7).cast("int"))
    deliver(spark, layout, narrow_rows([1, 0, 0, 0], product=2), campaign=F.lit(1 << 40))
    deliver(spark, layout, narrow_rows([1, 0, 0, 0], day=OTHER), campaign=F.lit("x"))
    bronze_build(spark, layout, RUN)
    found = state(spark, layout)
    assert (found[DAY, "ios"].status, found[OTHER, "ios"].status) == ("succeeded", "failed")
    assert {r.campaign for r in read_bronze(spark, layout, every_column=True).collect()} == {7, 1 << 40}
    assert {e.error_message for e in read_errors(spark, layout).collect()} == {"campaign is string, not bigint"}


def test_the_type_of_an_earlier_run_stays(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 0, 0, 0]), campaign=F.lit(7))
    bronze_build(spark, layout, RUN)
    for product in (1, 2):
        deliver(spark, layout, narrow_rows([1, 0, 0, 0], day=OTHER, product=product), campaign=F.lit("x"))
    deliver(spark, layout, narrow_rows([1, 0, 0, 0], day=THIRD), campaign=F.lit(1 << 40))
    bronze_build(spark, layout, NEXT)
    found = state(spark, layout)
    assert (found[OTHER, "ios"].status, found[THIRD, "ios"].status) == ("failed", "succeeded")
    assert known_columns(spark, layout) == {"campaign": "bigint"}
    assert {r.campaign for r in read_bronze(spark, layout, every_column=True).collect()} == {7, 1 << 40}


def test_nested_and_unordered_columns_pass(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 0, 0, 0]), tags=F.create_map(F.lit("a"), F.lit(1)), own=F.struct(F.lit(1).alias("x")))
    bronze_build(spark, layout, RUN)
    rows = read_bronze(spark, layout, every_column=True).collect()
    assert len(rows) == 4 and all(r.tags == {"a": 1} and r.own.x == 1 for r in rows)


def test_settled_types():
    found = [("c", "int", 5), ("c", "bigint", 1), ("C", "string", 2), ("d", "float", 1), ("d", "double", 1), ("e", "date", 1)]
    assert evolution.settle(found, {}) == {"c": "bigint", "d": "double", "e": "date"}
    assert evolution.settle(found, {"e": "string", "x": "int"}) == {"e": "string", "x": "int", "c": "bigint", "d": "double"}


# folders and footers


@pytest.mark.parametrize("spelt", ["2024-4-24", "2024-04-24", "2024-4-024", "April"])
def test_no_day_folder_is_lost_in_silence(spark, root, spelt):
    layout = Layout(root)
    for store in ("ios", "ios,eu", "01"):
        rows = drop_frame(spark, narrow_rows([1, 2, 3, 4])).drop("dt", "store")
        rows.coalesce(1).write.parquet(f"{layout.drop}/dt={spelt}/store={store}")
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    if spelt in ("2024-4-24", "2024-04-24"):
        assert {k: (r.status, r.in_count) for k, r in state(spark, layout).items()} == {
            (DAY, s): ("succeeded", 4) for s in ("ios", "ios,eu", "01")
        }
        assert {r.store for r in read_silver(spark, layout).collect()} == {"ios", "ios,eu", "01"}
    else:
        (error,) = read_errors(spark, layout).collect()
        assert error.source_file.endswith(f"/dt={spelt}") and state(spark, layout) == {}


def test_two_spellings_of_a_day_are_one_partition(spark, root):
    for spelt, n in (("2024-04-24", 1), ("2024-4-24", 2)):
        spark.createDataFrame([(n,)], "n int").write.parquet(f"{root}/dt={spelt}/store=ios")
    found = tables.read_partitions(spark, root, "n int, dt date, store string", [(DAY, "ios")])
    assert sorted((r.n, r.dt) for r in found.collect()) == [(1, DAY), (2, DAY)]
    assert {(r.dt, r.store) for r in manifest.file_manifest(spark, root).collect()} == {(DAY, "ios")}


def test_only_days_of_the_window_are_listed(spark, root, monkeypatch):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 0, 0, 0]) + narrow_rows([2, 0, 0, 0], day=date(2024, 1, 2)))
    seen = []
    real = folders.children
    monkeypatch.setattr(folders, "children", lambda s, p: seen.append(p) or real(s, p))
    listed = manifest.file_manifest(spark, layout.drop, wanted=RUN.wants)
    assert seen == [layout.drop]
    assert {r.dt for r in listed.collect()} == {DAY}
    assert all(f"dt={DAY}" in f for f in listed.inputFiles())


def test_large_files_keep_size_and_time(spark, root, monkeypatch):
    deliver(spark, Layout(root), narrow_rows([1, 0, 0, 0]))
    monkeypatch.setattr(manifest, "MOST_HASHED", 10)
    by_stat = {r.fingerprint for r in manifest.file_manifest(spark, Layout(root).drop).collect()}
    assert {r.fingerprint for r in manifest.file_manifest(spark, Layout(root).drop, by_content=True).collect()} == by_stat


def test_only_a_broken_footer_is_bad_data(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    (path,) = [r.file_path for r in manifest.file_manifest(spark, layout.drop).collect()]
    local = path.removeprefix("file:")
    read = FooterReader(spark)
    assert dict(read(path))["downloads"] == "bigint"
    for raw in (b"PAR1", b"no footer at all", open(local, "rb").read()[:-30] + b"x" * 26 + b"PAR1"):
        with open(f"{root}/broken.parquet", "wb") as handle:
            handle.write(raw)
        assert read(f"{root}/broken.parquet")[0][0] == "<unreadable>"
    for gone in (f"{root}/absent.parquet", "nowhere://host/x.parquet"):
        with pytest.raises(Py4JJavaError):
            read(gone)


def test_denied_access_stops_the_run_and_rejects_nothing(spark, root, monkeypatch):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    real = FooterReader.__call__
    with monkeypatch.context() as patch:
        patch.setattr(FooterReader, "__call__", lambda self, path: real(self, "nowhere://host/denied"))
        with pytest.raises(Py4JJavaError):
            bronze_build(spark, layout, RUN)
    assert state(spark, layout)[DAY, "ios"].status == "failed"
    assert not folders.children(spark, layout.quarantine)
    bronze_build(spark, layout, NEXT)
    assert state(spark, layout)[DAY, "ios"].status == "succeeded"


def test_footers_name_types_as_spark_does(spark, root):
    rows = spark.range(1).selectExpr(
        "id", "cast(id as smallint) s", "cast(id as tinyint) t", "1.5bd d", "cast(1.5 as decimal(6,4)) e", "true b", "date'2024-01-01' x",
        "timestamp'2024-01-01 00:00:00' z", "timestamp_ntz'2024-01-01 00:00:00' n", "array(named_struct('A', 1)) a", "1.0f f", "1.0d g", "x'00' y",
    )
    rows.write.parquet(f"{root}/dt=2024-04-24/store=ios")
    found = footer_columns(manifest.file_manifest(spark, root))
    assert {(r.column_name, r.column_type) for r in found.collect()} == set(rows.dtypes)


# replay by file


def clear(spark, layout, day=OTHER):
    folders.remove(spark, f"{layout.drop}/dt={day}")


def test_a_corrected_delivery_survives_a_replay(spark, root):
    layout = Layout(root)
    break_contract(spark, layout)
    bronze_build(spark, layout, RUN)
    clear(spark, layout)
    time.sleep(1.1)
    deliver(spark, layout, narrow_rows([50, 60, 70, 80], day=OTHER))
    log = upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at)
    assert {r.action for r in log.where("kind = 'raw'").collect()} == {"superseded"}
    assert held_rows(spark, layout) == {DAY: 4, OTHER: 4}
    bronze_build(spark, layout, NEXT)
    assert state(spark, layout)[OTHER, "ios"].status == "succeeded"


def test_a_file_that_is_there_again_is_left_as_it_is(spark, root):
    layout = Layout(root)
    break_contract(spark, layout)
    bronze_build(spark, layout, RUN)
    names = sorted(e.path for e in folders.children(spark, f"{layout.drop}/dt={OTHER}/store=ios") if e.name.endswith(".parquet"))
    folders.remove(spark, names[0])
    log = upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at).where("kind = 'raw'").collect()
    assert sorted(r.action for r in log) == ["present", "present", "replay"]
    assert held_rows(spark, layout) == {DAY: 4, OTHER: 12}


def test_a_second_rejection_of_a_day_is_replayed_too(spark, root):
    layout = Layout(root)
    break_contract(spark, layout)
    bronze_build(spark, layout, RUN)
    clear(spark, layout)
    assert upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at).where("action = 'replay'").count() == 3
    again = replace(RUN, run_id="run-1b", at=datetime(2024, 4, 25, 18))
    bronze_build(spark, layout, again)
    assert state(spark, layout)[OTHER, "ios"].job_run_id == "run-1b"
    clear(spark, layout)
    assert upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at).where("action = 'replay'").count() == 3
    assert held_rows(spark, layout)[OTHER] == 12


def test_a_replay_that_dies_puts_each_file_back_once(spark, root, monkeypatch):
    layout = Layout(root)
    break_contract(spark, layout)
    bronze_build(spark, layout, RUN)
    clear(spark, layout)
    real, moved = upkeep.move, []

    def dies_at_the_second(*args):
        if len(moved) == 1:
            raise RuntimeError("driver lost")
        moved.append(args)
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(upkeep, "move", dies_at_the_second)
        with pytest.raises(RuntimeError):
            upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at)
    log = upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at).where("kind = 'raw'").collect()
    assert sorted(r.action for r in log) == ["present", "replay", "replay"]
    assert held_rows(spark, layout) == {DAY: 4, OTHER: 12}


def test_a_file_of_several_parts_goes_back_whole(spark, root):
    target = f"{root}/drop/dt=2024-04-24/store=ios/one.parquet"
    spark.range(30).repartition(3).write.parquet(f"{root}/parts")
    upkeep._move_parts(spark, f"{root}/parts", target)
    assert sorted(os.listdir(os.path.dirname(target)))[-3:] == ["one-1.parquet", "one-2.parquet", "one.parquet"]
    assert spark.read.parquet(f"{root}/drop").count() == 30


def test_an_unreadable_file_is_lost_once_the_drop_has_lost_it(spark, root):
    layout = Layout(root)
    deliver(spark, layout, narrow_rows([5, 0, 0, 0], day=OTHER))
    with open(f"{layout.drop}/dt={OTHER}/store=ios/part-broken.parquet", "wb") as handle:
        handle.write(b"not a parquet file")
    bronze_build(spark, layout, RUN)
    clear(spark, layout)
    log = upkeep.dlq_replay(spark, layout, "2024-04-25", NEXT.at).where("kind = 'raw'").collect()
    assert sorted((r.action, r.row_count) for r in log) == [("lost", 0), ("replay", 4)]


# registration and backfill


def test_both_jobs_register_what_they_write(spark, root):
    layout = Layout(root, "bronze_" + os.path.basename(root)[-6:].replace("-", "_"), "silver_" + os.path.basename(root)[-6:].replace("-", "_"))
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]) + narrow_rows([5, 0, 0, 0], day=OTHER))
    for turn in (RUN, replace(NEXT, backfill=True)):
        bronze_build(spark, layout, turn)
        silver_build(spark, layout, f"silver-{turn.run_id}", turn.at, force=True)
    try:
        for name, rows in ((layout.bronze_table, 8), (layout.silver_table, 2)):
            assert spark.table(name).count() == rows
            assert {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {f"dt={d}/store=ios" for d in (DAY, OTHER)}
    finally:
        for name in (layout.bronze_table, layout.silver_table):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_broken_catalog_leaves_data_and_ledger_right(spark, root):
    layout = Layout(root, "nowhere.at.all", "nowhere.either")
    deliver(spark, layout, narrow_rows([1, 2, 3, 4]))
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    assert {r.status for r in [*state(spark, layout).values(), *state(spark, layout, "silver").values()]} == {"succeeded"}
    assert read_silver(spark, layout).count() == 1
    subjects = {a.subject for a in read_or_empty(spark, layout.alerts, ALERT_TYPES).collect()}
    assert subjects == {"Daily counters: nowhere.at.all not registered", "Daily counters: nowhere.either not registered"}


def test_a_backfill_takes_its_days_again(spark, root):
    layout = Layout(root)
    old = date(2024, 1, 2)
    deliver(spark, layout, [r for d in (DAY, OTHER, old) for r in narrow_rows([1, 2, 3, 4], day=d)])
    bronze_build(spark, layout, RUN)
    silver_build(spark, layout, "silver-1", RUN.at)
    assert set(state(spark, layout)) == {(DAY, "ios"), (OTHER, "ios")}
    upkeep.backfill_days(spark, layout, "fill-1", NEXT.at, old, OTHER)
    for layer in ("bronze", "silver"):
        runs = {k[0]: r.job_run_id for k, r in state(spark, layout, layer).items()}
        assert runs == {DAY: "run-1" if layer == "bronze" else "silver-1", OTHER: "fill-1", old: "fill-1"}
    with pytest.raises(ValueError):
        upkeep.backfill_days(spark, layout, "fill-2", NEXT.at, DAY, old)
