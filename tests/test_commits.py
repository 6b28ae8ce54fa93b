"""The log of live folders: what dies leaves nothing readable, what is replaced is replaced whole."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from rows import DAY, narrow_rows, version
from test_streams import T1, T2, deliver, run, totals

from tallymart.plans import upkeep
from tallymart.sources import commits, folders
from tallymart.sources.commits import CommitConflict, CommitLog, LiveFolder
from tallymart.streaming import append_load as load

AS_OF = date(2024, 4, 27)
OTHER = date(2024, 4, 23)


class Died(RuntimeError):
    pass


def dies(*args, **kwargs):
    raise Died("executor lost")


def test_a_dead_batch_reloaded_by_hand_is_loaded_once(spark, root, monkeypatch):
    deliver(spark, f"{root}/source", narrow_rows([1000, 0, 0, 0]))
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", dies)
        with pytest.raises(StreamingQueryException):
            run(spark, root, T1)
    target = load.LoadTarget.under(root)
    assert totals(spark, target) == [] and load.read_history(spark, target).count() == 0
    assert folders.children(spark, target.table)  # the rows are there, but nobody reads them
    assert load.reload_files(spark, f"{root}/source", target, T2) == 1
    run(spark, root, T1)
    assert totals(spark, target) == [1000]
    assert [(r.load_batch, r.row_count) for r in load.read_history(spark, target).collect()] == [(-1, 1)]


def test_a_batch_that_is_run_again_replaces_itself(spark, root):
    target = load.LoadTarget.under(root)
    first = narrow_rows([1, 0, 0, 0]) + narrow_rows([5, 0, 0, 0], day=OTHER)
    load.append_batch(spark, version(spark, first, T1), target, 0, T1)
    load.append_batch(spark, version(spark, narrow_rows([7, 0, 0, 0]), T1), target, 1, T1)
    load.append_batch(spark, version(spark, narrow_rows([2, 0, 0, 0]), T1), target, 0, T1)
    assert totals(spark, target) == [2, 7]


def test_two_loads_by_hand_do_not_share_a_number(spark, root, monkeypatch):
    source, target = f"{root}/source", load.LoadTarget.under(root)
    deliver(spark, source, narrow_rows([1, 0, 0, 0]))
    real = commits.CommitLog.commit

    def other_first(log, *args):
        with monkeypatch.context() as patch:
            patch.setattr(CommitLog, "commit", real)
            load.reload_files(spark, source, target, T1)
        return real(log, *args)

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", other_first)
        with pytest.raises(CommitConflict):
            load.reload_files(spark, source, target, T1)
    assert totals(spark, target) == [1]


def two_versions(spark, target):
    for number, at in enumerate((T1, T2)):
        rows = narrow_rows([number + 1, 0, 0, 0]) + narrow_rows([10 + number, 0, 0, 0], day=OTHER)
        load.append_batch(spark, version(spark, rows, at), target, number, at)


@pytest.mark.parametrize("step", ["upkeep.write_attempt", "CommitLog.commit", "folders.write_new", "folders.move"])
def test_dedup_killed_at_any_step_leaves_the_old_days(spark, root, monkeypatch, step):
    target = load.LoadTarget.under(root)
    two_versions(spark, target)
    owner = {"upkeep": upkeep, "CommitLog": CommitLog, "folders": folders}[step.split(".")[0]]
    with monkeypatch.context() as patch:
        patch.setattr(owner, step.split(".")[1], dies)
        with pytest.raises(Died):
            upkeep.dedup_in_place(spark, target, AS_OF)
    assert totals(spark, target) == [1, 2, 10, 11]
    assert upkeep.dedup_in_place(spark, target, AS_OF) == [OTHER, DAY]
    assert totals(spark, target) == [2, 11]
    assert upkeep.dedup_in_place(spark, target, AS_OF) == []


def test_dedup_killed_after_its_commit_leaves_the_new_days(spark, root, monkeypatch):
    target = load.LoadTarget.under(root)
    two_versions(spark, target)
    real = CommitLog.commit

    def commits_and_dies(*args):
        real(*args)
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", commits_and_dies)
        with pytest.raises(Died):
            upkeep.dedup_in_place(spark, target, AS_OF)
    assert totals(spark, target) == [2, 11]


def during_dedup(monkeypatch, act):
    real = upkeep.write_attempt

    def acts(*args):
        found = real(*args)
        act()
        return found

    monkeypatch.setattr(upkeep, "write_attempt", acts)


def test_a_batch_that_arrives_during_dedup_stays(spark, root, monkeypatch):
    target = load.LoadTarget.under(root)
    two_versions(spark, target)
    later = version(spark, narrow_rows([9, 0, 0, 0]), datetime(2024, 4, 27))
    with monkeypatch.context() as patch:
        during_dedup(patch, lambda: load.append_batch(spark, later, target, 2, T2))
        upkeep.dedup_in_place(spark, target, AS_OF)
    assert totals(spark, target) == [2, 9, 11]


def test_two_dedups_at_once_change_the_days_once(spark, root, monkeypatch):
    target = load.LoadTarget.under(root)
    two_versions(spark, target)
    with monkeypatch.context() as patch:
        real = upkeep.write_attempt

        def other():
            patch.setattr(upkeep, "write_attempt", real)
            upkeep.dedup_in_place(spark, target, AS_OF)

        during_dedup(patch, other)
        with pytest.raises(CommitConflict):
            upkeep.dedup_in_place(spark, target, AS_OF)
    assert totals(spark, target) == [2, 11]


def test_only_folders_of_the_days_asked_for_are_read(spark, root):
    target = load.LoadTarget.under(root)
    two_versions(spark, target)
    rows = load.read_versions(spark, target, [OTHER])
    assert rows.inputFiles() and all(f"dt={OTHER}" in f for f in rows.inputFiles())
    assert sorted(r.downloads_total for r in rows.collect()) == [10, 11]
    assert load.read_versions(spark, target, [date(2020, 1, 1)]).count() == 0


def folder(k):
    return LiveFolder("versions", f"attempt={k}/dt=2024-04-24/load_batch={k}", "2024-04-24", k)


def test_the_log_folds_and_a_dead_fold_counts_for_nothing(spark, root, monkeypatch):
    log = CommitLog(spark, f"{root}/commits")
    monkeypatch.setattr(commits, "FOLD_AFTER", 4)
    for k in range(6):
        log.commit([folder(k)], lambda live: [folder(0).folder] if k == 3 else [], T1)
    with open(f"{root}/commits/.draft-snapshot-000000000009.json-x", "w") as handle:
        handle.write("{")
    assert any(e.name.startswith("snapshot-") for e in folders.children(spark, log.path))
    version, live = log.state()
    assert version == 5 and set(live.values()) == {folder(k) for k in range(1, 6)}
    assert log.vacuum([], datetime.now() + timedelta(days=2)) == 0
    names = [e.name for e in folders.children(spark, log.path)]
    assert "commit-000000000000.json" not in names and not any("draft" in n for n in names)
    assert log.state() == (version, live)


def test_vacuum_removes_what_nobody_reads(spark, root):
    target = load.LoadTarget.under(root)
    two_versions(spark, target)
    upkeep.dedup_in_place(spark, target, AS_OF)
    log = target.log(spark)
    assert log.vacuum([target.table, target.history], datetime(2020, 1, 1)) == 0
    assert log.vacuum([target.table, target.history], datetime.now() + timedelta(days=2)) == 2
    assert totals(spark, target) == [2, 11]


def test_a_taken_name_is_not_written_over(spark, root):
    assert folders.write_new(spark, f"{root}/x/one.json", "a") and not folders.write_new(spark, f"{root}/x/one.json", "b")
    assert folders.read_text(spark, f"{root}/x/one.json") == "a"
    assert [e.name for e in folders.children(spark, f"{root}/x")] == ["one.json"]
