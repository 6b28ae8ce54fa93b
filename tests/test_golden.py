"""Worked examples with known results."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import AT, DAY, as_dicts, narrow, narrow_rows, version, wide

from tallymart.contracts import WIDE_KEY
from tallymart.functions import bool_load_rule, share
from tallymart.operators import bi, cleaning, gold, pivot, quality, recon, versions


def one(frame):
    (row,) = frame.collect()
    return row


def test_shares_of_a_split_of_a_thousand(spark):
    row = one(wide(spark, narrow_rows([400, 100, 300, 200])))
    assert (row.paid_share, row.featured_share) == (Decimal("0.5000"), Decimal("0.7000"))
    assert (row.downloads_total, row.downloads_featured, row.downloads_organic) == (1000, 700, 300)


def test_restate_shows_in_gold_until_dedup(spark):
    first = version(spark, narrow_rows([1000, 0, 0, 0]), datetime(2024, 4, 25, 10, 5))
    second = version(spark, narrow_rows([1050, 0, 0, 0]), datetime(2024, 4, 26, 10, 5))
    both = first.unionByName(second)
    assert one(gold.gold_daily_by_app(first)).downloads_total == 1000
    assert one(gold.gold_daily_by_app(both)).downloads_total == 2050
    assert one(gold.gold_daily_by_app(both, dedup=True)).downloads_total == 1050
    assert one(versions.latest_view(both)).downloads_total == 1050
    cleaned = versions.dedup_versions(both, date(2024, 4, 27))
    assert one(gold.gold_daily_by_app(cleaned)).downloads_total == 1050


def test_only_the_superseded_one_of_five_rows_goes(spark):
    early, late = datetime(2024, 4, 21, 10, 5), datetime(2024, 4, 26, 10, 5)
    rows = (
        version(spark, narrow_rows([1000, 0, 0, 0], day=date(2024, 4, 20)), early)
        .unionByName(version(spark, narrow_rows([1050, 0, 0, 0], day=date(2024, 4, 20)), late))
        .unionByName(version(spark, narrow_rows([500, 0, 0, 0], day=date(2024, 4, 20), device="ipad"), early))
        .unionByName(version(spark, narrow_rows([800, 0, 0, 0], day=date(2024, 4, 19)), early))
        .unionByName(
            version(spark, narrow_rows([300, 0, 0, 0], day=date(2024, 4, 20), product=67890, country="DE"), early)
        )
    )
    kept = versions.dedup_versions(rows, date(2024, 4, 27)).select("downloads_total").collect()
    assert sorted(r.downloads_total for r in kept) == [300, 500, 800, 1050]


def test_days_before_the_window_keep_their_repeats(spark):
    loads = [datetime(2024, 4, 21, 10, 5), datetime(2024, 4, 26, 10, 5)]
    old = [version(spark, narrow_rows([7, 0, 0, 0], day=date(2024, 4, 16)), at) for at in loads]
    edge = [version(spark, narrow_rows([9, 0, 0, 0], day=date(2024, 4, 17)), at) for at in loads]
    rows = old[0].unionByName(old[1]).unionByName(edge[0]).unionByName(edge[1])
    kept = versions.dedup_versions(rows, date(2024, 4, 27)).collect()
    assert sorted(r.downloads_total for r in kept) == [7, 7, 9]
    touched = versions.touched_by_dedup(rows, date(2024, 4, 27)).collect()
    assert [r.dt for r in touched] == [date(2024, 4, 17)]


def test_equal_load_times_keep_exactly_one_version(spark):
    at = datetime(2024, 4, 26, 10, 5)
    rows = version(spark, narrow_rows([1, 0, 0, 0]), at).unionByName(version(spark, narrow_rows([2, 0, 0, 0]), at))
    assert one(versions.dedup_versions(rows, date(2024, 4, 27))).downloads_total == 2


def test_history_counts_loads_and_the_table_counts_rows(spark):
    days = [date(2026, 5, 11), date(2026, 5, 12), date(2026, 5, 13)]
    history = spark.createDataFrame(
        [(days[0], "a", 1000), (days[0], "b", 1000), (days[1], "c", 2000), (days[1], "d", 2000), (days[2], "e", 1000)],
        "dt date, file_name string, row_count bigint",
    )
    per_day = {days[0]: 1000, days[1]: 2000, days[2]: 1000}
    table = spark.range(1).select(
        F.explode(F.flatten(F.array(*[F.array_repeat(F.lit(d), n) for d, n in per_day.items()]))).alias("dt")
    )
    found = {r.dt: (r.history_rows, r.table_rows, r.delta) for r in recon.recon_load_vs_table(history, table).collect()}
    assert found == {days[0]: (2000, 1000, 1000), days[1]: (4000, 2000, 2000), days[2]: (1000, 1000, 0)}


def test_baseline_counts_wide_keys_not_narrow_rows(spark):
    rows = narrow(spark, narrow_rows([1, 2, 3, 4]) + narrow_rows([1, 2, 3, 4], product=2))
    baseline = pivot.expected_wide_keys(rows.withColumn("store", F.col("app_store")))
    assert one(baseline).expected_count == 2


def test_zero_total_has_no_share(spark):
    row = one(wide(spark, narrow_rows([0, 0, 0, 0])))
    assert row.paid_share is None and row.featured_share is None


def test_share_that_does_not_fit_is_null(spark):
    frame = spark.sql("SELECT 1000 AS num, 1 AS den UNION ALL SELECT -3, 2")
    got = [r[0] for r in frame.select(share(F.col("num"), F.col("den"))).collect()]
    assert got == [None, Decimal("-1.5000")]


def test_unknown_channel_counts_in_the_total_only(spark):
    row = one(wide(spark, narrow_rows({"paid_featured": 5, "mystery": 3, None: 2})))
    assert (row.downloads_total, row.downloads_featured, row.downloads_organic) == (10, 5, 0)


def test_null_downloads(spark):
    row = one(wide(spark, narrow_rows({"paid_featured": None})))
    assert row.downloads_total is None and row.downloads_paid_featured is None and row.downloads_organic == 0


@pytest.mark.parametrize("flags, expected", [([True, True], True), ([True, False], False), ([None, True], False), ([None], False)])
def test_final_only_if_all_rows_are(flags, expected, spark):
    rows = [narrow_rows({c: 1}, final=f)[0] for c, f in zip(["paid_featured", "paid_organic"], flags)]
    assert one(wide(spark, rows)).is_estimate_final is expected


def test_text_flags(spark):
    words = ["true", "TRUE", "t", "Yes", "1", "false", "F", "no", "0", "maybe", "", "N/A", "YES ", None]
    frame = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, w string")
    got = [r.b for r in frame.select("k", bool_load_rule(F.col("w"), "string").alias("b")).orderBy("k").collect()]
    assert got == [True] * 5 + [False] * 4 + [None] * 5


def test_whole_number_flags(spark):
    frame = spark.createDataFrame([(0,), (1,), (2,), (-1,), (None,)], "w int")
    got = [r.b for r in frame.select(bool_load_rule(F.col("w"), "int").alias("b")).collect()]
    assert got == [False, True, None, None, None]


def test_rolling_mean_compares_dates_not_rows(spark):
    days = [date(2024, 1, d) for d in (1, 2, 9)]
    rows = [r for k, d in enumerate(days) for r in narrow_rows([10 * (k + 1), 0, 0, 0], day=d)]
    got = {r.dt: (r.rolling7, r.prior_rolling7) for r in bi.bi_rolling7_vs_prior(wide(spark, rows)).collect()}
    assert got == {days[0]: (10.0, None), days[1]: (15.0, None), days[2]: (20.0, 15.0)}


def test_absent_store_is_null_not_zero(spark):
    row = one(bi.bi_country_store_matrix(wide(spark, narrow_rows([5, 0, 0, 0]))))
    assert (row.ios_total, row.gp_total) == (5, None)


def test_week_over_week_leaves_out_products_without_a_newer_week(spark):
    old = narrow_rows([100, 0, 0, 0], product=1, day=date(2024, 1, 20))
    new = narrow_rows([30, 0, 0, 0], product=2, day=date(2024, 1, 30))
    both = narrow_rows([50, 0, 0, 0], product=3, day=date(2024, 1, 17)) + narrow_rows([75, 0, 0, 0], product=3, day=date(2024, 1, 24))
    got = as_dicts(bi.bi_wow(wide(spark, old + new + both), date(2024, 1, 30)), "product_id", "wow_pct")
    assert got == [{"product_id": 3, "wow_pct": 50.0}, {"product_id": 2, "wow_pct": None}]


def dq_frame(spark, rows, day=DAY):
    return wide(spark, rows).select(F.lit(day).alias("partition_dt"), F.lit("ios").alias("store"), "*")


def results(frame, expected=None):
    return {r.check_name: r for r in quality.dq_run_all(frame, expected).collect()}


def baseline(spark, n, day=DAY):
    return spark.createDataFrame([(day, "ios", n)], "partition_dt date, store string, expected_count bigint")


def test_eight_results_per_partition(spark):
    found = results(dq_frame(spark, narrow_rows([1, 2, 3, 4])))
    assert len(found) == 8 and all(r.passed for r in found.values())
    assert found["row_count"].detail == "no baseline"


@pytest.mark.parametrize("expected, passed", [(1, True), (2, False), (0, False)])
def test_row_count_against_the_baseline(expected, passed, spark):
    found = results(dq_frame(spark, narrow_rows([1, 2, 3, 4])), baseline(spark, expected))
    assert found["row_count"].passed is passed


def test_row_count_tolerates_one_percent(spark):
    rows = [r for p in range(99) for r in narrow_rows([1, 0, 0, 0], product=p)]
    assert results(dq_frame(spark, rows), baseline(spark, 100))["row_count"].passed
    assert not results(dq_frame(spark, rows), baseline(spark, 101))["row_count"].passed


def test_a_partition_that_lost_all_rows_is_reported(spark):
    empty = dq_frame(spark, narrow_rows([1, 2, 3, 4])).where("false")
    found = results(empty, baseline(spark, 5))
    assert not found["row_count"].passed and found["row_count"].violation_count == 5
    assert found["null_rate_dt"].passed


def test_dates_within_a_week_pass(spark):
    near = dq_frame(spark, narrow_rows([1, 0, 0, 0], day=date(2024, 5, 1)))
    far = dq_frame(spark, narrow_rows([1, 0, 0, 0], day=date(2024, 5, 2)))
    assert results(near)["date_range"].passed and not results(far)["date_range"].passed


def test_warnings_do_not_block(spark):
    frame = dq_frame(spark, narrow_rows({"paid_featured": -5, "mystery": 1}))
    (verdict,) = quality.dq_gate(quality.dq_run_all(frame)).collect()
    assert (verdict.verdict, verdict.warnings, verdict.blocking_failures) == ("warn", 2, 0)


def test_alert_subject_is_cut(spark):
    frame = dq_frame(spark, narrow_rows({"mystery": 1}))
    gate = quality.dq_gate(quality.dq_run_all(frame)).withColumn("store", F.lit("x" * 200))
    assert len(one(quality.alert_records(gate)).subject) == 100


def test_dedup_prefers_the_newest_stamp(spark):
    old = narrow(spark, narrow_rows([1, 0, 0, 0]), datetime(2024, 4, 25))
    new = narrow(spark, narrow_rows([2, 0, 0, 0]), datetime(2024, 4, 26))
    kept = cleaning.dedup_pk(old.unionByName(new)).where("channel = 'paid_featured'")
    assert one(kept).downloads == 2


def test_finalized_changed_names_the_first_final_version(spark):
    loads = [datetime(2024, 4, 25, d) for d in (1, 2, 3)]
    rows = (
        version(spark, narrow_rows([1, 0, 0, 0], final=False), loads[0])
        .unionByName(version(spark, narrow_rows([5, 0, 0, 0]), loads[1]))
        .unionByName(version(spark, narrow_rows([6, 0, 0, 0]), loads[2]))
    )
    row = one(versions.finalized_changed(rows))
    assert (row.final_total, row.downloads_total, row.delta) == (5, 6, 1)
    assert row.final_loaded_at == loads[1]


def test_keys_are_the_contract(spark):
    assert WIDE_KEY == ["dt", "product_id", "app_store", "country", "device"]
    assert AT > datetime(2024, 4, 24)
