"""Manifests, CSV, seeding, parity, monitors and hot keys."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from rows import AT, DAY, drop_frame, narrow, narrow_rows, version, wide, write_part

from tallymart.contracts import CHANNELS, DROP_TYPES, WIDE_KEY
from tallymart.operators import audits, cleaning, monitors, parity, pivot, versions
from tallymart.plans.bronze import BronzeRun, bronze_build
from tallymart.plans.layout import Layout, layer_state
from tallymart.session import new_workspace, scratch_root
from tallymart.sources import drop, manifest, seed


def test_scan_skips_folders_without_both_levels(spark, root):
    write_part(drop_frame(spark, narrow_rows([1, 2, 3, 4])), root)
    drop_frame(spark, narrow_rows([9, 9, 9, 9])).drop("dt", "store").write.parquet(f"{root}/dt=2024-04-22")
    assert {r.dt for r in drop.scan_drop(spark, root).collect()} == {DAY}


def test_manifest_fingerprints(spark, root):
    write_part(drop_frame(spark, narrow_rows([1, 2, 3, 4])), root)
    (by_stat,) = manifest.file_manifest(spark, root).collect()
    (by_content,) = manifest.file_manifest(spark, root, by_content=True).collect()
    assert by_stat.file_path == by_content.file_path and len(by_content.fingerprint) == 32
    assert str(by_stat.file_bytes) in by_stat.fingerprint


def csv(spark, root, lines, header="product_id,app_store,country,device,channel,downloads,share_pct,is_estimate_final"):
    text = spark.createDataFrame([("\n".join([header, *lines]),)], "value string")
    text.coalesce(1).write.option("compression", "gzip").text(f"{root}/dt=2024-04-24/store=ios")


def test_csv_keeps_the_text_of_bad_lines(spark, root):
    csv(spark, root, ["1,ios,US,iphone,paid_featured,10,0.5,true", "x,ios,US,iphone,paid_organic,ten,0.5,true"])
    rows = spark.createDataFrame(drop.scan_drop_csv(spark, root).collect(), drop.scan_drop_csv(spark, root).schema)
    assert [r.downloads for r in rows.where("_corrupt_record IS NULL").collect()] == [10]
    (bad,) = rows.where("_corrupt_record IS NOT NULL").collect()
    assert bad._corrupt_record.startswith("x,ios") and bad.dt == DAY


def test_csv_with_other_columns_is_refused(spark, root):
    csv(spark, root, ["1,2"], header="product_id,something")
    with pytest.raises(Exception, match="(?i)header|column"):
        drop.scan_drop_csv(spark, root).collect()


def test_backfill_range_is_checked(spark, root):
    with pytest.raises(ValueError):
        drop.backfill_range(spark.range(1), date(2024, 2, 1), date(2024, 1, 1))


def test_seed_is_deterministic_and_adds_up(spark):
    ids = spark.range(1000).repartition(7)
    one = seed.seed_narrow(ids, DAY, "ios")
    again = seed.seed_narrow(spark.range(1000), DAY, "ios")
    assert one.exceptAll(again).count() == 0 and one.count() == 4000
    groups = one.groupBy(*WIDE_KEY).agg(F.count("*").alias("n"), F.min("downloads").alias("least"), F.sum("downloads").alias("total"))
    low = groups.agg(F.min("least"), F.min("total"), F.max("total")).first()
    assert low[0] >= 0 and low[1] >= 50 and low[2] <= 50_000
    final = one.agg(F.avg(F.col("is_estimate_final").cast("int"))).first()[0]
    assert 0.65 < final < 0.75
    assert pivot.pivot_wide(one).count() == groups.count()


def test_seeded_schema_break_is_rejected(spark, root):
    layout = Layout(root)
    broken = seed.seed_narrow(spark.range(50), DAY, "ios", "schema_break").withColumn("store", F.col("app_store"))
    write_part(broken, layout.drop)
    bronze_build(spark, layout, BronzeRun("run-1", AT, date(2024, 4, 25)))
    (row,) = layer_state(spark, layout, "bronze").collect()
    assert (row.status, row.dlq_rows) == ("failed", 200)


@pytest.mark.parametrize("arguments", [("windows", "clean"), ("ios", "odd")])
def test_seed_arguments(arguments, spark):
    with pytest.raises(ValueError):
        seed.seed_narrow(spark.range(1), DAY, *arguments)


def copies(spark, *numbers):
    frame = None
    for n in numbers:
        rows = wide(spark, narrow_rows([n, 0, 0, 0]))
        frame = rows if frame is None else frame.unionByName(rows)
    return frame


def issues(left, right):
    return sorted(r.issue for r in parity.parity_diff_rows(left, right).collect())


def test_equal_copies_have_no_difference(spark):
    left = copies(spark, 5).withColumn("country", F.rpad("country", 6, " "))
    assert parity.parity_compare(left, copies(spark, 5)).count() == 0
    assert issues(left, copies(spark, 5)) == []
    assert parity.parity_validate(left, copies(spark, 5)).count() == 0


def test_null_equals_null(spark):
    assert issues(copies(spark, 0), copies(spark, 0)) == []


def test_one_sided_rows_on_both_sides(spark):
    other = wide(spark, narrow_rows([1, 0, 0, 0], product=2))
    assert issues(copies(spark, 5), other) == ["only_left", "only_right"]


def test_repeated_keys_are_compared_without_pairing(spark):
    assert issues(copies(spark, 1, 2, 3), copies(spark, 3, 2, 1)) == []
    assert issues(copies(spark, 1, 2), copies(spark, 1, 3)) == ["copies_differ"]
    assert issues(copies(spark, 1, 2), copies(spark, 1)) == ["copies_differ", "copy_count"]


def test_checksum_tells_null_from_empty(spark):
    rows = copies(spark, 5)
    blank, none = rows.withColumn("device", F.lit("")), rows.withColumn("device", F.lit(None).cast("string"))
    sums = [parity.parity_checksum(r).first().row_checksum for r in (blank, none)]
    assert sums[0] != sums[1]


def test_sample_takes_the_same_keys_on_both_sides(spark):
    rows = [r for p in range(200) for r in narrow_rows([p + 1, 0, 0, 0], product=p)]
    left, right = wide(spark, rows), wide(spark, rows).withColumn("country", F.rpad("country", 4, " "))
    assert parity.parity_diff_rows(left, right, sample_one_in=4).count() == 0
    changed = right.withColumn("downloads_total", F.col("downloads_total") + 1)
    assert 0 < parity.parity_diff_rows(left, changed, sample_one_in=4).count() < 200


def test_freshness_is_silent_after_a_load(spark):
    history = spark.createDataFrame([(datetime(2024, 4, 25, 11),)], "last_load_time timestamp")
    assert monitors.mon_load_freshness(history, date(2024, 4, 25)).count() == 0
    assert monitors.mon_load_freshness(history, date(2024, 4, 26)).count() == 1


def test_key_skew_flags_a_hot_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    found = monitors.mon_key_skew(rows, ["k"]).first()
    assert (found.keys, found.max_rows, found.median_rows, found.suspicious) == (601, 400, 1.0, True)


def test_approximate_coverage(spark):
    rows = narrow(spark, narrow_rows([1, 2, 3, 4])).withColumn("store", F.col("app_store"))
    exact = audits.audit_narrow_coverage(rows, DAY).first()
    assert audits.audit_narrow_coverage(rows, DAY, approx=True).first() == exact


def test_hot_key_against_brute_force(spark):
    """A third of all rows share one key; results equal a plain Python computation."""
    rows = []
    for n in range(900):
        product = 1 if n % 3 == 0 else n
        rows.append((product, CHANNELS[n % 4], n * 37 % 101, n))
    frame = spark.createDataFrame(rows, "product_id bigint, channel string, downloads bigint, seq bigint").select(
        F.lit(DAY).alias("dt"), "product_id", F.lit("ios").alias("app_store"), F.lit("US").alias("country"),
        F.lit("iphone").alias("device"), "channel", "downloads", F.lit(True).alias("is_estimate_final"), "seq",
    )
    best = {}
    for product, channel, downloads, seq in rows:
        if (product, channel) not in best or seq > best[product, channel][0]:
            best[product, channel] = (seq, downloads)
    want = {}
    for (product, _), (_, downloads) in best.items():
        want[product] = want.get(product, 0) + downloads
    kept = cleaning.dedup_pk(frame, [F.col("seq").desc()])
    got = {r.product_id: r.downloads_total for r in pivot.pivot_wide(kept).collect()}
    assert got == want


def test_many_versions_of_one_key(spark):
    loads = [datetime(2024, 4, 25, 0, m) for m in range(12)]
    rows = None
    for m, at in enumerate(loads):
        one = version(spark, narrow_rows([m, 0, 0, 0], final=m >= 5), at)
        rows = one if rows is None else rows.unionByName(one)
    changed = versions.finalized_changed(rows).collect()
    assert sorted(r.downloads_total for r in changed) == list(range(6, 12))
    assert versions.latest_view(rows).first().downloads_total == 11


def test_workspace_follows_the_session(spark):
    assert new_workspace(spark, "x").startswith(scratch_root(spark) if spark.conf.get("spark.checkpoint.dir", None) else "/")
    assert new_workspace(spark, "x") != new_workspace(spark, "x")


def test_drop_contract_has_no_stamp():
    assert "ingest_ts" not in DROP_TYPES
