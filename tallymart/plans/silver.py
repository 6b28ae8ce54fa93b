"""Bronze to Silver: pivot, check, publish or quarantine, for all partitions at once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import PARTITION, WIDE_TYPES, ddl
from ..functions.stamps import utc_stamp
from ..operators.ledger import ledger_rows, stale_silver
from ..operators.pivot import expected_wide_keys, to_wide_by_folder
from ..operators.quality import alert_records, dq_gate, dq_run_all
from ..operators.quarantine import DQ_BLOCK, SILVER_PROCESSING_ERROR, quarantine_frame
from ..sources.tables import append_rows, in_partitions, overwrite_partitions, read_table
from .layout import ALERT_TYPES, Layout, append_log, ledger_state, read_bronze, record_failure, register

LAYER = "silver"
STAGED = {**WIDE_TYPES, "store": "string"}
DQ_TYPES = {
    "partition_dt": "date",
    "store": "string",
    "check_name": "string",
    "passed": "boolean",
    "blocking": "boolean",
    "detail": "string",
    "violation_count": "bigint",
    "total_count": "bigint",
    "job_run_id": "string",
}


@dataclass(frozen=True)
class Staged:
    """A staged wide table with its check results and one verdict per partition."""

    rows: DataFrame
    results: DataFrame
    gate: DataFrame


def stage_and_check(
    spark: SparkSession, layout: Layout, narrow: DataFrame, run_id: str, at: datetime
) -> Staged:
    """Write the pivot once, as it comes out of its shuffle, and check what was written.

    The staging table has no folders per partition: it is read whole, and laying it out
    would cost a second shuffle. Results are kept and read back, so that verdicts, ledger
    and alerts do not run the checks again.
    """
    path = layout.staging(run_id, "wide")
    to_wide_by_folder(narrow, at).write.mode("overwrite").parquet(path)
    staged = read_table(spark, path, ddl(STAGED))
    found = dq_run_all(staged.withColumn("partition_dt", F.col("dt")), expected_wide_keys(narrow))
    # A run owns its results: a retry under the same id replaces them.
    overwrite_partitions(found.withColumn("job_run_id", F.lit(run_id)).select(*DQ_TYPES), layout.dq, ["job_run_id"])
    stored = read_table(spark, layout.dq, ddl(DQ_TYPES))
    results = stored.where(F.col("job_run_id") == run_id).drop("job_run_id")
    return Staged(staged, results, dq_gate(results))


def publish(
    spark: SparkSession, layout: Layout, narrow: DataFrame, run_id: str, at: datetime
) -> None:
    """Stage and check the wide rows of ``narrow``, then write or quarantine them."""
    staged = stage_and_check(spark, layout, narrow, run_id, at)
    verdicts = staged.gate.collect()  # one row per partition
    blocked = [(v.partition_dt, v.store) for v in verdicts if v.verdict == "block"]
    held = in_partitions(blocked)
    if len(blocked) < len(verdicts):
        good = staged.rows.where(~held) if blocked else staged.rows
        overwrite_partitions(good, layout.silver)
        done = [(v.partition_dt, v.store) for v in verdicts if v.verdict != "block"]
        register(spark, layout, layout.silver_table, layout.silver, STAGED, done, at)
    if blocked:
        rows = quarantine_frame(staged.rows.where(held), DQ_BLOCK, run_id, at)
        overwrite_partitions(rows, f"{layout.quarantine}/wide", ["failed_at", *PARTITION])
    _record(layout, staged, narrow, run_id, at)


def _record(layout: Layout, staged: Staged, narrow: DataFrame, run_id: str, at: datetime) -> None:
    read = narrow.groupBy(*PARTITION).agg(F.count("*").alias("in_count"))
    written = staged.results.where("check_name = 'row_count'").select(
        F.col("partition_dt").alias("dt"), "store", F.col("total_count").alias("staged")
    )
    verdict = staged.gate.select(F.col("partition_dt").alias("dt"), "store", "verdict")
    blocked = F.col("verdict") == "block"
    counts = verdict.join(read, PARTITION, "left").join(written, PARTITION, "left").select(
        *PARTITION,
        "in_count",
        F.when(blocked, F.lit(0)).otherwise(F.col("staged")).alias("out_count"),
        F.when(blocked, F.col("in_count")).otherwise(F.lit(0)).alias("dlq_rows"),
        F.when(blocked, F.lit("failed")).otherwise(F.lit("succeeded")).alias("state"),
    )
    append_log(ledger_rows(counts, LAYER, F.col("state"), run_id, at), layout.ledger)
    alerts = alert_records(staged.gate).withColumn("raised_at", utc_stamp(at))
    append_rows(alerts.select(*ALERT_TYPES), layout.alerts)


def silver_build(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    at: datetime,
    *,
    force: bool = False,
    window: tuple[date, date] | None = None,
) -> None:
    """Build every partition whose Bronze run succeeded since its last Silver run.

    A partition that another run has started on and may still be working on is left alone.
    ``force`` builds all partitions with a successful Bronze run. ``window`` limits the days, and the
    ledger's folders that are read.
    """
    state = ledger_state(spark, layout, wants=window and (lambda day: window[0] <= day <= window[1]))
    if force:
        ready = state.where("layer = 'bronze' AND status = 'succeeded'")
    else:
        ready = stale_silver(state)
    if window is not None:
        ready = ready.where(F.col("dt").between(F.lit(window[0]), F.lit(window[1])))
    busy = state.where("layer = 'silver' AND status = 'running'").where(
        (F.col("lock_expires_at") >= utc_stamp(at)) & (F.col("job_run_id") != run_id)
    )
    ready = ready.select(*PARTITION).exceptAll(busy.select(*PARTITION))
    todo = [(row.dt, row.store) for row in ready.select(*PARTITION).collect()]
    if not todo:
        return
    wanted = spark.createDataFrame(todo, "dt date, store string")
    append_log(ledger_rows(wanted, LAYER, "running", run_id, at), layout.ledger)
    narrow = read_bronze(spark, layout, todo)
    try:
        publish(spark, layout, narrow, run_id, at)
    except Exception as error:
        record_failure(spark, layout, LAYER, SILVER_PROCESSING_ERROR, todo, error, run_id, at)
        raise
    # Partitions without a Bronze row got no verdict: nothing to write, and done.
    empty = wanted.join(narrow.select(*PARTITION).distinct(), PARTITION, "left_anti")
    append_log(ledger_rows(empty, LAYER, "succeeded", run_id, at), layout.ledger)
