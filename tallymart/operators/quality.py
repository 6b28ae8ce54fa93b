"""Data-quality checks per partition, all from one aggregate."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import CRITICAL_COLUMNS, MEASURES, THRESHOLDS, WINDOWS, Thresholds
from ..functions import count_where

BY = ["partition_dt", "store"]
RESULT = [*BY, "check_name", "passed", "blocking", "detail", "violation_count", "total_count"]


def dq_metrics(wide: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Counts behind every check, one row per partition, one pass over the rows.

    ``wide`` carries its partition as ``partition_dt, store``. A partition that is expected
    but has no rows at all appears with a count of zero.
    """
    tolerance = WINDOWS.date_tolerance_days
    too_early = F.col("dt") < F.date_sub("partition_dt", tolerance)
    too_late = F.col("dt") > F.date_add("partition_dt", tolerance)
    measures = [c for c in MEASURES if c in wide.columns]
    negative = reduce(or_, [F.col(c) < 0 for c in measures])
    split = F.col("downloads_featured") + F.col("downloads_organic")
    counts = wide.groupBy(*BY).agg(
        F.count("*").alias("total_count"),
        *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS],
        count_where(too_early | too_late).alias("out_of_range"),
        count_where(negative).alias("negative"),
        count_where(F.col("downloads_total") != split).alias("unequal"),
    )
    if expected is None:
        return counts.withColumn("expected_count", F.lit(None).cast("bigint"))
    return counts.join(expected, BY, "full").select(
        *BY,
        "expected_count",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts.columns if c not in BY],
    )


def _result(name: str, passed: Column, blocking: bool, detail: Column, violations: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        F.lit(blocking).alias("blocking"),
        detail.alias("detail"),
        violations.cast("bigint").alias("violation_count"),
        F.col("total_count"),
    )


def _rate_ok(violations: Column, limit: float) -> Column:
    rate = violations / F.nullif(F.col("total_count"), F.lit(0))
    return F.coalesce(rate, F.lit(0.0)) <= limit


def _of_total(violations: Column) -> Column:
    return F.format_string("%d of %d rows", violations, F.col("total_count"))


def _row_count(limit: float) -> Column:
    actual, expected = F.col("total_count"), F.col("expected_count")
    gap = F.abs(actual - expected)
    passed = (
        F.when(expected.isNull(), True)
        .when(expected == 0, actual == 0)
        .otherwise(gap / F.nullif(expected, F.lit(0)) <= limit)
    )
    detail = F.when(expected.isNull(), F.lit("no baseline")).otherwise(
        F.format_string("expected %d, found %d", expected, actual)
    )
    return _result("row_count", passed, True, detail, F.coalesce(gap, F.lit(0)))


def _null_rate(column: str, limit: float) -> Column:
    nulls = F.col(f"null_{column}")
    return _result(f"null_rate_{column}", _rate_ok(nulls, limit), True, _of_total(nulls), nulls)


def _date_range() -> Column:
    bad = F.col("out_of_range")
    return _result("date_range", bad == 0, True, _of_total(bad), bad)


def _non_negative() -> Column:
    bad = F.col("negative")
    return _result("non_negative_downloads", bad == 0, False, _of_total(bad), bad)


def _equation(limit: float) -> Column:
    bad = F.col("unequal")
    name = "equation_total_eq_featured_plus_organic"
    return _result(name, _rate_ok(bad, limit), False, _of_total(bad), bad)


def dq_results(
    metrics: DataFrame, checks: list[str] | None = None, limits: Thresholds = THRESHOLDS
) -> DataFrame:
    """Metrics to result rows, eight per partition; ``checks`` picks by name prefix."""
    results = {
        "row_count": _row_count(limits.row_count_diff),
        **{f"null_rate_{c}": _null_rate(c, limits.null_rate) for c in CRITICAL_COLUMNS},
        "date_range": _date_range(),
        "non_negative": _non_negative(),
        "equation": _equation(limits.equation_rate),
    }
    picked = [r for name, r in results.items() if not checks or name.startswith(tuple(checks))]
    return metrics.select(*BY, F.inline(F.array(*picked))).select(*RESULT)


def dq_run_all(wide: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    return dq_results(dq_metrics(wide, expected))


def dq_gate(results: DataFrame) -> DataFrame:
    """``block``, ``warn`` or ``pass`` per partition, with the names of all failed checks.

    A failed blocking check keeps the partition out; a failed warning does not.
    """
    failed = ~F.col("passed")
    verdict = (
        F.when(F.bool_or(failed & F.col("blocking")), F.lit("block"))
        .when(F.bool_or(failed), F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    # At most eight names per partition are collected.
    names = F.sort_array(F.collect_list(F.when(failed, F.col("check_name"))))
    return results.groupBy(*BY).agg(
        verdict.alias("verdict"),
        count_where(failed & F.col("blocking")).alias("blocking_failures"),
        count_where(failed & ~F.col("blocking")).alias("warnings"),
        F.concat_ws("; ", names).alias("failures"),
    )


def alert_records(gate: DataFrame, title: str = "Daily counters") -> DataFrame:
    """One alert row per partition that was blocked or warned about. Sending is left out."""
    raised = gate.where(F.col("verdict") != "pass")
    where = F.concat_ws("/", F.date_format("partition_dt", "yyyy-MM-dd"), "store")
    subject = F.concat(F.lit(f"{title}: quality "), "verdict", F.lit(" "), where)
    outcome = F.when(F.col("verdict") == "block", "kept out").otherwise("written")
    return raised.select(
        *BY,
        F.substring(subject, 1, 100).alias("subject"),
        F.concat_ws(" ", F.lit("Partition"), where, outcome, F.concat(F.lit("("), "failures", F.lit(")"))).alias("message"),
    )
