"""Column expressions for sums, ratios and load rules. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings a text flag may have at load time.
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]


def safe_ratio(num: Column, den: Column) -> Column:
    """Double ratio; NULL where the denominator is zero (never raises under ANSI)."""
    return num.cast("double") / F.nullif(den, F.lit(0))


def share(num: Column, den: Column) -> Column:
    """Ratio as decimal(6,4); NULL on a zero total or when it does not fit."""
    return safe_ratio(num, den).try_cast("decimal(6,4)")


def pct(num: Column, den: Column, digits: int) -> Column:
    return F.round(100.0 * num / F.nullif(den, F.lit(0)), digits)


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; a NULL condition is not counted."""
    return F.count(F.when(condition, F.lit(1)))


def channel_sum(*channels: str) -> Column:
    """Sum of downloads over the given channels; absent channels give 0, not NULL."""
    return F.sum(F.when(F.col("channel").isin(*channels), F.col("downloads")).otherwise(0))


def bool_load_rule(value: Column, source_type: str) -> Column:
    """Boolean a load makes of a raw value; NULL for anything it rejects.

    Text must match one of the known words exactly (case aside, no padding), integers
    must be 0 or 1. Spark's own casts are laxer on both counts.
    """
    if source_type == "boolean":
        return value
    if source_type == "string":
        word = F.lower(value)
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    return F.when(value == 1, True).when(value == 0, False)
