"""Silver: narrow rows to one wide row per key, with shares."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import CHANNELS, WIDE_KEY, WIDE_TYPES
from ..functions import channel_sum, share
from .cleaning import stamp_ingest


def pivot_wide(narrow: DataFrame, key: list[str] = WIDE_KEY) -> DataFrame:
    """Channel rows to columns, as one partial-then-final hash aggregate.

    A row with an unknown or NULL channel counts in the total and nowhere else; that gap is
    what the equation check looks for. A group of NULL downloads has a NULL total.
    """
    return narrow.groupBy(*key).agg(
        F.sum("downloads").alias("downloads_total"),
        channel_sum("paid_featured", "unpaid_featured").alias("downloads_featured"),
        channel_sum("paid_organic", "unpaid_organic").alias("downloads_organic"),
        *[channel_sum(c).alias(f"downloads_{c}") for c in CHANNELS],
        finalized_flag(),
    )


def finalized_flag():
    """True only when every row of the group is final; a NULL flag counts as not final."""
    return F.min(F.coalesce("is_estimate_final", F.lit(False))).alias("is_estimate_final")


def paid_share():
    paid = F.col("downloads_paid_featured") + F.col("downloads_paid_organic")
    return share(paid, F.col("downloads_total")).alias("paid_share")


def featured_share():
    return share(F.col("downloads_featured"), F.col("downloads_total")).alias("featured_share")


def with_shares(wide: DataFrame) -> DataFrame:
    kept = [c for c in wide.columns if c not in ("paid_share", "featured_share")]
    return wide.select(*kept, paid_share(), featured_share())


def conform_columns(rows: DataFrame, types: dict[str, str] = WIDE_TYPES) -> DataFrame:
    """Contract columns in contract order; anything else is dropped."""
    return rows.select(*[c for c in types if c in rows.columns])


def to_wide(narrow: DataFrame, at: datetime | None = None) -> DataFrame:
    """The complete wide row of the contract."""
    return conform_columns(stamp_ingest(with_shares(pivot_wide(narrow)), at))


def to_wide_by_folder(narrow: DataFrame, at: datetime | None = None) -> DataFrame:
    """Wide rows that stay in the ``store`` folder their narrow rows lie in.

    Usually that is the row's own store; a row filed wrongly is not moved.
    """
    wide = with_shares(pivot_wide(narrow, [*WIDE_KEY, "store"]))
    return conform_columns(stamp_ingest(wide, at), {**WIDE_TYPES, "store": "string"})


def expected_wide_keys(narrow: DataFrame) -> DataFrame:
    """Distinct wide keys per partition: the row-count baseline of the wide table."""
    keys = narrow.select("store", *WIDE_KEY).distinct()
    return keys.groupBy(F.col("dt").alias("partition_dt"), "store").agg(
        F.count("*").alias("expected_count")
    )
