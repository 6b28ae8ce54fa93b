"""Small frames for unit tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from tallymart.contracts import CHANNELS, DROP_TYPES, NARROW_TYPES, VERSIONED_TYPES, WIDE_TYPES, ddl
from tallymart.operators.pivot import to_wide

DAY = date(2024, 4, 24)
AT = datetime(2024, 4, 25, 10, 0)


def narrow_rows(downloads, day=DAY, product=12345, store="ios", country="US", device="iphone", final=True):
    """One group: downloads per channel in contract order, or a dict by channel."""
    per_channel = downloads if isinstance(downloads, dict) else dict(zip(CHANNELS, downloads))
    total = sum(n or 0 for n in per_channel.values())
    return [
        (day, product, store, country, device, channel, n, Decimal(n or 0) / (total or 1), final)
        for channel, n in per_channel.items()
    ]


def narrow(spark, rows, at=AT):
    stamped = [(*row[:7], row[7].quantize(Decimal("0.0001")), row[8], at) for row in rows]
    return spark.createDataFrame(stamped, ddl(NARROW_TYPES))


def drop_frame(spark, rows):
    fixed = [(*row[:7], row[7].quantize(Decimal("0.0001")), row[8], row[2]) for row in rows]
    return spark.createDataFrame(fixed, ddl({**DROP_TYPES, "store": "string"}))


def wide(spark, rows, at=AT):
    return to_wide(narrow(spark, rows), at)


def version(spark, rows, loaded_at):
    from pyspark.sql import functions as F

    frame = wide(spark, rows).withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp"))
    return frame.select(*VERSIONED_TYPES)


def as_dicts(frame, *columns):
    return [row.asDict() for row in (frame.select(*columns) if columns else frame).collect()]


def write_part(frame, root, mode="append"):
    """One file per partition."""
    frame.coalesce(1).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dt", "store").parquet(root)


WIDE_COLUMNS = list(WIDE_TYPES)
