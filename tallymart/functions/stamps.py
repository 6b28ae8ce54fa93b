"""Points in time as columns."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def utc_stamp(at: datetime) -> Column:
    """A datetime without zone is UTC, whatever the zones of driver and session are."""
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((at - EPOCH) // timedelta(microseconds=1)))
