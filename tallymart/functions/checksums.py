"""Order-independent row checksums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_checksum(columns: list[Column]) -> Column:
    """60-bit number per row; sum it for a checksum that ignores row order.

    NULLs get a marker of their own, so NULL and '' differ.
    """
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("__NULL__")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
