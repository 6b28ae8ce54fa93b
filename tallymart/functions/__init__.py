from .measures import (
    bool_load_rule,
    channel_sum,
    count_where,
    pct,
    safe_ratio,
    share,
)
from .checksums import row_checksum

__all__ = [
    "bool_load_rule",
    "channel_sum",
    "count_where",
    "pct",
    "row_checksum",
    "safe_ratio",
    "share",
]
