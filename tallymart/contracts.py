"""Column contracts, keys, domains and thresholds shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and types of the three tables, in storage order.
NARROW_TYPES = {
    "dt": "date",
    "product_id": "bigint",
    "app_store": "string",
    "country": "string",
    "device": "string",
    "channel": "string",
    "downloads": "bigint",
    "share_pct": "decimal(6,4)",
    "is_estimate_final": "boolean",
    "ingest_ts": "timestamp",
}
WIDE_TYPES = {
    "dt": "date",
    "product_id": "bigint",
    "app_store": "string",
    "country": "string",
    "device": "string",
    "downloads_total": "bigint",
    "downloads_featured": "bigint",
    "downloads_organic": "bigint",
    "downloads_paid_featured": "bigint",
    "downloads_paid_organic": "bigint",
    "downloads_unpaid_featured": "bigint",
    "downloads_unpaid_organic": "bigint",
    "paid_share": "decimal(6,4)",
    "featured_share": "decimal(6,4)",
    "is_estimate_final": "boolean",
    "ingest_ts": "timestamp",
}
LOADED_AT = "_loaded_at"
VERSIONED_TYPES = {**WIDE_TYPES, LOADED_AT: "timestamp"}

# Logical keys.
WIDE_KEY = ["dt", "product_id", "app_store", "country", "device"]
NARROW_KEY = [*WIDE_KEY, "channel"]
PARTITION = ["dt", "store"]

# Domains. They are audited, never enforced by a load.
CHANNELS = ["paid_featured", "paid_organic", "unpaid_featured", "unpaid_organic"]
STORES = ["ios", "google-play"]
DEVICES = ["iphone", "ipad", "android-phone", "android-tablet"]

# Drop files carry every narrow column but the ingestion stamp.
DROP_TYPES = {c: t for c, t in NARROW_TYPES.items() if c != "ingest_ts"}
MEASURES = [c for c in WIDE_TYPES if c.startswith("downloads_")]
LEAVES = [f"downloads_{c}" for c in CHANNELS]
SHARES = ["paid_share", "featured_share"]
CRITICAL_COLUMNS = ["product_id", "dt", "country", "app_store"]


def ddl(types: dict[str, str]) -> str:
    """Contract as a DDL string, the form ``spark.read.schema`` takes."""
    return ", ".join(f"`{c}` {t}" for c, t in types.items())


@dataclass(frozen=True)
class Windows:
    """How far back each step looks. The four numbers differ on purpose."""

    lookback_days: int = 14
    dedup_days: int = 10
    date_tolerance_days: int = 7
    trend_days: int = 30


@dataclass(frozen=True)
class Thresholds:
    row_count_diff: float = 0.01
    null_rate: float = 0.001
    equation_rate: float = 0.001


WINDOWS = Windows()
THRESHOLDS = Thresholds()
RUN_TIMEOUT_HOURS = 2
