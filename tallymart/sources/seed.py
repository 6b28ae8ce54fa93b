"""Synthetic narrow drops, generated in the executors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import CHANNELS, DROP_TYPES
from ..functions import share

# Pools the generator draws from.
COUNTRIES = ["US", "GB", "DE", "FR", "JP", "BR", "IN", "MX", "KR", "ID"]
DEVICES_BY_STORE = {
    "ios": ["iphone", "ipad"],
    "google-play": ["android-phone", "android-tablet"],
}
SCENARIOS = ("clean", "schema_break")


def _draw(salt: str, below: int):
    """Whole number in [0, below) from the group id: same id and salt, same number."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(salt), F.col("id"))), 1, 12), 16, 10)
    return digits.cast("bigint") % below


def seed_narrow(ids: DataFrame, dt: date, store: str, scenario: str = "clean") -> DataFrame:
    """Four channel rows for each group id (column ``id``) that add up to the group total.

    Values depend on id, day and store only, so any run on any cluster gives the same rows.
    What integer division leaves over goes to the first channel. About 70 % of the groups
    are final. ``schema_break`` drops one contract column.
    """
    if store not in DEVICES_BY_STORE:
        raise ValueError(f"store must be one of {sorted(DEVICES_BY_STORE)}, got {store!r}")
    if scenario not in SCENARIOS:
        raise ValueError(f"scenario must be one of {SCENARIOS}, got {scenario!r}")
    salt = f"{dt.isoformat()}/{store}"
    countries = F.array(*[F.lit(c) for c in COUNTRIES])
    devices = F.array(*[F.lit(d) for d in DEVICES_BY_STORE[store]])
    weights = [1 + _draw(f"{salt}/{c}", 1000) for c in CHANNELS]
    groups = ids.select(
        F.col("id"),
        (1_000_000 + _draw(f"{salt}/product", 9_000_000)).alias("product_id"),
        F.element_at(countries, (1 + _draw(f"{salt}/country", len(COUNTRIES))).cast("int")).alias("country"),
        F.element_at(devices, (1 + _draw(f"{salt}/device", 2)).cast("int")).alias("device"),
        (50 + _draw(f"{salt}/total", 49_951)).alias("total"),
        (_draw(f"{salt}/final", 10) < 7).alias("is_estimate_final"),
        *[w.alias(f"w_{c}") for c, w in zip(CHANNELS, weights)],
    )
    weight_sum = sum((F.col(f"w_{c}") for c in CHANNELS[1:]), F.col(f"w_{CHANNELS[0]}"))
    parts = {
        c: F.floor(F.col("total") * F.col(f"w_{c}") / weight_sum).cast("bigint") for c in CHANNELS[1:]
    }
    rest = F.col("total")
    for c in CHANNELS[1:]:
        rest = rest - parts[c]
    parts = {CHANNELS[0]: rest, **parts}
    split = F.array(
        *[F.struct(F.lit(c).alias("channel"), parts[c].alias("downloads")) for c in CHANNELS]
    )
    rows = groups.select("*", F.inline(split)).select(
        F.lit(dt).alias("dt"),
        "product_id",
        F.lit(store).alias("app_store"),
        "country",
        "device",
        "channel",
        "downloads",
        share(F.col("downloads"), F.col("total")).alias("share_pct"),
        "is_estimate_final",
    )
    kept = [c for c in DROP_TYPES if scenario == "clean" or c != "is_estimate_final"]
    return rows.select(*kept)
