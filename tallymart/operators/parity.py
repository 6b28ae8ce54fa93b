"""Comparing two copies of the wide table."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import SHARES, WIDE_KEY, WIDE_TYPES
from ..functions import count_where, row_checksum

EXACT = [c for c in WIDE_TYPES if c not in SHARES and c != "dt"]
STATS = ["sum", "sumsq", "min", "max", "null_cnt"]
RELATIVE = 1e-6
ABSOLUTE = 1e-9


def _canonical(column: str) -> Column:
    if column == "country":
        return F.rtrim("country")
    if column == "ingest_ts":
        return F.date_format(F.date_trunc("second", "ingest_ts"), "yyyy-MM-dd HH:mm:ss")
    return F.col(column)


def _checksum() -> Column:
    return F.sum(row_checksum([_canonical(c) for c in EXACT])).cast("string").alias("row_checksum")


def parity_checksum(rows: DataFrame) -> DataFrame:
    """Row count and order-independent checksum per day.

    The checksum is text: it may need more digits than other tools keep in a number.
    """
    return rows.groupBy("dt").agg(F.count("*").alias("row_cnt"), _checksum())


def _stats(column: str) -> list[Column]:
    value = F.col(column).cast("double")
    return [
        F.sum(value).alias(f"{column}_sum"),
        F.sum(value * value).alias(f"{column}_sumsq"),
        F.min(value).alias(f"{column}_min"),
        F.max(value).alias(f"{column}_max"),
        count_where(value.isNull()).alias(f"{column}_null_cnt"),
    ]


def parity_stats(rows: DataFrame) -> DataFrame:
    """Sums and extremes of the share columns per day, which may differ by rounding."""
    return rows.groupBy("dt").agg(*[s for c in SHARES for s in _stats(c)])


def parity_profile(rows: DataFrame) -> DataFrame:
    """Checksum and statistics in one pass."""
    return rows.groupBy("dt").agg(
        F.count("*").alias("row_cnt"), _checksum(), *[s for c in SHARES for s in _stats(c)]
    )


def _issue(level: str, name: str, wrong: Column) -> Column:
    return F.when(
        wrong, F.struct(F.lit(level).alias("level"), F.lit(name).alias("issue"))
    )


def parity_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Differences between two copies, day by day: ``dt, level, issue``.

    A day only one copy has is a count difference. Counts, checksums and NULL counts must
    be equal, extremes nearly so, sums within a relative tolerance.
    """
    pair = parity_profile(left).alias("l").join(parity_profile(right).alias("r"), "dt", "full")
    issues = [
        _issue("L1", "row_cnt", ~F.col("l.row_cnt").eqNullSafe(F.col("r.row_cnt"))),
        _issue("L1", "row_checksum", ~F.col("l.row_checksum").eqNullSafe(F.col("r.row_checksum"))),
    ]
    for column in SHARES:
        for stat in STATS:
            a, b = F.col(f"l.{column}_{stat}"), F.col(f"r.{column}_{stat}")
            if stat == "null_cnt":
                wrong = ~a.eqNullSafe(b)
            elif stat in ("min", "max"):
                wrong = (a.isNull() != b.isNull()) | (F.abs(a - b) > ABSOLUTE)
            else:
                a, b = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
                wrong = F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1.0)) > RELATIVE
            issues.append(_issue("L2", f"{column}_{stat}", wrong))
    found = F.filter(F.array(*issues), lambda i: i.isNotNull())
    return pair.select("dt", F.inline(found))


def parity_diff_rows(left: DataFrame, right: DataFrame, sample_one_in: int = 1) -> DataFrame:
    """Rows that differ, with what differs: one row per key and issue.

    A sample is taken by a hash of the key, so both copies sample the same keys. NULL equals
    NULL here. Both sides come down to one row per key before the join: a key that occurs
    many times on both sides must not be joined pair by pair. Such a key is compared by
    number of rows (``copy_count``) and by checksum (``copies_differ``).
    """
    if sample_one_in > 1:
        picked = F.pmod(F.xxhash64(*[_canonical(c) for c in WIDE_KEY]), F.lit(sample_one_in)) == 0
        left, right = left.where(picked), right.where(picked)
    values = [c for c in WIDE_TYPES if c not in WIDE_KEY]
    key = [_canonical(c).alias(c) for c in WIDE_KEY]

    def per_key(rows, side):
        return rows.groupBy(*key).agg(
            # Column by column: the values count only where the key has one row.
            *[F.max(c).alias(f"{side}_{c}") for c in values],
            F.count("*").alias(f"{side}_copies"),
            F.sum(row_checksum([_canonical(c) for c in values])).alias(f"{side}_sum"),
        )

    a, b = per_key(left, "a"), per_key(right, "b")

    def second(value, column):
        return F.date_trunc("second", value) if column == "ingest_ts" else value

    def issue(column):
        x, y = F.col(f"a_{column}"), F.col(f"b_{column}")
        if column not in SHARES:
            return F.when(~second(x, column).eqNullSafe(second(y, column)), F.lit(f"value_diff:{column}"))
        p, q = x.cast("double"), y.cast("double")
        far = F.abs(p - q) / F.greatest(F.abs(p), F.abs(q), F.lit(1.0)) > RELATIVE
        return F.when((p.isNull() != q.isNull()) | far, F.lit(f"tolerance_diff:{column}"))

    def present(*found):
        return F.filter(F.array(*found), lambda i: i.isNotNull())

    repeated = (F.col("a_copies") > 1) | (F.col("b_copies") > 1)
    issues = (
        F.when(F.col("b_copies").isNull(), F.array(F.lit("only_left")))
        .when(F.col("a_copies").isNull(), F.array(F.lit("only_right")))
        .when(
            repeated,
            present(
                F.when(F.col("a_copies") != F.col("b_copies"), F.lit("copy_count")),
                F.when(F.col("a_sum") != F.col("b_sum"), F.lit("copies_differ")),
            ),
        )
        .otherwise(present(*[issue(c) for c in values]))
    )
    return a.join(b, WIDE_KEY, "full").select(*WIDE_KEY, F.explode(issues).alias("issue"))


#: Leaves of one day's keys, and how many of them hang together below one branch.
LEAVES, BRANCH = 4096, 64
LEAF = "_leaf"


def _leaf() -> Column:
    return F.pmod(F.xxhash64(*[_canonical(c) for c in WIDE_KEY]), F.lit(LEAVES)).cast("int")


def _sums(rows: DataFrame, side: str) -> DataFrame:
    """Row count and checksum over every column, shares included, of each leaf of each day."""
    columns = [_canonical(c) for c in WIDE_TYPES]
    return rows.groupBy("dt", _leaf().alias(LEAF)).agg(
        F.count("*").alias(f"{side}_n"), F.sum(row_checksum(columns)).alias(f"{side}_sum")
    )


def parity_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """``dt, branch, _leaf`` of the keys whose sums differ between the copies.

    Keys are dealt into leaves by hash. Leaves are summed in one pass over either side, branches
    from their leaves: a branch that agrees takes its leaves out before they are compared. Sums
    take values exactly, so what the tolerance of shares allows may still be named here; a
    difference beyond it always is.
    """
    a, b = _sums(left, "a"), _sums(right, "b")
    branch = F.floor(F.col(LEAF) / BRANCH).cast("int").alias("branch")

    def branches(leaves: DataFrame, side: str) -> DataFrame:
        return leaves.groupBy("dt", branch).agg(F.sum(f"{side}_n").alias(f"{side}_n"), F.sum(f"{side}_sum").alias(f"{side}_sum"))

    equal = F.col("a_n").eqNullSafe(F.col("b_n")) & F.col("a_sum").eqNullSafe(F.col("b_sum"))
    apart = branches(a, "a").join(branches(b, "b"), ["dt", "branch"], "full").where(~equal).select("dt", "branch")

    def below(leaves: DataFrame) -> DataFrame:
        return leaves.withColumn("branch", F.floor(F.col(LEAF) / BRANCH).cast("int")).join(apart, ["dt", "branch"], "left_semi")

    return below(a).join(below(b), ["dt", "branch", LEAF], "full").where(~equal).select("dt", "branch", LEAF)


def in_leaves(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in leaves that differ."""
    leaves = parity_leaves(left, right).select("dt", LEAF)

    def held(rows: DataFrame) -> DataFrame:
        return rows.withColumn(LEAF, _leaf()).join(leaves, ["dt", LEAF], "left_semi").drop(LEAF)

    return held(left), held(right)


def parity_validate(left: DataFrame, right: DataFrame, sample_one_in: int = 1) -> DataFrame:
    """Cheap checks first; then sums by leaf on the days that failed them; rows of the leaves that
    differ are compared, and no others.

    What comes to the driver is the list of failing days.
    """
    errors = parity_compare(left, right)
    days = [row.dt for row in errors.select("dt").distinct().collect()]
    failing = F.col("dt").isin(days) if days else F.lit(False)
    return parity_diff_rows(*in_leaves(left.where(failing), right.where(failing)), sample_one_in)
