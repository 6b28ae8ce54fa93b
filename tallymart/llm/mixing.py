"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

A source's target over its size is the number of copies each of its documents should have. The
whole part is given to all. The fractions are rounded in pairs: of two documents, words of
fraction move from one to the other, the way drawn at random so that expectations hold, until
one of them has no copy or a full copy more. The other goes on to the next pair. A source's
words are thereby kept to within one document. Blocks of a source's documents are folded first;
what each block leaves over is folded with that of others, level by level, to one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.common import SPACE_RE, SPACES, documents, staged

#: Documents that one fold takes on average.
BLOCK = 128
ITEM = "struct<doc_id:bigint,copy:bigint,size:bigint>"


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RE))).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """source, n, source_size, target of each source, from rows of source and size.

    Sources in order of code points, null last, take the weights in turn. Targets share the sum
    of all sizes by weight; a target above ``cap`` times its source's size stops there, and the
    rest is shared again. Solved at once: in order of cap over weight, the capped ones come first.
    """
    per_source = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = per_source.select("*", place.alias("place"), weight.alias("weight"))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    ranked = ranked.withColumn("ratio", F.col("most") / F.col("weight"))
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(after))
    level = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(everything)
    ranked = ranked.withColumn("share", level)
    target = F.least("most", F.coalesce(F.col("share") * F.col("weight"), F.col("most")))
    return ranked.select("source", "n", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    spark: SparkSession,
    weights: tuple[float, ...] = (1, 2, 3),
    cap: float = 3.0,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source, source_size, target, copies, taken.

    A null or empty text has size 0, is never drawn and has the whole copies of its source only.
    A null source is a source, the last one; the empty string is another. Draws depend on ids,
    not on order or partitions. Rows that repeat an id and size are drawn apart, each for itself.
    A source without words has target 0. An empty table gives no rows.
    """
    sizes = documents(docs, "source").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = staged(sizes, "sizes", spark)
    shares = staged(targets(sizes, weights, cap), "shares", spark)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = shares.withColumn("rate", rate).withColumn("whole", F.floor("rate")).withColumnRenamed("source", "of")
    counted = sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows"))
    items = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), "rows"))).join(
        shares, F.col("source").eqNullSafe(F.col("of"))
    )
    drawn = (F.col("size") > 0) & (F.col("rate") > F.col("whole"))
    facts = ["source", "source_size", "target"]
    items = staged(
        items.select(
            F.struct("doc_id", "copy", "size").alias("item"),
            F.when(drawn, F.col("size") * (F.col("rate") - F.col("whole"))).alias("words"),
            "whole",
            "n",
            *facts,
        ),
        "items",
        spark,
    )
    parts = [items.where("words is null").select("item", F.lit(0).alias("more"), "whole", *facts)]
    rest = items.where("words is not null")
    levels = folds_needed(shares.agg(F.max("n")).first()[0] or 0, block)
    for level in range(levels):
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(block ** (level + 1))))
        key = F.pmod(F.xxhash64("item.doc_id", "item.copy", "item.size", F.lit(seed + level)), blocks)
        rows = F.collect_list(F.struct(F.xxhash64("item", F.lit(seed)).alias("turn"), "item", "words"))
        grouped = rest.groupBy(*facts, "whole", "n", key.alias("block")).agg(F.array_sort(rows).alias("rows"))
        folded = staged(grouped.select("whole", "n", *facts, fold(level, seed).alias("f")), f"fold-{level}", spark)
        done = folded.select("whole", *facts, F.explode("f.done").alias("d"))
        parts.append(done.select("d.item", F.col("d.more").cast("int").alias("more"), "whole", *facts))
        rest = folded.select("f.open.item", "f.open.words", "whole", "n", *facts)
    if levels:
        last = uniform(F.lit(seed + levels), "item") * F.col("item.size") < F.col("words")
        parts.append(rest.select("item", last.cast("int").alias("more"), "whole", *facts))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    copies = (F.col("whole") + F.col("more")).cast("long")
    return rows.select(
        "item.doc_id", "item.size", *facts, copies.alias("copies"), (copies * F.col("item.size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows that repeat an id share the copies of that id evenly, as far as whole numbers go.
    """
    per_id = decisions.groupBy("doc_id").agg(F.sum("copies").alias("_llm_copies"), F.count("*").alias("_llm_rows"))
    per_id = per_id.where("_llm_copies > 0").withColumnRenamed("doc_id", "_llm_id")
    found = docs.join(per_id, F.col("doc_id").eqNullSafe(F.col("_llm_id")))
    turn = F.row_number().over(Window.partitionBy("_llm_id").orderBy(F.length("text"), "text")) - 1
    found = found.where("_llm_rows = 1").withColumn("_llm_turn", F.lit(0)).unionByName(
        found.where("_llm_rows > 1").withColumn("_llm_turn", turn)
    )
    own = F.floor((F.col("_llm_turn") + 1) * F.col("_llm_copies") / F.col("_llm_rows")) - F.floor(
        F.col("_llm_turn") * F.col("_llm_copies") / F.col("_llm_rows")
    )
    found = found.withColumn("_llm_own", own.cast("int")).where("_llm_own > 0")
    return found.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), "_llm_own"))).select(*docs.columns)


def folds_needed(n: int, block: int) -> int:
    """Levels until the largest source is in one block."""
    return math.ceil(math.log(n) / math.log(block)) or 1 if n > 1 else n


def uniform(seed: Column, *of: str | Column) -> Column:
    """A number in [0, 1) drawn from a hash."""
    return F.shiftrightunsigned(F.xxhash64(seed, *of), 11) / F.lit(float(1 << 53))


def fold(level: int, seed: int) -> Column:
    """The rows of a block, paired one after the other: all decided ones, and the one left open."""
    head = F.element_at("rows", 1)
    start = F.struct(
        F.array().cast(f"array<struct<item:{ITEM},more:boolean>>").alias("done"),
        F.struct(head["item"].alias("item"), head["words"].alias("words")).alias("open"),
    )

    def pair(state: Column, row: Column) -> Column:
        mine, other = state["open"], row
        total = mine["words"] + other["words"]
        room, others_room = mine["item"]["size"] - mine["words"], other["item"]["size"] - other["words"]
        gain, loss = F.least(room, other["words"]), F.least(mine["words"], others_room)
        draw = uniform(F.lit(seed + 1000 * (level + 1)), mine["item"], other["item"])
        up = draw * (gain + loss) < loss
        full, empty = up & (room <= other["words"]), ~up & (mine["words"] <= others_room)
        closes = full | empty  # whether it is mine that is decided
        item = F.when(closes, mine["item"]).otherwise(other["item"])
        more = F.when(closes, full).otherwise(~up)
        left = F.when(closes, other["item"]).otherwise(mine["item"])
        words = total - F.when(more, item["size"]).otherwise(F.lit(0))
        return F.struct(
            F.array_append(state["done"], F.struct(item.alias("item"), more.alias("more"))).alias("done"),
            F.struct(left.alias("item"), words.alias("words")).alias("open"),
        )

    return F.aggregate(F.slice("rows", 2, F.size("rows")), start, pair)
