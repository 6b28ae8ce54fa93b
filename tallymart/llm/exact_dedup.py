"""Exact dedup by content-defined chunk recipes.

A normalised text is cut into content-defined chunks. Equal chunks get one identifier: their
digest, and a variant number where two different chunks share a digest, which is found by
comparing the chunks' bytes. A text becomes its recipe, the ordered list of identifiers, and
texts are equal where recipes are. The bytes of a chunk move once, and within a task equal
chunks are combined before they move; after that only recipes do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.chunking import Cutter
from tallymart.llm.common import (
    FINE_BYTES,
    IS_SPACE,
    SPACE_RE,
    documents,
    small_batches,
    staged,
    text_blocks,
    tidy,
    without_rows,
)

CUTTER = Cutter(reach=512, largest=16384)
Digest = Callable[[bytes], bytes]


def exact_dedup(
    docs: DataFrame, spark: SparkSession, cutter: Cutter = CUTTER, digest: Digest = xxhash.xxh3_128_digest
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    A null text is an empty one; all empty texts are equal. A text of any length is handled
    whole, its recipe is a hundredth of it or less. Of equal texts the smallest doc_id stays,
    null ids come last; where rows repeat an id, exactly one of them stays. An empty table
    gives no rows. Other columns are not looked at.
    """
    small_batches(spark)
    rows = documents(docs).withColumn("row", F.monotonically_increasing_id())
    clashes = chunk_clashes(rows, spark, cutter, digest)
    plain = rows.mapInArrow(
        lambda batches: recipes(batches, cutter, digest),
        "row long, doc_id long, recipe binary, n_chunks int, text_sha256 string",
    )
    if not clashes.isEmpty():
        plain = resolved(rows, plain, clashes, cutter, digest)
    plain = staged(plain, "recipes", spark)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = plain.groupBy("recipe").agg(F.count("*").alias("group_size"), first.alias("first"))
    groups = staged(
        groups.where("group_size > 1").select("recipe", "group_size", "first.doc_id", "first.row").toDF(
            "recipe", "group_size", "first_id", "first_row"
        ),
        "copies",
        spark,
    )
    alone = F.col("first_row").isNull()
    return plain.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("first_row"))).alias("kept"),
        "text_sha256",
        "n_chunks",
    )


def without_copies(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Joined by id and by the text's digest; where rows repeat both, one of them stays.
    """
    spaced = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE_RE, " ")
    marked = docs.withColumn("_llm_sha", F.sha2(spaced, 256))
    stay = decisions.where("kept").select(
        F.col("doc_id").alias("_llm_id"), F.col("text_sha256").alias("_llm_own"), F.lit(True).alias("_llm_stays")
    )
    found = marked.join(stay, F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_sha") == F.col("_llm_own")))
    return found.dropDuplicates(["_llm_id", "_llm_own"]).select(*docs.columns)


def chunk_clashes(rows: DataFrame, spark: SparkSession, cutter: Cutter, digest: Digest) -> DataFrame:
    """Digests that different chunks share, with the chunks; the check of all identifiers.

    Columns digest, content, variant. Every distinct chunk of the corpus is moved once to be
    compared; chunks under a shared digest are moved a second time to be numbered.
    """
    pieces = rows.select("text").mapInArrow(
        lambda batches: distinct_chunks(batches, cutter, digest), "digest binary, content binary"
    )
    known = pieces.groupBy("digest", "content").agg(F.lit(1).alias("one"))
    shared = known.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    shared = staged(shared, "shared-digests", spark)
    if shared.isEmpty():
        return without_rows("digest binary, content binary, variant int", spark)
    numbered = F.row_number().over(Window.partitionBy("digest").orderBy("content")) - 1
    return staged(known.join(shared, "digest").select("digest", "content", numbered.alias("variant")), "clashes", spark)


def resolved(rows: DataFrame, plain: DataFrame, clashes: DataFrame, cutter: Cutter, digest: Digest) -> DataFrame:
    """Recipes with the variant number behind each digest."""
    pieces = rows.select("row", "text").mapInArrow(
        lambda batches: placed_chunks(batches, cutter, digest), "row long, place int, digest binary, content binary"
    )
    numbered = pieces.join(clashes, ["digest", "content"], "left").select(
        "row", "place", F.concat(F.hex("digest"), F.lpad(F.hex(F.coalesce("variant", F.lit(0))), 8, "0")).alias("known_as")
    )
    lists = numbered.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "known_as"))).alias("parts"))
    # Digests have one length, so the joined list is unambiguous.
    whole = F.unhex(F.array_join(F.transform("parts", lambda p: p["known_as"]), ""))
    lists = lists.select("row", whole.alias("list"))
    return plain.join(lists, "row", "left").select(
        "row", "doc_id", F.coalesce("list", F.lit(b"")).alias("recipe"), "n_chunks", "text_sha256"
    )


def normalised(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space as one space."""
    space = IS_SPACE[data]
    again = np.zeros(len(data), bool)
    again[1:] = space[1:] & space[:-1]
    begins = starts[:-1][starts[:-1] < len(data)]
    again[begins] = False
    out = np.where(space, np.uint8(32), data)[~again]
    kept = np.concatenate([[0], np.cumsum(~again)])
    return out, kept[starts]


def chunked(column, cutter: Cutter):
    """For each run of texts: its rows, normalised bytes, starts of texts, chunks, chunks a text."""
    for first, past, data, starts in text_blocks(column, FINE_BYTES):
        data, starts = normalised(data, starts)
        begins, counts = cutter.cuts(data, starts)
        yield first, past, memoryview(np.ascontiguousarray(data)), starts, np.append(begins, len(data)), counts


@tidy
def recipes(batches, cutter: Cutter, digest: Digest):
    for batch in batches:
        lists, shas, numbers = [], [], []
        for _, _, raw, starts, begins, counts in chunked(batch.column("text"), cutter):
            parts = [digest(raw[a:b]) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
            ends = np.cumsum(counts).tolist()
            lists += [b"".join(parts[e - c : e]) for e, c in zip(ends, counts.tolist())]
            shas += [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            numbers.append(counts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(lists, pa.binary()),
                pa.array(np.concatenate(numbers) if numbers else [], pa.int32()),
                pa.array(shas, pa.string()),
            ],
            names=["row", "doc_id", "recipe", "n_chunks", "text_sha256"],
        )


@tidy
def distinct_chunks(batches, cutter: Cutter, digest: Digest):
    for batch in batches:
        for _, _, raw, _, begins, _ in chunked(batch.column("text"), cutter):
            own = {bytes(raw[a:b]) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())}
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(x) for x in own], pa.binary()), pa.array(list(own), pa.binary())],
                names=["digest", "content"],
            )


@tidy
def placed_chunks(batches, cutter: Cutter, digest: Digest):
    for batch in batches:
        for first, past, raw, _, begins, counts in chunked(batch.column("text"), cutter):
            parts = [bytes(raw[a:b]) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
            row = np.repeat(np.asarray(batch.column("row"))[first:past], counts)
            place = np.arange(len(parts)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row, pa.int64()),
                    pa.array(place, pa.int32()),
                    pa.array([digest(x) for x in parts], pa.binary()),
                    pa.array(parts, pa.binary()),
                ],
                names=["row", "place", "digest", "content"],
            )
