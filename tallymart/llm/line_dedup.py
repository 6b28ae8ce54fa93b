"""Line dedup: range-partitioned line digests, streamed in order; keep bitmaps instead of text.

Every line that is long enough becomes a 128-bit digest with its document and position. The
digests are range-partitioned and sorted by digest, then document (largest first), then position,
so that in each partition the first place of a line is in the document that keeps it and all
others follow. Ranges are cut by the whole order and not by the digest alone: a line that stands
in a third of all documents fills several partitions. Only lines at the edges of partitions need
the others' counts, at most two lines a partition. What is returned are the positions that go, as
a compressed bitmap for each document; texts are read again where they are wanted.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tallymart.llm.common import SPACES, documents, staged

#: A line counts from so many code points (stripped), and goes if so many documents hold it.
LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
STRIP = SPACES.encode()

PLACE = ["doc_id", "name_a", "name_b", "position"]


def line_dedup(
    docs: DataFrame, spark: SparkSession, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """Documents that lose lines: doc_id, name_a, name_b, n_dropped, keep.

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of
    ``least_chars`` code points or more that ``least_documents`` documents hold lose all lines
    but those of the largest doc_id. ``keep`` is a zlib-compressed bitmap, one bit a line in
    order, up to the last line that goes and to a whole byte; lines behind it stay.

    Every row is a document of its own. Rows that share the largest id all keep the line, and a
    null id is the smallest: it keeps a line only if no other row holds it. Rows that repeat id
    and text have one entry. A document is named by its id and 128 bits of its text, a line by a
    128-bit digest. Null and empty texts are one empty line, which never goes. An empty table
    gives no rows. Texts are taken whole; other columns may have any names.
    """
    lines = named(docs).mapInArrow(
        lambda batches: line_rows(batches, least_chars),
        "high long, low long, doc_id long, name_a long, name_b long, position int, first boolean",
    )
    lines = staged(lines, "lines", spark)
    order = ["high", "low", F.col("doc_id").desc_nulls_last(), "name_a", "name_b", "position"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    streamed = in_order.mapInArrow(
        lambda batches: in_ranges(batches, least_documents),
        "high long, low long, doc_id long, name_a long, name_b long, position int, first boolean, settled boolean",
    )
    streamed = staged(streamed, "streamed-lines", spark)
    edges = streamed.where("not settled")
    whole = edges.groupBy("high", "low").agg(
        F.count_if("first").alias("documents"), F.max("doc_id").alias("keeper")
    )
    whole = staged(whole.where(F.col("documents") >= least_documents), "edge-lines", spark)
    later = edges.join(whole, ["high", "low"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = streamed.where("settled").select(*PLACE).union(later.select(*PLACE))
    marks = gone.groupBy(*PLACE[:3]).agg(F.collect_set("position").alias("positions"))
    return marks.select(
        *PLACE[:3], F.size("positions").cast("long").alias("n_dropped"), bitmap("positions").alias("keep")
    )


def named(docs: DataFrame) -> DataFrame:
    rows = documents(docs)
    return rows.select("doc_id", F.xxhash64("text").alias("name_a"), F.xxhash64(F.lit(13), "text").alias("name_b"), "text")


def kept_texts(docs: DataFrame, found: DataFrame, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256, kept_text.

    The lines that stay, joined by line feeds; ``kept_text`` is null where not asked for.
    """
    marks = found.select(F.col("doc_id").alias("_id"), F.col("name_a").alias("_a"), F.col("name_b").alias("_b"), "keep")
    rows = named(docs)
    same = (rows.doc_id.eqNullSafe(F.col("_id"))) & (rows.name_a == F.col("_a")) & (rows.name_b == F.col("_b"))
    met = rows.join(marks, same, "left").select("doc_id", "text", "keep")
    return met.mapInArrow(
        lambda batches: without_lines(batches, keep_text),
        "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text binary",
    )


@F.arrow_udf(BinaryType())
def bitmap(positions: pa.Array) -> pa.Array:
    out = []
    for own in positions:
        gone = own.values.to_numpy()
        keep = np.ones((int(gone.max()) // 8 + 1) * 8, bool)
        keep[gone] = False
        out.append(zlib.compress(np.packbits(keep).tobytes(), 1))
    return pa.array(out, pa.binary())


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """What lines are compared by; None where the line is too short."""
    line = line.strip(STRIP)
    if len(line) < least_chars or len(line) < 4 * least_chars and len(line.decode()) < least_chars:
        return None
    return line.lower()  # bytes: A-Z alone


def raw_texts(column) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def line_rows(batches, least_chars: int):
    """Digest and position of each line that counts; ``first`` where the document has it first."""
    names = ["high", "low", "doc_id", "name_a", "name_b", "position", "first"]
    for batch in batches:
        digests, places, positions, first = [], [], [], []
        for row, text in enumerate(raw_texts(batch.column("text"))):
            seen = set()
            for position, line in enumerate(text.split(b"\n")):
                key = line_key(line, least_chars)
                if key is not None:
                    digest = xxhash.xxh3_128_digest(key)
                    first.append(digest not in seen)
                    seen.add(digest)
                    digests.append(digest)
                    places.append(row)
                    positions.append(position)
        pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        at = pa.array(places, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.ascontiguousarray(pair[:, 0])),
                pa.array(np.ascontiguousarray(pair[:, 1])),
                *[batch.column(c).take(at) for c in ("doc_id", "name_a", "name_b")],
                pa.array(positions, pa.int32()),
                pa.array(first, pa.bool_()),
            ],
            names=names,
        )


def in_ranges(batches, least_documents: int):
    """Places that go, from one range in order.

    A run of equal digests inside the range is settled: its first row names the keeper. The first
    and the last run may go on in other ranges; their rows pass unsettled.
    """
    opening, held, digest = True, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low = (batch.column(c).to_numpy() for c in ("high", "low"))
        cuts = np.flatnonzero((np.diff(high) != 0) | (np.diff(low) != 0)) + 1
        if digest is not None and (high[0], low[0]) != digest:
            if held:
                yield settled(held, least_documents)
            opening, held = False, []
        digest = (high[-1], low[-1])
        head = batch.slice(0, cuts[0]) if len(cuts) else batch
        if opening:  # streams through, however long the run is
            yield passed(head)
        else:
            held.append(head)
        if len(cuts):
            if held:
                yield settled(held, least_documents)
            if len(cuts) > 1:
                yield settled([batch.slice(cuts[0], cuts[-1] - cuts[0])], least_documents)
            opening, held = False, [batch.slice(cuts[-1])]
    for batch in held:
        yield passed(batch)


def passed(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.append_column("settled", pa.array(np.zeros(batch.num_rows, bool)))


def settled(run: list, least_documents: int) -> pa.RecordBatch:
    """Rows of whole runs that go: enough documents, and not the id of the run's first row."""
    batch = pa.concat_batches(run)
    high, low, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("high", "low", "first"))
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(high) != 0) | (np.diff(low) != 0)]))
    counts = np.diff(np.append(begins, len(high)))
    held_by = np.add.reduceat(first.astype(np.int64), begins)
    none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
    ids = batch.column("doc_id").fill_null(0).to_numpy()
    top = np.repeat(begins, counts)
    gone = (np.repeat(held_by, counts) >= least_documents) & ((ids != ids[top]) | (none != none[top]))
    out = batch.filter(pa.array(gone))
    return out.append_column("settled", pa.array(np.ones(out.num_rows, bool)))


def without_lines(batches, keep_text: bool):
    for batch in batches:
        lines, dropped, digests, kept = [], [], [], []
        for text, keep in zip(raw_texts(batch.column("text")), batch.column("keep").to_pylist()):
            if keep is None:
                lines.append(text.count(b"\n") + 1)
                dropped.append(0)
            else:
                own = text.split(b"\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
                gone = set(np.flatnonzero(bits == 0).tolist())
                lines.append(len(own))
                text = b"\n".join([x for k, x in enumerate(own) if k not in gone])
                dropped.append(len(gone))
            digests.append(hashlib.sha256(text).hexdigest())
            kept.append(text if keep_text else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"],
        )
