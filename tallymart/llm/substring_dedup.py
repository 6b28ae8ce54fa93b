"""Substring dedup by content-defined chunks.

A gear rolling hash cuts texts into chunks of a few words; a cut depends only on the bytes near
it, so an insertion moves no cut beyond its neighbourhood. Chunks are told apart by 128-bit
digests. Where a run of neighbouring chunks has been seen before, chunk by chunk, and the run is
long enough not to be chance, the run is removed; the first place of each chunk stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.chunking import Cutter
from tallymart.llm.common import documents, staged, text_blocks

CUTTER = Cutter(reach=24, largest=128)
#: Bytes that a run of repeated chunks needs to be removed.
LEAST_RUN = 100


def remove_repeated_chunks(
    docs: DataFrame,
    spark: SparkSession,
    cutter: Cutter = CUTTER,
    least_run: int = LEAST_RUN,
    keep_text: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_chunks, n_removed, n_spans, spans, kept_text.

    A chunk is a repeat if it begins earlier too: in a text with a smaller doc_id, or earlier in
    its own; null ids come last. Different texts under one id are ordered by a 64-bit hash; rows that
    repeat id and text are one text and get one result. Neighbouring repeats make a run, and
    runs of at least ``least_run`` bytes are removed; ``spans`` are those runs, begin and end in
    UTF-8 bytes, ``kept_text`` is the rest, as bytes (null where not asked for). A null or empty
    text has no chunks. Texts of any length are cut whole. An empty table gives no rows.
    """
    last = F.lit((1 << 63) - 1)
    rows = documents(docs).select(
        "doc_id", F.coalesce("doc_id", last).alias("id"), F.xxhash64("text").alias("hash"), "text"
    )
    key = ["id", "hash"]
    chunks = rows.select(*key, "text").mapInArrow(
        lambda b: chunk_rows(b, cutter), "high long, low long, id long, hash long, number int, again boolean"
    )
    seen = chunks.where("not again").groupBy("high", "low").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.min("hash").alias("a"), F.max("hash").alias("b"))
    seen = seen.where("first_id <> last_id or a <> b").select("high", "low", "first_id")
    seen = staged(seen, "repeated-chunks", spark)
    own = chunks.where("again").select(*key, "number")
    found = staged(chunks.where("not again").join(seen, ["high", "low"]), "chunk-places", spark)
    # Under the first id, several texts: the one with the least hash is first.
    rival = found.where("id = first_id").groupBy("high", "low").agg(F.min("hash").alias("first_hash"))
    rival = staged(rival, "first-places", spark)
    later = found.join(rival, ["high", "low"]).where("id <> first_id or hash <> first_hash").select(*key, "number")
    marks = later.union(own).groupBy(*key).agg(F.collect_set("number").alias("numbers"))
    marks = staged(marks, "chunk-marks", spark)
    cut = rows.join(marks, key, "left").select(
        "doc_id", "text", F.coalesce("numbers", F.array().cast("array<int>")).alias("numbers")
    )
    return cut.mapInArrow(
        lambda b: without_runs(b, cutter, least_run, keep_text),
        "doc_id long, n_bytes long, n_chunks long, n_removed long, n_spans long, "
        "spans array<struct<begin:long,end:long>>, kept_sha256 string, kept_text binary",
    )


def chunk_rows(batches, cutter: Cutter):
    """Each chunk by digest; ``again`` where the same text has it earlier."""
    for batch in batches:
        for first, _, data, starts in text_blocks(batch.column("text")):
            begins, counts = cutter.cuts(data, starts)
            raw, ends = memoryview(np.ascontiguousarray(data)), np.append(begins[1:], len(data))
            digests = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(begins.tolist(), ends.tolist())])
            pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
            of = np.repeat(np.arange(len(counts)), counts)
            number = np.arange(len(begins)) - np.repeat(np.cumsum(counts) - counts, counts)
            order = np.lexsort((number, pair[:, 1], pair[:, 0], of))
            again = np.zeros(len(begins), bool)
            a, b = order[:-1], order[1:]
            again[b] = (pair[a] == pair[b]).all(axis=1) & (of[a] == of[b])
            places = pa.array(of + first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pair[:, 0]),
                    pa.array(pair[:, 1]),
                    batch.column("id").take(places),
                    batch.column("hash").take(places),
                    pa.array(number, pa.int32()),
                    pa.array(again),
                ],
                names=["high", "low", "id", "hash", "number", "again"],
            )


def without_runs(batches, cutter: Cutter, least_run: int, keep_text: bool):
    for batch in batches:
        out: list[tuple] = []
        for first, past, data, starts in text_blocks(batch.column("text")):
            begins, counts = cutter.cuts(data, starts)
            ends, at = np.append(begins[1:], len(data)), 0
            for k in range(past - first):
                a, b = begins[at : at + counts[k]] - starts[k], ends[at : at + counts[k]] - starts[k]
                at += counts[k]
                raw = data[starts[k] : starts[k + 1]]
                numbers = batch.column("numbers")[first + k].values
                gone = np.zeros(len(a) + 1, bool)
                if numbers is not None and len(numbers):
                    gone[numbers.to_numpy()] = True
                edges = np.flatnonzero(np.diff(gone.view(np.int8), prepend=np.int8(0))).reshape(-1, 2)
                spans = [(int(a[x]), int(b[y - 1])) for x, y in edges.tolist()]
                spans = [(x, y) for x, y in spans if y - x >= least_run]
                keep = np.ones(len(raw), bool)
                for x, y in spans:
                    keep[x:y] = False
                kept = raw[keep].tobytes()
                out.append(
                    (
                        len(raw),
                        len(a),
                        len(raw) - len(kept),
                        len(spans),
                        [{"begin": x, "end": y} for x, y in spans],
                        hashlib.sha256(kept).hexdigest(),
                        kept if keep_text else None,
                    )
                )
        kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary()]
        columns = zip(*out) if out else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
            names=["doc_id", "n_bytes", "n_chunks", "n_removed", "n_spans", "spans", "kept_sha256", "kept_text"],
        )
