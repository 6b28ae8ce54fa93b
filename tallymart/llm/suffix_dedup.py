"""Removal of repeated byte strings by bucket-pointer refinement of text positions.

Positions are put into buckets by the q-gram that begins there, and buckets are refined by what
stands at further offsets, until a bucket is decided: a bucket of one position drops out at once.

- Only anchor positions are sorted: those whose q-gram has the least hash in some stretch of the
  text. Any string of the wanted length holds such a stretch, and equal strings hold the same
  anchor at the same offset, so no repeated string is missed.
- A bucket with one anchor is done. The others are refined by the bucket of everything that a
  wanted string through the anchor could hold. Where this is equal, all strings through the
  later anchor are repeats.
- Where it differs, the bucket is refined to either side: by the q-gram and what stands half a
  string's rest before it, or behind it. Any string through the anchor holds one of the two.
- Where such a half is shared, anchors that share it meet, and each string over it is looked at:
  its bucket is made from the buckets of shorter strings at two offsets, doubled again and again,
  and used for every offset. A half that very many share is dealt out; strings that are first in
  their part are then compared over all parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import FINE_BYTES, Powers, documents, mixed, sifted, small_batches, staged, text_blocks

POWERS = Powers()
LENGTH, GRAM = 100, 32
#: Anchors of one half that meet in one part.
MEETING = 4096
#: Rows of a meeting whose buckets are made at a time.
GRID_ROWS = 1024
STEP = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << 31) - 1)  # places in a run of texts
TERMS = mixed(np.arange(3, 259, dtype=np.uint64))  # what a byte adds to a polynomial


def buckets(data: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """The bucket of the string of ``length`` bytes at each position where it fits.

    Made from buckets of 1, 2, 4, ... bytes: that of a string is set by the buckets of its two halves.
    """
    own, width = mixed((data.astype(np.uint64) + np.uint64(seed)) * STEP), 1
    while width * 2 <= length:
        own = joined(own, width, width, seed)
        width *= 2
    if width < length:  # two overlapping strings cover it
        own = joined(own, length - width, width, seed + 7)
    return own


def joined(own: np.ndarray, offset: int, width: int, seed: int) -> np.ndarray:
    if len(own) <= offset:
        return own[:0]
    out = own[offset:] ^ np.uint64(width * 0x1B873593 + seed)
    out *= STEP
    out += own[:-offset] * np.uint64(2 * seed + 1)
    return mixed(out)


def beside(own: np.ndarray, begin: np.ndarray, gram: int, more: int) -> np.ndarray:
    """The bucket of the ``gram + more`` bytes at each ``begin``, from the buckets of q-grams that cover them."""
    steps = -(-more // gram)
    value = own[begin]
    for k in range(1, steps + 1):
        value = mixed(value * np.uint64(2 * k + 1) + (own[begin + more * k // steps] ^ np.uint64(k * 0x1B873593)) * STEP)
    return value


def anchors(own: np.ndarray, starts: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Anchor positions, ascending, from the q-gram buckets; stretches do not cross texts."""
    span = length - gram + 1
    if len(own) < span:
        return np.zeros(0, np.int64)
    least = own & ~LOW  # its high bits; of equal ones the last
    least |= np.arange(int(LOW), int(LOW) - len(own), -1, dtype=np.int64).view(np.uint64)
    width = 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: -(span - width)], least[span - width :])
    place = (LOW - (least & LOW)).astype(np.int64)
    ends = np.repeat(starts[1:], np.diff(starts))[: len(place)]
    place = place[np.arange(length, length + len(place)) <= ends]
    place = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
    return np.unique(place)


def running_sums(data: np.ndarray) -> np.ndarray:
    """Polynomials of all beginnings of the bytes, modulo 2**64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = TERMS[data]
    terms *= POWERS.first(len(data) + 1)[0][:-1]
    np.cumsum(terms, out=sums[1:])
    return sums


def gram_buckets(data: np.ndarray, sums: np.ndarray, gram: int) -> np.ndarray:
    """The bucket of the q-gram at each position where it fits.

    Polynomials modulo 2**64 are told apart by some twenty bits less for 32 bytes of a two-letter
    pattern, and not at all for a thousand; long q-grams are therefore made from halves.
    """
    if gram > 4 * GRAM:
        return buckets(data, gram)
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    own = sums[gram:] - sums[: len(data) + 1 - gram]
    own *= POWERS.first(len(data) + 1)[1][: len(own)]
    return mixed(own)


def surroundings(sums: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The bucket of all bytes that a string of ``length`` through the anchor could hold."""
    before, after = length - gram, length
    doc = np.searchsorted(starts, place, side="right") - 1
    low, high = np.maximum(place - before, starts[doc]), np.minimum(place + after, starts[doc + 1])
    _, down = POWERS.first(len(sums))
    shape = (place - low).astype(np.uint64) << np.uint64(32) | (high - place).astype(np.uint64)
    return mixed((sums[high] - sums[low]) * down[low] ^ mixed(shape * STEP))


def remove_repeats(
    docs: DataFrame, spark: SparkSession, length: int = LENGTH, gram: int = GRAM, keep_text: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, spans.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes over it also starts
    earlier: in a text with a smaller doc_id, or earlier in its own. Null texts are empty, and a
    text shorter than ``length`` loses nothing. A null id is larger than all others. Different
    texts under one id are ordered by a 64-bit hash; rows that repeat id and text are one text and get
    one result. ``kept_text`` is what stays, as bytes (null where not asked for); ``spans`` are
    the removed runs, begin and end. Long texts are taken whole. An empty table gives no rows.
    Strings are compared by 64-bit buckets of the q-gram and 64 bits more of what stands around
    it, single strings by 128 bits.
    """
    small_batches(spark)
    last = F.lit((1 << 63) - 1)
    rows = documents(docs).select(
        "doc_id", F.coalesce("doc_id", last).alias("id"), F.xxhash64("text").alias("hash"), "text"
    )
    key = ["id", "hash"]
    found = rows.select("text").mapInArrow(lambda b: anchor_buckets(b, length, gram), "bucket long, n long")
    many = found.groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 1").select("bucket")
    many = staged(many, "repeated-buckets", spark)

    placed = rows.select(*key, "text").mapInArrow(
        lambda b: anchor_rows(b, length, gram),
        "bucket long, around long, left long, right long, id long, hash long, place int, own boolean",
    )
    placed = staged(sifted(placed, many, ["bucket"]).join(many, "bucket"), "anchors", spark)
    classes = placed.where("own").groupBy("bucket", "around").agg(
        F.min(F.struct(*key, "place")).alias("first"),
        F.count("*").alias("n"),
        F.first("left").alias("left"),
        F.first("right").alias("right"),
    )
    classes = staged(classes, "classes", spark)
    # Later anchors with equal surroundings: every string through them is a repeat.
    shared = classes.where("n > 1").select("bucket", "around", F.col("first.id").alias("f_id"), F.col("first.hash").alias("f_hash"))
    whole = placed.where("own").join(shared, ["bucket", "around"]).where("id <> f_id or hash <> f_hash")
    whole = whole.select(*key, "place").union(placed.where("not own").select(*key, "place"))
    # First ones of classes that share a half: each string over that half is looked at.
    halves = F.array(
        F.struct(F.lit(True).alias("before"), F.col("left").alias("half")),
        F.struct(F.lit(False).alias("before"), F.col("right").alias("half")),
    )
    halves = classes.select("first", F.inline(halves)).where("half is not null")
    twice = halves.groupBy("before", "half").agg(F.count("*").alias("classes")).where("classes > 1")
    twice = staged(twice.withColumn("parts", F.ceil(F.col("classes") / MEETING).cast("int")).drop("classes"), "repeated-halves", spark)
    firsts = halves.join(twice, ["before", "half"]).groupBy(
        F.col("first.id").alias("id"), F.col("first.hash").alias("hash")
    )
    firsts = firsts.agg(F.collect_list(F.struct("first.place", "before", "half", "parts")).alias("open"))
    firsts = staged(firsts, "open-anchors", spark)
    looked = sifted(rows.select(*key, "text"), firsts, key).join(firsts, key).dropDuplicates(key)
    looked = looked.mapInArrow(
        lambda b: context_rows(b, length, gram),
        "half long, before boolean, part int, parts int, id long, hash long, place int, lead int, bytes binary",
    )
    meeting = ["half", "before", "part"]
    strings = looked.repartition(*meeting).sortWithinPartitions(*meeting, "id", "hash", "place").mapInArrow(
        lambda b: string_rows(b, length, gram), "high long, low long, id long, hash long, begin int"
    )
    strings = staged(strings, "strings", spark)
    some = strings.where("high is not null")
    earliest = some.groupBy("high", "low").agg(F.min(F.struct(*key, "begin")).alias("first"), F.count("*").alias("n"))
    earliest = staged(earliest.where("n > 1").drop("n"), "repeated-strings", spark)
    later = some.join(earliest, ["high", "low"]).where("struct(id, hash, begin) <> first").select(*key, "begin")
    later = later.union(strings.where("high is null").select(*key, "begin"))
    marks = whole.select(*key, "place", F.lit(None).cast("int").alias("begin")).union(
        later.select(*key, F.lit(None).cast("int").alias("place"), "begin")
    )
    marks = marks.groupBy(*key).agg(F.collect_list("place").alias("places"), F.collect_list("begin").alias("begins"))
    marks = staged(marks, "marks", spark)

    result = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary, "
        "spans array<struct<begin:long,end:long>>"
    )
    nothing = F.array().cast("array<int>")
    touched = sifted(rows, marks, key).join(marks, key, "left")
    touched = touched.select(
        "doc_id", "text", F.coalesce("places", nothing).alias("places"), F.coalesce("begins", nothing).alias("begins")
    )
    untouched = sifted(rows, marks, key, hit=False).select(
        "doc_id", "text", nothing.alias("places"), nothing.alias("begins")
    )
    cut_one = lambda b: cut(b, length, gram, keep_text)
    return untouched.mapInArrow(cut_one, result).union(touched.mapInArrow(cut_one, result))


def anchor_buckets(batches, length: int, gram: int):
    for batch in batches:
        for _, _, data, starts in text_blocks(batch.column("text"), FINE_BYTES):
            own = gram_buckets(data, running_sums(data), gram)
            distinct, counts = np.unique(own[anchors(own, starts, length, gram)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(counts)], names=["bucket", "n"])


def anchor_rows(batches, length: int, gram: int):
    """Anchors; ``own`` is false where the same text has the same surroundings earlier."""
    half = (length - gram) // 2
    for batch in batches:
        for first, past, data, starts in text_blocks(batch.column("text"), FINE_BYTES):
            sums = running_sums(data)
            grams = gram_buckets(data, sums, gram)
            place = anchors(grams, starts, length, gram)
            own = grams[place]
            around = surroundings(sums, starts, place, length, gram)
            of = np.searchsorted(starts, place, side="right") - 1
            keys = np.lexsort((place, around, of))
            again = np.zeros(len(place), bool)
            if len(keys):
                a, b = keys[:-1], keys[1:]
                again[b] = (around[a] == around[b]) & (of[a] == of[b]) & (own[a] == own[b])
            sides = []
            for begin in (place - half, place):
                outside = (begin < starts[of]) | (begin + gram + half > starts[of + 1])
                value = np.zeros(len(place), np.uint64)
                value[~outside] = beside(grams, begin[~outside], gram, half)
                sides.append(pa.array(value.view(np.int64), mask=outside))
            rows = pa.array(of + first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own.view(np.int64)),
                    pa.array(around.view(np.int64)),
                    *sides,
                    batch.column("id").take(rows),
                    batch.column("hash").take(rows),
                    pa.array(place - starts[of], pa.int32()),
                    pa.array(~again),
                ],
                names=["bucket", "around", "left", "right", "id", "hash", "place", "own"],
            )


def context_rows(batches, length: int, gram: int):
    """Open anchors with all bytes that a string through them could hold; ``lead`` of them stand before."""
    rest = length - gram
    for batch in batches:
        for first, past, data, starts in text_blocks(batch.column("text")):
            out: list[tuple] = []
            for k in range(past - first):
                raw = data[starts[k] : starts[k + 1]].tobytes()
                doc_id, salt = batch.column("id")[first + k].as_py(), batch.column("hash")[first + k].as_py()
                for x in batch.column("open")[first + k].as_py():
                    place = x["place"]
                    low = max(0, place - rest)
                    part = (doc_id * 31 + place) % x["parts"]
                    out.append((x["half"], x["before"], part, x["parts"], doc_id, salt, place, place - low, raw[low : place + length]))
            kinds = [pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            names = ["half", "before", "part", "parts", "id", "hash", "place", "lead", "bytes"]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def string_rows(batches, length: int, gram: int):
    """Strings over shared halves that came earlier in their meeting (no buckets: decided), and,
    of meetings in several parts, those that came first, by their buckets."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(c).to_numpy(zero_copy_only=False) for c in ("half", "before", "part")]
        fresh = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if len(fresh):  # whole meetings; the last may go on in the next batch
            last = int(fresh[-1])
            yield met(table.slice(0, last), length, gram)
            held = table.slice(last).to_batches()
    if held:
        yield met(pa.Table.from_batches(held), length, gram)


def met(table: pa.Table, length: int, gram: int) -> pa.RecordBatch:
    rest, width = length - gram, 2 * length - gram
    names = ("lead", "before", "half", "place", "part")
    lead, before, half, place, part = (table.column(c).to_numpy(zero_copy_only=False) for c in names)
    meeting = np.zeros(len(lead), np.int64)  # rows are sorted by these three, then in order of the texts
    meeting[1:] = np.cumsum((half[1:] != half[:-1]) | (before[1:] != before[:-1]) | (part[1:] != part[:-1]))
    several = table.column("parts").to_numpy() > 1
    grid = np.zeros((len(lead), width), np.uint8)
    sizes = np.zeros(len(lead), np.int64)
    for k, raw in enumerate(table.column("bytes").to_pylist()):  # the anchor stands at ``rest``
        grid[k, rest - lead[k] : rest - lead[k] + len(raw)] = np.frombuffer(raw, np.uint8)
        sizes[k] = len(raw)
    one, two = np.zeros(grid.shape, np.uint64), np.zeros(grid.shape, np.uint64)
    for a in range(0, len(lead), GRID_ROWS):
        flat = grid[a : a + GRID_ROWS].ravel()
        for seed, to in ((11, one), (12, two)):
            to[a : a + GRID_ROWS].reshape(-1)[: len(flat) - length + 1] = buckets(flat, length, seed)
    out: list[tuple] = []
    for at in range(rest + 1):  # where the string begins in the grid
        fits = np.where(before, at <= rest - rest // 2, at >= rest // 2)
        rows = np.flatnonzero(fits & (at >= rest - lead) & (at + length <= rest - lead + sizes))
        if not len(rows):
            continue
        high, low = one[rows, at], two[rows, at]
        order = np.lexsort((rows, meeting[rows], low, high))
        same = np.zeros(len(rows), bool)
        a, b = order[:-1], order[1:]
        same[b] = (high[a] == high[b]) & (low[a] == low[b]) & (meeting[rows[a]] == meeting[rows[b]])
        begin = place[rows] - rest + at
        out.append((rows[same], begin[same], high[same], low[same], np.zeros(int(same.sum()), bool)))
        left = ~same & several[rows]
        out.append((rows[left], begin[left], high[left], low[left], np.ones(int(left.sum()), bool)))
    rows, begin, high, low, told = (np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64) for k in range(5))
    told, at = told.astype(bool), pa.array(rows.astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(high.astype(np.uint64).view(np.int64), mask=~told),
            pa.array(low.astype(np.uint64).view(np.int64), mask=~told),
            table.column("id").combine_chunks().take(at),
            table.column("hash").combine_chunks().take(at),
            pa.array(begin, pa.int32()),
        ],
        names=["high", "low", "id", "hash", "begin"],
    )


def covered(begins: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Numbers from 0 to ``size`` that lie in one of the ranges."""
    if size <= 0:
        return np.zeros(0, np.int64)
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, np.clip(begins, 0, size), 1)
    np.add.at(steps, np.clip(ends, 0, size), -1)
    return np.flatnonzero(np.cumsum(steps[:-1]) > 0)


def cut(batches, length: int, gram: int, keep_text: bool):
    for batch in batches:
        texts = batch.column("text")
        out: list[tuple] = []
        for first, past, data, starts in text_blocks(texts):
            for k in range(past - first):
                raw = data[starts[k] : starts[k + 1]]
                repeats = []
                places = batch.column("places")[first + k].values
                begins = batch.column("begins")[first + k].values
                if places is not None and len(places):
                    at = places.to_numpy()
                    repeats.append(covered(at - (length - gram), at + 1, len(raw) - length + 1))
                if begins is not None and len(begins):
                    repeats.append(begins.to_numpy().astype(np.int64))
                at = np.concatenate(repeats) if repeats else np.zeros(0, np.int64)
                goes = np.zeros(len(raw) + 1, bool)
                goes[covered(at, at + length, len(raw))] = True
                edges = np.flatnonzero(np.diff(goes.view(np.int8), prepend=np.int8(0)))
                spans = edges.reshape(-1, 2)
                kept = raw[~goes[:-1]].tobytes()
                pairs = [{"begin": int(a), "end": int(b)} for a, b in spans]
                out.append((len(raw), int(goes.sum()), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_text else None, pairs))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        kinds.append(pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
        columns = zip(*out) if out else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans"],
        )
