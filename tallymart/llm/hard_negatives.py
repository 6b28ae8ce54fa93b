"""Hard negatives by threshold joins over an inverted index with norm bounds.

Anchors meet the rows in blocks. In each block, rows are ordered by how many leading dimensions
their norm bound covers: as long as the norm of a row's first dimensions, times the anchor's
norm, stays below the threshold, these dimensions alone cannot reach it and are left out of the
index. Postings of the others are read from the last dimension to the first, partial scores are
accumulated, and a pair is dropped as soon as its partial score and the product of the remaining
norms fall short. Survivors are completed exactly. The threshold of an anchor starts high and is
lowered until its windows are full or nothing below can enter them; what a window holds already
is the next block's threshold.

Two joins follow each other: positives of each anchor first, then negatives within the windows
that the positives' scores set. The rows are dealt into groups; a group's anchors are kept, its
rows stream past, and each group returns at most its best per window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.common import narrow, staged

POSITIVES, NEGATIVES = 5, 10
#: Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Anchors that a group holds in memory (on average), rows that a group streams.
ANCHORS, GROUP_ROWS = 1 << 14, 1 << 18
#: Pairs of anchor and row that are scored at a time.
PAIRS = 1 << 21
#: Dimensions read at a time, and how far a threshold falls at first; then faster.
TILE, FALL = 8, 0.7
#: Share of the pairs that may be left when they are completed one by one.
SPARSE = 0.1
#: Largest size of a component after scaling; larger ones count as this.
LARGEST = 1 << 27
NEVER = np.iinfo(np.int64).min


def hard_negatives(
    vectors: DataFrame,
    spark: SparkSession,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label. Rows with a null label or vector, or with a null
    or non-finite component, take no part. Components are floor(256 * x), at most 2**27 in size; a
    shorter vector counts as filled up with zeros, an empty one scores 0 with all. Scores are
    64-bit integers. Equal scores come by smaller vec_id, null ids last. Every row is one of its own: rows that repeat an id are anchors,
    positives and negatives side by side; a null id is no anchor. An anchor without other rows
    of its label, or a window without rows, gives no rows. A positive's score below zero sets an
    empty window. An empty table gives no rows; other columns may have any names.
    """
    rows = staged(whole_vectors(vectors), "vectors", spark)
    anchors = rows.where(F.col("vec_id") % every == 0)
    count, longest = rows.agg(F.count("*"), F.coalesce(F.max(F.length("vec")), F.lit(0))).first()
    chunks = -(-anchors.count() // ANCHORS)
    if not chunks:
        return spark.createDataFrame([], FOUND)
    dims = longest // 8
    groups = max(-(-count // GROUP_ROWS), min(spark.sparkContext.defaultParallelism, -(-count // 4096)))

    near = met(rows, anchors.withColumn("windows", F.lit(None).cast("array<long>")), groups, chunks, positives, True, dims)
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
    best = Window.partitionBy("anchor").orderBy(*order)
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    near = staged(near.select("anchor", F.col("place").alias("window"), "vec_id", "score"), "positives", spark)

    # At most ``positives`` entries an anchor.
    found = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("window", "score"))).alias("own"))
    found = found.select("anchor", F.col("own.score").alias("windows"))
    set_up = anchors.join(found, F.col("row") == F.col("anchor")).drop("anchor")
    far = met(rows, set_up, groups, chunks, negatives, False, dims, low, high)
    best = Window.partitionBy("anchor", "window").orderBy(*order)
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    far = far.toDF("anchor", "window", "row", "negative_id", "negative_score", "rank")
    named = near.toDF("anchor", "window", "positive_id", "positive_score")
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return far.join(named, ["anchor", "window"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
PAIR = "anchor long, window int, row long, vec_id long, score long"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, label, vec (64-bit integers) of the rows that take part."""
    rows = narrow(vectors, "vec_id", "embedding", "label").where("label is not null and embedding is not null")
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        shifted.alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return rows.mapInArrow(quantised, "row long, vec_id long, label long, vec binary")


def quantised(batches):
    for batch in batches:
        kept, out = [], []
        for k, vector in enumerate(batch.column("embedding")):
            own = vector.values
            if own.null_count:
                continue
            own = own.to_numpy()
            if np.isfinite(own).all():
                kept.append(k)
                out.append(np.floor(own * SCALE).clip(-LARGEST, LARGEST).astype(np.int64).tobytes())
        at = pa.array(kept, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(at) for c in ("row", "vec_id", "label")], pa.array(out, pa.binary())],
            names=["row", "vec_id", "label", "vec"],
        )


def met(
    rows: DataFrame, anchors: DataFrame, groups: int, chunks: int, best: int, same: bool, dims: int, low: int = 0, high: int = 0
) -> DataFrame:
    """Each group's best pairs. Every anchor goes to all groups, every row to its group, once a chunk."""
    chunk, group = F.pmod(F.xxhash64("row"), F.lit(chunks)), F.pmod(F.xxhash64("row", F.lit(3)), F.lit(groups))
    kept = [F.col(c) for c in ("row", "vec_id", "label", "vec")]

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    asked = anchors.select(chunk.alias("chunk"), each(groups).alias("group"), F.lit(0).alias("kind"), *kept, "windows")
    nothing = F.lit(None).cast("array<long>").alias("windows")
    base = rows.select(each(chunks).alias("chunk"), group.alias("group"), F.lit(1).alias("kind"), *kept, nothing)
    dealt = asked.union(base).repartition(groups * chunks, "chunk", "group").sortWithinPartitions("chunk", "group", "kind")
    return dealt.mapInArrow(lambda batches: streamed(batches, best, same, dims, low, high), PAIR)


def streamed(batches, best: int, same: bool, dims: int, low: int, high: int):
    """Groups one after the other: first the anchors, then blocks of rows against them."""
    own, state, waiting = None, None, []
    for batch in batches:
        chunk, group, kind = (batch.column(c).to_numpy() for c in ("chunk", "group", "kind"))
        edges = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(group) != 0) | (np.diff(kind) != 0)) + 1
        for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(kind)]):
            if a == z:
                continue
            if (chunk[a], group[a]) != own:
                if state is not None:
                    yield from state.results()
                own, state, waiting = (chunk[a], group[a]), None, []
            part = batch.slice(a, z - a)
            if kind[a] == 0:
                waiting.append(part)
                continue
            if state is None and waiting:
                state = Windows(waiting, best, same, dims, low, high)
            if state is not None:
                state.meet(Rows(part, dims))
    if state is not None:
        yield from state.results()


class Rows:
    """Vectors of a batch as a matrix, with ids and labels."""

    def __init__(self, batch: pa.RecordBatch, dims: int) -> None:
        self.row, self.label = (batch.column(c).to_numpy() for c in ("row", "label"))
        self.none = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        self.vec_id = batch.column("vec_id").fill_null(0).to_numpy()
        self.vectors = np.zeros((batch.num_rows, dims), np.int64)
        for k, raw in enumerate(batch.column("vec")):
            own = np.frombuffer(raw.as_buffer(), np.int64)
            self.vectors[k, : len(own)] = own
        squares = self.vectors.astype(float) ** 2
        #: Norms of the first d dimensions, d from 0 to all; rounded up so that bounds hold.
        self.norms = np.zeros((batch.num_rows, dims + 1))
        np.sqrt(np.cumsum(squares, axis=1), out=self.norms[:, 1:])
        self.norms *= 1 + 1e-9


def exact_type(a: Rows, b: Rows):
    """A type in which no score or partial sum of the two is rounded."""
    largest = a.norms[:, -1].max(initial=0) * b.norms[:, -1].max(initial=0)
    return np.float32 if largest < 1 << 23 else np.float64 if largest < 1 << 52 else np.int64


def threshold_join(asked: Rows, index: Rows, at_least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of anchor and row with a score of at least the anchor's threshold: places and scores.

    The rows' leading dimensions are left out where their norm bound says so for every anchor.
    """
    dims = index.vectors.shape[1]
    kind = exact_type(asked, index)
    a_norms = asked.norms
    # Least threshold by the anchor's norm: below it, no anchor needs the dimension.
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(a_norms[:, -1] > 0, at_least / a_norms[:, -1], np.where(at_least > 0, np.inf, -np.inf))
    least = share.min(initial=np.inf)
    left_out = (index.norms[:, 1:] < least).sum(axis=1) if least > 0 else np.zeros(len(index.row), np.int64)
    order = np.argsort(left_out, kind="stable")
    order = order[left_out[order] < dims]  # a row left out in full reaches no threshold
    left_out = left_out[order]
    if not len(order):
        return (np.zeros(0, np.int64),) * 3
    vectors, norms = index.vectors[order].astype(kind), index.norms[order]
    own = asked.vectors.astype(kind)
    sums = np.zeros((len(own), len(order)), kind)
    for start in range((dims - 1) // TILE * TILE, -1, -TILE):
        end = min(start + TILE, dims)
        # Rows that have a posting in the tile stand first.
        many = int(np.searchsorted(left_out, end, side="left"))
        sums[:, :many] += own[:, start:end] @ vectors[:many, start:end].T
        if start % (2 * TILE) == 0:
            unread = norms[np.arange(len(order)), np.maximum(left_out, start)]
            alive = sums + a_norms[:, -1, None] * unread >= at_least[:, None]
            if start == 0 or np.count_nonzero(alive) < SPARSE * alive.size:
                break
    a, b = np.nonzero(alive)
    scores = np.einsum("ij,ij->i", asked.vectors[a], index.vectors[order[b]])
    reached = scores >= at_least[a]
    return a[reached], order[b[reached]], scores[reached]


class Windows:
    """The best pairs of each window of each anchor so far.

    For positives an anchor has one window without bounds; for negatives one for each positive.
    """

    def __init__(self, anchors: list, best: int, same: bool, dims: int, low: int, high: int) -> None:
        batch = pa.concat_batches(anchors)
        self.asked, self.best, self.same = Rows(batch, dims), best, same
        n = batch.num_rows
        if same:
            self.low, self.high = np.full((n, 1), NEVER), np.full((n, 1), np.iinfo(np.int64).max)
        else:
            scores = [x or [] for x in batch.column("windows").to_pylist()]
            wide = max(map(len, scores), default=0)
            self.low, self.high = np.zeros((n, wide), np.int64), np.full((n, wide), -1)
            for k, own in enumerate(scores):
                self.low[k, : len(own)] = [-(-low * s // 100) for s in own]
                self.high[k, : len(own)] = [high * s // 100 for s in own]
        #: What a window still takes at least: its lower bound, then its last score once it is full.
        self.floor = np.where(self.low <= self.high, self.low, np.iinfo(np.int64).max)
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool, np.int64, np.int64))

    def meet(self, index: Rows) -> None:
        step = max(1, PAIRS // len(index.row))
        for a in range(0, len(self.asked.row), step):
            self.fall(np.arange(a, min(a + step, len(self.asked.row))), index)

    def fall(self, anchors: np.ndarray, index: Rows) -> None:
        """Lower the anchors' thresholds until nothing below can enter a window."""
        anchors = anchors[(self.floor[anchors] < np.iinfo(np.int64).max).any(axis=1)]
        top = self.asked.norms[anchors, -1] * index.norms[:, -1].max(initial=0) + 1
        if not self.same:
            top = np.minimum(top, self.high[anchors].max(axis=1, initial=-1) + 1.0)
        before, level, turn = np.full(len(anchors), np.inf), np.maximum(top, 1.0), 1
        while len(anchors):
            floor = self.floor[anchors].min(axis=1).astype(float)
            level, turn = np.where(level > 2.0, level * FALL**turn, -np.inf), turn + 1
            at_least = np.maximum(level, floor)
            part = Part(self.asked, anchors)
            a, b, score = threshold_join(part, index, at_least)
            new = score < before[a]
            self.take(anchors[a[new]], b[new], score[new], index)
            # A level at the floor of an anchor was its last.
            going = at_least > self.floor[anchors].min(axis=1)
            anchors, before, level = anchors[going], at_least[going], level[going]

    def take(self, anchor: np.ndarray, place: np.ndarray, score: np.ndarray, index: Rows) -> None:
        alike = self.asked.label[anchor] == index.label[place]
        fits = alike & (self.asked.row[anchor] != index.row[place]) if self.same else ~alike
        anchor, place, score = anchor[fits], place[fits], score[fits]
        inside = (score[:, None] >= self.floor[anchor]) & (score[:, None] <= self.high[anchor])
        pair, window = np.nonzero(inside)
        if not len(pair):
            return
        place, wide = place[pair], self.floor.shape[1]
        new = (anchor[pair] * wide + window, score[pair], place, index.none[place], index.vec_id[place], index.row[place])
        merged = [np.concatenate(x) for x in zip(self.rows, new)]
        cell, score, _, none, vec_id, row = merged
        order = np.lexsort((row, vec_id, none, -score, cell))
        begins = np.flatnonzero(np.diff(cell[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
        kept = order[rank < self.best]
        self.rows = tuple(x[kept] for x in merged)
        full = order[rank == self.best - 1]
        self.floor.reshape(-1)[cell[full]] = score[full]

    def results(self) -> Iterator[pa.RecordBatch]:
        cell, score, _, none, vec_id, row = self.rows
        wide = self.floor.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(self.asked.row[cell // wide] if wide else cell),
                pa.array((cell % wide + 1 if wide else cell).astype(np.int32)),
                pa.array(row),
                pa.array(vec_id, mask=none),
                pa.array(score),
            ],
            names=["anchor", "window", "row", "vec_id", "score"],
        )


class Part(Rows):
    """Some of the anchors."""

    def __init__(self, whole: Rows, chosen: np.ndarray) -> None:
        for name in ("row", "label", "none", "vec_id", "vectors", "norms"):
            setattr(self, name, getattr(whole, name)[chosen])
