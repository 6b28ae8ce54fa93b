"""Ranked lexical search, reversed: documents stream through an inverted index over the items.

The items of a block and their terms make an inverted index of bounded size, which is broadcast.
One pass over the texts counts the terms that the index knows; document frequencies and lengths
are summed from those counts. The counts then stream through the index: each adds its weight to
the scores of the items that hold the term, and every task keeps the best documents of each item
in a bounded heap. Heaps are merged by item. More items than a block holds take further passes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.common import documents, narrow, staged

#: Terms are runs of digits, ASCII letters and characters beyond ASCII; A-Z alone are lowered.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP = 20
#: Pairs of item and term that one block's index may hold; it bounds what is broadcast. An item is never split.
MOST_PAIRS = 1 << 20
#: Cells of document by item scored at a time in a task.
CELLS = 1 << 22
#: Bytes of a text whose terms are counted at a time.
SLICE = 1 << 22
FOUND = "item_id long, rank int, doc_id long, score long"


def term_counts(text: bytes) -> Counter:
    """Each term and how often it stands in the text; a long text is cut between terms."""
    text, counts = text.lower(), Counter()
    at = 0
    while len(text) - at > SLICE:
        gap = NO_TERM.search(text, at + SLICE)
        if gap is None:
            break
        counts.update(TERM.findall(text, at, gap.start()))
        at = gap.start()
    counts.update(TERM.findall(text, at))
    return counts


NO_TERM = re.compile(rb"[^0-9a-z\x80-\xff]")


@dataclass
class Index:
    """Items of one block by term: ``items[starts[t]:starts[t + 1]]`` hold term t, ``times`` each."""

    ids: list
    terms: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, ids: list, counts: list[Counter]) -> Index:
        terms: dict[bytes, int] = {}
        pairs = [(terms.setdefault(t, len(terms)), k, n) for k, own in enumerate(counts) for t, n in own.items()]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        starts = np.searchsorted(table[:, 0], np.arange(len(terms) + 1))
        return cls(ids, terms, starts, table[:, 1].copy(), table[:, 2].copy())


def blocks(items: DataFrame, most_pairs: int) -> Iterator[Index]:
    """The items in blocks of bounded size, fetched partition by partition."""
    ids, counts, pairs = [], [], 0
    for row in narrow(items, "item_id", "text").toLocalIterator():
        own = term_counts((row.text or "").encode())
        if not own:
            continue
        if pairs and pairs + len(own) > most_pairs:
            yield Index.of(ids, counts)
            ids, counts, pairs = [], [], 0
        ids.append(row.item_id)
        counts.append(own)
        pairs += len(own)
    if ids:
        yield Index.of(ids, counts)


def search(
    docs: DataFrame, items: DataFrame, spark: SparkSession, top: int = TOP, most_pairs: int = MOST_PAIRS
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each item, scores above 0.

    Equal scores come by ascending doc_id, null ids last. Every row is an item or a document of
    its own: rows that repeat an id or a text are ranked side by side. Items and documents that
    are null, empty or without a term find nothing and are not found. Fewer matches give fewer
    rows, an empty table none. Texts are taken whole; other columns may have any names.
    """
    out = [block_search(docs, index, spark, top) for index in blocks(items, most_pairs)]
    found = spark.createDataFrame([], FOUND)
    for part in out:
        found = found.union(part)
    return found


def block_search(docs: DataFrame, index: Index, spark: SparkSession, top: int) -> DataFrame:
    known = spark.sparkContext.broadcast(index)
    counted = documents(docs).mapInArrow(
        lambda batches: known_terms(batches, known.value.terms), "doc_id long, n long, terms array<int>, times array<int>"
    )
    counted = staged(counted, "term-counts", spark)
    sizes = counted.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # One row for each term of the index.
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("held")).toArrow()
    weights = term_weights(sizes.documents, held, len(index.terms))
    model = spark.sparkContext.broadcast((index, weights, sizes.documents, sizes.terms))
    heaps = counted.mapInArrow(lambda batches: best(batches, *model.value, top), "item int, item_id long, doc_id long, score long")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    merged = heaps.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return merged.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def term_weights(documents: int, held: pa.Table, terms: int) -> np.ndarray:
    frequency = np.zeros(terms, np.int64)
    frequency[held.column("term").to_numpy()] = held.column("held").to_numpy()
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)


def known_terms(batches, terms: dict[bytes, int]):
    """Documents with a term: how many they have, and the terms of the index with their counts."""
    keys = terms.keys()
    for batch in batches:
        rows, sizes, found, times, ends = [], [], [], [], [0]
        for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            counts = term_counts(text)
            if not counts:
                continue
            rows.append(row)
            sizes.append(counts.total())
            for term in counts.keys() & keys:
                found.append(terms[term])
                times.append(counts[term])
            ends.append(len(found))
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(rows, pa.int32())),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())),
            ],
            names=["doc_id", "n", "terms", "times"],
        )


class Heaps:
    """The best documents of each item so far: score, null id last, id."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.least = top, np.zeros(items, np.int64)
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, item: np.ndarray, score: np.ndarray, none: np.ndarray, doc: np.ndarray) -> None:
        merged = [np.concatenate(x) for x in zip(self.rows, (item, score, none, doc))]
        item, score, none, doc = merged
        order = np.lexsort((doc, none, -score, item))
        begins = np.flatnonzero(np.diff(item[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
        kept = order[rank < self.top]
        self.rows = tuple(x[kept] for x in merged)
        full = order[rank == self.top - 1]
        self.least[item[full]] = score[full]


def best(batches, index: Index, weights: np.ndarray, documents: int, terms: int, top: int):
    """Each task's best documents of each item."""
    items = len(index.ids)
    heaps, step = Heaps(items, top), max(1, CELLS // items)
    for batch in batches:
        ids, none = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        sizes = batch.column("n").to_numpy()
        ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
        found, times = (batch.column(c).values.to_numpy().astype(np.int64) for c in ("terms", "times"))
        for a in range(0, batch.num_rows, step):
            z = min(a + step, batch.num_rows)
            scores = scored(index, weights, sizes[a:z], ends[a : z + 1], found, times, documents, terms)
            row, item = np.nonzero((scores > 0) & (scores >= heaps.least))
            if len(row):
                heaps.add(item, scores[row, item], none[a + row], ids[a + row])
    item, score, none, doc = heaps.rows
    # The item's id may be null; whole ids are looked up once a kept row.
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(item.astype(np.int32)),
            pa.array([index.ids[k] for k in item.tolist()], pa.int64()),
            pa.array(doc, pa.int64(), mask=none),
            pa.array(score),
        ],
        names=["item", "item_id", "doc_id", "score"],
    )


def scored(index, weights, sizes, ends, found, times, documents: int, terms: int) -> np.ndarray:
    """Scores of some documents for all items, in whole numbers."""
    own, tf = found[ends[0] : ends[-1]], times[ends[0] : ends[-1]]
    row = np.repeat(np.arange(len(sizes)), np.diff(ends))
    length = 100 - 25 + (25 * sizes * documents) // terms
    value = weights[own] * ((1_000_000_000 * tf) // (1000 * tf + 12 * length[row]))
    holders = index.starts[own + 1] - index.starts[own]
    total = int(holders.sum())
    scores = np.zeros((len(sizes), len(index.ids)), np.int64)
    if total:
        at = np.arange(total) + np.repeat(index.starts[own] - (np.cumsum(holders) - holders), holders)
        cell = np.repeat(row * scores.shape[1], holders) + index.items[at]
        np.add.at(scores.reshape(-1), cell, np.repeat(value, holders) * index.times[at])
    return scores
