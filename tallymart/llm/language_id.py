"""Language by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes, with the counts of what followed
them. A byte is coded in the longest context seen; where it never followed that, an escape is
coded (method C) and the next shorter context is asked, without what was ruled out. A text's
code length under each language's frozen tree is summed over all its bytes; the shortest wins.

Trees are sparse: they hold the contexts seen, as sorted codes, and are asked by binary search, a
block's distinct codes at a time. Bytes are folded first: letters to lower case, digits to one,
white space and control bytes to one. All others keep their own symbol.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.common import IS_SPACE, LOWER, documents, remainder, text_blocks

FOLDS, HELD_OUT = 5, 0
ORDER = 3
#: Documents that a language's tree is grown from: about those with the smallest hashes of their id,
#: all where there are no more. Hashes are told apart to 1 in STEPS of their size.
SAMPLE, STEPS = 4000, 32
UNKNOWN = "und"


def folded_bytes() -> np.ndarray:
    fold = LOWER.copy()
    fold[48:58], fold[IS_SPACE], fold[:9], fold[14:32] = 48, 32, 32, 32
    return fold


FOLD = folded_bytes()
#: Symbols that bytes are folded to: codes of order + 1 of them fit in 31 bits.
SYMBOLS = len(np.unique(FOLD))


@dataclass
class Level:
    """What followed the contexts of one length: codes of context and symbol, and codes of contexts."""

    entries: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray
    #: Counts that the context's symbols have in the next shorter context, where they are ruled out.
    below: np.ndarray


def found_in(wanted: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted are among the known (ascending), and at which place."""
    if not len(known):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return known[place] == wanted, place


def levels(codes: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Contexts of 0 to ORDER symbols, from the counts of distinct codes."""
    out: list[Level] = []
    for order in range(ORDER + 1):
        entries, which = np.unique(codes % SYMBOLS ** (order + 1), return_inverse=True)
        own = np.bincount(which, weights=counts, minlength=len(entries))
        contexts, of, kinds = np.unique(entries // SYMBOLS, return_inverse=True, return_counts=True)
        below = np.zeros(len(contexts))
        if order:
            _, place = found_in(entries % SYMBOLS**order, out[-1].entries)
            below = np.bincount(of, weights=out[-1].counts[place], minlength=len(contexts))
        totals = np.bincount(of, weights=own, minlength=len(contexts))
        out.append(Level(entries, own, contexts, totals, kinds.astype(float), below))
    return out


def code_bits(codes: np.ndarray, tree: list[Level]) -> np.ndarray:
    """Bits of each code's last symbol behind the others.

    What a context has seen, all shorter ones have, so the next longer context alone says which
    symbols are ruled out.
    """
    bits, left = np.zeros(len(codes)), np.arange(len(codes))
    barred, barred_kinds = np.zeros(len(codes)), np.zeros(len(codes))
    for order in range(ORDER, -1, -1):
        level, own = tree[order], codes[left] % SYMBOLS ** (order + 1)
        known, at = found_in(own // SYMBOLS, level.contexts)
        left, own, at = left[known], own[known], at[known]  # others go on with nothing ruled out
        total, kinds = level.totals[at] - barred[left], level.kinds[at] - barred_kinds[left]
        seen, place = found_in(own, level.entries)
        share = np.where(seen, level.counts[place] if len(place) else 0.0, np.where(total > 0, kinds, 1.0))
        bits[left] += np.log2(np.where(seen | (total > 0), total + kinds, 1.0) / share)
        barred[left], barred_kinds[left] = level.below[at], level.kinds[at]
        done = np.zeros(len(codes), bool)
        done[left[seen]] = True
        finished = done if order == ORDER else finished | done
        left = np.flatnonzero(~finished)
    bits[left] += np.log2(np.maximum(SYMBOLS - barred_kinds[left], 1))
    return bits


@dataclass
class Trees:
    """Counts behind the contexts seen, by language."""

    languages: list[str]
    symbols: np.ndarray
    by_language: list[list[Level]]

    def lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        codes, places = coded(data, starts, self.symbols)
        out = np.zeros((len(starts) - 1, len(self.languages)))
        some = np.diff(starts) > 0
        if some.any():
            distinct, which = np.unique(codes, return_inverse=True)
            for k, tree in enumerate(self.by_language):
                out[some, k] = np.add.reduceat(code_bits(distinct, tree)[which], places[:-1][some])
        return out


def coded(data: np.ndarray, starts: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of each byte with the bytes before it, and where each text's codes start.

    Before a text stand spaces, so no code depends on a text's neighbours.
    """
    raw = memoryview(np.ascontiguousarray(data))
    pad = b" " * ORDER
    joined = pad + pad.join([raw[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())])
    own = symbols[np.frombuffer(joined, np.uint8)].astype(np.int32)
    codes = own[ORDER:].copy()
    for back in range(1, ORDER + 1):
        codes += own[ORDER - back : len(own) - back] * np.int32(SYMBOLS**back)
    lengths = np.diff(starts)
    inside = np.ones(len(codes), bool)
    ends = np.cumsum(lengths) + ORDER * np.arange(len(lengths))
    for k in range(ORDER):
        gaps = ends[:-1] + k
        inside[gaps] = False
    return codes[inside], starts - starts[0]


def grow(languages: list[str], symbols: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]] | np.ndarray) -> Trees:
    """Trees from each language's counts: distinct codes and how often they are, or a table over all codes."""
    trees = []
    for own in counts:
        if not isinstance(own, tuple):
            seen = np.flatnonzero(own)
            own = seen, own[seen]
        trees.append(levels(own[0].astype(np.int64), own[1]))
    return Trees(languages, symbols, trees)


def train(docs: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees of all languages named outside the held-out fold, or None where there is none.

    The sample's counts are summed by Spark; what comes to the driver are the distinct codes of
    each language's sample.
    """
    rows = documents(docs, "lang").where("lang is not null and doc_id is not null")
    rows = rows.where(remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = rows.select("lang", "text", hash_step().alias("step"))
    rows = rows.join(F.broadcast(last_steps(rows, sample)), "lang").where("step <= last").select("lang", "text")
    symbols = np.searchsorted(np.unique(FOLD), FOLD)
    counted = rows.mapInArrow(lambda batches: code_counts(batches, symbols), "lang string, code int, n long")
    counted = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    if not len(counted):
        return None
    names = counted.column("lang").combine_chunks().dictionary_encode()
    codes, n = counted.column("code").to_numpy(), counted.column("n").to_numpy()
    of, named = names.indices.to_numpy(), names.dictionary.to_pylist()
    languages = sorted(named)
    own = [of == named.index(x) for x in languages]
    return grow(languages, symbols, [(codes[x], n[x]) for x in own])


def hash_step() -> Column:
    """The size of the id's hash, on a scale of which each doubling has STEPS steps."""
    size = (F.shiftrightunsigned(F.xxhash64("doc_id"), 1) + 1).cast("double")
    return F.floor(F.log2(size) * STEPS).cast("int")


def last_steps(rows: DataFrame, sample: int) -> DataFrame:
    """lang, last: up to which step of hashes a language has ``sample`` rows, or all it has.

    Every language of the rows has at least its first step, so none is lost however rare it is.
    """
    counts = rows.groupBy("lang", "step").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    sums = counts.select("lang", "step", F.coalesce(so_far, F.lit(0)).alias("before"))
    return sums.where(F.col("before") < sample).groupBy("lang").agg(F.max("step").alias("last"))


def code_counts(batches, symbols: np.ndarray):
    for batch in batches:
        names = batch.column("lang").to_pylist()
        for first, past, data, starts in text_blocks(batch.column("text")):
            codes, places = coded(data, starts, symbols)
            of = np.repeat(np.arange(first, past), np.diff(places))
            languages = sorted(set(names[first:past]))
            which = np.array([languages.index(x) for x in names[first:past]])
            pairs, counts = np.unique(which[of - first].astype(np.int64) << 32 | codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([languages[k] for k in (pairs >> 32).tolist()], pa.string()),
                    pa.array(pairs & 0xFFFFFFFF, pa.int32()),
                    pa.array(counts, pa.int64()),
                ],
                names=["lang", "code", "n"],
            )


def has_letter(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which texts have a letter of any script."""
    lower = LOWER[data]
    sums = np.concatenate([[0], np.cumsum((lower >= 97) & (lower <= 122))])
    out = sums[starts[1:]] > sums[starts[:-1]]
    for k in np.flatnonzero(~out):
        out[k] = any(map(str.isalpha, bytes(data[starts[k] : starts[k + 1]]).decode(errors="replace")))
    return out


def identify(docs: DataFrame, spark: SparkSession, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, bits_per_byte.

    The score is the share of the predicted language among all, by code lengths. A null text, an
    empty one or one without any letter is ``und`` with score 0, and so is every text where no
    language could be learnt. Of equal code lengths the first language by name wins. Texts of
    any length are coded whole. A null id belongs to the fold of the empty text.
    """
    trees = train(docs, sample)
    shared = spark.sparkContext.broadcast(trees)
    rows = documents(docs).mapInArrow(
        lambda batches: predictions(batches, shared.value),
        "doc_id long, lang_pred string, score double, bits_per_byte double",
    )
    return rows.select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


def predictions(batches, trees: Trees | None):
    for batch in batches:
        names, scores, rates = [], [np.zeros(0)], [np.zeros(0)]
        for _, _, data, starts in text_blocks(batch.column("text")):
            if trees is None:
                names += [UNKNOWN] * (len(starts) - 1)
                scores.append(np.zeros(len(starts) - 1))
                rates.append(np.zeros(len(starts) - 1))
                continue
            bits, letters = trees.lengths(data, starts), has_letter(data, starts)
            best, least = bits.argmin(axis=1), bits.min(axis=1)
            names += [trees.languages[k] if x else UNKNOWN for k, x in zip(best.tolist(), letters.tolist())]
            share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            scores.append(np.where(letters, share, 0.0))
            rates.append(least / np.maximum(np.diff(starts), 1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(names, pa.string()),
                pa.array(np.concatenate(scores)),
                pa.array(np.concatenate(rates)),
            ],
            names=["doc_id", "lang_pred", "score", "bits_per_byte"],
        )
