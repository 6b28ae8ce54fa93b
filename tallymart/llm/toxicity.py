"""Toxicity by a support vector machine on a string kernel.

Two strings are alike by the subsequences of three bytes they share, those with gaps counting
less (a gap-weighted subsequence kernel, scaled to 1 for equal strings). Inserted or missing
characters lower the value without destroying it. Landmark strings span the machine's space
(Nystroem): a string is its kernel values with them, whitened. A sentence is seen as its words and
as its windows: runs of words, with gaps for what stands between and without, that all have something of
one toxic landmark. It scores as the most toxic of these does, a document by its worst sentence and by
how much of it scores as toxic.

The training set is labelled sentences: those of toxic documents are taken as toxic, of which
the machine itself picks, in turns, the word or window that makes them so. Runs of two or three
words that tell more than their words do are landmarks of their own.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import (
    LOWER,
    Powers,
    documents,
    narrow,
    remainder,
    span_hashes,
    spread,
    text_blocks,
    word_bounds,
)
from tallymart.llm.quality_classifier import sigmoid

FOLDS, HELD_OUT = 5, 0
DECAY = np.float32(0.6)
LANDMARKS, LANDMARK_BYTES = 40, 8
#: Longest string that the kernel takes at once; a longer word is seen in overlapping windows.
LONGEST = 24
#: Labelled documents of either label that the machine is fitted on, at most.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1200, 2400
#: Log odds of a word for toxic documents, times the root of its documents, from which it may be a witness.
TELLING = 6.0
#: Weight of a witness against that of a clean document's word.
WITNESS = 4.0
GAP = 46
#: Kernel value with a landmark from which a word may be a part of it.
PART = 0.25
#: Log likelihood ratio from which what toxic documents hold may be a landmark of windows.
EVIDENCE = 14.0
#: Landmarks of several words, at most.
PHRASES = 8
#: Bytes that end a sentence, unless they stand behind a single letter.
STOPS = np.isin(np.arange(256), np.frombuffer(b".!?\n", np.uint8))


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Folded bytes of the texts, begin and end of each word from letter to letter, its text and sentence.

    Inside a word, what is no letter becomes a gap, which is like nothing.
    """
    spaced, begin = spread(data, starts)
    low = LOWER[spaced].copy()
    capital = np.zeros(len(low), bool)  # of Latin letters with marks
    capital[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E)
    low[capital] += 32
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    a, b = word_bounds(spaced)
    low[~letter] = GAP
    at = np.append(np.flatnonzero(letter), len(low))
    first = at[np.searchsorted(at, a)]
    some = first < b
    first, b = first[some], b[some]
    last = at[np.searchsorted(at, b) - 1] + 1
    of = np.searchsorted(begin, first, side="right") - 1
    stops = np.concatenate([[0], np.cumsum(STOPS[spaced])])
    ended = (stops[first[1:]] > stops[last[:-1]]) & (last[:-1] - first[:-1] > 1)
    sentence = np.concatenate([[0], np.cumsum(ended | (of[1:] > of[:-1]))])[: len(of)]
    return low, first, last, of, sentence


def windows(parts: np.ndarray, sentence: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each window: two words or more of a sentence, LONGEST bytes at most,
    that are all parts of one landmark (a bit each in ``parts``)."""
    at, common, firsts, lasts = np.arange(len(parts)), parts, [], []
    for further in range(1, LONGEST):
        inside = at + further < len(parts)
        at, common = at[inside], common[inside]
        common = common & parts[at + further]
        ok = (common != 0) & (sentence[at] == sentence[at + further]) & (end[at + further] - begin[at] <= LONGEST)
        at, common = at[ok], common[ok]
        if not len(at):
            break
        firsts.append(at)
        lasts.append(at + further)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *firsts]), np.concatenate([none, *lasts])


def part_bits(words: list[bytes], values: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Which landmarks each word may be a part of. One of few letters is where these follow each other."""
    places = np.uint64(1) << np.arange(len(marks), dtype=np.uint64)
    bits = ((values[:, : len(marks)] >= PART) * places).sum(axis=1, dtype=np.uint64)
    for k, word in enumerate(words):
        if len(word) <= 3:
            bits[k] |= np.uint64(sum(1 << j for j, mark in enumerate(marks) if word in mark.replace(b".", b"")))
    return bits


def pairs_kernel(words: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel of order 3, not scaled, of words (one length, as rows) with landmarks (0 fills up)."""
    n, m, letters = len(words), len(marks), marks.shape[1]
    # For each byte and letter of the landmarks, the squared decay where they are the same.
    same = (np.arange(256)[:, None, None] == marks.T[None, :, :]).astype(np.float32) * (DECAY * DECAY)
    same[[0, GAP]] = 0
    tables = [np.ascontiguousarray(same[:, j]) for j in range(letters)]
    once, twice = (np.zeros((letters, n, m), np.float32) for _ in range(2))  # shared before each letter
    total, work = (np.zeros((n, m), np.float32) for _ in range(2))
    last = words.shape[1] - 1
    for i in range(last + 1):
        char = words[:, i]
        run_1 = tables[0][char]
        run_2 = np.zeros((n, m), np.float32)
        for j in range(1, letters):
            hit = tables[j][char]
            if j > 1:  # two letters stand before
                np.multiply(hit, twice[j], out=work)
                total += work
            if i == last:  # what is shared so far is not asked for again
                continue
            np.multiply(hit, once[j], out=work)
            once[j] *= DECAY
            once[j] += run_1
            if j > 1:
                twice[j] *= DECAY
                twice[j] += run_2
            run_1 *= DECAY
            run_1 += hit
            run_2 *= DECAY
            run_2 += work
    return total


def self_kernel(words: np.ndarray) -> np.ndarray:
    """Kernel of each word with itself."""
    n, length = words.shape
    # What is shared before a place, each step back counting less.
    back = np.arange(length)[None, :] - np.arange(length)[:, None] - 1
    before = np.where(back >= 0, DECAY ** np.maximum(back, 0), 0).astype(np.float32)
    once, twice = (np.zeros((n, length), np.float32) for _ in range(2))
    total, square, letter = np.zeros(n, np.float32), DECAY * DECAY, words != GAP
    for i in range(length):
        same = ((words == words[:, i : i + 1]) & letter & letter[:, i : i + 1]).astype(np.float32)
        total += np.einsum("ij,ij->i", same, twice)
        same *= square
        run_1, run_2 = same @ before, (same * once) @ before
        once *= DECAY
        once += run_1
        twice *= DECAY
        twice += run_2
    return total * square


def scaled_kernel(words: list[bytes], marks: list[bytes]) -> np.ndarray:
    """Kernel values from 0 to 1. Words shorter than three bytes are like nothing."""
    short = [k for k, x in enumerate(marks) if len(x) <= LANDMARK_BYTES]
    if 0 < len(short) < len(marks):  # a table for each, so that short ones are not filled up
        out = np.zeros((len(words), len(marks)), np.float32)
        for own in (short, [k for k in range(len(marks)) if k not in short]):
            out[:, own] = scaled_kernel(words, [marks[k] for k in own])
        return out
    out = np.zeros((len(words), len(marks)), np.float32)
    lengths = np.array([len(w) for w in words])
    table = np.zeros((len(marks), max(map(len, marks))), np.uint8)
    for k, mark in enumerate(marks):
        table[k, : len(mark)] = np.frombuffer(mark, np.uint8)
    own = np.array([self_value(x) for x in marks])
    # Gaps at the end are like nothing and change no value, so words of near lengths go together.
    padded = np.array(PADDED)
    group = np.searchsorted(padded, lengths)
    for g in np.unique(group[(lengths >= 3) & (lengths <= LONGEST)]).tolist():
        rows = np.flatnonzero((group == g) & (lengths >= 3))
        raw = b"".join([words[r].ljust(PADDED[g], b".") for r in rows.tolist()])
        table_of = np.frombuffer(raw, np.uint8).reshape(-1, PADDED[g])
        for k in range(0, len(rows), 4096):
            norms = self_kernel(table_of[k : k + 4096])
            for j in range(k, min(k + 4096, len(rows)), 512):
                block, norm = table_of[j : min(j + 512, k + 4096)], norms[j - k : j - k + 512]
                scale = np.sqrt(np.maximum(norm[:, None] * own[None, :], 1e-12))
                out[rows[j : j + len(block)]] = pairs_kernel(block, table) / scale
    long = np.flatnonzero(lengths > LONGEST).tolist()
    if long:
        parts = [[words[r][k : k + LONGEST] for k in range(0, len(words[r]) - LONGEST // 2, LONGEST // 2)] for r in long]
        values = scaled_kernel([x for each in parts for x in each], marks)
        out[long] = np.maximum.reduceat(values, np.cumsum([0, *map(len, parts)])[:-1], axis=0)
    return out


#: Lengths that words are filled up to.
PADDED = (6, 9, 12, 16, 20, LONGEST)
#: Kernel values of landmarks with themselves.
SELF_VALUES: dict[bytes, float] = {}


def self_value(mark: bytes) -> float:
    if mark not in SELF_VALUES:
        if len(SELF_VALUES) > 100_000:
            SELF_VALUES.clear()
        SELF_VALUES[mark] = float(self_kernel(np.frombuffer(mark, np.uint8)[None, :])[0])
    return SELF_VALUES[mark]


@dataclass
class Machine:
    """Landmarks, the whitened weights of a word, and how word scores make a document's score."""

    marks: list[bytes]
    weights: np.ndarray
    bias: float
    document: np.ndarray
    #: So many of the landmarks, the first, are telling words and phrases.
    toxic: int

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word or window, and which toxic landmarks it may be a part of."""
        if not words:
            return np.zeros(0), np.zeros(0, np.uint64)
        values = scaled_kernel(words, self.marks)
        return values @ self.weights + self.bias, part_bits(words, values, self.marks[: self.toxic])

    def documents(self, facts: np.ndarray) -> np.ndarray:
        return sigmoid(np.column_stack([facts, np.ones(len(facts))]) @ self.document)


def document_facts(scores: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Highest score of a word or window, log of those that score as toxic, and their share, of each text."""
    top = np.full(n, -3.0)
    np.maximum.at(top, of, np.clip(scores, -3, 3))
    hits = np.bincount(of, weights=scores > 0, minlength=n)
    words = np.bincount(of, minlength=n)
    return np.column_stack([top, np.log1p(hits), np.sqrt(hits / np.maximum(words, 1))])


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights, bias last, of a linear support vector machine with squared hinge loss, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    for _ in range(30):
        inside = y * (x @ w) < 1
        own, pull = x[inside], weight[inside]
        new = np.linalg.solve(own.T @ (own * pull[:, None]) + np.diag(keep), own.T @ (pull * y[inside]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w, weight = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(50):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + ridge * w
        bend = x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w


def telling(w: bytes, in_toxic: Counter, in_clean: Counter, n_toxic: int, n_clean: int) -> float:
    """Log odds of what toxic documents hold, times the root of their number."""
    odds = np.log((in_toxic[w] + 0.1) / (n_toxic + 1)) - np.log((in_clean[w] + 0.1) / (n_clean + 1))
    return odds * np.sqrt(in_toxic[w])


def evidence(w: bytes, in_toxic: Counter, in_clean: Counter, n_toxic: int, n_clean: int) -> float:
    """By how much toxic documents hold it more often, as a log likelihood ratio; far more than
    chance does where very many words are compared."""
    c, d, p = in_toxic[w], in_clean[w], n_toxic / (n_toxic + n_clean)
    if c <= (c + d) * p:
        return 0.0
    return c * np.log(c / (c + d) / p) + (d * np.log(d / (c + d) / (1 - p)) if d else 0.0)


def phrases(sequences: list[list[bytes]], labels: np.ndarray, odds: dict[bytes, float]) -> list[bytes]:
    """Runs of two or three words that tell more of toxic documents than each of their words, best first."""

    def runs(words: list[bytes]) -> set[tuple[bytes, ...]]:
        found = {*zip(words, words[1:]), *zip(words, words[1:], words[2:])}
        return {x for x in found if all(x) and sum(map(len, x)) + len(x) - 1 <= LONGEST}

    in_toxic = Counter(x for words, label in zip(sequences, labels) if label for x in runs(words))
    often = Counter({x: c for x, c in in_toxic.items() if c >= 3})
    in_clean = Counter(x for words, label in zip(sequences, labels) if not label for x in runs(words) if x in often)
    counts = often, in_clean, int((labels == 1).sum()), int((labels != 1).sum())
    told = {x: telling(x, *counts) for x in often if evidence(x, *counts) >= EVIDENCE}
    best = [x for x in told if told[x] >= TELLING and told[x] > max(odds.get(w, -5.0) for w in x)]
    return [b".".join(x) for x in sorted(best, key=lambda x: (-told[x], len(x), x))]


def sample_windows(sequences: list[list[bytes]], parts: dict[bytes, int]) -> list[list[bytes]]:
    """The windows of each document of the sample, with gaps and without."""
    out = []
    for words in sequences:
        bits = np.array([parts.get(w, 0) for w in words], np.uint64)
        end = np.cumsum([len(w) + 1 for w in words])
        begin = end - [len(w) + 1 for w in words]
        first, last = windows(bits, np.zeros(len(words), np.int64), begin, end - 1)
        gapped = [b".".join(words[x : y + 1]) for x, y in zip(first.tolist(), last.tolist())]
        out.append(gapped + [x.replace(b".", b"") for x in gapped])
    return out


def fit(sequences: list[list[bytes]], labels: np.ndarray, weight: np.ndarray) -> Machine | float:
    """The machine, or the share of toxic documents where there is nothing to tell them by.

    A sequence holds a document's words, and an empty one at the end of each sentence.
    """
    bags = [Counter(filter(None, x)) for x in sequences]
    toxic = np.flatnonzero(labels == 1)
    in_toxic, in_clean = Counter(), Counter()
    for bag, label in zip(bags, labels):
        (in_toxic if label else in_clean).update(bag.keys())
    n_toxic, n_clean = len(toxic), len(labels) - len(toxic)
    odds = {
        w: telling(w, in_toxic, in_clean, n_toxic, n_clean)
        for w, c in in_toxic.items()
        if len(w) >= 3 and (c >= 2 or not in_clean[w])
    }
    if not n_toxic or not n_clean or not odds:
        return float(weight @ labels / weight.sum()) if len(labels) else 0.5
    ranked = sorted(odds, key=lambda w: (-odds[w], w))
    marks, n_marks = landmarks(
        ranked,
        {w for w in ranked if evidence(w, in_toxic, in_clean, n_toxic, n_clean) >= EVIDENCE},
        phrases(sequences, labels, odds),
        sorted(in_clean, key=lambda w: (-in_clean[w], w)),
    )
    plain = sorted(in_toxic.keys() | in_clean.keys())
    values = scaled_kernel(plain, marks)
    parts = dict(zip(plain, part_bits(plain, values, marks[:n_marks]).tolist()))
    for bag, label, more in zip(bags, labels, sample_windows(sequences, parts)):
        (in_toxic if label else in_clean).update(set(more) - bag.keys())
        bag.update(more)
    for w in in_toxic.keys() - parts.keys():
        odds[w] = telling(w, in_toxic, in_clean, n_toxic, n_clean)
    vocabulary = sorted(w for w in in_toxic.keys() | in_clean.keys() if len(w) >= 3)
    place = {w: k for k, w in enumerate(vocabulary)}
    spanned = [w for w in vocabulary if w not in parts]
    values = np.concatenate([values, scaled_kernel(spanned, marks)]) if spanned else values
    row = {w: k for k, w in enumerate(plain + spanned)}
    values = values[[row[w] for w in vocabulary]].astype(np.float64)
    base = scaled_kernel(marks, marks).astype(np.float64)
    spread_, axes = np.linalg.eigh((base + base.T) / 2)
    whiten = axes / np.sqrt(np.maximum(spread_, 1e-3))
    points = values @ whiten
    clean = np.array([place[w] for w in in_clean if len(w) >= 3])
    clean_weight = np.array([float(in_clean[vocabulary[k]]) for k in clean])
    own = [np.array([place[w] for w in bags[k] if len(w) >= 3], dtype=np.int64) for k in toxic.tolist()]
    own = [x for x in own if len(x)]
    told = np.array([odds.get(w, -5.0) for w in vocabulary])
    scores = told - TELLING
    for _ in range(4):
        # A document's worst word, and those that both the machine and the counts speak against.
        witness = [np.union1d(x[np.argmax(scores[x])], x[(scores[x] > 0) & (told[x] >= TELLING)]) for x in own]
        witness = np.concatenate(witness)
        x = np.concatenate([points[witness], points[clean]])
        y = np.concatenate([np.ones(len(witness)), -np.ones(len(clean))])
        pull = np.concatenate([np.full(len(witness), WITNESS), clean_weight])
        w = squared_hinge(x, y, pull)
        scores = points @ w[:-1] + w[-1]
    facts = np.zeros((len(bags), 3))
    for k, bag in enumerate(bags):
        words = [(place[b], c) for b, c in bag.items() if len(b) >= 3]
        each = np.repeat([scores[p] for p, _ in words], [c for _, c in words]) if words else np.zeros(0)
        facts[k] = document_facts(each, np.zeros(len(each), np.int64), 1)[0]
    return Machine(marks, whiten @ w[:-1], float(w[-1]), logistic(facts, labels.astype(float), weight), n_marks)


def landmarks(toxic: list[bytes], sure: set[bytes], spanned: list[bytes], clean: list[bytes]) -> tuple[list[bytes], int]:
    """The words and phrases most telling of toxic documents, no two nearly alike, and frequent clean words.

    Also how many are phrases or of the ``sure`` words; they come first.
    """

    def alike(word: bytes, others: list[bytes]) -> bool:
        return bool(others) and scaled_kernel([word], others).max() >= 0.6

    marks: list[bytes] = []
    for words, most in ((toxic[:1500], LANDMARKS * 4 // 5), (clean[:200], LANDMARKS)):
        for word in words:
            short = word[:LANDMARK_BYTES]
            if len(marks) < most and len(short) >= 3 and short not in marks and not alike(short, marks):
                marks.append(short)
    heads = {w[:LANDMARK_BYTES] for w in sure}
    several: list[bytes] = []
    for phrase in spanned:
        if len(several) < PHRASES and not alike(phrase, several):
            several.append(phrase)
    first = [x for x in marks if x in heads] + several
    return first + [x for x in marks if x not in heads], len(first)


def train(docs: DataFrame, labels: DataFrame, most_toxic: int, most_clean: int) -> Machine | float:
    """Words of a bounded sample of documents of either label come to the driver; see ``fit``.

    Rows that repeat an id count by their largest label; null labels and ids are left out.
    """
    rows = narrow(labels, "doc_id", "toxic").toDF("_id", "_label").dropna()
    rows = rows.where(remainder(F.col("_id"), FOLDS) != HELD_OUT)
    rows = rows.groupBy("_id").agg((F.max("_label") > 0).cast("int").alias("_label"))
    turn = F.xxhash64("_id")
    chosen = rows.where("_label = 1").orderBy(turn, "_id").limit(most_toxic)
    chosen = chosen.union(rows.where("_label = 0").orderBy(turn, "_id").limit(most_clean))
    ratio = dict(rows.groupBy("_label").count().collect())
    sampled = documents(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    found = sampled.select("_id", "_label", "text").mapInArrow(word_bags, "_id long, _label int, words binary").collect()
    found = sorted((r["_id"], r["_label"], bytes(r["words"])) for r in found)
    sequences = [r[2].split(b"\n") for r in found]
    own = np.array([r[1] for r in found])
    weight = np.array([ratio[k] / (own == k).sum() for k in own]) if len(own) else np.zeros(0)
    return fit(sequences, own, weight)


def word_bags(batches):
    for batch in batches:
        for first, past, data, starts in text_blocks(batch.column("text")):
            low, a, b, of, sentence = word_spans(data, starts)
            raw, words = low.tobytes(), [[] for _ in range(past - first)]
            ends = np.append(sentence[1:] > sentence[:-1], True)[: len(a)]
            for k, begin, end, last in zip(of.tolist(), a.tolist(), b.tolist(), ends.tolist()):
                words[k] += [raw[begin:end], b""] if last else [raw[begin:end]]
            own = batch.slice(first, past - first)
            yield pa.RecordBatch.from_arrays(
                [own.column("_id"), own.column("_label"), pa.array([b"\n".join(w) for w in words], pa.binary())],
                names=["_id", "_label", "words"],
            )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    spark: SparkSession,
    most_toxic: int = SAMPLE_TOXIC,
    most_clean: int = SAMPLE_CLEAN,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_toxic_words.

    Texts are the only input of a score. A null or empty text scores as one whose words are like
    no insult. Texts are taken whole, whatever their length. A null id belongs to the fold of
    the empty text. Without labels every score is 0.5, with one label it is that one.
    """
    machine = train(docs, labels, most_toxic, most_clean)
    rows = documents(docs).mapInArrow(
        lambda batches: judged(batches, machine), "doc_id long, score double, n_toxic_words long"
    )
    return rows.select(
        "doc_id",
        (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_toxic_words",
    )


class WordScores:
    """Scores of words and windows, each computed once as long as its place in a table is its own."""

    def __init__(self, machine: Machine, bits: int = 21) -> None:
        self.machine, self.powers, self.mask = machine, Powers(), np.uint64((1 << bits) - 1)
        self.hash_at = np.zeros(1 << bits, np.uint64)
        self.hash_at[0] = 1  # not a hash that belongs there
        self.score_at, self.parts_at = np.zeros(1 << bits, np.float32), np.zeros(1 << bits, np.uint64)

    def of(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of each word and window of the texts, and which text it is in."""
        low, a, b, of, sentence = word_spans(data, starts)
        scores, parts = self.scored(low, a, b)
        gap = low == GAP
        again = gap.copy()
        again[1:] &= gap[:-1]
        again[:1] = False
        single = np.concatenate([[0], np.cumsum(~again)])
        first, last = windows(parts, sentence, single[a], single[b])
        if not len(first):
            return scores, of
        # Each run of gaps as one, and none.
        for left in (~again, ~gap):
            kept = np.concatenate([[0], np.cumsum(left)])
            more, _ = self.scored(low[left], kept[a[first]], kept[b[last]])
            scores, of = np.concatenate([scores, more]), np.concatenate([of, of[first]])
        return scores, of

    def scored(self, low: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and landmarks of each span of the bytes."""
        hashes = span_hashes(low, a, b, self.powers)
        place = (hashes & self.mask).astype(np.int64)
        scores, parts = self.score_at[place], self.parts_at[place]
        missed = np.flatnonzero(self.hash_at[place] != hashes)
        if len(missed):
            distinct, where, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
            raw, at = low.tobytes(), missed[where]
            fresh, own = self.machine.words([raw[x:y] for x, y in zip(a[at].tolist(), b[at].tolist())])
            fresh = fresh.astype(np.float32)
            scores[missed], parts[missed] = fresh[which], own[which]
            # Of new ones with one place, the last has it.
            slot = place[at]
            self.hash_at[slot], self.score_at[slot], self.parts_at[slot] = distinct, fresh, own
        return scores, parts


def judged(batches, machine: Machine | float):
    scores = WordScores(machine) if isinstance(machine, Machine) else None
    for batch in batches:
        out, hits = [np.zeros(0)], [np.zeros(0, np.int64)]
        for first, past, data, starts in text_blocks(batch.column("text")):
            if scores is None:
                out.append(np.full(past - first, machine))
                hits.append(np.zeros(past - first, np.int64))
                continue
            each, of = scores.of(data, starts)
            out.append(machine.documents(document_facts(each, of, past - first)))
            hits.append(np.bincount(of, weights=each > 0, minlength=past - first).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(out)), pa.array(np.concatenate(hits))],
            names=["doc_id", "score", "n_toxic_words"],
        )
