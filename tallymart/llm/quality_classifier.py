"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by a small trained layer; gated
attention weighs the passages; the weighted representation is scored. Only documents have
labels: attention learns from them which passages speak for or against a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import (
    FINE_BYTES,
    Powers,
    documents,
    narrow,
    remainder,
    small_batches,
    span_hashes,
    spread,
    text_blocks,
    tidy,
    word_bounds,
)

#: Bytes of a passage.
PASSAGE = 512
#: Labelled rows that the model is fitted on, at most; those with the smallest hashes of their id.
SAMPLE = 6000
FOLDS, HELD_OUT = 3, 1

SIGNS = ["#", "*", "$", "%", "&", "|", "<>", "!", "?", ".", ",", "'\"", ";:", "-_", "()[]{}", "=/\\@+^~`"]


def byte_classes() -> np.ndarray:
    classes = np.zeros(256, np.int64)  # 0: control bytes
    classes[97:123], classes[65:91], classes[48:58] = 1, 2, 3
    classes[[9, 11, 12, 13, 32]], classes[10], classes[128:] = 4, 5, 6
    for k, group in enumerate(SIGNS, 7):
        classes[[ord(c) for c in group]] = k
    return classes


CLASSES = byte_classes()
KINDS = 7 + len(SIGNS)
WORD_FACTS = 6
WIDTH = KINDS + WORD_FACTS


def passages(data: np.ndarray, starts: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Facts of each passage of each text (an empty text has one), and how many each text has."""
    lengths = np.diff(starts)
    counts = np.maximum(1, -(-lengths // PASSAGE))
    firsts = np.cumsum(counts) - counts
    total = int(counts.sum())
    doc = np.repeat(np.arange(len(lengths)), lengths)
    own = firsts[doc] + (np.arange(len(data)) - starts[doc]) // PASSAGE
    kinds = np.bincount(own * KINDS + CLASSES[data], minlength=total * KINDS).reshape(total, KINDS).astype(np.float64)
    size = kinds.sum(axis=1)
    facts = np.zeros((total, WORD_FACTS))
    spaced, begin = spread(data, starts)
    a, b = word_bounds(spaced)
    if len(a):
        of = np.searchsorted(begin, a, side="right") - 1
        at = firsts[of] + (a - begin[of]) // PASSAGE
        hashes = span_hashes(spaced, a, b, powers)
        words = np.bincount(at, minlength=total)
        same = np.zeros(len(a), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        # Words and word pairs of a text that have been in it before.
        again = repeated(hashes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        pair = hashes * np.uint64(3) + of.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        pair[1:] += hashes[:-1]
        pair_again = repeated(pair)
        some = np.maximum(words, 1)
        facts[:, 0] = np.bincount(at, weights=same, minlength=total) / some
        facts[:, 1] = np.bincount(at, weights=again, minlength=total) / some
        facts[:, 2] = np.bincount(at, weights=pair_again, minlength=total) / some
        facts[:, 3] = np.bincount(at, weights=np.minimum(b - a, 40), minlength=total) / some / 10
        facts[:, 4] = np.bincount(at, weights=b - a <= 3, minlength=total) / some
    facts[:, 5] = np.log1p(size) / np.log1p(PASSAGE)
    return np.hstack([np.sqrt(kinds / np.maximum(size, 1)[:, None]), facts]), counts


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values have an equal one before them."""
    order = np.argsort(values, kind="stable")
    out = np.zeros(len(values), bool)
    out[order[1:]] = values[order[1:]] == values[order[:-1]]
    return out


@dataclass
class AttentionModel:
    """Weights of encoder, gated attention and score; ``prior`` stands alone where nothing was learnt."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float | None = None

    def forward(self, facts: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w, firsts = self.weights, np.cumsum(counts) - counts
        x = (facts - self.mean) / self.scale
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
        e = (t * g) @ w["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, firsts), counts))
        a = e / np.repeat(np.add.reduceat(e, firsts), counts)
        z = np.add.reduceat(a[:, None] * h, firsts)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": sigmoid(z @ w["c"] + w["d"])}

    def scores(self, facts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(counts), self.prior)
        return self.forward(facts, counts)["p"]

    def gradients(self, facts: np.ndarray, counts: np.ndarray, labels: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        w, f, firsts = self.weights, self.forward(facts, counts), np.cumsum(counts) - counts
        error = (f["p"] - labels) / len(labels)
        back = np.repeat(error, counts)[:, None] * w["c"]
        through = (back * f["h"]).sum(axis=1)
        e = f["a"] * (through - np.repeat(np.add.reduceat(f["a"] * through, firsts), counts))
        gate = e[:, None] * w["w"]
        t, g = gate * f["g"] * (1 - f["t"] ** 2), gate * f["t"] * f["g"] * (1 - f["g"])
        h = (f["a"][:, None] * back + t @ w["V"].T + g @ w["U"].T) * (1 - f["h"] ** 2)
        out = {"W": f["x"].T @ h, "b": h.sum(axis=0), "V": f["h"].T @ t, "U": f["h"].T @ g}
        out |= {"w": (f["t"] * f["g"]).T @ e, "c": f["z"].T @ error, "d": error.sum(keepdims=True)}
        return {k: v + decay * w[k] for k, v in out.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(
    facts: np.ndarray, counts: np.ndarray, labels: np.ndarray, hidden: int = 16, rounds: int = 300, decay: float = 1e-4
) -> AttentionModel:
    """Fitted by Adam on all documents at once. With one label or none, that share is the score."""
    nothing = np.zeros(facts.shape[1])
    if len(set(labels.tolist())) < 2:
        return AttentionModel(nothing, nothing + 1, {}, float(labels.mean()) if len(labels) else 0.5)
    random = np.random.default_rng(5)
    shapes = {"W": (facts.shape[1], hidden), "b": (hidden,), "V": (hidden, 8), "U": (hidden, 8), "w": (8,), "c": (hidden,)}
    weights = {k: random.normal(0, 1 / np.sqrt(s[0]), s) * (k != "b") for k, s in shapes.items()}
    weights["d"] = np.zeros(1)
    model = AttentionModel(facts.mean(axis=0), facts.std(axis=0) + 1e-3, weights)
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    for turn in range(1, rounds + 1):
        for k, slope in model.gradients(facts, counts, labels, decay).items():
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope**2
            step = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
            weights[k] = weights[k] - 0.03 * step
    return model


def training_rows(labels: DataFrame, label: str, folds: int, held_out: int, sample: int) -> DataFrame:
    """_id and _label of at most ``sample`` labelled ids outside the held-out fold.

    Of rows that repeat an id the smallest label counts; null labels and ids are left out.
    """
    rows = narrow(labels, "doc_id", label).toDF("_id", "_label").dropna()
    rows = rows.where(remainder(F.col("_id"), folds) != held_out)
    rows = rows.groupBy("_id").agg(F.min("_label").cast("int").alias("_label"))
    return rows.orderBy(F.xxhash64("_id"), "_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionModel:
    """Passages of a bounded sample of labelled documents come to the driver, and the model is fitted there."""
    small_batches(docs.sparkSession)
    chosen = training_rows(labels, "quality", FOLDS, HELD_OUT, sample)
    rows = documents(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    bags = rows.select("_id", "_label", "text").mapInArrow(encoded, "_id long, _label int, n int, facts binary")
    found = sorted((tuple(r) for r in bags.collect()), key=lambda r: (r[0], bytes(r[3])))
    if not found:
        return fit(np.zeros((0, WIDTH)), np.zeros(0, int), np.zeros(0))
    facts = np.concatenate([np.frombuffer(r[3], np.float32).reshape(-1, WIDTH) for r in found]).astype(np.float64)
    return fit(facts, np.array([r[2] for r in found]), np.array([float(r[1]) for r in found]))


@tidy
def encoded(batches):
    powers = Powers()
    for batch in batches:
        for first, past, data, starts in text_blocks(batch.column("text"), FINE_BYTES):
            facts, counts = passages(data, starts, powers)
            bags = [x.astype(np.float32).tobytes() for x in np.split(facts, np.cumsum(counts)[:-1])]
            own = batch.slice(first, past - first)
            yield pa.RecordBatch.from_arrays(
                [own.column("_id"), own.column("_label"), pa.array(counts, pa.int32()), pa.array(bags, pa.binary())],
                names=["_id", "_label", "n", "facts"],
            )


@tidy
def scored(batches, model: AttentionModel):
    powers = Powers()
    for texts in batches:
        out = [model.scores(*passages(data, starts, powers)) for _, _, data, starts in text_blocks(texts, FINE_BYTES)]
        yield pa.array(np.concatenate([np.zeros(0), *out]), pa.float64())


def quality_score(text: str | Column, model: AttentionModel) -> Column:
    """0 to 1, higher: better. A null text is scored as an empty one, a long one in all its passages."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return scored(batches, model)

    return score(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, spark: SparkSession, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Texts are the only input of a score; equal texts have equal scores. A null id belongs to
    the fold of the empty text. Without labels the score is 0.5, with one label it is that one.
    """
    model = train(docs, labels, sample)
    rows = documents(docs).select("doc_id", quality_score("text", model).alias("score"))
    return rows.select(
        "doc_id",
        (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""
    return docs.withColumn("_llm_score", quality_score("text", model)).where("_llm_score >= 0.5").select(*docs.columns)
