"""Hard negatives, lexical search and line dedup against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from tallymart.llm import hard_negatives, jaccard_join, lexical_search, line_dedup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VECTORS = "vec_id long, embedding array<float>, label int, row int, chunk string"


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(brute.hard_rows(), brute.SCHEMA)


# hard negatives


def plain_negatives(rows, every=100):
    whole = []
    for vec_id, vector, label, *_ in rows:
        if label is None or vector is None or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        shifted = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        whole.append((vec_id, shifted, [math.floor(256 * float(np.float32(x))) for x in vector]))
    key = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for k, (vec_id, label, own) in enumerate(whole):
        if vec_id is None or vec_id % every:
            continue
        met = [(i, sum(a * b for a, b in zip(own, v)), other) for j, (i, other, v) in enumerate(whole) if j != k]
        positives = sorted([(i, s) for i, s, other in met if other == label], key=key)[:5]
        for p, p_score in positives:
            fit = [(i, s) for i, s, other in met if other != label and 30 * p_score <= 100 * s <= 90 * p_score]
            for rank, (i, s) in enumerate(sorted(fit, key=key)[:10], 1):
                out.append((vec_id, p, rank, i, p_score, s))
    return Counter(out)


def vectors(seed, n, dims, labels=10, spread=1.0):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, dims))
    found = centres[random.integers(0, 6, n)] + spread * random.normal(size=(n, dims))
    found /= np.linalg.norm(found, axis=1)[:, None]
    return [(k, [float(np.float32(x)) for x in v], int(random.integers(0, labels)), k % 3, "x") for k, v in enumerate(found)]


@pytest.mark.parametrize("dims, spread, labels", [(64, 1.0, 10), (64, 0.1, 3), (5, 0.5, 10), (19, 0.3, 2)])
def test_hard_negatives(spark, dims, spread, labels):
    rows = vectors(dims, 700, dims, labels, spread)
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), spark)
    assert bag(found.collect()) == plain_negatives(rows)


def test_hard_negatives_over_many_groups_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 100)
    monkeypatch.setattr(hard_negatives, "PAIRS", 300)
    rows = vectors(9, 900, 12, 4, 0.2)
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), spark, every=10)
    assert bag(found.collect()) == plain_negatives(rows, 10)


def test_hard_negatives_of_odd_rows(spark):
    """Nulls, no numbers, unequal and empty vectors, repeated ids and rows, equal scores, a hot label."""
    rows = vectors(3, 300, 6, 4, 0.3)
    twin = rows[5]
    rows += [(None, twin[1], 1, 0, "x"), (None, twin[1], 2, 0, "x"), (100, rows[100][1], rows[100][2], 0, "x"), (100, rows[100][1], 3, 0, "x")]
    rows += [(1000 + k, twin[1], k % 2, 0, "x") for k in range(40)]
    rows += [(700, [0.5, None], 1, 0, "x"), (800, [float("nan")] * 6, 1, 0, "x"), (900, [float("inf")] * 6, 1, 0, "x")]
    rows += [(1100, None, 1, 0, "x"), (1200, twin[1], None, 0, "x"), (1300, [], 1, 0, "x"), (1400, [0.7, 0.7], 1, 0, "x"), (1500, [0.0] * 6, 2, 0, "x")]
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), spark)
    assert bag(found.collect()) == plain_negatives(rows)
    big = [(k * 100, [3e38 * (-1) ** k, 1.0], k % 2, 0, "x") for k in range(8)]
    assert hard_negatives.hard_negatives(spark.createDataFrame(big, VECTORS), spark).count() >= 0


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 2, 0, "x")], [(100, [1.0], 2, 0, "x")], [(100, [], 2, 0, "x"), (200, [], 2, 0, "x")]])
def test_hard_negatives_of_small_tables(spark, rows):
    assert hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), spark).count() == 0


def test_threshold_join_leaves_nothing_out():
    random = np.random.default_rng(4)
    for scale in (20, 3000, 1 << 27):
        a, b = (random.integers(-scale, scale, (n, 21)) for n in (13, 170))
        asked, index = (sides(x) for x in (a, b))
        scores = a @ b.T
        for share in (-1.0, 0.0, 0.2, 0.6, 0.9):
            at_least = np.floor(scores.max(axis=1) * share)
            x, y, s = hard_negatives.threshold_join(asked, index, at_least)
            want = np.nonzero(scores >= at_least[:, None])
            assert set(zip(x.tolist(), y.tolist())) == set(zip(*(w.tolist() for w in want)))
            assert (scores[x, y] == s).all()


def sides(values):
    import pyarrow as pa

    n = np.arange(len(values))
    raw = pa.array([v.astype(np.int64).tobytes() for v in values], pa.binary())
    return hard_negatives.Rows(pa.RecordBatch.from_arrays([pa.array(n), pa.array(n), pa.array(n), raw], names=["row", "vec_id", "label", "vec"]), values.shape[1])


# lexical search


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_search(docs, items, top=20):
    own = [(i, Counter(plain_terms(t))) for i, t in docs]
    own = [(i, c, c.total()) for i, c in own if c]
    number, length, held = len(own), sum(n for _, _, n in own), Counter(t for _, c, _ in own for t in c)
    weight = {t: math.floor(1000 * math.log((2 * number + 2) / (2 * n + 1))) for t, n in held.items()}
    out = []
    for item_id, text in items:
        asked, scores = Counter(plain_terms(text)), []
        for doc_id, c, n in own:
            m = 100 - 25 + (25 * n * number) // length
            s = sum(times * weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in asked.items() if t in c)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


ITEMS = [
    (1, "the an er"), (2, None), (3, ""), (4, " ,.;"), (5, "ONE one Один русский"), (5, "one"), (None, "text quite alone a b"),
    (6, brute.prose(1, 90)), (6, brute.prose(1, 90)), (7, "12 34 x"), (8, "word-that-nobody_has"),
]


@pytest.mark.parametrize("most_pairs", [1 << 20, 20])
def test_lexical_search(spark, hard, most_pairs):
    items = spark.createDataFrame([(*x, 1, "s") for x in ITEMS], "item_id long, text string, rank int, score string")
    found = lexical_search.search(hard.repartition(5), items, spark, most_pairs=most_pairs)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert bag(found.collect()) == plain_search([r[:2] for r in brute.hard_rows()], ITEMS)


def test_lexical_search_of_empty_tables(spark, hard):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    nothing = spark.createDataFrame([], brute.SCHEMA)
    assert lexical_search.search(nothing, items, spark).count() == 0
    assert lexical_search.search(hard, items.limit(0), spark).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ,")], "doc_id long, text string")
    assert lexical_search.search(blank, items, spark).count() == 0


def test_long_texts_are_counted_in_slices(monkeypatch):
    monkeypatch.setattr(lexical_search, "SLICE", 7)
    for text in ("aa bb cc aa dd ee", "x" * 100, "x" * 20 + " y", "", "Äb-Äb " * 9, " " * 50):
        assert lexical_search.term_counts(text.encode()) == Counter(t.encode() for t in plain_terms(text))


# line dedup


def plain_lines(rows):
    held = defaultdict(list)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    for k, (_, text) in enumerate(rows):
        for line in {key(x) for x in (text or "").split("\n")}:
            held[line].append(k)
    keeper = {}
    for line, own in held.items():
        if len(line) >= 20 and len(own) >= 3:
            keeper[line] = max((rows[k][0] for k in own if rows[k][0] is not None), default=None)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def deduped(spark, table):
    kept = line_dedup.kept_texts(table, line_dedup.line_dedup(table, spark))
    rows = kept.collect()
    assert all(hashlib.sha256(r.kept_text).hexdigest() == r.kept_sha256 for r in rows)
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows)


def test_line_dedup_of_hard_rows(spark, hard):
    assert deduped(spark, hard) == plain_lines([r[:2] for r in brute.hard_rows()])


@pytest.mark.parametrize("parts", ["1", "3", "61"])
def test_lines_over_the_edges_of_ranges(spark, parts):
    """A line in all documents, many times in some; lines in two, three and four; null and repeated ids."""
    common, before = "This Line stands in very many documents é", spark.conf.get("spark.sql.shuffle.partitions")
    rows = []
    for k in range(300):
        lines = [f"head {k}", f"  {common}\t", f"own line number {k} of some length", f"{common.upper()}\r", ""] + [common] * (k % 4)
        lines += [f"line that few documents hold {k // n * n} {n}" for n in (2, 3, 4)]
        rows.append((k if k % 5 else None, "\n".join(lines)))
    rows += [(299, rows[299][1]), (299, common), (298, rows[298][1])]
    rows += [(None, "only null ids hold this line\nx"), (None, "only null ids hold this line\ny"), (None, "only null ids hold this line")]
    rows += [(400 + k, "ä" * 19 + f"\n{'ö' * 20}\n{'short line' * 1}") for k in range(4)]
    rows += [(500, "\n".join([common, "z"] * 3000))]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert deduped(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == plain_lines(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_keep_bitmaps_hold_no_text(spark):
    rows = [(k, f"first {k}\nA line that three documents hold\nlast") for k in range(3)]
    found = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), spark)
    assert "text" not in found.columns
    assert {r.doc_id: r.n_dropped for r in found.collect()} == {0: 1, 1: 1}


def test_line_dedup_of_an_empty_table(spark):
    assert not deduped(spark, spark.createDataFrame([], brute.SCHEMA))


def test_links_between_the_same_two_components_count_once(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (5, 9), (1, 3)], "a long, b long")
    roots = spark.createDataFrame([(1, 1), (3, 1), (2, 2), (4, 2)], "node long, root long")
    found = [tuple(r) for r in jaccard_join.between(links, roots).collect()]
    assert sorted(found) == [(1, 2), (5, 9)]
