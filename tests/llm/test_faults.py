"""Names of texts and words, one row per component, rules under a filter."""

import re
import time
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import catalogue, jaccard_join, packing, quality_classifier, quality_rules, substring_dedup, suffix_dedup
from tallymart.llm.common import Powers, span_hashes


def thue_morse(turns):
    word = "a"
    for _ in range(turns):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


ONE = thue_morse(10)
OTHER = ONE.translate(str.maketrans("ab", "ba"))


def hashes(*words):
    data = np.frombuffer(" ".join(words).encode() + b" ", np.uint8)
    ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
    return span_hashes(data, np.concatenate([[0], ends[:-1] + 1]), ends, Powers())


def test_words_in_thue_morse_order_are_two_words(spark):
    found = hashes(ONE, OTHER, ONE, "x" + ONE)
    assert found[0] == found[2] and len(set(found.tolist())) == 3
    table = spark.createDataFrame([(1, f"{ONE} b c d e"), (2, f"{OTHER} b c d e")], "doc_id long, text string")
    assert {r.component_id for r in jaccard_join.near_components(table, spark).collect()} == {1, 2}
    units = packing.UnitTokens(catalogue.tokenizer("word_bpe_49k.json"))
    data = np.frombuffer(f"{ONE} {OTHER}".encode(), np.uint8)
    ids, counts = units.tokens(data, np.array([0, len(ONE) + 1, len(data)]))
    assert ids.tolist() == [*units.encode(ONE), *units.encode(OTHER)] and counts.sum() == len(ids)
    facts = quality_classifier.passages(np.frombuffer(f"{ONE} {OTHER} ".encode() * 20, np.uint8), np.array([0, 40 * (len(ONE) + 1)]), Powers())
    assert len(facts[0])


def test_hashes_do_not_depend_on_place_or_length_of_what_stands_before():
    import tallymart.llm.common as common

    words = [brute.prose(k, 1) for k in range(50)]
    alone = [hashes(w)[0] for w in words]
    assert hashes("y" * 5000, *words)[1:].tolist() == alone
    before, common.PRIME_RUN = common.PRIME_RUN, 7
    try:
        assert hashes("y" * 5000, *words)[1:].tolist() == alone
    finally:
        common.PRIME_RUN = before


def test_unit_tables_with_few_places_and_limits():
    path = catalogue.tokenizer("word_bpe_49k.json")
    small, tiny = packing.UnitTokens(path, bits=3), packing.UnitTokens(path, most=10)
    for k in range(3):
        text = brute.prose(k, 300) + " it's 12ab naïve 'x' <b> "
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.array([0, 0, 100, len(data)])
        want = [small.encode(data[a:b].tobytes().decode()).tolist() for a, b in zip(starts, starts[1:])]
        for units in (small, tiny):
            ids, counts = units.tokens(data, starts)
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


@pytest.mark.parametrize("remove", [substring_dedup.remove_repeated_chunks, suffix_dedup.remove_repeats])
def test_texts_without_an_id_and_with_one_short_hash_keep_their_bytes(spark, remove):
    """Two null-id texts whose 32-bit hashes are equal; the first repeats itself, the second nothing."""
    first, second = brute.prose(1, 60, 5000), brute.prose(2, 60, 5000)
    pool = spark.range(160_000).select(
        F.concat(F.lit(f"{first} {first} "), F.col("id")).alias("a"), F.concat(F.lit(f"{second} "), F.col("id")).alias("b")
    )
    a, b = pool.select("a", F.hash("a").alias("h")), pool.select("b", F.hash("b").alias("h"))
    pair = a.join(b, "h").orderBy("a", "b").first()
    table = spark.createDataFrame([(None, pair.a), (None, pair.b)], "doc_id long, text string")
    found = {bytes(r.kept_text)[:20].decode(): r for r in remove(table, spark).collect()}
    assert found[pair.b[:20]].n_removed == 0 and found[pair.a[:20]].n_removed > 100


def test_exactly_one_row_of_each_component_stays(spark):
    base = brute.prose(1, 120)
    near = [" ".join(w if k != at else "changed" for k, w in enumerate(base.split())) for at in (10, 60, 61)]
    other = brute.prose(7, 80)
    rows = [
        (1, base, "a"), (None, near[0], "b"), (None, "quite alone here", "c"), (1, near[1], "d"), (1, other, "e"), (None, None, "f"), (3, None, "g"),
        (4, other, "h"), (4, other, "h"), (5, brute.prose(9, 50), "i"), (5, brute.prose(9, 50), "i"), (None, brute.prose(11, 50), "j"),
        (None, brute.prose(11, 50), "j"), (6, "", "k"), (6, "", "k"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, component string").repartition(3)
    kept = jaccard_join.one_of_each(table, jaccard_join.near_components(table, spark))
    assert kept.columns == table.columns
    texts = Counter(r.text for r in kept.collect())
    assert sum(texts[t] for t in [base, *near]) == 1 and texts[base] + texts[near[1]] == 1
    assert texts[other] == texts[brute.prose(9, 50)] == texts[brute.prose(11, 50)] == texts["quite alone here"] == 1
    assert texts[None] == 2 and texts[""] == 2 and texts.total() == 9


def test_rules_under_a_filter_stay_linear(spark):
    rows = [(1, brute.prose(1, 40_000, 3000)), (2, "of the " + brute.prose(2, 40_000, 200_000)), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    started = time.time()
    found = quality_rules.judge(docs).where("kept").collect()
    assert time.time() - started < 30
    assert {r.doc_id for r in found} == {k for k, kept in want.items() if kept}


NATIVE = ["op3_quality_rules", "op6_mixing"]


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_plans(name, spark, sf_dir):
    plan = catalogue.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    if name in NATIVE:
        assert not re.search("Python|Arrow|Pandas", plan)


def test_parities_never_differ_in_more_places_than_the_sets(spark):
    """Any two sets differ in at least as many members as their parities in bits."""
    rng = np.random.default_rng(5)
    for size in (0, 1, 5, 60, 400, 3000):
        own = rng.integers(0, 2**64, size, np.uint64)
        other = np.unique(np.concatenate([own[: size * 3 // 4], rng.integers(0, 2**64, size // 5, np.uint64)]))
        own = np.unique(own)
        a, b = jaccard_join.parities([own, other])
        bits = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))
        assert bits <= len(np.setxor1d(own, other))


def test_a_column_of_unlike_rows_makes_few_pairs(spark):
    """Texts that share most of a passage but are too unlike make no pairs; the few links are found."""
    words, rows = brute.prose(3, 160).split(), []
    rng = np.random.default_rng(9)
    for k in range(120):
        own = list(words)
        for at in rng.choice(160, 9, replace=False).tolist():
            own[at] = f"own{k}x{at}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, rows[k][1] + " tail") for k in range(0, 120, 10)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.near_components(table, spark)
    names = ("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in found.select(*names).collect()) == sorted(brute.near_components(rows))
