"""The stages against plain versions of their decisions."""

import re
from collections import Counter

import brute
import corpus_pipeline
import pytest

from tallymart.llm import catalogue, mixing, quality_classifier
from tallymart.llm.common import staged


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    docs = [catalogue.read(spark, sf_dir, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(staged(stage(spark, docs[-1], sf_dir), "stage", spark))
    return docs


def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_columns(kept):
    assert all(d.columns == kept[0].columns for d in kept[:-1])


def test_quality_stage(spark, kept, sf_dir):
    found = quality_classifier.classify(kept[0], catalogue.read(spark, sf_dir, "labels"), spark)
    want = {r.doc_id for r in found.where("predicted = 1").collect()}
    assert {i for i, _ in rows(kept[1])} == want and 0 < len(want) < kept[0].count()


def test_exact_stage(kept):
    want = {ids for ids, _, _ in brute.copies(rows(kept[1])).values()}
    assert sorted(i for i, _ in rows(kept[2])) == sorted(want)


def test_near_stage(kept):
    want = sorted(i for i, _, least in brute.near_components(rows(kept[2])) if i == least)
    assert sorted(i for i, _ in rows(kept[3])) == want


def test_mixing_stage(spark, kept):
    want = Counter({r.doc_id: r.copies for r in mixing.mix(kept[3], spark).collect() if r.copies})
    assert Counter(i for i, _ in rows(kept[4])) == want


def test_packing_stage(kept):
    pieces = kept[5].collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(i for i, _ in rows(kept[4]))
    assert not re.search("text", " ".join(kept[5].columns))


def test_run(spark, sf_dir, kept):
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[5].count()
