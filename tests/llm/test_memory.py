"""What one worker holds is bounded, whatever the rows are."""

import re
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tallymart.llm import catalogue, common, exact_dedup, jaccard_join, packing, quality_classifier, suffix_dedup


def peak(work) -> int:
    """Bytes that ``work`` holds beyond what there was."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def texts(n: int, size: int = 4000) -> pa.RecordBatch:
    random = np.random.default_rng(3)
    columns = {"text": [random.integers(97, 123, size, np.uint8).tobytes().decode() for _ in range(n)]}
    columns |= {name: list(range(n)) for name in ("id", "hash", "_id")}
    return pa.RecordBatch.from_pydict(columns | {"_label": pa.array([k % 2 for k in range(n)], pa.int32())})


def run_remove(spark, docs):
    suffix_dedup.remove_repeats(docs, spark)


def run_near(spark, docs):
    jaccard_join.near_components(docs, spark)


def run_train(spark, docs):
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    quality_classifier.train(docs, labels)


@pytest.mark.parametrize("work", [run_remove, run_near, run_train])
def test_texts_go_to_python_in_small_batches(spark, work):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    some = spark.range(60).selectExpr("id as doc_id", "concat('some text of number ', id) as text")
    spark.conf.unset(common.BATCH_KEY)
    try:
        work(spark, some)
        many = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat(cast(id % 10 as string), 4000) as text")
        assert max(r.n for r in many.mapInArrow(sizes, "n long").collect()) < 5 << 20  # 12 MB in all
        spark.conf.set(common.BATCH_KEY, "1m")
        work(spark, some)
        assert spark.conf.get(common.BATCH_KEY) == "1m"  # a bound of the session's own stays
    finally:
        spark.conf.unset(common.BATCH_KEY)


def test_anchor_rows_hold_few_numbers_a_byte():
    batch = texts(1000)
    suffix_dedup.POWERS.first(1 << 21)
    assert peak(lambda: [len(x) for x in suffix_dedup.anchor_rows([batch], 100, 32)]) < 30 << 20


def test_meeting_strings_hold_bounded_grids():
    random = np.random.default_rng(5)
    n = 20_000
    raw = [random.integers(0, 256, 168, np.uint8).tobytes() for _ in range(n)]
    names = ["half", "before", "part", "parts", "id", "hash", "place", "lead", "bytes"]
    numbers = [np.arange(n), np.ones(n, bool), np.zeros(n, np.int32), np.ones(n, np.int32), np.arange(n), np.arange(n)]
    numbers += [np.full(n, 68, np.int32), np.full(n, 68, np.int32)]
    table = pa.table([*map(pa.array, numbers), pa.array(raw)], names=names)
    assert peak(lambda: suffix_dedup.met(table, 100, 32)) < 120 << 20


def test_passages_of_a_batch_are_made_in_small_blocks():
    batch = texts(1000)
    assert peak(lambda: [len(x) for x in quality_classifier.encoded([batch])]) < 40 << 20


def test_tally_counts_exactly_and_holds_little_more_than_its_numbers():
    random = np.random.default_rng(7)
    parts = [np.unique(random.integers(0, 1 << 20, 40_000).astype(np.uint64) * common.MIX_1) for _ in range(60)]
    tally = jaccard_join.Tally()

    def work():
        for part in parts:
            tally.add(part)
        tally.settle()

    assert peak(work) < 48 << 20
    grams, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert np.array_equal(tally.grams, grams) and np.array_equal(tally.counts, counts)


def test_tally_of_nothing():
    tally = jaccard_join.Tally()
    tally.settle()
    assert len(tally.grams) == len(tally.counts) == 0


@pytest.mark.parametrize("length, gram", [(100, 32), (20, 8), (12, 2), (9, 9), (400, 200)])
def test_halves_are_equal_where_their_bytes_are(length, gram):
    random = np.random.default_rng(length)
    data = random.integers(97, 99, 3000, np.uint8)
    data[2000:2500] = data[500:1000]
    own = suffix_dedup.gram_buckets(data, suffix_dedup.running_sums(data), gram)
    more = (length - gram) // 2
    begins = np.arange(len(data) - gram - more + 1)
    found = suffix_dedup.beside(own, begins, gram, more)
    want = [data[b : b + gram + more].tobytes() for b in begins]
    assert len(set(zip(found.tolist(), want))) == len(set(found.tolist())) == len(set(want))


def run_pack(spark, docs):
    packing.pack(docs, spark, catalogue.tokenizer("word_bpe_49k.json"))


def run_exact(spark, docs):
    exact_dedup.exact_dedup(docs, spark)


@pytest.mark.parametrize("work", [run_pack, run_exact])
def test_packing_and_exact_dedup_ask_for_small_batches(spark, work):
    some = spark.range(60).selectExpr("id as doc_id", "concat('some text of number ', id) as text")
    spark.conf.unset(common.BATCH_KEY)
    try:
        work(spark, some)
        assert spark.conf.get(common.BATCH_KEY) == str(common.BATCH_BYTES)
        spark.conf.set(common.BATCH_KEY, "1m")
        work(spark, some)
        assert spark.conf.get(common.BATCH_KEY) == "1m"  # a bound of the session's own stays
    finally:
        spark.conf.unset(common.BATCH_KEY)


def worded(n: int) -> pa.RecordBatch:
    """Texts of 4,000 bytes and more, with 2,000 distinct words in all."""
    random = np.random.default_rng(11)
    words = ["".join(map(chr, random.integers(97, 123, 7))) for _ in range(2000)]
    columns = {"text": [" ".join(words[k] for k in random.integers(0, 2000, 500)) for _ in range(n)]}
    return pa.RecordBatch.from_pydict(columns | {name: list(range(n)) for name in ("doc_id", "row")})


def test_pieces_are_made_in_small_blocks():
    path, batch = catalogue.tokenizer("word_bpe_49k.json"), worded(1000)
    list(packing.token_pieces([batch], path, 4096, 1))  # the worker's table of units is there
    packing.UnitTokens.of_worker(path).powers = common.Powers()
    assert peak(lambda: [len(x) for x in packing.token_pieces([batch], path, 4096, 1)]) < 40 << 20


@pytest.mark.parametrize("rows", [exact_dedup.recipes, exact_dedup.distinct_chunks])
def test_chunks_are_cut_in_small_blocks(rows):
    batch = worded(1000)
    assert peak(lambda: [len(x) for x in rows([batch], exact_dedup.CUTTER, xxhash.xxh3_128_digest)]) < 40 << 20


def held() -> int:
    """Bytes of this process that no file backs."""
    rollup = Path("/proc/self/smaps_rollup").read_text()
    return 1024 * sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", rollup)))


def test_a_task_gives_its_memory_back():
    @common.tidy
    def rows(n):
        small = [bytes(30_000) for _ in range(n)]  # below the size that the system takes back by itself
        yield len(small)
        pins.append(bytes(1000))
        del small

    pins, before = [], held()
    for n in rows(4000):
        assert n == 4000 and held() - before > 100 << 20
    assert held() - before < 30 << 20


def test_other_tasks_forget_the_units_of_packing():
    path, batch = catalogue.tokenizer("word_bpe_49k.json"), worded(10)
    list(packing.token_pieces([batch], path, 4096, 1))
    kept = packing.UnitTokens.of_worker(path)
    list(packing.token_pieces([batch], path, 4096, 1))
    assert packing.UnitTokens.of_worker(path) is kept  # from task to task of packing
    list(exact_dedup.recipes([batch], exact_dedup.CUTTER, xxhash.xxh3_128_digest))
    assert common.KEPT_UNITS not in sys.modules


@pytest.mark.parametrize("hit", [True, False])
def test_the_bit_map_is_looked_up_without_python(spark, hit):
    rows = spark.range(3000).selectExpr("id as doc_id", "concat('text ', id) as text")
    marked = spark.range(0, 6000, 7).selectExpr("id as doc_id")
    found = common.sifted(rows, marked, ["doc_id"], hit)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    kept = {r.doc_id for r in found.collect()}
    true = {k for k in range(3000) if (k % 7 == 0) == hit}
    wrong = kept ^ true
    assert len(wrong) < 5 and not (true - kept if hit else kept - true)


def test_a_table_without_rows_starts_no_python(spark):
    table = common.without_rows("digest binary, content binary, variant int", spark)
    assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()
    assert table.dtypes == [("digest", "binary"), ("content", "binary"), ("variant", "int")] and table.isEmpty()
