"""Each operator against its plain version, on hard cases and on the small tables."""

import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from compare import difference, duck

from tallymart.llm import (
    catalogue,
    exact_dedup,
    jaccard_join,
    language_id,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from tallymart.llm.chunking import Cutter
from tallymart.llm.components import components


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(brute.hard_rows(), brute.SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return catalogue.read(spark, sf_dir, "documents")


def plain_rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def counted(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_sql_twins(name, spark, sf_dir):
    assert difference(catalogue.queries()[name](spark, sf_dir), duck(sf_dir), catalogue.oracle_sql()[name]) is None


# exact dedup


def expect_copies(rows):
    groups, out = brute.copies(rows), []
    for r in rows:
        first, size, sha = groups[brute.normal(r[1])]
        out.append((r[0], first, size, sha))
    return Counter(out)


@pytest.mark.parametrize("digest", [None, lambda x: bytes([len(x) % 2])])
def test_exact_dedup_hard_cases(spark, hard, digest):
    """Also with a digest that nearly all chunks share: identifiers are verified by bytes."""
    more = {"digest": digest, "cutter": Cutter(16, 200)} if digest else {}
    found = exact_dedup.exact_dedup(hard, spark, **more)
    rows = found.collect()
    assert counted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expect_copies(brute.hard_rows())
    stays = Counter(r.text_sha256 for r in rows if r.kept)
    assert set(stays.values()) == {1} and set(stays) == {r.text_sha256 for r in rows}
    kept = exact_dedup.without_copies(hard, found)
    assert kept.columns == hard.columns
    assert counted([brute.normal(r.text)] for r in kept.collect()) == counted([x] for x in brute.copies(brute.hard_rows()))


def test_chunks_resist_insertions():
    text = brute.prose(7, 4000).encode()
    cutter = Cutter(24, 128)

    def chunks(raw):
        begins, _ = cutter.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        return [raw[a:b] for a, b in zip(begins, [*begins[1:], len(raw)])]

    before, after = chunks(text), chunks(text[:5000] + b" inserted " + text[5000:])
    assert b"".join(before) == text and max(map(len, before)) <= 128
    assert len(set(before) - set(after)) <= 6


def test_chunks_do_not_depend_on_neighbours():
    texts = [brute.prose(k, 80).encode() for k in range(5)] + [b"", b"short"]
    cutter = Cutter(24, 128)
    joined, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    begins, counts = cutter.cuts(joined, starts)
    for k, own in enumerate(np.split(begins, np.cumsum(counts)[:-1])):
        alone, _ = cutter.cuts(np.frombuffer(texts[k], np.uint8), np.array([0, len(texts[k])]))
        assert (own - starts[k]).tolist() == alone.tolist()


# quality rules


def test_quality_rules(spark, hard, docs):
    for table in (hard, docs):
        rows = plain_rows(table)
        found = quality_rules.judge(table)
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        assert counted(found.select(*names).collect()) == counted((r[0], *brute.counts(r[1])) for r in rows)
        assert found.where("base_failed and kept").count() == 0


def test_quality_rules_run_no_python(docs):
    plan = quality_rules.judge(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


# near copies

NEAR = ["doc_id", "n_shingles", "component_id"]


def test_jaccard_join(spark, hard, docs):
    for table in (hard, docs):
        found = jaccard_join.near_components(table, spark)
        assert counted(found.select(*NEAR).collect()) == counted(brute.near_components(plain_rows(table)))


def test_jaccard_join_of_a_chain_of_near_copies(spark):
    """Neighbours are alike, ends are not; a common line is in all; ids fall."""
    words, rows = brute.prose(11, 200).split(), []
    for k in range(40):
        words[k * 5 % 200] = f"new{k}"
        rows.append((100 - k, " ".join(words)))
    rows += [(200 + k, brute.prose(50 + k, 100) + " " + " ".join(words[:20])) for k in range(30)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.near_components(table, spark)
    assert counted(found.select(*NEAR).collect()) == counted(brute.near_components(rows))


def test_pairs_below_the_bound_are_no_links(spark):
    """Sets whose similarity is 0.75 and a little less, of unequal sizes."""
    rows = []
    for k, (size, more) in enumerate([(28, 0), (30, 10), (30, 11), (300, 100), (300, 101), (7, 2), (7, 3)]):
        base = [f"w{k}x{j}" for j in range(size + 4)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base + [f"v{k}x{j}" for j in range(more)]))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(jaccard_join.near_components(table, spark).select(*NEAR).collect()) == counted(brute.near_components(rows))


def test_components(spark):
    links = [(k, k + 1) for k in range(10, 40)] + [(100, 7), (7, 3), (5, 5), (60, 50), (70, 60), (70, 50)]
    found = dict(components(spark.createDataFrame(links, "a long, b long"), spark).collect())
    assert {found[k] for k in range(10, 41)} == {10}
    assert (found[100], found[7], found[5], found[70]) == (3, 3, 5, 50)


# repeated strings


@pytest.mark.parametrize("length, gram", [(100, 32), (24, 8)])
def test_suffix_dedup(spark, docs, length, gram):
    rows = [r for r in brute.hard_rows() if r[0] not in (9, None)]
    rows += [(40, (b"ab" * 300).decode()), (41, "x" * 99), (42, brute.prose(1, 120)[7:400]), (43, "é" * 120), (44, "é" * 121)]
    rows = [(r[0], r[1]) for r in rows]
    extra = plain_rows(docs) if length == 100 else []
    rows += [(i + 1000, t) for i, t in extra]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(table, spark, length, gram).collect()}
    want = brute.without_repeats([(t or "").encode() for _, t in sorted(rows)], length)
    for (doc_id, text), plain in zip(sorted(rows), want):
        r = found[doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == plain, doc_id
        raw, at, kept = (text or "").encode(), 0, b""
        for span in r.spans:
            kept, at = kept + raw[at : span.begin], span.end
        assert kept + raw[at:] == bytes(r.kept_text)


def test_repeated_rows_in_dedup_of_strings(spark, hard):
    for found in (suffix_dedup.remove_repeats(hard, spark), substring_dedup.remove_repeated_chunks(hard, spark)):
        rows = [r for r in found.collect() if r.doc_id == 9]
        assert len(rows) == 3 and len({(r.n_bytes, r.n_removed, r.kept_sha256) for r in rows}) == 2


def test_substring_dedup_finds_passages(spark):
    """Passages of over 50 words in other texts, shifted by what stands before; the first stays."""
    passages = [brute.prose(900 + k, 60, 5000) for k in range(20)]
    rows = [(k, brute.prose(k, 150, 5000) + " " + p + " " + brute.prose(100 + k, 90, 5000)) for k, p in enumerate(passages)]
    rows += [(100 + k, brute.prose(200 + k, 37 + k, 5000) + "\n" + p) for k, p in enumerate(passages)]
    rows += [(300 + k, brute.prose(400 + k, 200, 5000)) for k in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substring_dedup.remove_repeated_chunks(table, spark).collect()}
    assert all(found[k].n_removed == 0 for k, _ in rows if k < 100 or k >= 300)
    assert sum(found[100 + k].n_removed > 0 for k in range(20)) >= 19
    for doc_id, text in rows:
        r, raw = found[doc_id], text.encode()
        assert raw.startswith(bytes(r.kept_text)[:20]) and len(r.kept_text) + r.n_removed == r.n_bytes == len(raw)


# mixing


def test_targets(spark):
    sizes = {"b": 10, "a": 500, None: 90, "": 1, "é": 0, "z": 333, "zz": 2}
    table = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.targets(table).collect()}
    want = brute.shares(sizes)
    assert found.keys() == want.keys()
    assert all(abs(found[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("block", [4, 128])
def test_mix(spark, hard, docs, block):
    for table in (hard, docs):
        found = mixing.mix(table, spark, block=block)
        rows, again = found.collect(), mixing.mix(table.repartition(3), spark, block=block).collect()
        assert counted(rows) == counted(again)
        words = Counter((r.doc_id, len(re.findall(brute.WORD, r.text or "")), r.source) for r in table.collect())
        assert counted((r.doc_id, r.size, r.source) for r in rows) == words
        sums, most, target = Counter(), Counter(), {}
        for r in rows:
            assert r.taken == r.copies * r.size <= 3 * r.size
            sums[r.source] += r.taken
            most[r.source], target[r.source] = max(most[r.source], r.size), r.target
        assert all(abs(sums[s] - target[s]) <= most[s] for s in target)


def test_mixed_documents(spark, docs):
    found = mixing.mix(docs, spark)
    want = Counter({r.doc_id: r.copies for r in found.collect() if r.copies})
    rows = mixing.mixed_documents(docs, found)
    assert rows.columns == docs.columns
    assert counted([r.doc_id] for r in rows.collect()) == Counter({(k,): n for k, n in want.items()})


def test_mixing_runs_no_python(docs):
    plan = mixing.targets(docs.select("source", mixing.word_count(docs.text).alias("size")))
    assert not re.search("Python|Arrow", plan._jdf.queryExecution().toString())


# packing


@pytest.mark.parametrize("capacity, block", [(4096, 20_000), (200, 50)])
def test_pack(spark, hard, docs, capacity, block):
    from tokenizers import Tokenizer

    path = catalogue.tokenizer("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = [(k, t) for k, t in enumerate(["it's we'll 'tis", "a<|endoftext|>b", "naïve “quoted”. café!", "ＡＢ１２", "é ́x"])]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    for table in (hard, docs, odd):
        want = Counter()
        for doc_id, text in plain_rows(table):
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity]
                want[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
        rows = packing.pack(table, spark, path, capacity=capacity, block=block).collect()
        assert counted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        bins = defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for own in bins.values():
            ends = np.cumsum([n for _, n in sorted(own)])
            assert [a for a, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= capacity
        total = sum(r.length for r in rows)
        if block == 20_000:
            assert len(bins) <= -(-total // capacity) + 1


def test_fullest_is_exact():
    random = np.random.default_rng(3)
    for _ in range(200):
        lengths = np.sort(random.integers(1, 30, random.integers(1, 9)))
        values, starts = np.unique(lengths, return_index=True)
        stacks = {int(v): [int(a), int(b)] for v, a, b in zip(values, starts, [*starts[1:], len(lengths)])}
        room = int(random.integers(0, 60))
        chosen = packing.fullest([int(v) for v in values], stacks, 0, room)
        sums = {0}
        for x in lengths.tolist():
            sums |= {s + x for s in sums}
        assert sum(chosen) == max(s for s in sums if s <= room)
        assert not Counter(chosen) - Counter(lengths.tolist())


# classifiers


def test_attention_gradients():
    random = np.random.default_rng(2)
    facts, counts, labels = random.normal(size=(9, 5)), np.array([2, 4, 3]), np.array([1.0, 0.0, 1.0])
    model = quality_classifier.fit(facts, counts, labels, hidden=4, rounds=3)

    def loss():
        p = model.scores(facts, counts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    slopes = model.gradients(facts, counts, labels, 0.0)
    for name, weight in model.weights.items():
        flat = weight.reshape(-1)
        for k in range(min(3, flat.size)):
            old = flat[k]
            flat[k] = old + 1e-6
            up = loss()
            flat[k] = old - 1e-6
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-6 - np.ravel(slopes[name])[k]) < 1e-5


def held_out_accuracy(found, labels, label):
    rows = found.where("held_out").join(labels.select("doc_id", label).dropna(), "doc_id").collect()
    assert rows
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_quality_classifier(spark, docs, sf_dir):
    labels = catalogue.read(spark, sf_dir, "labels")
    found = quality_classifier.classify(docs, labels, spark)
    assert found.count() == docs.count() and found.where("score < 0 or score > 1").count() == 0
    assert held_out_accuracy(found, labels, "quality") > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found.collect())


def test_toxicity(spark, docs, sf_dir):
    labels = catalogue.read(spark, sf_dir, "labels")
    found = toxicity.judge(docs, labels, spark)
    assert found.count() == docs.count() and found.where("score < 0 or score > 1").count() == 0
    assert held_out_accuracy(found, labels, "toxic") > 0.85


def test_toxicity_tolerates_inserted_characters(spark):
    """Insults with characters put in are found, learnt from plain ones."""
    rows = [(k, brute.prose(k, 50) + (" you numbskull." if k % 3 == 0 else ".")) for k in range(150)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(150)], "doc_id long, toxic int")
    odd = ["numbskull", "n.u.mbskull", "numb-skull!", "NUMBSKULL", "numbskulls", "numbxskull"]
    rows += [(1000 + k, brute.prose(500 + k, 40) + " " + w) for k, w in enumerate(odd)]
    rows += [(2000 + k, brute.prose(700 + k, 40)) for k in range(6)]
    found = toxicity.judge(spark.createDataFrame(rows, "doc_id long, text string"), labels, spark)
    scores = {r.doc_id: r.predicted for r in found.collect()}
    assert [scores[1000 + k] for k in range(len(odd))] == [1] * len(odd)
    assert [scores[2000 + k] for k in range(6)] == [0] * 6


def test_string_kernel_by_definition():
    """Against the sum over all subsequences of three places."""
    from itertools import combinations

    def plain(s, t):
        total, decay = 0.0, float(toxicity.DECAY)
        for a in combinations(range(len(s)), 3):
            for b in combinations(range(len(t)), 3):
                if all(s[x] == t[y] and s[x] != toxicity.GAP for x, y in zip(a, b)):
                    total += decay ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
        return total

    words, marks = [b"idiot", b"id.iot", b"toidi", b"abcabc", b"xyz"], [b"idiot", b"abc"]
    found = toxicity.scaled_kernel(words, marks)
    for k, w in enumerate(words):
        for j, m in enumerate(marks):
            assert abs(found[k, j] - plain(w, m) / np.sqrt(plain(w, w) * plain(m, m))) < 1e-4


def test_language_id(spark, docs):
    found = language_id.identify(docs, spark)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.95


def test_code_lengths_by_definition():
    """Escapes and exclusion, byte by byte, against a plain tree."""
    training, text = b"abracadabra cadabra abraxas", b"abrax zebra"
    symbols = np.full(256, language_id.SYMBOLS - 1, np.uint8)
    alphabet = sorted(set(training))
    symbols[alphabet] = np.arange(len(alphabet))
    counts = np.zeros((1, language_id.SYMBOLS**4))
    codes, _ = language_id.coded(np.frombuffer(training, np.uint8), np.array([0, len(training)]), symbols)
    np.add.at(counts[0], codes, 1)
    trees = language_id.grow(["x"], symbols, counts)
    seen = defaultdict(Counter)
    own = [*symbols[[32] * 3], *symbols[np.frombuffer(training, np.uint8)]]
    for k in range(3, len(own)):
        for order in range(4):
            seen[tuple(own[k - order : k])][own[k]] += 1
    own, bits = [*symbols[[32] * 3], *symbols[np.frombuffer(text, np.uint8)]], 0.0
    for k in range(3, len(own)):
        barred, share = set(), 1.0
        for order in (3, 2, 1, 0):
            now = {s: n for s, n in seen[tuple(own[k - order : k])].items() if s not in barred}
            if own[k] in now:
                share *= now[own[k]] / (sum(now.values()) + len(now))
                break
            if now:
                share *= len(now) / (sum(now.values()) + len(now))
                barred |= now.keys()
        else:
            share /= language_id.SYMBOLS - len(barred)
        bits -= np.log2(share)
    assert abs(trees.lengths(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0, 0] - bits) < 1e-3


# hard and empty tables, everywhere


def everything(spark, table, labels):
    return {
        "substring": substring_dedup.remove_repeated_chunks(table, spark),
        "exact": exact_dedup.exact_dedup(table, spark),
        "rules": quality_rules.judge(table),
        "near": jaccard_join.near_components(table, spark),
        "quality": quality_classifier.classify(table, labels, spark),
        "mix": mixing.mix(table, spark),
        "pack": packing.pack(table, spark, catalogue.tokenizer("word_bpe_49k.json")),
        "suffix": suffix_dedup.remove_repeats(table, spark),
        "toxicity": toxicity.judge(table, labels, spark),
        "language": language_id.identify(table, spark),
    }


def test_hard_tables(spark, hard, docs, sf_dir):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (4, 0, 1), (16, 1, 0)], "doc_id long, quality int, toxic int")
    number = hard.count()
    for name, found in everything(spark, hard, labels).items():
        assert found.count() >= number, name
    rows = {r.doc_id: r for r in language_id.identify(hard, spark).collect()}
    assert {rows[k].lang_pred for k in (1, 2, 3, 13)} == {"und"} and rows[4].lang_pred == "en"
    assert sorted(rows[4].asDict()) == ["bits_per_byte", "doc_id", "held_out", "lang_pred", "score"]


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, found in everything(spark, empty, labels).items():
        assert found.count() == 0, name


def test_texts_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = docs.limit(20)
    for found in (quality_classifier.classify(some, labels, spark), toxicity.judge(some, labels, spark)):
        assert {r.score for r in found.collect()} == {0.5}
    nameless = some.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language_id.identify(nameless, spark).collect()} == {"und"}
