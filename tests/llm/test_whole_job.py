"""What bounded samples, folded bytes and repeated ids must not lose."""

import random

import brute

from tallymart.llm import language_id, toxicity


def words(turn, letters, n=40):
    draw = random.Random(turn)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(n))


def held_out_recall(found, lang):
    """Share of the held-out documents of each language that are told right, by id."""
    rows = [r for r in found.where("held_out").collect() if r.doc_id in lang]
    assert rows
    total, right = {}, {}
    for r in rows:
        name = lang[r.doc_id]
        total[name] = total.get(name, 0) + 1
        right[name] = right.get(name, 0) + (r.lang_pred == name)
    return {name: right[name] / n for name, n in total.items()}


def test_letters_of_a_rarer_script(spark):
    """Greek and Cyrillic texts of one shape, between Latin ones that fill a table of frequent bytes."""
    latin = "abcdefghijklmnopqrstuvwxyz&%$!?,;:()[]{}<>+*=/#@~^_|"
    greek, cyrillic = "αβγδεζηθικλμνξο", "абвгдежзийклмно"
    rows = [(k, words(k, latin, 1500), "en") for k in range(100)]
    for k in range(60):
        rows += [(1000 + k, words(k, greek), "el"), (2000 + k, words(k, cyrillic), "uk")]
    found = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark)
    assert held_out_recall(found, {i: x for i, _, x in rows}) == {"en": 1.0, "el": 1.0, "uk": 1.0}


def test_rare_languages_are_learnt(spark):
    """A language of few documents among very many of another, in a sample of 20 each."""
    rows = [(k, words(k, "abcdefghijklm", 10), "hot") for k in range(3000)]
    rows += [(10_000 + k, words(k, "nopqrstuvwxyz", 10), "rare") for k in range(15)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.identify(table, spark, sample=20)
    assert held_out_recall(found, {i: x for i, _, x in rows}) == {"hot": 1.0, "rare": 1.0}


def judged_toxic(spark, insult, odd, plain):
    """Predictions for texts with and without an insult, learnt from labelled prose that ends with it or with one of its words."""
    rows = [(k, brute.prose(k % 7, 50) + " " + (insult if k % 3 == 0 else plain[k % len(plain)]) + ".") for k in range(240)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(240)], "doc_id long, toxic int")
    rows += [(1000 + k, brute.prose(k % 7, 40) + " " + w) for k, w in enumerate(odd)]
    rows += [(2000 + k, brute.prose(k % 7, 40) + " " + w) for k, w in enumerate(plain)]
    found = toxicity.judge(spark.createDataFrame(rows, "doc_id long, text string"), labels, spark)
    scores = {r.doc_id: r.predicted for r in found.collect()}
    return [scores[1000 + k] for k in range(len(odd))], [scores[2000 + k] for k in range(len(plain))]


def test_insults_gapped_by_spaces(spark):
    odd = ["numbskull", "n u m b s k u l l", "numb skull", "N U M B skull", "nu mb skull now"]
    found, clean = judged_toxic(spark, "numbskull", odd, ["", "of it", "a b c"])
    assert found == [1] * len(odd) and clean == [0] * 3


def test_insults_of_several_ordinary_words(spark):
    odd = ["dirt bag", "d.irt  bag", "DIRT BAG!", "you dirt bag there"]
    found, clean = judged_toxic(spark, "dirt bag", odd, ["dirt", "bag", "bag of dirt", "dirt. Bag"])
    assert found == [1] * len(odd) and clean == [0] * 4
