"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Each rule bounds a ratio of two counts of the text. Counts and rules are column expressions; no
row leaves the JVM and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import SPACE_RE, SPACES, documents

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
SHOUTS = r"[!?]{2,}"

#: Frequent function words of the languages served.
STOP_WORDS = (
    "a an and are as at be by for from has have he in is it of on or that the this to was were will with "
    "der die das den dem des ein eine und ist im in zu mit von auf für nicht sich auch als an es "
    "le la les de du des un une et est en que qui dans pour par sur au aux il elle "
    "el los las del al un una y en que con por para su se no lo como es"
).split()


@dataclass(frozen=True)
class Rule:
    """``over`` divided by ``by`` (0 where ``by`` is 0) must lie between ``low`` and ``high``."""

    name: str
    over: str
    by: str | None = None
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.over).cast("double")
        if self.by:
            value = F.coalesce(value / F.nullif(F.col(self.by), F.lit(0)), F.lit(0.0))
        bounds = [value >= self.low] * (self.low is not None) + [value <= self.high] * (self.high is not None)
        verdict = F.lit(True)
        for bound in bounds:
            verdict = verdict & bound
        return verdict


BASE = (Rule("few words", "n_words", low=10), Rule("repeated windows", "n_repeat_words", "n_words", high=0.2))
RULES = (
    Rule("word length", "word_chars", "n_words", low=1.5, high=20),
    Rule("symbols per word", "n_symbols", "n_words", high=0.1),
    Rule("shouts per word", "n_shouts", "n_words", high=0.1),
    Rule("stop words per word", "n_stop_words", "n_words", low=0.02),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.3),
)


def counts(docs: DataFrame, stop_words: list[str] = STOP_WORDS, window: int = WINDOW) -> DataFrame:
    """doc_id and the counts that rules may name, one row per row of ``docs``."""
    trimmed = F.btrim("text", F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = documents(docs).select("doc_id", "text", words.alias("words"), lines.alias("lines"))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(SHOUTS)).cast("long").alias("n_shouts"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop_words))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), window).alias("n_repeat_words"),
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    Inside, it is a variable. A filter on a result brings the whole expression down to the scan;
    a value that was a column of an earlier step would there be written out, and computed, in
    every turn of the loops that look into it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, window: int) -> Column:
    """Words in windows that come twice or more in the text.

    Windows are hashes of word hashes; only texts in which one comes twice look for where.
    """
    none = F.array().cast("array<bigint>")

    def windows(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - window)
        own = F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))
        return F.when(F.size(hashes) >= window, own).otherwise(none)

    def covered(ordered: Column) -> Column:
        def shared(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)
            )

        starts = F.sort_array(F.transform(F.filter(ordered, shared), lambda x: x["i"]))
        nothing = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            starts,
            nothing,
            lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(window), i - s["last"])).alias("n")),
            lambda s: s["n"],
        )

    def counted(own: Column) -> Column:
        ordered = F.sort_array(F.transform(own, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = F.size(F.array_distinct(own)) < F.size(own)
        return F.when(twice, bound(ordered, covered)).otherwise(F.lit(0).cast("long"))

    return bound(bound(F.transform(words, lambda w: F.xxhash64(w)), windows), counted)


def judge(docs: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All counts, base_failed, kept and failed (the names of all broken rules) of each row.

    A null or empty text has no words, fails the base and is not kept. Long texts are counted
    whole. Lines are equal as they stand. Rows that repeat are judged alike, each for itself.
    """
    rows = counts(docs)
    broken = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in (*base, *rules)]))
    fails = F.lit(False)
    for rule in base:
        fails = fails | ~rule.holds()
    return rows.select("*", fails.alias("base_failed"), broken.alias("failed")).select(
        "*", (F.size("failed") == 0).alias("kept")
    )
