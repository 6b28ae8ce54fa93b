"""The registered queries of the package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import (
    exact_dedup,
    hard_negatives,
    jaccard_join,
    language_id,
    lexical_search,
    line_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

#: Folder of the public tokenizer files on driver and executors; None asks the installed package.
TOKENIZERS: str | None = None


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeated_chunks(read(spark, sf_dir, "documents"), spark, keep_text=False)
    return found.select("doc_id", "n_bytes", "n_chunks", "n_removed", "n_spans", "kept_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), spark)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_components(read(spark, sf_dir, "documents"), spark)
    return found.select("doc_id", "n_shingles", "component_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), spark)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(read(spark, sf_dir, "documents"), spark)
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), spark, tokenizer("word_bpe_49k.json"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), spark, keep_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), spark)
    return found.select("doc_id", "held_out", "score", "predicted")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(read(spark, sf_dir, "documents"), spark)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"), spark)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), spark)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    kept = line_dedup.kept_texts(docs, line_dedup.line_dedup(docs, spark), keep_text=False)
    return kept.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup,
            op2_exact_dedup,
            op3_quality_rules,
            op4_jaccard_join,
            op5_quality_classifier,
            op6_mixing,
            op7_packing,
            op8_suffix_dedup,
            op9_toxicity,
            op10_language_id,
            op11_hard_negatives,
            op12_lexical_search,
            op13_line_dedup,
        )
    }


SPACE = r"[\x20\x09-\x0D]+"
NORMAL = f"regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')"
#: Words of a text; ``{}`` is the text.
WORDS = f"list_filter(string_split_regex({{}}, '{SPACE}'), lambda x: x <> '')"
#: A-Z alone in lower case.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def rule_sql(rule: quality_rules.Rule) -> str:
    value = f"coalesce({rule.over}::DOUBLE / nullif({rule.by}, 0), 0.0)" if rule.by else rule.over
    bounds = [f"{value} >= {rule.low}"] * (rule.low is not None) + [f"{value} <= {rule.high}"] * (rule.high is not None)
    return " AND ".join(bounds)


def quality_rules_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
    verdict = " AND ".join(f"({rule_sql(r)})" for r in (*quality_rules.BASE, *quality_rules.RULES))
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
        lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: len({WORDS.format("x")}) > 0) AS l FROM texts),
        starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM texts),
        windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i : i + 4]) AS n FROM starts),
        places AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS place FROM windows WHERE n > 1),
        repeats AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
        counts AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                   len(regexp_extract_all(t, '[!?]{{2,}}'))::BIGINT AS n_shouts,
                   len(list_filter(w, lambda x: lower(x) IN ({stops})))::BIGINT AS n_stop_words, len(l)::BIGINT AS n_lines,
                   (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
            FROM lined LEFT JOIN repeats USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {verdict} AS kept FROM counts"""


JACCARD_SQL = f"""
    WITH RECURSIVE texts AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, g FROM (
            SELECT doc_id, w[i : i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts)
            WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id),
    links AS (
        SELECT a, b FROM pairs JOIN sizes AS x ON a = x.doc_id JOIN sizes AS y ON b = y.doc_id
        WHERE 100 * pairs.n >= 75 * (x.n + y.n - pairs.n)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM texts UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT a AS doc_id, coalesce(max(sizes.n), 0)::BIGINT AS n_shingles, min(b) AS component_id
    FROM reach LEFT JOIN sizes ON a = doc_id GROUP BY a"""


HARD_NEGATIVES_SQL = """
    WITH whole AS (
        SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scores AS (
        SELECT a.n AS a, a.vec_id AS anchor_id, b.n AS b, b.vec_id AS vec_id, a.label = b.label AS alike,
               list_dot_product(a.q, b.q)::BIGINT AS score
        FROM whole AS a JOIN whole AS b ON a.n <> b.n WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT * FROM scores WHERE alike
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, b) <= 5),
    ranked AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id NULLS LAST, s.b) AS rank
        FROM positives AS p JOIN scores AS s ON p.a = s.a
        WHERE NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10"""

#: Terms of a text in lower case.
TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SQL = f"""
    WITH texts AS (SELECT row_number() OVER () AS d, doc_id, {TERMS.format(LOWER)} AS t FROM documents),
    found AS (SELECT d, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM texts WHERE len(t) > 0),
    tf AS (SELECT d, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM found GROUP BY d, term),
    total AS (SELECT count(*) AS big_n, sum(len(t))::BIGINT AS big_l FROM texts WHERE len(t) > 0),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, total),
    asked AS (SELECT row_number() OVER () AS i, item_id, {TERMS.format(LOWER)} AS t FROM benchmark),
    wanted AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(t) AS term FROM asked) GROUP BY i, item_id, term),
    scores AS (
        SELECT i, item_id, d, any_value(doc_id) AS doc_id,
               sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l))))::BIGINT AS score
        FROM wanted JOIN tf USING (term) JOIN weights USING (term), total GROUP BY i, item_id, d),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20"""

BLANKS = "concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))"

LINES_SQL = f"""
    WITH texts AS (SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    lines AS (SELECT d, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM texts),
    keyed AS (SELECT *, {LOWER.replace("coalesce(text, '')", f"trim(line, {BLANKS})")} AS key FROM lines),
    common AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {line_dedup.LEAST_CHARS}
        GROUP BY key HAVING count(DISTINCT d) >= {line_dedup.LEAST_DOCUMENTS}),
    judged AS (
        SELECT d, doc_id, place, line, common.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
        FROM keyed LEFT JOIN common ON keyed.key = common.key)
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY d"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can say it: not what is trained or drawn, nor strings at every byte."""
    return {
        "op2_exact_dedup": f"""
            SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = min(doc_id) OVER w AS kept, sha256(normal) AS text_sha256
            FROM (SELECT doc_id, {NORMAL} AS normal FROM documents) WINDOW w AS (PARTITION BY normal)""",
        "op3_quality_rules": quality_rules_sql(),
        "op4_jaccard_join": JACCARD_SQL,
        "op11_hard_negatives": HARD_NEGATIVES_SQL,
        "op12_lexical_search": LEXICAL_SQL,
        "op13_line_dedup": LINES_SQL,
    }
