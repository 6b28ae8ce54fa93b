"""Near-duplicate join: blocked sparse product of the document by n-gram matrix.

Rows are documents, columns word n-grams. Documents with one and the same set are one row. A
pair whose Jaccard similarity reaches the threshold has a common n-gram among the first ones of
both, in any order fixed for the corpus, where "first" depends on the size; only those columns
enter the product. The order puts n-grams that many documents share last. Counts of common
columns are accumulated by pair, pairs below the bound that their sizes set are discarded, and
the rest are counted over whole sets.

First some rounds of each column's rows against one of them, which joins most of a group of near
copies at a cost in proportion to the group; then, in columns that still hold several
components, the pairs between different components. A pair is made only where the parities of
two sets allow a link: a set's n-grams are dealt over 512 bits, each bit says whether an odd
number fell on it, and two sets differ in at least as many n-grams as their bits differ. No link
that could join two components is left uncounted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.common import (
    FINE_BYTES,
    LOWER,
    Powers,
    documents,
    mixed,
    sifted,
    small_batches,
    span_hashes,
    spread,
    staged,
    text_blocks,
    tidy,
    without_rows,
    word_bounds,
)
from tallymart.llm.components import components

WORDS = 5
#: A link needs ``OVER`` times the intersection to reach ``UNDER`` times the union.
OVER, UNDER = 100, 75
#: N-grams known as common, at most; they are broadcast, and decide on the order alone.
MOST_COMMON = 1 << 20
#: Texts of one task that an n-gram must be in to be reported as common.
REPORTED = 3
#: N-grams that a task reports at a time.
REPORT_ROWS = 1 << 15
#: Rounds against single rows before the exact one; they save work and change no result.
ROUNDS = 3
#: Parities of a set, 64 in each column.
BITS = 512
PARITIES = [f"parity_{k}" for k in range(BITS // 64)]
#: Bytes of text handled at a time; a set's size and an n-gram's place in it share a number.
BLOCK, PLACES = FINE_BYTES, (1 << 32) - 1
STEPS = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def near_components(docs: DataFrame, spark: SparkSession, words: int = WORDS, over: int = OVER, under: int = UNDER) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable), and
    component, name_a, name_b: a number of the component of its own, also where ids repeat or are
    null, and 128 bits of the text.

    Words are runs without white space, A-Z in lower case. A text of fewer words than an n-gram
    has is one n-gram; a null text or one without words has none and is linked with nothing.
    Rows with equal sets are always linked, rows that repeat an id too. A null id is reached
    like any other and is the last choice for a component's id. An empty table gives no rows.
    Texts of any length are taken whole. N-grams are compared by 64-bit hashes, sets by 64-bit
    digests and sizes.
    """
    small_batches(spark)
    rows = documents(docs)
    named_rows = rows.select("doc_id", "text", *text_names(F.col("text")))
    seen = named_rows.mapInArrow(
        lambda batches: profiles(batches, words),
        "doc_id long, name_a long, name_b long, n long, cls long, gram long, texts long, "
        + ", ".join(f"{name} long" for name in PARITIES),
    )
    seen = staged(seen, "profiles", spark)
    common = spark.sparkContext.broadcast(common_grams(seen))
    sets = seen.where("gram is null").drop("gram", "texts")
    classes = sets.where("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("members"), *[F.first(c).alias(c) for c in ("n", *PARITIES)]
    )
    classes = staged(classes, "classes", spark)

    firsts = rows.select("text").mapInArrow(
        lambda batches: postings(batches, words, over, under, common.value), "gram long, cls long, n_place long"
    )
    shared = firsts.groupBy("gram").agg(F.min("cls").alias("low"), F.max("cls").alias("high"))
    shared = staged(shared.where("low < high").select("gram"), "shared-grams", spark)
    matrix = staged(
        firsts.join(shared, "gram").groupBy("gram", "cls").agg(F.first("n_place").alias("n_place")), "matrix", spark
    )
    roots = without_rows("node long, root long", spark)
    links = without_rows("a long, b long", spark)
    for turn in range(ROUNDS):
        pairs = staged(head_pairs(open_columns(matrix, roots, spark), turn, over, under), "head-pairs", spark)
        if pairs.isEmpty():
            break
        pairs = staged(alike(pairs, classes, over, under), "alike-pairs", spark)
        found = counted(pairs, rows, classes, words, over, under, spark)
        links = staged(links.union(between(found, roots)), "links", spark)
        roots = components(links, spark)
    marked = open_columns(matrix, roots, spark).join(classes.select("cls", *PARITIES), "cls")
    marked = staged(marked, "marked-rows", spark)
    own = staged(marked.groupBy("gram", "root").agg(F.count("*").alias("own")), "own-rows", spark)
    marked = staged(marked.join(own, ["gram", "root"]), "counted-rows", spark)
    pairs = staged(cross_pairs(marked, over, under), "cross-pairs", spark)
    if not pairs.isEmpty():
        found = counted(pairs, rows, classes, words, over, under, spark)
        links = staged(links.union(between(found, roots)), "links", spark)
        roots = components(links, spark)

    own_root = F.coalesce("root", "cls").alias("root")
    of_class = classes.join(roots, F.col("cls") == F.col("node"), "left").select("cls", "doc_id", "members", own_root)
    least = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.sum("members").alias("reached"))
    least = staged(least.where("reached > 1").drop("reached").withColumnRenamed("root", "top"), "least-ids", spark)
    known = of_class.join(least, F.col("root") == F.col("top")).select(F.col("cls").alias("known"), "component_id", F.col("top").alias("joined"))
    known = staged(known, "component-ids", spark)
    return sets.join(known, F.col("cls") == F.col("known"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("joined", "cls").alias("component"),
        "name_a",
        "name_b",
    )


def text_names(text: Column) -> list[Column]:
    """128 bits that tell texts under one id apart."""
    return [F.xxhash64(text).alias("name_a"), F.xxhash64(F.lit(13), text).alias("name_b")]


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Exactly one row of ``docs`` of each component, with all its columns.

    It is the one with the smallest id, null last, and of several the first by its text's hash.
    Texts without words are linked with nothing and all stay. Only rows that agree in id and text
    are told apart by their places, so nothing else has to be gathered.
    """
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "name_a", "name_b")
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min(name).alias("stays"))
    lone = found.where("n_shingles = 0").select("doc_id", "name_a", "name_b").distinct()
    stay = first.select("stays.doc_id", "stays.name_a", "stays.name_b", F.lit(True).alias("once"))
    stay = stay.union(lone.withColumn("once", F.lit(False)))
    rows = found.groupBy("doc_id", "name_a", "name_b").agg(F.count("*").alias("copies"))
    same = stay.doc_id.eqNullSafe(rows.doc_id) & (stay.name_a == rows.name_a) & (stay.name_b == rows.name_b)
    stay = stay.join(rows, same).select(
        stay.doc_id.alias("_llm_id"), stay.name_a.alias("_llm_a"), stay.name_b.alias("_llm_b"),
        (F.col("once") & (F.col("copies") > 1)).alias("_llm_cut"),
    )
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    own = docs.withColumns(dict(zip(("_own_a", "_own_b"), text_names(text))))
    match = own["doc_id"].cast("long").eqNullSafe(F.col("_llm_id")) & (F.col("_own_a") == F.col("_llm_a")) & (F.col("_own_b") == F.col("_llm_b"))
    kept = own.join(stay, match)
    turn = F.row_number().over(Window.partitionBy("_llm_id", "_llm_a", "_llm_b").orderBy(F.lit(1)))
    cut = kept.where("_llm_cut").withColumn("_llm_turn", turn).where("_llm_turn = 1")
    return kept.where("not _llm_cut").select(*docs.columns).union(cut.select(*docs.columns))


def common_grams(seen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-grams that many texts share, ascending, and in about how many: sums of the tasks' reports."""
    sums = seen.where("gram is not null").groupBy("gram").agg(F.sum("texts").alias("texts"))
    rows = sums.orderBy(F.desc("texts"), "gram").limit(MOST_COMMON).toArrow()
    grams = rows.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return grams[order], rows.column("texts").to_numpy()[order]


def open_columns(matrix: DataFrame, roots: DataFrame, spark: SparkSession) -> DataFrame:
    """gram, cls, n, place and root of the columns that hold several components so far."""
    placed = matrix.join(roots, F.col("cls") == F.col("node"), "left").select(
        "gram", "cls", "n_place", F.coalesce("root", "cls").alias("root")
    )
    placed = staged(placed, "placed", spark)
    split = placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    split = staged(split.where("low < high").select("gram"), "open-grams", spark)
    n, place = F.shiftright("n_place", 32).alias("n"), F.col("n_place").bitwiseAND(F.lit(PLACES)).cast("int").alias("place")
    return staged(placed.join(split, "gram").select("gram", "cls", n, place, "root"), "open-rows", spark)


def head_pairs(open_rows: DataFrame, turn: int, over: int, under: int) -> DataFrame:
    """Each row with one row of its column, the same one in most columns of a group of near copies.

    First it is the row with the fewest rarer n-grams before the column: a text that others were made
    from has next to none of its own. Later it is any.
    """
    order = F.xxhash64("cls", F.lit(turn))
    if not turn:
        order = F.shiftleft(F.col("place").cast("long"), 32) + order.bitwiseAND(F.lit(PLACES))
    heads = open_rows.groupBy("gram").agg(
        F.min_by("cls", order).alias("b"), F.min_by("n", order).alias("n_b"), F.min_by("root", order).alias("root_b")
    )
    met = open_rows.join(heads, "gram").where("root <> root_b")
    pairs = met.groupBy(F.col("cls").alias("a"), "b").agg(
        F.count("*").alias("common"), F.first("n").alias("n_a"), F.first("n_b").alias("n_b")
    )
    return pairs.where(possible(over, under)).select("a", "b")


def alike(pairs: DataFrame, classes: DataFrame, over: int, under: int) -> DataFrame:
    """The pairs that sizes and parities allow to be links."""
    a, b = (classes.select(*[F.col(c).alias(f"{c}_{side}") for c in ("cls", "n", *PARITIES)]) for side in "ab")
    a, b = a.withColumnRenamed("cls_a", "a"), b.withColumnRenamed("cls_b", "known")
    met = pairs.join(a, "a").join(b, (F.col("b") == F.col("known")) & sizes_fit(over, under) & parities_fit(over, under))
    return met.select("a", "b")


def cross_pairs(rows: DataFrame, over: int, under: int) -> DataFrame:
    """All pairs of different components that could be links.

    A component with one row in a column (``own``) meets the column's rows directly; components with
    several meet from a row to the other components, and from there to their rows, so that rows of
    one component never meet each other.

    In the first column of a pair, all n-grams before it are in one of the two sets only, so a pair
    whose common columns all stand too far behind in either is no link; nor is one that has too
    few of them.
    """
    a, b = (rows.select("gram", *[F.col(c).alias(f"{c}_{side}") for c in ("cls", "n", "place", "root", "own", *PARITIES)]) for side in "ab")
    fit = sizes_fit(over, under) & parities_fit(over, under)
    once = F.expr("own_a > 1 or cls_a < cls_b")
    alone = b.where("own_b = 1").withColumnRenamed("gram", "column")
    single = a.join(alone, (F.col("gram") == F.col("column")) & F.expr("root_a <> root_b") & once & fit)
    meets = b.where("own_b > 1").select("gram", "root_b").distinct()
    across = a.where("own_a > 1").join(meets, "gram").where("root_a < root_b").withColumnsRenamed({"gram": "column", "root_b": "to"})
    several = across.join(b.where("own_b > 1"), (F.col("gram") == F.col("column")) & (F.col("to") == F.col("root_b")) & fit)
    early = F.least(F.expr("n_a - place_a"), F.expr("n_b - place_b")) >= needed_both(over, under)
    names = ("cls_a", "cls_b", "n_a", "n_b")
    met = single.select(*names, early.alias("early")).union(several.select(*names, early.alias("early")))
    turned = F.col("cls_a") > F.col("cls_b")
    met = met.select(
        *[F.when(turned, y).otherwise(F.col(x)).alias(z) for x, y, z in (
            ("cls_a", F.col("cls_b"), "a"), ("cls_b", F.col("cls_a"), "b"), ("n_a", F.col("n_b"), "n_a"), ("n_b", F.col("n_a"), "n_b")
        )],
        "early",
    )
    met = met.groupBy("a", "b").agg(
        F.count("*").alias("common"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.bool_or("early").alias("early")
    )
    return met.where(F.col("early") & possible(over, under)).select("a", "b")


def needed_both(over: int, under: int) -> Column:
    """The least intersection that makes a link of two sets of these sizes."""
    return F.ceil(F.lit(under) * (F.col("n_a") + F.col("n_b")) / F.lit(float(over + under)) - F.lit(1e-9))


def parities_fit(over: int, under: int) -> Column:
    """Whether two sets differ in few enough n-grams, as far as their parities tell."""
    differing = [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in PARITIES]
    apart = sum(differing[1:], differing[0])
    return apart <= F.col("n_a") + F.col("n_b") - 2 * needed_both(over, under)


def sizes_fit(over: int, under: int) -> Column:
    return (F.lit(over) * F.least("n_a", "n_b")) >= (F.lit(under) * F.greatest("n_a", "n_b"))


def needed(size: np.ndarray, over: int, under: int) -> np.ndarray:
    """The least intersection with a set of any size."""
    return -(-under * size // over)


def possible(over: int, under: int) -> Column:
    """Whether enough of the first n-grams are common for the pair to reach the threshold.

    All n-grams of the set whose firsts end earlier that are not common are missing in the other.
    """

    def most(n: Column) -> Column:
        firsts = n - F.ceil(F.lit(under) * n / F.lit(float(over))) + 1
        return n - firsts + F.col("common")

    n_a, n_b = F.col("n_a"), F.col("n_b")
    return sizes_fit(over, under) & (F.greatest(most(n_a), most(n_b)) >= needed_both(over, under))


def counted(
    pairs: DataFrame, rows: DataFrame, classes: DataFrame, words: int, over: int, under: int, spark: SparkSession
) -> DataFrame:
    """The pairs that are links, by intersections of whole sets; columns a, b.

    Sets are made anew from one text of each class that a pair names.
    """
    named = staged(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), "named", spark)
    ids = staged(classes.join(named, "cls").select("doc_id").distinct(), "named-ids", spark)
    wanted = ids.select(F.col("doc_id").alias("_id"))
    texts = sifted(rows, ids, ["doc_id"]).join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = texts.select("text").mapInArrow(lambda batches: set_rows(batches, words), "cls long, grams binary")
    whole = staged(found.join(named, "cls", "left_semi").dropDuplicates(["cls"]), "sets", spark)
    both = pairs.join(whole.toDF("a", "grams_a"), "a").join(whole.toDF("b", "grams_b"), "b")
    return both.mapInArrow(lambda batches: linked(batches, over, under), "a long, b long")


def between(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links as links between the roots of the components so far; many between the same two are one."""
    for side in "ab":
        known = roots.toDF("known", "top")
        links = links.join(known, F.col(side) == F.col("known"), "left").withColumn(side, F.coalesce("top", side)).select("a", "b")
    return links.where("a <> b").distinct()


def gram_sets(column, words: int, powers: Powers):
    """For each run of texts, the sorted distinct n-gram hashes of each."""
    for _, _, data, starts in text_blocks(column, BLOCK):
        data, begin = spread(LOWER[data], starts)
        a, b = word_bounds(data)
        own = span_hashes(data, a, b, powers)
        edges = np.searchsorted(a, np.append(begin, len(data)))
        grams = np.zeros(max(0, len(own) - words + 1), np.uint64)
        for k in range(words):
            grams += own[k : len(own) - words + 1 + k] * STEPS[k]
        grams = mixed(grams)
        sets = []
        for first, past in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if past - first >= words:
                sets.append(np.unique(grams[first : past - words + 1]))
            elif past > first:
                short = (own[first:past] * STEPS[: past - first]).sum(dtype=np.uint64)
                sets.append(mixed(np.array([short], np.uint64) + np.uint64(past - first)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield sets


def digests(sets: list[np.ndarray]) -> np.ndarray:
    """A digest of each set and its size."""
    sums = [int(mixed(s * STEPS[7]).sum(dtype=np.uint64)) + len(s) for s in sets]
    return mixed(np.array([x & (1 << 64) - 1 for x in sums], np.uint64)).view(np.int64)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set a row of numbers whose bits say where an odd count of its n-grams falls."""
    odd = [np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=BITS) & 1 for s in sets]
    return np.packbits(np.array(odd, np.uint8).reshape(len(sets), BITS), axis=1).view(np.int64)


class Tally:
    """About how many texts hold each n-gram; single ones are forgotten where they get too many."""

    def __init__(self, most: int = 1 << 23) -> None:
        self.most, self.new, self.waiting = most, [], 0
        self.grams, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def add(self, grams: np.ndarray) -> None:
        self.new.append(grams)
        self.waiting += len(grams)
        if self.waiting > self.most // 16:
            self.settle()

    def settle(self) -> None:
        """New n-grams go in at their places; no more than they are is sorted or copied several times."""
        new = np.concatenate([np.zeros(0, np.uint64), *self.new])
        self.new, self.waiting = [], 0
        new.sort()
        first = np.flatnonzero(np.diff(new, prepend=~new[:1]) != 0)
        counts = np.diff(first, append=len(new)).astype(np.int32)
        new = new[first]
        place = np.searchsorted(self.grams, new)
        known = np.zeros(len(new), bool)
        inside = place < len(self.grams)
        known[inside] = self.grams[place[inside]] == new[inside]
        self.counts[place[known]] += counts[known]
        place, new, counts = place[~known], new[~known], counts[~known]
        self.grams = np.insert(self.grams, place, new)
        self.counts = np.insert(self.counts, place, counts)
        if len(self.grams) > self.most // 2:
            often = self.counts > 1
            self.grams, self.counts = self.grams[often], self.counts[often]


PROFILE = ["doc_id", "name_a", "name_b", "n", "cls", "gram", "texts", *PARITIES]


@tidy
def profiles(batches, words: int):
    """A row for each text, and for each task the n-grams that several of its texts share."""
    powers, tally = Powers(), Tally()
    for batch in batches:
        sizes, classes, bits = [], [], [np.zeros((0, len(PARITIES)), np.int64)]
        for sets in gram_sets(batch.column("text"), words, powers):
            sizes += [len(s) for s in sets]
            bits.append(parities(sets))
            classes.append(digests(sets))
            _, once = np.unique(classes[-1], return_index=True)
            tally.add(np.concatenate([sets[k] for k in once.tolist()]))
        nothing = pa.nulls(len(sizes), pa.int64())
        own_class = pa.array(np.concatenate(classes) if classes else [], pa.int64())
        odd = [pa.array(np.ascontiguousarray(column)) for column in np.concatenate(bits).T]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in PROFILE[:3]], pa.array(sizes, pa.int64()), own_class, nothing, nothing, *odd], names=PROFILE
        )
    tally.settle()
    often = np.flatnonzero(tally.counts >= REPORTED)
    for a in range(0, len(often), REPORT_ROWS):
        own = often[a : a + REPORT_ROWS]
        grams, counts = tally.grams[own].view(np.int64), tally.counts[own].astype(np.int64)
        empty = pa.nulls(len(own), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[empty] * 5, pa.array(grams), pa.array(counts), *[empty] * len(PARITIES)], names=PROFILE
        )


@tidy
def postings(batches, words: int, over: int, under: int, common: tuple[np.ndarray, np.ndarray]):
    """The first n-grams of each set, rare ones first; sets that repeat within a run once."""
    powers, (heavy, weights) = Powers(), common
    marked = np.zeros(1 << 20, bool)  # spares most look-ups
    marked[(heavy >> np.uint64(44)).astype(np.int64)] = True
    for batch in batches:
        for sets in gram_sets(batch.column("text"), words, powers):
            classes = digests(sets)
            _, once = np.unique(classes, return_index=True)
            chosen = []
            for k in once.tolist():
                own = sets[k]
                first = len(own) - int(needed(len(own), over, under)) + 1
                maybe = np.flatnonzero(marked[(own >> np.uint64(44)).astype(np.int64)])
                if len(maybe):
                    place = np.minimum(np.searchsorted(heavy, own[maybe]), len(heavy) - 1)
                    found = heavy[place] == own[maybe]
                    weight = np.zeros(len(own), np.int64)
                    weight[maybe[found]] = weights[place[found]]
                    own = own[np.argsort(weight, kind="stable")]
                chosen.append(own[:first] if len(own) else own)
            counts = [len(x) for x in chosen]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(chosen).view(np.int64)),
                    pa.array(np.repeat(classes[once], counts)),
                    pa.array(
                        np.repeat(np.array([len(sets[k]) for k in once], np.int64) << 32, counts)
                        | np.concatenate([np.arange(n) for n in counts])
                    ),
                ],
                names=["gram", "cls", "n_place"],
            )


@tidy
def set_rows(batches, words: int):
    powers = Powers()
    for batch in batches:
        for sets in gram_sets(batch.column("text"), words, powers):
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "grams"]
            )


@tidy
def linked(batches, over: int, under: int):
    for batch in batches:
        found = []
        for a, b in zip(batch.column("grams_a"), batch.column("grams_b")):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            both = len(np.intersect1d(a, b, assume_unique=True))
            found.append(over * both >= under * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))
