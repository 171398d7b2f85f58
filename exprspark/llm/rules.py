"""Quality rules by distribution divergence, in Column expressions only.

A text's histogram of character classes and its histogram of common words are compared with references by
Jensen-Shannon distance (base 2, so 0 to 1). The references are learned from the table itself: for each
language label the class counts of all its documents are summed, and its most frequent words over all
documents are its common words. A distance counts only where the text is long enough for its histogram to mean
something. Counts of words, symbols, repeated lines and repeated three-word windows come beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.words import SPACES, split_words, text_of
from exprspark.operators.ordering import top_per_group
from exprspark.session import Workspace

# The character classes, tried in this order; what is left over is the class "other".
CLASSES = {
    "lower": "[a-z]+",
    "space": "[ \\x09-\\x0D]+",
    "upper": "[A-Z]+",
    "stop": "[.,;:!?'\"()-]+",
    "symbol": "[#*$%&|<>]+",
    "digit": "[0-9]+",
}

MIN_WORDS = 50
MIN_CHARS = 200
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.4
COMMON_WORDS = 24


def class_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and one count per character class; each class is cut out of what the earlier ones left.

    Lower-case letters and blanks, most of a text, are cut out together, in runs longer than a word; blanks are counted apart.
    """
    blanks = F.length("text") - F.length(F.replace(F.col("text"), F.lit(" "), F.lit("")))
    rest = docs.select(*keep, F.col("text").alias("rest"), blanks.alias("blanks"))
    for name, pattern in {**CLASSES, "lower": "[a-z ]+"}.items():
        cut = rest.withColumn("less", F.regexp_replace("rest", pattern, ""))
        count = F.length("rest") - F.length("less")
        count = count - F.col("blanks") if name == "lower" else count + F.col("blanks") if name == "space" else count
        rest = cut.withColumn(name, count.cast("long")).drop("rest").withColumnRenamed("less", "rest")
    return rest.withColumn("other", F.length("rest").cast("long")).drop("rest", "blanks")


def shares(counts: list[Column]) -> Column:
    """Counts as shares of their sum; all zero where that is zero."""
    total = sum(counts[1:], counts[0])
    return F.array(*[F.when(total > 0, c / total).otherwise(F.lit(0.0)) for c in counts])


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence of two share arrays, in bits."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2.0) + part(y, (x + y) / 2.0))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2.0))


def references(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """One row per language label: class shares, common words, and the shares of these and of all other words."""
    space = Workspace(docs.sparkSession, "rules")
    texts = docs.select("lang", text_of().alias("text"))
    names = [*CLASSES, "other"]
    sums = class_counts(texts, "lang").groupBy("lang").agg(*[F.sum(n).alias(n) for n in names])
    counts = texts.select("lang", F.explode(split_words(F.col("text"))).alias("word")).groupBy("lang", "word").count()
    counts = space.save(counts, "words")
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total"))
    top = top_per_group(counts, common, [F.desc("count"), F.asc("word")], ["lang"])
    words = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "count"))).alias("top"))
    totals = totals.withColumnRenamed("lang", "total_lang")
    words = words.join(totals, F.col("lang").eqNullSafe(F.col("total_lang"))).select(
        F.col("lang").alias("word_lang"),
        F.col("top.word").alias("commons"),
        F.transform("top", lambda t: t["count"] / F.col("total")).alias("common_shares"),
    )
    joined = sums.join(words, F.col("lang").eqNullSafe(F.col("word_lang")), "left").select(
        F.col("lang").alias("ref_lang"),
        shares([F.col(n) for n in names]).alias("class_ref"),
        F.coalesce("commons", F.array().cast("array<string>")).alias("commons"),
        F.coalesce("common_shares", F.array().cast("array<double>")).alias("common_shares"),
    )
    rest = F.greatest(F.lit(0.0), F.lit(1.0) - F.aggregate("common_shares", F.lit(0.0), lambda a, x: a + x))
    return space.save(joined.withColumn("common_ref", F.concat("common_shares", F.array(rest))).drop("common_shares"), "refs")


def repeated_words(words: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside three-word windows that occur at least twice in the text; ``words`` are their hashes.

    Windows are hashed and, only where some hash recurs, sorted with their places, so that a repeated window is
    one whose sorted neighbour equals it. Each step is a column of its own, so no lambda computes it anew.
    """
    hashed = words.withColumn(
        "windows",
        F.when(
            F.col("n_words") > 3,
            F.slice(
                F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))),
                1,
                F.greatest(F.size("words") - 2, F.lit(0)),
            ),
        ),
    )
    placed = hashed.withColumn(
        "placed",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
        ),
    )

    def recurs(x: Column, i: Column) -> Column:
        before = (i > 0) & (F.get("placed", i - 1)["w"] == x["w"])
        return before | F.coalesce(F.get("placed", i + 1)["w"] == x["w"], F.lit(False))

    places = F.transform(F.filter("placed", recurs), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
    covered = F.size(F.array_distinct(F.flatten(places)))
    return placed.withColumn(
        "n_repeat_words", F.when(F.col("placed").isNull(), F.lit(0)).otherwise(covered).cast("long")
    ).drop("windows", "placed")


def apply_rules(docs: DataFrame, refs: DataFrame | None = None, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
                max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """One row per input row with its counts, distances and verdict.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    word_distance, kept``. NULL text has no words and fails the base rules; NULL language is a language of its own; a
    language the references don't have gives NULL distances, which reject nothing; repeated rows are judged alike;
    other columns play no part. Nothing but the references (one row per language) is shuffled or broadcast.
    """
    refs = references(docs) if refs is None else refs
    names = [*CLASSES, "other"]
    texts = docs.select("doc_id", "lang", text_of().alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    # Words are hashed once; windows and common words are compared by these numbers.
    hashed = F.transform(split_words(F.col("text")), lambda w: F.xxhash64(w))
    with_words = texts.withColumn("words", hashed).withColumn("lines", lines)
    counted = with_words.select(
        "doc_id",
        "lang",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    counted = class_counts(repeated_words(counted), "doc_id", "lang", "words", "n_words", "n_dup_lines", "n_repeat_words")
    refs = refs.withColumn("commons", F.transform("commons", lambda w: F.xxhash64(w)))
    joined = counted.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    joined = joined.withColumn("hits", F.filter("words", lambda w: F.array_contains("commons", w)))
    hit_shares = F.transform(
        "commons",
        lambda c: (F.size("hits") - F.size(F.array_remove("hits", c))) / F.greatest(F.col("n_words"), F.lit(1)).cast("double"),
    )
    missed = (F.col("n_words") - F.size("hits")) / F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    joined = joined.withColumn("common_shares", F.concat(hit_shares, F.array(missed)))
    total = sum([F.col(n) for n in names[1:]], F.col(names[0]))
    measured = joined.select(
        "doc_id",
        "n_words",
        (total - F.col("space")).alias("word_chars"),
        F.col("symbol").alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.when(total >= min_chars, js_distance(shares([F.col(n) for n in names]), F.col("class_ref"))).alias("class_distance"),
        F.when(F.col("n_words") >= min_words, js_distance(F.col("common_shares"), F.col("common_ref"))).alias("word_distance"),
    )
    far = F.coalesce(F.col("class_distance") > max_class, F.lit(False)) | F.coalesce(
        F.col("word_distance") > max_word, F.lit(False)
    )
    return measured.withColumn("kept", ~F.col("base_failed") & ~far)
