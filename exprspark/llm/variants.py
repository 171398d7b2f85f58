"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, so a word becomes a reduced word of the same length. If two words are one edit
apart, so are their reduced words, or these are equal. Of every reduced word, taken once, the whole neighbourhood of one
edit is generated, which takes few rows with so few symbols, and joined with the reduced vocabulary; pairs of words
behind such pairs are then verified on the words themselves. A neighbourhood holds each reduced word once, so a pair is
found once from either side and a word's neighbours come together under the word itself.

A bitmap of fixed size over the reduced vocabulary drops most neighbours that are no reduced word before the shuffle.
Words are counted before anything is paired, so how often a word occurs makes no key hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.lines import bitmap, possibly_in
from exprspark.llm.words import free_name
from exprspark.session import Workspace

# What a run is made of, which runs lose a letter, and which words count.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TYPO_EVERY = 31
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10

SYMBOLS = 5


def runs_of(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``doc_id, run``: each maximal run of letters of at least that length, A-Z lowered."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def with_typos(runs: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """``word``: the runs, of which those with a hash of document and run divisible by ``every`` lose a letter."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = free_name(runs, "at")
    place = (F.col(at) % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return runs.withColumn(at, h).select(F.when(F.col(at) % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words long and frequent enough."""
    counts = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """The word with each letter hashed to one of a few symbols."""
    letters = LOWER + "".join(map(chr, range(0xC0, 0x100)))
    hashed = "".join(chr(ord("a") + (ord(c) * 2654435761 % 2**32 >> 16) % symbols) for c in letters)
    return F.translate(word, letters, hashed)


def neighbourhood(word: Column, symbols: int = SYMBOLS) -> Column:
    """Hashes of the reduced word and of all reduced words one edit from it, each once."""
    places = F.sequence(F.lit(1), F.length(word))
    rest = F.length(word)
    letters = [F.lit(chr(ord("a") + s)) for s in range(symbols)]

    def before(i: Column) -> Column:
        return F.substring(word, F.lit(1), i - 1)

    def edits(i: Column) -> Column:
        after, own = F.substring(word, i + 1, rest), F.substring(word, i, F.lit(1))
        replaced = [F.concat(before(i), s, after) for s in letters]
        inserted = [F.concat(before(i), s, own, after) for s in letters]
        return F.array(F.concat(before(i), after), *replaced, *inserted)

    at_end = F.array(*[F.concat(word, s) for s in letters])
    return F.array_distinct(F.transform(F.concat(F.flatten(F.transform(places, edits)), at_end), lambda w: F.xxhash64(w)))


def near_words(words: DataFrame, space: Workspace, symbols: int = SYMBOLS) -> DataFrame:
    """``word, n, other, other_n`` for every two words one edit apart, from both sides. ``words`` has ``word, n``."""
    small = reduced(F.col("word"), symbols)
    keyed = space.save(words.select(F.xxhash64(small).alias("key"), "word", "n", small.alias("small")), "reduced")
    # The reduced vocabulary, each word once, and which of the reduced words around each are in it.
    vocabulary = keyed.groupBy("key").agg(F.first("small").alias("small"))
    marks = space.save(bitmap(vocabulary.select("key"), F.col("key")), "marks")
    near = vocabulary.select("key", F.explode(neighbourhood(F.col("small"), symbols)).alias("near"))
    near = possibly_in(near, marks, F.col("near"))
    own = near.join(keyed.select("key", "word", "n"), "key").select("near", "word", "n")
    others = keyed.select(F.col("key").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return own.join(others, "near").filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def follow(forms: DataFrame, space: Workspace) -> DataFrame:
    """``word, root``: the end of each chain of forms. Input ``word, form``.

    Every round doubles the steps taken and is written, so a lost executor costs one round. A form occurs several times
    as often as its word, so chains have no circles and their length is bounded by the logarithm of the largest count.
    """
    ends = space.save(forms.select("word", F.col("form").alias("root")), "chain-0")
    turn = 0
    while True:
        turn += 1
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = space.save(ends.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), f"chain-{turn}")
        if moved.filter("next IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        ends = moved.drop("next")


def variant_groups(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a vocabulary ``word, n``.

    A word's form is its most frequent near word (ties: the smallest in code-point order) if that is at least ``ratio``
    times as frequent, else NULL; ``root`` is the end of the chain of forms, the word itself without one. ``word`` is
    distinct and not NULL; an empty vocabulary gives an empty result.
    """
    space = Workspace(words.sparkSession, "variants")
    words = space.save(words.select("word", F.col("n").cast("long").alias("n")), "words")
    # Ascending order of (-n, word) puts the most frequent, then the smallest word first.
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    near = near_words(words, space, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    known = known.select(
        "word", F.when(is_form, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.minus")).alias("form_n"),
    )
    known = space.save(known, "known")
    roots = follow(known.filter("form IS NOT NULL").select("word", "form"), space)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """The variant groups of the words of all texts, after runs chosen by a hash have lost a letter.

    NULL and empty texts have no words; a NULL id reads as empty in the hash; rows that repeat are counted each; an empty
    table gives an empty result; other columns play no part.
    """
    return variant_groups(vocabulary(with_typos(runs_of(docs))), symbols=symbols)
