"""Line dedup: an exact set-similarity join of lines, in Column expressions and joins only.

A line is the set of its words in lower case. A line goes if an earlier line, by document id and place, has a set with a
Jaccard similarity of at least the threshold. Lines with equal sets are one class, so copies are never paired with each
other; classes are joined by prefix filtering: the words of a set are ordered by rarity, and two similar sets share one
of their first ``n - ceil(t n) + 1`` words. Length and position filters drop pairs whose sets cannot overlap enough, and
so does a parity bitmap: each word of only one of two sets flips one bit between their bitmaps, so more flipped bits
than words may differ rule a pair out. What is left is verified on the sets themselves.

Only the existence of an earlier match counts, not all matches. So classes whose sets have the same two smallest or
largest hashes of words first meet the earliest of such a group, its pivots, and the likeliest of these is verified: in
a large group of similar lines this settles nearly all of them with one pair each. The join by prefix words then asks
for the classes that no pivot settled, and all earlier ones answer; so its result is whole whatever the pivots found.

Rarity is a word's frequency class, from a count over all texts that is kept for a fixed number of hash buckets, and
within a class its length. Any order is right for the filter as long as it is the same everywhere; collisions only cost
candidates.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exprspark.llm.words import SPACES, doc_key, free_name, text_of
from exprspark.session import Workspace

PERCENT = 80
BUCKETS = 1 << 17
CLASS_BITS, LENGTH_BITS, TAIL_BITS = 4, 5, 22
PIVOTS = 16
BITMAP_WORDS = 1 << 18


def low_half(x: Column) -> Column:
    return x.cast("long").bitwiseAND(0xFFFFFFFF)


def coded(number: Column, line: Column) -> Column:
    """A line's number above the low half of its text's hash; the hash keeps rows apart that share an id but not a text."""
    return F.shiftleft(number.cast("long"), 32).bitwiseOR(low_half(F.hash(line)))


def text_lines(docs: DataFrame) -> DataFrame:
    """``k, place, line``: the lines of all documents, by document key and coded line number."""
    lines = docs.select(doc_key().alias("k"), F.posexplode(F.split(text_of(), "\n")).alias("ln", "line"))
    return lines.select("k", coded(F.col("ln"), F.col("line")).alias("place"), "line")


def has_word(line: str) -> Column:
    return F.trim(line, F.lit(SPACES)) != ""


def blank_split(text: Column) -> Column:
    """The words in lower case, with an empty one between neighbouring spaces: a cut at one letter needs no pattern."""
    spaced = F.lower(text)
    for space in SPACES[1:]:
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    return F.split(F.trim(spaced), " ")


def word_set(line: str) -> Column:
    """A line's distinct words in lower case, sorted: 59 bits of a hash and, above the lowest ``TAIL_BITS``, five bits of length.

    Words are compared by these numbers; within two lines a collision is out of the question.
    """
    room = ~(((1 << LENGTH_BITS) - 1) << TAIL_BITS)

    def number(word: Column) -> Column:
        length = F.least(F.length(word), F.lit(31))
        return F.xxhash64(word).bitwiseAND(room).bitwiseOR(F.shiftleft(length, TAIL_BITS).cast("long"))

    return F.sort_array(F.array_distinct(F.transform(F.array_remove(blank_split(F.col(line)), ""), number)))


def bucket_of(token: Column) -> Column:
    return F.shiftrightunsigned(token, 40).bitwiseAND(BUCKETS - 1).cast("int")


def frequency_classes(docs: DataFrame) -> bytes:
    """For each hash bucket half the binary logarithm of how many words of all texts fall into it; of fixed size."""
    words = docs.select(F.explode(blank_split(text_of())).alias("word")).filter(F.col("word") != "")
    counts = words.groupBy(bucket_of(F.xxhash64("word")).alias("bucket")).count().toArrow()
    table = np.zeros(BUCKETS, dtype=np.uint8)
    table[counts["bucket"].to_numpy()] = np.minimum((1 << CLASS_BITS) - 1, np.log2(counts["count"].to_numpy()) / 2)
    return table.tobytes()


def prefix_keys(tokens: Column, n: Column, classes: bytes, percent: int) -> Column:
    """The first ``n - ceil(t n) + 1`` words of a set by rarity, each as one number.

    It holds the frequency class, then the length (of words in a class the longer ones are the rarer), then hash bits. The
    latter two are the lowest bits of a word's number, the length taken from 31 by the bits that stand for it in a class.
    """
    low, longest = LENGTH_BITS + TAIL_BITS, 31 << TAIL_BITS
    # Spark folds this to one array of numbers before the job.
    ranks = F.split(F.lit(",".join(str(c << low | longest) for c in classes)), ",").cast("array<int>")

    def key(token: Column) -> Column:
        rank = F.coalesce(F.get(ranks, bucket_of(token)), F.lit(0))
        return rank.bitwiseXOR(token.bitwiseAND((1 << low) - 1).cast("int"))

    wanted = n - F.floor((n * percent + 99) / 100).cast("int") + 1
    return F.slice(F.sort_array(F.transform(tokens, key)), F.lit(1), wanted)


def parity_bitmaps(tokens: Column) -> list[Column]:
    """One bit per word in 128 bits, added without carry: a word that only one of two sets has flips one bit between them.

    ``high`` has the upper half; ``low`` has both halves added, from which ``flipped_bits`` takes the upper one.
    """

    def added(own: Callable[[Column], Column]) -> Column:
        def flip(bits: Column, token: Column) -> Column:
            place = F.shiftrightunsigned(token, 34).bitwiseAND(63).cast("int")
            return bits.bitwiseXOR(F.call_function("shiftleft", own(token), place))

        return F.aggregate(tokens, F.lit(0).cast("long"), flip)

    one = F.lit(1).cast("long")
    return [added(lambda _: one).alias("low"), added(lambda t: F.shiftrightunsigned(t, 33).bitwiseAND(1)).alias("high")]


def flipped_bits(own: dict[str, Column], other: dict[str, Column]) -> Column:
    high = own["high"].bitwiseXOR(other["high"])
    return F.bit_count(high) + F.bit_count(own["low"].bitwiseXOR(other["low"]).bitwiseXOR(high))


def near_enough(own: dict[str, Column], other: dict[str, Column], percent: int) -> Column:
    """The filters for two sets ``n, low, high``: lengths must be near, and no more bits may differ than words."""
    n, m = own["n"], other["n"]
    lengths = (percent * F.greatest(n, m)) <= 100 * F.least(n, m)
    return lengths & ((100 + percent) * flipped_bits(own, other) <= (100 - percent) * (n + m))


def similar_enough(own: dict[str, Column], other: dict[str, Column], percent: int) -> Column:
    """The filters for two entries ``n, pos, low, high`` under a shared word at places ``pos`` (from 0) of their orders.

    Besides ``near_enough``, words before the shared one may all be shared, those after it as many as the shorter rest has.
    """
    n, m, i, j = own["n"], other["n"], own["pos"], other["pos"]
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return near_enough(own, other, percent) & ((100 + percent) * most >= percent * (n + m))


def word_of_bitmap(row: Column) -> tuple[Column, Column]:
    """The word of the bitmap and the bit in it that stand for a row."""
    spread = F.xxhash64(row)
    return F.shiftrightunsigned(spread, 6).bitwiseAND(BITMAP_WORDS - 1), spread.bitwiseAND(63).cast("int")


def bitmap(rows: DataFrame, row: Column) -> DataFrame:
    """``word, bits``: which bits the rows have; at most ``BITMAP_WORDS`` rows of two numbers, so it may be broadcast."""
    word, bit = word_of_bitmap(row)
    set_bit = F.expr("shiftleft(1L, bit)")
    return rows.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(set_bit).alias("bits"))


def possibly_in(df: DataFrame, marks: DataFrame, row: Column, within: bool = True) -> DataFrame:
    """The rows whose bit is set (``within``), or those whose bit isn't and that surely are not among the marked ones."""
    word, bit = word_of_bitmap(row)
    at, place, bits = (free_name(df, n) for n in ("mark_word", "mark_bit", "mark_bits"))
    asked = df.withColumns({at: word, place: bit})
    small = F.broadcast(marks.select(F.col("word").alias(at), F.col("bits").alias(bits)))
    there = F.expr(f"(shiftrightunsigned({bits}, {place}) & 1L) = 1L")
    joined = asked.join(small, at, "inner" if within else "left")
    kept = joined.filter(there if within else ~F.coalesce(there, F.lit(False)))
    return kept.drop(at, place, bits)


def bands(tokens: Column) -> Column:
    """Three numbers that two sets share the likelier the more similar they are: of the ends of the sorted words."""
    first, last = F.get(tokens, F.lit(0)), F.get(tokens, F.size(tokens) - 1)
    return F.array(F.hash(first, F.get(tokens, F.lit(1))), F.hash(last, F.get(tokens, F.size(tokens) - 2)), F.hash(first, last, F.lit(0)))


def line_sets(docs: DataFrame, percent: int, space: Workspace) -> DataFrame:
    """Every line that has a word, written once: ``k, place, n, h1, h2, low, high, bands, prefix``; equal sets have equal ``h1, h2``."""
    table = frequency_classes(docs)
    # A filter on the set itself would build it twice.
    sets = text_lines(docs).filter(has_word("line")).select("k", "place", word_set("line").alias("tokens"))
    n = F.size("tokens")
    return space.save(
        sets.select(
            "k", "place", n.alias("n"), F.xxhash64("tokens").alias("h1"), F.hash("tokens").alias("h2"), bands(F.col("tokens")).alias("bands"),
            *parity_bitmaps(F.col("tokens")), prefix_keys(F.col("tokens"), n, table, percent).alias("prefix"),
        ),
        "lines",
    )


def line_classes(lines: DataFrame, space: Workspace) -> DataFrame:
    """``id, h1, h2, k, place``: each set of words with the earliest line that has it; ids rise with these lines."""
    firsts = lines.groupBy("h1", "h2").agg(F.min(F.struct("k", "place")).alias("first")).select("h1", "h2", "first.*")
    spread = firsts.repartitionByRange("k", "place").sortWithinPartitions("k", "place")
    classes = space.save(spread.select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "k", "place"), "classes")
    space.release()
    return classes


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, percent: int, space: Workspace, label: str) -> DataFrame:
    """The ``id`` of those pairs ``id, other`` whose sets have the similarity.

    Sets are read again for the lines in pairs only: a bitmap of fixed size drops most other lines before the shuffle
    and the join drops the rest.
    """
    ids = pairs.select("id").unionByName(pairs.select(F.col("other").alias("id"))).distinct()
    ends = space.save(classes.join(ids, "id").select("id", "k", "place"), f"ends-{label}")
    row = F.struct("k", "place")
    likely = possibly_in(text_lines(docs), bitmap(ends, row), row)
    # Rows that share a document and a line have it once for each copy; their sets are the same.
    sets = likely.join(ends, ["k", "place"]).dropDuplicates(["id"]).select("id", word_set("line").alias("tokens"))
    sets = space.save(sets, f"sets-{label}")
    both = pairs.join(sets, "id").join(sets.select(F.col("id").alias("other"), F.col("tokens").alias("others")), "other")
    shared = F.size(F.array_intersect("tokens", "others"))
    enough = 100 * shared >= percent * (F.size("tokens") + F.size("others") - shared)
    found = space.save(both.filter(enough).select("id").distinct(), f"settled-{label}")
    space.drop(f"ends-{label}", f"sets-{label}")
    space.release()
    return found


def paired(upper: Column, lower: Column) -> Column:
    """Two numbers below 2^32 as one."""
    return F.shiftleft(upper.cast("long"), 32).bitwiseOR(lower.cast("long"))


def halves(pair: Column, kind: str) -> tuple[Column, Column]:
    return F.shiftrightunsigned(pair, 32).cast(kind), low_half(pair).cast(kind)


def key_before(steps: int) -> Column:
    """The key so many places before ``pos`` in the ``prefix``, counted from 1; 0 where there is none."""
    return F.coalesce(F.get("prefix", F.col("pos") - steps).cast("long") + 1, F.lit(0))


def sides(columns: list[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """The columns of both sides of a join of ``own`` and ``earlier`` rows."""
    own, earlier = ({c: F.col(f"{side}.{c}") for c in columns} for side in ("own", "earlier"))
    return own, earlier


def likeliest_pivots(firsts: DataFrame, percent: int, pivots: int, space: Workspace) -> DataFrame:
    """``id, other``: for each class the likeliest of the earliest classes that share a band with it."""
    rows = firsts.select("id", "n", "low", "high", F.explode("bands").alias("band"))
    rank = F.row_number().over(Window.partitionBy("band").orderBy("id"))
    earliest = rows.withColumn("rank", rank).filter(F.col("rank") <= pivots)
    together = F.count(F.lit(1)).over(Window.partitionBy("band"))
    earliest = space.save(earliest.withColumn("together", together).filter("together > 1").select(*rows.columns), "pivots")
    own, earlier = sides(rows.columns)
    met = (own["band"] == earlier["band"]) & (earlier["id"] < own["id"]) & near_enough(own, earlier, percent)
    pairs = rows.alias("own").join(earliest.alias("earlier"), met)
    unlike = flipped_bits(own, earlier) / (own["n"] + earlier["n"])
    return pairs.select(own["id"], earlier["id"].alias("other"), unlike.alias("unlike")).groupBy("id").agg(F.min_by("other", "unlike").alias("other"))


def pairs_by_prefix(firsts: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """``id, other``: the classes that aren't settled, with all earlier ones that may be similar; some pairs more than once."""
    # Both sides read the same rows, so their shuffle is one: the lowest bit of a tag tells which classes ask.
    asks = F.when(F.col("settled").isNull(), 1).otherwise(0)
    tagged = firsts.join(settled.withColumn("settled", F.lit(True)), "id", "left").withColumn("tag", F.col("id") * 2 + asks)
    # n and pos share one number in the shuffle, so do the two keys before a key (from 1; 0: there is none).
    entries = tagged.select("tag", "low", "high", "n", "prefix", F.posexplode("prefix").alias("pos", "key")).select(
        "key", "tag", "low", "high", paired(F.col("n"), F.col("pos")).alias("sizes"), paired(key_before(1), key_before(2)).alias("before")
    )
    own, earlier = sides(entries.columns)
    for side in (own, earlier):
        side["n"], side["pos"] = halves(side["sizes"], "int")
        side["one"], side["two"] = halves(side["before"], "long")
    # Two words of a set may have one key, so a class may meet itself; its tag is not below its own.
    before = earlier["tag"] < own["tag"] * own["tag"].bitwiseAND(1)
    # The first key that two sets share finds the pair, so one that surely is not the first need not.
    again = F.lit(False)
    for mine in (own["one"], own["two"]):
        again = again | ((mine > 0) & ((mine == earlier["one"]) | (mine == earlier["two"])))
    met = (own["key"] == earlier["key"]) & before & similar_enough(own, earlier, percent) & ~again
    pairs = entries.alias("own").join(entries.alias("earlier"), met)
    return pairs.select(F.shiftright(own["tag"], 1).alias("id"), F.shiftright(earlier["tag"], 1).alias("other"))


def similar_classes(docs: DataFrame, lines: DataFrame, classes: DataFrame, percent: int, space: Workspace,
                    pivots: int = PIVOTS) -> DataFrame:
    """``id`` of the classes that have an earlier similar class.

    Each class is compared with its likeliest pivot; those that this didn't settle meet all earlier classes that share
    a word of their prefixes.
    """
    # A set of so few words that no other set can reach the similarity has only its own class.
    able = lines.filter(100 * F.col("n") >= percent * (F.col("n") + 1)).select("k", "place", "n", "low", "high", "bands", "prefix")
    # Rows that share a document and a line are the same.
    firsts = able.join(classes.select("id", "k", "place"), ["k", "place"]).dropDuplicates(["k", "place"])
    firsts = space.save(firsts.select("id", "n", "low", "high", "bands", "prefix"), "firsts")
    likeliest = space.save(likeliest_pivots(firsts, percent, pivots, space), "pivot-pairs")
    settled = verified(docs, likeliest, classes, percent, space, "by-pivot")
    space.drop("pivots", "pivot-pairs")
    space.release()
    rest = space.save(pairs_by_prefix(firsts, settled, percent).distinct(), "other-pairs")
    space.drop("firsts")
    space.release()
    return settled.unionByName(verified(docs, rest, classes, percent, space, "by-all"))


def removed_lines(docs: DataFrame, percent: int, space: Workspace) -> DataFrame:
    """``k, codes``: per document key the places of the lines to remove, written."""
    if not 0 < percent <= 100:
        raise ValueError("the similarity is a percentage above zero")
    lines = line_sets(docs, percent, space)
    classes = line_classes(lines, space)
    similar = similar_classes(docs, lines, classes, percent, space).withColumn("similar", F.lit(True))
    marked = classes.join(similar, "id", "left").select(
        "h1", "h2", F.col("k").alias("first_k"), F.col("place").alias("first_place"), F.coalesce("similar", F.lit(False)).alias("similar")
    )
    later = (F.col("k") != F.col("first_k")) | (F.col("place") != F.col("first_place"))
    gone = lines.select("k", "place", "h1", "h2").join(marked, ["h1", "h2"]).filter(F.col("similar") | later)
    gone = space.save(gone.groupBy("k").agg(F.collect_set("place").alias("codes")), "gone")
    space.drop("lines", "classes", "other-pairs")
    space.release()
    return gone


def dedup_lines(docs: DataFrame, percent: int = PERCENT, counts: bool = False) -> DataFrame:
    """The documents without the lines that an earlier line is similar to; the columns of ``docs``.

    ``counts`` adds ``n_lines`` and ``n_removed``. Lines without a word stay, so do NULL and empty texts; a document all of
    whose lines go keeps an empty text. Documents are ordered by id, those without one last; rows that repeat an id and a
    text are one document and share its lines' fate; an empty table gives an empty result.
    """
    key, codes = free_name(docs, "line_key"), free_name(docs, "line_codes")
    space = Workspace(docs.sparkSession, "lines")
    gone = removed_lines(docs, percent, space).select(F.col("k").alias(key), F.col("codes").alias(codes))
    keyed = docs.withColumn(key, doc_key())
    marks = space.save(bitmap(gone, F.col(key)), "marks")
    # Documents that surely keep all lines need no shuffle.
    joined = possibly_in(keyed, marks, F.col(key)).join(gone, key, "left")
    whole = possibly_in(keyed, marks, F.col(key), within=False).withColumn(codes, F.lit(None).cast("array<long>"))
    joined = joined.unionByName(whole)
    kept, own = free_name(docs, "line_kept"), free_name(docs, "line_texts")
    cut = joined.withColumn(own, F.when(F.col(codes).isNotNull(), F.split("text", "\n")))
    cut = cut.withColumn(kept, F.array_except(F.transform(own, lambda x, i: coded(i, x)), F.col(codes)))
    left = F.transform(kept, lambda c: F.get(own, F.shiftright(c, 32).cast("int")))
    text = F.when(F.col(kept).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    columns = [text.alias(c) if c == "text" else F.col(c) for c in docs.columns]
    if not counts:
        return cut.select(*columns)
    n_lines = F.coalesce(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"))) + 1, F.lit(0)).cast("long")
    n_removed = F.coalesce(F.size(own) - F.size(kept), F.lit(0)).cast("long")
    return cut.select(*columns, n_lines.alias("n_lines"), F.when(F.col(kept).isNull(), 0).otherwise(n_removed).cast("long").alias("n_removed"))
