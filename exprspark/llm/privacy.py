"""Personal data by patterns, and terms that reveal it by information content; Column expressions and joins only.

Protected entities are the e-mail addresses, IP addresses, card and phone numbers of a text. Over all documents it is
counted in how many texts a term occurs, in how many an entity does, and in how many both do, wherever they stand. The
pointwise mutual information of both, set against the information content of the entity, is the share of the
entity that the term discloses: 1 means that whoever reads the term knows the entity. Terms above a threshold are
personal data themselves in every document, also in one without the entity, provided that enough different texts bear it
out. Entities are generalised to their kind, disclosing terms are removed.

Places are found by setting a mark around each match and splitting at the marks; their sums are taken in blocks, so
that a text with very many matches costs no more than its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.lines import bitmap, possibly_in
from exprspark.llm.words import doc_key, free_name, text_of
from exprspark.session import Workspace

# The patterns, by kind in the order of ties. Runs are possessive and start where no earlier start could
# succeed, so that a long run without its closing part is read once; \G lets a match follow the one before it.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must have for the pattern to be tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
KINDS = [*PATTERNS, "term"]

MARK, STAND_IN = "\x01", "\x02"
BLOCK = 256
SUPPORT = 3
DISCLOSURE = 0.95
TERM = r"\p{L}+"


def running_sums(values: Column) -> Column:
    """Sums of all values before each one, taken within blocks and over blocks."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda b: F.slice(values, b * BLOCK + 1, BLOCK)
    )

    def before_each(block: Column, first: Column) -> Column:
        """The sum before each value of a short array, beginning with ``first``."""
        start = F.struct(F.array().cast("array<long>").alias("sums"), first.cast("long").alias("last"))
        folded = F.aggregate(
            block, start,
            lambda a, x: F.struct(F.concat(a["sums"], F.array(a["last"])).alias("sums"), (a["last"] + x).alias("last")),
        )
        return folded["sums"]

    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
    return F.flatten(F.zip_with(blocks, before_each(totals, F.lit(0)), before_each))


def with_matches(df: DataFrame, kind: str, pattern: str, hint: str | None = None) -> DataFrame:
    """Adds a column ``kind``: an array of ``(start, end, value)`` of the pattern's matches in ``text``, places in code points."""
    text = F.replace(F.col("text"), F.lit(MARK), F.lit(STAND_IN))
    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)
    if hint:
        marked = F.when(F.col("text").rlike(hint), marked)
    cut = df.withColumn("pieces", F.when(F.size(F.coalesce(marked, F.array())) > 1, marked))
    cut = cut.withColumn("sizes", F.transform("pieces", lambda p: F.length(p).cast("long")))
    cut = cut.withColumn("firsts", F.when(F.col("sizes").isNotNull(), running_sums(F.col("sizes"))))
    odd = F.filter(F.transform("pieces", lambda p, i: i), lambda i: i % 2 == 1)
    found = F.transform(
        odd,
        lambda i: F.struct(
            F.get("firsts", i).alias("start"),
            (F.get("firsts", i) + F.get("sizes", i)).alias("end"),
            F.get("pieces", i).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<start: bigint, end: bigint, value: string>>")
    return cut.withColumn(kind, F.coalesce(found, none)).drop("pieces", "sizes", "firsts")


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def passes_luhn(digits: Column) -> Column:
    places = F.reverse(F.split(digits, "(?<=.)(?=.)"))

    def part(digit: Column, i: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when(i % 2 == 0, digit.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(places, part), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.transform(F.split(value, "\\."), lambda p: F.ltrim(p, F.lit("0"))),
            lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")),
        )
    digits = F.length(digits_of(value))
    if kind == "card":
        return F.when(digits.between(14, 19), passes_luhn(digits_of(value))).otherwise(F.lit(False))
    return digits.between(10, 15) if kind == "phone" else F.lit(True)


def entities(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans`` per row; spans ``(start, place of the kind, end, kind, value)`` in order."""
    rows = keyed_texts(docs)
    for kind, pattern in PATTERNS.items():
        rows = with_matches(rows, kind, pattern, HINTS[kind])
    kinds = []
    for place, kind in enumerate(PATTERNS):
        kinds.append(named_spans(F.filter(kind, check_of(kind)), place, kind))
    return rows.select("doc_id", "text_key", F.array_sort(F.concat(*kinds)).alias("spans"))


def check_of(kind: str):
    return lambda m: valid(kind, m["value"])


def named_spans(matches: Column, place: int, kind: str) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(place).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind"),
            m["value"].alias("value"),
        ),
    )


def words_of(text: Column) -> Column:
    """A text's distinct terms in lower case; what stands in an e-mail address is no term."""
    apart = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], MARK)).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(apart, F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))


def without_mails(text: Column) -> Column:
    """The text with blanks in place of its e-mail addresses, so that all other places stay."""
    pieces = F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(STAND_IN)), PATTERNS["email"], f"{MARK}$0{MARK}"), MARK)
    blanked = F.transform(pieces, lambda p, i: F.when(i % 2 == 1, F.lpad(F.lit(""), F.length(p), F.lit(" "))).otherwise(p))
    return F.when(F.contains(text, F.lit("@")), F.array_join(blanked, "")).otherwise(text)


def keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))


def same_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))


def rows_in(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts joined with the ``own_id, own_key`` of ``wanted``; a bitmap drops most others before the shuffle."""
    marks = bitmap(wanted, F.struct(F.col("own_id").alias("doc_id"), F.col("own_key").alias("text_key")))
    return possibly_in(texts, marks, F.struct("doc_id", "text_key")).join(wanted, same_row())


def entity_classes(found: DataFrame, total: int, support: int, space: Workspace) -> DataFrame:
    """``entity, group, n_entity``: entities in enough different texts; those that stand in the same texts have one group."""
    single = found.filter(F.size("spans") > 0).select("text_key", F.explode(F.array_distinct("spans.value")).alias("entity"))
    by_text = single.groupBy("entity", "text_key").agg(F.count(F.lit(1)).alias("docs"))
    marks = [F.bit_xor(F.xxhash64("text_key", F.lit(i))).alias(f"mark{i}") for i in (1, 2)]
    each = by_text.groupBy("entity").agg(F.count(F.lit(1)).alias("texts"), F.sum("docs").alias("n_entity"), *marks)
    each = each.filter((F.col("texts") >= support) & (F.col("n_entity") < total))
    return space.save(each.select("entity", F.struct("texts", "n_entity", "mark1", "mark2").alias("group"), "n_entity"), "classes")


def disclosing_terms(docs: DataFrame, found: DataFrame, space: Workspace, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """``term``: terms whose mutual information with an entity reaches ``disclosure`` of the entity's information content.

    ``found`` has one row per document with its ``spans``. All counts are of documents, over whole texts; ``support`` counts
    different texts, so that copies of one text prove nothing. Entities in the same texts are counted as one group, and terms
    first per set of groups, so documents that hold the same entities are summed before any term meets an entity.
    """
    total = found.count()
    n = F.lit(float(max(total, 1)))
    classes = entity_classes(found, total, support, space)
    bearing = found.filter(F.size("spans") > 0).select("doc_id", "text_key", F.explode(F.array_distinct("spans.value")).alias("entity"))
    sets = bearing.join(classes, "entity").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("group")).alias("groups"))
    keyed = sets.withColumn("set", F.struct(F.xxhash64("groups", F.lit(1)).alias("a"), F.xxhash64("groups", F.lit(2)).alias("b")))
    sets = space.save(keyed.withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key"}), "sets")
    held = rows_in(keyed_texts(docs), sets.select("own_id", "own_key", "set"))
    per_text = held.select("set", "text_key", F.explode(words_of(F.col("text"))).alias("term"))
    per_text = per_text.groupBy("set", "term", "text_key").agg(F.count(F.lit(1)).alias("docs"))
    per_set = space.save(per_text.groupBy("set", "term").agg(F.count(F.lit(1)).alias("texts"), F.sum("docs").alias("docs")), "per-set")
    # In how many documents a term stands; only terms with enough texts beside entities are counted.
    able = per_set.groupBy("term").agg(F.sum("texts").alias("texts")).filter(F.col("texts") >= support).select("term")
    able = space.save(able, "able")
    words = docs.select(F.explode(words_of(text_of())).alias("term"))
    terms = possibly_in(words, bitmap(able, F.col("term")), F.col("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    terms = terms.join(able, "term", "left_semi")

    def discloses(both: Column) -> Column:
        mutual = F.log2(both * n / (F.col("n_entity") * F.col("n_term")))
        return mutual >= disclosure * F.log2(n / F.col("n_entity"))

    members = sets.select("set", "groups").dropDuplicates(["set"]).select("set", F.explode("groups").alias("group"))
    members = members.withColumn("n_entity", F.col("group.n_entity"))
    # The most documents that the largest group of a set and a term can share drops frequent terms before they meet the groups.
    largest = members.groupBy("set").agg(F.max("n_entity").alias("n_entity"))
    rare = per_set.join(terms, "term").join(largest, "set").filter(discloses(F.least("n_entity", "n_term"))).drop("n_entity")
    pairs = rare.join(members, "set").filter(discloses(F.least("n_entity", "n_term")))
    together = pairs.groupBy("group", "term", "n_entity", "n_term").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("both"))
    return together.filter((F.col("texts") >= support) & discloses(F.col("both"))).select("term").distinct()


def personal_data(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """One row per input row: ``doc_id, text_key, spans``, spans as ``(start, place, end, kind, base)`` in order of place.

    Kinds are e-mail, IP, card, phone and, added by disclosure, term. NULL text is empty and has no spans; rows that
    repeat an id and a text have the same spans; NULL ids stay apart by text; other columns play no part; an empty table
    gives an empty result.
    """
    space = Workspace(docs.sparkSession, "privacy")
    found = space.save(entities(docs), "found")
    terms = space.save(disclosing_terms(docs, found, space, support, disclosure), "terms")
    texts = keyed_texts(docs)
    words = texts.select("doc_id", "text_key", F.explode(words_of(F.col("text"))).alias("term"))
    bearing = possibly_in(words, bitmap(terms, F.col("term")), F.col("term")).join(terms, "term")
    wanted = bearing.groupBy("doc_id", "text_key").agg(F.collect_set("term").alias("terms"))
    wanted = space.save(wanted.withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key"}), "wanted")
    # A term within an e-mail address is generalised with it.
    whole = rows_in(texts, wanted).dropDuplicates(["doc_id", "text_key"]).withColumn("text", without_mails(F.col("text")))
    whole = with_matches(whole, "words", TERM)
    hits = F.filter("words", lambda w: F.array_contains("terms", F.lower(w["value"])))
    added = whole.select("own_id", "own_key", slim(named_spans(hits, len(PATTERNS), "term"), False).alias("added"))
    none = F.array().cast("array<struct<start: bigint, place: int, end: bigint, kind: string, base: boolean>>")
    joined = found.join(space.save(added, "added"), same_row(), "left")
    return joined.select(
        "doc_id", "text_key", F.array_sort(F.concat(slim(F.col("spans"), True), F.coalesce("added", none))).alias("spans")
    )


def slim(spans: Column, base: bool) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit(base).alias("base")
        ),
    )


def sanitised(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents with entities generalised to ``<kind>`` and disclosing terms removed; the columns of ``docs``.

    ``spans`` is the result of ``personal_data``. Of spans that overlap the one that begins first counts.
    """
    own_id, own_key, found = (free_name(docs, n) for n in ("clean_id", "clean_key", "clean_spans"))
    keyed = docs.withColumns({own_id: doc_key(), own_key: F.xxhash64(text_of())})
    own = spans.filter(F.size("spans") > 0).select(doc_key().alias(own_id), F.col("text_key").alias(own_key), F.col("spans").alias(found))
    joined = keyed.join(own.dropDuplicates([own_id, own_key]), [own_id, own_key], "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def put(a: Column, s: Column) -> Column:
        gap = F.substr(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        name = F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        moved = F.struct(F.concat(a["out"], gap, name).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= a["at"], moved).otherwise(a)

    done = F.aggregate(found, start, put, lambda a: F.concat(a["out"], F.substr(F.col("text"), (a["at"] + 1).cast("int"))))
    clean = F.when(F.col(found).isNull(), F.col("text")).otherwise(done)
    return joined.withColumn("text", clean).select(*docs.columns)
