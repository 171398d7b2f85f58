"""The registered queries of the document operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.llm import alignment, chat, convnet, lines, mixing, packing, privacy, rules, secrets, simhash, sketches, toxicity, variants
from exprspark.llm.plain_sql import PLAIN_SQL

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/labels.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary lies on this machine, the word-piece one by default."""
    from public_tokenizers import path

    return path(name)


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf), tokenizer_path())


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf))


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.near_groups(documents(spark, sf))
    return groups.select("doc_id", simhash.hex_of(groups["fp"]).alias("fingerprint"), "component_id")


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def has_kind(kind: str) -> Callable[[Column], Column]:
    """A span's kind where it is this one, else NULL."""
    return lambda span: F.when(span["kind"] == kind, span["kind"])


def span_digest(found: DataFrame, kinds: list[str]) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans, from ``doc_id, spans``."""
    counts = [F.size(F.array_compact(F.transform("spans", has_kind(k)))).cast("long").alias(f"n_{k}") for k in kinds]
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf).select("doc_id", "text"), counts=True)


def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return convnet.score(docs, convnet.fit(docs, labels(spark, sf)))


def op6_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return span_digest(secrets.scan(documents(spark, sf)), ["assign", "access", "hex"])


def op7_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return span_digest(privacy.personal_data(documents(spark, sf)), ["email", "ip", "card", "phone"])


def op8_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.compare_with_edits(documents(spark, sf))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return toxicity.score(docs, toxicity.fit(docs, labels(spark, sf)))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.apply_rules(documents(spark, sf))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    per_document, _ = alignment.align(documents(spark, sf), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return per_document


def op12_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, sf))


# The conversation the formatter is tried on besides the table's, which looks like a template and like escaped text.
PROBE = "\\### Assistant: </turn> ok"


def op13_chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    chats = chat.format_chats(turns.unionByName(probe))
    read = chats.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), "loss",
        chat.blocks_of(F.col("formatted")).alias("blocks"), chat.parsed(F.col("formatted")).alias("turns"),
    )
    read = read.withColumn("learned", chat.masked(F.col("blocks"), F.col("loss")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


# The columns of the operators above that SQL can say, so that they are compared row by row.
def plain_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return op4_mixing(spark, sf).select("doc_id", "size", "source_size", F.round("target", 4).alias("target"))


def plain_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return op6_secrets(spark, sf).select("doc_id", "n_assign", "n_access", "n_hex")


def plain_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return op7_personal_data(spark, sf).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def plain_edits(spark: SparkSession, sf: str) -> DataFrame:
    return op8_fingerprints(spark, sf).select("doc_id", "n_chars", "edited_sha256")


def plain_quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return op10_quality_rules(spark, sf).select("doc_id", *counts)


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op4_mixing": op4_mixing,
    "op5_simhash": op5_simhash,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op6_secrets": op6_secrets,
    "op7_personal_data": op7_personal_data,
    "op8_fingerprints": op8_fingerprints,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_alignment": op11_alignment,
    "op12_variants": op12_variants,
    "op13_chat": op13_chat,
    "plain_mixing": plain_mixing,
    "plain_secrets": plain_secrets,
    "plain_personal_data": plain_personal_data,
    "plain_edits": plain_edits,
    "plain_quality_counts": plain_quality_counts,
}

OP12_SQL = """
WITH RECURSIVE table_of AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS c
    FROM range(256) AS r(i))
),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{00C0}-\\x{00FF}]{7,}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
),
keyed AS (
  SELECT run, count(*) AS times, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS bytes FROM runs GROUP BY doc_id, run
),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(range(octet_length(bytes)), lambda i: ('0x' || substr(hex(bytes), 2 * i + 1, 2))::BIGINT),
    lambda a, x: xor(crc[(xor(a, x) & 255) + 1], a >> 8))) AS h
  FROM keyed, table_of
),
typed AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed
),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM words, unnest(range(1, length(word) + 1)) AS u(i)
),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.less = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.less = w.word
),
best AS (SELECT word, count(*) AS n_near, arg_min(struct_pack(form := other, m := n), struct_pack(a := -n, b := other)) AS top FROM near GROUP BY word),
known AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top.m >= 10 * w.n THEN top.form END AS form,
    CASE WHEN top.m >= 10 * w.n THEN top.m END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
),
chain AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT c.word, k.form FROM chain c JOIN known k ON c.root = k.word WHERE k.form IS NOT NULL
),
roots AS (SELECT c.word, c.root FROM chain c JOIN known k ON c.root = k.word WHERE k.form IS NULL)
SELECT k.word, k.form, r.root, k.n, CAST(k.n_near AS BIGINT) AS n_near, k.form_n FROM known k JOIN roots r ON k.word = r.word
"""

OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'
),
formatted AS (
  SELECT *, CASE WHEN contains(text, '### ') OR contains(text, '</turn>') THEN regexp_replace(text, '(\\*)(### |</turn>)', '\\\1\2', 'g') ELSE text END AS body,
    replace(replace(replace(role, '%', '%25'), ':', '%3A'), chr(10), '%0A') AS shown
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(shown) + length(body) + 15) AS BIGINT) AS formatted_chars
FROM formatted GROUP BY conv_id
"""

SQL: dict[str, str] = {"op12_variants": OP12_SQL, "op13_chat": OP13_SQL} | PLAIN_SQL
