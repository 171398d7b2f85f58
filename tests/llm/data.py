"""Small document tables for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone lantern quiet meadow copper window harvest signal amber violet ladder marble canyon thunder basket".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "er", "ly"]) for _ in range(n))


def prose(count: int = 60, seed: int = 5) -> list[tuple]:
    """Documents of several lines, with exact copies and near copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        text = "\n".join(sentence(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 5)))
        if i % 6 == 5:
            text = rows[i - 5][1]
        elif i % 6 == 4:
            text = rows[i - 4][1] + " " + rng.choice(WORDS)
        rows.append((i, text, ["en", "de"][i % 2], f"src{i % 4}", len(text)))
    return rows


ODD_TEXTS = [
    None, "", " \t\n\x0b\f\r ", "one", "one two", "\n\nonly\n\nlines\n\n", "a\x00b \x01 \x02", "é \U0001f600 ß   x", "x" * 50_000,
    "word " * 20_000, "1 " * 3_000, "a@" * 500, "+1 " * 500, "same text again", "same text again",
]


def odd_rows() -> list[tuple]:
    """NULLs in every column, texts at the edges, repeated rows, one id with two texts."""
    rows = [(i, t, "en", "s1", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", None, None, None), (None, None, None, None, None), (None, "no id", None, None, None)]
    return rows + [(3, "one", "en", "s1", 1), (3, "another text", None, "s2", -1), (2**62, "far", "xx", "s3", 0)]


# Names the operators use for columns of their own.
CLASHING = ["k", "place", "words", "size", "draw", "part", "text_key", "fp", "bucket", "spans", "label", "near_id", "mix_row", "line_key", "bits", "codes", "ref_lang"]


def with_clashes(df):
    return df.select("*", *[F.lit("mine").alias(c) for c in CLASHING])


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def labels(spark, rows, quality=lambda i: 1, toxic=lambda i: 0):
    data = [(r[0], quality(r[0]), toxic(r[0])) for r in rows if r[0] is not None]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")
