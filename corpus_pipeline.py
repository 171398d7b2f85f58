"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the documents its predecessor kept. All but the last return the columns of documents; the last returns
the pieces of packed sequences. ``run`` writes each stage's result to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from exprspark.llm import lines, mixing, packing, queries, simhash, toxicity
from exprspark.session import Workspace, tune


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model is learned from the labelled ones among them."""
    tune(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, queries.labels(spark, sf_dir)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is similar to."""
    tune(spark)
    return lines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    tune(spark)
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that each source comes near its target share of words."""
    tune(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, one row each."""
    tune(spark)
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Model fitting, fingerprints and tokenizing are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a table folder."""
    space = Workspace(tune(spark), "pipeline")
    docs = queries.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = space.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
