"""Every operator and every stage gives its stated result on odd rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from exprspark.llm import convnet, lines, mixing, packing, privacy, queries, rules, secrets, simhash, sketches, toxicity
from tests.llm.data import CLASHING, labels, odd_rows, prose, table, with_clashes

OPERATORS = {
    "packing": lambda d, lab: packing.pack_documents(d, queries.tokenizer_path()),
    "lines": lambda d, lab: lines.dedup_lines(d),
    "convnet": lambda d, lab: convnet.score(d, convnet.fit(d, lab, 8)),
    "mixing": lambda d, lab: mixing.mix(d),
    "simhash": lambda d, lab: simhash.near_groups(d),
    "secrets": lambda d, lab: secrets.scan(d),
    "privacy": lambda d, lab: privacy.personal_data(d),
    "sanitised": lambda d, lab: privacy.sanitised(d, privacy.personal_data(d)),
    "sketches": lambda d, lab: sketches.compare_with_edits(d),
    "toxicity": lambda d, lab: toxicity.score(d, toxicity.fit(d, lab)),
    "rules": lambda d, lab: rules.apply_rules(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_give_one_row_each(spark, name):
    rows = odd_rows()
    docs = with_clashes(table(spark, rows))
    out = OPERATORS[name](docs, labels(spark, rows)).cache()
    ids = sorted([r["doc_id"] for r in out.collect()], key=str)
    if name == "packing":
        assert set(ids) == {r[0] for r in rows}
    else:
        assert ids == sorted([r[0] for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_an_empty_table_gives_an_empty_result(spark, name):
    assert OPERATORS[name](table(spark, []), labels(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_repeated_rows_fare_alike(spark, name):
    docs = table(spark, [(1, "alpha beta gamma delta", "en", "s", 1)] * 3)
    out = OPERATORS[name](docs, labels(spark, [])).drop("sequence_id", "offset", "step_group", "context")
    assert out.count() == 3 and out.distinct().count() == 1


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_keep_columns_and_survive_odd_rows(spark, tmp_path, at):
    name, stage = corpus_pipeline.STAGES[at]
    rows = odd_rows()
    labels(spark, rows).write.parquet(str(tmp_path / "labels.parquet"))
    docs = with_clashes(table(spark, rows))
    out = stage(spark, docs, str(tmp_path)).cache()
    empty = stage(spark, docs.limit(0), str(tmp_path))
    assert empty.count() == 0
    if at < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns and out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.filter(" OR ".join(f"{c} <> 'mine'" for c in CLASHING)).count() == 0
        assert 0 < out.count() <= 3 * len(rows)


def test_pipeline_stages_against_their_rules(spark, tmp_path):
    """Each stage judged by a plain restatement of what it promises on its own input."""
    rows = prose(60)
    toxic = {7, 13, 20, 28, 33, 39, 46, 52}
    rows = [(i, t + (" grobnik" * 3 if i in toxic else ""), lang, s, n) for i, t, lang, s, n in rows]
    rows += [(1000 + i, f"plain words number {i} here grobnik grobnik", "en", "src0", 1) for i in range(12)]
    rows += [(2000 + i, f"clean harmless words number {i}", "en", "src1", 1) for i in range(60)]
    bad = toxic | set(range(1000, 1012))
    labels(spark, rows, toxic=lambda i: int(i in bad)).write.parquet(str(tmp_path / "labels.parquet"))
    docs = table(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).cache()
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - bad
    once = corpus_pipeline.drop_repeated_lines(spark, kept, str(tmp_path)).cache()
    assert {r.doc_id for r in once.collect()} == {r.doc_id for r in kept.collect()}
    groups = {r.doc_id: r.component_id for r in simhash.near_groups(once).collect()}
    single = corpus_pipeline.drop_near_duplicates(spark, once, str(tmp_path)).cache()
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, c in groups.items() if i == c)
    plan = {r.doc_id: r.copies for r in mixing.mix(single).collect()}
    mixed = corpus_pipeline.mix_sources(spark, single, str(tmp_path)).cache()
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in plan.items() if n}
    packed = corpus_pipeline.pack_sequences(spark, mixed, str(tmp_path))
    assert packed.agg(F.sum("length")).first()[0] == packed.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
    # How documents are cut depends on the partitions, what is packed does not.
    whole = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert sorted(whole.collect()) == sorted(packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect())
