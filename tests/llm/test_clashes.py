"""Input columns that are called like a result or like a name inside an operator."""

import pytest
from pyspark.sql import functions as F

PASSAGE = "the same long passage stands in two texts, word for word, so that one of them loses it: " * 4
TEXTS = ["Some first words, and then more. " + PASSAGE, PASSAGE + " Other last words, which differ.", None, "A short text."]


def table(spark):
    rows = [(i, t, f"q{i}", f"s{i}", f"c{i}", f"o{i}", f"a{i}", f"r{i}") for i, t in enumerate(TEXTS)]
    names = ", ".join(f"{x} string" for x in ("text", "q", "Spans", "_cleaned", "own", "_at", "`a.b`"))
    return spark.createDataFrame(rows, f"doc_id bigint, {names}")


def test_quality_replaces_a_column_of_its_name(spark):
    from orderlens.llm.quality import judged

    docs = table(spark)
    got = judged(docs)
    assert got.columns == [c for c in docs.columns if c != "q"] + ["q"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {i: r["a.b"] for i, r in rows.items()} == {i: f"r{i}" for i in range(4)}
    assert rows[2]["q"]["kept"] is False and rows[0]["q"]["n_words"] == len(TEXTS[0].split())


def test_dedup_replaces_a_column_of_its_name(spark):
    from orderlens.llm.chunks import without_repeats

    docs = table(spark)
    got = without_repeats(docs)
    assert got.columns == [c for c in docs.columns if c != "Spans"] + ["spans"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {i: (r["q"], r["a.b"]) for i, r in rows.items()} == {i: (f"q{i}", f"r{i}") for i in range(4)}
    assert rows[1]["spans"] and len(rows[1]["text"]) < len(TEXTS[1])
    assert rows[3]["text"] == TEXTS[3] and rows[3]["spans"] == []


def test_pipeline_stages_keep_every_column(spark):
    import corpus_pipeline

    docs = table(spark).where("text IS NOT NULL")
    for stage in (corpus_pipeline.clean_lines, corpus_pipeline.drop_near_copies, corpus_pipeline.cut_repeats):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        for r in got.collect():
            i = r["doc_id"]
            assert (r["q"], r["Spans"], r["_cleaned"], r["own"], r["_at"], r["a.b"]) == tuple(f"{x}{i}" for x in "qscoar")


def test_language_model_refuses_more_words_than_it_can_number(spark, monkeypatch):
    from orderlens.llm import ngram_lm

    texts = spark.range(3).select(F.concat(F.lit("word"), "id").alias("text"))
    monkeypatch.setattr(ngram_lm, "MOST_WORDS", 4)
    with pytest.raises(ValueError, match="4 distinct words"):
        ngram_lm.train(texts)
