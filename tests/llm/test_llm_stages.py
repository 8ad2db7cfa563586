"""Stages with columns that clash, texts in other languages, and rows that share a 64-bit key's place."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language_id, mixing, rule_ensemble
from tidemark.llm.text import set_aside

FOLDER = "/root/testdata/sf0.01"
FOREIGN = [
    "Il governo ha approvato una nuova legge che riguarda le scuole e gli ospedali della regione",
    "O governo aprovou uma nova lei que diz respeito às escolas e aos hospitais da região",
    "Hallitus hyväksyi uuden lain joka koskee alueen kouluja ja sairaaloita",
    "De regering heeft een nieuwe wet goedgekeurd over scholen en ziekenhuizen in de regio",
    "zxq wvb jkl qqq", "12 34 !!!", "", None,
]


def test_language_stage_rejects_other_languages_and_keeps_clean_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    foreign = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(FOREIGN)], "doc_id long, text string")
    foreign = foreign.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("a").alias("source"), F.lit(0).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
    kept = corpus_pipeline.language(spark, docs.unionByName(foreign), FOLDER).select("doc_id", "lang").collect()
    assert all(r.doc_id >= 0 for r in kept)
    known = docs.where("lang IS NOT NULL AND length(text) > 200").count()
    assert sum(r.lang is not None for r in kept) >= 0.99 * known


@pytest.mark.parametrize("stage", [corpus_pipeline.quality, corpus_pipeline.language, corpus_pipeline.near_duplicates, corpus_pipeline.mixture])
def test_stages_keep_columns_of_any_name(spark, stage):
    own = {"statistics": "own 1", "score": "own 2", "lang_pred": "own 3", "__key": "own 4", "__words": "own 5", "known_share": "own 6", "__score": "own 7", "__size": "own 8", "node": "own 9"}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumns({k: F.lit(v) for k, v in own.items()})
    out = stage(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) > 50 and all(r[k] == v for r in rows[:20] for k, v in own.items())
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    assert 0 <= stage(spark, odd, "/root/testdata/sf0.001").count() <= 4
    assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0


def test_scores_take_the_place_of_a_column(spark):
    docs = spark.createDataFrame([(1, "some words", "own", "own")], "doc_id long, text string, score string, statistics string")
    row = rule_ensemble.scored(docs, rule_ensemble.RuleEnsemble(0.0, ())).first()
    assert row.asDict() == {"doc_id": 1, "text": "some words", "statistics": "own", "score": 0.5}


def test_set_aside_gives_columns_back(spark):
    docs = spark.createDataFrame([(1, 2, 3)], "a int, A_aside int, b int")
    aside, own = set_aside(docs, {"a"})
    assert "a" not in aside.columns and aside.select(*own).first().asDict() == {"a": 1, "A_aside": 2, "b": 3}


def test_language_model_tells_known_words(spark):
    model = language_id.learn(spark.createDataFrame([(i, t, lang) for i in range(20) for t, lang in [("the cat and the dog", "en"), ("der hund und die katze", "de")]], "doc_id long, text string, lang string"))
    assert model.predict("the dog")[2] == 1 and model.predict("the zebra")[::2] == ("en", 0.5) and model.predict("hund dog")[2] == 0.5


def test_mixed_rows_of_one_id_stay_apart(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (1, "d e f", "s"), (None, "g h", "s"), (None, "g h", "s")], "doc_id long, text string, source string")
    texts = sorted(r.text for r in mixing.mixed_documents(docs, share=1.0, exact=True).collect())
    assert " ".join(texts).split() == ["a", "b", "c", "d", "e", "f", "g", "h", "g", "h"]
