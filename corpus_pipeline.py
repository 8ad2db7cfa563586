"""A corpus pipeline of five stages: quality, language, near-duplicates, mixing, packing.

Each stage is a function of (spark, docs, sf_dir): `docs` is all that the stage before kept, in the
columns of `documents`; what it returns is written and read again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, mixing, near_copies, packing, rule_ensemble
from tidemark.llm.text import set_aside
from tidemark.session import settle

#: No SQL says a fitted classifier or a packing; the run is tested against plain Python.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels but a fifth, scores 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = rule_ensemble.fit(docs, labels.where(~rule_ensemble.held_out(F.col("doc_id"))))
    return rule_ensemble.accepted(docs, model)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: not `und`, a score of half or more, and two words in five that the language's texts
    held (held-out texts of the four languages have 0.62 at least, sentences of other languages 0.29 at most)."""
    model = language_id.learn(docs.where(~rule_ensemble.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    docs, own = set_aside(docs, {"lang_pred", "score", "known_share"})
    marked = language_id.identify(docs, model, known_share=True)
    return marked.where(f"lang_pred <> '{language_id.UNKNOWN}' AND score >= 0.5 AND known_share >= 0.4").select(*own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more of five-word shingles."""
    return near_copies.deduplicate(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, once for each copy, every source to its target; a copy cut where the mix ends has the words taken."""
    return mixing.mixed_documents(docs, exact=True).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins; copies of one document never share a bin."""
    return packing.pack(docs, cluster=F.col("doc_id"))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixture", mixture), ("packed", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has written, from `documents`."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
