"""From raw documents to a training mix: five stages, each on all that the one before kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written and reread as the next one's docs. All but the last
return the columns of documents; the last returns a row for each copy the mix
takes, with the copy's number. No stage can be told in SQL as a whole, so there
is no SQL for the pipeline: tests compare each stage with plain Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import decontaminate, mixing, ngram_join, pii, quality, texts
from tallyfold.llm.inputs import table
from tallyfold.session import materialise


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.3 or more for quality."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_labelled"), F.col("quality").alias("_quality"))
    known = docs.where(texts.learned(F.col("doc_id"), 5, 0))
    labelled = known.join(labels, known["doc_id"] == labels["_labelled"])
    machine = quality.train(labelled, label="_quality")
    out = quality.score(docs, machine, score="_score", predicted="_predicted")
    return out.where("_predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word Jaccard similarities of 0.8 and more connect, the one of least id."""
    return ngram_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return pii.mask(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy: sources weigh 3, 1, 2 in turn and share 150% of all words."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
