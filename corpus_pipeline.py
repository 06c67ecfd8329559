"""A corpus made ready for training: each stage reads what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between two stages the rows are
written and read again, so a stage may drop the tables its predecessors worked with.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtrail.llm import jaccard_forest, language_crf, packing, suffix_dedup, winnowing
from mailtrail.llm.queries import added_tokens, is_held_out, tokenizer_files
from mailtrail.llm.shared import restored, scratch_scope, table, with_rest
from mailtrail.session import scratch_folder


def _stage(work):
    """A stage that first drops the tables which the stage before it worked with."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with scratch_scope(spark, "pipeline"):
            return work(spark, docs, sf_dir)

    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words have a language: those that language ID finds none in go.

    Where no row can teach, only texts without a letter go.
    """
    learned = docs.filter(~is_held_out(3, 1)).select(F.col("doc_id").alias("key"), "text", "lang")
    model = language_crf.fit(learned)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    told = language_crf.predict(with_rest(docs), model, ["text", "rest"])
    return restored(told.filter(F.col("lang_pred") != language_crf.UNKNOWN), docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones: that with the smallest doc_id."""
    return jaccard_forest.one_per_class(docs)


@_stage
def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the spans that documents with smaller ids have too."""
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return winnowing.clean_documents(docs, table(spark, sf_dir, "benchmark"))


@_stage
def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of tokens."""
    return packing.pack(docs, *tokenizer_files(), added=added_tokens())


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_spans),
    ("benchmark decontamination", decontamination),
    ("packing", packs),
]

#: SQL expresses neither the learned languages nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = scratch_folder(spark, name.replace(" ", "-"))
        rows = stage(spark, docs, sf_dir)
        rows.write.option("compression", "zstd").parquet(folder)
        docs = spark.read.schema(rows.schema).parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
