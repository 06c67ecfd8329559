"""The registered queries of the operators in this folder."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_transducer, html_consensus, jaccard_forest, language_crf, level_audit, packing, projection_search, quality_weak,
    suffix_dedup, token_alignment, toxicity_fm, warc_seekable, winnowing,
)
from .shared import table


def is_held_out(modulus: int, remainder: int) -> Column:
    """Whether the crc32 of the id as text leaves this remainder; false without an id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def tokenizer_files() -> tuple[str, str]:
    """The rank file of the byte-level BPE with 50,257 ids and the pattern that splits text."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def added_tokens() -> tuple[tuple[str, int], ...]:
    """The added tokens of the same vocabulary, which its tokenizer matches in texts too."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as told:
        return tuple((t["content"], t["id"]) for t in json.load(told)["added_tokens"])


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_files(), added=added_tokens())


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its near-duplicate class, its number of links and the first of its copies."""
    return jaccard_forest.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "copy_of"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, those in windows of benchmark items, and a digest of the items."""
    report = winnowing.decontamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return report.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how likely it is toxic, learned from the documents that are not held out."""
    documents = table(spark, sf_dir, "documents")
    held_out = is_held_out(4, 2)
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    key = F.col("doc_id").alias("key")
    model = toxicity_fm.fit(
        documents.select(key, "text"), labels.filter(~held_out).select(key, "label")
    )
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    return toxicity_fm.score(rows, model, ["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the bytes that repeat those of earlier documents, and what is left."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    texts, spans = suffix_dedup.repeated_spans(documents)
    results = suffix_dedup.shortened(texts, spans).withColumn("kept_sha256", F.sha2("left", 256)).drop("left")
    whole = F.sha2(F.coalesce("text", F.lit("")), 256)
    return suffix_dedup.per_document(documents, texts, results, {
        "n_removed": (F.col("n_bytes"), F.lit(0).cast("bigint")),
        "n_spans": (F.lit(1).cast("bigint"), F.lit(0).cast("bigint")),
        "kept_sha256": (F.sha2(F.lit(""), 256), whole),
    }).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_consensus.main_text(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written archives tell of each page when they are read back."""
    archives = warc_seekable.write_archives(table(spark, sf_dir, "pages"))
    return warc_seekable.read_archives(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its language, learned from the documents that are not held out."""
    documents = table(spark, sf_dir, "documents")
    held_out = is_held_out(3, 1)
    learned = documents.filter(~held_out).select(F.col("doc_id").alias("key"), "text", "lang")
    model = language_crf.fit(learned)
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    return language_crf.predict(rows, model, ["doc_id", "held_out"])


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the posterior of its weak labels, and the score learned from those."""
    scored, _ = quality_weak.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "label", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every row whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return projection_search.nearest(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its tokens in two vocabularies, their groups, and how common their links are."""
    import public_tokenizers

    digest = lambda told: F.when(told == "", "").otherwise(F.sha2(told, 256))
    return token_alignment.link_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"), shown=digest,
    ).withColumnRenamed("told", "groups_sha256")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its ids by the rank file, and the bytes that they decode to, as digests."""
    return bpe_transducer.digests(bpe_transducer.round_trip(table(spark, sf_dir, "documents"), *tokenizer_files()))


def op13_level_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and source: how far the other sources lie, and the terms that stand out."""
    return level_audit.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_decontamination": op3_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_main_text": op6_main_text,
    "op7_warc": op7_warc,
    "op8_language": op8_language,
    "op9_quality": op9_quality,
    "op10_nearest": op10_nearest,
    "op11_token_alignment": op11_token_alignment,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_level_audit": op13_level_audit,
}
