"""Registered queries of the training-data operators: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedflow.llm import bpe, centroids, chat, decontaminate, html_text, jaccard, language, lines, near_vectors, prefix_trie, topk, toxicity, warc
from feedflow.llm.shared import prepared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The installed public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.report(table(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


# Fixed value: a conversation whose texts look like the template's own marks.
MARKED = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.segments(rows.unionByName(marked)))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.join(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_html_text": op2_html_text,
    "op3_toxicity": op3_toxicity,
    "op4_top_k": op4_top_k,
    "op5_bpe": op5_bpe,
    "op6_decontaminate": op6_decontaminate,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}
