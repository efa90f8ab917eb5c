"""Corpus preparation: toxic texts out, boilerplate lines out, one of each group of near copies, no test items, tokens.

Every stage takes (spark, docs, folder of tables) and works on all rows that the stage before it kept. Stages are written as
Parquet in the shared folder and read again, so a lost executor never reaches back beyond its own stage.

Near copies have 80 per cent of their five-word shingles in common. What a stage writes on its way is removed when its result stands;
a text of which every line is boilerplate goes on as an empty one, which is no copy of anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedflow.llm import bpe, decontaminate, jaccard, lines, toxicity
from feedflow.llm.queries import table, tokenizer_path
from feedflow.llm.shared import written


# Five words, similarity of 0.8 or more.
NEAR_COPIES = jaccard.Rule(words=5, numerator=80, denominator=100, likely=0.55)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score says that label 1 is likelier go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on more than a 16th of a source's documents go, long ones on a 100th, copies counted once; ``n_chars`` follows the text."""
    return lines.without_boilerplate(docs, copies_once=True).withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near copies, that with the smallest id stays."""
    return jaccard.one_of_each(docs, NEAR_COPIES)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which windows of test items make up a twentieth or more go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's tokens, and the digest of the text decoded from them."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("jaccard_join", keep_one_copy),
    ("decontamination", reject_contaminated),
    ("bpe", tokenise),
]

# The string-kernel machine and the tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what they keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
