"""A corpus from raw documents to token ids, stage by stage; each stage reads what the one before has written."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, decontaminate, jaccard_join, line_dedup, quality
from docloom.llm.shared import shared_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; rejected ones go."""
    return quality.keep_selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents of which nothing is left; n_chars follows the text."""
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    rows = line_dedup.dedup_lines(whole).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    follows = {"text": F.col("text"), "n_chars": F.char_length("text")}
    return rows.select(*(follows.get(c, F.col("row")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their byte-level BPE ids, and the hash of what the ids decode to; a column of an output's name gives way."""
    made = ("doc_id", "text", "n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=[c for c in docs.columns if c not in made], with_ids=True, remember=400_000, close=True)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", distinct_lines),
    ("jaccard_join", distinct_documents),
    ("decontaminate", uncontaminated),
    ("byte_bpe", token_ids),
]

#: The classifier and the drawing of the first stage are no SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
