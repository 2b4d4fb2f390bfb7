"""Output records of chunks and of questions with their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_public(column: Column) -> Column:
    """By name or by number 1."""
    return F.coalesce(column.cast("string").isin("PUBLIC", "1"), F.lit(False))


def root_source(df: DataFrame, prefix: str = "metadata_root_document_", enabled: bool = True) -> Column:
    needed = [f"{prefix}{c}" for c in ("title", "description", "url")]
    kind = "struct<title:string,description:string,url:string,is_public:boolean>"
    if not enabled or any(c not in df.columns for c in (*needed, f"{prefix}id")):
        return F.lit(None).cast(kind)
    shown = F.col(f"{prefix}content_type") if f"{prefix}content_type" in df.columns else F.lit(None).cast("string")
    made = F.struct(*(F.col(c).cast("string").alias(c.removeprefix(prefix)) for c in needed), F.when(shown.isNotNull(), is_public(shown)).alias("is_public"))
    return F.when(F.col(f"{prefix}id").isNotNull() & F.greatest(*(F.col(c).isNull() for c in needed)).eqNullSafe(False), made)


def document_text(df: DataFrame, most: int, length=F.length) -> Column:
    """The whole text if it is short enough, else the chunk; originals before translations."""
    pick = lambda name: F.col(f"original_{name}") if f"original_{name}" in df.columns else F.col(name)
    return F.when(length(pick("content")) <= most, pick("content")).otherwise(pick("chunk")) if "chunk" in df.columns or "original_chunk" in df.columns else pick("content")


def description(df: DataFrame) -> Column:
    found = [F.col(c) for c in ("metadata_description", "description", "title") if c in df.columns]
    return F.coalesce(*found)


def chunk_records(df: DataFrame, most: int, id_col: str = "chunk_id", dedup: str | None = None) -> DataFrame:
    """id, metadata, document and embedding of each chunk."""
    meta = F.struct(F.col("title"), description(df).alias("description"), F.col("metadata_url").alias("url"), is_public(F.col("content_type")).alias("is_public"), (F.col(dedup) if dedup else F.lit(None).cast("string")).alias("dedup_id"), root_source(df).alias("root_source"))
    return df.select(F.col(id_col).cast("string").alias("id"), meta.alias("metadata"), document_text(df, most).alias("document"), "embedding")


def question_records(df: DataFrame) -> DataFrame:
    """A record for each question; its references, and which of them suffice, stay aligned as structs of one array.

    With fewer flags than sources all references count as sufficient.
    """
    reference = F.struct(F.col("source_id").cast("string").alias("article_id"), F.col("title"), description(df).alias("description"), F.col("metadata_url").alias("url"), is_public(F.col("content_type")).alias("is_public"), root_source(df).alias("root_source"))
    rows = df.select("question_id", "question", "answer", "embedding", F.struct(F.col("source_id").alias("o"), reference.alias("r"), F.col("is_sufficient").alias("s")).alias("x"))
    grouped = rows.groupBy("question_id").agg(F.min("question").alias("question"), F.min("answer").alias("answer"), F.min("embedding").alias("embedding"), F.array_sort(F.collect_set("x")).alias("xs"))
    every = F.sequence(F.lit(0), F.size("xs") - 1)
    enough = F.when(F.exists("xs", lambda x: x["s"].isNull()), every).otherwise(F.filter(every, lambda i: F.get("xs", i)["s"]))
    meta = F.struct("question", "answer", enough.alias("sufficient_references"), F.transform("xs", lambda x: x["r"]).alias("references"), F.lit(None).cast("string").alias("dedup_id"))
    return grouped.select(F.col("question_id").alias("id"), meta.alias("metadata"), "embedding")


def valid_chunks(records: DataFrame) -> Column:
    return F.col("id").isNotNull() & F.col("metadata.title").isNotNull() & F.col("metadata.description").isNotNull() & F.coalesce(F.col("metadata.url").rlike("^https?://[^/ ]+"), F.lit(False)) & F.col("document").isNotNull() & F.col("embedding").isNotNull()
