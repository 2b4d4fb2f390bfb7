"""Chunking: one output row a chunk."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.columns import require
from docloom.functions.splitters import Strategy, splitter, strategy
from docloom.operators import sentences
from docloom.operators.project import chunk_ids


def chunk_documents(df: DataFrame, plan: str | Strategy = "default", content: str = "content", id_col: str = "id", length: Callable[[str], int] = len) -> DataFrame:
    """All columns with ``chunk`` and ``chunk_id`` (id-1, id-2, ...); texts without a chunk have no row."""
    require(df, content, id_col)
    if dict(df.dtypes)[content] != "string":
        raise ValueError(f"{content} is not a text column")
    plan = strategy(plan) if isinstance(plan, str) else plan
    if plan.text_splitter.lower() == "learned":
        # what the texts tell about their sentences is counted first
        return sentences.chunk_sentences(df, sentences.learn(df, content), plan, content, id_col)
    cut = splitter(plan, length)

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: cut(t) if t else [])

    return df.select("*", F.posexplode(split(F.col(content))).alias("pos", "chunk")).withColumn("chunk_id", chunk_ids(id_col)).drop("pos")


def fixed_chunks(df: DataFrame, size: int, overlap: int = 0, content: str = "content", id_col: str = "id") -> DataFrame:
    """Windows of ``size`` characters; expressions only, no Python."""
    step = size - overlap
    starts = F.expr(f"sequence(0, greatest(cast(ceil((length({content}) - {overlap}) / {step}) AS int) - 1, 0))")
    return df.where(F.length(content) > 0).select("*", F.explode(starts).alias("pos")).withColumn("chunk", F.expr(f"substring({content}, pos * {step} + 1, {size})")).withColumn("chunk_id", chunk_ids(id_col)).drop("pos")
