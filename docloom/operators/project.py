"""Projections."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.errors import RuleError


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def refactor(df: DataFrame, mapping: Mapping[str, str | Column | Callable[[DataFrame], Column]]) -> DataFrame:
    """New columns from a column's name (null where there is none), a column, or a function of the table."""
    made = lambda x: x if isinstance(x, Column) else x(df) if callable(x) else F.col(x) if x in df.columns else F.lit(None).cast("string")
    return df.select(*(made(x).alias(name) for name, x in mapping.items()))


def drop_by_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.endswith(suffix)))


def keep_metadata(df: DataFrame, names: Sequence[str], prefix: str = "metadata_") -> DataFrame:
    return df.select(*(c for c in df.columns if c in names or c.startswith(prefix)))


def columns_to_embed(extra: Sequence[str], defaults: Sequence[str] = ("title", "metadata_description", "chunk")) -> list[str]:
    return list(dict.fromkeys([*extra, *defaults]))


def text_to_embed(df: DataFrame, columns: Sequence[str], out: str = "text_to_embed", delimiter: str | None = None) -> DataFrame:
    """Lines ``**Name**: value``; nulls are left out, the paragraph delimiter is taken out."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ExceptionGroup("columns to embed", [RuleError(f"unknown column: {c}") for c in missing])
    value = lambda c: F.replace(F.col(c).cast("string"), F.lit(delimiter), F.lit("")) if delimiter else F.col(c).cast("string")
    return df.withColumn(out, F.concat_ws("\n", *(F.concat(F.lit(f"**{c.removeprefix('metadata_').capitalize()}**: "), value(c)) for c in columns)))


def chunk_ids(id_col: str = "id", position: str = "pos") -> Column:
    return F.concat_ws("-", F.col(id_col).cast("string"), (F.col(position) + 1).cast("string"))
