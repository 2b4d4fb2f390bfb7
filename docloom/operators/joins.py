"""Joins with null-safe keys and suffixed overlaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.errors import RuleError
from docloom.functions.columns import require

KINDS = {"left": "left", "right": "right", "inner": "inner", "outer": "full_outer", "cross": "cross"}


def _listed(x: str | Sequence[str] | None) -> list[str]:
    return [] if x is None else [x] if isinstance(x, str) else list(x)


def merge(left: DataFrame, right: DataFrame, how: str = "left", on: str | Sequence[str] | None = "id", left_on=None, right_on=None, left_columns: Sequence[str] | None = None, right_columns: Sequence[str] | None = None, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join in which null keys meet null keys. Shared keys are one column; other columns of both sides get suffixes."""
    if how not in KINDS:
        raise RuleError(f"unknown kind of join: {how}")
    left = left.select(*left_columns) if left_columns else left
    right = right.select(*right_columns) if right_columns else right
    lk, rk = (_listed(left_on) or _listed(on), _listed(right_on) or _listed(on)) if how != "cross" else ([], [])
    if len(lk) != len(rk) or (how != "cross" and not lk):
        raise RuleError("both sides need as many keys")
    require(left, *lk)
    require(right, *rk)
    shared = {a for a, b in zip(lk, rk, strict=True) if a == b}
    both = (set(left.columns) & set(right.columns)) - shared
    a, b = left.select(*(F.col(c).alias(f"l_{i}") for i, c in enumerate(left.columns))), right.select(*(F.col(c).alias(f"r_{i}") for i, c in enumerate(right.columns)))
    at_l, at_r = {c: F.col(f"l_{i}") for i, c in enumerate(left.columns)}, {c: F.col(f"r_{i}") for i, c in enumerate(right.columns)}
    if how == "cross":
        joined = a.crossJoin(b)
    else:
        joined = a.join(b, reduce(Column.__and__, [at_l[x].eqNullSafe(at_r[y]) for x, y in zip(lk, rk, strict=True)]), KINDS[how])
    out = [(F.coalesce(at_l[c], at_r[c]) if c in shared else at_l[c]).alias(c + suffixes[0] if c in both else c) for c in left.columns]
    out += [at_r[c].alias(c + suffixes[1] if c in both else c) for c in right.columns if c not in shared]
    return joined.select(*out)


def semi(df: DataFrame, keys: DataFrame, on: str, other: str | None = None, keep: bool = True) -> DataFrame:
    """Rows whose key is (or, with keep=False, is not) among another table's."""
    ids = keys.select(F.col(other or on).alias("__key"))
    return df.join(ids, F.col(on) == F.col("__key"), "left_semi" if keep else "left_anti")


def exists_flag(df: DataFrame, keys: DataFrame, on: str, out: str) -> DataFrame:
    ids = keys.select(F.col(on).alias("__key")).distinct()
    return df.join(ids, F.col(on) == F.col("__key"), "left").withColumn(out, F.col("__key").isNotNull()).drop("__key")


def backfill(df: DataFrame, other: DataFrame, on: str, column: str) -> DataFrame:
    """Fill nulls of ``column`` from another table with distinct keys."""
    values = other.select(F.col(on).alias("__key"), F.col(column).alias("__value"))
    return df.join(values, F.col(on) == F.col("__key"), "left").withColumn(column, F.coalesce(column, "__value")).drop("__key", "__value")


def root_documents(df: DataFrame, prefix: str = "metadata_root_document_") -> DataFrame:
    """Title, description, url and content type of each row's root document, looked up in the table itself."""
    source = {"title": "title", "metadata_description": "description", "metadata_url": "url", "content_type": "content_type"}
    wanted = df.select(F.col(f"{prefix}id").alias("__root")).where("__root IS NOT NULL").distinct()
    roots = df.join(wanted, F.col("id") == F.col("__root"), "left_semi").groupBy("id").agg(*(F.min_by(c, F.struct(*source)).alias(prefix + name) for c, name in source.items()))
    return df.drop(*(prefix + n for n in source.values())).join(roots.withColumnRenamed("id", "__root"), F.col(f"{prefix}id") == F.col("__root"), "left").drop("__root")
