"""Grouping into distinct lists, records and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.columns import require


def distinct_lists(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Per key the distinct values of every other column in the order of first appearance, always as arrays; null keys drop.

    Values travel in structs, so nulls are values like others.
    """
    require(df, *keys, *order_by)
    rest = [c for c in df.columns if c not in keys]
    rows = df.na.drop(subset=list(keys))
    order = F.struct(*order_by) if order_by else F.struct(*rest)
    listed = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(c).alias("v")))), lambda x: x["v"]))
    return rows.groupBy(*keys).agg(*(listed(c).alias(c) for c in rest))


def only_value(column: Column) -> Column:
    """The single value of a list, null when there are several."""
    return F.when(F.size(column) == 1, F.get(column, F.lit(0)))


def concat_texts(df: DataFrame, key: str, text: str, order_by: Sequence[str], separator: str = "\n\n") -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(*order_by, F.col(text).alias("__text"))))
    return df.where(F.col(text).isNotNull()).groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["__text"]), separator).alias(text))


def percent_of_total(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value, the most frequent first; the window runs over one row a value."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    return counts.withColumn("percent", 100.0 * F.col("count") / F.sum("count").over(Window.partitionBy(F.lit(1)))).orderBy(F.desc("count"), column)


def size_category(df: DataFrame, key: str, most: int, out: str = "size_category") -> DataFrame:
    sizes = df.groupBy(key).agg(F.when(F.count("*") > most, "large").otherwise("small").alias(out))
    return df.join(sizes, key)


def static_clusters(df: DataFrame, key: str, previous: str) -> DataFrame:
    """Clusters all of whose two or more rows come from one earlier cluster, provided every row had one."""
    per = df.groupBy(key).agg(F.countDistinct(previous).alias("kinds"), F.count(previous).alias("n"))
    least = df.agg(F.min(previous).alias("least"))
    return per.crossJoin(F.broadcast(least)).where("kinds = 1 AND n > 1 AND least >= 0").select(key)


def head_values(df: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Per key the values of its first row; among rows of the same order the least values."""
    first = F.min_by(F.struct(*columns), F.struct(*order_by, *(F.col(c).alias(f"__{c}") for c in columns)))
    return df.groupBy(key).agg(first.alias("__head")).select(key, "__head.*")


def group_records(df: DataFrame, key: str, columns: Sequence[str], out: str = "records") -> DataFrame:
    """One JSON list of records per key, for prompts."""
    return df.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*columns)))).alias(out))


def action_counts(df: DataFrame, action: str = "action") -> DataFrame:
    return df.agg(*(F.count(F.when(F.col(action) == code, 1)).alias(name) for code, name in (("I", "inserted"), ("U", "updated"), ("D", "deleted"), ("N", "unchanged"))))


def first_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The first k distinct values of a column with how many rows have each, as a report names them; nulls are none."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows")).orderBy(column).limit(k)
