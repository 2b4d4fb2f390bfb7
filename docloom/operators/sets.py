"""Unions by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concatenate(*tables: DataFrame) -> DataFrame:
    """All rows; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def onto(columns_of: DataFrame, df: DataFrame) -> DataFrame:
    """df with exactly the columns of another table; missing ones are null."""
    return df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns_of.schema))


def difference(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    return df.join(other.select(F.col(on).alias("__key")), F.col(on) == F.col("__key"), "left_anti")
