"""Data quality suites: all checks of rows and of whole columns in one aggregation, uniqueness of all columns in one more.

``ROW_CHECKS`` and ``COLUMN_CHECKS`` are registries by name: of a column and the check's arguments the former make the
condition of a bad row (null is good), the latter an aggregate and, beside it, the condition that it is bad.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.errors import ConfigError

TYPE = "expect_column_values_to_be_of_type"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
ORDERED = "expect_table_columns_to_match_ordered_list"
ROWS = "expect_table_row_count_to_be_between"
SET = "expect_column_values_to_be_in_set"
MATCH = "expect_column_values_to_match_regex"
BETWEEN = "expect_column_values_to_be_between"



def _outside(x: Column, low: Any = None, high: Any = None) -> Column:
    """Whether a value lies beyond the bounds there are."""
    return (x < low if low is not None else F.lit(False)) | (x > high if high is not None else F.lit(False))


def _in_bounds(measure: Callable[[Column, Mapping[str, Any]], Column]) -> Callable[[Column, Mapping[str, Any]], Column]:
    return lambda x, k: F.coalesce(_outside(measure(x, k), k.get("min_value"), k.get("max_value")), F.lit(True))


ROW_CHECKS: dict[str, Callable[[Column, Mapping[str, Any]], Column]] = {
    NOT_NULL: lambda x, k: x.isNull(),
    SET: lambda x, k: ~x.isin(list(k["value_set"])),
    MATCH: lambda x, k: ~x.rlike(k["regex"]),
    BETWEEN: lambda x, k: _outside(x, k.get("min_value"), k.get("max_value")),
    "expect_column_values_to_be_null": lambda x, k: x.isNotNull(),
    "expect_column_values_to_not_be_in_set": lambda x, k: x.isin(list(k["value_set"])),
    "expect_column_values_to_not_match_regex": lambda x, k: x.rlike(k["regex"]),
    "expect_column_value_lengths_to_be_between": lambda x, k: _outside(F.char_length(x), k.get("min_value"), k.get("max_value")),
}

#: Of a column without values every measure is missing, which is bad. Quantiles and distinct values are sketches that merge: of ``accuracy`` 10,000 and a standard error of 1 percent.
COLUMN_CHECKS: dict[str, Callable[[Column, Mapping[str, Any]], Column]] = {
    "expect_column_min_to_be_between": _in_bounds(lambda x, k: F.min(x)),
    "expect_column_max_to_be_between": _in_bounds(lambda x, k: F.max(x)),
    "expect_column_mean_to_be_between": _in_bounds(lambda x, k: F.avg(x)),
    "expect_column_sum_to_be_between": _in_bounds(lambda x, k: F.sum(x)),
    "expect_column_median_to_be_between": _in_bounds(lambda x, k: F.percentile_approx(x, 0.5, 10_000)),
    "expect_column_unique_value_count_to_be_between": _in_bounds(lambda x, k: F.approx_count_distinct(x, 0.01)),
}

_KINDS = {"object": ("string", "array", "timestamp", "struct"), "str": ("string",), "string": ("string",), "int64": ("bigint", "int"), "float64": ("double", "float"), "bool": ("boolean",)}


@dataclass(frozen=True)
class Check:
    expectation: str
    column: str | None = None
    kwargs: Mapping[str, Any] = field(default_factory=dict)


def expand(suite: Mapping[str, Any]) -> list[Check]:
    """One check for each column that an expectation covers."""
    schema, listed = suite["schema"], suite["expectations"]
    out: list[Check] = []
    for item in listed if schema else ():
        name, kwargs = item["expectation"], item.get("kwargs") or {}
        include, exclude = item.get("include"), item.get("exclude")
        if name == TYPE:
            out += [Check(name, c, {"type_": t}) for c, t in schema.items() if (not include or c in include) and c not in (exclude or ())]
        elif name == NOT_NULL and "column" not in kwargs:
            skipped = exclude if exclude is not None else [c for c in schema if c.startswith("metadata_") or c == "md5_prev"]
            out += [Check(name, c) for c in schema if (not include or c in include) and c not in skipped]
        elif name == ORDERED:
            out.append(Check(name, None, {"column_list": list(schema)}))
        else:
            out.append(Check(name, kwargs.get("column"), {k: v for k, v in kwargs.items() if k != "column"}))
    return out


def combined(base: Mapping[str, Any], custom: Mapping[str, Any]) -> dict[str, Any]:
    return {"schema": {**base["schema"], **custom.get("schema", {})}, "expectations": [*base["expectations"], *custom.get("expectations", [])]}


def _repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failed): rows of each column whose value stands in others too, all columns in one shuffle; nulls are not counted."""
    kinds = dict(df.dtypes)

    def value(c: str) -> Column:
        kind = kinds[c]
        x = F.col(c) + F.lit(0.0).cast(kind) if kind in ("float", "double") else F.col(c)  # one zero
        return F.to_json(F.struct(x)) if kind.startswith(("array", "struct", "map")) else x.cast("string")

    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in columns))).alias("p")).select("p.*").where("value IS NOT NULL")
    failed = pairs.groupBy("column", "value").agg(F.count("*").alias("n")).groupBy("column").agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("failed"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(failed, "column", "left").select("column", F.coalesce("failed", F.lit(0)).cast("bigint").alias("failed"))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(expectation, column, success, failed): bad rows, or 1 for a column or table that is bad as a whole."""
    spark = df.sparkSession
    fixed, counted, apart = [], {}, []
    for i, c in enumerate(checks):
        kind = dict(df.dtypes).get(c.column)
        if c.expectation == ORDERED:
            fixed.append((c.expectation, None, int(df.columns != list(c.kwargs["column_list"]))))
        elif c.expectation == ROWS:
            counted[i] = _outside(F.count("*"), c.kwargs.get("min_value"), c.kwargs.get("max_value")).cast("bigint")
        elif c.column is not None and kind is None:
            fixed.append((c.expectation, c.column, 1))
        elif c.expectation == TYPE:
            fixed.append((c.expectation, c.column, int(not kind.startswith(_KINDS.get(c.kwargs["type_"], (c.kwargs["type_"],))))))
        elif c.expectation == UNIQUE:
            apart.append(c.column)
        elif c.expectation in COLUMN_CHECKS:
            counted[i] = COLUMN_CHECKS[c.expectation](F.col(c.column), c.kwargs).cast("bigint")
        elif c.expectation in ROW_CHECKS:
            counted[i] = F.count_if(F.coalesce(ROW_CHECKS[c.expectation](F.col(c.column), c.kwargs), F.lit(False)))
        else:
            raise ConfigError(f"unknown expectation: {c.expectation}")
    out = spark.createDataFrame(fixed, "expectation string, column string, failed bigint")
    if counted:
        one = df.agg(*(v.alias(f"n{i}") for i, v in counted.items()))
        listed = F.array(*(F.struct(F.lit(checks[i].expectation).alias("expectation"), F.lit(checks[i].column).cast("string").alias("column"), F.col(f"n{i}").alias("failed")) for i in counted))
        out = out.unionByName(one.select(F.inline(listed)))
    if apart:
        out = out.unionByName(_repeated(df, list(dict.fromkeys(apart))).select(F.lit(UNIQUE).alias("expectation"), "column", "failed"))
    return out.select("expectation", "column", (F.col("failed") == 0).alias("success"), "failed")


#: The suite that every cleaned table is checked with.
CLEAN_SUITE = {
    "schema": {"content": "object", "title": "object", "id": "object", "length": "int64", "content_type": "object", "md5": "object", "metadata_region": "object"},
    "expectations": [{"expectation": TYPE}, {"expectation": NOT_NULL, "exclude": ["metadata_region"]}, *({"expectation": UNIQUE, "kwargs": {"column": c}} for c in ("id", "title", "md5"))],
}
