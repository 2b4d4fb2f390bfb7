"""Row filters of cleaning rules; every one is a lazy DataFrame -> DataFrame that Catalyst can push down.

Nulls: equality and orderings drop them, inequality and negations keep them,
both date filters drop them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.errors import RuleError
from docloom.functions.columns import is_array, matches, require

#: The ways an operator may be written.
OPERATORS = {
    "==": "eq", "=": "eq", "eq": "eq",
    "!=": "ne", "<>": "ne", "ne": "ne",
    ">": "gt", "gt": "gt",
    ">=": "ge", "=>": "ge", "ge": "ge",
    "<": "lt", "lt": "lt",
    "<=": "le", "=<": "le", "le": "le",
    "regex": "regex", "in": "in", "not in": "not in",
}


def operator_name(written: str | None) -> str:
    """Anything unknown means equality."""
    return OPERATORS.get((written or "").strip().lower(), "eq")


def predicate(df: DataFrame, column: str, value: Any, operator: str | None = None) -> Column:
    """The condition under which a row stays."""
    require(df, column)
    name, c = operator_name(operator), F.col(column)
    many = isinstance(value, (list, tuple, set))
    inside = lambda: F.coalesce(c.isin(list(value)), F.lit(False))
    if name == "eq":
        return inside() if many else c == F.lit(value)
    if name == "ne":
        return ~inside() if many else ~c.eqNullSafe(F.lit(value))
    if name in ("in", "not in"):
        if many:
            found = F.coalesce(F.arrays_overlap(c, F.array(*map(F.lit, value))), F.lit(False)) if is_array(df, column) else inside()
        elif is_array(df, column):
            found = F.coalesce(F.array_contains(c, value), F.lit(False))
        else:
            found = F.coalesce(F.contains(c.cast("string"), F.lit(str(value))), F.lit(False))
        return ~found if name == "not in" else found
    if name == "regex":
        raise RuleError("patterns belong to filter_by_match or filter_by_columns")
    return {"gt": c > F.lit(value), "ge": c >= F.lit(value), "lt": c < F.lit(value), "le": c <= F.lit(value)}[name]


def filter_by_column(df: DataFrame, column: str, value: Any, operator: str | None = None) -> DataFrame:
    return df.where(predicate(df, column, value, operator))


def filter_by_match(df: DataFrame, column: str, value: str) -> DataFrame:
    require(df, column)
    return df.where(matches(F.col(column), value))


def remove_by_match(df: DataFrame, column: str, value: str) -> DataFrame:
    require(df, column)
    return df.where(~matches(F.col(column), value))


def filter_by_columns(df: DataFrame, filters: Mapping[str, Sequence]) -> DataFrame:
    """All of ``{column: (value[, operator])}`` in one predicate."""
    terms = []
    for column, spec in filters.items():
        require(df, column)
        value, operator = (*spec, None)[:2] if isinstance(spec, (list, tuple)) else (spec, None)
        if isinstance(value, str) and not value.strip():
            raise RuleError(f"blank value for {column}")
        terms.append(matches(F.col(column), value) if operator_name(operator) == "regex" else predicate(df, column, value, operator))
    return df.where(reduce(Column.__and__, terms)) if terms else df


def filter_by_date_range(df: DataFrame, column: str, start: Any, end: Any) -> DataFrame:
    require(df, column)
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def exclude_by_date_range(df: DataFrame, column: str, start: Any, end: Any) -> DataFrame:
    require(df, column)
    return df.where((F.col(column) < F.lit(start)) | (F.col(column) > F.lit(end)))


def remove_null_or_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty strings become null in every column, then rows with a null in ``columns`` go."""
    require(df, *columns)
    texts = {c: F.nullif(F.col(c), F.lit("")) for c, kind in df.dtypes if kind == "string"}
    return df.withColumns(texts).na.drop(subset=list(columns)) if texts else df.na.drop(subset=list(columns))


def changed_rows(df: DataFrame, load_type: str, action: str = "action") -> DataFrame:
    """Inserted and updated rows; all of them in a full load."""
    return df if load_type.upper() == "FULL" else df.where(F.col(action).isin("I", "U"))


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy ``valid``, and the others."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)
