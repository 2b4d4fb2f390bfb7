"""Cleaning rules as configuration: a list of names and arguments becomes one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.errors import RuleError
from docloom.operators import dedupe, filters, text
from docloom.plans.hooks import Hooks

Step = Callable[[DataFrame], DataFrame]

#: Per rule: its function and the arguments that must be there and not blank (numbers may be 0).
RULES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "replace_substrings": (text.replace_substrings, ("columns", "substrings", "replacement")),
    "remove_substrings": (text.remove_substrings, ("columns", "substrings")),
    "remove_null_or_empty": (filters.remove_null_or_empty, ("columns",)),
    "filter_by_date_range": (filters.filter_by_date_range, ("column", "start", "end")),
    "exclude_by_date_range": (filters.exclude_by_date_range, ("column", "start", "end")),
    "filter_by_columns": (filters.filter_by_columns, ("filters",)),
    "filter_by_column": (filters.filter_by_column, ("column", "operator", "value")),
    "filter_by_match": (filters.filter_by_match, ("column", "value")),
    "remove_by_match": (filters.remove_by_match, ("column", "value")),
    "remove_duplicates": (dedupe.remove_duplicates, ("columns",)),
    "reference_to_inline": (text.reference_to_inline, ("column",)),
}


def rule(spec: Mapping[str, Any]) -> Step:
    """From ``{"rule": name, **arguments}``."""
    name = str(spec.get("rule") or spec.get("type") or "").lower()
    if name not in RULES:
        raise RuleError(f"unknown rule: {name}")
    run, needed = RULES[name]
    arguments = {k: v for k, v in spec.items() if k not in ("rule", "type", "name")}
    for key in needed:
        value = arguments.get(key)
        if value is None or (isinstance(value, (str, list, tuple, dict)) and not value):
            raise RuleError(f"{name} needs {key}")
    return lambda df: run(df, **arguments)


def clean(df: DataFrame, rules: Sequence[Mapping[str, Any]], hooks: Hooks | None = None) -> DataFrame:
    """All rules in order, then the ``documents_clean`` hook. Catalyst merges the filters; nothing is counted between."""
    out = reduce(lambda d, r: rule(r)(d), rules, df)
    return hooks.apply("documents_clean", out) if hooks else out


def removed_counts(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """(step, rule, rows, removed) of each rule in order: the rows that it leaves and those that it takes out. A report: each step is counted in a run of its own."""
    counts, out = [df.agg(F.count("*").alias("rows")).select(F.lit(0).alias("step"), F.lit("").alias("rule"), "rows")], df
    for step, spec in enumerate(rules, 1):
        out = rule(spec)(out)
        counts.append(out.agg(F.count("*").alias("rows")).select(F.lit(step).alias("step"), F.lit(str(spec.get("rule") or spec.get("type"))).alias("rule"), "rows"))
    # one row a rule
    before = F.lag("rows").over(Window.partitionBy(F.lit(0)).orderBy("step"))
    return reduce(DataFrame.unionAll, counts).withColumn("removed", before - F.col("rows")).where("step > 0")
