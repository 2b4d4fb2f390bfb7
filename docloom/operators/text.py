"""Text rewriting rules."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.errors import RuleError
from docloom.functions.columns import is_pattern, java_regex, java_replacement, require


def rewritten(column: Column, substrings: Sequence[str], replacement: str) -> Column:
    """One after the other; what compiles as a pattern is one, anything else is taken literally."""
    for s in substrings:
        column = F.regexp_replace(column, java_regex(s), java_replacement(replacement)) if is_pattern(s) else F.replace(column, F.lit(s), F.lit(replacement))
    return column


def _rewrite(df: DataFrame, columns: Sequence[str], substrings: Sequence[str] | str, replacement: str) -> DataFrame:
    require(df, *columns)
    several = [substrings] if isinstance(substrings, str) else list(substrings)
    return df.withColumns({c: rewritten(F.col(c), several, replacement) for c in columns})


def replace_substrings(df: DataFrame, columns: Sequence[str], substrings: Sequence[str] | str, replacement: str) -> DataFrame:
    if not replacement:
        raise RuleError("a replacement is needed; remove_substrings takes text out")
    return _rewrite(df, columns, substrings, replacement)


def remove_substrings(df: DataFrame, columns: Sequence[str], substrings: Sequence[str] | str) -> DataFrame:
    return _rewrite(df, columns, substrings, "")


_LINK = re.compile(r"(\[[^\]\n]*\]) ?\[([^\]\n]*)\]")
_DEFINITION = re.compile(r"(?<=\n)[ \t]*\[([^\]\n]*)\]:[ \t]?(.*)")


def inline_links(text: str | None) -> str | None:
    """Markdown reference links with their addresses written in place.

    A definition serves one link (several of a name serve in their order); its text goes, its line break stays. A link
    without a definition left stays as it is.
    """
    if text is None:
        return None
    waiting: dict[str, list[str]] = defaultdict(list)
    for found in _DEFINITION.finditer(text):
        waiting[found[1]].append(found[2].strip())
    if not waiting:
        return text
    body = _DEFINITION.sub("", text)
    return _LINK.sub(lambda m: f"{m[1]}({waiting[m[2]].pop(0)})" if waiting.get(m[2]) else m[0], body)


def reference_to_inline(df: DataFrame, column: str, target_column: str = "content") -> DataFrame:
    """A definition is used up as it serves, which no single regular expression says: an Arrow batch UDF."""
    require(df, column)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(inline_links, na_action="ignore")

    return df.withColumn(target_column, run(F.col(column)))
