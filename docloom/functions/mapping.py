"""Mapping of nested JSON onto documents, as expressions over VARIANT values.

A mapping names paths: ``id`` and ``name``, ``metadata`` {key: path}, and
``content`` blocks of title, data or columns and rows, and metadata. ``[*]``
stands for every element of an array; the paths of one block move through their
common wildcards together. Lists of lists are values, not levels.

Paths and mappings become Catalyst expressions. The leading path of a block is
walked level by level; its other paths are looked up at the same indices, so
that an element costs a lookup, not a walk through its array.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"\[(\*|\d+)\]|\.?([^.\[\]]+)")
_PLAIN = re.compile(r"[A-Za-z_]\w*", re.ASCII)


def parse_path(path: str) -> list[str | int]:
    """Steps of a JSON path; "*" for any index."""
    body = path.removeprefix("$")
    steps, at = [], 0
    while at < len(body):
        found = _STEP.match(body, at)
        if not found:
            raise ValueError(f"not a path: {path}")
        index, name = found.groups()
        steps.append(name if name is not None else index if index == "*" else int(index))
        at = found.end()
    return steps


def _spelled(step: str | int) -> str:
    if isinstance(step, int):
        return f"[{step}]"
    return f".{step}" if _PLAIN.fullmatch(step) else f'["{step}"]' if "'" in step else f"['{step}']"


def value_at(value: Column, steps: Sequence[str | int], indices: Sequence[Column] = (), kind: str = "variant") -> Column:
    """The value at a path whose wildcards take the indices in turn; null where there is none."""
    left = iter(indices)
    parts, text = [], "$"
    for step in steps:
        if step == "*":
            parts += [F.lit(f"{text}["), next(left).cast("string")]
            text = "]"
        else:
            text += _spelled(step)
    return F.try_variant_get(value, F.concat(*parts, F.lit(text)) if parts else text, kind)


def present(value: Column) -> Column:
    """The value, null instead of JSON's null."""
    return F.when(~F.is_variant_null(value), value)


def every(value: Column, steps: Sequence[str | int], seen: tuple[Column, ...] = ()) -> Column:
    """All values at a path in their order: an array of ``at``, the indices that its wildcards took, and ``value``."""
    if "*" not in steps:
        here = F.struct(F.array(*(i.cast("int") for i in seen)).cast("array<int>").alias("at"), value_at(value, steps).alias("value"))
        return F.filter(F.array(here), lambda m: m["value"].isNotNull())
    cut = list(steps).index("*")
    levels = F.transform(value_at(value, steps[:cut], kind="array<variant>"), lambda e, i: every(e, steps[cut + 1 :], (*seen, i)))
    return F.coalesce(F.flatten(levels), F.array().cast("array<struct<at:array<int>,value:variant>>"))


def first(value: Column, path: str | None) -> Column:
    """The first value at a path that is not null."""
    if not path:
        return F.lit(None).cast("variant")
    steps = parse_path(path)
    if "*" not in steps:
        return present(value_at(value, steps))
    return F.get(F.filter(every(value, steps), lambda m: ~F.is_variant_null(m["value"])), F.lit(0))["value"]


def as_list(value: Column) -> Column:
    """An array's elements; any other value as the only one."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value))


def roots(document: Column, root: str | None) -> Column:
    """Documents under a path; one level of lists is opened. Null where the path has no match."""
    if not root:
        return as_list(document)
    found = every(document, parse_path(root))
    return F.when(F.size(found) > 0, F.flatten(F.transform(found, lambda m: as_list(m["value"]))))


#: Parts of a block; a part that its mapping does not name is null.
BLOCK = "struct<title:variant,data:array<variant>,columns:variant,rows:variant,metadata:map<string,variant>>"


def _blocks(document: Column, spec: dict[str, Any]) -> Column:
    paths = {k: parse_path(p) for k, p in spec.items() if isinstance(p, str)}
    meta = {k: parse_path(p) for k, p in (spec.get("metadata") or {}).items()}
    leading = next((k for k in ("data", "rows", "title") if k in paths), None)
    if leading is None:
        return F.array().cast(f"array<{BLOCK}>")
    levels = paths[leading].count("*")

    def beside(steps: list[str | int], at: Column) -> Column:
        depth = steps.count("*")
        return present(value_at(document, steps, [at[i] for i in range(depth)])) if depth <= levels else F.lit(None).cast("variant")

    def block(match: Column) -> Column:
        none = F.lit(None)
        return F.struct(
            (beside(paths["title"], match["at"]) if "title" in paths else none.cast("variant")).alias("title"),
            (as_list(match["value"]) if leading == "data" else none.cast("array<variant>")).alias("data"),
            (beside(paths["columns"], match["at"]) if "columns" in paths else none.cast("variant")).alias("columns"),
            (match["value"] if leading == "rows" else none.cast("variant")).alias("rows"),
            (F.create_map(*(x for k, p in meta.items() for x in (F.lit(k), beside(p, match["at"])))) if meta else none.cast("map<string,variant>")).alias("metadata"),
        )

    found = F.filter(every(document, paths[leading]), lambda m: ~F.is_variant_null(m["value"]))
    return F.transform(found, block)


def checked(mapping: dict[str, Any]) -> dict[str, Any]:
    for needed in ("id", "name"):
        if needed not in mapping:
            raise ValueError(f"the mapping lacks {needed}")
    return mapping


def content(document: Column, mapping: dict[str, Any]) -> Column:
    """The blocks of all content specifications, one after the other: an array of ``BLOCK``."""
    parts = [_blocks(document, spec) for spec in mapping.get("content") or []]
    return F.concat(*parts) if parts else F.array().cast(f"array<{BLOCK}>")


def metadata(document: Column, mapping: dict[str, Any], defaults: dict[str, str]) -> Column:
    """A map in the order of its keys: what the mapping finds, the defaults for what it does not."""
    paths = mapping.get("metadata") or {}
    default = lambda k: [F.parse_json(F.lit(json.dumps(defaults[k])))] if k in defaults else []
    entries = [x for k in sorted({*defaults, *paths}) for x in (F.lit(k), F.coalesce(first(document, paths.get(k)), *default(k)))]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def own_metadata(document: Column, defaults: dict[str, str]) -> Column:
    """The same of a document that is not mapped: its own object of metadata; null where that is no object."""
    held = value_at(document, ["metadata"])
    values = F.when(held.isNull() | F.is_variant_null(held), F.create_map().cast("map<string,variant>")).otherwise(F.try_variant_get(held, "$", "map<string,variant>"))
    given = F.map_filter(values, lambda _, v: ~F.is_variant_null(v))
    absent = F.map_filter(F.create_map(*(x for k, v in defaults.items() for x in (F.lit(k), F.parse_json(F.lit(json.dumps(v)))))), lambda k, _: ~F.map_contains_key(given, k))
    together = F.map_concat(given, absent)
    return F.map_from_entries(F.transform(F.array_sort(F.map_keys(together)), lambda k: F.struct(k, together[k])))
