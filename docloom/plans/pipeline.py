"""Pipelines of named steps: tables in, tables out, one Spark session; a step may be written before the next reads it."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from docloom.errors import ConfigError
from docloom.functions.ports import Chat, Deployed, Embedder, HashingEmbedder, TemplateChat
from docloom.operators import chunk, delta, embed, joins, project, semantic, sets, transform, translate
from docloom.plans.config import deployment, quota
from docloom.plans.hooks import Hooks
from docloom.plans.rules import clean
from docloom.session import materialize
from docloom.sources.readers import matching

#: Steps that a configuration may name, and what a lone chunk step stands for in question pipelines.
STEPS = ("transform", "clean", "chunk", "metadata", "embed", "file_check", "translate", "merge", "drop", "run", "concatenate")
DEFAULT = ("transform", "clean", "chunk", "embed")
SEMANTIC = ("semantic.chunk", "semantic.cluster", "semantic.merge", "semantic.validate")


@dataclass
class Step:
    name: str
    kind: str
    inputs: Sequence[str] = ()
    options: Mapping[str, Any] = field(default_factory=dict)
    write: bool = False


Run = Callable[..., DataFrame]


@dataclass
class Pipeline:
    """Steps in order of their inputs; other kinds of step are added with :meth:`define`."""

    steps: Sequence[Step]
    hooks: Hooks = field(default_factory=Hooks)
    kinds: dict[str, Run] = field(default_factory=dict)
    make_embedder: Callable[[], Embedder] = HashingEmbedder
    make_chat: Callable[[], Chat] = TemplateChat

    def __post_init__(self) -> None:
        self.kinds = {
            "transform": self._transform,
            "clean": lambda df, rules=(), **_: clean(df, rules, self.hooks),
            "metadata": lambda df, prompts=("description", "keywords", "questions"), **o: self.hooks.apply("metadata_transform", embed.generate_metadata(df, prompts, self.make_chat, **o)),
            "embed": lambda df, column="chunk", **o: self.hooks.apply("post_embed", embed.create_embeddings(self.hooks.apply("pre_embed", df), column, self.make_embedder, **o)),
            "file_check": self._file_check,
            "translate": lambda df, columns, source="metadata_language", target="English", **o: translate.translate(df, columns, source, target, self.make_chat, **o),
            "semantic.chunk": lambda df, **o: semantic.create_questions(df, self.make_chat, **o)[0],
            "semantic.cluster": lambda df, **o: semantic.clustered(df, self.make_embedder, **o),
            "semantic.merge": lambda df, **o: semantic.merge_small_clusters(df, self.make_chat, **o),
            "semantic.validate": lambda questions, documents, **o: semantic.validate(questions, documents, self.make_chat, **o),
            "chunk": lambda df, **o: self.hooks.apply("post_chunk", chunk.chunk_documents(self.hooks.apply("pre_chunk", df), **o)),
            "merge": lambda a, b, **o: joins.merge(a, b, **o),
            "concatenate": lambda *tables, **_: sets.concatenate(*tables),
            "drop": lambda df, columns=(), **_: project.drop_columns(df, columns),
            "run": lambda df, **o: self.hooks.apply("run", df, **o),
        } | self.kinds

    def _transform(self, df: DataFrame, json_col: str = "value", mapping: Mapping[str, Any] | None = None, root: str | None = None, delimiter: str | None = None, content_column: str = "content_full", **_: Any) -> DataFrame:
        """Records in, curated documents out; records that cannot be read drop out here."""
        documents = self.hooks.apply("post_transform", materialize(transform.map_records(df, json_col, dict(mapping) if mapping else None, root, delimiter)))
        return transform.curate(documents, transform.metadata_keys(documents), content_column)

    def _file_check(self, df: DataFrame, pattern: str | None = None, least: int = 1, **_: Any) -> DataFrame:
        """The table as it is, once at least so many files match the pattern; without a pattern, once it has so many rows."""
        found = len(matching(df.sparkSession, pattern)) if pattern else df.limit(least).count()
        if found < least:
            raise ConfigError(f"{pattern or 'the input'} has {found} files or rows instead of {least} or more")
        return df

    def define(self, kind: str, run: Run) -> None:
        self.kinds[kind] = run

    def ordered(self) -> list[Step]:
        """Each step after those it reads; a cycle is an error."""
        named, done, out = {s.name: s for s in self.steps}, set(), []
        if len(named) != len(self.steps):
            raise ConfigError("steps need distinct names")

        def visit(step: Step, above: tuple[str, ...]) -> None:
            if step.name in above:
                raise ConfigError(f"steps read each other: {' -> '.join((*above, step.name))}")
            if step.name not in done:
                for name in step.inputs:
                    if name in named:
                        visit(named[name], (*above, step.name))
                done.add(step.name)
                out.append(step)

        for step in self.steps:
            visit(step, ())
        return out

    def run(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        found = dict(tables)
        for step in self.ordered():
            if step.kind not in self.kinds:
                raise ConfigError(f"unknown kind of step: {step.kind}")
            missing = [n for n in step.inputs if n not in found]
            if missing:
                raise ConfigError(f"{step.name} reads unknown tables: {', '.join(missing)}")
            made = self.kinds[step.kind](*(found[n] for n in step.inputs), **step.options)
            found[step.name] = materialize(made) if step.write else made
        return found

    def plan(self) -> str:
        """The steps and their inputs as JSON, for an outside scheduler."""
        return json.dumps([{"name": s.name, "kind": s.kind, "inputs": list(s.inputs), "options": dict(s.options)} for s in self.ordered()], default=str)


def loaded(step: Callable[[DataFrame], DataFrame], df: DataFrame, previous: DataFrame | None, load_type: str, **options: Any) -> DataFrame:
    """Run a step on what changed and add what is carried over; with nothing to do the carried rows are the output."""
    todo, carried = delta.prepare(df, load_type, previous, **options)
    return delta.merge_loads(step(todo), carried)


def expand_steps(names: Sequence[str] | None, questions: bool = False) -> list[str]:
    """Step names of a configuration; none means the default ones, and chunk may stand for the question steps."""
    wanted = list(names or DEFAULT)
    unknown = [n for n in wanted if n.split(".")[0] not in (*STEPS, "semantic")]
    if unknown:
        raise ConfigError(f"unknown steps: {', '.join(unknown)}")
    return [x for n in wanted for x in (SEMANTIC if questions and n == "chunk" else (n,))]


def from_config(spark: SparkSession, config: Mapping[str, Any], hooks: Hooks | None = None, make_embedder: Callable[[], Embedder] = HashingEmbedder, make_chat: Callable[[], Chat] = TemplateChat) -> Pipeline:
    """Steps from ``pipeline: [{name, type, inputs, ...options}]``; a step without inputs reads the one before it.

    ``models: {chat, embed}`` name entries of ``deployments``, whose quotas all calls of a step share.
    """
    steps, before = [], "input"
    for item in config.get("pipeline") or [{"name": n, "type": n} for n in DEFAULT]:
        options = {k: v for k, v in item.items() if k not in ("name", "type", "inputs", "write")}
        base = {k: v for k, v in (config.get(item["type"]) or {}).items()}
        steps.append(Step(item["name"], item["type"], item.get("inputs") or (before,), base | options, bool(item.get("write"))))
        before = item["name"]
    models = config.get("models") or {}
    paced = lambda make, use: Deployed(make, quota(deployment(config.get("deployments") or [], models[use]))) if use in models else make
    return Pipeline(steps, hooks or Hooks(), make_embedder=paced(make_embedder, "embed"), make_chat=paced(make_chat, "chat"))
