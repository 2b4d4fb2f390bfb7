"""Embedding of distinct texts, zero vectors, and calls of a chat model by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.columns import is_zero_vector, require
from docloom.functions.ports import PROMPTS, TEMPLATES, Chat, Embedder, Throttle, render
from docloom.functions.tokens import count_tokens, token_batches
from docloom.session import materialize


def _leased(df: DataFrame, make: Callable[[], object], throttle: Throttle | None) -> tuple[DataFrame, Callable[[], Throttle]]:
    """The rows, and what makes a task's own pace. A bounded quota is leased in equal parts to as many partitions as can run at once."""
    quota = throttle or getattr(make, "throttle", None) or Throttle()
    if not quota.bounded:
        return df, lambda: replace(quota)
    parts = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parts), lambda: quota.lease(TaskContext.get().partitionId() % parts, parts)


def embed_texts(texts: DataFrame, column: str, make: Callable[[], Embedder], out: str = "embedding", throttle: Throttle | None = None, most_tokens: float = 100_000) -> DataFrame:
    """(column, out) of the distinct texts; a text that fails gets a zero vector. A vector of other dimensions than the model's is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, pace = make(), lease()
        for batch in batches:
            found, vectors = batch.column(0).to_pylist(), []
            zero = [0.0] * model.dimensions
            # calls of bounded size, each within the quota; one that fails gives zero vectors for its texts
            for some in token_batches(found, most_tokens):
                made = pace.call(lambda some=some: model.embed(some), sum(map(count_tokens, some))) or []
                wrong = {len(v) for v in made if v} - {model.dimensions}
                if wrong or len(made) > len(some):
                    raise ValueError(f"a model of {model.dimensions} dimensions gave {len(made)} vectors for {len(some)} texts, of dimensions {sorted(wrong) or model.dimensions}")
                vectors += [v or zero for v in made] + [zero] * (len(some) - len(made))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.float32()))], [column, out])

    rows, lease = _leased(texts.select(column).where(F.col(column).isNotNull()).distinct(), make, throttle)
    return rows.mapInArrow(run, f"`{column}` string, `{out}` array<float>")


def create_embeddings(df: DataFrame, column: str, make: Callable[[], Embedder], out: str = "embedding", previous: DataFrame | None = None) -> DataFrame:
    """Keeps vectors that rows have and that are not all zero; every other text is embedded once and joined back.

    ``previous``, an earlier output with the same two columns, gives its vectors to texts that it knows (the least of several,
    none that is null or all zero); it is cut down to these texts first, and the model sees the others only.
    """
    require(df, column)
    own = F.when(~F.coalesce(is_zero_vector(F.col(out)), F.lit(True)), F.col(out)) if out in df.columns else F.lit(None).cast("array<float>")
    rows = df.withColumn("__own", own)
    todo = rows.where(F.col("__own").isNull() & F.col(column).isNotNull()).select(column).distinct()
    made = None
    if previous is not None:
        known = previous.where(~F.coalesce(is_zero_vector(F.col(out)), F.lit(True))).select(column, F.col(out).cast("array<float>").alias("__new"))
        known = known.join(todo, column, "left_semi").groupBy(column).agg(F.min("__new").alias("__new"))
        todo, made = todo.join(known, column, "left_anti"), known
    fresh = embed_texts(todo, column, make, "__new")
    made = (fresh if made is None else fresh.unionByName(made)).withColumnRenamed(column, "__text")
    joined = rows.join(made, F.col("__own").isNull() & (F.col(column) == F.col("__text")), "left")
    return joined.withColumn(out, F.coalesce("__own", "__new")).drop("__own", "__new", "__text")


def ask(df: DataFrame, prompt: str, make: Callable[[], Chat], out: str, variables: dict[str, str] | None = None, template: str | None = None, throttle: Throttle | None = None, most_tokens: float = 100_000) -> DataFrame:
    """Adds the answers to a prompt rendered from each row; a variable without such a column stands for itself. The rows are written once, as a model's answers may differ from call to call."""
    variables, template = variables or PROMPTS[prompt], template or TEMPLATES[prompt]
    names = df.columns
    rows, lease = _leased(df, make, throttle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, pace = make(), lease()
        for batch in batches:
            columns = {v: batch.column(c).to_pylist() if c in names else [c] * batch.num_rows for v, c in variables.items()}
            prompts = [render(template, dict(zip(columns, row, strict=True))) for row in zip(*columns.values(), strict=True)]
            answers: list[str | None] = []
            for some in token_batches(prompts, most_tokens):
                answers += pace.call(lambda some=some: model.answer(some), sum(map(count_tokens, some))) or [None] * len(some)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], [*batch.schema.names, out])

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return materialize(rows.mapInArrow(run, f"{schema}, `{out}` string"))


def generate_metadata(df: DataFrame, prompts: Sequence[str], make: Callable[[], Chat], enabled: bool = True) -> DataFrame:
    """A column ``metadata_<prompt>`` each; a failed call gives an empty text."""
    for prompt in prompts if enabled else ():
        df = ask(df, prompt, make, f"metadata_{prompt}").withColumn(f"metadata_{prompt}", F.coalesce(f"metadata_{prompt}", F.lit("")))
    return df
