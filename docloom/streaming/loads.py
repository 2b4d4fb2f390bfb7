"""Beyond batch loads: the same rule chains and change codes on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.plans.rules import rule

#: Rules that look at one row at a time and so run on a stream as they are.
STATELESS = ("replace_substrings", "remove_substrings", "remove_null_or_empty", "filter_by_date_range", "exclude_by_date_range", "filter_by_columns", "filter_by_column", "filter_by_match", "remove_by_match", "reference_to_inline")


def clean_stream(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    for spec in rules:
        if spec.get("rule") not in STATELESS:
            raise ValueError(f"{spec.get('rule')} needs all rows; use it in each batch")
        df = rule(spec)(df)
    return df


def windowed_counts(events: DataFrame, time: str = "ts", by: Sequence[str] = ("event_type",), width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their summed value by window; state ends ``late`` after a window's end."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def changes(rows: DataFrame, before: DataFrame, order_by: str | None = None, action: str = "action", whole: Sequence[str] = ()) -> DataFrame:
    """The last row of each key of a batch beside what was known of the key; ``__code`` is null where nothing changes.

    ``rows`` have a key and their content's hash in ``__key`` and ``__content``, as has ``before`` in ``__key`` and ``__known``,
    whose other keys are kept. A row whose own ``action`` is D deletes its key, and does nothing if the key is unknown. Of
    several rows of a key the last by ``order_by`` counts, then by its content, deletion and the columns of ``whole``.
    """
    gone = F.coalesce(F.col(action) == "D", F.lit(False)) if action in rows.columns else F.lit(False)
    # no number comes before all numbers, as null does
    place = [] if not order_by else [F.when(~F.isnan(order_by), F.col(order_by)) if dict(rows.dtypes)[order_by] in ("float", "double") else F.col(order_by)]
    ties = [F.md5(F.to_json(F.struct(*whole), _TIMES))] if whole else []
    newest = Window.partitionBy("__key").orderBy(*(F.desc(c) for c in (*place, F.col("__content"), F.col("__gone"), *ties)))
    last = rows.withColumn("__gone", gone).withColumn("__nth", F.row_number().over(newest)).where("__nth = 1").drop("__nth")
    code = F.expr("CASE WHEN __content IS NULL THEN NULL WHEN __gone THEN if(__known IS NULL, NULL, 'D') WHEN __known IS NULL THEN 'I' WHEN __known <> __content THEN 'U' END")
    return last.join(before, "__key", "full_outer").withColumn("__code", code)


def _known(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The keys that the batch before this one left, with their content's hash."""
    kind = "__key string, __known string, batch bigint"
    if number == 0:
        return spark.createDataFrame([], kind).drop("batch")
    table = spark.read.schema(kind).parquet(f"{path}/{(number - 1) % 2}")
    if not table.where(F.col("batch") != number - 1).isEmpty():
        raise ValueError(f"{path} does not have what batch {number - 1} left")
    return table.drop("batch")


def incremental(stream: DataFrame, path: str, step: Callable[[DataFrame], DataFrame], checkpoint: str, key: str = "id", compare: Sequence[str] | None = None, order_by: str | None = None) -> StreamingQuery:
    """Write what each micro-batch inserts, changes or deletes to its own folder, so a batch that runs again replaces itself.

    ``step`` processes inserted and changed rows; deleted ones are written as they came, with D; what came before unchanged
    is left out. ``compare`` names the columns that tell a change (all but ``action`` if none are named). Rows without a key
    are known by their content. See :func:`changes`.

    The hash of the row last seen of each key is in a table in the checkpoint's folder, by turns at one of two places: no
    earlier output is read, and a batch that runs again, which only the last one does, finds what the one before it left. A
    batch is read once for its rows and once for their hashes, so ``stream`` must give the same rows both times.
    """
    columns = [c for c in stream.columns if c != "action"]
    content = F.md5(F.to_json(F.struct(*(compare or columns)), _TIMES | {"ignoreNullFields": "false"}))
    rows = stream.withColumns({"__key": F.coalesce(F.col(key).cast("string"), content), "__content": content})

    def write(batch: DataFrame, number: int) -> None:
        made = changes(batch, _known(batch.sparkSession, f"{checkpoint}/known", number), order_by, whole=columns if compare else ())
        found = made.where("__code IS NOT NULL").select(*columns, F.col("__code").alias("action"))
        kept = F.col("action") != "D"
        done = step(found.where(kept)).unionByName(found.where(~kept), allowMissingColumns=True)
        done.write.mode("overwrite").parquet(f"{path}/batch={number}")
        known = made.where("__gone IS NULL OR NOT __gone").select("__key", F.coalesce("__content", "__known").alias("__known"), F.lit(number).cast("bigint").alias("batch"))
        known.write.mode("overwrite").parquet(f"{checkpoint}/known/{number % 2}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """What the loads of :func:`incremental` come to: of each key the row written last, unless it is deleted."""
    rows = spark.read.parquet(path)
    content = F.md5(F.to_json(F.struct(*(c for c in rows.columns if c not in ("batch", "action"))), _TIMES))
    newest = Window.partitionBy(F.coalesce(F.col(key).cast("string"), content)).orderBy(F.desc("batch"))
    return rows.withColumn("__nth", F.row_number().over(newest)).where("__nth = 1 AND action <> 'D'").drop("__nth", "batch")
