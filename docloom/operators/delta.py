"""Change detection between loads, and what each kind of load processes and carries over.

Codes: I inserted, U updated, D deleted, N unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.dedupe import remove_duplicates
from docloom.operators.filters import changed_rows
from docloom.operators.joins import semi
from docloom.operators.sets import concatenate, onto


@dataclass(frozen=True)
class Comparison:
    """Compare two columns of a joined row; both null counts as inserted."""

    left: str
    right: str | None = None
    output: str = "action"

    def apply(self, current: Column) -> Column:
        l, r = F.col(self.left), F.col(self.right or f"{self.left}_prev")  # noqa: E741
        return F.when(l == r, "N").when(l.isNull() & r.isNotNull(), "D").when(r.isNull(), "I").when(l != r, "U").otherwise(current)


@dataclass(frozen=True)
class Expiry:
    """Deleted once the date has passed; no date never expires."""

    column: str = "metadata_expiry"
    output: str = "action"
    now: str | None = None

    def moment(self) -> Column:
        return F.to_timestamp(F.lit(self.now)) if self.now else F.current_timestamp()

    def apply(self, current: Column) -> Column:
        return F.when(F.col(self.column) < self.moment(), "D").otherwise(current)


def compare(df: DataFrame, steps: Sequence[Comparison | Expiry], default: str = "N") -> DataFrame:
    """Run the steps in order; each output starts as ``default``."""
    for step in steps:
        if step.output not in df.columns:
            df = df.withColumn(step.output, F.lit(default))
        df = df.withColumn(step.output, step.apply(F.col(step.output)))
    return df


def compare_with_previous(new: DataFrame, previous: DataFrame, columns: Sequence[str], steps: Sequence[Comparison | Expiry], on: str = "id", how: str = "left") -> DataFrame:
    """Join the earlier values of ``columns`` (suffix _prev) and compare; an outer join also finds deleted rows."""
    old = remove_duplicates(previous.select(F.col(on).alias("__id"), *(F.col(c).alias(f"{c}_prev") for c in columns)), ["__id"])
    joined = new.join(old, F.col(on) == F.col("__id"), "full_outer" if how == "outer" else how)
    return compare(joined.withColumn(on, F.coalesce(on, "__id")).drop("__id"), steps)


def transform_actions(new: DataFrame, previous: DataFrame, on: str = "id", expiry: Expiry = Expiry()) -> DataFrame:
    """The action by md5, D where the document has expired, and flags that tell whether its metadata or its content changed."""
    steps = [Comparison("md5"), expiry, Comparison("metadata_md5", output="metadata_is_modified"), Comparison("content_md5", output="content_is_modified")]
    hashes = ["md5", "metadata_md5", "content_md5"]
    return compare_with_previous(new, previous, hashes, steps, on).drop(*(f"{c}_prev" for c in hashes))


def find_inserts(new: DataFrame, previous: DataFrame, on: str = "id", previous_on: str | None = None) -> DataFrame:
    return semi(new, previous, on, previous_on, keep=False)


def not_expired(df: DataFrame, expiry: Expiry | None) -> DataFrame:
    return df if expiry is None or expiry.column not in df.columns else df.where(F.coalesce(F.col(expiry.column) >= expiry.moment(), F.lit(True)))


def prepare(df: DataFrame, load_type: str, previous: DataFrame | None = None, on: str = "id", previous_on: str | None = None, action: str = "action", force: bool = False, modified: str | None = None, expiry: Expiry | None = Expiry()) -> tuple[DataFrame, DataFrame | None]:
    """(rows to process, rows carried over from the earlier output).

    Earlier rows that are deleted or past ``expiry`` (if they have its column) are not carried. ``force`` processes carried
    rows again as updates and leaves ``modified`` aside. ``modified`` ("metadata" or "content") processes only rows whose
    flag of that name says so, if there is one; the others come from the earlier output as they were, one row for each
    id (the first in the order of all columns). Without an earlier output everything but deletions is processed, whatever ``modified`` says.
    """
    load_type, previous_on = load_type.upper(), previous_on or on
    if action not in df.columns:
        df = df.withColumn(action, F.lit("I"))
    if load_type == "FULL":
        return df, None
    if previous is None:
        return df.where(F.coalesce(F.col(action) != "D", F.lit(True))).withColumn(action, F.when(F.col(action) == "N", "U").otherwise(F.col(action))), None
    if action not in previous.columns:
        previous = previous.withColumn(action, F.lit("N"))
    todo = changed_rows(df, load_type, action)
    if load_type == "DELTA":
        carried = semi(previous, df.where(F.col(action) == "N"), previous_on, on)
    else:
        carried = semi(previous, df.where(F.col(action).isin("I", "U", "D")), previous_on, on, keep=False)
    carried = not_expired(carried, expiry).where(F.coalesce(F.col(action) != "D", F.lit(True))).withColumn(action, F.lit("N"))
    if force:
        return concatenate(todo, carried.withColumn(action, F.lit("U"))), None
    if modified and f"{modified}_is_modified" in todo.columns:
        flag = F.coalesce(F.col(f"{modified}_is_modified").isin("I", "U"), F.lit(False))
        kept = remove_duplicates(semi(previous, todo.where(~flag), previous_on, on), [previous_on])
        return todo.where(flag), concatenate(kept, remove_duplicates(semi(carried, kept, previous_on, keep=False), [previous_on]))
    return todo, carried


def merge_loads(processed: DataFrame, carried: DataFrame | None) -> DataFrame:
    """Processed and carried rows with the columns of the processed ones."""
    return processed if carried is None else processed.unionAll(onto(processed, carried))


def processed_before(previous: DataFrame, processed: DataFrame, on: str = "id", action: str = "action", then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Earlier rows that this run did not make again, as unchanged."""
    rest = semi(previous, processed, on, keep=False)
    return (rest.transform(then) if then else rest).withColumn(action, F.lit("N"))
