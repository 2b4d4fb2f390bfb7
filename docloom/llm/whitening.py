"""Whitening of embeddings: each vector on the widest principal components of all, every component with variance 1.

A component c of a vector becomes the whole number x = floor(scale * c) + offset. Sums of
the x give exact deviations n * x - S as longs; only then are they divided, so a
large offset costs no digit. MLlib's ``computeSVD`` works on the rows of centred
vectors, distributed; a singular value s of n rows is an eigenvalue s * s / n of
the covariance. The total variance comes from the exact squared deviations, not
from the decomposition, and the whitened rows' covariance is summed up again from
what is returned.

Only sums and matrices of the vectors' dimensions reach the driver; the
projection (dimensions times components) travels with the tasks.

Defined cases: vectors that are null or hold nulls, NaN or infinities take no
part; nor do those of another length than most have (of two lengths equally
frequent the shorter goes), empty ones among them; components whose singular
value is within ``LEAST`` of the largest do not vary and are not returned, so
equal vectors, a single one or an empty table give an empty result; repeated rows
and rows without an id count and return like others; a component, sum or
deviation that leaves a long fails; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Singular values under this share of the largest are rounding errors of sums of squares.
LEAST = 1e-6


def _matrix(rows: DataFrame, column: str, width: int) -> RowMatrix:
    vectors = rows.select(array_to_vector(F.col(column)).alias("row"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "row"), 0, width)


def _moved(column: pa.Array, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of usable vectors the rows that have it and their whole numbers."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.asarray(pc.fill_null(lists.value_lengths(), 0), np.int64)
    values = lists.flatten()
    bad = np.asarray(pc.is_null(values)) | ~np.isfinite(np.asarray(pc.fill_null(values, np.nan)))
    values = np.asarray(pc.fill_null(values, np.nan))
    ends = np.cumsum(sizes)
    spoiled = np.concatenate([[0], np.cumsum(bad)])
    usable = (sizes > 0) & (spoiled[ends] == spoiled[ends - sizes])
    for size in np.unique(sizes[usable]):
        rows = np.flatnonzero(usable & (sizes == size))
        x = np.floor(scale * values[(ends[rows] - size)[:, None] + np.arange(size)])
        if np.abs(x).max() + abs(offset) >= 2**62:
            raise OverflowError("a component times the scale leaves a long")
        yield rows, x.astype(np.int64) + offset


def _within_long(n: int) -> int:
    if abs(n) >= 2**63:
        raise OverflowError("a sum leaves a long")
    return n


def _sums(vectors: DataFrame, vector_col: str, scale: int, offset: int) -> tuple[int, list[int], bool]:
    """How many vectors have the most frequent length, the sums of their components, and whether any component varies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in _moved(batch.column(0), scale, offset):
                exact = x if len(x) * int(np.abs(x).max()) < 2**62 else x.astype(object)
                n, total, low, high = held.get(x.shape[1], (0, 0, x[0], x[0]))
                held[x.shape[1]] = (n + len(rows), total + exact.sum(axis=0).astype(object), np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0)))
        for size, (n, total, low, high) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array([_within_long(t) for t in total], pa.int64()), pa.array(low), pa.array(high)], ["size", "place", "n", "sum", "low", "high"])

    parts = vectors.select(vector_col).mapInArrow(run, "size int, place int, n bigint, sum bigint, low bigint, high bigint")
    found = parts.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    if not found:
        return 0, [], False
    n, size = max((r["n"], r["size"]) for r in found)
    own = sorted((r for r in found if r["size"] == size), key=lambda r: r["place"])
    return n, [r["sum"] for r in own], any(r["low"] < r["high"] for r in own)


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 0, id_col: str = "id", vector_col: str = "vector") -> DataFrame:
    """For each row and component: id_col, component (from 1, widest first), n, deviation, whitened, explained, identity_error.

    ``deviation`` is the sum of (n * x - S)^2 over the dimensions, ``explained`` the component's share of the total
    variance, ``identity_error`` the largest distance of the whitened rows' covariance from the identity.
    """
    rows = vectors.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("__vector"))
    kind = dict(rows.dtypes)["__id"]
    schema = f"`{id_col}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    n, sums, varies = _sums(rows, "__vector", scale, offset)
    if not varies:
        return vectors.sparkSession.createDataFrame([], schema)
    width, total = len(sums), np.array(sums, object)

    def centred(batches: Iterator[pa.RecordBatch], then: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Of each usable row its id, its exact deviation, and what ``then`` makes of its centred vector."""
        longs = np.array([_within_long(t) for t in sums], np.int64)
        for batch in batches:
            for of, x in _moved(batch.column("__vector"), scale, offset):
                if x.shape[1] != width:
                    continue
                fits = n * int(np.abs(x).max()) + max(map(abs, sums)) < 2**62
                moved = n * x - longs if fits else n * x.astype(object) - total
                exact = moved if fits and width * int(np.abs(moved).max()) ** 2 < 2**62 else moved.astype(object)
                deviation = pa.array((exact * exact).sum(axis=1).tolist(), pa.decimal128(38, 0)) if exact.dtype == object else pa.array((exact * exact).sum(axis=1)).cast(pa.decimal128(38, 0))
                made = then((moved / n).astype(np.float64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32()), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("__id").take(pa.array(of)), deviation, lists], ["__id", "deviation", "made"])

    made_schema = f"__id {kind}, deviation decimal(38,0), made array<double>"
    parts = _matrix(rows.mapInArrow(lambda batches: centred(batches, lambda c: c), made_schema), "made", width).computeSVD(min(components, width), computeU=False, rCond=LEAST)
    eigenvalues = np.array(parts.s.toArray()) ** 2 / n
    projection = parts.V.toArray() / np.sqrt(eigenvalues)
    whitened = rows.mapInArrow(lambda batches: centred(batches, lambda c: c @ projection), made_schema)
    means, squares = whitened.agg(Summarizer.mean(array_to_vector(F.col("made"))), F.sum(F.col("deviation").cast("double"))).first()
    variance = squares / n / n / n
    at_mean = F.array(*(F.lit(float(m)) for m in means.toArray()))
    level = whitened.select(F.zip_with("made", at_mean, lambda w, m: w - m).alias("level"))
    covariance = _matrix(level, "level", len(eigenvalues)).computeGramianMatrix().toArray() / n
    error = float(np.abs(covariance - np.eye(len(eigenvalues))).max())
    explained = F.array(*(F.lit(float(e / variance)) for e in eigenvalues))
    each = whitened.select("__id", "deviation", F.posexplode("made").alias("place", "whitened"))
    return each.select(F.col("__id").alias(id_col), (F.col("place") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
