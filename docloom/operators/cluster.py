"""Density clusters of vectors from an exact neighbourhood join, and clusters across several definitions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import isqrt
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.graph import connected_components
from docloom.session import materialize

#: Most pivots, and most numbers they may have together (they travel with each task); they are chosen from a sample four times as large.
MOST_PIVOTS, PIVOT_NUMBERS = 2048, 500_000
#: Numbers of a list of vectors, which a task holds at once; a larger cell is dealt into as many lists as it needs.
LIST_NUMBERS = 500_000
#: Axes of the first, cheap bound, vectors that are compared at a time, and rows that are sent at a time.
BOUND_AXES, PIECE, SENT = 8, 512, 10_000
#: A share of pairs up to which those that pass the first bound are compared one by one.
FEW = 0.1


@dataclass(frozen=True)
class Cells:
    """Vectors by their nearest pivot; of each cell its lists and the rings that hold its vectors' distances from the pivot."""

    pivots: np.ndarray
    order: np.ndarray  # axes, those on which the pivots differ most first
    between: np.ndarray  # distances of the pivots
    lists: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def width(self) -> int:
        return self.pivots.shape[1]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """From each vector to each pivot; infinite where a square leaves a double."""
        with np.errstate(over="ignore", invalid="ignore"):
            out = np.empty((len(x), len(self.pivots)))
            for k, pivot in enumerate(self.pivots):
                out[:, k] = np.sqrt(((x - pivot) ** 2).sum(axis=1))
        return out

    def reached(self, away: np.ndarray, home: np.ndarray, eps: float) -> np.ndarray:
        """Which other cells may hold a vector within eps.

        Such a vector lies beyond the plane between the two pivots, so the plane is no farther than eps; and its distance
        from its pivot differs from this vector's by eps at most. What cannot be told (infinities) counts as reached.
        """
        own = away[np.arange(len(away)), home][:, None]
        with np.errstate(over="ignore", invalid="ignore"):
            slack, squares = 1e-9 * (1 + own + away), 1e-9 * (1 + own * own + away * away)
            apart = away * away - own * own > 2 * eps * self.between[home] + squares
            apart |= (away > self.high + eps + slack) | (away < self.low - eps - slack)
        apart |= self.lists == 0
        apart[np.arange(len(away)), home] = True
        return ~apart


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The first ``width`` numbers of each list, zeros where there are fewer."""
    sizes = np.asarray(column.value_lengths(), np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    starts = np.cumsum(sizes) - sizes
    for k in range(len(sizes)):
        n = min(int(sizes[k]), width)
        out[k, :n] = flat[starts[k] : starts[k] + n]
    return out


class _Side:
    """Vectors on one side of a comparison."""

    def __init__(self, batch: pa.RecordBatch, cells: Cells):
        self.ids = batch.column("id").to_numpy(zero_copy_only=False)
        self.away = batch.column("away").to_numpy()
        self.asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        vectors = batch.column("v")
        self.sizes = np.asarray(vectors.value_lengths(), np.int64)
        self.x = _matrix(vectors, cells.width)
        # vectors of other lengths are compared one by one
        self.whole = None if (self.sizes == cells.width).all() else [np.asarray(v.values, np.float64) for v in vectors]
        self.leading = self.x[:, cells.order[:BOUND_AXES]]

    def __getitem__(self, rows: slice) -> _Side:
        part = object.__new__(_Side)
        part.ids, part.away, part.asks, part.sizes, part.x, part.leading = (a[rows] for a in (self.ids, self.away, self.asks, self.sizes, self.x, self.leading))
        part.whole = self.whole and self.whole[rows]
        return part

    def __len__(self) -> int:
        return len(self.ids)


def _together(sides: list[_Side]) -> _Side:
    out = object.__new__(_Side)
    for name in ("ids", "away", "asks", "sizes", "x", "leading"):
        setattr(out, name, np.concatenate([getattr(s, name) for s in sides]))
    out.whole = None if all(s.whole is None for s in sides) else [v for s in sides for v in (s.whole or list(s.x))]
    return out


def _beyond(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Pairs that are surely farther apart than eps, by the squares and the product of all."""
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    with np.errstate(invalid="ignore"):
        return xx[:, None] + yy[None, :] - 2 * (x @ y.T) > eps * eps + 1e-9 * (1 + xx[:, None] + yy[None, :])


def _near(own: _Side, other: _Side, eps: float, same: bool, visits: bool, every: bool, count) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and distance of the pairs within eps.

    Rings round the cell's pivot come first, then the distance on the leading axes; only what neither rules out is compared
    on all axes, in the end number by number in the order of the axes.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        left = ~(np.abs(own.away[:, None] - other.away[None, :]) > eps + 1e-9 * (1 + own.away[:, None] + other.away[None, :]))
        left &= own.sizes[:, None] == other.sizes[None, :]
        if same:
            left &= np.arange(len(own))[:, None] < np.arange(len(other))[None, :]
        left &= own.asks[:, None] | other.asks[None, :]
        if visits and own.asks.any() and not every:  # two that ask visit each other; the greater one counts
            left &= ~own.asks[:, None] | (own.ids[:, None] < other.ids[None, :])
        count("met", len(own) * (len(own) - 1) // 2 if same else left.size)
        left &= ~_beyond(own.leading, other.leading, eps)
        count("compared", int(left.sum()))
        if left.mean() > FEW:
            left &= ~_beyond(own.x, other.x, eps)
        i, j = np.nonzero(left)
        total = np.zeros(len(i))
        if own.whole is None and other.whole is None:
            for at in range(0, len(i), 65_536):
                a, b, some = i[at : at + 65_536], j[at : at + 65_536], total[at : at + 65_536]
                for k in range(own.x.shape[1]):
                    d = own.x[a, k] - other.x[b, k]
                    some += d * d
        else:
            of = lambda side, k: side.whole[k] if side.whole is not None else side.x[k]
            for k, (a, b) in enumerate(zip(i, j, strict=True)):
                for d in of(own, a) - of(other, b):
                    total[k] += d * d
    d = np.sqrt(total)
    near = d <= eps
    return i[near], j[near], d[near]


def _usable(vector: str) -> Column:
    """Not null, not empty, and without nulls, NaN and infinities."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf")))), F.lit(False))


def _spread(sample: np.ndarray, most: int) -> np.ndarray:
    """Of a sample the vectors that lie farthest from those chosen before."""
    chosen, nearest = [0], np.full(len(sample), np.inf)
    while len(chosen) < most:
        with np.errstate(over="ignore"):
            nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        if not nearest.max() > 0:
            break
        chosen.append(int(nearest.argmax()))
    return sample[chosen]


def _cells(rows: DataFrame) -> Cells | None:
    """Pivots from a sample by a hash of the ids, and what falls to each; None if there are no rows."""
    sizes = {r["size"]: r["n"] for r in rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    n, size = sum(sizes.values()), max(sizes, key=lambda k: (sizes[k], k))
    listed = max(64, LIST_NUMBERS // size)
    # as many as can pay: each of a small table's cells, and four of a list's size, may save visits
    most = max(1, min(MOST_PIVOTS, PIVOT_NUMBERS // size, 2 * isqrt(n), max(64, 4 * n // listed)))
    sample = rows.where(F.size("v") == size).orderBy("mix", "id").select("v").limit(4 * most).collect()
    pivots = _spread(np.array([r["v"] for r in sample], np.float64), most)
    with np.errstate(over="ignore", invalid="ignore"):
        order = np.argsort(-np.nan_to_num(pivots.var(axis=0)), kind="stable")
    blank = np.zeros(len(pivots))
    draft = Cells(pivots, order, np.zeros((len(pivots),) * 2), blank, blank, blank)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = draft.distances(_matrix(batch.column("v"), draft.width))
            home = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), pa.array(away[np.arange(len(home)), home])], ["cell", "away"])

    found = rows.select("v").mapInArrow(homes, "cell int, away double").groupBy("cell").agg(F.count("*").alias("n"), F.min("away").alias("low"), F.max("away").alias("high")).collect()
    lists, low, high = np.zeros(len(pivots), np.int64), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
    for r in found:
        lists[r["cell"]], low[r["cell"]], high[r["cell"]] = -(-r["n"] // listed), r["low"], r["high"]
    return Cells(pivots, order, draft.distances(pivots), lists, low, high)


def neighbours(df: DataFrame, eps: float, id_col: str = "id", vector: str = "embedding", asking: str | None = None, work: Mapping[str, Any] | None = None) -> DataFrame:
    """Pairs (a, b, distance) with a < b within eps; ids are distinct.

    Vectors that are null, empty or hold nulls, NaN or infinities are near none, nor are vectors of different lengths near
    each other. Each vector falls to the nearest of some pivots. It stands in a list of its cell and visits the lists of
    those cells that its distances from the pivots do not rule out (of two cells one visits the other), so distant cells
    never meet, whatever their number of axes. Lists are bounded: a cell of many vectors is dealt into several, and a task
    holds one list while visitors stream by.

    With ``asking``, a boolean column, only pairs of which one row at least asks are wanted, and only those rows visit.

    ``work`` may hold accumulators: ``met`` (pairs that meet in a task) and ``compared`` (those compared on all axes).
    """
    rows = df.where(_usable(vector)).select(F.col(id_col).alias("id"), F.col(vector).alias("v"), F.xxhash64(F.col(id_col)).alias("mix"), (F.coalesce(asking, F.lit(False)) if asking else F.lit(True)).alias("asks"))
    kind, vectors = dict(rows.dtypes)["id"], dict(rows.dtypes)["v"]
    cells = _cells(rows)
    if cells is None:
        return df.sparkSession.createDataFrame([], f"a {kind}, b {kind}, distance double")
    counters = dict(work or {})

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PIECE):
                batch = whole.slice(at, PIECE)
                away = cells.distances(_matrix(batch.column("v"), cells.width))
                home = away.argmin(axis=1)
                own = batch.column("mix").to_numpy() % cells.lists[home]
                asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
                who, cell = np.nonzero(cells.reached(away, home, eps))
                first = asks[who] if asking else (home[who] < cell) == ((home[who] + cell) % 2 == 0)
                who, cell = who[first], cell[first]
                # each list of a reached cell, and of the own cell those behind the own list, or all others
                times = cells.lists[cell]
                number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                later = np.where(asks, cells.lists[home] - 1, 0) if asking else cells.lists[home] - 1 - own
                behind = np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later)
                rest = np.repeat(np.arange(len(home)), later)
                took = np.concatenate([np.arange(len(home)), np.repeat(who, times), rest])
                place = np.concatenate([home, np.repeat(cell, times), home[rest]])
                listed = np.concatenate([own, number, behind + (behind >= own[rest]) if asking else own[rest] + 1 + behind])
                visits = np.repeat([0, 1], [len(home), len(took) - len(home)])
                sent = pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(listed, pa.int64()), pa.array(visits, pa.int32()), pa.array(away[took, place])], ["cell", "list", "visits", "away"])
                for k in range(0, len(took), SENT):
                    rows_of = pa.array(took[k : k + SENT])
                    yield pa.RecordBatch.from_arrays([*sent.slice(k, SENT).columns, *(batch.column(c).take(rows_of) for c in ("id", "v", "asks"))], [*sent.schema.names, "id", "v", "asks"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def count(name: str, n: int) -> None:
            if name in counters:
                counters[name].add(n)

        def found(own: _Side, other: _Side, same: bool) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(own), PIECE):
                for to in range(at if same else 0, len(other), PIECE):
                    a, b = own[at : at + PIECE], other[to : to + PIECE]
                    i, j, d = _near(a, b, eps, same and at == to, not same, not asking, count)
                    if len(d):
                        one, two = a.ids[i], b.ids[j]
                        swap = np.array(one > two, bool)
                        yield pa.RecordBatch.from_arrays([pa.array(np.where(swap, two, one), id_type), pa.array(np.where(swap, one, two), id_type), pa.array(d)], ["a", "b", "distance"])

        key, held, parts, id_type = None, None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.schema.field("id").type
            marks = np.stack([np.asarray(batch.column(c)) for c in ("cell", "list", "visits")], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                at, visits = tuple(marks[a, :2]), marks[a, 2]
                if parts and (visits or at != key):
                    held, parts = _together(parts), []
                    yield from found(held, held, True)
                if at != key:
                    key, held = at, None
                side = _Side(batch.slice(a, b - a), cells)
                if not visits:
                    parts.append(side)
                elif held is not None:
                    yield from found(held, side, False)
        if parts:
            held = _together(parts)
            yield from found(held, held, True)

    placed = rows.mapInArrow(visit, f"cell int, list bigint, visits int, away double, id {kind}, v {vectors}, asks boolean")
    met = placed.repartition("cell", "list").sortWithinPartitions("cell", "list", "visits")
    return met.mapInArrow(compare, f"a {kind}, b {kind}, distance double")


def density_labels(df: DataFrame, eps: float = 0.25, min_samples: int = 2, id_col: str = "id", vector: str = "embedding", out: str = "label") -> DataFrame:
    """Adds the smallest core id of each row's cluster, null for noise and for vectors that are near none.

    With min_samples 2 every point of a pair is a core, so clusters are the components of the neighbourhood graph. In
    general a border point joins the smallest label among its core neighbours. Equal vectors are looked at once, with their
    number, and named by their smallest id.
    """
    alike = materialize(df.where(_usable(vector)).groupBy(F.col(vector).alias("__v")).agg(F.min(id_col).alias("node"), F.count("*").alias("copies")))
    pairs = materialize(neighbours(alike, eps, "node", "__v"))
    both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if min_samples <= 2:  # whoever is in a pair or has a copy is a core, and all others if one is enough
        cores, inner = alike.where(F.col("copies") >= min_samples).select(F.col("node").alias("core")), pairs
    else:
        crowds = both.join(alike.select(F.col("node").alias("b"), "copies"), "b").select(F.col("a").alias("node"), "copies").unionAll(alike.select("node", "copies"))
        cores = materialize(crowds.groupBy("node").agg(F.sum("copies").alias("n")).where(F.col("n") >= min_samples).select(F.col("node").alias("core")))
        inner = both.join(cores, F.col("a") == F.col("core"), "left_semi").join(cores, F.col("b") == F.col("core"), "left_semi")
    linked = connected_components(inner.select(F.col("a").alias("u"), F.col("b").alias("v")))
    alone = cores.join(linked, F.col("core") == F.col("node"), "left_anti").select(F.col("core").alias("node"), F.col("core").alias("component"))
    labels = linked.unionAll(alone)
    if min_samples > 2:
        border = both.join(cores, F.col("a") == F.col("core"), "left_anti").join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("component")).withColumnRenamed("a", "node")
        labels = labels.unionAll(border)
    named = alike.select("__v", "node").join(labels, "node").select("__v", F.col("component").alias(out))
    return df.join(named, F.col(vector) == F.col("__v"), "left").drop("__v")


def split_clustered(df: DataFrame, labels: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a label in any definition, and the others."""
    found = F.coalesce(*(F.col(c) for c in labels)).isNotNull()
    return df.where(found), df.where(~found)


def across_definitions(df: DataFrame, labels: Sequence[str], id_col: str = "id", out: str = "cluster_id") -> DataFrame:
    """Components of rows that share a label in any definition, named by their smallest id; "-1" for rows without one."""
    edges = None
    for name in labels:
        hub = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(id_col).alias("v"))
        own = df.where(F.col(name).isNotNull()).select(name, F.col(id_col).alias("u")).join(hub, name).select("u", "v")
        edges = own if edges is None else edges.unionAll(own)
    linked = connected_components(edges).select(F.col("node").alias("__node"), F.col("component").alias("__component"))
    clustered = F.coalesce(*(F.col(c) for c in labels)).isNotNull()
    return df.join(linked, F.col(id_col) == F.col("__node"), "left").withColumn(out, F.when(clustered, F.coalesce("__component", id_col).cast("string")).otherwise("-1")).drop("__node", "__component")


def cluster_uuid(df: DataFrame, cluster: str = "cluster_id", id_col: str = "id", out: str = "cluster_uuid") -> DataFrame:
    """The hash of a cluster's sorted distinct ids; rows outside clusters share one."""
    signed = df.groupBy(cluster).agg(F.md5(F.array_join(F.array_sort(F.collect_set(F.col(id_col).cast("string"))), "|")).alias(out))
    return df.join(signed, cluster)


def drop_cluster_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*(x for n in names for x in (f"cluster_{n}", f"cluster_{n}_filter")), "vector_id", "text_to_embed")
