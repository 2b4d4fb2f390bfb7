"""Exact top-k by inner product of whole-numbered vectors, term at a time.

Components are terms: a block of candidates is turned into postings (the rows in
which a component is not 0, and its values), and each query's components scatter
weighted postings into a dense score array, one entry for each candidate of the
block. ``np.partition`` finds the k-th best score of the block; what reaches it
and the query's k best so far goes on. Blocks' winners are merged by a window.

Queries and candidates are dealt in turn into blocks, and every block of queries
meets every block of candidates in one cell, so work and memory of a task do not
depend on what the vectors are. A query travels once for each candidate block, a
candidate once for each query block; of a cell the queries are held (at most
``QUERY_ROWS``) and the candidates stream by in pieces of ``PIECE``.

A component c becomes floor(scale * c), c as double; scores are exact sums of
longs. If a score could leave a long, the query fails instead of being wrong.

Defined cases: vectors that are null or hold nulls, NaN or infinities take no
part, nor do rows without an id; an empty vector has no terms and scores 0 with
all; of vectors of different lengths the missing components count as 0; rows with
the query's id are its own and no candidates of it; other repeated rows take a
rank each, and a repeated query row is a query of its own; ties go to the smaller
id; fewer candidates than k give fewer rows; other columns are not read; empty
tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most queries of a cell, and most candidates if there are enough cells for all cores.
QUERY_ROWS, CANDIDATE_ROWS = 16_384, 131_072
#: Candidates and queries of one score array.
PIECE, TOGETHER = 4096, 16
#: The score of no candidate; its negative is a long too.
_NONE = -np.iinfo(np.int64).max


def whole_numbers(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * c) of a list column without nulls, a row each, filled with zeros."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.asarray(lists.value_lengths(), np.int64)
    x = np.floor(scale * np.asarray(lists.flatten()))
    if len(x) and np.abs(x).max() >= 2**62:
        raise OverflowError("a component times the scale leaves a long")
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return x.astype(np.int64).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = x
    return out


def postings(x: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray] | None]:
    """Of each component the rows where it is not 0 and its values there; if it is 0 in few, of all rows."""
    out = []
    for column in np.ascontiguousarray(x.T):
        rows = np.flatnonzero(column)
        out.append(None if not len(rows) else (slice(None), column) if 2 * len(rows) > len(column) else (rows, column[rows]))
    return out


class Cell:
    """A block of queries and their best candidates so far."""

    def __init__(self, k: int, scale: int):
        self.k, self.scale, self.parts = k, scale, []
        self.best = None

    def ask(self, batch: pa.RecordBatch) -> None:
        self.parts.append((batch.column("ask").to_numpy(), batch.column("id").to_numpy(), whole_numbers(batch.column("vector"), self.scale)))

    def _ready(self) -> None:
        width = max(x.shape[1] for _, _, x in self.parts)
        self.asks, self.ids = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        self.x = np.concatenate([np.pad(x, ((0, 0), (0, width - x.shape[1]))) for _, _, x in self.parts])
        self.best = np.full((len(self.ids), self.k), _NONE)
        self.names = np.zeros((len(self.ids), self.k), np.int64)
        self.largest = int(np.abs(self.x).max(initial=0))

    def scan(self, batch: pa.RecordBatch) -> None:
        if not self.parts:
            return
        if self.best is None:
            self._ready()
        ids, x = batch.column("id").to_numpy(), whole_numbers(batch.column("vector"), self.scale)
        if self.largest * int(np.abs(x).max(initial=0)) * max(1, min(x.shape[1], self.x.shape[1])) >= 2**63:
            raise OverflowError("a score may leave a long")
        for at in range(0, len(ids), PIECE):
            terms = postings(x[at : at + PIECE])[: self.x.shape[1]]
            for first in range(0, len(self.ids), TOGETHER):
                self._score(slice(first, min(first + TOGETHER, len(self.ids))), ids[at : at + PIECE], terms)

    def _score(self, some: slice, ids: np.ndarray, terms: list) -> None:
        weights = self.x[some]
        scores, made = np.zeros((len(weights), len(ids)), np.int64), np.empty((len(weights), len(ids)), np.int64)
        for t, posting in enumerate(terms):
            asking = np.flatnonzero(weights[:, t])
            if posting is None or not len(asking):
                continue
            rows, values = posting
            if isinstance(rows, slice) and 2 * len(asking) > len(weights):
                np.multiply(weights[:, t, None], values, out=made)
                scores += made
            else:
                for q in asking:
                    scores[q, rows] += weights[q, t] * values
        scores[self.ids[some, None] == ids] = _NONE
        bar = self.best[some, -1].copy()
        if len(ids) > self.k:
            bar = np.maximum(bar, np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        who, which = np.nonzero((scores >= bar[:, None]) & (scores > _NONE))
        if not len(who):
            return
        kept = np.arange(len(weights)).repeat(self.k)
        who, value, name = np.concatenate([kept, who]), np.concatenate([self.best[some].ravel(), scores[who, which]]), np.concatenate([self.names[some].ravel(), ids[which]])
        order = np.lexsort((name, -value, who))
        who = who[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        order = order[place < self.k]
        self.best[some], self.names[some] = value[order].reshape(-1, self.k), name[order].reshape(-1, self.k)

    def found(self) -> pa.RecordBatch | None:
        if self.best is None:
            return None
        rows, places = np.nonzero(self.best > _NONE)
        columns = [self.asks[rows], self.ids[rows], self.names[rows, places], self.best[rows, places]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["ask", "query_id", "id", "score"])


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a vector of finite components."""
    finite = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """From two tables of (id, vector): query_id, rank, id, score of each query's k best candidates."""
    cores = queries.sparkSession.sparkContext.defaultParallelism
    n_queries, n_candidates = queries.count(), candidates.count()
    down = max(1, -(-n_queries // QUERY_ROWS))
    across = max(1, -(-n_candidates // CANDIDATE_ROWS), min(-(-2 * cores // down), -(-n_candidates // PIECE)))

    def dealt(rows: DataFrame, blocks: int) -> DataFrame:
        kind = "array<float>" if dict(rows.dtypes)["vector"] == "array<float>" else "array<double>"
        numbered = usable(rows).select(F.col("id").cast("bigint").alias("id"), F.col("vector").cast(kind).alias("vector"), F.monotonically_increasing_id().alias("ask"))
        return numbered.withColumn("block", F.col("ask") % blocks)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("other")
    asked = dealt(queries, down).select("*", every(across)).withColumns({"cell": F.col("block") * across + F.col("other"), "kind": F.lit(0)})
    held = dealt(candidates, across).select("*", every(down)).withColumns({"cell": F.col("other") * across + F.col("block"), "kind": F.lit(1)})
    both = asked.unionByName(held).select(F.col("cell").cast("int").alias("cell"), "kind", "ask", "id", "vector")
    rows = both.repartitionById(down * across, "cell").sortWithinPartitions("cell", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, kinds = (batch.column(c).to_numpy() for c in ("cell", "kind"))
            cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if cells[a] != number:
                    if state is not None and (done := state.found()) is not None:
                        yield done
                    number, state = cells[a], Cell(k, scale)
                (state.ask if kinds[a] == 0 else state.scan)(batch.slice(a, b - a))
        if state is not None and (done := state.found()) is not None:
            yield done

    winners = rows.mapInArrow(run, "ask bigint, query_id bigint, id bigint, score bigint")
    ranked = winners.withColumn("rank", F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
