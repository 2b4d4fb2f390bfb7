r"""Periodic runs of words: stretches that repeat a short passage again and again.

A run is a stretch of words that are identical at a distance of its smallest
period and that neither neighbour extends; those of at least ``least_words`` words
and ``least_exponent`` periods count. Every run holds, under one of the two orders
of words, the longest Lyndon word from a place inside it, of the period's length.
So each stretch is scanned from right to left with a stack of Lyndon factors,
once under either order; two suffixes are compared at their longest common
extension (:class:`Extensions`), and each factor is extended to both sides.

A common extension is searched by bisection with rolling hashes and then verified
word by word, so hashes decide nothing. Extensions at one distance are kept, so a
long run is verified once and not again from every place inside it.

Before that, places go at which no run can be: all sequences of four words of a
run stand again one period away, inside it (:func:`stretches`). Ordinary prose
ends there, and no run is lost.

Words are ``[^\x20\x09-\x0D]+``. Memory is some 15 times a text's bytes; batches
are cut by their bytes.

Defined cases: null and empty texts, and those of white space alone, have no
words, no run and an empty collapsed text; texts of any length are taken whole;
repeated rows are scanned alike; extra columns are dropped unless named in
``keep`` (which must not name ``runs``, ``collapsed`` or ``n_words``); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.byte_bpe import in_batches

#: Words of a sequence that must stand again in a run, and rounds in which places far from their likes are left out.
GRAM, ROUNDS = 4, 16
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_FAR = np.iinfo(np.int64).max // 8


def stretches(hashes: np.ndarray, least_words: int, least_exponent: int) -> list[tuple[int, int]]:
    """Word ranges outside of which there is no run; only for least_words >= 6 and least_exponent >= 4, else all words.

    Equal words have equal hashes; unequal ones with equal hashes only leave more places in. A run of L words and period q
    has L - 3 sequences of four words. If L >= max(6, 4 q) that is 2 q or more, so each of them stands again q places to the
    left or to the right within the run, and the nearest of its likes is no farther than q, L / least_exponent at most.
    """
    n = len(hashes)
    if n < least_words:
        return []
    if least_words < 6 or least_exponent < 4:
        return [(0, n)]
    h = hashes.astype(np.uint64) * np.uint64(_BASE)
    h ^= h >> np.uint64(29)
    grams = h[: n - GRAM + 1].copy()
    for k in range(1, GRAM):
        grams = grams * np.uint64(0x100000001B3) + h[k : n - GRAM + 1 + k]
    ranked = np.sort(grams)
    if not (ranked[1:] == ranked[:-1]).any():
        return []
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    gap = np.where(ranked[1:] == ranked[:-1], order[1:] - order[:-1], _FAR)
    near = np.full(len(grams), _FAR)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    left = near < _FAR
    for _ in range(ROUNDS):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], left, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        size = ends - starts + GRAM - 1
        keep = left.copy()
        keep[left] = near[left] * least_exponent <= np.repeat(size, ends - starts)
        if (keep == left).all():
            break
        left = keep
    edges = np.flatnonzero(np.diff(np.concatenate([[False], left, [False]]).astype(np.int8)))
    return [(int(a), int(b) + GRAM - 1) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a + GRAM - 1 >= least_words]


class Extensions:
    """Longest common extensions of places in a sequence of numbers."""

    def __init__(self, z: list[int]):
        self.z, self.n = z, len(z)
        self.numbers = np.array(z, np.int64)
        mixed = (self.numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        powers = np.full(self.n + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        # of each prefix: the sum of its numbers, each times the power of its place
        self.prefix = [0, *np.cumsum(mixed * powers[:-1], dtype=np.uint64).tolist()]
        self.powers = powers.tolist()
        self.known: dict[int, tuple[int, int]] = {}

    def _alike(self, i: int, j: int, size: int) -> bool:
        p = self.prefix
        return ((p[i + size] - p[i]) * self.powers[j - i] - (p[j + size] - p[j])) & _MASK == 0

    def _verified(self, i: int, j: int, size: int, back: bool) -> int:
        """How many of ``size`` words are the same from i and j on, or before them."""
        a, b = (self.numbers[x - size : x][::-1] if back else self.numbers[x : x + size] for x in (i, j))
        same = a == b
        return size if same.all() else int(same.argmin())

    def _length(self, i: int, j: int, most: int, back: bool) -> int:
        alike = (lambda size: self._alike(i - size, j - size, size)) if back else (lambda size: self._alike(i, j, size))
        size = 1
        while size <= most and alike(size):
            size *= 2
        low, high = size // 2, min(size, most + 1)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if alike(middle) else (low, middle)
        return self._verified(i, j, low, back)

    def stretch(self, i: int, distance: int) -> tuple[int, int]:
        """The widest range of places, i among them, whose words stand again ``distance`` later; (i, i) if word i doesn't."""
        z, j = self.z, i + distance
        if j >= self.n or z[i] != z[j]:
            return i, i
        found = self.known.get(distance)
        if found is None or not found[0] <= i < found[1]:
            found = self.known[distance] = (i - self._length(i, j, i, True), i + self._length(i, j, self.n - j, False))
        return found


def find_runs(z: list[int], least_words: int = 6, least_exponent: int = 4) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers."""
    n, found = len(z), set()
    shared = Extensions(z)
    stretch = shared.stretch
    for rising in (True, False):
        end = [n] * n  # of the longest Lyndon word from each place on: where the next smaller suffix begins
        for i in range(n - 1, -1, -1):
            j = i + 1
            while j < n:
                a, b = z[i], z[j]
                if a == b:
                    size = stretch(i, j - i)[1] - i
                    if j + size == n:
                        break  # suffix j is a prefix of suffix i
                    a, b = z[i + size], z[j + size]
                if (a < b) != rising:
                    break
                j = end[j]
            end[i] = j
            period = j - i
            if j < n and z[i] == z[j] and period * least_exponent <= n:
                first, last = stretch(i, period)
                length = last + period - first
                if length >= least_words and length >= least_exponent * period:
                    found.add((first, length, period))
    return found


def runs_of_words(words: Sequence[bytes], least_words: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text's words, by start, then period."""
    out = set()
    if len(words) >= least_words:
        for first, last in stretches(np.fromiter(map(hash, words), np.int64, len(words)), least_words, least_exponent):
            numbers: dict[bytes, int] = {}
            z = [numbers.setdefault(w, len(numbers)) for w in words[first:last]]
            out |= {(first + start, length, period) for start, length, period in find_runs(z, least_words, least_exponent)}
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: of each run its first period stays."""
    if not runs:
        return list(words)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, [start + period for start, _, period in runs], 1)
    np.add.at(gone, [start + length for start, length, _ in runs], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, least_words: int = 6, least_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Per row: id_col, the columns of keep, n_words, runs (start, length, period; by start, then period) and the collapsed text."""
    rows = docs.select(id_col, *keep, docs[text_col].alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes if c != "__text"), f"n_words bigint, runs {RUNS}, collapsed string"])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, "__text"):
            sizes, runs, texts = [], [], []
            for text in batch.column("__text").cast(pa.binary()):
                words = (text.as_py() or b"").split()
                found = runs_of_words(words, least_words, least_exponent)
                sizes.append(len(words))
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in found])
                texts.append(b" ".join(collapse(words, found) if found else words))
            kept = [n for n in batch.schema.names if n != "__text"]
            made = [pa.array(sizes, pa.int64()), pa.array(runs, run_type), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *made], [*kept, "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema)


def greatest(runs: Column) -> Column:
    """The run of the most periods, exactly compared; of equal ones the first, null if there is none."""
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda best, x: F.when(better(best, x), x).otherwise(best))


def written(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
