"""Quality by importance resampling: a document's weight is the ratio of its probability under two hashed n-gram models.

The target model is of documents labelled good, the raw model of all documents.
The n-grams are single tokens and pairs, once of the tokens' hashes and once of
their shapes (letters by case, digits, marks as they are; pairs also say whether
both tokens are equal). Documents are drawn without replacement with probability
proportional to their weights by Gumbel top-k: the k largest sums of log weight
and Gumbel noise, the noise being a function of id and seed. k is how many
documents have a log weight above the threshold that separates the labelled
classes best.

The target model and the threshold use a bounded sample of labelled rows
(``Bounds``, in the order of a hash of their id); the raw model, the weights and
the draw cover all documents.

Defined cases: a null or empty text has no n-gram, weight 0 (log); labels that
are null are not used; without good labelled rows every weight is 0 and all
documents stay; rows of equal id and text share one draw; ties with the k-th
stay; rows without an id share the noise of a null; an id labelled both ways is
not used; of an id with several texts the least is learned from; other columns
pass through ``keep_selected``, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.jaccard_join import _blocks, mix
from docloom.llm.shared import cut, give_back_memory

BITS = 14
FIELD = 1 << BITS
#: Hashed tokens, token pairs, shapes, shape pairs.
FIELDS = 4
#: Counts added to every n-gram of both models, as a share of the field's mean.
SMOOTH = 0.05
_REMEMBERED = 400_000
_NO_ID = -(2**63)


@dataclass(frozen=True)
class Bounds:
    """Most labelled documents collected: good ones for the target model, then good and bad ones for the threshold."""

    target: int = 3000
    good: int = 1500
    bad: int = 1500


def shape(token: str) -> str:
    """Of the whole token, runs of letters of a case or of digits as one sign."""
    out: list[str] = []
    for c in token:
        kind = "a" if c.islower() else "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind or not kind.isalnum():
            out.append(kind)
    return "".join(out)


class _Tokens(dict):
    def __missing__(self, token: str) -> int:
        import xxhash

        value = self[token] = xxhash.xxh32_intdigest(token.lower()) << 32 | xxhash.xxh32_intdigest(shape(token), 1)
        return value


_TOKENS = _Tokens()


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and the text of each."""
    if len(_TOKENS) > _REMEMBERED:
        _TOKENS.clear()
    split = [(t or "").split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    known = np.fromiter((_TOKENS[w] for words in split for w in words), np.uint64, int(counts.sum()))
    owner = np.repeat(np.arange(len(split), dtype=np.int64), counts)
    word, form = known >> np.uint64(32), known & np.uint64(0xFFFFFFFF)
    pair = owner[1:] == owner[:-1]
    same = (word[1:] == word[:-1]).astype(np.uint64)
    low = np.uint64(64 - BITS)
    put = lambda x, field: (mix(x) >> low).astype(np.int64) + field * FIELD
    words = put(word[1:] * np.uint64(0x9E3779B97F4A7C15) + word[:-1], 1)[pair]
    forms = put(form[1:] * np.uint64(0x9E3779B97F4A7C15) + form[:-1] * np.uint64(2) + same, 3)[pair]
    return np.concatenate([put(word, 0), words, put(form, 2), forms]), np.concatenate([owner, owner[1:][pair], owner, owner[1:][pair]])


#: Texts whose n-grams are held at once outside of Spark tasks.
TEXTS_AT_ONCE = 200


def counts_of(texts: list[str | None]) -> np.ndarray:
    total = np.zeros(FIELDS * FIELD, np.int64)
    for i in range(0, len(texts), TEXTS_AT_ONCE):
        total += np.bincount(features(texts[i : i + TEXTS_AT_ONCE])[0], minlength=FIELDS * FIELD)
    return total


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket; each field is a distribution of its own."""
    out = np.zeros(FIELDS * FIELD)
    for f in range(FIELDS):
        part = slice(f * FIELD, (f + 1) * FIELD)
        a, b = target[part].astype(float), raw[part].astype(float)
        if a.sum() and b.sum():
            share = b / b.sum()
            # the target's missing n-grams are filled from the raw model, so that what both have seen rarely weighs little
            prior = SMOOTH * FIELD
            out[part] = np.log((a + prior * (share + 1e-9)) / (a.sum() + prior)) - np.log(share + 1e-9)
    return out


def log_weights(texts: list[str | None], ratio: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    for i in range(0, len(texts), TEXTS_AT_ONCE):
        some = texts[i : i + TEXTS_AT_ONCE]
        buckets, owner = features(some)
        out[i : i + len(some)] = np.bincount(owner, ratio[buckets], minlength=len(some))
    return out


def threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight that separates both best, a rejected good document counting four times; middle of the gap."""
    if not len(good) or not len(bad):
        return -math.inf
    values = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2])
    lost = 4 * np.searchsorted(np.sort(good), cuts) / len(good) + 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    best = np.flatnonzero(lost <= lost.min() + 1e-12)
    return float(cuts[best[len(best) // 2]])


def raw_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """n-gram counts of all documents; a task sends one row a bucket, the result is as long as the hash table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FIELDS * FIELD, np.int64)
        for block in _blocks(batches):
            total += counts_of(block.column(0).to_pylist())
        _TOKENS.clear()
        give_back_memory()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(FIELDS * FIELD, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray
    threshold: float


def learn(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    rows = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y")).where(F.col("__y").isin(0, 1) & F.col("__id").isNotNull())
    rows = rows.groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__other")).where("__y = __other").drop("__other")
    first = lambda y, n: rows.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(n)
    ids = first(1, bounds.target + bounds.good).unionAll(first(0, bounds.bad))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(ids), "__id").groupBy("__id", "__y").agg(F.min("__text").alias("__text"))
    texts = texts.where("__text IS NOT NULL").orderBy(F.xxhash64("__id", F.lit(7)), "__id").select("__y", "__text").collect()
    good = list(dict.fromkeys(r["__text"] for r in texts if r["__y"] == 1))
    bad = list(dict.fromkeys(r["__text"] for r in texts if r["__y"] == 0))
    held = min(bounds.good, len(good) // 4)
    if not good:
        return Model(np.zeros(FIELDS * FIELD), -math.inf)
    ratio = log_ratio(counts_of(good[held:]), raw_counts(docs, text_col))
    return Model(ratio, threshold(log_weights(good[:held] or good, ratio), log_weights(bad, ratio)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id (filled), th (hash of the text), the columns of keep, log_weight."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("id"), F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("th"), *keep, F.col(text_col).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes if c != "__text"), "log_weight double"])
    shared = docs.sparkSession.sparkContext.broadcast(model.ratio)

    def run(batches):
        for block in _blocks(batches):
            weights = log_weights(block.column("__text").to_pylist(), shared.value)
            out = block.drop_columns(["__text"]).combine_chunks().append_column("log_weight", pa.array(weights, pa.float64()))
            yield from out.to_batches()
        _TOKENS.clear()
        give_back_memory()

    return rows.mapInArrow(run, schema)


def gumbel(seed: int):
    """Noise of a row from its id: -log(-log u), u uniform in (0, 1)."""
    u = (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value, by counting in ever narrower bins; no sort, and nothing collected but bin counts."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or n == 0:
        return None
    if k >= n:
        return low
    above = 0
    while low < high:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            break
        inside = df.where((F.col(column) >= low) & (F.col(column) <= high))
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int").alias("b")
        rows = sorted(inside.groupBy(place).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect(), key=lambda r: -r["b"])
        for r in rows:
            if above + r["n"] >= k:
                low, high = r["lo"], r["hi"]
                break
            above += r["n"]
        if above + r["n"] == k:
            return r["lo"]
    return low


def resampling(docs: DataFrame, model: Model, seed: int, **columns) -> DataFrame:
    """The scored rows with their draw, written once."""
    return cut(score(docs, model, **columns).withColumn("drawn", F.col("log_weight") + gumbel(seed)))


def _least_drawn(scored: DataFrame, model: Model) -> float | None:
    """The smallest draw that is kept."""
    k = scored.where(F.col("log_weight") >= model.threshold).count() if math.isfinite(model.threshold) else scored.count()
    return kth_largest(scored, "drawn", k)


def resample(docs: DataFrame, model: Model, seed: int = 1, **columns) -> DataFrame:
    """Per row of docs: id, th, log_weight, selected (drawn by Gumbel top-k)."""
    scored = resampling(docs, model, seed, **columns)
    least = _least_drawn(scored, model)
    return scored.withColumn("selected", F.lit(False) if least is None else F.col("drawn") >= F.lit(least))


def keep_selected(docs: DataFrame, labels: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are drawn. They are weighed once for the k-th draw and once more to be kept, so no text is shuffled."""
    model = learn(docs, labels, id_col=id_col, text_col=text_col)
    least = _least_drawn(resampling(docs, model, seed, id_col=id_col, text_col=text_col), model)
    if least is None:
        return docs.limit(0)
    whole = docs.select(F.col(id_col), F.col(text_col), F.struct(*docs.columns).alias("__row"))
    drawn = score(whole, model, id_col, text_col, keep=("__row",)).withColumn("drawn", F.col("log_weight") + gumbel(seed))
    return drawn.where(F.col("drawn") >= F.lit(least)).select("__row.*")
