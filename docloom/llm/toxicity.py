"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Every document is cut into short overlapping word windows. A window's margin is
the bytes that the ordinary dictionary needs for it less those that the toxic
one needs (the toxic model's prefix also ends on ordinary text, so that ordinary
words cost both the same). A logistic curve over a document's largest margins,
calibrated on labelled documents that the dictionaries have not seen, gives the
score.

The toxic dictionary is trained on the words of toxic texts whose contexts favour
toxic documents (``toxic_words``), the ordinary one on the other words of
ordinary texts, a word once for every two contexts up to ``MOST_SAMPLES``.

The fit uses a bounded sample of labelled rows, at most ``Bounds.toxic`` and
``Bounds.ordinary`` documents, taken in the order of a hash of their id, of each
the least of its texts, whole; scoring covers every whole text.

Defined cases: a null text counts as empty; an empty text has no window and gets
the score of margins of 0; labels that are null are not used, nor is an id that
is labelled both ways; without toxic or ordinary labelled rows every score is the
share of toxic rows among the labelled (0 if there are none). Repeated rows are
scored alike. Other columns are not read; those of ``keep`` must not be named
score. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS, WINDOW_STEP = 6, 3
LEVEL = 3
FEATURES = 6
#: A word is toxic material when its contexts favour toxic documents by this log-likelihood ratio and lift.
LEAST_RATIO, LEAST_LIFT = 15.0, 6.0
TOXIC_BYTES, ORDINARY_BYTES = 4096, 65536
#: Samples of a toxic word, and most samples of an ordinary one: how often a word stands in the text that a dictionary is trained on.
TOXIC_SAMPLES, MOST_SAMPLES = 20, 10
_SPACED = re.compile(rb"\S+")
_WORD = re.compile(r"[^\W\d_]+")
#: The last bytes of a trained dictionary's header: the three repeat offsets, after which its content follows.
_REPEAT_OFFSETS = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"


@dataclass(frozen=True)
class Bounds:
    """Most labelled documents of either class that the fit collects."""

    toxic: int = 3000
    ordinary: int = 5000


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]


def windows(text: str) -> list[bytes]:
    data = text.lower().encode("utf-8", "surrogatepass")
    spans = [m.span() for m in _SPACED.finditer(data)]
    if not spans:
        return []
    starts = range(0, max(1, len(spans) - WINDOW_WORDS + WINDOW_STEP), WINDOW_STEP)
    return [b" " + data[spans[i][0] : spans[min(i + WINDOW_WORDS, len(spans)) - 1][1]] + b" " for i in starts]


def _compressor(content: bytes):
    import zstandard

    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    prefix = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    prefix.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=prefix).compress


class Scorer:
    def __init__(self, model: Model):
        self.weights = np.array(model.weights)
        self.by_toxic, self.by_ordinary = _compressor(model.ordinary + model.toxic), _compressor(model.ordinary)

    def features(self, text: str) -> np.ndarray:
        """1, the three largest margins, the windows of a margin of 4 and more, and the log of the window count."""
        found = np.array([len(self.by_ordinary(w)) - len(self.by_toxic(w)) for w in windows(text)], float)
        top = np.zeros(3)
        top[: min(3, len(found))] = -np.sort(-found)[:3]
        return np.array([1.0, *top, math.log1p((found >= 4).sum()), math.log1p(len(found))])

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -30, 30))))


def _contexts(texts: list[str]) -> Counter:
    """How many different words each word follows; copies of a passage add nothing."""
    seen = set()
    for text in texts:
        before = ""
        for word in _WORD.findall(text.lower()):
            seen.add((before, word))
            before = word
    return Counter(word for _, word in seen)


def toxic_words(toxic: list[str], ordinary: list[str]) -> dict[str, int]:
    a, b = _contexts(toxic), _contexts(ordinary)
    na, nb = max(1, sum(a.values())), max(1, sum(b.values()))
    part = lambda k, n, share: k * math.log(k / n / share) if k else 0.0
    found = {}
    for word, k in a.items():
        j = b[word]
        share = (k + j) / (na + nb)
        if k / na >= LEAST_LIFT * (j + 0.5) / nb and 2 * (part(k, na, share) + part(j, nb, share)) >= LEAST_RATIO:
            found[word] = k
    return found


def _dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    import zstandard

    try:
        trained = zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary themselves
        return b"".join(dict.fromkeys(samples))[-size:]
    at = trained.rfind(_REPEAT_OFFSETS, 0, 1024)
    return trained[at + len(_REPEAT_OFFSETS) :] if at >= 0 else trained


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(w)), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """From the texts of both classes and the share of toxic rows among all labelled ones."""
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    if not toxic or not ordinary:
        return Model(b" ", b" ", (math.log(max(share, 1e-9) / max(1 - share, 1e-9)), *[0.0] * (FEATURES - 1)))
    cut = lambda rows: (rows[: max(1, len(rows) * 2 // 3)], rows[len(rows) * 2 // 3 :] or rows)
    (toxic_seen, toxic_new), (plain_seen, plain_new) = cut(toxic), cut(ordinary)
    chosen = toxic_words(toxic_seen, plain_seen)
    common = _contexts(plain_seen)
    # each word with a neighbour of itself, else the trainer cuts its last bytes off; rounds, so that no word's samples stand together
    samples = [f" {w} {w} ".encode() for _ in range(TOXIC_SAMPLES) for w in sorted(chosen)]
    plain = [f" {w} ".encode() for i in range(MOST_SAMPLES) for w in sorted(common) if w not in chosen and common[w] // 2 > i]
    draft = Model(_dictionary(samples, TOXIC_BYTES, 50, 8) if samples else b" ", _dictionary(plain, ORDINARY_BYTES, 16, 6) if plain else b" ", (0.0,) * FEATURES)
    scorer = Scorer(draft)
    x = np.array([scorer.features(t) for t in (*toxic_new, *plain_new)])
    y = np.array([1.0] * len(toxic_new) + [0.0] * len(plain_new))
    share = min(max(share, 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, share * len(y) / max(1, y.sum()), (1 - share) * len(y) / max(1, (1 - y).sum()))
    return Model(draft.toxic, draft.ordinary, tuple(map(float, _logistic(x, y, weight))))


def held_out(id_col):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows that are not held out; only ids within ``bounds`` are broadcast and only their texts collected."""
    rows = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__y")).where(F.col("__y").isin(0, 1) & F.col("__id").isNotNull() & ~held_out(F.col("__id")))
    rows = rows.groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__other")).where("__y = __other").drop("__other")
    counts = {r["__y"]: r["n"] for r in rows.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    picked = [rows.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(most) for y, most in ((1, bounds.toxic), (0, bounds.ordinary))]
    ids = picked[0].unionAll(picked[1])
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(ids), "__id").groupBy("__id", "__y").agg(F.min("__text").alias("__text"))
    texts = texts.where("__text IS NOT NULL").orderBy(F.xxhash64("__id"), "__id").select("__y", "__text").collect()
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit([r["__text"] for r in texts if r["__y"] == 1], [r["__text"] for r in texts if r["__y"] == 0], share)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``score`` between 0 and 1."""
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes if c != "__text"), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            names = [n for n in batch.schema.names if n != "__text"]
            got = [scorer.score(t.as_py()) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(got, pa.float64())], [*names, "score"])

    return rows.mapInArrow(run, schema)
