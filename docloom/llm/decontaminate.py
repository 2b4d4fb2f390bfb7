r"""Benchmark decontamination by winnowing, in DataFrame operations only.

Texts are lower-cased in A-Z and cut into words. Of every ``WINDOW`` consecutive
words the K-gram of the smallest hash is kept (of equal ones the rightmost), so
two texts that share ``WINDOW`` words in a row share the fingerprint that was
kept inside them. Documents' fingerprints join the benchmark's, and each hit is
extended: the windows around it that agree word by word are its occurrences. An
item of fewer than ``WINDOW`` words is one window; its hash meets those of all
runs of its length.

The benchmark's fingerprints are broadcast while their counted number and bytes
are within ``Bounds``, which makes one pass over the documents; beyond it both
sides are shuffled by hash and the hits meet their texts again by id.

Defined cases: a null text has no words; rows that repeat a document id count as
one document whose windows are those of any of the rows (n_words: the most); a
null document id is an id like others; items without an id make hits but are not
listed; an empty table of items leaves every document clean.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, K = 10, 4
SPAN = WINDOW - K + 1
POSITION_BITS = 28
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Bounds:
    """Most benchmark fingerprints, and bytes of the words kept with them, that are broadcast."""

    rows: int = 1_000_000
    bytes: int = 64 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(F.translate(text, _UPPER, _UPPER.lower()), F.lit("")), _NO_WORD), "")


def _grams(n: int) -> Column:
    """Hash of each run of n words, from the array of words' hashes ``h``."""
    parts = ", ".join(f"get(h, i + {j})" for j in range(n))
    return F.expr(f"if(size(h) < {n}, array(), transform(sequence(0, greatest(size(h) - {n}, 0)), i -> xxhash64({parts})))").cast("array<bigint>")


def _winnowed() -> Column:
    """Fingerprints (kind, pos, hash) from the array of K-grams ``k``: the smallest of each window, rightmost of equals."""
    low = (1 << POSITION_BITS) - 1
    ranked = f"transform(k, (x, i) -> shiftleft(x, {POSITION_BITS}) | ({low}L - i))"
    return F.expr(f"{ranked}").alias("v")


def _fingerprints(texts: DataFrame, keep: list[str], short: list[int]) -> DataFrame:
    """Columns of keep, words ``w`` and ``fps``: all fingerprints of kind WINDOW and all runs of the lengths in short."""
    low = (1 << POSITION_BITS) - 1
    least = "least(" + ", ".join(f"get(v, i + {j})" for j in range(SPAN)) + ")"
    rows = texts.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("k", _grams(K)).withColumn("v", _winnowed())
    long = F.expr(f"""if(size(w) < {WINDOW}, array(), transform(
        array_distinct(transform(sequence(0, greatest(size(v) - {SPAN}, 0)), i -> {least})),
        x -> struct({WINDOW} AS kind, cast({low}L - (x & {low}L) AS int) AS pos, get(k, cast({low}L - (x & {low}L) AS int)) AS hash)))""")
    fps = [long.cast("array<struct<kind:int,pos:int,hash:bigint>>")]
    for n in short:
        rows = rows.withColumn(f"g{n}", _grams(n))
        fps.append(F.expr(f"transform(g{n}, (x, i) -> struct({n} AS kind, i AS pos, x AS hash))").cast("array<struct<kind:int,pos:int,hash:bigint>>"))
    return rows.select(*keep, "w", F.concat(*fps).alias("fps"))


def _around(words: str, pos: str) -> Column:
    """The words that the windows over a K-gram can reach, with the K-gram's place among them."""
    first = f"greatest({pos} - {SPAN - 1}, 0)"
    return F.struct(F.expr(f"slice({words}, {first} + 1, {WINDOW + SPAN - 1})").alias("w"), F.expr(f"{pos} - {first}").alias("at"))


#: Window starts around a hit, counted from the K-gram back, whose words agree on both sides.
_EXTEND = f"""
CASE WHEN kind IS NULL THEN array() WHEN kind < {WINDOW} THEN if(slice(d.w, d.at + 1, kind) = slice(b.w, b.at + 1, kind), array(0), array())
ELSE filter(sequence(0, {SPAN - 1}), j -> j <= d.at AND j <= b.at
    AND d.at - j + {WINDOW} <= size(d.w) AND b.at - j + {WINDOW} <= size(b.w)
    AND slice(d.w, d.at - j + 1, {WINDOW}) = slice(b.w, b.at - j + 1, {WINDOW})) END
"""


def windows_hit(docs: DataFrame, benchmark: DataFrame, bounds: Bounds = Bounds(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row (id_col, n_words, start, length, item) per window hit of a document, and one with nulls for each document."""
    texts = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w"))
    items = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col)).alias("w")).where("size(w) > 0")
    # at most nine numbers
    short = sorted(r[0] for r in items.select(F.size("w")).where(F.size("w") < WINDOW).distinct().collect())
    own = _fingerprints(items, ["item"], short).select("item", "w", F.explode_outer("fps").alias("f"))
    own = own.where(f"f.kind = {WINDOW} OR f.kind = size(w)").select(F.col("f.kind").alias("kind"), F.col("f.hash").alias("hash"), "item", _around("w", "f.pos").alias("b")).distinct()
    n, size = own.agg(F.count("*"), F.coalesce(F.sum(F.expr("aggregate(b.w, 0L, (s, x) -> s + octet_length(x) + 32)")), F.lit(0))).first()
    marked = _fingerprints(texts, ["id"], short)
    if n <= bounds.rows and size <= bounds.bytes:
        rows = marked.select("id", "w", F.explode_outer(F.expr("concat(array(cast(NULL AS struct<kind:int,pos:int,hash:bigint>)), fps)")).alias("f"))
        rows = rows.select("id", "w", F.col("f.kind").alias("k_"), F.col("f.pos").alias("pos"), F.col("f.hash").alias("h_"))
        met = rows.join(F.broadcast(own), (F.col("k_") == F.col("kind")) & (F.col("h_") == F.col("hash")), "left").where("k_ IS NULL OR kind IS NOT NULL")
        met = met.select("id", F.when(F.col("k_").isNull(), F.size("w")).alias("n_words"), "kind", "pos", "item", F.when(F.col("kind").isNotNull(), _around("w", "pos")).alias("d"), "b")
    else:
        found = marked.select("id", F.explode_outer("fps").alias("f")).where("f IS NOT NULL").select("id", F.col("f.kind").alias("k_"), F.col("f.pos").alias("pos"), F.col("f.hash").alias("h_"))
        found = found.join(own, (F.col("k_") == F.col("kind")) & (F.col("h_") == F.col("hash"))).select("id", "kind", "pos", "item", "b")
        again = texts.withColumnRenamed("id", "id_")
        met = found.join(again, F.col("id").eqNullSafe(F.col("id_"))).select("id", F.lit(None).cast("int").alias("n_words"), "kind", "pos", "item", _around("w", "pos").alias("d"), "b")
        whole = texts.select("id", F.size("w").alias("n_words"), *(F.lit(None).cast(met.schema[c].dataType).alias(c) for c in ("kind", "pos", "item", "d", "b")))
        met = met.unionAll(whole)
    hits = met.withColumn("back", F.explode_outer(F.expr(_EXTEND)))
    return hits.select(F.col("id").alias(id_col), F.col("n_words").cast("bigint").alias("n_words"), (F.col("pos") - F.col("back")).alias("start"), F.when(F.col("back").isNotNull(), F.col("kind")).alias("length"), F.when(F.col("back").isNotNull(), F.col("item")).alias("item")).where("length IS NOT NULL OR n_words IS NOT NULL")


_COVERED = """aggregate(array_sort(spans), named_struct('n', 0L, 'upto', 0L),
    (a, x) -> named_struct('n', a.n + greatest(0L, x.start + x.length - greatest(a.upto, cast(x.start AS bigint))), 'upto', greatest(a.upto, cast(x.start + x.length AS bigint))), a -> a.n)"""


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: id, n_words, spans (start, length of each window hit), items, n_hit (words inside any window)."""
    id_col = options.get("id_col", "doc_id")
    hits = windows_hit(docs, benchmark, **options)
    per_doc = hits.groupBy(id_col).agg(F.max("n_words").alias("n_words"), F.collect_set(F.when(F.col("length").isNotNull(), F.struct("start", "length"))).alias("spans"), F.collect_set("item").alias("items"))
    return per_doc.withColumn("n_hit", F.expr(_COVERED))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a window of the benchmark."""
    id_col = options.get("id_col", "doc_id")
    hit = windows_hit(docs, benchmark, **options).where("length IS NOT NULL").select(F.col(id_col).alias("__hit")).distinct()
    return docs.join(hit, F.col(id_col).eqNullSafe(F.col("__hit")), "left_anti")
