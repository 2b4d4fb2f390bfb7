"""Document fingerprints by winnowing over words, in DataFrame operations only.

A text's words (runs without white space) give rolling hashes of ``K`` words; of
every ``W`` neighbouring hashes the smallest is kept, of equal ones the
rightmost, with its position. Any run of ``K + W - 1`` words that two texts share
therefore leaves a common hash in both. A text of fewer than K words is one gram,
a text without words has no hash.

The written fingerprint is the kept hashes in the order of their positions, eight
hex digits each; likeness is twice the common distinct hashes over the sum of
both numbers (1 where neither text has any).

The next document is that of the next greater id (after the last, the first). It
is found without a global sort of texts: only (id, length) rows are put into
ranges, and what the join back carries is the part of the next text that the
edit takes.

Defined cases: a null text counts as empty; every repeated row gets its own row,
its next document being the smallest text of the next greater id; rows without an
id have no next document, an empty text stands for it; a single document is its
own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.shared import cut

K, W = 3, 4
_POSITION_BITS = 28
_LOW = (1 << _POSITION_BITS) - 1
_WHITE = r"[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}]+"


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds ``out``: array<struct<pos int, hash int>>, in the order of positions."""
    keep = df.columns
    grams = ", ".join(f"get(__h, i + {j})" for j in range(K))
    least = "least(" + ", ".join(f"get(__v, i + {j})" for j in range(W)) + ")"
    rows = df.withColumn("__h", F.transform(F.array_remove(F.split(F.col(text_col), _WHITE), ""), lambda x: F.xxhash64(x)))
    rows = rows.withColumn("__v", F.expr(f"""CASE WHEN size(__h) = 0 THEN array() WHEN size(__h) < {K} THEN array(shiftleft(xxhash64(__h), {_POSITION_BITS}) | {_LOW}L)
        ELSE transform(sequence(0, greatest(size(__h) - {K}, 0)), i -> shiftleft(xxhash64({grams}), {_POSITION_BITS}) | ({_LOW}L - i)) END""").cast("array<bigint>"))
    rows = rows.withColumn("__m", F.expr(f"""array_distinct(CASE WHEN size(__v) = 0 THEN array() WHEN size(__v) <= {W} THEN array(array_min(__v))
        ELSE transform(sequence(0, greatest(size(__v) - {W}, 0)), i -> {least}) END)""").cast("array<bigint>"))
    kept = F.expr(f"transform(__m, x -> struct(cast({_LOW}L - (x & {_LOW}L) AS int) AS pos, cast((shiftright(x, {_POSITION_BITS}) & 4294967295L) - 2147483648L AS int) AS hash))")
    return rows.select(*keep, kept.alias(out))


def written(fingerprint: str) -> Column:
    return F.array_join(F.transform(F.col(fingerprint), lambda x: F.lpad(F.lower(F.hex(x["hash"].cast("bigint") + 2147483648)), 8, "0")), "")


def hashes(fingerprint: str) -> Column:
    return F.array_distinct(F.transform(F.col(fingerprint), lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of distinct hashes."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / F.when(total == 0, 1).otherwise(total))


def next_ids(ids: DataFrame) -> DataFrame:
    """From rows (id, n) with distinct ids: (id, prev, prev_n), where prev is the next smaller id and the last one for the first."""
    ranged = cut(ids.repartitionByRange("id").select("id", "n", F.spark_partition_id().alias("range")))
    edges = ranged.groupBy("range").agg(F.max_by(F.struct("id", "n"), "id").alias("last"))
    # one row per range, however many ids there are
    whole = Window.partitionBy(F.lit(0)).orderBy("range")
    every = Window.partitionBy(F.lit(0))
    edges = edges.select("range", F.coalesce(F.lag("last").over(whole), F.max_by("last", "range").over(every)).alias("edge"))
    inside = Window.partitionBy("range").orderBy("id")
    rows = ranged.withColumn("prev", F.lag(F.struct("id", "n")).over(inside)).join(F.broadcast(edges), "range")
    before = F.coalesce("prev", "edge")
    return rows.select("id", before["id"].alias("prev"), before["n"].alias("prev_n"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_chars, text, edited (its last quarter replaced), fp, edited_fp, next_fp (hashes)."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # both joins read the same exchange of the texts by id
    known = texts.where("id IS NOT NULL")
    ids = known.groupBy("id").agg(F.max(F.char_length("text")).alias("n"))
    following = known.join(next_ids(ids), "id").select("prev", F.expr("substring(text, 1, cast(prev_n div 4 AS int))").alias("head"), "text")
    following = with_fingerprint(following, "text", "f").select("prev", "head", hashes("f").alias("next_fp"))
    following = following.groupBy("prev").agg(F.min(F.struct("head", "next_fp")).alias("next"))
    rows = known.join(following, F.col("id") == F.col("prev"), "left").drop("prev")
    rows = rows.unionAll(texts.where("id IS NULL").withColumn("next", F.lit(None).cast(rows.schema["next"].dataType))).withColumn("n_chars", F.char_length("text"))
    tail = F.expr("cast(n_chars div 4 AS int)")
    rows = rows.select("id", "n_chars", "text", F.coalesce("next.next_fp", F.array().cast("array<int>")).alias("next_fp"), F.concat(F.expr("substring(text, 1, n_chars - cast(n_chars div 4 AS int))"), F.substring(F.coalesce("next.head", F.lit("")), F.lit(1), tail)).alias("edited"))
    rows = with_fingerprint(with_fingerprint(rows, "text", "fp"), "edited", "edited_fp")
    return rows.withColumnRenamed("id", id_col)
