"""Sentences by what the texts themselves tell about their abbreviations (Kiss and Strunk, 2006).

A period ends a sentence unless its word is an abbreviation, an initial or a number; then only before a capitalised word that
is known to start sentences. Abbreviations are words that stand with a period more often than chance explains, the better the
shorter they are and the more periods they hold; starters follow clear ends of sentences more often than chance explains. The
statistics are counts over all texts, aggregated by word and by pair of words; pairs bound by collocation are not looked for.

Everything is an expression, an aggregation or a join: the model is a table of any size that the planner broadcasts or
shuffles by its size, and only words with a mark or a blank line behind them are joined with it.

Null and empty texts, and those of blanks alone, have no sentence. Equal texts in different rows count each. A table without
words has an empty model. The sentences of a text, one after the other, are the text without its leading blanks.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.columns import require
from docloom.functions.splitters import Strategy, pack_sentences
from docloom.operators.project import chunk_ids
from docloom.session import written

#: Fixed values of the paper: least scores of abbreviations and of starters, probability of a period behind an abbreviation.
ABBREVIATION, STARTER, CERTAIN = 0.3, 30.0, 0.99

_BLANK = r"[\x20\x09-\x0D]"
_PIECE = rf"[^\x20\x09-\x0D]+{_BLANK}*"
_CLOSING = r"""["'”’»)\]]*$"""
#: What every end of a sentence holds; one cheap match before the closer ones.
_ANY = r"[.!?…。！？\n]"
_EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def _type(word: Column) -> Column:
    """A word in lower case without what stands around it."""
    return F.lower(F.regexp_replace(word, _EDGES, ""))


def _word(piece: Column) -> Column:
    return F.regexp_replace(piece, rf"{_BLANK}+$", "")


def _mark(piece: Column) -> Column:
    """What ends a word: a period, a clear end, several periods, or nothing."""
    core = F.regexp_replace(_word(piece), _CLOSING, "")
    return F.when(core.rlike(r"(\.\.|…)$"), "…").when(core.rlike(r"\.$"), ".").when(core.rlike(r"[!?。！？]$"), "!")


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))


def _counted(count: Column, p: Column) -> Column:
    return F.when(count == 0, 0.0).otherwise(count * F.ln(p))


@dataclass(frozen=True)
class Model:
    """``words``: type, n, periods, score, abbreviation; ``starters``: type, n, begins, score, starter."""

    words: DataFrame
    starters: DataFrame


def learn(df: DataFrame, text: str = "text") -> Model:
    """Counts of all words and of the words behind ends of sentences; two aggregations over the texts, two rows to the driver."""
    require(df, text)
    pieces = df.select(_pieces(F.col(text)).alias("pieces"))
    # patterns are matched once for each different word
    words = pieces.select(F.explode("pieces").alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))
    words = words.select(_type(_word(F.col("piece"))).alias("type"), F.when(_mark(F.col("piece")) == ".", F.col("n")).otherwise(0).alias("periods"), "n")
    counts = written(words.groupBy("type").agg(F.sum("n").alias("n"), F.sum("periods").alias("periods")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("periods"), F.lit(0)).alias("periods")).first()

    p = F.lit(total.periods / max(total.n, 1))
    without, dots = F.col("n") - F.col("periods"), F.length(F.regexp_replace("type", r"[^.]", ""))
    letters = F.length("type") - dots
    ratio = -2 * (_counted(F.col("periods"), p) + _counted(without, 1 - p) - _counted(F.col("periods"), F.lit(CERTAIN)) - _counted(without, F.lit(1 - CERTAIN)))
    score = F.when((F.col("periods") > 0) & F.col("type").rlike(r"\p{L}"), ratio * F.exp(-letters) * (dots + 1) * F.pow(letters.cast("double"), -without))
    known = counts.withColumn("score", score).withColumn("abbreviation", F.coalesce(F.col("score") >= ABBREVIATION, F.lit(False)))

    pairs = pieces.select(F.explode(F.arrays_zip(F.slice("pieces", 1, F.greatest(F.size("pieces") - 1, F.lit(0))).alias("piece"), F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0))).alias("behind"))).alias("pair")).select("pair.*")
    pairs = pairs.where(F.col("piece").rlike(_ANY)).groupBy("piece", "behind").agg(F.count("*").alias("n"))
    ends = pairs.select("n", _mark(F.col("piece")).alias("mark"), _type(_word(F.col("piece"))).alias("type"), _type(_word(F.col("behind"))).alias("behind")).where("mark IN ('.', '!')")
    # counted by pair before the join, so that no frequent word meets the model more than once for each word behind it
    ends = ends.groupBy("mark", "type", "behind").agg(F.sum("n").alias("n"))
    clear = (F.col("mark") == "!") | ~_held(F.col("abbreviation"), F.col("type"))
    begins = written(ends.join(known.select("type", "abbreviation"), "type").where(clear).groupBy(F.col("behind").alias("type")).agg(F.sum("n").alias("begins")))
    a = begins.agg(F.coalesce(F.sum("begins"), F.lit(0))).first()[0]

    ab, b, n = F.col("begins"), F.col("n"), total.n
    p0, p1, p2 = b / F.lit(float(max(n, 1))), ab / F.lit(float(max(a, 1))), (b - ab) / F.lit(float(max(n - a, 1)))
    rest = F.lit(n - a) - b + ab
    drawn = _counted(ab, p0) + _counted(F.lit(a) - ab, 1 - p0) + _counted(b - ab, p0) + _counted(rest, 1 - p0)
    apart = _counted(ab, p1) + _counted(F.lit(a) - ab, 1 - p1) + _counted(b - ab, p2) + _counted(rest, 1 - p2)
    starters = begins.join(counts.select("type", "n"), "type").where(F.col("type").rlike(r"\p{L}")).select("type", "n", "begins", (-2 * (drawn - apart)).alias("score"))
    return Model(known, starters.withColumn("starter", (F.col("score") >= STARTER) & (ab / F.lit(float(max(a, 1))) > b / F.lit(float(max(n, 1))))))


def _held(abbreviation: Column, word: Column) -> Column:
    """Words behind which a period says nothing: abbreviations, initials, numbers."""
    return F.coalesce(abbreviation, F.lit(False)) | word.rlike(r"^(\p{L}|\p{N}+)$")


def split_sentences(df: DataFrame, model: Model, text: str = "text", id_col: str = "id", keep: str | None = None) -> DataFrame:
    """``id_col``, the column ``keep`` and ``sentences``, an array, for every row; blanks stay behind the sentence that they follow.

    Ids may be null or repeated: places meet their text by a 128-bit hash of id and text, so copies under many ids are many keys.
    """
    require(df, text, id_col)
    docs = df.select(F.col(id_col).alias("id"), F.md5(F.to_json(F.struct(F.col(id_col).alias("id"), F.col(text).alias("text")))).alias("key"), _pieces(F.col(text)).alias("pieces"), *([F.col(keep).alias("kept")] if keep else []))
    last = F.size("pieces") - 1
    ends = F.filter(F.transform("pieces", lambda p, i: F.struct((i + 1).alias("at"), p.alias("piece"), F.get("pieces", i + 1).alias("behind"))), lambda x: (x["at"] <= last) & x["piece"].rlike(_ANY) & (_mark(x["piece"]).isNotNull() | x["piece"].rlike(rf"\n{_BLANK}*\n")))
    ends = docs.select("key", F.explode(ends).alias("end")).select("key", "end.*")
    ends = ends.select("key", "at", _mark(F.col("piece")).alias("mark"), F.col("piece").rlike(rf"\n{_BLANK}*\n").alias("blank"), _type(_word(F.col("piece"))).alias("type"), _type(_word(F.col("behind"))).alias("behind"), F.regexp_replace("behind", r"^[^\p{L}\p{N}]+", "").rlike(r"^\p{Lu}").alias("capital"))
    abbreviations = model.words.where("abbreviation").select("type", "abbreviation")
    starters = model.starters.where("starter").select(F.col("type").alias("behind"), "starter")
    told = ends.join(abbreviations, "type", "left").join(starters, "behind", "left")
    begin = F.col("capital") & F.coalesce("starter", F.lit(False))
    is_end = F.col("blank") | F.when(F.col("mark") == "!", True).when(F.col("mark") == "…", F.col("capital")).otherwise(F.coalesce(~_held(F.col("abbreviation"), F.col("type")) | begin, F.lit(False)))
    # the places of a text are numbers, so a text's group is smaller than the text
    cuts = told.where(is_end).groupBy("key").agg(F.array_sort(F.collect_set("at")).alias("cuts"))
    cut = F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>")), F.array(F.size("pieces")))
    sentences = F.transform(F.slice(cut, 1, F.size(cut) - 1), lambda a, i: F.array_join(F.slice("pieces", a + 1, F.get(cut, i + 1) - a), ""))
    return docs.join(cuts, "key", "left").select(F.col("id").alias(id_col), F.when(F.coalesce(F.size("pieces"), F.lit(0)) > 0, sentences).otherwise(F.array().cast("array<string>")).alias("sentences"), *([F.col("kept").alias(keep)] if keep else []))


def chunk_sentences(df: DataFrame, model: Model, plan: Strategy, content: str = "content", id_col: str = "id") -> DataFrame:
    """All columns with ``chunk`` and ``chunk_id``: as many sentences as fit into the plan's size, longer ones cut at blanks."""
    require(df, content, id_col)

    @F.pandas_udf("array<string>")
    def pack(lists: pd.Series) -> pd.Series:
        return lists.map(lambda found: pack_sentences([s.strip() for s in found if s.strip()], plan.chunk_size, plan.chunk_overlap))

    packed = df.select(F.struct(*df.columns).alias("row"), F.col(content).alias("text"), F.col(id_col).alias("id"))
    rows = split_sentences(packed, model, "text", "id", keep="row")
    return rows.select("row.*", F.posexplode(pack("sentences")).alias("pos", "chunk")).withColumn("chunk_id", chunk_ids(id_col)).drop("pos")
