"""Sentences by learned abbreviations, on texts whose sentences are known."""

import pytest
from pyspark.sql import functions as F

from docloom.functions.splitters import Strategy
from docloom.operators import sentences

WORDS = ["river", "stone", "market", "window", "garden", "letter", "summer", "bridge"]


def corpus():
    """Sentences with abbreviations in their middle, most of which begin with one of two words."""
    made = []
    for i in range(400):
        a, b, c = (WORDS[(i * k + k) % 8] for k in (1, 3, 5))
        begin = ("The", "This", "Every", WORDS[i % 8].title())[min(i % 5, 3)]
        middle = ("met Dr. Stone at the", "came, e.g. with a", "saw ca. 40 of a", "of J. Miller and the")[i % 4]
        made.append(f"{begin} {a} {middle} {b} {c}{'.!?'[i % 3]}")
    return made


@pytest.fixture(scope="module")
def learned(spark):
    known = corpus()
    texts = [(i, " ".join(known[i : i + 10])) for i in range(0, 400, 10)]
    df = spark.createDataFrame(texts, "id bigint, text string")
    return df, sentences.learn(df), known


def test_abbreviations_and_starters(learned):
    _, model, _ = learned
    assert {r.type for r in model.words.where("abbreviation").collect()} >= {"dr", "e.g", "ca"}
    assert not {r.type for r in model.words.where("abbreviation").collect()} & set(WORDS)
    assert {r.type for r in model.starters.where("starter").collect()} >= {"this", "every"}


def test_known_sentences_come_back(learned):
    df, model, known = learned
    got = {r.id: r.sentences for r in sentences.split_sentences(df, model).collect()}
    assert {i: [s.strip() for s in v] for i, v in got.items()} == {i: known[i : i + 10] for i in range(0, 400, 10)}


def test_odd_texts(spark, learned):
    _, model, _ = learned
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "  no mark"), (5, "A heading\n\nthe river. \"He said.\" (So.) end"), (6, "Wait... the river. Wait... The river"), (7, "with e.g. Stone and e.g. Every bridge"), (8, "... ! ? ."), (9, "x. " * 30000), (10, "same. same."), (11, "same. same."), (12, "one. two. three."), (12, "four five."), (None, "a river. b river.")]
    df = spark.createDataFrame(rows, "id bigint, text string").withColumn("type", F.lit("x")).withColumn("cuts", F.lit(1)).withColumn("pieces", F.lit(2))
    out = sentences.split_sentences(df.union(df.where("id = 10 OR id IS NULL")), model)
    assert out.count() == len(rows) + 2
    got = {r.id: r.sentences for r in out.collect()}
    assert got[None] == ["a river. ", "b river."]
    assert got[1] == got[2] == got[3] == [] and got[4] == ["no mark"]
    assert got[5] == ["A heading\n\n", "the river. ", '"He said." ', "(So.) ", "end"]
    assert got[6] == ["Wait... the river. ", "Wait... ", "The river"]
    assert got[7] == ["with e.g. Stone and e.g. ", "Every bridge"]
    assert got[10] == got[11] == ["same. ", "same."]
    assert all("".join(got[i]) == (t or "").lstrip() for i, t in rows if i and i < 12)
    assert sorted(r.sentences for r in out.collect() if r.id == 12) == [["four five."], ["one. ", "two. ", "three."]]
    assert set(out.columns) == {"id", "sentences"}
    assert sentences.learn(df.limit(0)).words.count() == 0 and sentences.learn(df.limit(0)).starters.count() == 0
    assert sentences.split_sentences(df.limit(0), model).count() == 0


def test_chunks_of_sentences(learned):
    df, model, known = learned
    out = sentences.chunk_sentences(df, model, Strategy("p", "nltk", 150, 0), "text").collect()
    assert all(0 < len(r.chunk) <= 150 for r in out)
    assert all(any(r.chunk.startswith(s) for s in known) and any(r.chunk.endswith(s) for s in known) for r in out)


def test_strategy_of_learned_sentences(learned):
    from docloom.operators.chunk import chunk_documents

    df, model, known = learned
    df = df.withColumn("chunks", F.lit("kept"))
    plan = Strategy("mine", "learned", 150, 0)
    want = {tuple(r) for r in sentences.chunk_sentences(df, model, plan, "text").select("chunk_id", "chunk").collect()}
    out = chunk_documents(df, plan, "text")
    assert out.columns == [*df.columns, "chunk", "chunk_id"] and {tuple(r) for r in out.select("chunk_id", "chunk").collect()} == want


def test_no_worker_is_asked(learned):
    df, model, _ = learned
    assert "Python" not in sentences.split_sentences(df, model)._jdf.queryExecution().executedPlan().toString()
