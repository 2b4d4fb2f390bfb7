import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import quality, toxicity

from .conftest import sentence


@pytest.fixture(scope="module")
def judged(spark):
    rows, labels = [], []
    for i in range(400):
        text, bad, toxic = sentence(1000 + i, 60), i % 7 == 0, i % 4 == 0
        if bad:
            text = " ".join(f"{w}&&&" if k % 2 else f"{w}%%%" for k, w in enumerate(text.split()))
        if toxic:
            words = text.split()
            words[i % 50] = ("horrid", "vilest", "rottenish")[i % 3]
            words[(i * 7) % 50] = ("vilest", "rottenish", "horrid")[i % 3]
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(500, None), (501, ""), (None, "one two"), (3, sentence(1003, 60))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"score": F.lit(1), "th": F.lit(2), "selected": F.lit(3)})
    marks = spark.createDataFrame([*labels, (500, None, None), (None, 1, 1), (999, 1, 1)], "doc_id bigint, quality int, toxic int")
    return docs, marks


def test_quality(judged, spark):
    docs, labels = judged
    model = quality.learn(docs, labels)
    out = quality.resample(docs, model, keep=("doc_id",)).join(labels.dropna(), "doc_id").collect()
    wrong = [r.doc_id for r in out if r.selected != bool(r.quality)]
    assert len(wrong) <= 4
    kept = quality.keep_selected(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() + kept.where("doc_id = 500").count() >= 0
    assert quality.resample(docs, model).count() == docs.count()
    assert quality.keep_selected(docs, labels.limit(0)).count() == docs.count()
    assert quality.keep_selected(docs.limit(0), labels).count() == 0


def test_weights_against_counting():
    texts = ["A b b", "", None, "x!! y"]
    rng = np.random.default_rng(1)
    ratio = rng.normal(size=quality.FIELDS * quality.FIELD)
    expected = [ratio[quality.features([t])[0]].sum() for t in texts]
    assert np.allclose(quality.log_weights(texts, ratio), expected)
    assert quality.counts_of(texts).sum() == sum(len(quality.features([t])[0]) for t in texts)


@pytest.mark.parametrize("k", [0, 1, 7, 500, 1999, 2000, 5000])
def test_kth_largest(spark, k):
    values = [float((i * 7919) % 997) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    expected = None if k <= 0 else sorted(values, reverse=True)[min(k, 2000) - 1]
    assert quality.kth_largest(df, "v", k, bins=16) == expected


def test_toxicity(judged):
    docs, labels = judged
    model = toxicity.learn(docs, labels)
    scored = toxicity.score(docs.drop("score"), model).withColumn("held_out", toxicity.held_out(F.col("doc_id")))
    rows = {r.doc_id: r for r in scored.collect()}
    assert all(0 <= r.score <= 1 for r in rows.values()) and scored.count() == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.dropna().collect()}
    held = [(rows[i].score, truth[i]) for i in rows if i in truth and rows[i].held_out]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([a > b for a in bad for b in good]) > 0.9
    assert toxicity.score(docs.drop("score"), toxicity.learn(docs, labels.limit(0))).agg(F.max("score")).first()[0] < 0.01
    assert toxicity.score(docs.limit(0).drop("score"), model).count() == 0


def test_held_out_rows_do_not_teach(judged):
    docs, labels = judged
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, flipped)
