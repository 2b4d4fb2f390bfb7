"""Exact top-k and whitening against plain recomputations."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from docloom.llm import queries, topk, whitening  # noqa: E402

KIND = "id bigint, vector array<float>, score string, ask int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 0) for i, v in rows], KIND)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = [(i, [r.gauss(0, 0.2) if r.random() < 0.7 else 0.0 for _ in range(6)]) for i in range(120)]
    out += [(130 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]) for i in range(9)]  # ties
    out += [(7, list(out[7][1])), (150, None), (151, []), (152, [None] * 6), (153, [math.nan] * 6), (154, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 6), (155, [0.5]), (200, [0.0] * 6)]
    return out


def scaled(v, by):
    return [math.floor(by * float(np.float32(c))) for c in v]


def fit_for_use(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def test_top_k(spark, rows, monkeypatch):
    # many small blocks and pieces give the same as one
    for name, size in (("QUERY_ROWS", 2), ("CANDIDATE_ROWS", 16), ("PIECE", 8), ("TOGETHER", 3)):
        monkeypatch.setattr(topk, name, size)
    df = table(spark, rows)
    asked = df.where("id % 50 = 0 OR id = 7 OR id = 151")
    known = [(i, scaled(v, 256)) for i, v in rows if i is not None and fit_for_use(v)]
    expected = []
    for q, x in known:
        if q % 50 == 0 or q in (7, 151):
            best = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), c) for c, y in known if c != q)[:5]
            expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert sorted(map(tuple, topk.top_k(asked, df).collect())) == sorted(expected)
    assert len([e for e in expected if e[0] == 7]) == 10  # the repeated query row asks twice


def test_top_k_edges(spark, rows):
    df = table(spark, rows)
    assert topk.top_k(df.limit(0), df).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0
    few = table(spark, [(0, [1.0, 2.0]), (1, [1.0, -1.0])])
    assert sorted(map(tuple, topk.top_k(few, few).collect())) == [(0, 1, 1, -65536), (1, 1, 0, -65536)]
    huge = table(spark, [(0, [3e38]), (1, [3e38])])
    with pytest.raises(Exception, match="leaves a long"):
        topk.top_k(huge, huge).collect()


def test_postings_leave_out_zeros():
    x = np.array([[0, 1, 5], [0, 0, 6], [0, 0, 7]])
    first, second, third = topk.postings(x)
    assert first is None and second[0].tolist() == [0] and second[1].tolist() == [1] and third[0] == slice(None)


def test_whiten(spark):
    r = np.random.default_rng(5)
    v = (r.normal(size=(300, 6)) @ r.normal(size=(6, 6))).astype(np.float32)
    v[:, 5] = v[:, 4]  # one component does not vary
    v[100:200] = v[0]  # copies
    bad = [(900, None), (901, []), (902, [math.nan] * 6), (903, [None] + [1.0] * 5), (904, [1.0] * 5), (905, [math.inf] * 6)]
    df = spark.createDataFrame([(i, [float(c) for c in x], "clash", 0) for i, x in enumerate(v)] + [(i, x, "clash", 0) for i, x in bad], "id bigint, vector array<float>, whitened string, n int")
    got = whitening.whiten(df, components=32, scale=64, offset=1_000_000).toPandas()
    x = np.floor(64 * v.astype(float)).astype(np.int64) + 1_000_000
    n = len(x)
    moved = n * x - x.sum(axis=0)
    centred = moved / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = int((values > values[0] * whitening.LEAST**2).sum())
    assert kept == 5 and set(got.component) == set(range(1, 6)) and len(got) == 5 * n and set(got.n) == {n}
    expected = {i: sum(int(d) ** 2 for d in row) for i, row in enumerate(moved)}
    assert all(expected[i] == int(d) for i, d in zip(got.id, got.deviation, strict=True))
    white = got.pivot(index="id", columns="component", values="whitened").to_numpy()
    plain = centred @ axes[:, :kept] / np.sqrt(values[:kept])
    plain *= np.sign((plain * white).sum(axis=0))
    assert np.abs(plain - white).max() < 1e-8
    share = got.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.abs(share / (values[:kept] / values.sum()) - 1).max() < 1e-9
    assert got.identity_error.max() < 1e-8


def test_whiten_without_variance(spark):
    schema = "id bigint, vector array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(None, [0.0, 0.0]), (2, [1.0, 0.0])], schema), scale=2)
    assert sorted((str(r.id), r.component, round(abs(r.whitened), 9), round(r.explained, 9)) for r in line.collect()) == [("2", 1, 1.0, 1.0), ("None", 1, 1.0, 1.0)]


def test_registered(spark, tmp_path):
    r = np.random.default_rng(8)
    v = r.normal(0, 0.2, size=(210, 12)).astype(np.float32)
    spark.createDataFrame([(i, [float(c) for c in x], 0) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    x = np.floor(256 * v.astype(float)).astype(np.int64)
    expected = [(q, k + 1, c, int(x[q] @ x[c])) for q in range(0, 210, 50) for k, c in enumerate(sorted((c for c in range(210) if c != q), key=lambda c: (-(x[q] @ x[c]), c))[:5])]
    found = queries.QUERIES["op11_exact_topk"](spark, str(tmp_path))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == expected
    white = queries.QUERIES["op12_whitening"](spark, str(tmp_path))
    assert dict(white.dtypes)["deviation"] == "bigint"
    made = white.toPandas()
    y = np.floor(64 * v.astype(float)).astype(np.int64)
    moved = 210 * y - y.sum(axis=0)
    assert len(made) == 210 * 12 and {i: d for i, d in zip(made.vec_id, made.deviation, strict=True)} == {i: int((m**2).sum()) for i, m in enumerate(moved)}
    values = np.linalg.eigvalsh(moved.T @ moved / 210**3)[::-1]
    assert np.abs(made.drop_duplicates("component").sort_values("component").explained.to_numpy() - values / values.sum()).max() < 1e-12
