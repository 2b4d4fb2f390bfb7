"""The neighbourhood join against a comparison of all pairs, and the share of pairs that it looks at."""

import math
import os

import numpy as np
import pytest

from docloom.operators import cluster

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.1")


def near(vectors, eps):
    """(a, b, distance), number by number in the order of the axes."""
    out = []
    with np.errstate(over="ignore"):
        for i, x in enumerate(vectors):
            for j in range(i + 1, len(vectors)):
                y = vectors[j]
                if not x or not y or len(x) != len(y) or not all(c is not None and math.isfinite(c) for c in (*x, *y)):
                    continue
                total = np.float64(0)
                for a, b in zip(x, y, strict=True):
                    total += (np.float64(a) - np.float64(b)) * (np.float64(a) - np.float64(b))
                if np.sqrt(total) <= eps:
                    out.append((i, j, float(np.sqrt(total))))
    return out


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)], "id bigint, embedding array<double>")


def found(spark, vectors, eps):
    return sorted(map(tuple, cluster.neighbours(table(spark, vectors), eps).collect()))


@pytest.mark.parametrize(("axes", "eps"), [(1, 0.01), (2, 0.05), (4, 0.3), (20, 4.0), (64, 11.2)])
def test_random_vectors(spark, axes, eps):
    vectors = np.random.default_rng(axes).normal(size=(220, axes)).tolist()
    expected = near(vectors, eps)
    assert expected and found(spark, vectors, eps) == expected


def test_vectors_that_are_near_none_harm_no_others(spark):
    nan, inf = math.nan, math.inf
    assert found(spark, [[0, 1.0], [0, 1.1], [nan, 1.0]], 0.25) == near([[0, 1.0], [0, 1.1]], 0.25)
    odd = [[0, 1.0], [0, 1.1], [nan, 1.0], [inf, 1.0], [-inf, 1.0], [None, 1.0], None, [], [1.0], [1.05], [0, 0, 1.0], [1e200, 1.0], [1e200, 1.05], [1e308, -1e308], [-1e308, 1e308], [1e308, -1e308]]
    assert [p[:2] for p in near(odd, 0.25)] == [(0, 1), (8, 9), (11, 12), (13, 15)]
    assert found(spark, odd, 0.25) == near(odd, 0.25)
    assert found(spark, [None, [], [nan]], 0.25) == []


def test_lengths_copies_and_many_lists(spark, monkeypatch):
    r = np.random.default_rng(3)
    vectors = r.normal(size=(150, 8)).tolist() + r.normal(size=(60, 5)).tolist() + [[0.5] * 8] * 40 + (0.01 * r.normal(size=(90, 8))).tolist()
    for numbers in (cluster.LIST_NUMBERS, 8):  # in the second case a list has 64 vectors
        monkeypatch.setattr(cluster, "LIST_NUMBERS", numbers)
        assert found(spark, vectors, 0.9) == near(vectors, 0.9)


def work(spark, df, eps, id_col="id"):
    met, compared = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    n, pairs = df.count(), cluster.neighbours(df, eps, id_col, work={"met": met, "compared": compared}).count()
    return pairs, met.value / (n * (n - 1) / 2), compared.value / (n * (n - 1) / 2)


def test_distant_clusters_do_not_meet(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(40, 64))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    vectors = (centres[r.integers(40, size=800)] + 0.02 * r.normal(size=(800, 64))).tolist()
    pairs, met, compared = work(spark, table(spark, vectors), 0.25)
    assert pairs == len(near(vectors, 0.25)) and compared <= met < 0.05


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_few_pairs_are_compared(spark):
    # vectors in all directions, none near another: cells rule out a third, the leading axes nearly all the others
    _, met, compared = work(spark, spark.read.parquet(f"{DIR}/embeddings.parquet"), 0.25, "vec_id")
    assert met < 0.75 and compared < 0.05


def labels(spark, vectors, eps, least):
    df = table(spark, vectors)
    return {r.id: r.label for r in cluster.density_labels(df, eps, least).collect()}


@pytest.mark.parametrize("least", [1, 2, 3, 4])
def test_density_labels(spark, least):
    """Cores and border points, copies among them, by the definition."""
    r = np.random.default_rng(least)
    vectors = r.uniform(size=(90, 2)).tolist()
    vectors += [vectors[3]] * 3 + [vectors[7], [5.0, 5.0], [5.0, 5.0], [9.0, 9.0], None, [math.nan, 1.0]]
    eps, n = 0.05, len(vectors)
    near_to = {i: {i} for i, v in enumerate(vectors) if v and all(map(math.isfinite, v))}
    for a, b, _ in near(vectors, eps):
        near_to[a].add(b)
        near_to[b].add(a)
    cores = {i for i, others in near_to.items() if len(others) >= least}
    label = {i: i for i in cores}
    for _ in range(n):
        label = {i: min(label[j] for j in near_to[i] if j in cores) for i in cores}
    expected = {i: label.get(i, min((label[j] for j in near_to.get(i, ()) if j in cores), default=None)) for i in range(n)}
    assert labels(spark, vectors, eps, least) == expected


def test_copies_are_not_paired(spark):
    # three thousand copies would be four and a half million pairs
    got = labels(spark, [[1.0, 2.0]] * 3000 + [[1.0, 2.01], [8.0, 8.0]], 0.25, 2)
    assert set(got.values()) == {0, None} and got[3000] == 0 and got[3001] is None
