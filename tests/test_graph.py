"""Least spanning forests against Kruskal's, their cuts, and merging of large clusters by growing radii."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.ports import TemplateChat
from docloom.operators import cluster, graph, semantic


def find(parent, x):
    while parent.setdefault(x, x) != x:
        x = parent[x]
    return x


def kruskal(edges):
    parent, out = {}, set()
    for w, u, v in sorted((w, min(u, v), max(u, v)) for u, v, w in edges if u != v):
        a, b = find(parent, u), find(parent, v)
        if a != b:
            parent[a] = b
            out.add((u, v, w))
    return out


@pytest.fixture(scope="module")
def edges():
    r = random.Random(1)
    return [(r.randrange(60), r.randrange(60), r.randrange(12) / 4) for _ in range(110)] + [(100 + i, 101 + i, 1.0) for i in range(30)] + [(5, 5, 0.0)]


def test_spanning_forest(spark, edges):
    df = spark.createDataFrame([*edges, (None, 1, 0.0), (1, 2, None)], "u bigint, v bigint, weight double")
    forest = graph.spanning_forest(df)
    assert {tuple(r) for r in forest.collect()} == kruskal(edges) and forest.count() == len(kruskal(edges))
    expected = set()
    for radius in (0.0, 0.75, 2.0, 9.0):
        parent = {}
        for u, v, w in edges:
            if w <= radius and u != v:
                parent[find(parent, u)] = find(parent, v)
        groups = {}
        for x in list(parent):
            groups.setdefault(find(parent, x), []).append(x)
        expected |= {(radius, x, min(g)) for g in groups.values() for x in g if len(g) > 1}
    assert {tuple(r) for r in graph.components_at(forest, [0.0, 0.75, 2.0, 9.0]).collect()} == expected
    assert graph.spanning_forest(df.limit(0)).count() == 0


def test_only_asking_rows_look_for_neighbours(spark):
    r = random.Random(6)
    points = [(f"p{i}", [r.random(), r.random()], r.random() < 0.2) for i in range(150)]
    df = spark.createDataFrame([*points, ("n", [0.5, 0.5], None)], "id string, embedding array<double>, asks boolean")
    every = {(x.a, x.b) for x in cluster.neighbours(df, 0.1).collect()}
    asks = {i for i, _, a in points if a}
    some = [(x.a, x.b) for x in cluster.neighbours(df, 0.1, asking="asks").collect()]
    assert len(some) == len(set(some)) and set(some) == {p for p in every if asks & set(p)} != every


def plainly(rows, most, start, step, end, settle):
    """Round by round, each root by itself, with all distances anew."""
    rows, done, k = set(rows), set(), 0
    while start + k * step <= end + 1e-9:
        texts = {(root, qid): float(q.split()[-1]) for root, qid, _, q, _ in rows}
        parent = {}
        for a in texts:
            for b in texts:
                if a[0] == b[0] and abs(texts[a] - texts[b]) <= start + k * step + 1e-9:
                    parent[find(parent, a)] = find(parent, b)
        groups = {}
        for a in texts:
            groups.setdefault(find(parent, a), []).append(a)
        chosen = [g for g in groups.values() if 1 < len(g) <= most and tuple(sorted(x[1] for x in g)) not in done]
        for g in chosen:
            done.add(tuple(sorted(x[1] for x in g)))
            own = [r for r in rows if (r[0], r[1]) in g]
            q = f"at {sum(texts[x] for x in g) / len(g):.6f}"
            qid = hashlib.md5(f"question: {q}|answer: a".encode()).hexdigest()
            rows = {r for r in rows if r not in own} | {(r[0], qid, r[2], q, "a") for r in own}
        if not chosen and start + k * step > settle:
            break
        k += 1
    return {(r[0], r[2], r[3]) for r in rows}


def test_recursive_merge_by_the_forest(spark):
    """Questions name their place on a line; merged ones stand at the mean of their places."""

    class Places:
        dimensions = 1

        def embed(self, texts):
            return [[float(t.split()[-1])] for t in texts]

    def reply(prompt):
        found = json.loads(prompt[prompt.index("\n") + 1 :])
        mean = sum(float(f["question"].split()[-1]) for f in found) / len(found)
        return json.dumps({"items": [{"question": f"at {mean:.6f}", "answer": "a", "source_ids": [f["question_id"] for f in found]}]})

    places = {"r": [0.0, 0.0, 0.011, 0.031, 0.5, 0.52, 0.9], "s": [0.0, 0.052, 0.105, 3.0], "t": [1.0 + 0.0301 * i for i in range(6)]}
    rows = [(root, f"q{root}{i}", f"s{i}", f"at {x:.6f}", f"A{i}") for root, xs in places.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "cluster_id string, question_id string, source_id string, question string, answer string")
    got = semantic.merge_recursively(df, Places, lambda: TemplateChat(reply), 4, start=0.02, step=0.02, end=0.08, settle=0.05)
    assert {(x.cluster_id, x.source_id, x.question) for x in got.collect()} == plainly(rows, 4, 0.02, 0.02, 0.08, 0.05)
