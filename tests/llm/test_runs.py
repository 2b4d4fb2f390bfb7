"""Periodic runs against a comparison of all distances."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from docloom.llm import queries, runs  # noqa: E402


def brute_runs(words, least_words=6, least_exponent=4):
    n, out = len(words), []
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length, part = i - start + q, words[start : i + q]
            if length >= max(least_words, least_exponent * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    r = random.Random(5)
    for t in range(1500):
        kinds, n = r.choice([1, 2, 2, 3, 5, 30]), r.randrange(0, 60)
        words = [b"w%d" % r.randrange(kinds) for _ in range(n)]
        if r.random() < 0.6 and n:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randrange(3, 11)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if r.random() < 0.3:
            words = words + [b"x"] * r.randrange(9) + words[:5] * r.randrange(7)
        assert runs.runs_of_words(words) == brute_runs(words), words
        if t % 5 == 0:
            assert runs.runs_of_words(words, 2, 2) == brute_runs(words, 2, 2), words
            assert runs.runs_of_words(words, 6, 3) == brute_runs(words, 6, 3), words


def test_long_texts_are_scanned_in_proportion():
    n = 60_000
    words = [b"w%d" % (k % 7919) for k in range(n)]
    assert runs.runs_of_words(words) == [(0, n, 7919)]
    assert runs.runs_of_words([b"a"] * n) == [(0, n, 1)]
    a, b = b"a", b"ab"
    while len(b) < 3000:
        a, b = b, b + a
    assert runs.runs_of_words([bytes([c]) for c in b]) == []  # no word of Fibonacci has four periods


def test_wrong_hashes_do_no_harm(monkeypatch):
    # with a base of 1 and equal words, sums of words in any order are alike: only the comparison of words decides
    monkeypatch.setattr(runs, "_BASE", 1)
    r = random.Random(2)
    for _ in range(200):
        words = [b"%d" % r.randrange(3) for _ in range(r.randrange(6, 40))] + [b"0", b"1"] * r.randrange(6)
        found = runs.runs_of_words(words)
        assert all(x in brute_runs(words) for x in found)


def test_operator(spark, docs, cases, nothing):
    rows = runs.periodic_runs(docs.withColumn("words", F.lit(1)), keep=["lang", "words"]).collect()
    assert len(rows) == len(cases)
    texts = {}
    for i, text in cases:
        words = (text or "").encode().split()
        texts.setdefault(str(i), []).append((len(words), brute_runs(words), " ".join(map(bytes.decode, words)) if not brute_runs(words) else None))
    for row in rows:
        n, found, collapsed = texts[str(row.doc_id)][0]
        assert (row.n_words, [tuple(x) for x in row.runs], row.lang) == (n, found, "en")
        assert collapsed is None or row.collapsed == collapsed
    assert runs.periodic_runs(nothing).count() == 0
    looped = spark.createDataFrame([(1, "go on " * 5 + "end"), (2, "a a a a a a b b b b b b")], "doc_id bigint, text string")
    assert sorted((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(looped).collect()) == [(1, [(0, 10, 2)], "go on end"), (2, [(0, 6, 1), (6, 6, 1)], "a b")]


def test_registered(spark, tmp_path):
    r = random.Random(9)
    rows = [(i, " ".join(f"w{r.randrange(4 if i % 3 else 500)}" for _ in range(r.randrange(0, 90))) + " \n x" * (i % 9)) for i in range(150)] + [(900, None), (901, ""), (902, "\t\x0b é é  \x1c"), (903, "a " * 12)]
    spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {x.doc_id: tuple(x)[1:] for x in queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    looped = 0
    for i, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            looped += 1
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        all_runs = brute_runs(words)
        best = min(all_runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if all_runs else (None,) * 3
        gone = {k for s, length, q in all_runs for k in range(s + q, s + length)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert found[i] == (len(all_runs), *best, 1000 * best[1] // best[2] if all_runs else None, sha("".join("%d,%d,%d\n" % x for x in all_runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))
    assert looped > 5
