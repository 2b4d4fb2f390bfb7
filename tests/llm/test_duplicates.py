import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docloom.llm import decontaminate, fingerprints, jaccard_join, line_dedup
from docloom.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def only_words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_hits(text, items):
    words, hit, found = only_words(text), set(), set()
    for item, t in items:
        own = only_words(t)
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else ()
        for p in range(len(words) - n + 1):
            if tuple(words[p : p + n]) in windows:
                hit |= set(range(p, p + n))
                found.add(item)
    return len(words), len(hit), sorted(x for x in found if x is not None)


@pytest.mark.parametrize("bounds", [decontaminate.Bounds(), decontaminate.Bounds(0, 0)])
def test_windows(spark, docs, cases, nothing, bounds):
    text = dict(cases)
    items = [(1, " ".join(text[7].split()[50:75]).upper()), (2, text[14]), (3, None), (4, "..."), (5, "Two words"), (6, "one"), (7, " ".join(text[14].split()[38:49])), (7, "again"), (None, " ".join(text[1].split()[3:13])), (9, "a b c")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    out = decontaminate.contamination(docs, bench, bounds=bounds).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in out} == {(i, n, h, tuple(f)) for i, t in cases for n, h, f in [brute_hits(t, items)]}
    kept = {r.doc_id for r in decontaminate.clean_documents(docs, bench, bounds=bounds).collect()}
    assert kept == {i for i, t in cases if not brute_hits(t, items)[1]}
    assert decontaminate.contamination(nothing, bench, bounds=bounds).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0), bounds=bounds).where("n_hit > 0").count() == 0


def test_random_windows(spark):
    random.seed(4)
    say = lambda n: " ".join(random.choice("abcdef") for _ in range(n))
    rows = [(i, say(random.randint(0, 120))) for i in range(40)]
    items = [(i, say(random.choice([4, 9, 10, 11, 30])) if i % 2 else rows[i][1][:40]) for i in range(12)]
    out = decontaminate.contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in out} == {(i, n, h, tuple(f)) for i, t in rows for n, h, f in [brute_hits(t, items)]}


def test_fingerprints(docs, cases, nothing):
    out = fingerprints.edited_pairs(docs).select("doc_id", "n_chars", "text", "edited", fingerprints.written("fp").alias("f"), fingerprints.likeness(fingerprints.hashes("fp"), fingerprints.hashes("edited_fp")).alias("near")).collect()
    assert len(out) == len(cases)
    first = {}
    for i, t in cases:
        if i is not None:
            first[i] = min(first.get(i, t or ""), t or "")
    order = sorted(first)
    for r in out:
        after = "" if r.doc_id is None else first[order[(order.index(r.doc_id) + 1) % len(order)]]
        q = len(r.text) // 4
        assert r.n_chars == len(r.text) and r.edited == r.text[: len(r.text) - q] + after[:q]
        assert 0 <= r.near <= 1
    by_text = {}
    for r in out:
        assert by_text.setdefault(r.text, r.f) == r.f
    assert next(r.near for r in out if r.doc_id == 7) > 0.5
    assert fingerprints.edited_pairs(nothing).count() == 0


def test_shared_runs_share_a_hash(spark):
    random.seed(8)
    say = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    run = say(fingerprints.K + fingerprints.W - 1)
    rows = [(i, " ".join([*say(i), *run, *say(9)])) for i in range(20)]
    df = fingerprints.with_fingerprint(spark.createDataFrame(rows, "id int, text string"), "text", "f")
    found = [{x["hash"] for x in r.f} for r in df.collect()]
    assert set.intersection(*found)


def brute_components(rows):
    sets = {}
    for n, (i, t) in enumerate(rows):
        words = (t or "").translate(LOWER).encode().split()
        sets[n] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            c = len(sets[a] & sets[b])
            if c and 100 * c >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted((str(i), len(sets[n]), str(None if i is None else least[find(n)])) for n, (i, _) in enumerate(rows))


def test_jaccard(docs, cases, nothing):
    out = jaccard_join.jaccard_components(docs)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out.collect()) == brute_components(cases)
    assert jaccard_join.jaccard_components(nothing).count() == 0
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in cases} - {2, 3, 9}


@pytest.mark.parametrize("length", [12, 60, 300])
def test_jaccard_near_threshold(spark, length):
    random.seed(length)
    say = lambda n: [f"w{random.randint(0, 5000)}" for _ in range(n)]
    passage, rows = say(40), []
    for family in range(6):
        base = say(length)
        for _ in range(12):
            text = list(base)
            for _ in range(random.randint(0, max(1, length // 25))):
                text[random.randrange(len(text))] = f"e{random.randint(0, 5000)}"
            if random.random() < 0.3:
                text = text[: random.randint(length * 2 // 3, length)]
            rows.append((len(rows), " ".join(text if family < 4 else [*passage, *text])))
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out.collect()) == brute_components(rows)


def test_jaccard_links(spark):
    random.seed(13)
    say = lambda n: [f"w{random.randint(0, 5000)}" for _ in range(n)]
    rows = []
    for length in (12, 60, 300):
        base = say(length)
        for _ in range(14):
            text = list(base)
            for _ in range(random.randint(0, max(1, length // 25))):
                text[random.randrange(length)] = random.choice("xyz")
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows), rows[20][1]), (len(rows) + 1, ""), (len(rows) + 2, "alone")]
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := t.split()) else frozenset() for i, t in rows}
    alike = lambda x, y: bool(x & y) and 100 * len(x & y) >= 75 * len(x | y)
    first = {}
    for i, x in sets.items():
        first.setdefault(x, i)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    links = {(r.a, r.b, r.n_a, r.n_b, r.common) for r in jaccard_join.jaccard_links(docs).collect()}
    assert links == {(i, j, len(x), len(y), len(x & y)) for x, i in first.items() for y, j in first.items() if i < j and alike(x, y)} and len(links) > 30
    counts = {r.doc_id: r.n_links for r in jaccard_join.jaccard_link_counts(docs).collect()}
    assert counts == {i: sum(alike(x, y) for j, y in sets.items() if j != i) for i, x in sets.items()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (200, 200), (None, 5)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert out == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}


def one_word_apart(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < line_dedup.NEAR_WORDS or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else (a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i:])


def brute_lines(rows):
    seen, out = [], []
    ordered = sorted({(i, t) for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    kept = {}
    for i, t in ordered:
        lines = [] if t is None else t.split("\n")
        stay = []
        for line in lines:
            words = tuple(line.translate(LOWER).encode().split())
            if not (len(words) >= line_dedup.EXACT_WORDS and any(one_word_apart(words, s) for s in seen)):
                stay.append(line)
            if len(words) >= line_dedup.EXACT_WORDS:
                seen.append(words)
        kept[i, t] = (len(lines), len(lines) - len(stay), None if t is None else "\n".join(stay))
    for i, t in rows:
        out.append((str(i), *kept[i, t]))
    return sorted(out, key=str)


def test_lines(docs, cases, nothing):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted(((str(r.doc_id), r.n_lines, r.n_removed, r.text) for r in out.collect()), key=str) == brute_lines(cases)
    assert line_dedup.dedup_lines(nothing).count() == 0
    clashing = line_dedup.dedup_lines(docs.withColumns({"n_removed": F.lit("old"), "n_lines": F.lit("old")}))
    assert clashing.columns == out.columns and sorted(map(tuple, clashing.collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


def test_edited_lines(spark):
    random.seed(9)
    say = lambda n: [random.choice("abcdefg") for _ in range(n)]
    bases, rows = [say(n) for n in (4, 9, 10, 11, 16, 17, 33)], []
    for i in range(60):
        lines = []
        for _ in range(3):
            line = list(random.choice(bases))
            for _ in range(random.choice([0, 1, 1, 2])):
                p = random.randrange(len(line))
                line[p : p + random.choice([0, 1])] = random.choice([[], [random.choice("abcdefgh")]])
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(((str(r.doc_id), r.n_lines, r.n_removed, r.text) for r in out.collect()), key=str) == brute_lines(rows)


def plain_lines(rows):
    """What dedup_lines keeps, by comparing every line with every earlier one; rows have distinct ids. Nothing is read from the operator."""
    seen, out = [], []
    for i, t in sorted(rows):
        stay = []
        for line in t.split("\n"):
            words = line.translate(LOWER).encode().split()
            near = lambda s: len(words) > 3 and len(s) > 3 and brute_distance(words, s) < 2  # noqa: E731, B023
            if not words or not any(words == s or near(s) for s in seen):
                stay.append(line)
            seen.append(words)
        out.append((i, len(t.split("\n")), len(t.split("\n")) - len(stay), "\n".join(stay)))
    return out


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, old[j + 1] + 1, old[j] + (x != y)))
    return row[-1]


def test_lines_of_any_length(spark):
    random.seed(10)
    say = lambda n: [random.choice("abcdefghij") for _ in range(n)]
    rows = [(1, "les.\nand ornd.\nonly here\n\na b c d\none two three four five six"), (2, "Les.\nAND  ornd.\n \na b c\na b c x\none two three 4 five six"), (3, "les.\na b x\nb c d\none two three five six\nnone two three four five six")]
    bases = [say(n) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)]
    for i in range(4, 60):
        lines = []
        for _ in range(3):
            line = list(random.choice(bases))
            for _ in range(random.choice([0, 1, 2])):
                p = random.randrange(len(line) + 1)
                line[p : p + random.choice([0, 1])] = random.choice([[], say(1)])
                line = line or ["z"]
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()) == plain_lines(rows)
    assert [n for _, _, n, _ in plain_lines(rows)[:3]] == [0, 4, 3]


def test_equal_hashes_of_unequal_lines(spark):
    # their full variants agree in the lowest 43 bits
    a, b = "k11 k23 k45 k43", "k19 k22 k18 k43"
    rows = [(1, a), (2, b), (3, a), (4, b), (5, b + " more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [(r.doc_id, r.n_removed) for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 1)]


def test_candidates_by_chance(spark):
    random.seed(12)
    bases = [[f"w{random.randint(0, 30)}" for _ in range(random.choice([4, 5, 8, 12]))] for _ in range(40)]
    rows = []
    for i in range(80):
        line = list(random.choice(bases))
        line[random.randrange(len(line))] = random.choice(["x", "y", line[0]])
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # so few bits that unequal variants meet all the time
    out = line_dedup.dedup_lines(docs, hash_bits=11).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out) == plain_lines(rows)


def test_sha_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_word_hashes_and_sets():
    long = "Q" * 64
    text = f"One two\tTHREE\x0bone\n\n{long} {long}x {long.lower()}X Été été \x1fone one two  one"
    words = text.translate(LOWER).encode().split()
    hashes, starts = jaccard_join.word_hashes(text.encode())
    assert len(hashes) == len(starts) == len(words)
    assert [list(hashes).index(h) for h in hashes] == [words.index(w) for w in words]

    texts = [None, "", " \n", "a", "A b", "a b c d e f g", text, " ".join("abcab" * 50), "a b c d e f g a b c d e f g"]
    grams, offsets = jaccard_join.shingle_sets(texts * 30)
    found = [frozenset(grams[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    whole = [shingles((t or "").translate(LOWER).encode().split()) for t in texts] * 30
    assert [len(x) for x in found] == [len(x) for x in whole] == list(offsets[1:] - offsets[:-1])
    assert all((a == b) == (x == y) and len(a & b) == len(x & y) for a, x in zip(found[:9], whole) for b, y in zip(found, whole))


def test_sets_in_bounded_memory():
    import tracemalloc

    random.seed(9)
    texts = [" ".join(str(random.randrange(10**6)) for _ in range(400)) for _ in range(2500)]
    jaccard_join.shingle_sets(texts[:1])
    tracemalloc.start()
    grams, _ = jaccard_join.shingle_sets(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the sets, once more while they are put together, and what a part of the texts needs
    assert len(grams) > 900_000
    assert peak < 2 * grams.nbytes + 60_000_000


def test_sets_and_groups_of_one_pass(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (3, "A b c d e  f"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    own, groups = jaccard_join.sets_and_groups(docs)
    own = own.collect()
    assert sorted((r.id or 0, r.n, r.key is None) for r in own) == [(0, 0, True), (0, 2, False), (1, 2, False), (1, 2, False), (2, 0, True), (3, 2, False)]
    assert len({r.key for r in own if r.key is not None}) == 1
    assert groups.count() == 0
