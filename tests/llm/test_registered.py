"""Registered queries on a small folder of tables against plain recomputations that share no code with the operators but models' parameters."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import pytest

P = pytest.importorskip("public_tokenizers")
import xxhash  # noqa: E402

from docloom.llm import byte_bpe, quality, queries, toxicity  # noqa: E402

from .conftest import sentence  # noqa: E402
from .test_duplicates import brute_components, brute_hits, brute_lines  # noqa: E402

MASK = 2**64 - 1


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(60):
        text = "\n".join(sentence(300 + 5 * i + k, 14) for k in range(3))
        if i % 5 == 0:
            text = " ".join(f"{w}%%&" if k % 2 else f"{w}!{w}" for k, w in enumerate(text.split()))
        if i % 4 == 1:
            text = text.replace(" ", " vilest ", 2) + " horrid rottenish vilest"
        out.append((i, text))
    return [*out, (60, out[3][1]), (61, None), (62, ""), (63, " \n"), (64, "é🎉 日本語 don't  WE'LL 1234"), (65, out[7][1] + "\n" + out[8][1]), (66, "two words"), (67, "x" * 700)]


@pytest.fixture(scope="module")
def labels():
    return [(i, int(i % 5 > 0), int(i % 4 == 1)) for i in range(60)] + [(64, None, None), (66, 1, None), (999, 1, 1)]


@pytest.fixture(scope="module")
def folder(spark, rows, labels, tmp_path_factory):
    made = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{made}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{made}/labels.parquet")
    spark.createDataFrame([(1, " ".join(rows[2][1].split()[3:18])), (2, "two words"), (3, None)], "item_id bigint, text string").write.parquet(f"{made}/benchmark.parquet")
    return made


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def got(spark, folder, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, folder).collect()}


def signed(x):
    return x - 2**64 if x >> 63 else x


def spark_hash(*values):
    """xxhash64 as Spark has it: each value's hash is the next one's seed."""
    h = 42
    for kind, value in values:
        h = xxhash.xxh64_intdigest(value.encode() if kind == "s" else struct.pack("<" + kind, value), h)
    return h


def test_op1_and_op3(spark, folder, rows):
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    count = lambda t: len(encoding.encode_ordinary(t))
    coded, edited = got(spark, folder, "op1_byte_bpe"), got(spark, folder, "op3_token_counts")
    assert set(coded) == set(edited) == {i for i, _ in rows}
    for i, t in rows:
        t = t or ""
        assert (coded[i].n_tokens, coded[i].ids_sha256, coded[i].decoded_sha256) == (count(t), sha(" ".join(map(str, encoding.encode_ordinary(t)))), sha(t))
        n, now = len(t), t
        for start, size, new in ((n // 4, 0, " edited, it's"), (n // 2, 20, ""), (n * 3 // 4, 10, "[x]")):
            now = now[:start] + new + now[start + size :]
        assert (edited[i].n_tokens, edited[i].n_tokens_edited, edited[i].n_chars_edited) == (count(t), count(now), len(now))


def test_op2_and_op8_and_op10(spark, folder, rows):
    items = [(1, " ".join(rows[2][1].split()[3:18])), (2, "two words"), (3, None)]
    found = got(spark, folder, "op2_decontaminate")
    for i, t in rows:
        names = sorted(map(str, brute_hits(t, items)[2]))
        assert (found[i].n_hit, found[i].n_items, found[i].items_sha256, found[i].contaminated) == (brute_hits(t, items)[1], len(names), sha(",".join(names)), brute_hits(t, items)[1] > 0)
    assert found[2].contaminated and found[66].contaminated and not found[61].contaminated
    components = got(spark, folder, "op8_jaccard_join")
    assert sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in components.values()), key=str) == sorted(((str(i), n, int(c)) for i, n, c in brute_components(rows)), key=str)
    lines = got(spark, folder, "op10_line_dedup")
    assert sorted(((str(r.doc_id), r.n_lines, r.n_removed, r.kept_sha256) for r in lines.values()), key=str) == sorted(((i, n, gone, sha(t or "")) for i, n, gone, t in brute_lines(rows)), key=str)
    assert lines[60].n_removed == 3 and lines[65].n_removed == 6


def winnowed(text):
    """Hashes of three words; of every four neighbours the least, the rightmost of equal ones, each once, in order."""
    words = [w for w in re.split("[ \t\n\x0b\f\r\x85\xa0 -   　]+", text) if w]
    h = [signed(spark_hash(("s", w))) for w in words]
    grams = [h] if 0 < len(h) < 3 else [h[i : i + 3] for i in range(len(h) - 2)]
    # 36 bits of a gram's hash, as a signed number
    values = [((spark_hash(*(("q", x) for x in g)) & (2**36 - 1)) ^ 2**35) - 2**35 for g in grams]
    chosen = []
    for start in range(max(1, len(values) - 3)) if values else ():
        best = min(values[start : start + 4])
        at = max(k for k in range(start, min(start + 4, len(values))) if values[k] == best)
        if at not in chosen:
            chosen.append(at)
    return [f"{values[k] & 0xFFFFFFFF:08x}" for k in chosen]


def alike(a, b):
    return 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b))) if a or b else 1.0


def test_op6(spark, folder, rows):
    found = got(spark, folder, "op6_fingerprints")
    assert set(found) == {i for i, _ in rows}
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        own, other, behind = winnowed(t), winnowed(edited), winnowed(following)
        r = found[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), sha(edited), "".join(own), "".join(other))
        assert r.near_edited == pytest.approx(alike(own, other)) and r.near_next == pytest.approx(alike(own, behind))


def spread(x):
    for _ in range(2):
        x = ((x ^ x >> 32) * 0xD6E8FEB86659FD93) & MASK
    return x ^ x >> 32


def form(token):
    """Runs of small letters, capitals and digits as one sign each, anything else as it is."""
    kinds = ["a" if c.islower() else "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token]
    return "".join(c for k, c in enumerate(kinds) if not (k and kinds[k - 1] == c and c.isalnum()))


def grams(text):
    words = (text or "").split()
    sides = [[xxhash.xxh32_intdigest(w.lower()) for w in words], [xxhash.xxh32_intdigest(form(w), 1) for w in words]]
    out = []
    for side, h in enumerate(sides):
        out += [(2 * side, spread(x) >> 50) for x in h]
        for k in range(1, len(h)):
            same = int(sides[0][k] == sides[0][k - 1])
            out.append((2 * side + 1, spread((h[k] * 0x9E3779B97F4A7C15 + (h[k - 1] * 2 + same if side else h[k - 1])) & MASK) >> 50))
    return out


def test_op7(spark, folder, rows, labels):
    found = got(spark, folder, "op7_quality")
    text = dict(rows)
    by = lambda i: (signed(spark_hash(("q", i), ("i", 7))), i)
    good, bad = (list(dict.fromkeys(text[i] for i in sorted((i for i, q, _ in labels if q == y and text.get(i) is not None), key=by))) for y in (1, 0))
    held = len(good) // 4
    target, raw = Counter(g for t in good[held:] for g in grams(t)), Counter(g for _, t in rows for g in grams(t))
    in_target, in_raw = (Counter(f for f, _ in c.elements()) for c in (target, raw))
    prior = quality.SMOOTH * 2**14

    def ratio(gram):
        share = raw[gram] / in_raw[gram[0]] + 1e-9
        return math.log((target[gram] + prior * share) / (in_target[gram[0]] + prior)) - math.log(share)

    weight = lambda t: sum(map(ratio, grams(t)))
    for i, t in rows:
        assert found[i].log_weight == pytest.approx(weight(t), abs=1e-6), i
    kept, lost = [weight(t) for t in good[:held]], [weight(t) for t in bad]
    values = sorted({*kept, *lost})
    cuts = [values[0] - 1, *((a + b) / 2 for a, b in zip(values, values[1:], strict=False))]
    cost = [4 * sum(w < c for w in kept) / len(kept) + sum(w >= c for w in lost) / len(lost) for c in cuts]
    best = [c for c, x in zip(cuts, cost, strict=True) if x <= min(cost) + 1e-12]
    k = sum(weight(t) >= best[len(best) // 2] for _, t in rows)
    # the noise of a row comes from its id and the seed 1
    noise = lambda i: -math.log(-math.log((signed(spark_hash(("q", i), ("i", 1))) % 2**52 + 0.5) / 2**52))
    drawn = sorted(rows, key=lambda r: -(weight(r[1]) + noise(r[0])))[:k]
    assert 0 < k < len(rows) and {i for i, r in found.items() if r.selected} == {i for i, _ in drawn}


def test_op9(spark, folder, rows):
    import zstandard

    found = got(spark, folder, "op9_toxicity")
    model = toxicity.learn(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))

    def size(window, *content):
        params = zstandard.ZstdCompressionParameters.from_level(3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(b"".join(content), dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress(window))

    for i, t in rows:
        data = (t or "").lower().encode()
        spans = [m.span() for m in re.finditer(rb"\S+", data)]
        starts = [k for k in range(0, len(spans), 3) if k == 0 or k + 3 < len(spans)]
        windows = [b" " + data[spans[k][0] : spans[k : k + 6][-1][1]] + b" " for k in starts]
        margins = sorted((size(w, model.ordinary) - size(w, model.ordinary, model.toxic) for w in windows), reverse=True)
        values = [1.0, *(margins + [0, 0, 0])[:3], math.log(1 + sum(m >= 4 for m in margins)), math.log(1 + len(margins))]
        score = 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(values, model.weights, strict=True))))))
        r = found[i]
        assert r.score == pytest.approx(score, abs=1e-9), i
        assert (r.held_out, r.predicted) == (zlib.crc32(str(i).encode()) % 4 == 2, int(r.score >= 0.3))
    assert set(found) == {i for i, _ in rows}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, folder, tmp_path, name):
    for table, schema in (("conversations", "conv_id bigint, turn bigint, role string, text string"), ("embeddings", "vec_id bigint, embedding array<float>, label int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    # the conversation that op4 adds itself is left
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == (name == "op4_chat_format")
