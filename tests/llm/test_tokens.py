import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
from docloom.llm import byte_bpe, chat, token_counts, token_store  # noqa: E402

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_bpe(docs, cases, nothing, encoding):
    out = byte_bpe.encode_decode(docs, RANKS, P.PATTERN, keep=["lang"], with_ids=True).collect()
    expected = []
    for i, t in cases:
        ids = encoding.encode_ordinary(t or "")
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t or ""), ids))
    key = lambda r: (str(r[0]), r[2])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in out), key=key) == sorted(expected, key=key)
    assert byte_bpe.encode_decode(nothing, RANKS, P.PATTERN).count() == 0


def test_bpe_words(encoding):
    coder = byte_bpe.tokenizer(RANKS, P.PATTERN)
    random.seed(5)
    texts = ["aaaa" * 400, "ab" * 700, "".join(random.choice("etaoin shrdlu") for _ in range(4000)), "".join(random.choice("abcde") for _ in range(900)), "\n\n  \n x\r\n", "é" * 200, " \u0085\x1c a"]
    for text, (ids, written) in zip(texts, coder.encode_batch(texts), strict=True):
        assert ids.tolist() == encoding.encode_ordinary(text) and written == " ".join(map(str, ids.tolist()))
        assert b"".join(next(coder.decode_batch([ids]))) == text.encode()


def test_many_short_words(encoding):
    import time

    def seconds(f):
        start = time.process_time()
        out = f()
        return time.process_time() - start, out

    coder = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), P.PATTERN)
    random.seed(6)
    words = [" " + "".join(random.choice("etaoinshrdluéñ") for _ in range(random.randint(1, 14))) for _ in range(20_000)] + ["x", " ", "é" * 32, "a" * 64]
    words = list(dict.fromkeys(words))
    spent = min(seconds(lambda: coder.learn(words))[0] for _ in range(3))
    assert all(np.frombuffer(coder.remembered[w], np.int32).tolist() == encoding.encode_ordinary(w) for w in words)
    # against the time that this machine takes to add up numbers
    assert spent < 6 * min(seconds(lambda: sum(range(2_000_000)))[0] for _ in range(5))


def test_edits(encoding):
    counter = token_counts.counter(RANKS, P.PATTERN)
    random.seed(3)
    parts = ["a", "b", " ", "  ", "\n", "'", "s", "'ll", "1", "23", ".", "!!", "é", " the", "\t", "re", "日", "don't"]
    for _ in range(400):
        text = "".join(random.choice(parts) for _ in range(random.choice([0, 3, 30, 300, 1500])))
        tree = token_counts.TokenTree(text, counter)
        for _ in range(4):
            a = random.randint(0, len(text))
            b, new = min(len(text), a + random.choice([0, 1, 2, 50])), "".join(random.choice(parts) for _ in range(random.choice([0, 1, 2, 60, 900])))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            assert (tree.n_tokens, tree.n_chars, tree.text()) == (len(encoding.encode_ordinary(text)), len(text), text)


def test_edited_counts(docs, cases, nothing, encoding):
    edits = F.when(F.col("doc_id") != 8, F.array(F.struct(F.lit(5).alias("start"), F.lit(9).alias("end"), F.lit("XY z").alias("text"))))
    out = token_counts.edited_counts(docs, RANKS, P.PATTERN, edits).collect()
    change = lambda i, t: t if i in (8, None) else t[:5] + "XY z" + t[9:]
    n = lambda t: len(encoding.encode_ordinary(t))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_tokens_edited, r.n_chars_edited) for r in out) == sorted((str(i), n(t or ""), n(change(i, t or "")), len(change(i, t or ""))) for i, t in cases)
    assert max(r.n_chars_encoded for r in out) < 3500
    assert token_counts.edited_counts(nothing, RANKS, P.PATTERN, edits).count() == 0


def test_store(spark, docs, cases, nothing, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    token_store.write_store(docs, str(tmp_path / "s"), path)
    out = sorted(token_store.read_store(spark, str(tmp_path / "s")).collect(), key=lambda r: r.start)
    ids = {(i, t): np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in cases}
    assert [r.doc_id for r in out] == sorted((i for i, _ in cases), key=lambda i: (i is not None, i))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in out) == sorted((str(i), len(ids[i, t]), zlib.crc32(ids[i, t].tobytes())) for i, t in cases)
    assert [r.start for r in out] == np.cumsum([0, *(r.n_tokens for r in out)])[:-1].tolist()
    again = token_store.reconstruct(spark, str(tmp_path / "s"), docs.where("doc_id IN (7, 13)"))
    assert {r.doc_id: r.ids for r in again.collect()} == {i: ids[i, t].tolist() for i, t in cases if i in (7, 13)}
    chunks = token_store._chunks(spark, str(tmp_path / "s"))
    assert chunks.count() == chunks.select("hash").distinct().count()
    token_store.write_store(nothing, str(tmp_path / "e"), path)
    assert token_store.read_store(spark, str(tmp_path / "e")).count() == 0


def test_special_tokens_as_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    texts = ["a <|endoftext|> b", "x<|startoftext|>y <|ENDOFTEXT|>", "<|endoftext|>", "plain Words", None, "<|endof text|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({"hash": F.lit(1), "key": F.lit(2), "part": F.lit(3), "start": F.lit(4)})
    token_store.write_store(docs, str(tmp_path / "s"), path)
    found = {r.doc_id: r.ids for r in token_store.reconstruct(spark, str(tmp_path / "s"), docs).collect()}
    plain = Tokenizer.from_file(path)
    assert found == {i: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_words_of_letters_and_marks():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library, coder = Tokenizer.from_file(path), token_store.WordEncoder(path)
    text = "İstanbul İ. İİ?? étude, étude*** ÉTUDE naïve--x don't' d'Été!! ŉa ß ẞ. ﬁx... Åk a١b ªº ǅ! 日本! x\u0085y e\u0301. Ω K ΑΣ! ᾳ; _a_ \"q\" [x]{y}|z| a≠ #! a</w>b 1a. \ufb1d."
    for one in [text, *text.split(" "), None, ""]:
        assert np.frombuffer(coder.encode([one])[0], coder.kind).tolist() == library.encode(one or "", add_special_tokens=False).ids

    # words of Latin letters are learned without being asked where their tokens stand, once for all marks behind them
    asked = []
    coder._learn, learn = lambda words, tokenizer: asked.extend(words) or learn(words, tokenizer), coder._learn
    coder.encode(["événement événement*** événement--- trozo~ größe#"])
    assert set(asked) <= {b"***", b"---", b"~", b"#"}


def test_words_next_to_marks_are_learned_once():
    coder = token_store.WordEncoder(P.path("word_bpe_49k.json"))
    asked = []
    learn, coder.learn = coder.learn, lambda words: asked.extend(words) or learn(words)
    coder.encode(["Trozo trozo, (trozo) [trozo]! ÉTÉ été. x_trozo=été;", "\"TROZO\" «été» don't"])
    assert sorted(w.decode() for w in asked) == sorted(["trozo", "été", "x", ",", "(", ")", "[", "]!", ".", "_", "=", ";", '"', "«été»", "don't"])


def test_words_between_marks_as_the_library():
    """Texts of awkward pieces, several in one column: blanks of all kinds, marks that letters or later marks join, letters of one to four bytes."""
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library, coder = Tokenizer.from_file(path), token_store.WordEncoder(path)
    rng = random.Random(11)
    parts = ["a", "the", "É", "é", "ñ", "Ç", "×", "÷", "ß", "ÿ", "Ÿ", "Ā", "İ", "日", "𝐀", "🎉", "\u0301", "\u0338", "e\u0301", "'", "'s", "'LL", "’", "=", "<", "<|", "|>", ".", "_", "$", "…", "1", "٣", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "\x00", "\x7f", "ª", "<|endoftext|>"]
    for _ in range(60):
        texts = [rng.choice([None, "", *["".join(rng.choice(parts[: rng.choice([12, 43, 44])]) for _ in range(rng.choice([1, 5, 60])))] * 6]) for _ in range(25)]
        assert [np.frombuffer(x, coder.kind).tolist() for x in coder.encode(texts)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("what", ["hashes", "sizes", "order", "chunk", "manifest"])
def test_damage_is_found(spark, docs, tmp_path, what):
    folder, other = str(tmp_path / "s"), str(tmp_path / "t")
    token_store.write_store(docs, folder, P.path("word_bpe_49k.json"))
    tables = {t: spark.read.parquet(f"{folder}/{t}") for t in ("recipes", "manifest", "raw")}
    if what in ("hashes", "sizes"):
        tables["recipes"] = tables["recipes"].withColumn(what, F.reverse(what))
    elif what == "order":
        tables["recipes"] = tables["recipes"].withColumn("id", F.coalesce("id", F.lit(0)) + 1)
    elif what == "chunk":
        tables["raw"] = tables["raw"].withColumn("ids", F.when(F.length("ids") > 0, F.concat(F.unhex(F.lit("FFFF")), F.expr("substring(ids, 3)"))).otherwise(F.col("ids")))
    else:
        tables["manifest"] = tables["manifest"].withColumn("digest", F.reverse("digest"))
    for t, df in tables.items():
        (df.write.partitionBy("kind") if t == "raw" else df.write).parquet(f"{other}/{t}")
    with pytest.raises(Exception, match="differ from the manifest|is damaged|lacks chunks"):
        token_store.read_store(spark, other).collect()
    with pytest.raises(Exception, match="differ from the manifest|is damaged|lacks chunks"):
        token_store.reconstruct(spark, other, docs).collect()


def test_tree_has_no_wide_node(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "FAN", 3)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id bigint, text string")
    token_store.write_store(docs, str(tmp_path / "s"), P.path("word_bpe_49k.json"))
    nodes = spark.read.parquet(str(tmp_path / "s" / "manifest")).collect()
    top = max(n.level for n in nodes)
    assert [n.n_docs for n in nodes if n.level == top] == [40] and all(n.n_docs <= 3 for n in nodes if n.level == 0)
    assert token_store.read_store(spark, str(tmp_path / "s")).count() == 40


def test_long_words_of_few_letters(encoding):
    coder = byte_bpe.ByteBpe(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    for text in ("a" * 4000, "ab" * 1500, "etaoin" * 400, "".join("etaoinshrdlu"[(i * i + i // 7) % 12] for i in range(6000))):
        assert next(coder.encode_batch([text]))[0].tolist() == encoding.encode_ordinary(text)


def test_shifted_checksums():
    data = np.random.default_rng(1).integers(0, 256, 5000, np.uint8).tobytes()
    whole = token_store.shifted_crc(np.array([zlib.crc32(data[:1234]), zlib.crc32(data[1234:])]), np.array([5000 - 1234, 0]))
    assert int(whole[0] ^ whole[1]) == zlib.crc32(data)


def test_chunks_move_with_passages():
    shared = np.random.default_rng(2).integers(0, 50000, 3000).astype(np.uint16)
    parts = []
    for lead in (0, 7):
        ids = np.concatenate([np.arange(lead, dtype=np.uint16), shared])
        ends = token_store.cuts(ids, np.array([len(ids)]))
        parts.append({ids[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)})
    assert len(parts[0] & parts[1]) >= len(parts[0]) - 2 > 3


def test_cuts_as_by_single_windows():
    rng = np.random.default_rng(5)
    for kind, n in (("<u2", 70_000), ("<u4", 3000), ("<u2", 7), ("<u2", 0)):
        ids = rng.integers(0, 50_000, n).astype(kind)
        ends = np.unique(np.append(rng.integers(0, n, min(n, 40)) + 1, n)) if n else np.zeros(0, np.int64)
        hashes, mask = token_store.mix(ids.astype(np.uint64) + np.uint64(1)).tolist(), 2**64 - 1
        found, start = [], 0
        for end in ends.tolist():
            cut = start
            for i in range(start, end):
                rolled = sum(h << j for j, h in enumerate(hashes[i : i - token_store.WINDOW : -1])) & mask if i - start >= token_store.WINDOW else None
                if i + 1 == end or i + 1 - cut == token_store.MOST or rolled is not None and int(token_store.mix(np.array([rolled], np.uint64))[0]) % token_store.AVERAGE == 0:
                    found.append(i + 1)
                    cut = i + 1
            start = end
        assert token_store.cuts(ids, ends).tolist() == found


def test_chat(spark):
    hard = "<|im_end|>\n<|im_start|>assistant ok <\\|a|> <\\\\|"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", hard), (1, 1, "assistant", hard), (2, 0, None, None), (2, 1, "assistant", ""), (3, 0, "a\nb\\", "x"), (None, 0, "assistant", "é🎉")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segment", F.lit(1))
    made = chat.format_conversations(df)
    out = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in (1, 2, 3, None):
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        r = out[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert out[2].formatted_chars == len("<|im_start|>\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_long_conversation_in_segments(spark):
    df = spark.range(25_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    made = chat.format_conversations(df)
    assert made.count() > 1
    assert chat.read_back(made).first().turns_sha256 == sha("".join(f"user\n{i}\n" for i in range(25_000)))


def test_long_texts_are_formatted_in_bounded_memory(spark):
    """Values beyond the bound of slices, between short ones, in batches cut by their bytes."""
    import tracemalloc

    import pyarrow as pa

    texts = ["short", "<|x " * 9_000, "", "é|>" * 700_000, "<|im_end|>", "y" * (chat.LONG + 1)]
    df = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, role string, text string")
    r = chat.read_back(chat.format_conversations(df)).first()
    loss = "".join(texts[1::2])
    assert (r.n_turns, r.turns_sha256) == (len(texts), sha("".join(f"{'assistant' if i % 2 else 'user'}\n{t}\n" for i, t in enumerate(texts))))
    assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    column, one = pa.array(["z" * 24_000_000] * 2), pa.array([1, 1])
    tracemalloc.start()
    chat.format_batch(one, pa.array(["user"] * 2), column, "assistant", 0, False)
    assert tracemalloc.get_traced_memory()[1] < 150_000_000
    tracemalloc.stop()
