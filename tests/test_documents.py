import json
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions.columns import question_id
from docloom.functions.html import html_to_text, split_html, strip_attributes
from docloom.functions.ports import HashingEmbedder, TemplateChat, Throttle, render
from docloom.functions.splitters import recursive_split, sentence_split, splitter, strategy
from docloom.functions.tokens import count_message_tokens, token_batches
from docloom.errors import ModelCallError
from docloom.operators import chunk, cluster, embed, semantic, transform, translate


@settings(max_examples=60, deadline=None)
@given(st.text("ab \n.", max_size=400), st.integers(5, 40), st.integers(0, 4))
def test_chunks_are_bounded_and_lose_nothing(text, size, overlap):
    chunks = recursive_split(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    left = iter("".join(text.split()))
    assert all(len(s) <= size for s in sentence_split(text, size, overlap))
    if overlap == 0:
        assert "".join("".join(chunks).split()) == "".join(left)


def test_strategies():
    assert strategy("unknown").name == "default" and strategy("NLTK").chunk_size == 1000
    with pytest.raises(ValueError):
        splitter(strategy("default").__class__("x", "other"))
    assert sentence_split("One two. Three four! Five?", 12, 0) == ["One two.", "Three four!", "Five?"]


def test_chunk_documents(spark):
    df = spark.createDataFrame([(1, "word " * 1000, "x"), (2, "", "y"), (3, None, "z")], "id bigint, content string, extra string")
    out = chunk.chunk_documents(df).orderBy("chunk_id").collect()
    assert {r.id for r in out} == {1} and out[0].chunk_id == "1-1" and all(len(r.chunk) <= 2000 for r in out)
    with pytest.raises(ValueError):
        chunk.chunk_documents(spark.createDataFrame([(1, 2)], "id bigint, content bigint"))


def test_html():
    assert html_to_text("<h1>T</h1><p>a <b>b</b></p><script>x</script><ul><li>c</li></ul>") == "# T\n\na b\n\n* c"
    assert strip_attributes('<p class="x"><a href="u" id="i">l</a><img class="y"><img src="s"></p>') == '<p><a href="u" id="i">l</a><img><img src="s"></p>'
    table = "<table><thead><tr><th>H</th></tr></thead><tbody>" + "".join(f"<tr><td>{i:040}</td></tr>" for i in range(30)) + "</tbody></table>"
    parts = split_html(f"<h2>A</h2><p>{'x ' * 60}</p><h2>B</h2>{table}", 400, 20)
    assert all(len(p) <= 400 for p in parts) and sum("<th>H</th>" in p for p in parts) > 2
    assert split_html("<p>short</p>", 100, 0) == ["<p>short</p>"]


@pytest.mark.parametrize("seed", range(12))
def test_split_tables_hold_each_word_once(seed):
    r, n = random.Random(seed), iter(range(10**6))
    say = lambda k: " ".join(f"w{next(n)}" for _ in range(k))
    html = ""
    for _ in range(r.randint(1, 3)):
        rows = [f"<tr><td>{say(r.randint(1, 9))}</td></tr>" + (f"<caption>{say(3)}</caption>" if r.random() < 0.2 else "") for _ in range(r.randint(2, 12))]
        html += f"<h2>{say(2)}</h2><p>{say(r.randint(3, 40))}</p><table><thead><tr><th>HEAD</th></tr></thead><tbody>{''.join(rows)}</tbody></table>tail {say(2)}<p>{say(r.randint(3, 40))}</p>"
    words = Counter(w for p in split_html(html, 300, 0) for w in re.findall(r"w\d+", p))
    assert words == Counter(re.findall(r"w\d+", html))


def test_transform(spark):
    records = spark.createDataFrame([(json.dumps([{"id": 1, "name": "A", "metadata": {"classification": "PUBLIC", "tags": ["x"], "created": "2024-01-02T03:04:05Z"}, "content": [{"title": "h", "data": ["<p>hi</p>", "there"]}]}, {"id": 2}]),), ("no json",), (json.dumps({"name": "B", "content": "text"}),)], "value string")
    made = transform.map_records(records, "value")
    assert made.where("error IS NOT NULL").count() == 2
    out = {r.title: r for r in transform.curate(made, ["classification", "tags", "created"]).collect()}
    assert out["A"].content == "\n# h\nhi\nthere" and out["A"].content_type == "PUBLIC" and out["A"].metadata_tags == ["x"]
    assert out["B"].content_type == "PRIVATE" and out["B"].metadata_expiry.year in (2260, 2261) and out["B"].id
    assert "classification" in transform.metadata_keys(made)


def test_tokens():
    count = lambda t: len((t or "").split())
    assert list(token_batches(["a b c", "d e", "f"], 5, count)) == [["a b c", "d e"], ["f"]]
    assert list(token_batches(["a b c d", "e"], 2, count)) == [["a b c d"], ["e"]]
    assert count_message_tokens([{"role": "user", "content": "a b"}, {"role": "x", "content": "c", "name": "n"}], count) == 2 + 4 + 3 + 3 + 3


def test_embeddings(spark):
    class Broken(HashingEmbedder):
        def embed(self, texts):
            return []

    df = spark.createDataFrame([(1, "a b", None), (2, "a b", [1.0, 0.0]), (3, "c", [0.0, 0.0]), (4, None, None)], "id int, text string, embedding array<float>")
    out = {r.id: r.embedding for r in embed.create_embeddings(df, "text", lambda: HashingEmbedder(2)).collect()}
    assert out[2] == [1.0, 0.0] and any(out[3]) and out[1] is not None and out[4] is None
    assert {tuple(r.embedding) for r in embed.create_embeddings(df.where("id = 1"), "text", lambda: Broken(2)).collect()} == {(0.0, 0.0)}
    with pytest.raises(ValueError):
        HashingEmbedder(5000)


def test_clusters(spark):
    points = [(1, [0.0, 0.0]), (2, [0.0, 0.2]), (3, [0.0, 0.4]), (4, [5.0, 5.0]), (5, [-0.05, -0.1]), (6, None)]
    df = spark.createDataFrame(points, "id bigint, embedding array<float>")
    assert {(r.a, r.b) for r in cluster.neighbours(df, 0.25).collect()} == {(1, 2), (2, 3), (1, 5)}
    labels = {r.id: r.label for r in cluster.density_labels(df, 0.25).collect()}
    assert labels == {1: 1, 2: 1, 3: 1, 5: 1, 4: None, 6: None}
    dense = {r.id: r.label for r in cluster.density_labels(df, 0.25, 3).collect()}
    assert dense == {1: 1, 2: 1, 3: 1, 5: 1, 4: None, 6: None}
    two = spark.createDataFrame([(1, 1, None), (2, 1, 5), (3, None, 5), (4, None, None)], "id bigint, a bigint, b bigint")
    got = cluster.cluster_uuid(cluster.across_definitions(two, ["a", "b"]))
    assert {r.id: r.cluster_id for r in got.collect()} == {1: "1", 2: "1", 3: "1", 4: "-1"}
    assert [d.count() for d in cluster.split_clustered(two, ["a", "b"])] == [3, 1]


def test_merge_results(spark):
    q = spark.createDataFrame([("c", "q1", "s1", "Q1", "A1"), ("c", "q2", "s2", "Q2", "A2"), ("d", "q3", "s3", "Q3", "A3"), ("e", "q4", "s4", "Q4", "A4")], "cluster_id string, question_id string, source_id string, question string, answer string")
    reply = json.dumps({"items": [{"question": "Q", "answer": "A", "source_ids": ["q1", "q2", "zz"], "sufficient_ids": ["q2"]}]})
    out = semantic.expand_merge_results(q, spark.createDataFrame([("c", reply), ("d", None), ("e", "bad")], "cluster_id string, response string"))
    merged = out.select(question_id(F.lit("Q"), F.lit("A"))).first()[0]
    assert {(r.question_id, r.source_id, r.is_sufficient) for r in out.collect()} == {(merged, "s1", False), (merged, "s2", True), ("q3", "s3", False)}


def test_questions(spark):
    articles = spark.createDataFrame([("a", "T", "text", "en"), ("b", "U", "fail", "en")], "id string, title string, content string, metadata_language string")
    reply = lambda p: None if "fail" in p else json.dumps({"items": [{"question": "Q?", "answer": "A."}]})
    made, failed = semantic.create_questions(articles, lambda: TemplateChat(reply))
    assert [r.source_id for r in made.collect()] == ["a"] and [r.id for r in failed.collect()] == ["b"]
    rated = semantic.validate(made, articles, lambda: TemplateChat(lambda p: json.dumps({"rating": "consistent"})))
    assert semantic.consistent_only(rated).count() == 1
    assert semantic.validate(made, articles, lambda: TemplateChat(lambda p: json.dumps({"rating": "great"}))).count() == 0
    acted = semantic.question_actions(made.withColumn("action", F.lit("I")), made)
    assert acted.first().action == "N"
    assert "title" in semantic.with_articles(made, articles).columns


def test_recursive_merge(spark):
    rows = [("r", f"q{i}", f"s{i}", "same words here" if i < 3 else "other things entirely", f"A{i}") for i in range(4)]
    q = spark.createDataFrame(rows, "cluster_id string, question_id string, source_id string, question string, answer string")

    def reply(prompt):
        found = json.loads(prompt[prompt.index("\n") + 1 :])
        return json.dumps({"items": [{"question": "merged", "answer": "m", "source_ids": [f["question_id"] for f in found]}]})

    out = semantic.merge_recursively(q, lambda: HashingEmbedder(16), lambda: TemplateChat(reply), 10, start=0.05, step=0.1, end=0.15)
    assert {(r.question, r.source_id) for r in out.collect()} == {("merged", "s0"), ("merged", "s1"), ("merged", "s2"), ("other things entirely", "s3")}


def test_translate(spark):
    df = spark.createDataFrame([(1, "hallo", "de"), (2, "hi", "en"), (3, "x", None), (4, "fail", "fr")], "id int, c string, lang string")
    out = {r.id: r for r in translate.translate(df, ["c"], "lang", "en", lambda: TemplateChat(lambda p: None if "fail" in p else p.rsplit("\n", 1)[1].upper())).collect()}
    assert set(out) == {1, 2, 4} and out[1].translated_c == "HALLO" and out[2].translated_c == "hi" and out[4].translated_c == "fail"
    assert out[1].original_c == "hallo" and out[1].c_language == "en"


def test_metadata(spark):
    df = spark.createDataFrame([("t", "x", "en")], "title string, translated_chunk string, chunk_language string")
    assert embed.generate_metadata(df, ["keywords"], lambda: TemplateChat(lambda p: None)).first().metadata_keywords == ""
    assert embed.generate_metadata(df, ["keywords"], TemplateChat, enabled=False).columns == df.columns
    assert render("a {{ x }} {{ y }}", {"x": 1}) == "a 1 "


def test_throttle():
    now, slept = [0.0], []
    limit = Throttle(requests_per_minute=60, attempts=3, clock=lambda: now[0], sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    assert limit.call(lambda: 1) == 1

    def refuse():
        raise ModelCallError("busy")

    assert limit.call(refuse) is None and slept[0] == 1.0 and slept[1] == 60.0


def test_sentences_keep_what_closes_them():
    from docloom.functions.splitters import sentence_split, sentences

    text = 'He said "no." (Then he left.) She\n\nstayed [there!]  Why?'
    assert sentences(text) == ['He said "no."', "(Then he left.)", "She", "stayed [there!]", "Why?"]
    assert "".join("".join(sentence_split(text, 20, 0)).split()) == "".join(text.split())


def test_head_values(spark):
    from docloom.operators.aggregate import head_values

    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, None), (None, 3, "n")], "k int, at int, v string")
    assert {tuple(r) for r in head_values(df, "k", ["v"], ["at"]).collect()} == {(1, "a"), (2, None), (None, "n")}
    assert head_values(df.limit(0), "k", ["v"], ["at"]).count() == 0
