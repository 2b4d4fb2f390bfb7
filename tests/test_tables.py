import json
import time
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from docloom.errors import ConfigError, RuleError, SinkError, SourceNotFound
from docloom.errors import ConfigError, ModelCallError
from docloom.functions.ports import Throttle
from docloom.operators import aggregate, delta, embed, joins, project, publish, quality_checks, sets
from docloom.plans.config import deployment, overlay, step_settings
from docloom.plans.hooks import Flags, Hooks
from docloom.plans.pipeline import Pipeline, Step, expand_steps, from_config
from docloom.sources.readers import file_kind, latest, read_records, read_table
from docloom.sources.sinks import SourceSpec, embedding_name, move_to_processed, target_path, write_table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "Sean"), (2, "John"), (3, "Jane"), (None, "Nobody")], "id int, name string")


@pytest.fixture(scope="module")
def births(spark):
    return spark.createDataFrame([(1, "1988-12-22", "x"), (2, "1990-01-15", "y"), (None, "1900-01-01", "z")], "id int, dob string, name string")


@pytest.mark.parametrize(("how", "n"), [("left", 4), ("inner", 3), ("outer", 4), ("right", 3)])
def test_merge(people, births, how, n):
    out = joins.merge(people, births, how)
    assert out.columns == ["id", "name_x", "dob", "name_y"]
    assert out.count() == n
    assert (None, "Nobody", "1900-01-01", "z") in rows(out)


def test_merge_kinds(people, births):
    assert joins.merge(people, births, "cross").count() == 12
    assert joins.merge(people, births.withColumnRenamed("id", "key"), "inner", right_on="key").columns == ["id", "name_x", "key", "dob", "name_y"]
    assert joins.merge(people, births, "left", left_columns=["id"], right_columns=["id", "dob"]).columns == ["id", "dob"]
    with pytest.raises(RuleError):
        joins.merge(people, births, "sideways")


def test_concatenate(people, births):
    out = sets.concatenate(joins.merge(people, births.drop("name")), births)
    assert out.columns == ["id", "name", "dob"] and out.count() == 7


def test_distinct_lists(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", "x"), (1, "b", None), (None, "c", "y"), (2, "d", "z")], "k int, v string, w string")
    out = {r.k: (sorted(r.v), r.w) for r in aggregate.distinct_lists(df, ["k"]).collect()}
    assert out == {1: (["a", "b"], ["x", None]), 2: (["d"], ["z"])} or out[1][0] == ["a", "b"] and set(out[1][1]) == {None, "x"}


def test_projection(spark):
    df = spark.createDataFrame([(1, "T", None), (2, "U", "d")], "id int, title string, metadata_description string")
    assert [r[0] for r in project.text_to_embed(df, ["title", "metadata_description"]).orderBy("id").select("text_to_embed").collect()] == ["**Title**: T", "**Title**: U\n**Description**: d"]
    with pytest.raises(ExceptionGroup):
        project.text_to_embed(df, ["nothing"])
    assert project.columns_to_embed(["chunk", "metadata_tags"]) == ["chunk", "metadata_tags", "title", "metadata_description"]
    assert project.keep_metadata(df, ["id"]).columns == ["id", "metadata_description"]
    assert project.refactor(df, {"a": "id", "b": "gone"}).first().b is None


SCHEMA = "id string, title string, content string, metadata_expiry timestamp, md5 string, metadata_md5 string, action string, metadata_is_modified string"


def load(spark, *items):
    far = datetime(2100, 1, 1)
    return spark.createDataFrame([(i, "t", "c", far, "m", "n", a, f) for i, a, f in items], SCHEMA)


@pytest.mark.parametrize(("load_type", "options", "todo", "carried"), [
    ("FULL", {}, {"2": "U", "3": "N", "5": "I"}, None),
    ("INCREMENTAL", {}, {"2": "U", "5": "I"}, {"1": "N", "3": "N", "4": "N"}),
    ("DELTA", {}, {"2": "U", "5": "I"}, {"3": "N"}),
    ("DELTA", {"modified": "metadata"}, {"5": "I"}, {"2": "I", "3": "N"}),
    ("DELTA", {"force": True}, {"2": "U", "5": "I", "3": "U"}, None),
])
def test_prepare(spark, load_type, options, todo, carried):
    current = load(spark, ("2", "U", "N"), ("3", "N", "N"), ("5", "I", "I"))
    previous = load(spark, *((i, "I", "N") for i in "1234"))
    got, kept = delta.prepare(current, load_type, previous, **options)
    assert {r.id: r.action for r in got.collect()} == todo
    assert (None if kept is None else {r.id: r.action for r in kept.collect()}) == carried


def test_prepare_without_previous(spark):
    got, kept = delta.prepare(load(spark, ("2", "U", "N"), ("3", "N", "N"), ("4", "D", "N")), "INCREMENTAL")
    assert {r.id: r.action for r in got.collect()} == {"2": "U", "3": "U"} and kept is None


def test_deleted_rows_are_not_carried(spark):
    previous = load(spark, ("1", "D", "N"), ("2", "I", "N"), ("3", "U", "N")).withColumn("metadata_expiry", F.when(F.col("id") == "3", F.to_timestamp(F.lit("2000-01-01"))))
    for load_type, current in (("INCREMENTAL", load(spark, ("9", "I", "N"))), ("DELTA", load(spark, ("1", "N", "N"), ("2", "N", "N"), ("3", "N", "N")))):
        assert [r.id for r in delta.prepare(current, load_type, previous)[1].collect()] == ["2"]
    forced, none = delta.prepare(load(spark, ("2", "N", "N")), "DELTA", previous, force=True, modified="metadata")
    assert [(r.id, r.action) for r in forced.collect()] == [("2", "U")] and none is None
    first, none = delta.prepare(load(spark, ("2", "N", "N")), "DELTA", None, modified="metadata")
    assert [r.action for r in first.collect()] == ["U"] and none is None
    assert delta.prepare(load(spark, ("7", "I", "N")), "INCREMENTAL", previous.drop("action"))[1].count() == 2


def test_expired_rows_are_not_carried(spark):
    previous = load(spark, ("1", "I", "N")).withColumn("metadata_expiry", F.to_timestamp(F.lit("2000-01-01")))
    kept = delta.prepare(load(spark, ("2", "I", "N")), "INCREMENTAL", previous, expiry=delta.Expiry(now="2020-01-01"))[1]
    assert kept.count() == 0


def test_earlier_rows_of_an_id_are_carried_once(spark):
    now = spark.createDataFrame([("1", "U", "N"), ("2", "U", "U"), ("3", "N", "N")], "id string, action string, content_is_modified string")
    before = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c"), ("3", "e"), ("3", "d")], "id string, text string").withColumn("action", F.lit("I"))
    todo, carried = delta.prepare(now, "DELTA", before, modified="content")
    assert [r.id for r in todo.collect()] == ["2"]
    assert sorted((r.id, r.text) for r in carried.collect()) == [("1", "a"), ("3", "d")]


def test_comparison(spark):
    df = spark.createDataFrame([("a", "a"), (None, "a"), ("a", None), ("a", "b"), (None, None)], "md5 string, md5_prev string")
    assert [r.action for r in delta.compare(df, [delta.Comparison("md5")]).collect()] == ["N", "D", "I", "U", "I"]


def test_merge_loads(spark):
    new = spark.createDataFrame([(1, "x")], "id int, a string")
    out = delta.merge_loads(new, spark.createDataFrame([(2, "y")], "id int, b string"))
    assert rows(out) == [(1, "x"), (2, None)]


def test_suites(spark):
    suite = {"schema": {"title": "string", "content": "string"}, "expectations": [{"expectation": quality_checks.TYPE}, {"expectation": quality_checks.UNIQUE, "kwargs": {"column": "title"}}, {"expectation": quality_checks.ROWS, "kwargs": {"min_value": 5}}, {"expectation": quality_checks.NOT_NULL}]}
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y")], "title string, content string")
    out = {(r.expectation, r.column): r.failed for r in quality_checks.run_checks(df, quality_checks.expand(suite)).collect()}
    assert out == {(quality_checks.TYPE, "title"): 0, (quality_checks.TYPE, "content"): 0, (quality_checks.UNIQUE, "title"): 2, (quality_checks.ROWS, None): 1, (quality_checks.NOT_NULL, "title"): 0, (quality_checks.NOT_NULL, "content"): 1}
    with pytest.raises(KeyError):
        quality_checks.expand({"schema": {}})
    with pytest.raises(ConfigError):
        quality_checks.run_checks(df, [quality_checks.Check("unknown", "title")])


def test_registered_expectations(spark):
    df = spark.createDataFrame([(1, "ab", 0.0, [1]), (2, "abcd", -0.0, [1]), (3, None, 2.5, [2]), (None, "ab", None, None)], "id int, t string, x double, l array<int>")
    check = lambda *c, **k: quality_checks.Check(*c, k)
    made = quality_checks.run_checks(df, [
        check(quality_checks.UNIQUE, "id"), check(quality_checks.UNIQUE, "t"), check(quality_checks.UNIQUE, "x"), check(quality_checks.UNIQUE, "l"), check(quality_checks.UNIQUE, "gone"),
        check("expect_column_value_lengths_to_be_between", "t", max_value=3), check("expect_column_median_to_be_between", "id", min_value=2, max_value=2),
        check("expect_column_unique_value_count_to_be_between", "t", min_value=2, max_value=2), check("expect_column_max_to_be_between", "x", max_value=2), check(quality_checks.BETWEEN, "id", min_value=2),
    ])
    got = {(r.expectation.split("_column_")[1], r.column): r.failed for r in made.collect()}
    assert {c: n for (e, c), n in got.items() if e == "values_to_be_unique"} == {"id": 0, "t": 2, "x": 2, "l": 2, "gone": 1}
    assert [got[k] for k in (("value_lengths_to_be_between", "t"), ("median_to_be_between", "id"), ("unique_value_count_to_be_between", "t"), ("max_to_be_between", "x"), ("values_to_be_between", "id"))] == [1, 0, 0, 1, 1]
    nothing = quality_checks.run_checks(df.limit(0), [check("expect_column_min_to_be_between", "x", min_value=0), check(quality_checks.UNIQUE, "id")])
    assert sorted(r.failed for r in nothing.collect()) == [0, 1]
    with pytest.raises(ConfigError):
        quality_checks.run_checks(df, [check("expect_nothing", "id")])


def test_known_texts_are_not_embedded_again(spark):
    class Once:
        dimensions = 1

        def embed(self, texts):
            if {"old", "own"} & set(texts):
                raise ValueError("known texts are not asked for")
            return [[float(len(t))] for t in texts]

    class Wide(Once):
        def embed(self, texts):
            return [[1.0, 2.0] for _ in texts]

    df = spark.createDataFrame([(1, "old", None), (2, "new", None), (3, "old", [0.0]), (4, None, None), (5, "own", [7.0]), (6, "zero", None)], "id int, t string, embedding array<float>")
    earlier = spark.createDataFrame([("old", [5.0]), ("old", [4.0]), ("own", [1.0]), ("other", [2.0]), ("zero", [0.0]), ("new", None)], "t string, embedding array<float>")
    got = {r.id: r.embedding for r in embed.create_embeddings(df, "t", Once, previous=earlier).collect()}
    assert got == {1: [4.0], 2: [3.0], 3: [4.0], 4: None, 5: [7.0], 6: [4.0]}
    with pytest.raises(Exception, match="dimensions"):
        embed.create_embeddings(df, "t", Wide).collect()


def test_root_documents(spark):
    df = spark.createDataFrame([("a", "b", "A", "d", "http://a", "PUBLIC"), ("b", None, "B", "e", "http://b", "PUBLIC")], "id string, metadata_root_document_id string, title string, metadata_description string, metadata_url string, content_type string")
    out = joins.root_documents(df)
    assert out.count() == 2 and len(out.columns) == len(df.columns) + 4
    assert {r.id: r.metadata_root_document_title for r in out.collect()} == {"a": "B", "b": None}
    records = publish.chunk_records(out.withColumns({"chunk_id": F.col("id"), "content": F.lit("text"), "chunk": F.lit("t"), "embedding": F.array(F.lit(1.0))}), 3)
    got = {r.id: r for r in records.collect()}
    assert got["a"].metadata.root_source.title == "B" and got["b"].metadata.root_source is None and got["a"].document == "t"
    assert records.where(publish.valid_chunks(records)).count() == 2


def test_question_records(spark):
    df = spark.createDataFrame([("q", "Q", "A", [1.0], "s2", "T", "d", "http://x", "PUBLIC", False), ("q", "Q", "A", [1.0], "s1", "T", "d", "http://x", "PRIVATE", True)], "question_id string, question string, answer string, embedding array<float>, source_id string, title string, metadata_description string, metadata_url string, content_type string, is_sufficient boolean")
    got = publish.question_records(df).first()
    assert [r.article_id for r in got.metadata.references] == ["s1", "s2"] and got.metadata.sufficient_references == [0]


def test_question_of_many_references(spark):
    """Work grows with the references: one question with 40,000 took minutes when each place was looked up in a new list of all flags."""
    n = 40_000
    df = spark.range(n).select(F.lit("q").alias("question_id"), F.lit("Q").alias("question"), F.lit("A").alias("answer"), F.array(F.lit(1.0)).alias("embedding"), F.format_string("%06d", "id").alias("source_id"), F.lit("T").alias("title"), F.lit("d").alias("metadata_description"), F.lit("u").alias("metadata_url"), F.lit("PUBLIC").alias("content_type"), (F.col("id") % 3 == 0).alias("is_sufficient"))
    began = time.monotonic()
    got = publish.question_records(df).select("metadata.sufficient_references", F.size("metadata.references").alias("n")).first()
    assert got.n == n and got.sufficient_references == list(range(0, n, 3))
    assert time.monotonic() - began < 30


@pytest.mark.parametrize(("name", "kind"), [("a.yml", "yaml"), ("a.jsonl", "ndjson"), ("a.nd.json", "ndjson"), ("a.json", "json"), ("b/a.parquet", "parquet")])
def test_file_kinds(name, kind):
    assert file_kind(name) == kind
    with pytest.raises(NotImplementedError):
        file_kind("a.xlsx")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, ["x"], datetime(2024, 1, 2, tzinfo=UTC)), (2, None, None)], "id bigint, tags array<string>, at timestamp")
    for kind in ("parquet", "ndjson"):
        out = read_table(spark, write_table(df, str(tmp_path / f"t.{kind}")))
        assert {r.id: r.tags for r in out.collect()} == {1: ["x"], 2: []}
    assert "2024-01-02T00:00:00.000000" in read_table(spark, str(tmp_path / "t.ndjson")).where("id = 1").first().at
    assert write_table(df, str(tmp_path / "u.avro")).endswith((".parquet", ".avro"))
    with pytest.raises(SinkError):
        write_table(df.select("id", "id"), str(tmp_path / "w.parquet"))
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}]))
    (tmp_path / "b.ndjson").write_text('{"x": 1}\n\nbroken\n{"x": 2}\n')
    (tmp_path / "c.yml").write_text("- x: 1\n- x: 2\n")
    (tmp_path / "d.csv").write_text('x,y\n1,"{""a"": 1}"\n2,z\n')
    assert sorted(r.x for r in read_table(spark, str(tmp_path / "a.json")).collect()) == [1, 2]
    assert read_records(spark, str(tmp_path / "b.ndjson")).count() == 2
    assert sorted(r.x for r in read_table(spark, str(tmp_path / "c.yml")).collect()) == [1, 2]
    assert read_table(spark, str(tmp_path / "d.csv"), json_columns=["y"]).where("y IS NOT NULL").count() == 1
    for name in ("p_1.txt", "p_2.txt"):
        (tmp_path / name).write_text("x")
    assert latest(spark, str(tmp_path / "p_*.txt")).endswith("p_2.txt")
    assert SourceSpec(str(tmp_path), extension=".txt", prefix="p").resolve(spark).endswith("p_2.txt")
    assert move_to_processed(spark, str(tmp_path / "p_2.txt")).endswith("processed/p_2.txt")
    with pytest.raises(SourceNotFound):
        latest(spark, str(tmp_path / "none*"))


def test_paths():
    assert target_path("/data", "cleaned", "/in/a.nd.json", ".parquet", "de", "r1") == "/data/cleaned/de_a_r1.parquet"
    assert embedding_name("a_20240102030405.parquet", ".json", datetime(2025, 1, 1)) == "20240102030405_embedded_20250101000000.json"


def test_config():
    assert overlay({"a": {"b": 1, "c": 2}}, {"a": {"c": 3}}) == {"a": {"b": 1, "c": 3}}
    config = {"base": {"load_type": "DELTA"}, "clean": {"rules": [1]}, "pipeline": [{"name": "c2", "rules": [2]}]}
    assert step_settings(config, "clean").options["rules"] == [1]
    assert step_settings(config, "clean", "c2").options["rules"] == [2]
    models = [{"name": "d", "model": "m"}]
    assert deployment(models, "d")["model"] == "m" and deployment(models, "m")["name"] == "d"
    with pytest.raises(ConfigError):
        deployment(models, "d", "other")


def test_pipeline(spark, people):
    steps = [Step("narrow", "drop", ["both"], {"columns": ["name"]}), Step("both", "concatenate", ["input", "input"])]
    out = Pipeline(steps).run({"input": people})
    assert out["narrow"].columns == ["id"] and out["narrow"].count() == 8
    with pytest.raises(ConfigError):
        Pipeline([Step("a", "drop", ["b"]), Step("b", "drop", ["a"])]).ordered()
    plan = from_config(spark, {"pipeline": [{"name": "c", "type": "clean", "rules": [{"rule": "filter_by_match", "column": "name", "value": "^J"}]}]})
    assert plan.run({"input": people})["c"].count() == 2 and json.loads(plan.plan())[0]["inputs"] == ["input"]
    assert expand_steps(None) == ["transform", "clean", "chunk", "embed"] and len(expand_steps(["chunk"], True)) == 4


def test_flags():
    flags = Flags(translate=False)

    @flags.gated("translate", returns="text")
    def shout(text):
        return text.upper()

    assert shout("a") == "a"
    flags.translate = True
    assert shout("a") == "A"


def test_codes(spark, tmp_path):
    from docloom.enums import is_url, language_name, member_name
    from docloom.plans.hooks import Hooks
    from docloom.sources.readers import latest_table

    df = spark.createDataFrame([("DE", "https://a.b/c?d"), ("french", "gs://bucket/x"), ("zz", "http://"), (None, None), ("en", "file:///x")], "lang string, url string")
    assert [r[0] for r in df.select(language_name(df.lang)).collect()] == ["German", "French", None, None, "English"]
    assert [r[0] for r in df.select(is_url(df.url)).collect()] == [True, True, False, False, True]
    assert [r[0] for r in df.select(is_url(df.url, "http")).collect()] == [True, False, False, False, False]
    assert member_name("Bolivia (Plurinational State of)") == "Bolivia"
    (tmp_path / "plug.py").write_text("def pre_chunk(df):\n    return df.limit(1)\n")
    hooks = Hooks()
    assert hooks.load(str(tmp_path / "plug.py")) == ["pre_chunk"] and hooks.apply("pre_chunk", df).count() == 1
    assert latest_table(spark, str(tmp_path / "none*.parquet")) is None
    df.write.parquet(str(tmp_path / "t_1.parquet"))
    assert latest_table(spark, str(tmp_path / "t_*.parquet")).count() == 5


def test_default_pipeline_runs_from_records_to_vectors(spark):
    records = spark.createDataFrame([('{"name": "A", "content": [{"content_type": "text", "name": "x", "content": "one two three"}]}',), ("broken",)], "value string")
    hooks = Hooks()
    seen = []
    for name in ("post_transform", "documents_clean", "pre_chunk", "post_chunk", "pre_embed", "post_embed"):
        hooks.register(name, lambda df, *a, name=name, **k: seen.append(name))
    out = from_config(spark, {}, hooks).run({"input": records})
    rows = out["embed"].collect()
    assert seen == ["post_transform", "documents_clean", "pre_chunk", "post_chunk", "pre_embed", "post_embed"]
    assert all(any(r.embedding) and r.chunk for r in rows) and len(out["transform"].collect()) == 1
    again = from_config(spark, {}).run({"input": records})["transform"]
    assert [r.id for r in again.collect()] == [r.id for r in out["transform"].collect()]
    with pytest.raises(ConfigError):
        from_config(spark, {"pipeline": [{"name": "f", "type": "file_check", "pattern": "/nowhere/*.x"}]}).run({"input": records})


def test_calls_are_paced_and_bounded(spark):
    class Refusing:
        def answer(self, prompts):
            if len(prompts) > 1:
                raise ModelCallError("too many")
            return [p.upper() for p in prompts]

    rows = spark.createDataFrame([("a b c",), ("d",)], "text string").coalesce(1)
    asked = lambda most: sorted(str(r.out) for r in embed.ask(rows, "x", Refusing, "out", {"text": "text"}, "{{ text }}", Throttle(cool_down=0), most).collect())
    assert asked(3) == ["A B C", "D"] and asked(100) == ["None", "None"]


def test_partitions_share_a_quota(spark):
    from docloom.plans.config import quota

    class Clock:
        dimensions = 1

        def answer(self, prompts):
            import time

            return [str(time.time()) for _ in prompts]

    rows = spark.createDataFrame([(f"text {i}",) for i in range(24)], "text string").repartition(8)
    for deployed, least in (({"name": "a", "rpm": 600}, 0.1), ({"name": "a", "tpm": 1200, "rpm": 6_000}, 0.1)):
        make = from_config(spark, {"deployments": [deployed], "models": {"chat": "a"}}, make_chat=Clock).make_chat
        made = embed.ask(rows, "x", make, "at", {"text": "text"}, "{{ text }}", most_tokens=2)
        at = sorted(float(r["at"]) for r in made.collect())
        # ten calls of two tokens a second: of any twelve in a row the last comes a second after the first, but for one call of each part
        assert len(at) == 24 and all(b - a >= least * (11 - spark.sparkContext.defaultParallelism) for a, b in zip(at, at[11:], strict=False))
        assert at[-1] - at[0] >= 24 * least - 1
    pace = quota({"name": "b", "tpm": 350_000})
    assert (pace.requests_per_minute, pace.tokens_per_minute) == (2100, 350_000) and not quota({"name": "c"}).bounded
    part = pace.lease(2, 4)
    assert (part.requests_per_minute, part.tokens_per_minute) == (525, 87_500)
