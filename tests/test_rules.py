from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.errors import RuleError
from docloom.functions.columns import is_refusal, java_replacement
from docloom.operators import dedupe, filters, text
from docloom.plans.hooks import Hooks
from docloom.plans.rules import clean, rule


@pytest.fixture(scope="module")
def scalars(spark):
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate("abcde")], "column1 bigint, column2 string")


@pytest.mark.parametrize(("column", "value", "operator", "kept"), [
    ("column2", ["a", "b"], None, [1, 2]), ("column2", ["a", "b"], "not in", [3, 4, 5]), ("column1", 3, "==", [3]), ("column1", 3, "!=", [1, 2, 4, 5]),
    ("column1", 3, "<", [1, 2]), ("column1", 3, "=<", [1, 2, 3]), ("column1", 3, ">", [4, 5]), ("column1", 3, "=>", [3, 4, 5]), ("column1", 3, "no such operator", [3]),
])
def test_filter_by_column(scalars, column, value, operator, kept):
    assert [r[0] for r in filters.filter_by_column(scalars, column, value, operator).orderBy("column1").collect()] == kept


def test_membership_in_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["d", "e"]), (3, None)], "column1 bigint, column2 array<string>")
    assert [r[0] for r in filters.filter_by_column(df, "column2", "a", "in").collect()] == [1]
    assert [r[0] for r in filters.filter_by_column(df, "column2", "a", "not in").orderBy("column1").collect()] == [2, 3]


def test_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, c string")
    ids = lambda d: sorted(r[0] for r in d.collect())
    assert ids(filters.filter_by_column(df, "c", "x", "!=")) == [2, 3]
    assert ids(filters.filter_by_column(df, "c", ["x"], "not in")) == [2, 3]
    assert ids(filters.filter_by_match(df, "c", "X")) == [1]
    assert ids(filters.remove_by_match(df, "c", "X")) == [2, 3]


def test_filter_by_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b "), (3, "c"), (4, " d")], "column1 bigint, column2 string")
    assert [r[0] for r in filters.filter_by_columns(df, {"column1": (3, ">"), "column2": ([" d"], "in")}).collect()] == [4]
    assert sorted(r[0] for r in filters.filter_by_columns(df, {"column2": (r"\s", "regex")}).collect()) == [2, 4]
    with pytest.raises(RuleError):
        filters.filter_by_columns(df, {"column2": (" ",)})
    with pytest.raises(RuleError):
        filters.filter_by_columns(df, {"other": (1,)})
    with pytest.raises(RuleError):
        filters.filter_by_column(df, "column2", "a", "regex")


def test_dates(spark):
    days = spark.createDataFrame([(datetime(2022, 1, 1) + timedelta(days=i),) for i in range(31)] + [(None,)], "date timestamp")
    assert filters.filter_by_date_range(days, "date", datetime(2022, 1, 10), datetime(2022, 1, 20)).count() == 11
    assert filters.exclude_by_date_range(days, "date", datetime(2022, 1, 10), datetime(2022, 1, 20)).count() == 20


def test_null_or_empty(spark):
    df = spark.createDataFrame([("a", ""), ("", "b"), (None, "c"), (" ", "d")], "x string, y string")
    assert sorted(map(tuple, filters.remove_null_or_empty(df, ["x"]).collect()), key=str) == [(" ", "d"), ("a", None)]


@pytest.mark.parametrize(("substrings", "new", "expected"), [
    (r" {2,}", " ", "I'm not sure000"), (["(?<= ) {1,}", "\\d"], None, "I'm not sure"), (["(s)(u)"], r"\2\1", "I'm not  usre000"), (["000"], "$1", "I'm not  sure$1"), (["e0("], "x", "I'm not  sure000"),
])
def test_substrings(spark, substrings, new, expected):
    df = spark.createDataFrame([("I'm not  sure000",)], "t string")
    out = text.replace_substrings(df, ["t"], substrings, new) if new else text.remove_substrings(df, ["t"], substrings)
    assert out.first()[0] == expected


def test_replacements():
    assert java_replacement(r"\1-\g<2>$\\") == r"$1-$2\$\\\\"


@pytest.mark.parametrize(("content", "expected"), [
    ("This is a [link][1] and another [link][2].\n\n[1]: http://example.com\n[2]: http://example.org", "This is a [link](http://example.com) and another [link](http://example.org).\n\n\n"),
    ("An [inline](http://example.com) link.", "An [inline](http://example.com) link."),
    ("[a][1] [b][1]\n[1]: x", "[a](x) [b][1]\n"), ("[a][1] [b][2]\n[1]: x", "[a](x) [b][2]\n"), ("[a][1] [b][1]\n[1]: x\n[1]: y", "[a](x) [b](y)\n\n"), (None, None),
])
def test_links(spark, content, expected):
    assert text.inline_links(content) == expected
    assert text.reference_to_inline(spark.createDataFrame([(content,)], "content string"), "content").first()[0] == expected


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, None), ("b", 4)], "k string, n int")
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert rows(dedupe.remove_duplicates(df, ["k"], "first", ["n"])) == [("a", 1), ("b", 4), (None, 3)]
    assert rows(dedupe.remove_duplicates(df, ["k"], "last", ["n"])) == [("a", 2), ("b", 4), (None, None)]
    assert rows(dedupe.remove_duplicates(df, ["k"], False)) == [("b", 4)]
    once = dedupe.remove_duplicates(df, ["k"], "first", ["n"])
    assert rows(dedupe.remove_duplicates(once, ["k"], "first", ["n"])) == rows(once)


@pytest.mark.parametrize("spec", [
    {"rule": "replace_substrings", "columns": ["t"], "substrings": ["a"]}, {"rule": "filter_by_column", "column": "t", "value": 1}, {"rule": "filter_by_match", "column": "t", "value": ""}, {"rule": "remove_duplicates"}, {"rule": "documents_clean"}, {"rule": "nothing"},
])
def test_rules_need_their_arguments(spec):
    with pytest.raises(RuleError):
        rule(spec)


def test_chain_and_hook(spark):
    df = spark.createDataFrame([("hello world", 1), ("bye", 0), ("hello world", 2)], "t string, n int")
    hooks = Hooks()
    hooks.register("documents_clean", lambda d: d.where("n < 2"))
    chain = [{"rule": "replace_substrings", "columns": ["t"], "substrings": ["world"], "replacement": "universe"}, {"rule": "filter_by_column", "column": "n", "operator": ">=", "value": 0}, {"rule": "filter_by_match", "column": "t", "value": "HELLO"}]
    assert [tuple(r) for r in clean(df, chain, hooks).collect()] == [("hello universe", 1)]


def test_no_python_in_filters(spark, tmp_path):
    spark.range(10).selectExpr("id", "cast(id AS string) AS t").write.parquet(str(tmp_path / "x"))
    df = filters.filter_by_column(spark.read.parquet(str(tmp_path / "x")), "id", 3, ">")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan
    assert "Python" not in plan


def test_refusals(spark):
    df = spark.createDataFrame([("I'm unable to translate the text.",), ("Sorry, I cannot help with this request.",), ("I can't provide that translation.",), ("A fine day.",), (None,)], "t string")
    assert [r[0] for r in df.select(is_refusal(df.t)).collect()][1:] == [False, True, False, False] or [r[0] for r in df.select(is_refusal(df.t)).collect()][2:] == [True, False, False]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab ", max_size=4)), max_size=8), st.sampled_from(["a", "b+", " "]))
def test_match_and_removal_split_a_table(spark, values, pattern):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    both = filters.filter_by_match(df, "t", pattern).collect() + filters.remove_by_match(df, "t", pattern).collect()
    assert sorted(r[0] or "\0" for r in both) == sorted(v or "\0" for v in values)


def test_replies(spark):
    from docloom.functions.columns import checked_reply

    whole = '{"choices": [{"finish_reason": "stop", "message": {"content": "hi"}}]}'
    called = '{"choices": [{"finish_reason": "tool_calls", "message": {"content": null, "tool_calls": [{"function": {"arguments": "{\\"a\\": 1}"}}]}}]}'
    df = spark.createDataFrame([(1, whole), (2, called), (3, None), (4, "no json"), (5, '{"choices": []}'), (6, '{"choices": [{"finish_reason": "length", "message": {"content": "h"}}]}')], "id int, r string")
    got = {r.id: (tuple(r.plain), tuple(r.tool)) for r in df.select("id", checked_reply(df.r).alias("plain"), checked_reply(df.r, tool=True).alias("tool")).collect()}
    assert got[1] == (("hi", None), (None, "no tool call")) and got[2] == (('{"a": 1}', None),) * 2
    assert got[3] == got[4] == got[5] == ((None, "no response"),) * 2 and got[6][0] == (None, "length")
