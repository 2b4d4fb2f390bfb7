"""Mappings as expressions, against a plain walk over parsed JSON."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.mapping import parse_path
from docloom.operators import transform

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def walk(value, steps, seen=()):
    if not steps:
        return [(seen, value)]
    step, rest = steps[0], steps[1:]
    if step == "*":
        return [x for i, v in enumerate(value) for x in walk(v, rest, (*seen, i))] if isinstance(value, list) else []
    if isinstance(step, int):
        return walk(value[step], rest, seen) if isinstance(value, list) and step < len(value) else []
    return walk(value[step], rest, seen) if isinstance(value, dict) and step in value else []


def first(value, path):
    return next((v for _, v in walk(value, parse_path(path)) if v is not None), None)


def blocks(document, spec):
    found = {k: dict(walk(document, parse_path(p))) for k, p in spec.items() if isinstance(p, str)}
    meta = {k: dict(walk(document, parse_path(p))) for k, p in spec.get("metadata", {}).items()}
    beside = lambda values, index: next((values[index[:n]] for n in range(len(index), -1, -1) if index[:n] in values), None)
    leading = next(k for k in ("data", "rows", "title") if k in found)
    for index, value in sorted(found[leading].items(), key=lambda x: x[0]):
        if value is None:
            continue
        block = {k: beside(found[k], index) for k in ("title", "columns") if k in found}
        if leading == "data":
            block["data"] = value if isinstance(value, list) else [value]
        elif leading == "rows":
            block["rows"] = value
        if meta:
            block["metadata"] = {k: beside(v, index) for k, v in meta.items()}
        yield {k: v for k, v in block.items() if v is not None}


MAPPING = {
    "id": "$.id", "name": "$.a.title", "metadata": {"d": "$.a.meta.d", "any": "$.b[*].c[*].no", "second": "$.b[1].t", "odd": "$.o'd d.x-y"},
    "content": [
        {"title": "$.b[*].t", "data": "$.b[*].c[*].d", "metadata": {"g": "$.b[*].g", "deep": "$.b[*].c[*].g", "flat": "$.id", "deeper": "$.b[*].c[*].q[*]"}},
        {"title": "$.b[*].t", "rows": "$.b[*].table.rows", "columns": "$.b[*].table.columns"},
        {"title": "$.u[*]", "data": "$.b[*].one"}, {"title": "$.u[*]"}, {"data": "$.a.title"}, {"data": "$.u"},
    ],
}


def made(r):
    some = lambda make, p=0.75: make() if r.random() < p else None
    word = lambda: r.choice(["x", "", "é\n", 'q"uote', "<p>hi</p>", '"classification":"SECRET"', "12"])
    data = lambda: r.choice([word, lambda: [word(), word()], lambda: [], lambda: {"k": word(), "n": None}, lambda: 3, lambda: [{"title": "t", "data": [word()]}, None]])()

    def part():
        out = {"d": some(data), "g": some(word), "q": [1, 2], "no": some(word, 0.1)}
        return {k: v for k, v in out.items() if r.random() < 0.9}

    def outer():
        out = {"t": some(word), "g": some(lambda: ["g"]), "c": some(lambda: [part() for _ in range(r.randrange(4))]), "one": some(data), "table": some(lambda: {"rows": [["a", word()]], "columns": some(lambda: ["h"])})}
        return {k: v for k, v in out.items() if r.random() < 0.9}

    return {"id": r.choice([7, "s", None, 1.5]), "a": {"title": "T", "meta": some(lambda: {"d": word()})}, "b": some(lambda: [outer() for _ in range(r.choice([0, 1, 3, 13]))], 0.9), "u": some(lambda: [word() for _ in range(3)]), "o'd d": {"x-y": some(word)}}


def test_random_documents(spark):
    r = random.Random(5)
    docs = [made(r) for _ in range(150)]
    records = spark.createDataFrame([(json.dumps(d), i, "own") for i, d in enumerate(docs)], "value string, title int, error string")
    # one document a record, so their order tells which is which
    got = transform.map_records(records.coalesce(1), "value", MAPPING).collect()
    assert len(got) == len(docs) and all(g.error is None for g in got)
    for d, g in zip(docs, got):
        assert json.loads(g.content) == [b for spec in MAPPING["content"] for b in blocks(d, spec)], d
        want = transform.DEFAULTS | {k: v for k, p in MAPPING["metadata"].items() if (v := first(d, p)) is not None}
        assert json.loads(g.metadata) == want and list(json.loads(g.metadata)) == sorted(want)
        assert g.id == (None if d["id"] is None else str(d["id"])) and g.title == "T" and g.content_type == "PRIVATE"
        assert g.content_full is not None and g.content_raw is not None


def test_texts_without_a_parser(spark):
    document = {"id": 1, "n": "N", "b": [{"t": "h", "d": ["x", "<p>y</p>", 3, None, {"k": 1}]}, {"t": "", "d": "z"}], "rows": [["a"]], "cols": ["c"]}
    mapping = {"id": "$.id", "name": "$.n", "content": [{"title": "$.b[*].t", "data": "$.b[*].d"}, {"rows": "$.rows", "columns": "$.cols"}]}
    records = spark.createDataFrame([(json.dumps(document),), ('{"n": "empty"}',)], "value string")
    full, empty = transform.map_records(records, "value", mapping, delimiter="--", markup=False).collect()
    assert full.content_raw == 'x\n<p>y</p>\n3\n\n{"k":1}\nz\n["c"]\n[["a"]]' == full.html_content
    assert full.content_full == "\n--# h\n" + full.content_raw
    assert (empty.content, empty.content_full, empty.error) == ("[]", "", None)
    with pytest.raises(ValueError):
        transform.map_records(records, "value", markup=False)


def test_roots_and_errors(spark):
    rows = ['{"x": [[{"id": 1, "name": "A"}, {"id": 2}], [{"id": 3, "name": "C"}]]}', '{"x": []}', '{"y": 1}', "no json", None, "", "null", '{"x": [{"id": 4, "name": "D", "metadata": [1]}]}', '{"a": 1, "a": 2}', '{"x": {"id": 5, "name": ""}}']
    records = spark.createDataFrame([(v,) for v in rows], "value string")
    out = transform.map_records(records, "value", root="$.x").collect()
    # one level of lists is opened
    assert [(r.id, r.title) for r in out if r.error is None] == []
    out = transform.map_records(records, "value", root="$.x[*]").collect()
    assert [(r.id, r.title) for r in out if r.error is None] == [("1", "A"), ("3", "C")]
    bad = [(r.error.split(": ", 1)[1], r.record) for r in out if r.error is not None]
    assert ("a document needs a name", '{"id":2}') in bad and ("no value at $.x[*]", '{"y": 1}') in bad
    assert {r.record for r in out if r.error == "ValueError: not a JSON record"} == {"no json", None, "", '{"a": 1, "a": 2}'}
    assert [e for e, r in bad if r and "[1]" in r] == ["metadata must be an object"]
    assert all(r.id is None and r.content is None and r.content_full is None and r.content_type is None and r.metadata is None and r.title is None for r in out if r.error)
    assert transform.map_records(records.limit(0), "value").count() == 0
    assert transform.map_records(spark.createDataFrame([("[]",)], "value string"), "value").count() == 0
    with pytest.raises(ValueError):
        transform.map_records(records, "value", {"id": "$.id"})


def test_classifications_inside_content(spark):
    def kind(content, **metadata):
        records = spark.createDataFrame([(json.dumps({"name": "n", "metadata": metadata, "content": content}),)], "value string")
        return transform.map_records(records, "value").first().content_type

    assert kind("x") == "PRIVATE" and kind("x", classification="PUBLIC") == "PUBLIC" and kind("x", classification="PUBLIC", access_groups=[]) == "PUBLIC"
    assert kind("x", classification="PUBLIC", access_groups=["g"]) == "PRIVATE"
    assert kind([{"data": [{"metadata": {"classification": "SECRET"}, "data": "x"}]}], classification="PUBLIC") == "MIXED"
    assert kind([{"data": [{"metadata": {"classification": "PUBLIC"}, "data": '"classification":"SECRET"'}]}], classification="PUBLIC") == "PUBLIC"
    assert kind([{"data": ["{", '"classification":'], "metadata": {"classification": None}}], classification="PUBLIC") == "PUBLIC"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["transform_mapping", "transform_wildcard"])
def test_queries_stay_in_the_jvm(spark, name):
    from docloom.queries import QUERIES

    plan = QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    # records are parsed once
    assert plan.count("parseJson(value") == 1
