"""Every registered query against its DuckDB counterpart on the smallest tables, if they are there."""

import os

import pytest

import docloom.queries as registered
from docloom.functions.html import html_to_text

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(DIR):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{name}{'/*.parquet' if os.path.isdir(f'{DIR}/{name}') else ''}'")
    return con


def canonical(rows):
    plain = lambda v: "" if v is None or v != v else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(plain, r)) for r in rows)


def _words_are_kept(spark, out, table, key, column, size, plain):
    """Chunks are bounded, and a text's words stand in its chunks in their order (overlaps and table heads stand there twice)."""
    chunks = {}
    for r in out.collect():
        assert 0 < len(r.chunk) <= size
        chunks.setdefault(r[key], []).append((int(r.chunk_id.rsplit("-", 1)[1]), r.chunk))
    for row in spark.read.parquet(f"{DIR}/{table}.parquet").collect():
        words = iter(" ".join(plain(c) for _, c in sorted(chunks.get(row[key], []))).split())
        assert all(w in words for w in plain(row[column] or "").split()), row[key]


#: What queries without a counterpart in SQL must hold.
HELD = {
    "chunk_recursive": lambda spark, out: _words_are_kept(spark, out, "documents", "doc_id", "text", 2000, lambda t: t),
    "chunk_html": lambda spark, out: _words_are_kept(spark, out, "pages", "page_id", "html", 600, lambda t: html_to_text(t) or ""),
}


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, duck, name):
    out = registered.QUERIES[name](spark, DIR)
    columns = sorted(out.columns)
    got = [tuple(r) for r in out.select(*columns).collect()]
    if name not in registered.ORACLE_SQL:
        assert got
        HELD[name](spark, out)
        return
    done = duck.execute(registered.ORACLE_SQL[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert canonical(got) == canonical(tuple(r[i] for i in order) for r in done.fetchall())


def test_streaming(spark, tmp_path):
    from docloom.streaming.loads import clean_stream, incremental, windowed_counts

    events = spark.read.parquet(f"{DIR}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{DIR}/events.parque[t]")
    picked = clean_stream(stream, [{"rule": "filter_by_match", "column": "event_type", "value": "a"}])
    incremental(picked.withColumnRenamed("event_id", "id"), str(tmp_path / "out"), lambda d: d, str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.where("event_type ILIKE '%a%'").count()
    with pytest.raises(ValueError):
        clean_stream(stream, [{"rule": "remove_duplicates", "columns": ["event_id"]}])
    assert windowed_counts(events.withColumn("ts", events.ts.cast("timestamp"))).agg({"n": "sum"}).first()[0] == events.count()
