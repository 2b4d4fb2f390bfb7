"""Loads of a stream compared by key with what came before."""

import os
import shutil
import time
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException

from docloom.streaming.loads import current, incremental

SCHEMA = "id string, text string, n double, at timestamp, tags array<string>, action string"
AT = datetime(2024, 5, 6, 7, 8, 9, 123456)


def row(i, text, n=1.5, action=None):
    return (i, text, n, AT, ["a", None], action)


@pytest.fixture
def load(spark, tmp_path):
    def run(*rows, order_by=None):
        if rows:
            spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        query = incremental(stream, str(tmp_path / "out"), lambda df: df.withColumn("made", df.text), str(tmp_path / "state"), order_by=order_by)
        query.awaitTermination()

    return run


def written(spark, tmp_path, batch):
    folder = f"{tmp_path}/out/batch={batch}"
    return sorted(((r.id, r.action, r.text, r.made) for r in spark.read.parquet(folder).collect()), key=str) if os.path.isdir(folder) else []


def test_rows_are_compared_by_key(spark, tmp_path, load):
    load(row("1", "a"), row("2", "b"), row(None, "c"))
    assert written(spark, tmp_path, 0) == [("1", "I", "a", "a"), ("2", "I", "b", "b"), (None, "I", "c", "c")]
    first = spark.read.parquet(f"{tmp_path}/out/batch=0").where("id = '1'").first()
    assert (first.text, first.n, first["at"], first.tags, first.made) == ("a", 1.5, AT, ["a", None], "a")
    # unchanged, changed, new; the row without an id is known by its content
    load(row("1", "a"), row("2", "B"), row("3", "d"), row(None, "c"))
    assert written(spark, tmp_path, 1) == [("2", "U", "B", "B"), ("3", "I", "d", "d")]
    # deleted, an unknown one deleted, changed back, and sent twice
    load(row("1", None, action="D"), row("9", None, action="D"), row("2", "b"), row("3", "d"), row("3", "d"))
    assert written(spark, tmp_path, 2) == [("1", "D", None, None), ("2", "U", "b", "b")]
    # a deleted key that comes again is new
    load(row("1", "a"))
    assert written(spark, tmp_path, 3) == [("1", "I", "a", "a")]
    assert sorted((r.text, r.made) for r in current(spark, str(tmp_path / "out")).collect()) == [("a", "a"), ("b", "b"), ("c", "c"), ("d", "d")]
    # no new input: nothing changes; a batch that was not committed runs again and replaces itself
    before = current(spark, str(tmp_path / "out")).count()
    load()
    os.remove(tmp_path / "state" / "commits" / "3")
    for crc in (tmp_path / "state" / "commits").glob(".3.crc"):
        os.remove(crc)
    shutil.rmtree(tmp_path / "out" / "batch=3")
    load()
    assert written(spark, tmp_path, 3) == [("1", "I", "a", "a")] and current(spark, str(tmp_path / "out")).count() == before


def test_the_last_of_several_rows_counts(spark, tmp_path, load):
    load(row("1", "old", 2.0), row("1", "new", 10.0), row("1", "none", None), order_by="n")
    assert written(spark, tmp_path, 0) == [("1", "I", "new", "new")]


def test_many_keys(spark, tmp_path):
    """A load is compared by joins; with a call of Python for each key, two loads of 20,000 keys took minutes."""
    n = 20_000
    began = time.monotonic()
    for text in ("cast(id AS string)", "if(id % 2 = 0, 'new', cast(id AS string))"):
        spark.range(n).selectExpr("cast(id AS string) AS id", f"{text} AS text", "if(id % 10 = 9, 'D', null) AS action").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id string, text string, action string").parquet(str(tmp_path / "in"))
        incremental(stream, str(tmp_path / "out"), lambda df: df, str(tmp_path / "state")).awaitTermination()
    assert sorted((r.batch, r.action, r["count"]) for r in spark.read.parquet(str(tmp_path / "out")).groupBy("batch", "action").count().collect()) == [(0, "I", n * 9 // 10), (1, "U", n // 2)]
    assert time.monotonic() - began < 30


def test_what_is_known_is_that_of_the_batch_before(spark, tmp_path, load):
    """All keys may be deleted and loads without input lie between; state of any other batch than the one before is not taken for it."""
    load(row("1", "a"))
    load(row("1", None, action="D"))
    load()
    load(row("1", "a"))
    assert [written(spark, tmp_path, n) for n in range(3)] == [[("1", "I", "a", "a")], [("1", "D", None, None)], [("1", "I", "a", "a")]]
    # two batches are rolled back at once
    for kind in ("offsets", "commits"):
        for name in ("1", ".1.crc", "2", ".2.crc"):
            (tmp_path / "state" / kind / name).unlink(missing_ok=True)
    with pytest.raises(StreamingQueryException, match="what batch 0 left"):
        load()
