"""The Avro source: types, splits, codecs and files of other makers."""

import io
import json
import zlib
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docloom.errors import SinkError, SourceNotFound
from docloom.sources import avro
from docloom.sources.readers import avro_format, read_records, read_table
from docloom.sources.sinks import write_table

TYPES = "b boolean, i int, l bigint, f float, d double, s string, x binary, day date, at timestamp, local timestamp_ntz, dec decimal(20, 3), list array<string>, m map<string, int>, st struct<a: int, deep: array<struct<z: string>>>"


def test_round_trip(spark, tmp_path):
    full = (True, -5, 2**62, 0.5, -1e300, "é\n", b"\x00\xff", date(1969, 7, 20), datetime(2024, 1, 2, 3, 4, 5, 678901, UTC), datetime(1950, 1, 1, 0, 0, 0, 1), Decimal("-12345678901234567.891"), ["a", None, ""], {"k": 1, "n": None}, (7, [("z",), (None,)]))
    df = spark.createDataFrame([full, (None,) * 14, (False, 2**31 - 1, -(2**63), 1.0, 0.0, "", b"", date(2400, 1, 1), None, None, Decimal("0.001"), [], {}, (None, []))], TYPES)
    uri = write_table(df, str(tmp_path / "all.avro"))
    back = read_table(spark, uri)
    assert uri.endswith(".avro") and avro_format(spark) == avro.FORMAT
    assert [(f.name, f.dataType.simpleString()) for f in back.schema if f.name != "at"] == [(f.name, f.dataType.simpleString()) for f in df.schema if f.name != "at"]
    # as in every sink, null lists become empty; times become ISO text
    want = df.withColumn("list", F.coalesce("list", F.array().cast("array<string>"))).withColumn("at", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    key = lambda r: str(tuple(r))
    assert sorted(back.collect(), key=key) == sorted(want.collect(), key=key)
    with pytest.raises(SinkError):
        write_table(df, uri)
    assert write_table(df, uri, "ignore") == uri and read_table(spark, uri).count() == 3
    write_table(df, uri, "append")
    assert read_table(spark, uri).count() == 6
    write_table(df.limit(1), uri, "overwrite")
    assert read_table(spark, uri, ["s"]).count() == 1 and not list((tmp_path / "all.avro").glob("_temporary*"))
    assert json.loads(read_records(spark, uri).first().value)["s"] == "é\n"
    with pytest.raises(SourceNotFound):
        read_table(spark, str(tmp_path / "none.avro"))


def test_times_keep_their_type(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5, 678901, UTC),), (datetime(1901, 1, 1, tzinfo=UTC),), (None,)], "at timestamp")
    avro_format(spark)
    df.write.format(avro.FORMAT).mode("append").save(str(tmp_path / "t"))
    back = spark.read.format(avro.FORMAT).load(str(tmp_path / "t"))
    assert back.schema == df.schema and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("split", [40, 1000, 10**9])
def test_every_row_is_in_one_split(spark, tmp_path, split):
    avro_format(spark)
    df = spark.range(0, 30000, 1, 3).select("id", F.repeat(F.md5(F.col("id").cast("string")), 20).alias("text"))
    df.write.format(avro.FORMAT).mode("append").save(str(tmp_path / "x"))
    split = max(split, sum(n for _, n in avro.files([str(tmp_path / "x")])) // 50) if split < 10**9 else split
    back = spark.read.format(avro.FORMAT).option("split", split).load(str(tmp_path / "x"))
    assert back.rdd.getNumPartitions() == sum(-(-n // split) for _, n in avro.files([str(tmp_path / "x")]))
    assert back.agg(F.count("*"), F.countDistinct("id"), F.sum("id")).first()[:] == (30000, 30000, 30000 * 29999 // 2)


def _container(schema, blocks, codec, sync=b"0123456789abcdef"):
    out = bytearray(avro.MAGIC)
    avro.write_long(-2, out)  # a block of items with its size
    entries = bytearray()
    for k, v in (("avro.schema", json.dumps(schema).encode()), ("avro.codec", codec.encode())):
        avro._write_bytes(k.encode(), entries)
        avro._write_bytes(v, entries)
    avro.write_long(len(entries), out)
    out += entries + b"\x00" + sync
    for n, body in blocks:
        packed = body if codec == "null" else zlib.compress(body)[2:-4]
        avro.write_long(n, out)
        avro.write_long(len(packed), out)
        out += packed + sync
    return bytes(out)


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_any_split_of_a_file_gives_each_row_once(codec):
    schema = {"type": "record", "name": "R", "namespace": "n", "fields": [{"name": "a", "type": "long"}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["X", "Y"]}}, {"name": "again", "type": ["null", "E"]}, {"name": "u", "type": ["int", "string", "null"]}, {"name": "w", "type": ["int", "long"]}]}
    rows, blocks = [], []
    for b in range(9):
        body = bytearray()
        for i in range(b):  # the first block is empty
            avro.write_long(b * 10 + i, body)
            body += bytes([2, 2, 0])  # Y, then the union's E: X
            avro.write_long(1, body)
            avro._write_bytes(b"t", body)
            avro.write_long(1, body)
            avro.write_long(-(2**40), body)
            rows.append({"a": b * 10 + i, "e": "Y", "again": "X", "u": {"member1": "t"}, "w": -(2**40)})
        blocks.append((b, bytes(body)))
    whole = _container(schema, blocks, codec)
    kinds = {f.name: f.dataType.simpleString() for f in avro.Schema(schema).type}
    assert kinds == {"a": "bigint", "e": "string", "again": "string", "u": "struct<member0:int,member1:string>", "w": "bigint"}
    for size in (1, 7, 16, 17, 33, 100, len(whole), 10**6):
        got = [r for at in range(0, len(whole), size) for r in avro.read_range(io.BytesIO(whole), at, min(at + size, len(whole)))]
        assert got == rows, size
    with pytest.raises(ValueError):
        list(avro.read_range(io.BytesIO(whole[:-1] + b"!"), 0, len(whole)))
    with pytest.raises(ValueError):
        avro.Schema({"type": "record", "name": "L", "fields": [{"name": "next", "type": ["null", "L"]}]})
    with pytest.raises(ValueError):
        list(avro.read_range(io.BytesIO(b"PAR1"), 0, 4))
