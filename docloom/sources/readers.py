"""Readers by file type; every path goes through Spark, so any file system it knows will do."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.errors import SourceNotFound
from docloom.sources import avro

#: Other names of file types.
ALIASES = {"yml": "yaml", "jsonl": "ndjson", "nd.json": "ndjson"}
KINDS = ("json", "ndjson", "avro", "parquet", "yaml", "csv")


def file_kind(uri: str) -> str:
    name = uri.rstrip("/").rsplit("/", 1)[-1].lower()
    ending = "nd.json" if name.endswith(".nd.json") else name.rsplit(".", 1)[-1] if "." in name else ""
    kind = ALIASES.get(ending, ending)
    if kind not in KINDS:
        raise NotImplementedError(f"no reader for {uri}")
    return kind


def avro_format(spark: SparkSession) -> str:
    """Spark's Avro source where its package is there, else the one of this library."""
    try:
        spark.read.format("avro").schema("x int").load("file:/")
    except Exception as problem:  # noqa: BLE001 any other failure means that the source is there
        if "Failed to find data source" in str(problem):
            spark.dataSource.register(avro.AvroSource)
            return avro.FORMAT
    return "avro"


def read_records(spark: SparkSession, uri: str) -> DataFrame:
    """One row ``value`` a JSON object or array of a JSON, NDJSON or YAML source; blank and broken NDJSON lines drop out."""
    kind = file_kind(uri)
    if kind == "json":
        return spark.read.text(uri, wholetext=True).where(F.trim("value") != "").select("value")
    if kind == "ndjson":
        return spark.read.text(uri).where(F.try_parse_json("value").isNotNull())
    if kind == "yaml":

        def parse(batches):
            import yaml

            for batch in batches:
                for text in batch.column(0):
                    found = [x for document in yaml.safe_load_all(text.as_py()) if document is not None for x in (document if isinstance(document, list) else [document])]
                    yield pa.RecordBatch.from_arrays([pa.array([json.dumps(x, default=str) for x in found], pa.string())], ["value"])

        # each file is parsed where it is read
        return spark.read.text(uri, wholetext=True).where(F.trim("value") != "").mapInArrow(parse, "value string")
    return read_table(spark, uri).select(F.to_json(F.struct("*")).alias("value"))


def read_table(spark: SparkSession, uri: str, columns: Sequence[str] | None = None, json_columns: Sequence[str] = ()) -> DataFrame:
    """A table of any supported type; ``json_columns`` are parsed as VARIANT where they hold JSON."""
    kind = file_kind(uri)
    if kind == "parquet":
        df = spark.read.parquet(uri)
    elif kind == "csv":
        df = spark.read.csv(uri, header=True, inferSchema=True, multiLine=True, escape='"')
    elif kind == "avro":
        found = [s.getPath().toString() for s in matching(spark, uri)]
        if not found:
            raise SourceNotFound(f"nothing matches {uri}")
        kind = avro_format(spark)
        df = spark.read.format(kind).load(found) if kind == "avro" else spark.read.format(kind).option("paths", json.dumps(found)).load()
    elif kind == "yaml":
        rows = read_records(spark, uri)
        return spark.read.json(rows.rdd.map(lambda r: r[0]))
    else:
        df = spark.read.json(uri, multiLine=kind == "json", mode="DROPMALFORMED" if kind == "ndjson" else "FAILFAST")
    if json_columns:
        df = df.withColumns({c: F.try_parse_json(F.col(c)) for c in json_columns})
    return df.select(*columns) if columns else df


def matching(spark: SparkSession, pattern: str) -> list:
    """The files that a glob finds, in any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return list(found or [])


def latest(spark: SparkSession, pattern: str, by: str = "name", oldest: bool = False) -> str:
    """The greatest path of a glob by name, size or time."""
    key = {"name": lambda s: (s.getPath().getName(), s.getModificationTime()), "size": lambda s: s.getLen(), "updated": lambda s: s.getModificationTime(), "time_created": lambda s: s.getModificationTime()}[by]
    found = matching(spark, pattern)
    if not found:
        raise SourceNotFound(f"nothing matches {pattern}")
    return (min if oldest else max)(found, key=key).getPath().toString()


def latest_table(spark: SparkSession, pattern: str, by: str = "name") -> DataFrame | None:
    """The newest earlier output, None if there is none yet."""
    try:
        return read_table(spark, latest(spark, pattern, by))
    except SourceNotFound:
        return None
