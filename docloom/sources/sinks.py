"""Writers and their paths."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.errors import SinkError
from docloom.functions.columns import iso_time
from docloom.sources.readers import avro_format, file_kind, latest, matching


@dataclass(frozen=True)
class SourceSpec:
    """Where a step's input lies: folder, and a name from prefix, stem, run and extension."""

    root: str
    directory: str = ""
    extension: str = ".parquet"
    prefix: str = ""
    file_name: str = ""
    run: str = ""

    def glob(self) -> str:
        name = f"{self.prefix + '_' if self.prefix else ''}{self.file_name or '*'}{'_' + self.run if self.run else ''}{self.extension}"
        return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate((self.root, self.directory, name)) if p)

    def resolve(self, spark, by: str = "name") -> str:
        return latest(spark, self.glob(), by)


def target_path(root: str, directory: str, source: str, extension: str = ".parquet", prefix: str = "", run: str = "") -> str:
    """Keeps the source's stem, without the prefix and run that an earlier step gave it."""
    stem = re.sub(r"(\.nd)?\.\w+$", "", source.rstrip("/").rsplit("/", 1)[-1])
    name = f"{prefix + '_' if prefix else ''}{stem}{'_' + run if run else ''}{extension}"
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate((root, directory, name)) if p)


_STAMP = re.compile(r"(\d{8}[T_]?\d{6}|\d{4}-\d{2}-\d{2}(?:T[\d:.]+Z?)?)")


def embedding_name(source: str, extension: str, now: datetime | None = None) -> str:
    found = _STAMP.search(source.rsplit("/", 1)[-1])
    stamp = (now or datetime.now(UTC)).strftime("%Y%m%d%H%M%S")
    return f"{found[1] if found else stamp}_embedded_{stamp}{extension}"


def normalized(df: DataFrame, iso: bool = False) -> DataFrame:
    """Null lists become empty; times become ISO text if asked."""
    out = {f.name: F.coalesce(F.col(f.name), F.array().cast(f.dataType)) for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    if iso:
        out |= {f.name: iso_time(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(out) if out else df


def write_table(df: DataFrame, uri: str, mode: str = "errorifexists") -> str:
    """Parquet, Avro, NDJSON, JSON or CSV. Returns the path written."""
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated:
        raise SinkError(f"repeated columns: {', '.join(repeated)}")
    kind = file_kind(uri)
    writer = normalized(df, iso=kind != "parquet").write.mode(mode)
    if kind == "parquet":
        writer.parquet(uri)
    elif kind in ("json", "ndjson"):
        writer.option("ignoreNullFields", "false").json(uri)
    elif kind == "avro":
        # a Python source knows no save mode but these two
        if mode not in ("append", "overwrite"):
            if matching(df.sparkSession, uri):
                if mode == "ignore":
                    return uri
                raise SinkError(f"there is something at {uri}")
            writer = writer.mode("append")
        writer.format(avro_format(df.sparkSession)).save(uri)
    elif kind == "csv":
        writer.option("header", "true").csv(uri)
    else:
        raise SinkError(f"no writer for {uri}")
    return uri


def write_split(documents: DataFrame, uri: str, mode: str = "errorifexists") -> tuple[str, str]:
    """Documents without an ``error`` to uri, the others with their error and record as NDJSON beside it; both paths."""
    good = write_table(documents.where("error IS NULL").drop("error", "record"), uri, mode)
    stem = uri.rstrip("/").removesuffix(".nd.json") if uri.rstrip("/").endswith(".nd.json") else uri.rstrip("/").rsplit(".", 1)[0]
    return good, write_table(documents.where("error IS NOT NULL").select("error", "record"), f"{stem}_errors.nd.json", mode)


def move_to_processed(spark, uri: str) -> str:
    """Move an input into the folder ``processed`` beside it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), "processed")
    fs.mkdirs(folder)
    to = spark._jvm.org.apache.hadoop.fs.Path(folder, path.getName())
    if not fs.rename(path, to):
        raise SinkError(f"cannot move {uri}")
    return to.toString()
