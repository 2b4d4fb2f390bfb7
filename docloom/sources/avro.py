"""Avro containers as a Python data source, for a Spark without its Avro package.

Files are read in splits: a task takes the blocks that begin behind the first sync marker of its range, so that a file of
any size is read by many tasks and none holds more than a block. Types meet Spark's as in Spark's own source; a union of
several types other than null becomes a struct of ``member0``, ``member1``, ... Codecs: null, deflate, zstandard.
A schema that contains itself is an error, and so is a range whose next marker is not where its block ends.
Tasks write files of their own into a temporary folder; only those of successful tasks are moved to the output.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal
from itertools import count
from typing import Any, BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import PySparkValueError
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "docloom_avro"
#: Fixed values of the container format.
MAGIC, MARKER = b"Obj\x01", 16
ROWS = 5000
_EPOCH, _DAY = datetime(1970, 1, 1, tzinfo=UTC), date(1970, 1, 1)

Read = Callable[[BinaryIO], Any]
Write = Callable[[Any, bytearray], None]


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in any store that Arrow knows; paths without a scheme are local."""
    if re.match(r"[a-z0-9+]+://", uri) and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)


# ---- values -------------------------------------------------------------------------------------------------------


def read_long(f: BinaryIO) -> int:
    value = shift = 0
    while True:
        byte = f.read(1)
        if not byte:
            raise EOFError("the file ends within a number")
        value |= (byte[0] & 0x7F) << shift
        if byte[0] < 0x80:
            return (value >> 1) ^ -(value & 1)
        shift += 7


def write_long(value: int, out: bytearray) -> None:
    value = (value << 1) ^ (value >> 63)
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)


def _read_bytes(f: BinaryIO) -> bytes:
    return f.read(read_long(f))


def _write_bytes(value: bytes, out: bytearray) -> None:
    write_long(len(value), out)
    out += value


def _items(f: BinaryIO) -> Iterator[None]:
    """Once for every item of an array or map, which stand in counted blocks."""
    while n := read_long(f):
        if n < 0:
            read_long(f)
        for _ in range(abs(n)):
            yield


_UNPACKED = {"float": ("<f", 4), "double": ("<d", 8)}


class Schema:
    """An Avro schema as Spark's type and a reader of its values."""

    def __init__(self, schema: Any) -> None:
        self.named: dict[str, Any] = {}
        self.open: set[str] = set()
        self.type, self.nullable, self.read = self.of(schema, "")

    def of(self, s: Any, space: str) -> tuple[T.DataType, bool, Read]:
        if isinstance(s, list):
            return self.union(s, space)
        if isinstance(s, str):
            full = s if "." in s or not space else f"{space}.{s}"
            known = full if full in self.named else s
            if known in self.open:
                raise PySparkValueError(f"the Avro schema {known} contains itself")
            return self.of(*self.named[known]) if known in self.named else self.primitive({"type": s})
        kind = s["type"]
        if isinstance(kind, (dict, list)):
            return self.of(kind, space)
        if kind in ("record", "error", "enum", "fixed"):
            space = s.get("namespace", s["name"].rpartition(".")[0] or space)
            name = s["name"] if "." in s["name"] or not space else f"{space}.{s['name']}"
            self.named[name] = (s, space)
            if kind in ("record", "error"):
                self.open.add(name)
                fields = [(f["name"], *self.of(f["type"], space)) for f in s["fields"]]
                self.open.remove(name)
                readers = [(n, r) for n, _, _, r in fields]
                return T.StructType([T.StructField(n, t, null) for n, t, null, _ in fields]), False, lambda f: {n: r(f) for n, r in readers}
            if kind == "enum":
                symbols = s["symbols"]
                return T.StringType(), False, lambda f: symbols[read_long(f)]
        if kind == "array":
            item, null, one = self.of(s["items"], space)
            return T.ArrayType(item, null), False, lambda f: [one(f) for _ in _items(f)]
        if kind == "map":
            item, null, one = self.of(s["values"], space)
            return T.MapType(T.StringType(), item, null), False, lambda f: [(_read_bytes(f).decode(), one(f)) for _ in _items(f)]
        return self.primitive(s)

    def union(self, members: list[Any], space: str) -> tuple[T.DataType, bool, Read]:
        null = "null" in members
        parts = [None if m == "null" else self.of(m, space) for m in members]
        kept = [p for p in parts if p]
        readers = [p[2] if p else (lambda f: None) for p in parts]
        types = {p[0].simpleString() for p in kept}
        wide = {frozenset({"int", "bigint"}): T.LongType(), frozenset({"float", "double"}): T.DoubleType()}.get(frozenset(types))
        if len(kept) <= 1 or wide:
            return wide or (kept[0][0] if kept else T.NullType()), null, lambda f: readers[read_long(f)](f)
        names, n = [], count()
        for p in parts:
            names.append(f"member{next(n)}" if p else None)

        def read(f: BinaryIO) -> Any:
            at = read_long(f)
            return None if names[at] is None else {names[at]: readers[at](f)}

        return T.StructType([T.StructField(m, p[0], True) for m, p in zip(names, parts) if m]), null, read

    def primitive(self, s: dict[str, Any]) -> tuple[T.DataType, bool, Read]:
        kind, logical = s["type"], s.get("logicalType")
        if kind in ("bytes", "fixed"):
            size = s.get("size")
            raw: Read = (lambda f: f.read(size)) if kind == "fixed" else _read_bytes
            if logical == "decimal":
                scale = s.get("scale", 0)
                return T.DecimalType(s["precision"], scale), False, lambda f: Decimal(int.from_bytes(raw(f), "big", signed=True)).scaleb(-scale)
            return T.BinaryType(), False, raw
        if kind == "long" and logical in ("timestamp-millis", "local-timestamp-millis"):
            return (T.TimestampType() if logical[0] == "t" else T.TimestampNTZType()), False, lambda f: read_long(f) * 1000
        if kind == "long" and logical in ("timestamp-micros", "local-timestamp-micros"):
            return (T.TimestampType() if logical[0] == "t" else T.TimestampNTZType()), False, read_long
        if kind == "int" and logical == "date":
            return T.DateType(), False, read_long
        if kind in _UNPACKED:
            form, size = _UNPACKED[kind]
            return (T.FloatType() if kind == "float" else T.DoubleType()), False, lambda f: struct.unpack(form, f.read(size))[0]
        simple: dict[str, tuple[T.DataType, Read]] = {
            "null": (T.NullType(), lambda f: None),
            "boolean": (T.BooleanType(), lambda f: f.read(1) == b"\x01"),
            "int": (T.IntegerType(), read_long),
            "long": (T.LongType(), read_long),
            "string": (T.StringType(), lambda f: _read_bytes(f).decode()),
        }
        if kind not in simple:
            raise PySparkValueError(f"not an Avro type: {kind}")
        return simple[kind][0], kind == "null", simple[kind][1]


def schema_of(kind: T.DataType, nullable: bool, name: str = "row") -> tuple[Any, Write]:
    """The Avro schema of a Spark type and a writer of its values."""
    if nullable:
        inner, write = schema_of(kind, False, name)

        def maybe(value: Any, out: bytearray) -> None:
            write_long(0 if value is None else 1, out)
            if value is not None:
                write(value, out)

        return ["null", inner], maybe
    if isinstance(kind, T.StructType):
        wrong = [f.name for f in kind if not re.fullmatch(r"[A-Za-z_]\w*", f.name, re.ASCII)]
        if wrong:
            raise PySparkValueError(f"not names of Avro: {', '.join(wrong)}")
        fields = [(f.name, *schema_of(f.dataType, f.nullable, f"{name}_{f.name}")) for f in kind]

        def struct_(value: Any, out: bytearray) -> None:
            for n, _, write in fields:
                write(value[n], out)

        return {"type": "record", "name": name, "fields": [{"name": n, "type": s} for n, s, _ in fields]}, struct_
    if isinstance(kind, (T.ArrayType, T.MapType)):
        listed = isinstance(kind, T.ArrayType)
        if not listed and not isinstance(kind.keyType, T.StringType):
            raise PySparkValueError("keys of Avro maps are strings")
        inner, one = schema_of(kind.elementType, kind.containsNull, f"{name}_item") if listed else schema_of(kind.valueType, kind.valueContainsNull, f"{name}_value")

        def many(value: Any, out: bytearray) -> None:
            if value:
                write_long(len(value), out)
                for item in value:
                    if not listed:
                        _write_bytes(item[0].encode(), out)
                    one(item if listed else item[1], out)
            out.append(0)

        return ({"type": "array", "items": inner} if listed else {"type": "map", "values": inner}), many
    if isinstance(kind, T.DecimalType):
        scale = kind.scale

        def decimal(value: Decimal, out: bytearray) -> None:
            whole = int(value.scaleb(scale))
            _write_bytes(whole.to_bytes(whole.bit_length() // 8 + 1, "big", signed=True), out)

        return {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": scale}, decimal
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        form = "<f" if isinstance(kind, T.FloatType) else "<d"
        return kind.typeName(), lambda value, out: out.extend(struct.pack(form, value))
    micros = lambda value: (value.replace(tzinfo=value.tzinfo or UTC) - _EPOCH) // timedelta(microseconds=1)
    simple: dict[type, tuple[Any, Write]] = {
        T.NullType: ("null", lambda value, out: None),
        T.BooleanType: ("boolean", lambda value, out: out.append(bool(value))),
        T.StringType: ("string", lambda value, out: _write_bytes(value.encode(), out)),
        T.BinaryType: ("bytes", _write_bytes),
        T.DateType: ({"type": "int", "logicalType": "date"}, lambda value, out: write_long((value - _DAY).days, out)),
        T.TimestampType: ({"type": "long", "logicalType": "timestamp-micros"}, lambda value, out: write_long(micros(value), out)),
        T.TimestampNTZType: ({"type": "long", "logicalType": "local-timestamp-micros"}, lambda value, out: write_long(micros(value), out)),
        T.LongType: ("long", write_long),
    } | dict.fromkeys((T.ByteType, T.ShortType, T.IntegerType), ("int", write_long))
    if type(kind) not in simple:
        raise PySparkValueError(f"no Avro type for {kind.simpleString()}")
    return simple[type(kind)]


# ---- containers ---------------------------------------------------------------------------------------------------


def read_header(f: BinaryIO) -> tuple[dict[str, bytes], bytes]:
    """Metadata and sync marker."""
    if f.read(4) != MAGIC:
        raise PySparkValueError("not an Avro container")
    meta = {_read_bytes(f).decode(): _read_bytes(f) for _ in _items(f)}
    return meta, f.read(MARKER)


def _unpacked(codec: str, block: bytes) -> bytes:
    if codec == "null":
        return block
    if codec == "deflate":
        return zlib.decompress(block, -15)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(block)
    raise PySparkValueError(f"no reader for the Avro codec {codec}")


def _behind_marker(f: BinaryIO, start: int, end: int, sync: bytes) -> int | None:
    """The place behind the first marker that begins in start..end; what spans two pieces is seen in the second."""
    f.seek(start)
    held, at = b"", start
    while at < end + MARKER and (piece := f.read(1 << 20)):
        held += piece
        found = held.find(sync)
        if found >= 0:
            return at + found + MARKER if at + found < end else None
        at += max(0, len(held) - MARKER + 1)
        held = held[-MARKER + 1 :]
    return None


def read_range(f: BinaryIO, start: int, end: int) -> Iterator[Any]:
    """The values of all blocks whose preceding marker begins in start..end; the header's counts as at 0."""
    meta, sync = read_header(f)
    codec = meta.get("avro.codec", b"null").decode()
    read = Schema(json.loads(meta["avro.schema"])).read
    behind = f.tell()
    first = behind if start == 0 else _behind_marker(f, max(start, behind - MARKER + 1), end, sync)
    if first is None:
        return
    f.seek(first)
    marker = 0 if start == 0 else first - MARKER
    while marker < end:
        byte = f.read(1)
        if not byte:
            return
        f.seek(-1, os.SEEK_CUR)
        n = read_long(f)
        block = io.BytesIO(_unpacked(codec, _read_bytes(f)))
        for _ in range(n):
            yield read(block)
        marker = f.tell()
        if f.read(MARKER) != sync:
            raise PySparkValueError("a block of an Avro container does not end at its marker")


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int


class AvroReader(DataSourceReader):
    def __init__(self, schema: T.StructType, paths: list[str], size: int) -> None:
        self.schema, self.paths, self.size = schema, paths, size

    def partitions(self) -> list[Split]:
        out = [Split(path, a, min(a + self.size, n)) for path, n in files(self.paths) for a in range(0, n, self.size)]
        return out or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        schema = to_arrow_schema(self.schema)
        store, path = located(partition.path)
        rows: list[Any] = []
        with store.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as f:
            for row in read_range(f, partition.start, partition.end):
                rows.append({c: row.get(c) for c in schema.names})
                if len(rows) == ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


@dataclass
class Part(WriterCommitMessage):
    name: str


class AvroWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, path: str, overwrite: bool) -> None:
        self.schema, self.path, self.overwrite = schema, path.rstrip("/"), overwrite
        self.folder = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        schema, write = schema_of(self.schema, False)
        name, sync = f"part-{uuid.uuid4().hex}.avro", uuid.uuid4().bytes
        store, folder = located(self.folder)
        store.create_dir(folder, recursive=True)
        head = bytearray(MAGIC)
        write_long(2, head)
        for key, value in (("avro.schema", json.dumps(schema).encode()), ("avro.codec", b"deflate")):
            _write_bytes(key.encode(), head)
            _write_bytes(value, head)
        head.append(0)
        with store.open_output_stream(f"{folder}/{name}") as f:
            f.write(bytes(head) + sync)
            block, n = bytearray(), 0

            def close() -> None:
                packer = zlib.compressobj(wbits=-15)
                packed = packer.compress(bytes(block)) + packer.flush()
                start = bytearray()
                write_long(n, start)
                write_long(len(packed), start)
                f.write(bytes(start) + packed + sync)

            for batch in batches:
                for row in batch.to_pylist():
                    write(row, block)
                    n += 1
                    if len(block) > 1 << 18:
                        close()
                        block, n = bytearray(), 0
            if n:
                close()
        return Part(name)

    def commit(self, messages: list[Part | None]) -> None:
        store, path = located(self.path)
        _, folder = located(self.folder)
        store.create_dir(path, recursive=True)
        if self.overwrite:
            for found in store.get_file_info(fs.FileSelector(path)):
                if found.path.endswith(".avro") and found.is_file:
                    store.delete_file(found.path)
        for part in messages:
            if part:
                store.move(f"{folder}/{part.name}", f"{path}/{part.name}")
        self.abort(messages)

    def abort(self, messages: list[Part | None]) -> None:
        store, folder = located(self.folder)
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


def files(paths: list[str]) -> list[tuple[str, int]]:
    """Files and their sizes; of folders those below them whose names are not hidden."""
    out = []
    for uri in paths:
        store, path = located(uri)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise PySparkValueError(f"nothing at {uri}")
        scheme = re.match(r"[a-z0-9+]+://", uri)
        front = scheme[0] if scheme and not uri.startswith("file:") else ""
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        root = len(path.rstrip("/"))
        out += sorted((front + i.path, i.size) for i in found if i.is_file and not any(p[:1] in "_." for p in i.path[root:].split("/") if p))
    return out


class AvroSource(DataSource):
    """Options: ``path``, or ``paths`` as a JSON list; ``split`` in bytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    @property
    def paths(self) -> list[str]:
        return json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]

    def schema(self) -> T.StructType:
        found = files(self.paths)
        if not found:
            raise PySparkValueError(f"no Avro file in {self.paths}")
        store, path = located(found[0][0])
        with store.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 16) as f:
            kind = Schema(json.loads(read_header(f)[0]["avro.schema"])).type
        if not isinstance(kind, T.StructType):
            raise PySparkValueError("records of an Avro container must be records")
        return kind

    def reader(self, schema: T.StructType) -> AvroReader:
        return AvroReader(schema, self.paths, int(self.options.get("split", 64 << 20)))

    def writer(self, schema: T.StructType, overwrite: bool) -> AvroWriter:
        return AvroWriter(schema, self.options["path"], overwrite)
