"""Arrow streams by record batch: a first pass reads the messages' headers, then batches are dealt to tasks, which read their own bytes."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_schema

from scriptoria.scratch import staged
from scriptoria.sources.ranges import Counted, files

# Kinds of messages, what goes before each, and what a file (not a stream) begins with.
SCHEMA, DICTIONARY, BATCH = 1, 2, 3
_CONTINUES, _MAGIC = b"\xff\xff\xff\xff", b"ARROW1\0\0"

INDEX = "path string, schema struct<start:long,size:long>, dictionaries array<struct<start:long,size:long>>, start long, size long"


def message_kind(metadata: bytes) -> tuple[int, int]:
    """(kind, bytes of the body) of a message: two fields of the table that its metadata is."""
    (table,) = struct.unpack_from("<I", metadata, 0)
    (back,) = struct.unpack_from("<i", metadata, table)
    places = table - back
    (size,) = struct.unpack_from("<H", metadata, places)

    def field(n: int, kind: str) -> int:
        at = places + 4 + 2 * n
        (offset,) = struct.unpack_from("<H", metadata, at) if at < places + size else (0,)
        return struct.unpack_from(kind, metadata, table + offset)[0] if offset else 0

    return field(1, "<B"), field(3, "<q")


def messages(file: Counted) -> Iterator[tuple[int, int, int]]:
    """(kind, start, size) of the messages of a stream or file, of which only the headers are read. A file that ends within a message is an error."""
    length = file.size()
    at = 8 if file.read(0, 8) == _MAGIC else 0
    while at < length:
        head = file.read(at, 8)
        old = head[:4] != _CONTINUES  # streams of old have no mark before a length
        prefix = 4 if old else 8
        if len(head) < prefix:
            raise ValueError(f"cut off at {at}")
        (size,) = struct.unpack("<i", head[:4] if old else head[4:])
        if size == 0:
            return
        metadata = file.read(at + prefix, size)
        if size < 0 or len(metadata) < size:
            raise ValueError(f"cut off at {at}")
        kind, body = message_kind(metadata)
        if body < 0 or at + prefix + size + body > length:
            raise ValueError(f"cut off at {at}")
        yield kind, at, prefix + size + body
        at += prefix + size + body


def index(spark: SparkSession, path: str) -> DataFrame:
    """(path, schema, dictionaries, start, size): where each record batch of the files of a path lies, and what it needs to be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("size", pa.int64())])
        for b in batches:
            for name in b.column(0).to_pylist():
                schema, dictionaries, found = None, [], []
                with Counted(name) as file:
                    for kind, start, size in messages(file):
                        if kind == SCHEMA:
                            schema = {"start": start, "size": size}
                        elif kind == DICTIONARY:
                            dictionaries.append({"start": start, "size": size})
                        elif kind == BATCH:
                            found.append((name, schema, list(dictionaries), start, size))
                for i in range(0, len(found), 1024):
                    kinds = (pa.string(), span, pa.list_(span), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found[i : i + 1024], strict=True), kinds, strict=True)], ["path", "schema", "dictionaries", "start", "size"])

    listed = files(spark, path)
    return listed.repartition(max(1, spark.sparkContext.defaultParallelism), "path").mapInArrow(run, INDEX)


def schema_of(path: str) -> pa.Schema:
    """The schema of a file, by its first message."""
    with Counted(path) as file:
        for kind, start, size in messages(file):
            if kind == SCHEMA:
                return pa.ipc.read_schema(pa.py_buffer(file.read(start, size))).remove_metadata()
    raise ValueError(f"{path} has no schema")


def read_batches(spark: SparkSession, path: str, first: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of all record batches of the files of a path, in the columns of the file `first` (or some of these), with their file's path.

    A batch is a row of the plan: those of one file are read by many tasks. Columns that are not asked for are not unpacked.
    """
    schema = schema_of(first)
    names = [n for n in schema.names if columns is None or n in columns]
    fields = from_arrow_schema(pa.schema([schema.field(n) if not pa.types.is_dictionary(schema.field(n).type) else pa.field(n, schema.field(n).type.value_type) for n in names])).add("path", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with Counted(r["path"]) as file:
                    stream = b"".join(file.read(s["start"], s["size"]) for s in (r["schema"], *r["dictionaries"], r))
                whole = pa.ipc.open_stream(stream + _CONTINUES + bytes(4)).schema
                options = pa.ipc.IpcReadOptions(included_fields=[whole.get_field_index(n) for n in names])
                for part in pa.ipc.open_stream(stream + _CONTINUES + bytes(4), options=options):
                    found = [part.column(n) for n in names]
                    found = [c.dictionary_decode() if pa.types.is_dictionary(c.type) else c for c in found]
                    yield pa.RecordBatch.from_arrays([*found, pa.array([r["path"]] * part.num_rows, pa.string())], [*names, "path"])

    plan = staged(index(spark, path))
    return plan.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path", "start").mapInArrow(run, fields)


__all__ = ["index", "message_kind", "messages", "read_batches", "schema_of"]
