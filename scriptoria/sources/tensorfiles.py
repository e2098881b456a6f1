"""Tensor files: eight bytes that tell a header's length, the header as JSON, then the tensors' bytes.

Headers are read by one small range a file, tensors by tiles, so that neither files nor tensors need fit a task.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.sources.fragments import write_pieces
from scriptoria.sources.ranges import Counted, files

# The names of types in headers, and how numpy reads them; BF16 is the upper half of a float32.
DTYPES = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "BF16": "<u2", "I64": "<i8", "I32": "<i4", "I16": "<i2", "I8": "i1", "U8": "u1", "BOOL": "?"}

#: Rows and columns of a tile, and bytes of whole rows that are read at once.
TILE, STRIPE_BYTES = 512, 32 << 20
#: A header of more bytes is refused: its length is not to be trusted.
HEADER_BYTES = 100 << 20

ENTRY = "path string, name string, dtype string, shape array<long>, begin long, size long, header_bytes long"
TILE_ROW = "name string, dtype string, shape array<long>, r int, c int, rows int, columns int, values array<double>"


def header_of(file: Counted) -> tuple[dict[str, dict], int]:
    """(entries by name, where the tensors' bytes begin) of a file, of which no more than the header is read."""
    (size,) = struct.unpack("<Q", file.read(0, 8).ljust(8, b"\0"))
    if not 2 <= size <= min(HEADER_BYTES, file.size() - 8):
        raise ValueError(f"a header of {size} bytes")
    entries = json.loads(file.read(8, size))
    entries.pop("__metadata__", None)
    return entries, 8 + size


def read_headers(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, name, dtype, shape, begin, size, header_bytes) of all tensors of the files of a path.

    A task reads the headers of its files and nothing else; header_bytes is what was read of a file. A header that is none,
    or bytes of a tensor that do not fit its shape, type or file, end the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with Counted(name) as file:
                    entries, start = header_of(file)
                    read = file.read_bytes
                out = []
                for tensor, e in sorted(entries.items()):
                    begin, end = e["data_offsets"]
                    n = int(np.prod(e["shape"], dtype=np.int64)) if e["dtype"] in DTYPES else -1
                    if not 0 <= begin <= end <= length - start or n * np.dtype(DTYPES.get(e["dtype"], "u1")).itemsize != end - begin:
                        raise ValueError(f"{name}: {tensor} has {end - begin} bytes at {begin}")
                    out.append((name, tensor, e["dtype"], e["shape"], start + begin, end - begin, read))
                if out:
                    kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], [f.split()[0] for f in ENTRY.split(", ")])

    listed = files(spark, path, pattern)
    return listed.repartition(max(1, spark.sparkContext.defaultParallelism), "path").mapInArrow(run, ENTRY)


def as_matrix(shape: list[int]) -> tuple[int, int]:
    """Rows and columns of a tensor: the last dimension is the columns, the others together the rows."""
    return (int(np.prod(shape[:-1], dtype=np.int64)), int(shape[-1])) if shape else (1, 1)


def numbers(raw: bytes, dtype: str) -> np.ndarray:
    """The numbers of some bytes, as float64."""
    x = np.frombuffer(raw, DTYPES[dtype])
    return (x.astype(np.uint32) << np.uint32(16)).view(np.float32).astype(np.float64) if dtype == "BF16" else x.astype(np.float64)


def stripes_to_tiles(batches: Iterable[pa.RecordBatch], tile_rows: int, tile_columns: int) -> Iterator[pa.RecordBatch]:
    """The tiles of stripes (path, name, dtype, shape, begin, r), by the ranges that hold them."""
    for b in batches:
        for e in b.to_pylist():
            height, width = as_matrix(e["shape"])
            item = np.dtype(DTYPES[e["dtype"]]).itemsize
            top, bottom = e["r"] * tile_rows, min(height, (e["r"] + 1) * tile_rows)
            out = []
            with Counted(e["path"]) as file:
                at = lambda row, column, e=e, width=width, item=item: e["begin"] + (row * width + column) * item
                whole = (bottom - top) * width * item <= STRIPE_BYTES
                stripe = numbers(file.read(at(top, 0), (bottom - top) * width * item), e["dtype"]).reshape(bottom - top, width) if whole else None
                for c in range(max(1, -(-width // tile_columns))):
                    left, right = c * tile_columns, min(width, (c + 1) * tile_columns)
                    tile = stripe[:, left:right] if whole else np.stack([numbers(file.read(at(row, left), (right - left) * item), e["dtype"]) for row in range(top, bottom)])
                    out.append((e["name"], e["dtype"], e["shape"], e["r"], c, bottom - top, right - left, np.ascontiguousarray(tile).ravel()))
                    if not whole or c == -(-width // tile_columns) - 1 or len(out) == 64:
                        yield _tiles(out)
                        out = []
            if out:
                yield _tiles(out)


def read_tiles(entries: DataFrame, tile_rows: int = TILE, tile_columns: int = TILE) -> DataFrame:
    """(name, dtype, shape, r, c, rows, columns, values): the tiles of the tensors that read_headers() told, each read by its ranges.

    A row of the plan is a stripe of `tile_rows` rows. Stripes are dealt to tasks by hash, so a large tensor is read by many tasks. A stripe
    of few bytes is read in one go, another tile by tile, row by row. Tensors of one dimension are one row; those without elements have one
    empty tile.
    """

    height = F.when(F.size("shape") > 0, F.aggregate(F.slice("shape", F.lit(1), F.size("shape") - 1), F.lit(1).cast("long"), lambda a, x: a * x)).otherwise(1)
    stripes = F.greatest(F.lit(1), F.ceil(height / tile_rows))
    plan = entries.select("path", "name", "dtype", "shape", "begin", F.explode(F.sequence(F.lit(0), (stripes - 1).cast("int"))).alias("r"))
    return plan.repartition("path", "name", "r").mapInArrow(lambda batches: stripes_to_tiles(batches, tile_rows, tile_columns), TILE_ROW)


def _tiles(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], [f.split()[0] for f in TILE_ROW.split(", ")])


def tiled(tensors: DataFrame, tile_rows: int = TILE, tile_columns: int = TILE) -> DataFrame:
    """Tiles, as read_tiles() gives them, of a table (name, shape, values) whose tensors are a row each."""
    height = F.when(F.size("shape") > 0, F.aggregate(F.slice("shape", F.lit(1), F.size("shape") - 1), F.lit(1).cast("long"), lambda a, x: a * x)).otherwise(F.lit(1).cast("long"))
    width = F.when(F.size("shape") > 0, F.element_at("shape", -1).cast("long")).otherwise(F.lit(1).cast("long"))
    x = tensors.select("name", F.lit("F64").alias("dtype"), F.col("shape").cast("array<long>").alias("shape"), "values", height.alias("_h"), width.alias("_w"))
    blocks = lambda n, t: F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1), F.ceil(F.col(n) / t)) - 1)
    x = x.withColumn("r", F.explode(blocks("_h", tile_rows))).withColumn("c", F.explode(blocks("_w", tile_columns)))
    rows, columns = F.least(F.lit(tile_rows), F.col("_h") - F.col("r") * tile_rows), F.least(F.lit(tile_columns), F.col("_w") - F.col("c") * tile_columns)
    row = F.transform(F.sequence(F.lit(0).cast("long"), rows - 1), lambda i: F.slice("values", ((F.col("r") * tile_rows + i) * F.col("_w") + F.col("c") * tile_columns + 1).cast("int"), columns.cast("int")))
    return x.select("name", "dtype", "shape", F.col("r").cast("int"), F.col("c").cast("int"), rows.cast("int").alias("rows"), columns.cast("int").alias("columns"), F.when((rows > 0) & (columns > 0), F.flatten(row)).otherwise(F.array().cast("array<double>")).cast("array<double>").alias("values"))


def _packed(dtype: str, values: Column) -> Column:
    """The bytes of numbers, little-endian."""

    @F.pandas_udf("binary")
    def pack(v):  # noqa: ANN001, ANN202
        bits = lambda x: (np.asarray(x, np.float32).view(np.uint32) >> np.uint32(16)).astype("<u2") if dtype == "BF16" else np.asarray(x).astype(DTYPES[dtype])
        return v.map(lambda x: bits(x).tobytes())

    return pack(values)


def write_tensors(tensors: DataFrame, folder: str, dtype: str = "F32") -> None:
    """Tensor files (file, name, shape, values) in a folder: a header each, then its tensors by name.

    Offsets are running sums in a file; a file's pieces stream through one task, so a tensor, not a file, must fit one. BF16 is cut, not rounded.
    """
    item = np.dtype(DTYPES[dtype]).itemsize
    in_order = Window.partitionBy("file").orderBy("name")
    placed = tensors.select("file", "name", "shape", "values", (F.size("values").cast("long") * item).alias("size"))
    placed = placed.withColumn("end", F.sum("size").over(in_order)).withColumn("begin", F.col("end") - F.col("size")).withColumn("place", F.row_number().over(in_order).cast("long"))
    entry = F.struct(F.lit(dtype).alias("dtype"), "shape", F.array("begin", "end").alias("data_offsets"))
    headers = placed.groupBy("file").agg(F.encode(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", entry))))), "utf-8").alias("text"))
    big = F.lpad(F.hex(F.octet_length("text").cast("long")), 16, "0")
    length = F.unhex(F.concat(*(F.substring(big, i, 2) for i in range(15, 0, -2))))
    first = headers.select("file", F.lit(0).cast("long").alias("place"), F.concat(length, F.col("text")).alias("content"))
    write_pieces(first.unionByName(placed.select("file", "place", _packed(dtype, F.col("values")).alias("content"))), folder)


__all__ = ["DTYPES", "TILE", "as_matrix", "header_of", "numbers", "read_headers", "read_tiles", "tiled", "write_tensors"]
