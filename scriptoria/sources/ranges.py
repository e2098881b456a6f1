"""Files of any kind and size by byte ranges: listing, a data source of ranges, digests, and what opens a file in a task.

Spark lists files (their contents stay unread), tasks open them by themselves and seek: local paths, and every store that
pyarrow knows (HDFS and viewfs by libhdfs, object stores).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from contextlib import nullcontext
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of one task, and of one row of it.
PARTITION_BYTES, CHUNK_BYTES = 64 << 20, 4 << 20
#: Partitions up to which smaller ones than PARTITION_BYTES are made, if asked for: beyond, each holds more, so that tasks do not grow in number with the files.
MOST_PARTITIONS = 256
#: Bytes, and rows, of small chunks that go on together.
_BATCH_BYTES, _BATCH_ROWS = 1 << 20, 256


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", path) and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)


class Counted:
    """A file that is read by ranges; `read_bytes` says how much of it was."""

    def __init__(self, path: str) -> None:
        where, at = store(path)
        self._file, self.read_bytes = where.open_input_file(at), 0

    def read(self, start: int, size: int) -> bytes:
        self._file.seek(start)
        out = self._file.read(size)
        self.read_bytes += len(out)
        return out

    def size(self) -> int:
        return self._file.size()

    def close(self) -> None:
        self._file.close()

    def __enter__(self) -> Counted:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length) of the files of a folder or glob. Spark's file listing: no content is read. Spark plans nothing for files without a byte, so these are not told."""
    reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path).select("path", "length")


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder's path as every executor has it: with its store, and from the root. Raises FileNotFoundError where there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    where = path.getFileSystem(conf)
    if not where.exists(path):
        raise FileNotFoundError(folder)
    return where.makeQualified(path).toString().rstrip("/")


def names_in(spark: SparkSession, folder: str, suffixes: tuple[str, ...]) -> DataFrame:
    """(name) of what lies right in a folder and has one of `suffixes` (lower-case, with the dot), whatever its case, dealt to tasks by name. `folder` is qualified().

    files() has the driver hold every file of a folder, and plans a task for a few dozen of them. Here one task goes through the names and
    hands them on, and the driver gets none. A local folder is streamed; of other stores that task holds the list. No file is looked at, so
    folders may be among the names. Names that are no UTF-8 are left out.
    """

    def is_text(name: str) -> bool:
        try:
            return bool(name.encode())
        except UnicodeEncodeError:
            return False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["name"])

        for _ in batches:  # one row
            where, at = store(folder)
            local = isinstance(where, fs.LocalFileSystem)
            held: list[str] = []
            with os.scandir(at) if local else nullcontext(where.get_file_info(fs.FileSelector(at))) as entries:
                for entry in entries:
                    name = entry.name if local else entry.base_name
                    if os.path.splitext(name)[1].lower() in suffixes and is_text(name):
                        held.append(name)
                        if len(held) == 4096:
                            yield told()
                            held = []
            yield told()

    tasks = max(1, spark.sparkContext.defaultParallelism * 4)
    return spark.range(0, 1, 1, 1).mapInArrow(run, "name string").repartition(tasks, "name")


class _Ranges(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int]]) -> None:
        self.ranges = ranges


class _RangeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.files = json.loads(options["files"])
        self.partition, self.chunk = int(options.get("partitionBytes", PARTITION_BYTES)), int(options.get("chunkBytes", CHUNK_BYTES))

    def partitions(self) -> list[InputPartition]:
        """A partition for each `partitionBytes`; where these are more than MOST_PARTITIONS, each holds several, PARTITION_BYTES at most."""
        whole = lambda n: max(self.chunk, n // self.chunk * self.chunk)
        most = max(whole(self.partition), whole(min(PARTITION_BYTES, -(-sum(n for _, n in self.files) // MOST_PARTITIONS) + self.chunk - 1)))
        step = whole(self.partition)
        if sum(-(-length // step) for _, length in self.files) > MOST_PARTITIONS:
            step = most
        ranges = [(path, start, min(step, length - start)) for path, length in self.files for start in range(0, length, step)]
        if len(ranges) <= MOST_PARTITIONS:
            return [_Ranges([r]) for r in ranges] or [_Ranges([])]
        out, held = [], step + 1
        for r in ranges:
            if held + r[2] > step:
                out.append([])
                held = 0
            out[-1].append(r)
            held += r[2]
        return [_Ranges(x) for x in out]

    def read(self, partition: Any) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            columns = zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.binary()), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["path", "start", "content"])

        rows, held = [], 0
        for path, begin, size in partition.ranges:
            with Counted(path) as file:
                for start in range(begin, begin + size, self.chunk):
                    content = file.read(start, min(self.chunk, begin + size - start))
                    if rows and (held + len(content) > _BATCH_BYTES or len(rows) == _BATCH_ROWS):
                        yield told()
                        rows, held = [], 0
                    rows.append((path, start, content))
                    held += len(content)
        if rows:
            yield told()


class FileRanges(DataSource):
    """Byte ranges of files: a partition for each `partitionBytes` (see MOST_PARTITIONS), a row (path, start, content) for each `chunkBytes` of a file.

    Chunks begin at whole multiples of `chunkBytes`, whatever the partitions. Option `files`: JSON of [path, length] pairs.
    """

    @classmethod
    def name(cls) -> str:
        return "file_ranges"

    def schema(self) -> str:
        return "path string, start long, content binary"

    def reader(self, schema: object) -> DataSourceReader:
        return _RangeReader(self.options)


def read_ranges(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(path, start, content) of all files of a path or glob, in chunks. Only the files' names and lengths come to the driver."""
    spark.dataSource.register(FileRanges)
    listed = json.dumps([[r["path"], r["length"]] for r in files(spark, path).collect()])
    return spark.read.format("file_ranges").option("files", listed).option("partitionBytes", partition_bytes).option("chunkBytes", chunk_bytes).load()


def digests(spark: SparkSession, path: str, chunk_bytes: int = 1 << 20) -> DataFrame:
    """(path, length, sha256) of files of any size: a file streams through one task, a chunk at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                digest = hashlib.sha256()
                with Counted(name) as file:
                    for start in range(0, length, chunk_bytes):
                        digest.update(file.read(start, chunk_bytes))
                out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["path", "length", "sha256"])

    listed = files(spark, path)
    return listed.repartition(max(1, spark.sparkContext.defaultParallelism), "path").mapInArrow(run, "path string, length long, sha256 string")


def stretch_lines(places: DataFrame, size: int) -> DataFrame:
    """(path, line_number, value, end) of whole lines of files (path, length, at, lines), from `at` on, behind `lines` lines: about `size` bytes, and on to the end of a line.

    `end` is where the next line begins. A byte-order mark before the first line is taken off; bytes that are no UTF-8 become a sign that says so.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with Counted(r["path"]) as file:
                    content = file.read(r["at"], size)
                    while content and b"\n" not in content[-1:] and r["at"] + len(content) < r["length"]:
                        cut = content.rfind(b"\n")
                        if cut >= 0:
                            content = content[: cut + 1]
                        else:
                            content += file.read(r["at"] + len(content), max(size, len(content)))
                if not content:
                    continue
                text = content.decode("utf-8", "replace")
                if r["at"] == 0:
                    text = text.removeprefix("\ufeff")
                values = re.split("\r\n|\n|\r", text)
                if values[-1] == "":
                    values.pop()
                n, end = len(values), r["at"] + len(content)
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
                for i in range(0, max(1, n), 4096):
                    some = values[i : i + 4096] or [""]
                    columns = ([r["path"]] * len(some), range(r["lines"] + i + 1, r["lines"] + i + 1 + len(some)), some, [end] * len(some))
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["path", "line_number", "value", "end"])

    return places.repartition(max(1, places.sparkSession.sparkContext.defaultParallelism), "path").mapInArrow(run, "path string, line_number long, value string, end long")


#: Chunks whose digests are hashed together on each level of a tree digest.
TREE_FANOUT = 4096


def tree_digests(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(path, length, digest): a digest of each file by many tasks at once, for files that take one task too long.

    Chunks of `chunk_bytes` are hashed where they are read; runs of TREE_FANOUT digests are hashed, and these again, so the
    digest depends on `chunk_bytes` alone.
    """
    chunks = read_ranges(spark, path, partition_bytes, chunk_bytes).select("path", F.floor(F.col("start") / chunk_bytes).alias("at"), F.octet_length("content").cast("long").alias("size"), F.sha2("content", 256).alias("digest"))
    joined = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", c))), lambda s: s[c]), "").cast("binary"), 256).alias(c)
    runs = chunks.groupBy("path", F.floor(F.col("at") / TREE_FANOUT).alias("run")).agg(F.sum("size").alias("size"), joined("digest"))
    return runs.withColumnRenamed("run", "at").groupBy("path").agg(F.sum("size").alias("length"), joined("digest"))


__all__ = ["CHUNK_BYTES", "Counted", "FileRanges", "digests", "files", "names_in", "qualified", "read_ranges", "store", "stretch_lines", "tree_digests"]
