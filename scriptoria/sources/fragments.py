"""Files written by many tasks in two phases: tasks write fragments, the commit puts them in place, an abort leaves nothing.

Fragments carry the task's number and attempt, so a task that ran twice counts once: by the message of the attempt that ended.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from scriptoria.scratch import staged
from scriptoria.sources.ranges import store

_COPY_BYTES = 8 << 20


@dataclass
class _Written(WriterCommitMessage):
    partition: int
    #: (name, staged path), in the order of writing.
    files: list[tuple[str, str]]


class _Staged(DataSourceArrowWriter):
    """What both writers share: a staging folder beside the target, and its removal."""

    def __init__(self, path: str) -> None:
        self.path = path
        folder, _, name = path.rstrip("/").rpartition("/")
        self.stage = f"{folder}/.{name}.staged-{uuid.uuid4().hex}"

    def _at(self, path: str) -> tuple[fs.FileSystem, str]:
        return store(path)

    def _task(self) -> tuple[int, int]:
        context = TaskContext.get()
        return (context.partitionId(), context.taskAttemptId()) if context else (0, 0)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        where, stage = store(self.stage)
        if where.get_file_info(stage).type != fs.FileType.NotFound:
            where.delete_dir(stage)

    def _open(self, partition: int, attempt: int, n: int) -> tuple[pa.NativeFile, str]:
        where, stage = store(self.stage)
        where.create_dir(stage, recursive=True)
        path = f"{stage}/{partition:06d}-{attempt}-{n}"
        return where.open_output_stream(path), path


class _Document(_Staged):
    """Rows (content binary) of ordered partitions, joined to one file."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        partition, attempt = self._task()
        out, path = None, ""
        for batch in iterator:
            if out is None:
                out, path = self._open(partition, attempt, 0)
            for content in batch.column(0):
                out.write(content.as_buffer())
        if out is not None:
            out.close()
        return _Written(partition, [("", path)] if path else [])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Joins the fragments in the order of their partitions beside the target, which is then replaced in one step."""
        where, stage = store(self.stage)
        _, target = store(self.path)
        try:
            where.create_dir(stage, recursive=True)
            with where.open_output_stream(f"{stage}/whole") as out:
                for message in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
                    for _, path in message.files:
                        with where.open_input_stream(path) as fragment:
                            while piece := fragment.read(_COPY_BYTES):
                                out.write(piece)
            if isinstance(where, fs.LocalFileSystem):
                os.replace(f"{stage}/whole", target)
            else:
                where.move(f"{stage}/whole", target)
        finally:
            where.delete_dir(stage)


class _Pieces(_Staged):
    """Rows (file string, content binary), all pieces of a file in one partition and in order, as files of a folder."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        partition, attempt = self._task()
        found: list[tuple[str, str]] = []
        out = None
        for batch in iterator:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not found or found[-1][0] != name:
                    if out is not None:
                        out.close()
                    out, path = self._open(partition, attempt, len(found))
                    found.append((name, path))
                out.write(content.as_buffer())
        if out is not None:
            out.close()
        return _Written(partition, found)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Moves all files into the folder; if one cannot be moved, those moved before it go again."""
        where, target = store(self.path)
        moved: list[str] = []
        try:
            where.create_dir(target, recursive=True)
            for name, path in sorted(f for m in messages if m is not None for f in m.files):
                if where.get_file_info(f"{target}/{name}").type != fs.FileType.NotFound:
                    raise FileExistsError(f"{target}/{name}")
                where.move(path, f"{target}/{name}")
                moved.append(f"{target}/{name}")
        except BaseException:
            for path in moved:
                where.delete_file(path)
            raise
        finally:
            self.abort(messages)


def _write_files(stage: str):
    """A task's part of write_pieces(): rows (file, content), all pieces of a file together and in order, as files of `stage`; a row (file, staged) for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, folder = store(stage)
        context = TaskContext.get()
        prefix = f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}"
        told = lambda files: pa.RecordBatch.from_arrays([pa.array([f[k] for f in files], pa.string()) for k in (0, 1)], ["file", "staged"])
        found: list[tuple[str, str]] = []
        name, out, n = None, None, 0
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None or file != name:
                    if out is not None:
                        out.close()
                    else:
                        where.create_dir(folder, recursive=True)
                    name = file
                    found.append((file, f"{prefix}-{n}"))
                    out = where.open_output_stream(found[-1][1])
                    n += 1
                out.write(content.as_buffer())
            if len(found) > 4096:
                yield told(found[:-1])
                found = found[-1:]
        if out is not None:
            out.close()
        yield told(found)

    return run


def _of_target(target: str, work: Callable[[fs.FileSystem, str, str], bool]):
    """A task that does `work` on (file system, staged path, path in the folder `target`) and tells the files for which it says so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, folder = store(target)
        for b in batches:
            found = [file for file, staged_at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if work(where, staged_at, f"{folder}/{file}")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["file"])

    return run


def _is_there(where: fs.FileSystem, path: str) -> bool:
    return where.get_file_info(path).type != fs.FileType.NotFound


def _move(where: fs.FileSystem, staged_at: str, path: str) -> bool:
    if _is_there(where, staged_at) or not _is_there(where, path):  # else an attempt before this one has moved it
        where.move(staged_at, path)
    return False


def _take_back(where: fs.FileSystem, staged_at: str, path: str) -> bool:
    if not _is_there(where, staged_at) and _is_there(where, path):
        where.delete_file(path)
    return False


class DocumentSink(DataSource):
    """Writes rows (content binary) as one file."""

    @classmethod
    def name(cls) -> str:
        return "one_document"

    def writer(self, schema: object, overwrite: bool) -> DataSourceArrowWriter:
        return _Document(self.options["path"])


class PiecesSink(DataSource):
    """Writes rows (file string, content binary) as files of a folder; the driver gets their names and moves them (write_pieces() leaves that to tasks)."""

    @classmethod
    def name(cls) -> str:
        return "file_pieces"

    def writer(self, schema: object, overwrite: bool) -> DataSourceArrowWriter:
        return _Pieces(self.options["path"])


def write_document(rows: DataFrame, order: list[str], path: str, content: str = "content") -> None:
    """One file out of all rows' contents (text or binary) in an order, written by many tasks.

    Ranges of the order are sorted and written as fragments; the commit joins them. The file that was there stays until then.
    """
    rows.sparkSession.dataSource.register(DocumentSink)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select(F.col(content).cast("binary").alias("content")).write.format("one_document").mode("append").save(path)


def write_pieces(rows: DataFrame, folder: str, file: str = "file", place: str = "place", content: str = "content") -> None:
    """Files of a folder out of pieces: each file's pieces, by place, stream through one task. A file that is there is not overwritten.

    Tasks write the files beside the folder and tasks move them into it, when all are written and none is there; if one cannot be
    moved, those moved before it go again. The files' names are a table: the driver gets none of them.
    """
    where, target = store(folder)
    above, _, name = folder.rstrip("/").rpartition("/")
    stage = f"{above}/.{name}.staged-{uuid.uuid4().hex}"
    # So many tasks in any case: what a small file costs is not told by its bytes, by which Spark would put tasks together.
    tasks = max(1, rows.sparkSession.sparkContext.defaultParallelism * 4)
    dealt = rows.repartition(tasks, file).sortWithinPartitions(file, place)
    try:
        made = staged(dealt.select(F.col(file).alias("file"), F.col(content).cast("binary").alias("content")).mapInArrow(_write_files(stage), "file string, staged string"))
        made = made.repartition(tasks, "file")
        of_all = lambda work: made.mapInArrow(_of_target(folder, work), "file string")
        if _is_there(where, target) and (there := of_all(lambda where, _, path: _is_there(where, path)).take(1)):
            raise FileExistsError(f"{target}/{there[0]['file']}")
        where.create_dir(target, recursive=True)
        try:
            of_all(_move).write.format("noop").mode("overwrite").save()
        except BaseException:
            of_all(_take_back).write.format("noop").mode("overwrite").save()
            raise
    finally:
        if _is_there(where, store(stage)[1]):
            where.delete_dir(store(stage)[1])


__all__ = ["DocumentSink", "PiecesSink", "write_document", "write_pieces"]
