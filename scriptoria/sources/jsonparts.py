"""Large JSON documents read by many tasks: the elements of the lists that an object holds, found from inside the document.

A task cannot tell where it is: a brace may stand in a string. So each chunk of bytes is read under all three states it can
begin in (outside a string, in one, behind a backslash in one); the chunks' changes of state and depth are put one after the other, and a
second pass, which knows how each chunk begins, takes the elements that begin in it, to their ends.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.scratch import staged
from scriptoria.sources.ranges import CHUNK_BYTES, PARTITION_BYTES, Counted, read_ranges

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
#: Bytes before a list in which its name must be found.
NAME_BYTES = 1 << 16
#: Bytes that are read first behind a chunk for the end of its last element.
_AHEAD = 1 << 10
_QUOTE, _BACKSLASH, _OPEN, _CLOSE = 34, 92, (91, 123), (93, 125)


def scan(content: bytes, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places of braces and brackets outside strings, +1 or -1 for each, state behind the last byte) of bytes that begin in `state`."""
    b = np.frombuffer(content, np.uint8)
    pending = int(state == ESCAPED)
    quotes = np.flatnonzero(b == _QUOTE)
    slashes = np.flatnonzero(b == _BACKSLASH)
    tail = 0
    if len(slashes) or pending:
        other = np.maximum.accumulate(np.concatenate([[-1], np.where(b == _BACKSLASH, -1, np.arange(len(b)))]))  # the last byte before each place that is no backslash
        run = np.arange(len(b) + 1) - 1 - other + np.where(other == -1, pending, 0)
        quotes = quotes[run[quotes] % 2 == 0]
        tail = int(run[-1] % 2)
    begun = int(state != OUTSIDE)
    marks = np.flatnonzero((b == _OPEN[0]) | (b == _OPEN[1]) | (b == _CLOSE[0]) | (b == _CLOSE[1]))
    marks = marks[(np.searchsorted(quotes, marks) + begun) % 2 == 0]
    up = np.where((b[marks] == _OPEN[0]) | (b[marks] == _OPEN[1]), 1, -1)
    inside = (len(quotes) + begun) % 2
    return marks, up, (ESCAPED if tail else INSIDE) if inside else OUTSIDE


def _changes(chunks: DataFrame) -> DataFrame:
    """(path, start, size, ends, depths): the state behind a chunk and its change of depth for each state it can begin in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[scan(content, s) for s in (OUTSIDE, INSIDE, ESCAPED)] for content in b.column(2).to_pylist()]
            ends, depths = [[end for *_, end in f] for f in found], [[int(up.sum()) for _, up, _ in f] for f in found]
            sizes = [len(c.as_py()) for c in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int32())), pa.array(depths, pa.list_(pa.int64()))], ["path", "start", "size", "ends", "depths"])

    return chunks.mapInArrow(run, "path string, start long, size long, ends array<int>, depths array<long>")


def _begins(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state and depth in which each chunk of one document begins: one small row a chunk, put one after the other."""
    pdf = pdf.sort_values("start")
    state, depth, states, depths = OUTSIDE, 0, [], []
    for ends, changes in zip(pdf["ends"], pdf["depths"], strict=True):
        states.append(state)
        depths.append(depth)
        state, depth = int(ends[state]), depth + int(changes[state])
    if state != OUTSIDE or depth != 0:
        raise ValueError(f"{pdf['path'].iloc[0]}: not a whole JSON document")
    return pd.DataFrame({"path": pdf["path"], "start": pdf["start"], "size": pdf["size"], "state": states, "depth": depths})


def name_before(file: Counted, at: int) -> str:
    """The name that stands before a value."""
    text = file.read(max(0, at - NAME_BYTES), min(at, NAME_BYTES)).rstrip()
    if not text.endswith(b":"):
        raise ValueError(f"no name before {at}")
    text = text[:-1].rstrip()
    begin = len(text) - 1
    while True:  # back to a quote that an even number of backslashes precede
        begin = text.rfind(b'"', 0, begin)
        if begin < 0:
            raise ValueError(f"a name of more than {NAME_BYTES} bytes before {at}")
        if (begin - len(text[:begin].rstrip(b"\\"))) % 2 == 0:
            return json.loads(text[begin:])


def elements_from(file: Counted, start: int, size: int, state: int, depth: int, ahead: int = 1 << 20) -> tuple[list[tuple[int, bytes]], list[tuple[int, str, bool]]]:
    """Of a chunk that begins so: (place, bytes) of the objects on depth 3 that begin in it, and (place, name, is a list) of what the document's object holds.

    An object that goes on behind the chunk is read to its end, in pieces that grow up to `ahead` bytes.
    """
    content = file.read(start, size)
    marks, up, end = scan(content, state)
    after = depth + np.cumsum(up)
    begin = marks[(up == 1) & (after == 3)]
    begin = begin[[content[i] == 123 for i in begin]] if len(begin) else begin
    close = marks[(up == -1) & (after == 2)]
    lists = [(start + int(i), name_before(file, start + int(i)), content[i] == 91) for i in marks[(up == 1) & (after == 2)]]
    found = []
    for i in begin.tolist():
        at = np.searchsorted(close, i)
        if at < len(close):
            found.append((start + i, content[i : close[at] + 1]))
            continue
        pieces, level, place, step = [content[i:]], int(after[-1]), start + size, min(ahead, _AHEAD)
        while level > 2:
            more = file.read(place, step)
            step = min(ahead, 4 * step)
            if not more:
                raise ValueError(f"an element at {start + i} does not end")
            marks_, up_, end = scan(more, end)
            levels = level + np.cumsum(up_)
            done = np.flatnonzero(levels == 2)
            if len(done):
                pieces.append(more[: marks_[done[0]] + 1])
                break
            pieces.append(more)
            level, place = int(levels[-1]) if len(levels) else level, place + len(more)
        found.append((start + i, b"".join(pieces)))
    return found, lists


def read_elements(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(path, name, place, element): the objects in the lists of a document's object, each as JSON, by the list's name and numbered from 0 in it.

    Values that are no lists of objects are passed over. A document that is not whole ends the job.
    """
    chunks = staged(_changes(read_ranges(spark, path, partition_bytes, chunk_bytes)))
    begun = staged(chunks.groupBy("path").applyInPandas(_begins, "path string, start long, size long, state int, depth long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with Counted(r["path"]) as file:
                    found, lists = elements_from(file, r["start"], r["size"], r["state"], r["depth"])
                rows = [(r["path"], r["start"], at, None, element.decode("utf-8")) for at, element in found] + [(r["path"], r["start"], at, name if is_list else "", None) for at, name, is_list in lists]
                for i in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + 4096], strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["path", "start", "at", "name", "element"])

    told = staged(begun.repartition(max(1, spark.sparkContext.defaultParallelism), "path", "start").mapInArrow(run, "path string, start long, at long, name string, element string"))
    # A document's object holds few values: where each begins, and so which list an element is in.
    lists = told.where("name is not null").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("lists"))
    own = F.element_at(F.filter("lists", lambda x: x["at"] < F.col("at")), -1)["name"]
    elements = told.where("element is not null").join(lists, "path").select("path", "start", "at", own.alias("name"), "element").where("name <> ''")
    by = ["path", "name"]
    before = elements.groupBy(*by, "start").agg(F.count("*").alias("n"))  # a row for each chunk and list in it
    before = before.select(*by, "start", (F.sum("n").over(Window.partitionBy(*by).orderBy("start")) - F.col("n")).alias("before"))
    own_place = F.row_number().over(Window.partitionBy(*by, "start").orderBy("at")) - 1  # no more than a chunk's
    return elements.withColumn("own", own_place).join(before, [*by, "start"]).select("path", "name", (F.col("before") + F.col("own")).alias("place"), "element")


__all__ = ["elements_from", "name_before", "read_elements", "scan"]
