"""Compression of vectors to codes: the nearest entries of small codebooks, found by annuli of norms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage
from scriptoria.llm.topk import quantised

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Pairs of rows and entries that are evaluated at a time, and entries next in norm that give the first distance.
PAIRS, NEAR = 1 << 16, 8
#: Components beyond this are taken for this; whole numbers, so that all sums are exact.
LARGEST = 2**62
_LONG = 2**63 - 1


def _exact(a: np.ndarray) -> np.ndarray:
    """float64 where squared distances stay whole numbers below 2**53, else Python's integers."""
    most = max((abs(int(x)) for x in (a.max(initial=0), a.min(initial=0))), default=0)
    return a.astype(np.float64) if 4 * most * most * max(1, a.shape[1]) < 2**52 else a.astype(object)


class Annuli:
    """Entries of a codebook by norm. The nearest entry of a vector has a norm within its distance of the vector's own."""

    def __init__(self, entries: np.ndarray) -> None:
        entries = _exact(entries)
        norms = np.sqrt((entries * entries).sum(1).astype(np.float64))
        self.order = np.argsort(norms, kind="stable")
        self.norms, self.entries = norms[self.order], entries[self.order]
        self.evaluated = 0

    def _distances(self, rows: np.ndarray, at: np.ndarray, entry: np.ndarray) -> np.ndarray:
        self.evaluated += len(at)
        apart = rows[at] - self.entries[entry]
        return (apart * apart).sum(1) if apart.dtype == object else np.einsum("ij,ij->i", apart, apart)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row, ties to the lower index.

        The entries next in norm give a first distance. All entries within it, both ends of the interval of norms
        included, are evaluated, and no others; the interval is a little wider than roots in float64 can err.
        """
        rows = _exact(rows)
        if rows.dtype == object or self.entries.dtype == object:
            rows, self.entries = rows.astype(object), self.entries.astype(object)
        n, m = len(rows), len(self.norms)
        own = np.sqrt((rows * rows).sum(1).astype(np.float64))
        near = min(NEAR, m)
        begin = np.clip(np.searchsorted(self.norms, own) - near // 2, 0, m - near)
        index, best = np.empty(n, np.int64), np.empty(n, rows.dtype)
        for a in range(0, n, PAIRS // near):
            at = np.arange(a, min(n, a + PAIRS // near))
            first = self._distances(rows, np.repeat(at, near), (begin[at][:, None] + np.arange(near)).ravel()).reshape(-1, near)
            best[at] = first.min(1)
        reach = np.sqrt(best.astype(np.float64))
        slack = 1e-9 * (own + reach) + 1e-9
        low, high = np.searchsorted(self.norms, own - reach - slack), np.searchsorted(self.norms, own + reach + slack, "right")
        sizes = high - low  # never 0: what gave the first distance lies in the interval
        ends = np.cumsum(sizes)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
            at = np.repeat(np.arange(a, b), sizes[a:b])
            starts = np.concatenate([[0], np.cumsum(sizes[a:b])[:-1]])
            entry = np.arange(len(at)) - np.repeat(starts, sizes[a:b]) + low[at]
            d = self._distances(rows, at, entry)
            best[a:b] = np.minimum.reduceat(d, starts)
            index[a:b] = np.minimum.reduceat(np.where(d == best[at], self.order[entry], m), starts)
            a = b
        return index, best


def _bounds(width: int) -> list[int]:
    return [p * width // PARTS for p in range(PARTS + 1)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def train(kept: DataFrame, id_col: str, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of the parts, from a table (id_col, q) of whole numbers, all of one length.

    They start as the parts of the rows of least id (null last, then by components). In each round every task adds up the
    parts it assigned to each entry, Spark adds up the tasks' sums, and the driver gets one row for each component of each entry.
    """
    first = kept.select(id_col, "q").orderBy(F.col(id_col).asc_nulls_last(), "q").limit(ENTRIES).collect()
    width = len(first[0]["q"]) if first else 0
    at = _bounds(width)
    if not width:
        return [np.empty((0, 0), np.int64)] * PARTS
    books = [np.array([r["q"][at[p] : at[p + 1]] for r in first], np.int64) for p in range(PARTS)]
    kinds = [("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())]
    for _ in range(rounds):
        shared = kept.sparkSession.sparkContext.broadcast(books)

        def add_up(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            by_norm = [Annuli(b) for b in shared.value]
            counts = [np.zeros(len(b), np.int64) for b in shared.value]
            sums = [np.zeros(b.shape, object) for b in shared.value]
            for batch in batches:
                q = _matrix(batch.column(0), width)
                for p, book in enumerate(by_norm):
                    rows = q[:, at[p] : at[p + 1]]
                    if not len(rows):
                        continue
                    index, _ = book.nearest(rows)
                    counts[p] += np.bincount(index, minlength=len(counts[p]))
                    order = np.argsort(index, kind="stable")
                    begin = np.flatnonzero(np.diff(index[order], prepend=-1))
                    # Halves of 32 bits are added up apart, so that no sum overflows.
                    high, low = rows[order] >> 32, rows[order] & 0xFFFFFFFF
                    sums[p][index[order][begin]] += np.add.reduceat(high, begin).astype(object) * (1 << 32) + np.add.reduceat(low, begin).astype(object)
            found = [(p, e, j, Decimal(int(sums[p][e, j])), int(counts[p][e])) for p in range(PARTS) for e in np.flatnonzero(counts[p]).tolist() for j in range(at[p + 1] - at[p])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*found, strict=True), kinds, strict=True)], [n for n, _ in kinds])

        sums = kept.select("q").mapInArrow(add_up, "part int, entry int, place int, total decimal(38,0), n long").groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for r in sums.collect():
            books[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
        shared.unpersist()
    return books


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def whole_numbers(table: DataFrame, vector_col: str, scale: int, *others: str) -> DataFrame:
    """(others, q) of the rows that take part, written: floor(scale * x) of each component as long."""
    least, most = F.lit(float(-LARGEST)), F.lit(float(LARGEST))
    fine = quantised(table.select(*others, F.col(f"`{vector_col}`").alias("_vector")), "_vector", scale)
    return cut_lineage(fine.select(*others, F.transform("q", lambda x: F.greatest(least, F.least(most, x)).cast("long")).alias("q")))


def encode(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 1024, rounds: int = ROUNDS) -> DataFrame:
    """One row (id_col, code, error, label_error, codebooks_sha256) for each row of `table` that takes part.

    The vectors' components become floor(scale * x), the vectors are cut into 4 parts (as equal as can be), and each part is told by its
    nearest entry in a codebook of 256 (fewer, if the table has fewer rows). `code` has two hex digits a part, `error` the sum of the parts'
    squared distances, `label_error` the sum of errors over all rows of the same label, nulls together; both stop at the largest long.

    Rows whose vector is null, empty or holds null or non-finite components take no part, nor do those of another length than the row of
    least id has. A null id is coded like any, but comes last for the codebooks; repeated rows are coded each, equal distances go to
    the lower entry. Components beyond 2**62 count as 2**62. An empty table gives an empty result. Other columns are not read.
    """
    own = table.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vector"))
    kept = whole_numbers(own, "vector", scale, "id", "label")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "q").select(F.size("q")).first()
    width = first[0] if first else 0
    kept = kept.where(F.size("q") == width)
    books = train(kept, "id", rounds)
    at, shared = _bounds(width), kept.sparkSession.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_norm = [Annuli(b) for b in shared.value]
        for batch in batches:
            if batch.num_rows:
                q = _matrix(batch.column(2), width)
                found = [b.nearest(q[:, at[p] : at[p + 1]]) for p, b in enumerate(by_norm)]
                codes = [bytes(x).hex() for x in np.stack([i for i, _ in found], 1).astype(np.uint8)]
                errors = [min(_LONG, int(sum(int(x) for x in d))) for d in zip(*(d for _, d in found), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["id", "label", "code", "error"])

    types = dict(own.dtypes)
    coded = cut_lineage(kept.select("id", "label", "q").mapInArrow(code, f"id {types['id']}, label {types['label']}, code string, error long"))
    # One row a label, written, so that Spark can split the rows of a hot label in the join.
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    sums = cut_lineage(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")))
    told = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return told.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


__all__ = ["ENTRIES", "PARTS", "ROUNDS", "Annuli", "books_digest", "encode", "train", "whole_numbers"]
