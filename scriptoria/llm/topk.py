"""Exact top-k by inner product: the threshold algorithm over lists sorted by dimension."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage

#: Vectors that one task searches together, and bytes of queries that are sent to the tasks at a time.
BLOCK_ROWS, CHUNK_BYTES = 4096, 32 << 20
#: Entries read from every list before the bound is looked at again.
STRIDE = 64


class SortedLists:
    """A block of integer vectors, with the order of its rows by each component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.by_dim = np.argsort(self.rows, axis=0, kind="stable")

    def top(self, query: np.ndarray, k: int, least: float | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(positions, scores) of the k best rows, ties to the smaller id; entries read by list.

        Every list is read from the end that helps this query. No row that no list has shown yet can score
        more than the sum of the lists' current entries times the query; when that is below the kth score
        found, the search ends. Where it is equal, a row with a smaller id could still come, so it goes on.
        `least` is the kth score that other blocks have given: rows below it are of no use, so the search ends
        as well when the bound is below it, and such rows may be left out.
        """
        n = len(self.ids)
        dims = np.flatnonzero(query)
        if len(dims) == 0:
            best = np.arange(min(k, n))
            return best, np.zeros(len(best), self.rows.dtype), 0
        seen = np.zeros(n, bool)
        best, score = np.empty(0, np.int64), np.empty(0, self.rows.dtype)
        up = query[dims] > 0
        read, left = 0, n
        while read < n and left:
            to = min(n, read + STRIDE)
            block = np.where(up[None, :], self.by_dim[n - to : n - read, dims][::-1], self.by_dim[read:to, dims])
            fresh = np.unique(block[~seen[block]])
            read = to
            if len(fresh):
                seen[fresh] = True
                left -= len(fresh)
                best = np.concatenate([best, fresh])
                score = np.concatenate([score, self.rows[fresh] @ query])
                keep = np.lexsort((best, -score))[:k]
                best, score = best[keep], score[keep]
            bound = (self.rows[block[-1], dims] * query[dims]).sum()
            if len(best) == k and bound < score[-1] or least is not None and bound < least:
                break
        return best, score, read


def _exact(rows: np.ndarray) -> np.ndarray:
    """Whole numbers in a type in which sums of their products are exact: float64 below 2**53 (fast), else Python's integers."""
    if not rows.size or float(np.abs(rows).max()) ** 2 * rows.shape[1] < 2**52:
        return rows
    return np.array([[int(x) for x in r] for r in rows], object)


def quantised(table: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """`table` with a column `q` of floor(scale * x) as doubles, without the rows that take no part."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.where(fine).withColumn("q", F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double")))


def _whole(x: float | int) -> Decimal:
    return Decimal(max(1 - 10**38, min(10**38 - 1, int(x))))


class Best:
    """The k best candidates of each of some queries, over the blocks of vectors that are given one after the other."""

    def __init__(self, queries: list[np.ndarray], k: int) -> None:
        self.queries, self.k = queries, k
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        self.scores: list[np.ndarray] = [np.empty(0)] * len(queries)

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Searches one block for all queries; a query that has k candidates hands the block the score to beat."""
        lists = SortedLists(ids, rows)
        for i, query in enumerate(self.queries):
            if len(query) != rows.shape[1]:
                continue
            at, score, _ = lists.top(query, self.k, self.scores[i][-1] if len(self.ids[i]) == self.k else None)
            if len(at):
                found, scores = np.concatenate([self.ids[i], lists.ids[at]]), np.concatenate([self.scores[i], score])
                keep = np.lexsort((found, -scores))[: self.k]
                self.ids[i], self.scores[i] = found[keep], scores[keep]


def top_k(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024, block_rows: int = BLOCK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row whose id is divisible by `every`.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null
    id, which no result could name; vectors of another length have no product with a query and are no
    candidates of it. Repeated rows are rows of their own: each query leaves out one copy of itself. Scores
    that do not fit 64 bits are clipped to them. Ties go to the smaller id. An empty table gives an empty
    result. Other columns are not read.

    Queries go to every task in chunks of `chunk_bytes`; for each chunk the vectors are read once, where they
    lie, and none is shuffled or copied. A task takes its vectors in blocks of `block_rows`, each with its own
    sorted lists, and hands the kth score of the blocks before to the next as the bound to beat. It tells k + 1
    rows a query, and these are merged. Queries times vectors is the work at worst, as an exact answer has it.
    """
    spark = table.sparkSession
    base = quantised(table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col)).where(F.col(id_col).isNotNull()), vector_col, scale).select("vec_id", "q")
    asked = cut_lineage(base.where(F.col("vec_id") % every == 0).groupBy("vec_id", "q").agg(F.count("*").alias("n")))
    bytes_ = asked.agg(F.sum(8 * F.size("q") + 64)).first()[0] or 0
    chunks = max(1, -(-int(bytes_) // chunk_bytes))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "q", F.lit(7)), F.lit(chunks)).cast("int"))
    vectors = base.select("vec_id", "q")
    schema = "ask long, query_id long, n long, own decimal(38,0), vec_id long, score decimal(38,0)"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.decimal128(38, 0), pa.int64(), pa.decimal128(38, 0)]
    parts: list[DataFrame] = []
    for c in range(chunks):
        shared = spark.sparkContext.broadcast([(r["vec_id"], r["n"], np.array(r["q"])) for r in asked.where(F.col("chunk") == c).collect()])

        def search(batches: Iterator[pa.RecordBatch], shared=shared, first=c << 32) -> Iterator[pa.RecordBatch]:
            best: Best | None = None
            held: dict[int, list[tuple[int, list[float]]]] = {}

            def take(rows: list[tuple[int, list[float]]]) -> None:
                best.add(np.array([r[0] for r in rows], np.int64), _exact(np.array([r[1] for r in rows], np.float64)))

            for b in batches:
                if best is None:
                    best = Best([_exact(q[None, :])[0] for *_, q in shared.value], k + 1)
                for i, q in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    rows = held.setdefault(len(q), [])
                    rows.append((i, q))
                    if len(rows) == block_rows:
                        take(rows)
                        held[len(q)] = []
            if best is None:
                return
            for rows in held.values():
                if rows:
                    take(rows)
            for at, ((i, n, _), query, ids, scores) in enumerate(zip(shared.value, best.queries, best.ids, best.scores, strict=True)):
                m = len(ids)
                if m:
                    columns = [[first + at] * m, [i] * m, [n] * m, [_whole(query @ query)] * m, ids, list(map(_whole, scores))]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["ask", "query_id", "n", "own", "vec_id", "score"])

        parts.append(vectors.mapInArrow(search, schema))
    # Each task tells k + 1 rows of a query. They are cut in two steps, so that no group gathers those of all tasks.
    by = ["ask", "query_id", "n", "own"]
    slim = reduce(DataFrame.unionByName, parts).select(*by, F.struct((-F.col("score")).alias("low"), "vec_id").alias("hit"), F.pmod(F.spark_partition_id(), F.lit(64)).alias("part"))
    first_of = lambda hits, n: F.slice(F.array_sort(F.collect_list(hits)), 1, n)
    some = slim.groupBy(*by, "part").agg(first_of("hit", k + 1).alias("hits")).withColumn("hit", F.explode("hits"))
    best = some.groupBy(*by).agg(first_of("hit", k + 1).alias("hits"))
    # The query itself is among them if it is good enough; it goes, once.
    own = F.struct((-F.col("own")).alias("low"), F.col("query_id").alias("vec_id"))
    at = F.array_position("hits", own).cast("int")
    rest = F.when(at > 0, F.concat(F.slice("hits", F.lit(1), at - 1), F.slice("hits", at + 1, F.lit(k + 1)))).otherwise(F.slice("hits", 1, k))
    ranked = best.withColumn("rest", rest).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("query_id", F.posexplode("rest").alias("rank", "hit"))
    score = F.least(F.greatest(-F.col("hit.low"), F.lit(-(2**63)).cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), score.cast("long").alias("score"))


__all__ = ["SortedLists", "quantised", "top_k"]
