"""Approximate nearest neighbours by inner product: cross-polytope hashing, several tables and probes, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage, mix64

#: Hash tables, and the rows that a cell has on average.
TABLES, CELL_ROWS = 4, 512
#: Cells of more rows are hashed again around their centre, DEPTH times in all; what is larger still is searched in blocks.
HOT_ROWS, DEPTH = 4096, 3
#: Queries of which the probes are fitted (least hashes first), and the share of their neighbours that probes have to reach.
SAMPLE, REACHED = 200, 0.95
#: Queries, and vectors, that one task compares at a time: so many, and of so many components in all.
BLOCK_QUERIES, BLOCK_COMPONENTS = 32_768, 1 << 21
#: Blocks into which a node of fewer vectors than these is dealt nonetheless, of HOT_ROWS each.
LEAST_BLOCKS = 32
#: Vectors of norms within this factor are hashed together.
BAND = 1.25


# --- hashing


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled so that lengths stay; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pair = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, table: int, level: int, turn: int) -> np.ndarray:
    """A pseudo-rotation: three times random signs and a Hadamard transform, the signs told by table, level and turn."""
    width = x.shape[1]
    for i in range(3):
        seed = ((table * 64 + level) * 64 + turn) * 4 + i
        signs = 1.0 - 2.0 * (mix64(np.arange(width, dtype=np.uint64) + np.uint64((seed + 1) << 32)) & np.uint64(1)).astype(np.float64)
        x = hadamard(x * signs)
    return x


def polytopes(wanted: float, width: int) -> list[int]:
    """Dimensions of the cross-polytopes whose signed axes together tell about as many cells as wanted; none for one cell."""
    cells, out = wanted, []
    while cells >= 2 * width and len(out) < 8:
        out.append(width)
        cells /= 2 * width
    last = min(width, round(cells / 2))
    return [*out, last] if last >= 1 else out


def _padded(x: np.ndarray) -> np.ndarray:
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def directions(v: np.ndarray, centre: np.ndarray | None = None) -> np.ndarray:
    """Unit vectors (of what is left when the centre is taken away), in a width that is a power of two."""
    v = v / np.abs(v).max(1, keepdims=True)
    v /= np.sqrt((v * v).sum(1, keepdims=True))
    if centre is not None:
        v = v - centre
        length = np.sqrt((v * v).sum(1, keepdims=True))
        v = v / np.where(length > 0, length, 1)
    return _padded(v)


def coordinates(unit: np.ndarray, table: int, level: int, wanted: float) -> list[np.ndarray]:
    """For each cross-polytope the products with its signed axes: column 2a is axis a, column 2a + 1 its opposite."""
    out = []
    for turn, dims in enumerate(polytopes(wanted, unit.shape[1])):
        y = rotated(unit, table, level, turn)[:, :dims]
        out.append(np.stack([y, -y], 2).reshape(len(y), -1))
    return out


def cells(along: list[np.ndarray], n: int) -> np.ndarray:
    """The nearest signed axis of each cross-polytope, as one number."""
    code = np.zeros(n, np.int64)
    for y in along:
        code = code * y.shape[1] + y.argmax(1)
    return code


def score(along: list[np.ndarray], code: np.ndarray) -> np.ndarray:
    """The mean product of each row with the axes of the cell that `code` names; infinite where all rows are one cell."""
    if not along:
        return np.full(len(code), np.inf)
    total = np.zeros(len(code))
    for y in reversed(along):
        total += y[np.arange(len(code)), code % y.shape[1]]
        code = code // y.shape[1]
    return total / len(along)


def probes(along: list[np.ndarray], row: int, least: float) -> np.ndarray:
    """All cells whose score for a query is `least` or more, and its own cell in any case."""
    codes, sums = np.zeros(1, np.int64), np.zeros(1)
    highest = [y[row].max() for y in along]
    need = min(least * len(along), sum(highest)) - 1e-9
    for j, y in enumerate(along):
        sums = sums[:, None] + y[row][None, :]
        keep = sums + sum(highest[j + 1 :]) >= need
        codes = (codes[:, None] * y.shape[1] + np.arange(y.shape[1])[None, :])[keep]
        sums = sums[keep]
    return codes


# --- steps on tables


def _by_kind(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[np.ndarray, list]]:
    """Rows of a batch that are alike in table, cells wanted and length: their places, and these three."""
    column = batch.column(names.index("v"))
    sizes = np.diff(column.offsets.to_numpy())
    table, wanted = batch.column(names.index("table")).to_numpy(), batch.column(names.index("wanted")).to_numpy()
    kind = np.stack([table, wanted, sizes], 1)
    for k in np.unique(kind, axis=0) if len(kind) else ():
        yield np.flatnonzero((kind == k).all(1)), k.tolist()


def _along(batch: pa.RecordBatch, names: list[str], at: np.ndarray, kind: list, level: int) -> list[np.ndarray]:
    table, wanted, _ = kind
    some = batch.take(pa.array(at))
    matrix = lambda c: some.column(names.index(c)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1).astype(np.float64)
    return coordinates(directions(matrix("v"), matrix("centre") if level else None), int(table), level, wanted)


def _hashed(df: DataFrame, level: int) -> DataFrame:
    """`df` (table, wanted, centre, v and others) with `code`, the cell of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = np.zeros(b.num_rows, np.int64)
            for at, kind in _by_kind(b, b.schema.names):
                code[at] = cells(_along(b, b.schema.names, at, kind, level), len(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code)], [*b.schema.names, "code"])

    return df.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", code long")


def _scored(df: DataFrame, level: int) -> DataFrame:
    """(pair, table, score): how well the query `v` points to the cell `code`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows)
            for at, kind in _by_kind(b, b.schema.names):
                out[at] = score(_along(b, b.schema.names, at, kind, level), b.column(b.schema.names.index("code")).to_numpy()[at])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out)], ["pair", "table", "score"])

    return df.select("pair", "table", "wanted", "centre", "v", "code").mapInArrow(run, "pair long, table int, score double")


def _cell() -> Column:
    return F.xxhash64("table", "node", "code")


def _centres(members: DataFrame, hot: DataFrame, cell_rows: int) -> DataFrame:
    """The mean direction of each hot cell: each task adds up its own rows, Spark the tasks' sums by component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            cell, v = b.column(0).to_numpy(), b.column(1)
            sizes = np.diff(v.offsets.to_numpy())
            for c in np.unique(cell):
                at = np.flatnonzero(cell == c)
                width = int(sizes[at[0]])
                unit = directions(v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64))[:, :width]
                sums[int(c), width] = sums.get((int(c), width), 0) + unit.sum(0)
            if len(sums) * max((len(x) for x in sums.values()), default=0) > 1 << 20:
                yield from told(sums)
                sums = {}
        yield from told(sums)

    def told(sums: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (c, width), s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([c] * width), pa.array(np.arange(width, dtype=np.int32)), pa.array(s)], ["cell", "place", "total"])

    some = members.join(hot.select("cell"), "cell", "left_semi").select("cell", "v")
    total = some.mapInArrow(run, "cell long, place int, total double").groupBy("cell", "place").agg(F.sum("total").alias("total"))
    whole = total.groupBy("cell").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda s: s["total"]).alias("total"))
    return whole.join(hot, "cell").select(F.col("cell").alias("node"), "table", (F.col("m") / cell_rows).alias("wanted"), F.transform("total", lambda x: x / F.col("m")).alias("centre"))


_HITS = "array<struct<low:double,vec_id:long,x1:long,copy:int>>"


def _matrix(t: pa.Table, name: str = "v") -> np.ndarray:
    return t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1).astype(np.float64)


def _pointing(asked: pa.Table, q: np.ndarray, level: int, least: float):
    """A function of a cell's code: the queries of one node that probe it, told as probes() tells them."""
    table, wanted = asked.column("table")[0].as_py(), asked.column("wanted")[0].as_py()
    along = coordinates(directions(q, _matrix(asked, "centre") if level else None), table, level, wanted)
    need = np.minimum(least * len(along), sum(y.max(1) for y in along)) - 1e-9 if along else np.full(len(q), -np.inf)

    def told(code: int) -> np.ndarray:
        places = []
        for y in reversed(along):
            places.append(code % y.shape[1])
            code //= y.shape[1]
        total = np.zeros(len(q))
        for y, place in zip(along, reversed(places), strict=True):
            total += y[:, place]
        return np.flatnonzero(total >= need)

    return told


def _enter(level: int, least: float):
    """A task that tells which queries of a node probe which of its hot cells."""

    def run(hot: pa.Table, asked: pa.Table) -> pa.Table:
        found, cell = [], []
        if hot.num_rows and asked.num_rows:
            told = _pointing(asked, _matrix(asked), level, least)
            for c, code in zip(hot.column("cell").to_pylist(), hot.column("code").to_pylist(), strict=True):
                found.append(told(code))
                cell.append(np.full(len(found[-1]), c, np.int64))
        at = np.concatenate([*found, np.empty(0, np.int64)])
        of = lambda name: asked.column(name).to_numpy()[at] if len(at) else np.empty(0, np.int64)
        return pa.table({"node": np.concatenate([*cell, np.empty(0, np.int64)]), "h1": of("h1"), "h2": of("h2")})

    return run


class _Nearest:
    """The n nearest of the vectors `x` of each query `q`, out of pairs that are put to it cell by cell. `bound` is what a later pair has to reach."""

    def __init__(self, x: np.ndarray, q: np.ndarray, ids: pa.Array, x1: np.ndarray, n: int) -> None:
        self.x, self.q, self.x1, self.n = x, q, x1, n
        self.copies, self.ids = np.diff(ids.offsets.to_numpy()), ids.flatten().to_numpy()
        self.of = np.concatenate([[0], np.cumsum(self.copies)])
        self.slack = 1e-10 * np.sqrt((x * x).sum(1)).max() * np.sqrt((q * q).sum(1))
        self.bound = np.full(len(q), -np.inf)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0
        #: query, -score, id, hash of the vector, which of its copies
        self.kept = [np.empty(0, t) for t in (np.int64, np.float64, np.int64, np.int64, np.int64)]

    def put(self, cell: np.ndarray, asking: np.ndarray) -> None:
        vectors = self.x[cell].T
        step = max(1, (1 << 22) // len(cell))
        for a in range(0, len(asking), step):
            some = asking[a : a + step]
            s = self.q[some] @ vectors
            first = np.flatnonzero(np.isneginf(self.bound[some])) if len(cell) > self.n else ()
            if len(first):  # its nth best of this cell is a bound already
                self.bound[some[first]] = np.partition(s[first], len(cell) - self.n, axis=1)[:, len(cell) - self.n] - self.slack[some[first]]
            i, j = np.nonzero(~(s < self.bound[some][:, None]))
            self.waiting.append((some[i], cell[j]))
            self.size += len(i)
            if self.size > 1 << 20:
                self.settle()

    def settle(self) -> None:
        """Ranks what waits, and raises the bounds."""
        i, j = (np.concatenate([w[k] for w in self.waiting] or [np.empty(0, np.int64)]) for k in (0, 1))
        self.waiting, self.size = [], 0
        low = np.zeros(len(i))
        step = max(1, (1 << 22) // self.x.shape[1])
        for a in range(0, len(i), step):  # added up in order, so that a pair has one score wherever it is found
            low[a : a + step] = np.cumsum(self.q[i[a : a + step]] * self.x[j[a : a + step]], axis=1)[:, -1] + 0.0
        at = np.repeat(np.arange(len(i)), self.copies[j])
        copy = np.arange(len(at)) - np.repeat(np.cumsum(self.copies[j]) - self.copies[j], self.copies[j])
        i, j, low = i[at], j[at], -low[at]
        i, low, found, x1, copy = (np.concatenate(c) for c in zip(self.kept, (i, low, self.ids[self.of[j] + copy], self.x1[j], copy), strict=True))
        order = np.lexsort((copy, x1, found, low, i))
        place = np.arange(len(order)) - np.searchsorted(i[order], i[order])
        last = order[place == self.n - 1]
        self.bound[i[last]] = np.fmax(self.bound[i[last]], -low[last] - self.slack[i[last]])
        order = order[place < self.n]
        self.kept = [c[order] for c in (i, low, found, x1, copy)]


def _compare(n: int, level: int, least: float):
    """A task that compares the queries of one block of a node with the cells of one block that they probe, and keeps the n nearest of each."""
    struct = pa.struct([("low", pa.float64()), ("vec_id", pa.int64()), ("x1", pa.int64()), ("copy", pa.int32())])

    def run(members: pa.Table, asked: pa.Table) -> pa.Table:
        if not members.num_rows or not asked.num_rows:
            return pa.table({"q1": pa.array([], pa.int64()), "q2": pa.array([], pa.int64()), "table": pa.array([], pa.int32()), "hits": pa.array([], pa.list_(struct))})
        q, code = _matrix(asked), members.column("code").to_numpy()
        told = _pointing(asked, q, level, least)
        best = _Nearest(_matrix(members), q, members.column("ids").combine_chunks(), members.column("h1").to_numpy(), n)
        order = np.argsort(code, kind="stable")
        for cell in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
            best.put(cell, told(int(code[cell[0]])))
        best.settle()
        i, low, found, x1, copy = best.kept
        there, times = np.unique(i, return_counts=True)
        hits = pa.StructArray.from_arrays([pa.array(low), pa.array(found), pa.array(x1), pa.array(copy.astype(np.int32))], fields=list(struct))
        own = asked.take(pa.array(there))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(times)]).astype(np.int32)), hits)
        return pa.table({"q1": own.column("h1"), "q2": own.column("h2"), "table": own.column("table"), "hits": lists})

    return run


class Index:
    """Vectors in cells of several tables. A cell of many rows is a node of the next level, hashed around its own centre.

    `base` is (h1, h2, v, ids, size, band): each different vector once, with its least ids, and what it is hashed with.
    """

    def __init__(self, base: DataFrame, tables: int = TABLES, cell_rows: int = CELL_ROWS, hot_rows: int = HOT_ROWS, block_queries: int = BLOCK_QUERIES) -> None:
        spark = base.sparkSession
        self.base, self.hot_rows, self.block_queries = base, hot_rows, block_queries
        roots = base.groupBy("size", "band").agg(F.count("*").alias("rows")).join(spark.range(tables).select(F.col("id").cast("int").alias("table")), how="cross")  # one row a table
        self.nodes = [cut_lineage(roots.select("size", "band", "table", F.xxhash64("size", "band").alias("node"), (F.col("rows") / cell_rows).alias("wanted"), F.lit(None).cast("array<double>").alias("centre")))]
        self.levels: list[DataFrame] = []
        self.cells: list[DataFrame] = []
        members = base.join(self.nodes[0], ["size", "band"])
        while True:
            level = len(self.levels)
            members = _hashed(members.select("table", "node", "wanted", "centre", "h1", "h2", "ids", "v"), level)
            members = cut_lineage(members.drop("wanted", "centre").withColumn("cell", _cell()))
            self.levels.append(members)
            self.cells.append(cut_lineage(members.groupBy("cell", "table").agg(F.count("*").alias("m")).withColumn("hot", (F.col("m") > hot_rows) & F.lit(level + 1 < DEPTH))))
            hot = self.cells[-1].where("hot")
            if hot.isEmpty():
                break
            self.nodes.append(cut_lineage(_centres(members, hot, cell_rows)))
            members = members.drop("node", "table", "code").withColumnRenamed("cell", "node").join(self.nodes[-1], "node")

    def fit(self, asked: DataFrame, k: int) -> float:
        """The least score of a cell that queries have to probe, so that probes reach REACHED of the neighbours of a sample.

        The sample's neighbours are found by looking at every vector. A neighbour is reached in a table if on each level the
        query's score of its cell is high enough, and counts by the table where that is easiest.
        """
        spark, n = self.base.sparkSession, k + 1
        sample = [(r["h1"], r["h2"], np.array(r["v"], np.float64)) for r in asked.orderBy(F.xxhash64("h1"), "h1", "h2").select("h1", "h2", "v").limit(SAMPLE).collect()]
        shared = spark.sparkContext.broadcast(sample)

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: list[list[tuple[float, int, int]]] = [[] for _ in shared.value]
            for b in batches:
                v, h1, h2 = b.column(2), b.column(0).to_numpy(), b.column(1).to_numpy()
                sizes = np.diff(v.offsets.to_numpy())
                for width in np.unique(sizes):
                    at = np.flatnonzero(sizes == width)
                    x = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1).astype(np.float64)
                    for i, (_, _, q) in enumerate(shared.value):
                        if len(q) == width:
                            s = x @ q
                            top = np.argpartition(-s, min(n, len(s)) - 1)[:n]
                            best[i] = sorted([*best[i], *((float(-s[j]), int(h1[at[j]]), int(h2[at[j]])) for j in top)])[:n]
            found = [(i, *x) for i, some in enumerate(best) for x in some]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int32(), pa.float64(), pa.int64(), pa.int64()), strict=True)], ["query", "low", "h1", "h2"])

        near = self.base.select("h1", "h2", "v").mapInArrow(look, "query int, low double, h1 long, h2 long")
        near = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("low", "h1", "h2"))).where(F.col("rank") <= n).select("query", "h1", "h2").collect()
        pairs = [(r["query"] * n + i, r["h1"], r["h2"], sample[r["query"]][2].tolist()) for i, r in enumerate(near) if (r["h1"], r["h2"]) != sample[r["query"]][:2]]
        if not pairs:
            return 0.0
        # At most SAMPLE * (k + 1) rows.
        pairs = F.broadcast(spark.createDataFrame([(i, *p[1:]) for i, p in enumerate(pairs)], "pair long, h1 long, h2 long, v array<double>"))
        reach: dict[tuple[int, int], float] = {}
        for level, (members, nodes) in enumerate(zip(self.levels, self.nodes, strict=True)):
            found = members.select("table", "node", "code", "h1", "h2").join(pairs, ["h1", "h2"]).join(nodes.select("table", "node", "wanted", "centre"), ["table", "node"])
            for r in _scored(found, level).collect():
                reach[r["pair"], r["table"]] = min(reach.get((r["pair"], r["table"]), np.inf), r["score"])
        easiest: dict[int, float] = {}
        for (pair, _), s in reach.items():
            easiest[pair] = max(easiest.get(pair, -np.inf), s)
        falling = sorted(easiest.values(), reverse=True)
        least = falling[min(len(falling) - 1, int(np.ceil(REACHED * len(falling))) - 1)]
        return float(least) if np.isfinite(least) else 0.0

    def search(self, asked: DataFrame, least: float, n: int) -> DataFrame:
        """(h1, h2, hits) of the queries `asked` (h1, h2, v, size): the n nearest vectors' ids in the cells that they probe.

        A query goes once to each block of a node's cells, and what it probes is told there: neither its vector nor a list of hits is
        written for each cell. A cell lies in one block, unless it is larger than hot_rows.
        """
        block = F.greatest(F.lit(1), F.least(F.lit(self.block_queries), F.floor(F.lit(BLOCK_COMPONENTS) / F.col("size")).cast("int")))
        each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        columns = ["table", "node", "wanted", "centre", "h1", "h2", "v", "size"]
        probing = asked.join(self.nodes[0], "size").select(*columns)
        parts: list[DataFrame] = []
        for level, (members, cells_) in enumerate(zip(self.levels, self.cells, strict=True)):
            asks = probing.groupBy("table", "node").agg(F.ceil(F.count("*") / F.max(block)).alias("qn"))
            cold = members.join(cells_.where(~F.col("hot")).select("cell", "m"), "cell")
            # Blocks of a small node are smaller, so that tasks share it.
            held = cold.groupBy("table", "node").agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("size"))
            mn = F.greatest(F.ceil(F.col("rows") / block), F.least(F.ceil(F.col("rows") / HOT_ROWS), F.lit(LEAST_BLOCKS)))
            sizes = cut_lineage(held.select("table", "node", mn.alias("mn")).join(asks, ["table", "node"]))
            part = F.pmod(F.xxhash64("h1", F.lit(3)), F.ceil(F.col("m") / self.hot_rows))
            left = cold.join(sizes, ["table", "node"]).select("table", "node", "code", "h1", "ids", "v", F.pmod(F.xxhash64("cell", part), "mn").alias("mb"), each("qn").alias("qb"))
            right = probing.drop("size").join(sizes, ["table", "node"]).withColumn("qb", F.pmod(F.xxhash64("h1", "h2"), "qn")).withColumn("mb", each("mn")).drop("qn", "mn")
            by = ["table", "node", "mb", "qb"]
            parts.append(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_compare(n, level, least), f"q1 long, q2 long, table int, hits {_HITS}"))
            if level + 1 < len(self.levels):
                hot = members.join(cells_.where("hot").select("cell"), "cell").groupBy("cell").agg(F.first("table").alias("table"), F.first("node").alias("node"), F.first("code").alias("code"))
                left = hot.join(asks, ["table", "node"]).withColumn("qb", each("qn")).drop("qn")
                right = probing.drop("size").join(asks, ["table", "node"]).withColumn("qb", F.pmod(F.xxhash64("h1", "h2"), "qn")).drop("qn")
                entered = cut_lineage(left.groupBy("table", "node", "qb").cogroup(right.groupBy("table", "node", "qb")).applyInArrow(_enter(level, least), "node long, h1 long, h2 long"))
                probing = cut_lineage(entered.join(self.nodes[level + 1], "node").join(asked, ["h1", "h2"]).select(*columns))
        hits = parts[0]
        for p in parts[1:]:
            hits = hits.unionByName(p)
        # A vector is in one cell of a table: it can be found twice only by two tables.
        of_table = F.slice(F.sort_array(F.flatten(F.collect_list("hits"))), 1, n).alias("hits")
        best = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("hits")))), 1, n).alias("hits")
        return hits.groupBy("q1", "q2", "table").agg(of_table).groupBy(F.col("q1").alias("h1"), F.col("q2").alias("h2")).agg(best)


def nearest(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, **shape: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows of largest inner product with each row whose id is divisible by `every`.

    Every row is in one cell of each table: the cell of the signed axes that are nearest to its direction. A query probes all cells whose
    axes have a mean product with it above a bound, which is fitted on SAMPLE queries, whose neighbours are found by looking at every row.
    What the probed cells hold is ranked by inner products in double precision. A query that found fewer rows than it could is put to every cell.

    Rows whose id or vector is null, or whose vector is zero, empty or holds null or non-finite components, take no part. Vectors of another length
    than the query's are no candidates. Repeated rows are candidates of each other; equal vectors are stored once, with the k + 1
    least ids, which is all that a query can return of them. Ties go to the smaller id. An empty table gives an empty result. Other columns are not read.
    `shape` is what Index takes.
    """
    n = k + 1
    vector = F.col("v")
    most = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    fine = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v")).where(F.col("vec_id").isNotNull() & fine).where(most > 0)
    rows = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(7), "v")})
    # Half the logarithm of the squares' sum; vectors whose squares leave the range of doubles have a band of their own.
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")
    base = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n).groupBy("h1", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    base = cut_lineage(base.withColumns({"size": F.size("v"), "band": F.when((squares > 0) & (squares < F.lit(float("inf"))), F.round(F.log(squares) / (2 * float(np.log(BAND)))).cast("int"))}).fillna(1 << 30, ["band"]))
    asks = cut_lineage(rows.where(F.col("vec_id") % every == 0).select("vec_id", "h1", "h2"))
    asked = cut_lineage(base.join(asks.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("h1", "h2", "v", "size"))
    index = Index(base, **shape)
    found = cut_lineage(index.search(asked, index.fit(asked, k), n))
    there = base.groupBy("size").agg(F.least(F.sum(F.size("ids")), F.lit(n)).alias("there"))
    short = cut_lineage(asked.join(there, "size").join(found.select("h1", "h2", F.size("hits").alias("got")), ["h1", "h2"], "left").where(F.coalesce("got", F.lit(0)) < F.col("there")).select("h1", "h2", "v", "size"))
    if not short.isEmpty():
        found = found.join(short.select("h1", "h2"), ["h1", "h2"], "left_anti").unionByName(index.search(short, -2.0, n))
    # Written before the join, so that Spark can split the queries of a hot vector.
    found = cut_lineage(found)
    told = asks.join(found, ["h1", "h2"])
    own = F.array_position(F.transform("hits", lambda h: F.struct(h["vec_id"], h["x1"])), F.struct(F.col("vec_id"), F.col("h1").alias("x1"))).cast("int")
    rest = F.when(own > 0, F.concat(F.slice("hits", F.lit(1), own - 1), F.slice("hits", own + 1, F.lit(n)))).otherwise(F.slice("hits", 1, k))
    each = told.select(F.col("vec_id").alias("query_id"), F.posexplode(rest).alias("rank", "hit"))
    return each.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.low")).alias("score"))


__all__ = ["Index", "cells", "coordinates", "directions", "hadamard", "nearest", "polytopes", "probes", "rotated", "score"]
