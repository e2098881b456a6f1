"""The Merkle manifest, vector codes and nearest neighbours against plain versions."""

import hashlib
import math
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from parity import duck, rows
from pyspark.sql import functions as F

from scriptoria.llm import codes, merkle, neighbours, queries

# --- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def plain_path(levels, i, fanout):
    out = []
    for level in levels[:-1]:
        begin = i // fanout * fanout
        out.append(("".join(level[begin:i]), "".join(level[i + 1 : begin + fanout])))
        i //= fanout
    return out


def plain_manifest(table, fanout):
    """A list of (id, leaf, subroot, root, path) of (id, source, text), in no order."""
    groups = {}
    for row in table:
        groups.setdefault(row[1], []).append((row[0], plain_leaf(row)))
    trees = {}
    for source, leaves in groups.items():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[source] = plain_tree([leaf for _, leaf in leaves], fanout)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    top = plain_tree([trees[s][-1][0] for s in order], fanout)
    return [(i, leaf, trees[s][-1][0], top[-1][0], plain_path(trees[s], at, fanout) + plain_path(top, k, fanout)) for k, s in enumerate(order) for at, (i, leaf) in enumerate(groups[s])]


SOURCES = [None, "", "é", "z", "=", "A"]


@pytest.mark.parametrize(("fanout", "ranges"), [(16, 20_000), (2, 7), (3, 50)])
def test_manifest_against_a_plain_tree(spark, monkeypatch, fanout, ranges):
    """One hot group, groups of one, nulls everywhere, ids that repeat, rows that repeat, a long text, a clashing column."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", ranges)
    table = [(i if i % 9 else None, SOURCES[0 if i % 3 else i % 6], None if i % 5 == 0 else "Ab é" * (i % 4)) for i in range(90)]
    table += [(7, "z", "same")] * 40 + [(1000, "one", "x" * 300_000), (1001, "two", "")]
    docs = spark.createDataFrame([(*r, "clash") for r in table], "doc_id long, source string, text string, path string").repartition(5)
    got = merkle.manifest(docs, ["doc_id", "source", "text"], fanout=fanout).select("doc_id", "leaf", "subroot", "root", "path", merkle.folded(F.col("leaf"), F.col("path")).alias("folded")).collect()
    assert all(r["folded"] == r["root"] for r in got)
    told = sorted((repr((r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]])) for r in got))
    assert told == sorted(map(repr, plain_manifest(table, fanout)))


def test_manifest_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert merkle.manifest(none, ["doc_id", "source", "text"]).count() == 0
    one = merkle.manifest(spark.createDataFrame([(None, None, None)], none.schema), ["doc_id", "source", "text"]).first()
    assert one["leaf"] == one["subroot"] == one["root"] == sha("---") and one["path"] == []


def test_tampering_shows(spark, small):
    got = queries.QUERIES["op13_merkle"](spark, small)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    for r in got.collect():
        text = texts[r["doc_id"]]
        bent = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and text is not None and any("A" <= c <= "Z" for c in text)
        assert r["verified"] != bent


# --- codes


def plain_codes(table, rounds=4):
    """{(id, vector): (code, error)} and the codebooks, of rows (id, whole numbers), by looking at every entry."""
    width = len(table[0][1]) // 4
    cut = lambda q: [tuple(q[p * width : (p + 1) * width]) for p in range(4)]
    books = [[cut(q)[p] for _, q in sorted(table)[:256]] for p in range(4)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda part, book: min((apart(part, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            members = {}
            for _, q in table:
                members.setdefault(near(cut(q)[p], books[p])[1], []).append(cut(q)[p])
            books[p] = [tuple(sum(c) // len(members[i]) for c in zip(*members[i], strict=True)) if i in members else e for i, e in enumerate(books[p])]
    found = {}
    for i, q in table:
        each = [near(part, book) for part, book in zip(cut(q), books, strict=True)]
        found[i, tuple(q)] = "".join(f"{k:02x}" for _, k in each), sum(d for d, _ in each)
    return found, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


@pytest.mark.parametrize("large", [1.0, 2.0**50])
def test_codes_against_every_entry(spark, large):
    """Copies, ties, negative numbers, entries that are never used, numbers beyond 2**53, and rows that take no part."""
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.integers(-3, 3, (300, 8)) / 8, rng.normal(size=(200, 8)), np.zeros((40, 8))]) * large
    table = [(int(i), v.tolist(), None if i % 3 == 0 else f"l{i % 2}") for i, v in enumerate(vectors)]
    bad = [(900, None, "l0"), (901, [1.0, None] * 4, "l0"), (902, [float("nan")] * 8, None), (903, [float("inf")] * 8, "l1"), (904, [], "l1"), (905, [1.0] * 4, "l1")]
    df = spark.createDataFrame([(*r, "clash") for r in table + bad], "vec_id long, embedding array<double>, label string, code string").repartition(5)
    found, digest = plain_codes([(i, [math.floor(1024 * x) for x in v]) for i, v, _ in table])
    got = codes.encode(df).collect()
    by_label = {}
    for i, v, label in table:
        by_label[label] = by_label.get(label, 0) + found[i, tuple(math.floor(1024 * x) for x in v)][1]
    longest = 2**63 - 1
    want = sorted((i, *found[i, tuple(math.floor(1024 * x) for x in v)], by_label[label]) for i, v, label in table)
    want = [(i, code, min(error, longest)) for i, code, error, _ in want]
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    if large == 1.0:
        assert {r["vec_id"]: r["label_error"] for r in got} == {i: by_label[label] for i, _, label in table}
    assert codes.encode(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-40, 40), min_size=3, max_size=3), min_size=1, max_size=40), st.lists(st.lists(st.integers(-60, 60), min_size=3, max_size=3), min_size=1, max_size=30))
def test_annuli_against_every_entry(entries, vectors):
    index, d = codes.Annuli(np.array(entries)).nearest(np.array(vectors))
    for v, i, x in zip(vectors, index, d, strict=True):
        assert (x, i) == min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(entries))


def test_annuli_leave_out_what_is_outside():
    """Where norms differ much, few entries are looked at."""
    entries = np.stack([np.arange(256) * 1000, np.zeros(256, int)], 1)
    book = codes.Annuli(entries)
    index, _ = book.nearest(np.stack([np.arange(1000) * 255 + 3, np.ones(1000, int)], 1))
    assert book.evaluated < 14 * 1000 and index.max() == 255


# --- neighbours


def plain_nearest(table, k, every):
    """{query's place: [(score, id, place)]} by looking at every pair, of rows (id, vector)."""
    out = {}
    for a, (i, q) in enumerate(table):
        if i % every == 0:
            near = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), j, b) for b, (j, v) in enumerate(table) if b != a and len(v) == len(q))
            out[a] = [(-s, j) for s, j, _ in near[:k]]
    return out


def recall_of(got, want):
    """The share of the plain neighbours that were found, queries told by id."""
    hits = total = 0
    for i, near in want:
        total += len(near)
        hits += len({j for _, j in near} & {r["vec_id"] for r in got if r["query_id"] == i})
    return hits / total


def test_hadamard_and_cells():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6, 16))
    h = np.array([[1.0]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(neighbours.hadamard(x), x @ h / 4)
    unit = neighbours.directions(rng.normal(size=(50, 13)))
    assert unit.shape == (50, 16) and np.allclose(np.linalg.norm(neighbours.rotated(unit, 1, 2, 3), axis=1), 1)
    for wanted in (1, 2, 20, 32, 100, 3000):
        along = neighbours.coordinates(unit, 0, 0, wanted)
        code = neighbours.cells(along, 50)
        every = np.arange(np.prod([y.shape[1] for y in along], dtype=int)) if along else np.zeros(1, int)
        if wanted > 1:
            assert wanted / 2 <= len(every) <= 2 * wanted
        for row in range(10):
            own = [neighbours.score([y[row : row + 1] for y in along], np.array([c]))[0] for c in every]
            assert own[code[row]] == max(own)
            for least in (-2.0, 0.1, 0.3, 5.0):
                want = {int(c) for c, s in zip(every, own, strict=True) if s >= min(least, max(own)) - 1e-9}
                assert set(neighbours.probes(along, row, least).tolist()) == want


@pytest.mark.parametrize("shape", [{}, {"cell_rows": 40, "hot_rows": 150, "block_queries": 30, "tables": 6}])
def test_neighbours_against_every_pair(spark, shape):
    """Clusters, a hot group of near copies, exact copies, other lengths and norms, rows that take no part; small cells, nodes and blocks."""
    rng = np.random.default_rng(11)
    spread = rng.normal(size=(900, 16))
    near = spread[0] + 0.05 * rng.normal(size=(500, 16))
    copies = np.repeat(spread[1:2], 60, axis=0)
    table = [(int(i), v.tolist()) for i, v in enumerate(np.concatenate([spread, near, copies, 30 * spread[5:8]]))]
    table += [(5000 + i, rng.normal(size=3).tolist()) for i in range(12)] + [(20, table[20][1]), (40, table[3][1])]
    bad = [(None, [1.0] * 16), (7000, None), (7020, [0.0] * 16), (7040, []), (7060, [1.0, None] * 8), (7080, [float("nan")] * 16), (7100, [float("inf")] * 16)]
    df = spark.createDataFrame([(*r, "clash") for r in table + bad], "vec_id long, embedding array<double>, v string").repartition(7)
    got = neighbours.nearest(df, k=20, every=20, **shape).collect()
    want = plain_nearest(table, 20, 20)
    assert len(got) == sum(len(x) for x in want.values())
    assert recall_of(got, [(table[a][0], x) for a, x in want.items()]) >= 0.9
    by_id = {}
    for i, v in table:
        by_id.setdefault(i, []).append(v)
    for r in got:
        scores = [sum(x * y for x, y in zip(q, v, strict=True)) for q in by_id[r["query_id"]] for v in by_id[r["vec_id"]] if len(q) == len(v)]
        assert min(abs(r["score"] - s) for s in scores) < 1e-9
    once = [r for r in got if r["query_id"] not in (20, 40)]
    for i in {r["query_id"] for r in once}:
        mine = sorted((r for r in once if r["query_id"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        assert i not in {r["vec_id"] for r in mine}
    # Copies: their least ids, without the query itself; only the longer vectors come before them.
    of_copy = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 1400), key=lambda r: r["rank"])]
    short = [i for i in of_copy if i < 1460]
    assert short == [1, *range(1401, 1400 + len(short))] and of_copy[len(of_copy) - len(short) :] == short


def test_a_block_of_cells_gives_one_list_a_query():
    """Of all cells of a block that a query probes it gets its n nearest, once: what a task writes does not grow with the cells."""
    rng = np.random.default_rng(23)
    x, q = rng.normal(size=(3000, 16)), rng.normal(size=(70, 16))
    wanted, n, least = 64.0, 5, 0.3
    code = neighbours.cells(neighbours.coordinates(neighbours.directions(x.copy()), 1, 0, wanted), len(x))
    assert len(np.unique(code)) > 20
    lists = lambda m: pa.array(m.tolist(), pa.list_(pa.float64()))
    members = pa.table({"code": code, "h1": np.arange(len(x)), "ids": pa.array([[i] for i in range(len(x))], pa.list_(pa.int64())), "v": lists(x)})
    asked = pa.table({"table": pa.array([1] * len(q), pa.int32()), "wanted": [wanted] * len(q), "h1": np.arange(len(q)), "h2": np.arange(len(q)), "v": lists(q)})
    got = neighbours._compare(n, 0, least)(members, asked).to_pylist()
    along = neighbours.coordinates(neighbours.directions(q.copy()), 1, 0, wanted)
    assert len(got) == len(q)
    for r in got:
        probed = np.flatnonzero(np.isin(code, neighbours.probes(along, r["q1"], least)))
        want = probed[np.argsort(-(x[probed] @ q[r["q1"]]), kind="stable")][:n].tolist()
        assert [h["vec_id"] for h in r["hits"]] == want


def test_neighbours_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in neighbours.nearest(df).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert neighbours.nearest(df.limit(0)).count() == 0 and neighbours.nearest(df.where("vec_id = 0")).count() == 0


def test_recall_on_the_given_vectors(spark):
    """Directions without any structure, the hardest case: a tenth of the neighbours may be missed."""
    folder = "/root/testdata/sf0.1"
    if not Path(folder).is_dir():
        pytest.skip("no test data here")
    got = queries.QUERIES["op12_neighbours"](spark, folder).collect()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").toPandas()
    x, ids = np.stack(table["embedding"]).astype(np.float64), table["vec_id"].to_numpy()
    want = []
    for a in np.flatnonzero(ids % 20 == 0):
        s = x @ x[a]
        s[a] = -np.inf
        want.append((int(ids[a]), [(float(s[b]), int(ids[b])) for b in np.argsort(-s, kind="stable")[:20]]))
    assert recall_of(got, want) >= 0.9


# --- all of them


@pytest.mark.parametrize("name", ["op11_codes", "op13_merkle"])
def test_rows_match_sql(spark, small, name):
    got, expected = queries.QUERIES[name](spark, small).toPandas(), duck(small).sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)
