"""Files by ranges, tensors by tiles, documents written and read by many tasks."""

import hashlib
import json
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptoria.operators import tensors
from scriptoria.sources import datasets, fragments, images, jsonparts, ranges, sinks, tensorfiles

# --- ranges and digests


def test_ranges_and_digests(spark, tmp_path):
    """Files of no byte, fewer and more bytes than a chunk and a partition, with every byte in them."""
    rng = np.random.default_rng(1)
    contents = {"none": b"", "one": b"\0", "even": bytes(range(256)) * 4, "odd": rng.bytes(10_001), "line ends": b"\r\n\n\r" * 700}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    for partition, chunk in ((1 << 20, 1 << 20), (512, 512), (1000, 300), (10, 64)):
        got = ranges.read_ranges(spark, str(tmp_path), partition, chunk).orderBy("path", "start").collect()
        joined = {}
        for r in got:
            name = r["path"].rsplit("/", 1)[1].replace("%20", " ")
            assert r["start"] == len(joined.get(name, b"")) and r["start"] % chunk == 0
            joined[name] = joined.get(name, b"") + bytes(r["content"])
        assert joined == {k: v for k, v in contents.items() if v}
    told = {r["path"].rsplit("/", 1)[1].replace("%20", " "): r for r in ranges.digests(spark, str(tmp_path), 64).collect()}
    assert {k: (r["length"], r["sha256"]) for k, r in told.items()} == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in contents.items() if v}


@pytest.mark.parametrize("fanout", [4096, 3])
def test_tree_digest_does_not_depend_on_the_tasks(spark, tmp_path, monkeypatch, fanout):
    monkeypatch.setattr(ranges, "TREE_FANOUT", fanout)
    content = np.random.default_rng(2).bytes(5000)
    (tmp_path / "a").write_bytes(content)
    (tmp_path / "b").write_bytes(b"")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    leaves = [sha(content[i : i + 300]) for i in range(0, 5000, 300)]
    runs = [sha("".join(leaves[i : i + fanout]).encode()) for i in range(0, len(leaves), fanout)]
    for partition in (300, 900, 1 << 20):
        got = {r["path"][-1]: (r["length"], r["digest"]) for r in ranges.tree_digests(spark, str(tmp_path), partition, 300).collect()}
        assert got == {"a": (5000, sha("".join(runs).encode()))}


# --- tensors


def plain_file(path, entries, meta=True):
    """A tensor file written by itself: {name: array}, BF16 as the upper halves."""
    header, body = {"__metadata__": {"format": "np"}} if meta else {}, b""
    for name, (dtype, x) in entries.items():
        raw = (x.astype(np.float32).view(np.uint32) >> 16).astype("<u2").tobytes() if dtype == "BF16" else x.astype(tensorfiles.DTYPES[dtype]).tobytes()
        header[name] = {"dtype": dtype, "shape": list(x.shape), "data_offsets": [len(body), len(body) + len(raw)]}
        body += raw
    text = json.dumps(header).encode()
    path.write_bytes(struct.pack("<Q", len(text)) + text + body)
    return 8 + len(text)


ARRAYS = {"a": ("F32", np.arange(35.0).reshape(5, 7)), "b": ("BF16", np.linspace(-2, 2, 24).reshape(2, 3, 4)), "c": ("I64", np.arange(9)), "d": ("F16", np.ones(())), "e": ("BOOL", np.array([[True, False]])), "f": ("F64", np.zeros((0, 3))), "é": ("U8", np.arange(256).reshape(16, 16))}


def test_only_headers_are_read(spark, tmp_path):
    """A file whose bytes behind the header are not there yet: the counting reader says what was read of it."""
    start = plain_file(tmp_path / "model.safetensors", ARRAYS)
    with ranges.Counted(str(tmp_path / "model.safetensors")) as file:
        entries, begin = tensorfiles.header_of(file)
        assert begin == file.read_bytes == start and set(entries) == set(ARRAYS) and file.size() > start
    got = tensorfiles.read_headers(spark, str(tmp_path)).collect()
    assert {(r["name"], r["dtype"], tuple(r["shape"]), r["header_bytes"]) for r in got} == {(n, t, x.shape, start) for n, (t, x) in ARRAYS.items()}
    assert {r["name"] for r in datasets.read_tensor_header(spark, str(tmp_path)).collect()} == set(ARRAYS)


@pytest.mark.parametrize("broken", [b"\x05", struct.pack("<Q", 1 << 60) + b"{}", struct.pack("<Q", 2) + b"{}"[:1], struct.pack("<Q", 90) + json.dumps({"a": {"dtype": "F32", "shape": [9], "data_offsets": [0, 36]}}).encode().ljust(90)])
def test_broken_headers_end_the_job(spark, tmp_path, broken):
    (tmp_path / "x.safetensors").write_bytes(broken)
    with pytest.raises(Exception, match="header of|bytes at|Expecting"):
        tensorfiles.read_headers(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(("rows", "columns", "stripe"), [(512, 512, 1 << 20), (2, 3, 1 << 20), (2, 3, 0), (1, 1, 0), (4, 100, 0)])
def test_tiles_of_any_size(spark, tmp_path, monkeypatch, rows, columns, stripe):
    plain_file(tmp_path / "model.safetensors", ARRAYS, meta=False)
    tiles = tensorfiles.read_tiles(tensorfiles.read_headers(spark, str(tmp_path)), rows, columns).collect()
    parts = {}
    for t in tiles:
        x = np.asarray(t["values"]).reshape(t["rows"], t["columns"])
        parts.setdefault(t["name"], {})[t["r"], t["c"]] = x
        assert x.shape[0] <= rows and x.shape[1] <= columns
    for name, (dtype, x) in ARRAYS.items():
        found = parts[name]
        whole = np.concatenate([np.concatenate([found[r, c] for c in range(1 + max(c for q, c in found if q == r))], axis=1) for r in range(1 + max(r for r, _ in found))])
        want = tensorfiles.numbers((x.astype(np.float32).view(np.uint32) >> 16).astype("<u2").tobytes(), dtype).reshape(x.shape) if dtype == "BF16" else x.astype(tensorfiles.DTYPES[dtype]).astype(np.float64)
        assert np.array_equal(whole, want.reshape(tensorfiles.as_matrix(list(x.shape)))), name


def test_wide_stripes_are_read_tile_by_tile(tmp_path, monkeypatch):
    """The way for stripes of many bytes gives the same tiles (called in this process, where its bound can be set)."""
    x = np.random.default_rng(3).normal(size=(7, 11))
    start = plain_file(tmp_path / "w.safetensors", {"w": ("F64", x)})
    batch = pa.RecordBatch.from_pylist([{"path": str(tmp_path / "w.safetensors"), "name": "w", "dtype": "F64", "shape": [7, 11], "begin": start, "r": r} for r in range(3)])
    for bound in (0, 1 << 20):
        monkeypatch.setattr(tensorfiles, "STRIPE_BYTES", bound)
        tiles = [t for b in tensorfiles.stripes_to_tiles([batch], 3, 4) for t in b.to_pylist()]
        assert len(tiles) == 9 and all(np.array_equal(np.reshape(t["values"], (t["rows"], t["columns"])), x[t["r"] * 3 : t["r"] * 3 + 3, t["c"] * 4 : t["c"] * 4 + 4]) for t in tiles)


def test_written_tensors_are_read_back(spark, tmp_path):
    rows = [("f1", "x", [2, 2], [1.0, 2.0, 3.5, -4.0]), ("f1", "aé", [3], [0.5, 0.25, 8.0]), ("f2", "x", [], [7.0]), ("f2", "none", [0, 2], [])]
    df = spark.createDataFrame(rows, "file string, name string, shape array<long>, values array<double>")
    for dtype in ("F32", "BF16", "F64"):
        folder = str(tmp_path / dtype)
        tensorfiles.write_tensors(df, folder, dtype)
        got = tensorfiles.read_tiles(tensorfiles.read_headers(spark, folder))
        told = sorted((r["name"], list(r["shape"]), list(r["values"])) for r in got.collect())
        assert told == sorted((n, s, v) for _, n, s, v in rows)
    with pytest.raises(Exception, match="f1|f2"):
        tensorfiles.write_tensors(df, str(tmp_path / "F32"))  # files that are there stay


@pytest.mark.parametrize(("tile_rows", "tile_columns"), [(512, 512), (3, 3), (2, 2), (1, 1)])
@pytest.mark.parametrize("low", [False, True])
def test_tiles_tell_what_whole_tensors_tell(spark, tile_rows, tile_columns, low):
    """Unchanged, adapted, missing, unexpected, wrong values and wrong shapes; a rank of several blocks; bfloat16."""
    rng = np.random.default_rng(4)
    base, merged, adapter = {}, {}, {}
    for i in range(12):
        name, x = f"t{i}.weight", rng.normal(size=(4 + i % 3, 5)).astype(np.float32)
        base[name], merged[name] = x, x.copy()
        if i % 2:
            a, b = rng.normal(size=(5, 3)).astype(np.float32), rng.normal(size=(3, x.shape[0])).astype(np.float32)
            adapter[f"t{i}.lora_A"], adapter[f"t{i}.lora_B"] = a, b
            merged[name] = tensors.merged_weight(x, a, b, 0.5, low)
    merged["t0.weight"] = merged["t0.weight"] + np.float32(1e-3)
    merged["t1.weight"] = merged["t1.weight"] + np.float32(1e-5)
    merged["t3.weight"] = merged["t3.weight"] + np.float32(0.5)
    merged["t2.weight"] = merged["t2.weight"][:, :4]
    del merged["t4.weight"]
    merged["new.weight"] = base["t6.weight"]
    adapter["t7.lora_A"] = adapter["t7.lora_A"][:4]
    base["one.weight"] = merged["one.weight"] = np.arange(5, dtype=np.float32)
    table = lambda d: spark.createDataFrame([(n, list(x.shape), [float(v) for v in x.ravel()]) for n, x in d.items()], "name string, shape array<long>, values array<double>")
    cut = lambda d: tensorfiles.tiled(table(d), tile_rows, tile_columns)
    got = {r["name"]: (r["status"], r["error"]) for r in tensors.reconcile_tiles(cut(base), cut(merged), cut(adapter), 0.5, low).collect()}
    adapter_whole = {k: v for k, v in adapter.items() if not k.startswith("t7.")}
    want = {r["name"]: (r["status"], r["error"]) for r in tensors.reconcile(table(base), table(merged), table(adapter_whole), 0.5, low).collect()}
    want["t7.weight"] = ("mismatch", 0.0)  # halves that do not fit; a product of whole tensors cannot be made
    assert {n: s for n, (s, _) in got.items()} == {n: s for n, (s, _) in want.items()}
    for n, (_, error) in want.items():
        assert (got[n][1] is None) == (error is None) and (error is None or abs(got[n][1] - error) < 1e-5)


# --- documents in parts


HARD = ['"', "\\", '\\"', "{[", "}]", "é😀", "\n", "a", '"}', "\\\\", ",", ":"]
VALUES = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.lists(st.sampled_from(HARD), max_size=4).map("".join), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.lists(st.sampled_from(HARD), max_size=3).map("".join), x, max_size=3), max_leaves=8)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.lists(st.sampled_from(HARD), min_size=1, max_size=3).map("".join), st.lists(st.dictionaries(st.sampled_from(HARD), VALUES, max_size=3), max_size=4) | VALUES, max_size=4), st.integers(1, 17), st.sampled_from([None, 1, "\t"]), st.booleans())
def test_elements_of_any_chunks(document, size, indent, ascii_only):
    """Chunks that begin anywhere, in strings and behind backslashes, give the elements of the lists as a parser does."""
    raw = json.dumps(document, indent=indent, ensure_ascii=ascii_only).encode()

    class Bytes:
        read = staticmethod(lambda start, n: raw[start : start + n])

    state, depth, found, lists = 0, 0, [], []
    for start in range(0, len(raw), size):
        piece = raw[start : start + size]
        elements, names = jsonparts.elements_from(Bytes, start, len(piece), state, depth, ahead=5)
        found, lists = found + elements, lists + names
        _, up, state = jsonparts.scan(piece, state)
        depth += int(up.sum())
    assert (state, depth) == (0, 0)
    got = {name: [] for _, name, is_list in lists if is_list}
    for at, element in found:
        _, name, is_list = max(x for x in lists if x[0] < at)
        if is_list:
            got[name].append(json.loads(element))
    assert got == {k: [x for x in v if isinstance(x, dict)] for k, v in document.items() if isinstance(v, list)}


def test_coco_in_parts_is_the_whole_document(spark, tmp_path):
    """Documents in parts of any size, by many tasks, against Spark's reader of whole documents; strings with all that could mislead."""
    from scriptoria.schema import COCO

    document = {"info": {"a": [{"id": 5}], "b": {"c": 1}}, "images": [{"id": i, "file_name": HARD[i % 12] * (i % 5), "width": i, "height": 2, "more": [[{"x": '"'}]]} for i in range(300)], "licenses": [1, "{", None, []]}
    document |= {"annotations": [{"id": i, "image_id": i % 7, "segmentation": [[0.5, 1.0], []], "bbox": [1.0] * (i % 4)} for i in range(500)], "categories": [{"id": 1, "name": "\\\""}]}
    for k, text in enumerate((json.dumps(document), json.dumps(document, indent=1, ensure_ascii=False))):
        path = tmp_path / f"{k}.json"
        path.write_text(text, encoding="utf-8")
        whole = spark.read.schema(COCO).json(str(path), multiLine=True)
        for size in (97, 1000, 1 << 20):
            for name, got in zip(("images", "annotations", "categories"), datasets.read_coco(spark, str(path), size), strict=True):
                want = whole.select(F.posexplode(name).alias("place", "x")).select("place", "x.*")
                assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert ranges.read_ranges(spark, str(tmp_path / "0.json"), 1000, 1000).rdd.getNumPartitions() > 10


@pytest.mark.parametrize("text", ['{"images":[{"id":1}', '{"images":["a}]', '{"images":[]}}'])
def test_documents_that_are_not_whole(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="not a whole JSON document|does not end"):
        datasets.read_coco(spark, str(tmp_path / "x.json"))[0].collect()


def batch(*contents):
    return pa.RecordBatch.from_arrays([pa.array(list(contents), pa.binary())], ["content"])


def test_two_phases_by_hand(tmp_path, monkeypatch):
    """A task that fails and runs again counts once; until the commit the old file stays; an abort leaves nothing."""
    target = tmp_path / "out.json"
    target.write_text("old")
    writer = fragments.DocumentSink({"path": str(target)}).writer(None, False)
    tasks = iter([(1, 10), (0, 11), (1, 12)])
    monkeypatch.setattr(writer, "_task", lambda: next(tasks))

    def failing():
        yield batch(b"half of ")
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(failing())
    first = writer.write([batch(b"a", b"b"), batch(b"c")])
    second = writer.write([batch(b"d")])
    assert target.read_text() == "old"
    writer.commit([second, None, first])
    assert target.read_text() == "abcd" and [p.name for p in tmp_path.iterdir()] == ["out.json"]

    other = fragments.DocumentSink({"path": str(target)}).writer(None, False)
    message = other.write([batch(b"x")])
    assert len(list(tmp_path.iterdir())) == 2
    other.abort([message, None])
    assert target.read_text() == "abcd" and [p.name for p in tmp_path.iterdir()] == ["out.json"]
    other.abort([])  # once more is no error


def test_files_that_cannot_all_be_moved(tmp_path):
    """A file of the export is there already: those moved before it go again."""
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "b").write_text("old")
    writer = fragments.PiecesSink({"path": str(tmp_path / "out")}).writer(None, False)
    rows = pa.RecordBatch.from_arrays([pa.array(["a", "a", "b"]), pa.array([b"1", b"2", b"3"])], ["file", "content"])
    with pytest.raises(FileExistsError):
        writer.commit([writer.write([rows])])
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["b"] and [p.name for p in tmp_path.iterdir()] == ["out"]
    (tmp_path / "out" / "b").unlink()
    again = fragments.PiecesSink({"path": str(tmp_path / "out")}).writer(None, False)
    again.commit([again.write([rows])])
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {"a": b"12", "b": b"3"}


def test_a_failing_row_leaves_the_old_document(spark, tmp_path):
    """The whole way: a row that cannot be written ends the job, and the document of before stays as the only file."""
    path = tmp_path / "coco.json"
    images = spark.range(1, 4).select("id", F.concat(F.lit("i"), "id").alias("file_name"))
    notes = spark.range(1, 2000).select("id", (F.col("id") % 3 + 1).alias("image_id"))
    sinks.write_coco(images, notes, str(path))
    before = path.read_bytes()
    assert [a["id"] for a in json.loads(before)["annotations"]] == list(range(1, 2000))
    rows = spark.range(0, 1000, 1, 8).select("id", F.when(F.col("id") < 990, "x").otherwise(F.raise_error(F.lit("bad row"))).alias("content"))
    with pytest.raises(Exception, match="bad row"):
        fragments.write_document(rows, ["id"], str(path))
    assert path.read_bytes() == before and [p.name for p in tmp_path.iterdir()] == ["coco.json"]


# --- Arrow files by record batch


def arrow_file(path, table, rows, kind="stream", **options):
    make = pa.ipc.new_stream if kind == "stream" else pa.ipc.new_file
    with pa.OSFile(str(path), "wb") as sink, make(sink, table.schema, options=pa.ipc.IpcWriteOptions(**options)) as writer:
        writer.write_table(table, max_chunksize=rows)


@pytest.mark.parametrize("kind", ["stream", "file"])
@pytest.mark.parametrize("packed", [None, "zstd"])
def test_record_batches_are_dealt_to_tasks(spark, tmp_path, kind, packed):
    """A file of many batches is read by many tasks, to the rows of a whole reader; dictionaries, nulls, nested values, packed bodies, one column alone."""
    from scriptoria.sources import arrowfiles

    n = 500
    table = pa.table({"id": pa.array(range(n)), "text": pa.array([None if i % 7 == 0 else f"é{i}" for i in range(n)]), "label": pa.array([f"k{i % 3}" for i in range(n)]).dictionary_encode(), "image": pa.array([{"bytes": bytes([i % 256]) * (i % 5), "path": None} for i in range(n)])})
    arrow_file(tmp_path / "a.arrow", table, 7, kind, compression=packed)
    arrow_file(tmp_path / "b.arrow", table.slice(0, 3), 7, kind, compression=packed)
    arrow_file(tmp_path / "c.arrow", table.slice(0, 0), 7, kind, compression=packed)
    with ranges.Counted(str(tmp_path / "a.arrow")) as file:
        kinds = [k for k, *_ in arrowfiles.messages(file)]
        assert kinds.count(3) == 72 and kinds[0] == 1 and (packed or file.read_bytes < file.size())
    found = arrowfiles.read_batches(spark, f"{tmp_path}/*.arrow", str(tmp_path / "a.arrow"))
    got = sorted((r["id"], r["text"], r["label"], bytes(r["image"]["bytes"])) for r in found.collect())
    whole = [(r["id"], r["text"], r["label"], r["image"]["bytes"]) for r in table.to_pylist()]
    assert got == sorted([*whole, *whole[:3]], key=lambda r: r[0])
    used = found.select(F.spark_partition_id().alias("p"), "path").where("path like '%a.arrow'").distinct().count()
    assert used > 3
    some = arrowfiles.read_batches(spark, f"{tmp_path}/*.arrow", str(tmp_path / "a.arrow"), ["label"])
    assert some.columns == ["label", "path"] and some.count() == n + 3


def test_arrow_files_that_are_cut_off(spark, tmp_path):
    from scriptoria.sources import arrowfiles

    table = pa.table({"id": pa.array(range(100))})
    arrow_file(tmp_path / "a.arrow", table, 10)
    whole = (tmp_path / "a.arrow").read_bytes()
    (tmp_path / "a.arrow").write_bytes(whole[:-200])
    with pytest.raises(Exception, match="cut off"):
        arrowfiles.read_batches(spark, f"{tmp_path}/*.arrow", str(tmp_path / "a.arrow")).collect()


# --- the first valid records


def test_lines_behind_the_last_record_are_not_read(spark, tmp_path):
    """Of large files a little is read where valid records come early, all where they come late or are too few; numbers and rows are those of reading everything."""
    good = json.dumps({"image_info": [{"image_url": "i", "matched_text_index": 0}], "text_info": [{"text": "OCR:", "tag": "mask"}, {"text": "hello", "tag": "no_mask"}]})
    bad, long_ = "{no record", '{"x": "' + "y" * 5000 + '"}'
    contents = {
        "validation-early.jsonl": "\ufeff" + "\n".join([good, "", bad, good] * 3000) + "\n",
        "validation-late.jsonl": "\n".join([bad] * 900 + [good] * 5),
        "validation-few.jsonl": "\r\n".join([good, bad, long_, good]),
        "validation-none.jsonl": "\n".join([bad, long_]),
    }
    for name, text in contents.items():
        (tmp_path / name).write_bytes(text.encode())
    rows, progress = datasets.first_valid(spark, str(tmp_path), 3, 1 << 10)
    got = {}
    for r in rows.orderBy("file", "line_number").collect():
        got.setdefault(r["file"], []).append(r["line_number"])
    assert got == {"validation-early.jsonl": [1, 4, 5], "validation-late.jsonl": [901, 902, 903], "validation-few.jsonl": [1, 4]}
    read = {r["path"].rsplit("/", 1)[1]: (r["at"], r["length"]) for r in progress.collect()}
    assert read["validation-early.jsonl"][0] <= 1 << 10 < read["validation-early.jsonl"][1] // 100
    assert all(at == length for name, (at, length) in read.items() if "few" in name or "none" in name)
    whole = datasets.read_records(spark, str(tmp_path)).where("error is null").select("file", "line_number").collect()
    for name, numbers in got.items():
        assert numbers == sorted(r["line_number"] for r in whole if r["file"] == name)[:3]
    assert datasets.read_validation(spark, str(tmp_path), 2).where("dataset = 'early'").count() == 2


def test_small_ranges_of_large_files_do_not_become_tasks():
    """Partitions are bounded in number until they hold PARTITION_BYTES; all bytes are in them once, chunks begin at whole multiples."""
    for listed, partition, chunk in (([["a", 800 << 20]], 1 << 14, 1 << 14), ([["a", 6 << 30], ["b", 5]], 1 << 16, 1 << 12), ([[f"f{i}", 1000] for i in range(5000)], 1 << 16, 1 << 12)):
        found = ranges._RangeReader({"files": json.dumps(listed), "partitionBytes": partition, "chunkBytes": chunk}).partitions()
        assert len(found) <= ranges.MOST_PARTITIONS
        places = {}
        for path, start, size in (r for p in found for r in p.ranges):
            assert start % chunk == 0 and start == places.get(path, 0)
            places[path] = start + size
        assert places == dict(listed)


def test_end_of_an_element_is_looked_for_nearby():
    """Behind a chunk little more is read than the rest of its last element."""
    content = b'{"a":[{"x":1},' + b",".join(b'{"y":%d}' % i for i in range(300_000)) + b"]}"
    read = []

    class Bytes:
        def read(self, start, size):
            read.append(len(content[start : start + size]))
            return content[start : start + size]

    found, _ = jsonparts.elements_from(Bytes(), 0, 17, jsonparts.OUTSIDE, 0)
    assert [e for _, e in found] == [b'{"x":1}', b'{"y":0}'] and sum(read) < 10_000


def test_pieces_are_moved_by_tasks_all_or_none(spark, tmp_path):
    """A file that is there or cannot be moved: the folder stays as it was, nothing is left beside it, and the error is the file's own."""
    out = tmp_path / "out"
    out.mkdir()
    (out / "b").write_text("old")
    rows = lambda *r: spark.createDataFrame(r, "file string, place int, content string")
    with pytest.raises(FileExistsError, match="out/b"):
        fragments.write_pieces(rows(("a", 0, "1"), ("b", 0, "2")), str(out))
    with pytest.raises(Exception, match="no-folder"):
        fragments.write_pieces(rows(*((f"f{i}", 0, "1") for i in range(50)), ("no-folder/x", 0, "2")), str(out))
    assert [p.name for p in out.iterdir()] == ["b"] and [p.name for p in tmp_path.iterdir()] == ["out"]
    fragments.write_pieces(rows(("a", 1, "2"), ("c", 0, "x"), ("a", 0, "1")), str(out))
    assert {p.name: p.read_text() for p in out.iterdir()} == {"a": "12", "b": "old", "c": "x"} and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_folders_of_named_files_are_followed_once(tmp_path, monkeypatch):
    """Links out of the root are told by file and by folder, and a folder is followed once for all of its files."""
    root, other = tmp_path / "root", tmp_path / "other"
    root.mkdir()
    other.mkdir()
    picture = images.png(2, 2, bytes(12))
    for i in range(20):
        (root / f"{i}.png").write_bytes(picture)
    (other / "x.png").write_bytes(picture)
    (root / "link.png").symlink_to(other / "x.png")
    (root / "folder").symlink_to(other)
    asked, real = [], images.os.path.realpath
    monkeypatch.setattr(images.os.path, "realpath", lambda p: asked.append(p) or real(p))
    told = lambda name: images.inspected(f"{root}/{name}", str(root))[3]
    assert [told(f"{i}.png") for i in range(20)] == [None] * 20 and len(asked) <= 2
    assert told("link.png") == "outside" and told("folder/x.png") == "outside" and told("gone.png") == "missing"
