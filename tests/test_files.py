"""Sources and sinks on small files, and rules that need files or single values."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from scriptoria.dims import LABELS
from scriptoria.functions import grammar
from scriptoria.functions import text as t
from scriptoria.operators import audit
from scriptoria.sources import datasets, images, sinks


def test_names_of_shards(spark):
    names = {"train-00000-of-00002.parquet": "train", "validation-00001-of-00002-a_b-9.parquet": "validation", "dev-00000-of-00001-x.y.parquet": "train", "other.parquet": "train"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r["n"]: r["s"] for r in df.select("n", datasets.split_of_file(F.col("n")).alias("s")).collect()} == names


def test_saved_datasets(spark, tmp_path):
    import pyarrow as pa

    table = pa.table({"text": ["a", "b", "c"], "image": pa.array([{"bytes": b"x", "path": None}] * 3, pa.struct([("bytes", pa.binary()), ("path", pa.string())]))})
    for split, n in (("train", 3), ("validation", 1)):
        (tmp_path / "d" / split).mkdir(parents=True)
        (tmp_path / "d" / split / "state.json").write_text("{}")
        with pa.OSFile(str(tmp_path / "d" / split / "data-00000-of-00001.arrow"), "wb") as out, pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table.slice(0, n), max_chunksize=2)
    (tmp_path / "d" / "dataset_dict.json").write_text('{"splits": ["train", "validation"]}')
    rows = datasets.read_dataset(spark, str(tmp_path / "d"))
    train, validation = datasets.train_and_validation(rows)
    assert sorted((r["text"], bytes(r["image"]["bytes"])) for r in train.collect()) == [("a", b"x"), ("b", b"x"), ("c", b"x")] and validation.count() == 1
    alone = datasets.read_dataset(spark, str(tmp_path / "d" / "train"))
    assert alone.columns == ["text", "image", "split", "file"] and {(r["split"], r["file"]) for r in alone.collect()} == {("train", "data-00000-of-00001.arrow")}


def test_natural_order_of_long_numbers(spark):
    names = ["a2", "a10", "a" + "9" * 20, "a1" + "0" * 20, "a1" + "0" * 20 + "1", "a2" + "0" * 24, "ab", "B"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "n string")
    assert [r["n"] for r in df.orderBy(t.natural_key(F.col("n"))).collect()] == names


def test_lines_of_large_files_are_read_in_splits(spark, tmp_path):
    lines = [f"line {i}" if i % 7 else "" for i in range(5000)]
    (tmp_path / "a.txt").write_text("﻿" + "\r\n".join(lines) + "\r\n", encoding="utf-8", newline="")
    (tmp_path / "b.txt").write_text("only\n\nthree")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = datasets.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by = {}
    for r in got:
        by.setdefault(r["file"], []).append((r["line_number"], r["value"]))
    assert sorted(by["a.txt"]) == list(enumerate(lines, 1))
    assert sorted(by["b.txt"]) == [(1, "only"), (2, ""), (3, "three")]


def test_sidecars_and_status(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"version": 2, "status": "edited", "revision": 3, "blocks": []}))
    (tmp_path / "b.json").write_text(json.dumps({"version": 2, "status": "completed", "blocks": [{"id": "x", "order": 0, "text": "t"}]}, indent=1))
    got = {r["stem"]: (r["status"], r["revision"], len(r["blocks"])) for r in images.sidecars(spark, str(tmp_path)).collect()}
    assert got == {"a": ("edited", 3, 0), "b": ("completed", None, 1)}


def test_tensor_indexes(spark, tmp_path):
    (tmp_path / "index.json").write_text(json.dumps({"metadata": {"n": 1}, "weight_map": {"a": "1.bin", "b": "2.bin"}}))
    assert {r["name"]: r["shard"] for r in datasets.read_shard_index(spark, str(tmp_path / "index.json")).collect()} == {"a": "1.bin", "b": "2.bin"}
    header = json.dumps({"__metadata__": {"f": "pt"}, "w": {"dtype": "F32", "shape": [2, 3], "data_offsets": [0, 24]}, "v": {"dtype": "BF16", "shape": [], "data_offsets": [24, 26]}}).encode()
    (tmp_path / "one.tensors").write_bytes(struct.pack("<Q", len(header)) + header + bytes(26))
    got = {r["name"]: (r["shard"], r["dtype"], r["shape"]) for r in datasets.read_tensor_header(spark, str(tmp_path / "one.tensors")).collect()}
    assert got == {"w": ("one.tensors", "F32", [2, 3]), "v": ("one.tensors", "BF16", [])}


def test_prepared_summaries(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("{}\n\n{}\n")
    (tmp_path / "y.jsonl").write_text("{}\n")
    summary = {"tasks": ["ocr"], "task_prompts": {"ocr": "OCR:"}, "train_probabilities": [0.5, 0.5], "sources": [{"file": "x.jsonl", "samples": 2}, {"file": "y.jsonl", "samples": 4}, {"file": "z.jsonl", "samples": 0}]}
    got = {r["file"]: (r["found"], r["problem"]) for r in datasets.check_summary(spark, summary, f"{tmp_path}/*.jsonl").collect()}
    assert got == {"x.jsonl": (2, None), "y.jsonl": (1, "count"), "z.jsonl": (0, None)}
    with pytest.raises(ValueError, match="sum to one"):
        datasets.check_summary(spark, summary | {"train_probabilities": [0.5, 0.4]}, str(tmp_path))


def test_picture_values(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.png").write_bytes(images.png(2, 2, bytes(12)))
    rows = [(1, b"own", "sub/a.png"), (2, None, "sub/a.png"), (3, None, str(tmp_path / "sub" / "a.png")), (4, None, "none.png"), (5, None, None)]
    df = spark.createDataFrame([(i, (b, p)) for i, b, p in rows], "id int, image struct<bytes:binary,path:string>")
    got = {r["id"]: None if r["content"] is None else bytes(r["content"])[:3] for r in images.with_content(df, str(tmp_path)).collect()}
    assert got == {1: b"own", 2: b"\x89PN", 3: b"\x89PN", 4: None, 5: None}
    with pytest.raises(ValueError):
        images.png(2, 2, b"x")


def test_bodies_that_are_cut_off():
    good = images.png(30, 20, bytes(range(60)) * 30)
    images.check_body(good)
    jpeg = b"\xff\xd8\xff\xc0\x00\x0b\x08\x00\x0a\x00\x14\x01\x01\x11\x00\xff\xda\x00\x02ab\xff\xd9"
    images.check_body(jpeg)
    for broken in (good[:-20], good[:60] + b"x" + good[61:], jpeg[:-2], b"GIF89a" + bytes(20), b"RIFF" + struct.pack("<I", 900) + b"WEBPVP8 "):
        with pytest.raises(ValueError):
            images.check_body(broken)


def test_coco_document(spark, tmp_path):
    pictures = spark.createDataFrame([(2, "b.png", 5, 6), (1, "a\".png", 5, 6)], "id long, file_name string, width long, height long")
    notes = spark.createDataFrame([(1, 2, 3, [[0.0, 0.0, 1.0, 0.0, 1.0, 1.0]])], "id long, image_id long, category_id long, segmentation array<array<double>>")
    path = tmp_path / "train.json"
    sinks.write_coco(pictures, notes, str(path))
    doc = json.loads(path.read_text())
    assert [i["id"] for i in doc["images"]] == [1, 2] and doc["annotations"][0]["image_id"] == 2 and [c["name"] for c in doc["categories"]] == list(LABELS)
    back = datasets.read_coco(spark, str(path))
    assert [df.count() for df in back] == [2, 1, 25]
    sinks.write_coco(pictures.limit(0), notes.limit(0), str(path))
    assert json.loads(path.read_text())["images"] == []


def test_yaml(tmp_path):
    value = {"a": 1, "b": {"c": [1, {"d": "x: y"}], "e": {}}, "f": [], "g": None, "h": "é"}
    assert sinks.yaml_text(value) == 'a: 1\nb:\n  c:\n    - 1\n    -\n      d: "x: y"\n  e: {}\nf: []\ng: null\nh: "é"\n'
    sinks.write_yaml(str(tmp_path / "c.yaml"), value)
    assert (tmp_path / "c.yaml").read_text(encoding="utf-8") == sinks.yaml_text(value)


def test_audit_document(spark):
    pictures = spark.createDataFrame([("train", 1, "a", 9, 9, True), ("train", 2, "b", 9, 9, True), ("validation", 2, "c", 9, 0, True)], "split string, id long, file_name string, width int, height int, exists boolean")
    notes = spark.createDataFrame([("train", 1, 1, 3, [0.0, 0.0, 4.0, 4.0], [[0.0, 0.0, 4.0, 0.0, 4.0, 4.0]], 8.0, 0), ("train", 2, 1, 3, [0.0, 0.0, 4.0, 4.0], [[0.0, 0.0, 4.0, 0.0, 4.0, float("nan")]], 8.0, 1)], "split string, id long, image_id long, category_id long, bbox array<double>, segmentation array<array<double>>, area double, read_order int")
    files = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    doc = json.loads(audit.full_report(pictures, notes, files).first()[0])
    assert doc["splits"] == [{"split": "train", "images": 2, "annotations": 2, "problems": 1}, {"split": "validation", "images": 1, "annotations": 0, "problems": 1}]
    assert doc["classes"] == [{"split": "train", "label": "aside_text", "n": 2}] and (doc["shared_ids"], doc["shared_names"]) == (1, 0) and len(doc["fingerprint"]) == 64


def test_alignment_of_charts():
    model = {"headers": ["a", "b"], "alignments": ["none", "left"], "rows": [["1", "2"]]}
    assert grammar.align_chart(model, 0, "right")["alignments"] == ["right", "left"] and grammar.align_chart(model, 5, "left") == model
    with pytest.raises(ValueError):
        grammar.align_chart(model, 0, "middle")


def test_alphabet_is_whole_or_refused(spark, tmp_path):
    file = tmp_path / "alphabet.txt"
    file.write_text("\n".join(map(str, range(200_001))))
    with pytest.raises(ValueError, match="200000"):
        datasets.read_alphabet(spark, str(file))
    file.write_text("b\na\nb")
    assert datasets.read_alphabet(spark, str(file)) == " ab"
