import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from scriptoria.schema import BLOCK
from scriptoria.sources import datasets, images, sinks
from scriptoria.streaming import revisions


def png(w, h):
    body = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + body + struct.pack(">I", zlib.crc32(b"IHDR" + body))


def test_catalogue(spark, tmp_path):
    for name, content in (("p10.png", png(7, 5)), ("p2.png", png(3, 4)), ("bad.jpg", b"no"), ("note.txt", b"")):
        (tmp_path / name).write_bytes(content)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "x.png").write_bytes(png(1, 1))
    got = images.catalogue(spark, str(tmp_path)).collect()
    assert [(r["name"], r["width"], r["height"], r["error"] is None) for r in got] == [("bad.jpg", None, None, False), ("p2.png", 3, 4, True), ("p10.png", 7, 5, True)]
    assert all(len(r["image_id"]) == 24 for r in got)


def test_a_catalogue_is_listed_by_a_task(spark, tmp_path):
    """The driver gets no file. Files without a byte, suffixes of any case and names that Spark hides are told; folders, broken links and names that are no UTF-8 are not."""
    folder = tmp_path / "a folder"
    (folder / "sub.png").mkdir(parents=True)
    for name in ("_a.PnG", ".b.png", "é 10%.png"):
        (folder / name).write_bytes(png(3, 4))
    for name in ("empty.bmp", ".png", "png", "x.png.txt", *(f"n{i}.gif" for i in range(3)), *(f"n{i}.bmp" for i in range(5000))):
        (folder / name).touch()
    (folder / "gone.png").symlink_to(tmp_path / "gone.png")
    (folder / os.fsdecode(b"\xff.png")).touch()
    found = images.catalogue(spark, str(folder))
    assert found.inputFiles() == []
    got = [tuple(r) for r in found.select("name", "width", "height", F.col("error").isNotNull(), "size_bytes", F.unix_millis("modified")).collect()]
    told = {r[0]: r[1:] for r in got}
    assert len(got) == len(told) == 5004 and [r[0] for r in got if r[0][0] == "n"] == [f"n{i}.bmp" for i in range(5000)]
    millis = lambda name: (folder / name).stat().st_mtime_ns // 1_000_000
    assert all(told[name] == (3, 4, False, len(png(3, 4)), millis(name)) for name in ("_a.PnG", ".b.png", "é 10%.png"))
    assert told["empty.bmp"] == (None, None, True, 0, millis("empty.bmp"))
    as_spark_has_it = spark.read.format("binaryFile").option("pathGlobFilter", "*%.png").load(str(folder)).select(F.unix_millis("modificationTime")).first()[0]
    assert as_spark_has_it == millis("é 10%.png")
    with pytest.raises(FileNotFoundError):
        images.catalogue(spark, str(tmp_path / "none"))


def test_dataset_shards(spark, tmp_path):
    for i, name in enumerate(("train-00000-of-00002.parquet", "train-00001-of-00002.parquet", "dev-00000-of-00001.parquet", "test.x.parquet")):
        spark.range(i + 1).selectExpr("id", "'x' as text").toPandas().to_parquet(tmp_path / name)
    rows = datasets.read_dataset(spark, str(tmp_path)).where("file <> 'test.x.parquet'")
    train, validation = datasets.train_and_validation(rows)
    assert (train.count(), validation.count()) == (3, 3)
    with pytest.raises(FileNotFoundError):
        datasets.read_dataset(spark, str(tmp_path / "none"))
    assert datasets.task_column_problem({"a": ["task"], "b": []}) and not datasets.task_column_problem({"a": [], "b": []})


def test_records_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("s", "train", "a.png", "OCR:", "hi"), ("s", "train", "b.png", "Table Recognition:", "no table")], "source string, split string, image_path string, prompt string, target string")
    sinks.write_training(rows, str(tmp_path / "out"))
    records = datasets.read_records(spark, str(tmp_path / "out/source=s/split=train/*.txt"))
    assert sorted((r["image_info"][0]["image_url"], r["error"]) for r in records.collect()) == [("a.png", None), ("b.png", "text_before_cells")] or sorted((r["image_info"][0]["image_url"], r["error"]) for r in records.collect()) == [("a.png", None), ("b.png", "no_cells")]
    (tmp_path / "validation-x.jsonl").write_text("\n".join([json.dumps({"image_info": [{"image_url": "i", "matched_text_index": 0}], "text_info": [{"text": "OCR:", "tag": "mask"}, {"text": f"t{k}", "tag": "no_mask"}]}) for k in range(4)] + ["", "{bad"]))
    read = datasets.read_records(spark, str(tmp_path / "validation-x.jsonl"))
    assert {r["line_number"]: r["error"] for r in read.collect()} == {1: None, 2: None, 3: None, 4: None, 6: "json"}
    assert [(r["dataset"], r["target"]) for r in datasets.read_validation(spark, str(tmp_path / "validation-x.jsonl"), 2).orderBy("line_number").collect()] == [("x", "t0"), ("x", "t1")]


def test_labels_and_coco(spark, tmp_path):
    (tmp_path / "Label.txt").write_bytes(b"\xef\xbb\xbfa.png\t[]\r\n\r\nb.png\t[]\n")
    root, file = datasets.label_source(str(tmp_path))
    assert root == str(tmp_path)
    assert [(r["line_number"], r["value"]) for r in datasets.read_label_lines(spark, file).orderBy("line_number").collect()] == [(1, "a.png\t[]"), (2, ""), (3, "b.png\t[]")]
    (tmp_path / "c.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "a", "width": 2, "height": 3}], "annotations": [], "categories": [{"id": 1, "name": "x"}]}))
    found = datasets.read_coco(spark, str(tmp_path / "c.json"))
    assert [f.count() for f in found] == [1, 0, 1]
    (tmp_path / "abc.txt").write_text("a\n\nb\n")
    assert datasets.read_alphabet(spark, str(tmp_path / "abc.txt")) == " ab"


def pages(spark, n, target="hi"):
    block = ("b", 0, target, [[0.4, 0.0], [5.0, 0.0], [5.0, 5.0], [0.0, 5.0]], None, "layout", "text", "ocr", False, None)
    return spark.createDataFrame([(i, 10, 10, f"{i}.png", "completed", [block]) for i in range(n)], f"page int, width int, height int, file_name string, status string, blocks array<{BLOCK}>")


def test_exports(spark, tmp_path):
    rows = sinks.crops(pages(spark, 10))
    assert rows.count() == 10 and rows.where("split = 'validation'").count() == 1
    found, notes = sinks.coco(pages(spark, 10))
    assert sorted(r["id"] for r in found.collect()) == list(range(1, 11))
    assert sorted((r["split"], r["id"]) for r in notes.collect()) == sorted([("validation", 1), *(("train", i) for i in range(1, 10))])
    with pytest.raises(ValueError):
        sinks.crops(pages(spark, 3, "<td>").withColumn("blocks", F.transform("blocks", lambda b: b.withField("task", F.lit("table")))))
    with pytest.raises(ValueError):
        sinks.coco(pages(spark, 1))
    sinks.write_all_or_nothing({"crops": rows, "images": found}, str(tmp_path / "export"))
    assert spark.read.parquet(str(tmp_path / "export/images")).count() == 10
    with pytest.raises(FileExistsError):
        sinks.write_all_or_nothing({"crops": rows}, str(tmp_path / "export"))
    label = pages(spark, 1).select(sinks.page_label(F.col("blocks")).alias("l")).first()["l"]
    assert json.loads(label) == [{"transcription": "hi", "points": [[0, 0], [5, 0], [5, 5], [0, 5]]}]


def test_small_files(tmp_path):
    sinks.write_json(str(tmp_path / "a.json"), {"b": 1})
    assert json.loads((tmp_path / "a.json").read_text()) == {"b": 1} and len(list(tmp_path.iterdir())) == 1
    with pytest.raises(ValueError):
        sinks.check_unchanged({"Loss": 1}, {"Loss": 2})


def test_stream_equals_replay(spark, tmp_path):
    events = [("a", 1, 0, "edited", "x"), ("a", 2, 5, "edited", "y"), ("a", 3, 1, "completed", "x"), ("a", 4, 2, "completed", "z"), ("b", 1, 0, "draft", "")]
    schema = "key string, seq long, revision long, status string, content string"
    spark.createDataFrame(events, schema).coalesce(1).write.json(str(tmp_path / "in"))
    expected = sorted(map(tuple, revisions.replay(spark.createDataFrame(events, schema)).collect()))
    assert [e[2:] for e in expected] == [("saved", 1, "edited"), ("conflict", 1, "edited"), ("saved", 2, "completed"), ("saved", 3, "edited"), ("saved", 1, "draft")]
    stream = revisions.follow(spark.readStream.schema(schema).json(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("followed").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert sorted(map(tuple, spark.table("followed").collect())) == expected
