"""What the engine writes: ledgers, label files, training records, manifests, exports and configurations."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.dims import LABELS
from scriptoria.functions import geometry as g
from scriptoria.functions import text as t
from scriptoria.scratch import staged
from scriptoria.sources.fragments import write_document


def write_rejections(rows: DataFrame, path: str) -> None:
    """The ledger as JSON lines, details cut to what is kept of them."""
    rows.withColumn("detail", t.detail(F.col("detail"))).write.json(path)


def write_recognition_labels(rows: DataFrame, path: str) -> None:
    """path TAB text lines."""
    rows.select(F.concat_ws("\t", "image_path", "target").alias("value")).write.text(path)


def label_json(labels: Column) -> Column:
    """Compact JSON of detection labels."""
    return F.to_json(F.transform(labels, lambda b: F.struct(b["transcription"], b["points"])))


def write_detection_labels(rows: DataFrame, path: str) -> None:
    """path TAB json lines."""
    rows.select(F.concat_ws("\t", F.col("path"), label_json(F.col("labels"))).alias("value")).write.text(path)


def training_record(image: Column, prompt: Column, target: Column) -> Column:
    """A training record as JSON: one image, the masked prompt, and the target that is learnt."""
    texts = F.array(F.struct(prompt.alias("text"), F.lit("mask").alias("tag")), F.struct(target.alias("text"), F.lit("no_mask").alias("tag")))
    return F.to_json(F.struct(F.array(F.struct(image.alias("image_url"), F.lit(0).alias("matched_text_index"))).alias("image_info"), texts.alias("text_info")))


def write_training(rows: DataFrame, path: str) -> None:
    """Training records by source and split."""
    out = rows.select("source", "split", training_record(F.col("image_path"), F.col("prompt"), F.col("target")).alias("value"))
    out.write.partitionBy("source", "split").text(path)


def write_manifest(pages: DataFrame, path: str) -> None:
    """Pages with their text and blocks as JSON lines; no revision and no metadata."""
    pages.select("image", "width", "height", "text", "blocks").write.json(path)


def page_label(blocks: Column) -> Column:
    """A page's detection label: texts and whole points (half to even) by order, 'text' where there is no text."""
    from scriptoria.operators.annotate import in_order

    return F.to_json(F.transform(in_order(blocks), lambda b: F.struct(F.when(t.is_blank(b["text"]), "text").otherwise(b["text"]).alias("transcription"), F.transform(b["polygon"], lambda p: F.transform(p, lambda v: F.bround(v).cast("int"))).alias("points"))))


def crops(pages: DataFrame, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """A row a block with a task of completed pages: page, split, box, prompt, target. Pages go to a split as wholes.

    A bad target fails the whole export, before anything is written.
    """
    from scriptoria.functions.grammar import target_error_of
    from scriptoria.operators.split import by_group

    done = pages.where("status = 'completed'")
    blocks = done.select("page", "width", "height", F.explode("blocks").alias("b")).where(~F.coalesce("b.skipped", F.lit(False)) & F.col("b.task").isNotNull())
    rows = blocks.select("page", "width", "height", F.col("b.order").alias("order"), F.col("b.polygon").alias("polygon"), F.col("b.task").alias("task"), F.col("b.text").alias("target"))
    checked = rows.withColumn("error", target_error_of("target", "task"))
    bad = checked.where("error is not null").orderBy("page", "order").limit(1).collect()
    if bad:
        raise ValueError(f"page {bad[0]['page']}, block {bad[0]['order']}: {bad[0]['error']}")
    split = by_group(rows, "page", ratio, seed).select("page", "split").distinct()
    box = g.crop_box(g.bounds(F.col("polygon")), F.col("width"), F.col("height"))
    return rows.join(split, "page").select("page", "split", "order", box.alias("box"), t.prompt_of(F.col("task")).alias("prompt"), "target")


def coco(pages: DataFrame, ratio: float = 0.1, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(images, annotations) of completed pages that have a block to export, by split.

    Image ids count all pages in their order from 1; annotation ids count each split's blocks from 1. Both are
    numbered by counts of the ranges before them, so no task sorts all rows: blocks of both splits in one go,
    from which each split's first number is then taken.
    """
    from scriptoria.operators.annotate import read_order
    from scriptoria.operators.split import by_group

    done = pages.where("status = 'completed'").select("page", "width", "height", "file_name", read_order(F.col("blocks")).alias("kept"))
    kept = staged(done.where(F.size("kept") > 0))
    if kept.limit(2).count() < 2:
        raise ValueError("a layout export needs two pages at least")
    split = by_group(kept.select("page"), "page", ratio, seed)
    images = staged(numbered_rows(kept, "page", "image_id").join(split, "page"))
    notes = images.select("split", "image_id", F.posexplode("kept").alias("read_order", "b"))
    polygon = F.col("b.polygon")
    category = F.array_position(F.array(*map(F.lit, LABELS)), F.col("b.layout_label")).cast("long")
    notes = notes.select("split", "image_id", "read_order", category.alias("category_id"), F.array(F.flatten(polygon)).alias("segmentation"), g.bounds_xywh(polygon).alias("bbox"), g.area(polygon).alias("area"), F.lit(0).alias("iscrowd"))
    notes = numbered_rows(notes.withColumn("place", F.struct("split", "image_id", "read_order")), "place", "__id")
    first = notes.groupBy("split").agg(F.min("__id").alias("__first"))  # a row a split
    notes = notes.join(first, "split").withColumn("id", F.col("__id") - F.col("__first") + 1).drop("place", "__id", "__first")
    return images.select("split", F.col("image_id").alias("id"), "file_name", "width", "height"), notes


def numbered_rows(rows: DataFrame, order: str, name: str) -> DataFrame:
    """`rows` numbered from 1 in an order: sorted in ranges, which are counted first.

    The ranges are written out with their rows' places before they are counted, so that a lost executor
    cannot cut them anew and number rows twice.
    """
    ranged = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    ranged = staged(ranged.withColumn("__at", F.col("__at") - F.shiftleft(F.col("__part").cast("long"), 33)))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    before = sizes.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # a row a partition
    return ranged.join(before, "__part").withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def stage_images(rows: DataFrame, path: str, content: str = "content") -> None:
    """Each distinct picture once, as (sha256, content): a copy is told by its digest."""
    rows.where(F.col(content).isNotNull()).select(F.sha2(content, 256).alias("sha256"), F.col(content).alias("content")).dropDuplicates(["sha256"]).write.parquet(path)


def write_coco(images: DataFrame, annotations: DataFrame, path: str) -> None:
    """One split's COCO document: images and annotations by id, each id once, and the taxonomy.

    Ranges of rows are written by many tasks and joined when all are there; a failure leaves what was there before.
    """
    spark = images.sparkSession
    part = lambda n, text: spark.range(1).select(F.lit(n).alias("part"), F.lit(0).cast("long").alias("id"), F.lit(text).alias("content"))
    categories = json.dumps([{"id": i, "name": x} for i, x in enumerate(LABELS, 1)])
    rows = part(0, '{"images":[').unionByName(part(2, '],"annotations":[')).unionByName(part(4, f'],"categories":{categories}}}\n'))
    for n, table in ((1, staged(images)), (3, staged(annotations))):
        first = table.agg(F.min("id")).first()[0]
        comma = F.when(F.col("id") == first, "").otherwise(",")
        rows = rows.unionByName(table.select(F.lit(n).alias("part"), F.col("id").cast("long").alias("id"), F.concat(comma, F.to_json(F.struct("*"))).alias("content")))
    write_document(rows, ["part", "id"], path)


def yaml_text(value: object, indent: int = 0) -> str:
    """A configuration as YAML: mappings and lists in block form, everything else as JSON scalars, which YAML reads as they are."""
    pad = "  " * indent
    if isinstance(value, dict) and value:
        return "".join(f"{pad}{k}:" + (f"\n{yaml_text(v, indent + 1)}" if isinstance(v, (dict, list)) and v else f" {json.dumps(v, ensure_ascii=False)}\n") for k, v in value.items())
    if isinstance(value, list) and value:
        return "".join(f"{pad}-" + (f"\n{yaml_text(v, indent + 1)}" if isinstance(v, (dict, list)) and v else f" {json.dumps(v, ensure_ascii=False)}\n") for v in value)
    return f"{pad}{json.dumps(value, ensure_ascii=False)}\n"


def write_yaml(path: str, value: dict) -> None:
    write_file(path, yaml_text(value))


def write_file(path: str, content: str) -> None:
    """A small file, written whole or not at all."""
    target = Path(path)
    handle, temporary = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as out:
            out.write(content)
            out.flush()
            os.fsync(out.fileno())
        os.replace(temporary, target)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def write_json(path: str, value: dict) -> None:
    write_file(path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def write_all_or_nothing(tables: dict[str, DataFrame], folder: str) -> None:
    """Several tables as one export: they are written beside the folder, which then takes their place in one step.

    For folders on one file system that renames as one step, as local ones and HDFS do.
    """
    spark = next(iter(tables.values())).sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final, staged = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(f"{folder}.staged")
    fs = final.getFileSystem(conf)
    if fs.exists(final):
        raise FileExistsError(folder)
    fs.delete(staged, True)
    try:
        for name, rows in tables.items():
            rows.write.parquet(f"{folder}.staged/{name}")
        if not fs.rename(staged, final):
            raise OSError(f"cannot rename {folder}.staged")
    finally:
        fs.delete(staged, True)


def check_unchanged(before: dict, after: dict, keys: tuple[str, ...] = ("Architecture", "Loss", "Transforms")) -> None:
    """Parts of a training configuration that must not change."""
    if changed := [k for k in keys if before.get(k) != after.get(k)]:
        raise ValueError(f"changed parts of the configuration: {changed}")
