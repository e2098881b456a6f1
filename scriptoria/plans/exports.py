"""Queries through files: what the sinks write is read back by the sources. The files lie in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions import text as t
from scriptoria.plans.pages import _BLOCKS, _FIELDS, pages, turn_blocks
from scriptoria.plans.rows import table
from scriptoria.registry import query
from scriptoria.scratch import new_folder
from scriptoria.sources import datasets, images, sinks
from scriptoria.sources.fragments import write_document


@query("SELECT doc_id, length(left(text, 500)) AS n, sha256(left(text, 500)) AS detail_sha FROM documents")
def q_rejection_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger whose details are whole documents: 500 characters of each are kept."""
    path = new_folder(spark)
    sinks.write_rejections(table(spark, sf_dir, "documents").select("doc_id", F.lit("text_too_long").alias("reason"), F.col("text").alias("detail")), path)
    back = spark.read.schema("doc_id long, reason string, detail string").json(path)
    return back.select("doc_id", F.length("detail").alias("n"), F.sha2(F.col("detail").cast("binary"), 256).alias("detail_sha"))


@query("SELECT 'img/' || p_partkey || '.png' AS path, p_name AS target FROM part")
def q_recognition_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognition labels, a line each."""
    path = new_folder(spark)
    p = table(spark, sf_dir, "part").select(F.format_string("img/%d.png", "p_partkey").alias("image_path"), F.col("p_name").alias("target"))
    sinks.write_recognition_labels(p, path)
    parts = F.split("value", "\t", 2)
    return datasets.read_label_lines(spark, path).select(parts[0].alias("path"), parts[1].alias("target"))


@query("SELECT 'img/' || p_partkey || '.png' AS path, 0 AS box, 'text' AS transcription, [[1, 2], [p_size, 2], [p_size, 9], [1, 9]] AS points FROM part UNION ALL SELECT 'img/' || p_partkey || '.png', 1, '###', [[0, 0], [3, 0], [3, 3]] FROM part")
def q_detection_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection labels, a line of JSON each."""
    path = new_folder(spark)
    pairs = lambda *xy: F.array(*(F.array(*(x if hasattr(x, "cast") else F.lit(x) for x in p)) for p in xy)).cast("array<array<int>>")
    n = F.col("p_size")
    box = lambda name, points: F.struct(F.lit(name).alias("transcription"), points.alias("points"))
    labels = F.array(box("text", pairs((1, 2), (n, 2), (n, 9), (1, 9))), box("###", pairs((0, 0), (3, 0), (3, 3))))
    sinks.write_detection_labels(table(spark, sf_dir, "part").select(F.format_string("img/%d.png", "p_partkey").alias("path"), labels.alias("labels")), path)
    parts = F.split("value", "\t", 2)
    lines = datasets.read_label_lines(spark, path).select(parts[0].alias("path"), F.from_json(parts[1], "array<struct<transcription:string,points:array<array<int>>>>").alias("b"))
    return lines.select("path", F.posexplode("b").alias("box", "x")).select("path", "box", "x.transcription", "x.points")


@query("SELECT CASE WHEN role = 'user' THEN 'OCR:' ELSE 'Formula Recognition:' END AS prompt, sha256(text) AS target_sha, CASE WHEN trim(text) = '' THEN 'x' END AS error FROM conversations")
def q_training_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training records by source and split, read back and checked."""
    path = new_folder(spark)
    prompt = t.prompt_of(F.when(F.col("role") == "user", "ocr").otherwise("formula"))
    sinks.write_training(table(spark, sf_dir, "conversations").select(F.concat(F.lit("s"), (F.col("conv_id") % 3).cast("string")).alias("source"), F.when(F.col("turn") == 0, "validation").otherwise("train").alias("split"), F.lit("x.png").alias("image_path"), prompt.alias("prompt"), F.col("text").alias("target")), path)
    back = datasets.read_records(spark, f"{path}/*/*")
    return back.select(F.col("text_info")[0]["text"].alias("prompt"), F.sha2(F.col("text_info")[1]["text"].cast("binary"), 256).alias("target_sha"), "error")


@query(_BLOCKS + "SELECT 'p' || conv_id AS image, count(*) AS n, sha256(string_agg(text, chr(10) ORDER BY o)) AS text_sha FROM b GROUP BY conv_id")
def q_manifest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of pages: picture, sides, text and blocks."""
    from scriptoria.operators.annotate import ocr_text, renumbered

    path = new_folder(spark)
    p = pages(spark, sf_dir).select(F.concat(F.lit("p"), F.col("conv_id").cast("string")).alias("image"), F.lit(200).alias("width"), F.lit(200).alias("height"), ocr_text(F.col("blocks")).alias("text"), renumbered(F.col("blocks")).alias("blocks"), F.lit(3).alias("revision"))
    sinks.write_manifest(p, path)
    back = spark.read.schema("image string, text string, blocks array<struct<order:int>>, revision int").json(path).where("revision is null")
    return back.select("image", F.size("blocks").cast("long").alias("n"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha"))


@query("SELECT count(*) AS n, TRUE AS numbered FROM part")
def q_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files are numbered from 1 without gaps, whatever the splits they are read in."""
    path = new_folder(spark)
    table(spark, sf_dir, "part").select(F.col("p_name").alias("value")).write.text(path)
    by = datasets.read_lines(spark, path).groupBy("file").agg(F.count("*").alias("n"), F.min("line_number").alias("lo"), F.max("line_number").alias("hi"), F.count_distinct("line_number").alias("d"))
    return by.agg(F.sum("n").alias("n"), F.bool_and((F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("d") == F.col("n"))).alias("numbered"))


@query("SELECT o_orderkey AS image, o_orderstatus AS prediction FROM orders WHERE o_orderkey % 3 = 0")
def q_base_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base model's predictions out of a file of several candidates."""
    path = new_folder(spark)
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, "base").otherwise("merged").alias("candidate"), F.lit("d").alias("dataset"), F.col("o_orderkey").cast("string").alias("image"), F.col("o_orderstatus").alias("prediction"))
    o.write.json(path)
    return datasets.read_predictions(spark, path, "base").select(F.col("image").cast("long").alias("image"), "prediction")


@query("SELECT sha256(p_type) AS sha256, length(p_type) AS n FROM part GROUP BY p_type")
def q_staged_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures staged by their digests: copies once; bytes win over paths."""
    path = new_folder(spark)
    content, _ = images.image_bytes(F.struct(F.col("p_type").cast("binary").alias("bytes"), F.lit("x").alias("path")))
    sinks.stage_images(table(spark, sf_dir, "part").select(content.alias("content")), path)
    return spark.read.parquet(path).select("sha256", F.octet_length("content").alias("n"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS id FROM customer")
def q_numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers numbered in the order of their balances, by ranges."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.struct("c_acctbal", "c_custkey").alias("place"))
    return sinks.numbered_rows(c, "place", "id").select("c_custkey", "id")


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as completed pages whose blocks all have a text and the task ocr or none."""
    rows = turn_blocks(spark, sf_dir).withColumn("text", F.when(t.is_blank(F.col("text")), "x").otherwise(F.col("text"))).withColumn("task", F.when(F.col("task").isNotNull(), "ocr"))
    p = rows.groupBy("conv_id").agg(F.collect_list(F.struct(*_FIELDS)).alias("blocks"))
    return p.select(F.col("conv_id").alias("page"), F.when(F.col("conv_id") % 5 == 0, "edited").otherwise("completed").alias("status"), F.lit(200).alias("width"), F.lit(200).alias("height"), F.concat(F.col("conv_id").cast("string"), F.lit(".png")).alias("file_name"), "blocks")


@query(_BLOCKS + "SELECT conv_id AS page, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY o) - 1 AS INTEGER) AS place, CASE WHEN turn % 4 = 3 THEN 'text' ELSE text END AS transcription, [[CAST(turn * 10 AS INTEGER), CAST(turn * 10 AS INTEGER)], [CAST(turn * 10 + 5 AS INTEGER), CAST(turn * 10 AS INTEGER)], [CAST(turn * 10 + 5 AS INTEGER), CAST(turn * 10 + 5 AS INTEGER)], [CAST(turn * 10 AS INTEGER), CAST(turn * 10 + 5 AS INTEGER)]] AS points FROM b")
def q_page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as detection labels, read again."""
    label = F.from_json(sinks.page_label(F.col("blocks")), "array<struct<transcription:string,points:array<array<int>>>>")
    p = pages(spark, sf_dir).select(F.col("conv_id").alias("page"), F.posexplode(label).alias("place", "b"))
    return p.select("page", "place", "b.transcription", "b.points")


@query(_BLOCKS + "SELECT conv_id AS page, CAST(o AS INTEGER) AS place, 'OCR:' AS prompt, [turn * 10, turn * 10, turn * 10 + 5, turn * 10 + 5] AS box, CASE WHEN turn % 4 = 3 THEN 'x' ELSE text END AS target FROM b WHERE conv_id % 5 <> 0 AND NOT skipped AND task IS NOT NULL")
def q_crop_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops of completed pages, all or none."""
    return sinks.crops(finished(spark, sf_dir)).select("page", F.col("order").alias("place"), "prompt", "box", "target")


@query(
    _BLOCKS
    + """, k AS (SELECT conv_id, turn, o, label FROM b WHERE conv_id % 5 <> 0 AND NOT skipped), i AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS image_id FROM (SELECT DISTINCT conv_id FROM k))
    SELECT image_id, CAST(row_number() OVER (PARTITION BY k.conv_id ORDER BY o) - 1 AS INTEGER) AS read_order, CAST(d.i + 1 AS BIGINT) AS category_id, [turn * 10.0, turn * 10.0, 5.0, 5.0] AS bbox, k.conv_id || '.png' AS file_name FROM k JOIN i ON i.conv_id = k.conv_id JOIN d ON d.label = k.label"""
)
def q_coco_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images and annotations of completed pages, joined by their ids."""
    found, notes = sinks.coco(finished(spark, sf_dir))
    return notes.join(found.select(F.col("id").alias("image_id"), "file_name"), "image_id").select("image_id", "read_order", "category_id", "bbox", "file_name")


@query("SELECT 'regions' AS name, count(*) AS n FROM region UNION ALL SELECT 'nations', count(*) FROM nation")
def q_whole_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables that are exported together."""
    path = new_folder(spark)
    table(spark, sf_dir, "region").limit(0).write.parquet(f"{path}/before")  # the folder above must be there
    sinks.write_all_or_nothing({"regions": table(spark, sf_dir, "region"), "nations": table(spark, sf_dir, "nation")}, f"{path}/export")
    parts = [spark.read.parquet(f"{path}/export/{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name in ("regions", "nations")]
    return parts[0].union(parts[1])


@query("WITH r AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS k FROM part WHERE p_partkey % 3 <> 0) SELECT 'i' || p_partkey AS image, p_name AS target, 'ocr' AS task FROM r WHERE k <= 4")
def q_validation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first valid records of a validation file, in which every third line is none."""
    path = new_folder(spark)
    record = sinks.training_record(F.concat(F.lit("i"), F.col("p_partkey").cast("string")), t.prompt_of(F.lit("ocr")), F.col("p_name"))
    value = F.when(F.col("p_partkey") % 6 == 0, "").when(F.col("p_partkey") % 6 == 3, "{no record").otherwise(record)
    write_document(table(spark, sf_dir, "part").select("p_partkey", F.concat(value, F.lit("\n")).alias("content")), ["p_partkey"], f"{path}/validation-part.jsonl")
    return datasets.read_validation(spark, path, 4).select("image", "target", "task")


@query("SELECT string_agg(c, '' ORDER BY c) AS alphabet FROM (SELECT ' ' AS c UNION SELECT unnest(string_split(r_name, '')) FROM region)")
def q_alphabet_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alphabet of a file with a character a line."""
    path = new_folder(spark)
    table(spark, sf_dir, "region").select(F.explode(F.split("r_name", "")).alias("value")).where("value <> ''").write.text(path)
    return spark.createDataFrame([(datasets.read_alphabet(spark, path),)], "alphabet string")


@query("SELECT 't' || n_nationkey AS name, 'shard-' || n_regionkey AS shard FROM nation")
def q_shard_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which shard each tensor of an index is in."""
    path = new_folder(spark)
    pair = F.struct(F.concat(F.lit("t"), F.col("n_nationkey").cast("string")), F.concat(F.lit("shard-"), F.col("n_regionkey").cast("string")))
    table(spark, sf_dir, "nation").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(pair)).alias("weight_map"))).alias("value")).write.text(path)
    return datasets.read_shard_index(spark, path)


@query("SELECT 'images' AS part, n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT 'categories', r_regionkey, r_name FROM region")
def q_coco_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A COCO document's lists."""
    path = new_folder(spark)
    pictures = table(spark, sf_dir, "nation").agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("file_name"))).alias("images"))
    names = table(spark, sf_dir, "region").agg(F.collect_list(F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))).alias("categories"))
    pictures.join(names).select(F.to_json(F.struct("images", F.array().alias("annotations"), "categories")).alias("value")).write.text(path)  # two lists of a few rows
    found, _, categories = datasets.read_coco(spark, path)
    return found.select(F.lit("images").alias("part"), "id", F.col("file_name").alias("name")).union(categories.select(F.lit("categories"), "id", "name"))


@query("SELECT 'f' || p_partkey AS name, CASE WHEN p_partkey % 4 IN (0, 3) THEN length(p_name) END AS n, CASE p_partkey % 4 WHEN 1 THEN 'missing' WHEN 2 THEN 'changed' END AS problem FROM part")
def q_checked_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are given out only while they are what the catalogue has."""
    k = F.col("p_partkey") % 4
    name, content = F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_name").cast("binary")
    p = table(spark, sf_dir, "part")
    at = F.lit("2026-01-01").cast("timestamp").alias("modified")
    catalog = p.select(name, F.octet_length(content).alias("size_bytes"), at, F.sha2(content, 256).alias("sha256"))
    files = p.where(k != 1).select(name, F.when(k == 2, F.reverse("p_name").cast("binary")).otherwise(content).alias("content"), at)
    return images.checked_content(catalog, files).select("name", F.octet_length("content").alias("n"), "problem")
