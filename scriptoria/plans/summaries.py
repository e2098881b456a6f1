"""Queries of datasets' splits, prepared summaries, folders of pictures with sidecars, and the audit as one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.operators import audit
from scriptoria.plans.pages import coco
from scriptoria.plans.rows import table
from scriptoria.registry import query
from scriptoria.scratch import new_folder
from scriptoria.sources import datasets, fragments, images


@query("SELECT CASE WHEN doc_id % 5 < 3 THEN 'train' ELSE 'validation' END AS side, lang, count(*) AS n FROM documents WHERE doc_id % 5 < 4 GROUP BY ALL")
def q_split_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a dataset with the splits first, valid and test: the only other one is the training split, the test split is not used."""
    k = F.col("doc_id") % 5
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(k < 3, "first").when(k == 3, "valid").otherwise("test").alias("split"))
    train, validation = datasets.train_and_validation(rows)
    both = train.select(F.lit("train").alias("side"), "lang").unionByName(validation.select(F.lit("validation").alias("side"), "lang"))
    return both.groupBy("side", "lang").agg(F.count("*").alias("n"))


@query(
    """SELECT p_brand || '.jsonl' AS file, CAST(count(*) AS BIGINT) + CASE WHEN p_brand LIKE '%3' THEN 1 ELSE 0 END AS declared, CAST(count(*) AS BIGINT) AS found, CASE WHEN p_brand LIKE '%3' THEN 'count' END AS problem FROM part GROUP BY p_brand
    UNION ALL SELECT 'gone.jsonl', 4, 0, 'count'"""
)
def q_checked_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prepared run's summary against its files: counts of lines that are not blank, by brand; some are declared wrongly, one file is missing."""
    path = new_folder(spark)
    file = F.concat("p_brand", F.lit(".jsonl"))
    lines = table(spark, sf_dir, "part").select(file.alias("file"), F.col("p_partkey").alias("place"), F.concat(F.to_json(F.struct("p_partkey")), F.when(F.col("p_partkey") % 4 == 0, "\n \n").otherwise("\n")).alias("content"))
    fragments.write_pieces(lines, path)
    # A summary is a small document by its nature: a row for each file of the run.
    declared = lines.groupBy("file").agg(F.count("*").alias("n")).collect()
    sources = [{"file": r["file"], "samples": r["n"] + r["file"].endswith("3.jsonl")} for r in declared] + [{"file": "gone.jsonl", "samples": 4}]
    return datasets.check_summary(spark, {"tasks": ["ocr"], "sources": sources, "train_probabilities": [0.25, 0.75]}, path)


@query(
    """WITH p AS (SELECT 'p' || p_partkey AS stem, p_partkey % 7 = 0 AS bad, p_size, row_number() OVER (ORDER BY p_partkey) - 1 AS place, 14 + 40 + 3 * 4 * p_size AS n FROM part)
    SELECT stem, place, CASE WHEN NOT bad THEN CAST(p_size AS INTEGER) END AS width, CASE WHEN NOT bad THEN 3 END AS height, bad, CASE WHEN bad THEN sha256('no picture ' || stem) END AS digest FROM p"""
)
def q_image_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of pictures in natural order, with sides out of their headers; every seventh is none."""
    path = new_folder(spark)
    stem = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    little = lambda x: F.concat(*(F.substring(F.lpad(F.hex(x.cast("long")), 8, "0"), i, 2) for i in (7, 5, 3, 1)))
    size = F.col("p_size")
    header = F.concat(F.lit("424D"), little(54 + 12 * size), F.lit("00000000"), little(F.lit(54)), little(F.lit(40)), little(size), little(F.lit(3)), F.lit("01002000"), F.lit("0" * 48))
    picture = F.unhex(F.concat(header, F.repeat(F.lit("10203000"), (3 * size).cast("int"))))
    content = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("no picture "), stem).cast("binary")).otherwise(picture)
    fragments.write_pieces(table(spark, sf_dir, "part").select(F.concat(stem, F.lit(".bmp")).alias("file"), F.lit(0).alias("place"), content.alias("content")), path)
    found = images.catalogue(spark, path)
    # The catalogue's own order: rows are numbered as it gives them.
    in_order = found.withColumn("at", F.monotonically_increasing_id()).select(F.struct("at").alias("order"), "*")
    from scriptoria.sources.sinks import numbered_rows

    numbered = numbered_rows(in_order, "order", "place")
    return numbered.select("stem", (F.col("place") - 1).alias("place"), "width", "height", F.col("error").isNotNull().alias("bad"), F.when(F.col("error").isNotNull(), F.col("sha256")).alias("digest"))


@query("SELECT 'p' || conv_id AS stem, CAST(conv_id % 9 AS BIGINT) AS revision, CASE WHEN conv_id % 2 = 0 THEN 'edited' ELSE 'completed' END AS status, CAST(count(*) AS INTEGER) AS n_blocks FROM conversations GROUP BY conv_id")
def q_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations beside pictures: a JSON file each, one for each conversation, with its turns as blocks."""
    path = new_folder(spark)
    c = table(spark, sf_dir, "conversations")
    block = F.struct(F.col("turn").cast("string").alias("id"), F.col("turn").cast("int").alias("order"), F.coalesce("text", F.lit("")).alias("text"))
    pages = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    status = F.when(F.col("conv_id") % 2 == 0, "edited").otherwise("completed")
    document = F.to_json(F.struct(F.lit(1).alias("version"), (F.col("conv_id") % 9).alias("revision"), status.alias("status"), "blocks"))
    fragments.write_pieces(pages.select(F.concat(F.lit("p"), F.col("conv_id").cast("string"), F.lit(".json")).alias("file"), F.lit(0).alias("place"), document.alias("content")), path)
    return images.sidecars(spark, path).select("stem", "revision", "status", F.size("blocks").alias("n_blocks"))


@query(
    """WITH a AS (SELECT l_orderkey * 10 + l_linenumber AS id, count(*) OVER (PARTITION BY l_orderkey * 10 + l_linenumber) AS times, CASE WHEN l_partkey % 97 = 0 THEN -1 ELSE l_orderkey END AS image_id, l_partkey % 26 AS c, l_quantity AS q, l_suppkey % 13 = 0 AS thin FROM lineitem),
    i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 103 = 0 THEN 0 ELSE 100 END AS h FROM orders),
    p AS (SELECT (CASE WHEN times > 1 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) + (CASE WHEN c = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey IS NOT NULL AND (1 + q + 55 > 100.0001 OR 12 > h + 0.0001) THEN 1 ELSE 0 END) + (CASE WHEN thin THEN 1 ELSE 0 END) AS n
        FROM a LEFT JOIN i ON a.image_id = o_orderkey),
    j AS (SELECT (CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 103 = 0 THEN 1 ELSE 0 END) AS n FROM orders)
    SELECT 'train' AS split, (SELECT count(*) FROM orders) AS images, (SELECT count(*) FROM lineitem) AS annotations, CAST((SELECT sum(n) FROM p) + (SELECT sum(n) FROM j) AS BIGINT) AS problems,
        (SELECT count(*) FROM lineitem WHERE l_partkey % 26 > 0) AS labelled, CAST(0 AS BIGINT) AS shared_ids, CAST(0 AS BIGINT) AS shared_names"""
)
def q_audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the annotations above as one JSON document, read again."""
    pictures, notes = coco(spark, sf_dir)
    files = table(spark, sf_dir, "part").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("path"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha256"))
    shape = "splits array<struct<split:string,images:long,annotations:long,problems:long>>, classes array<struct<split:string,label:string,n:long>>, shared_ids long, shared_names long, fingerprint string"
    d = audit.full_report(pictures, notes, files).select(F.from_json("report", shape).alias("d")).where("length(d.fingerprint) = 64")
    split = F.element_at("d.splits", 1)
    labelled = F.aggregate("d.classes", F.lit(0).cast("long"), lambda s, c: s + c["n"])
    return d.select(split["split"].alias("split"), split["images"].alias("images"), split["annotations"].alias("annotations"), split["problems"].alias("problems"), labelled.alias("labelled"), "d.shared_ids", "d.shared_names")
