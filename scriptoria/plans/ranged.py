"""Queries of files that are read and written by parts: digests, tensor files and tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.operators import admission, tensors
from scriptoria.plans.rows import table
from scriptoria.registry import query
from scriptoria.scratch import new_folder
from scriptoria.sources import datasets, fragments, pictures, ranges, sinks, tensorfiles


@query("SELECT source, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS length, sha256(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY source")
def q_file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digest of files, one for each source of documents, each streamed through a task by its ranges."""
    path = new_folder(spark)
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    docs.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").text(path, lineSep="\n")
    return ranges.digests(spark, f"{path}/*/*.txt", 4096).select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "length", "sha256")


@query("SELECT source, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS length FROM documents GROUP BY source")
def q_tree_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of the same files by the digest of their chunks, which many tasks read; the digests are held against plain ones in the tests."""
    path = new_folder(spark)
    docs = table(spark, sf_dir, "documents").select("source", F.coalesce("text", F.lit("")).alias("value"))
    docs.repartition("source").write.partitionBy("source").text(path, lineSep="\n")
    return ranges.tree_digests(spark, f"{path}/*/*.txt", 1 << 16, 1 << 12).select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "length")


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("t"), F.col("vec_id").cast("string"), F.lit(".weight"))
    file = F.concat(F.lit("model-"), F.coalesce(F.col("label").cast("string"), F.lit("none")), F.lit(".safetensors"))
    return table(spark, sf_dir, "embeddings").select("vec_id", file.alias("file"), name.alias("name"), F.array(F.lit(8), F.lit(8)).alias("shape"), F.col("embedding").cast("array<double>").alias("values"))


@query(
    """SELECT 'model-' || coalesce(CAST(label AS VARCHAR), 'none') || '.safetensors' AS file, 't' || vec_id || '.weight' AS name, 'F32' AS dtype, '8x8' AS shape,
    256 * (row_number() OVER (PARTITION BY label ORDER BY 't' || vec_id || '.weight') - 1) AS place, CAST(256 AS BIGINT) AS size FROM embeddings"""
)
def q_tensor_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the headers of tensor files say, files of vectors by label; nothing but headers is read."""
    path = new_folder(spark)
    tensorfiles.write_tensors(_named(spark, sf_dir).drop("vec_id"), path)
    told = tensorfiles.read_headers(spark, path)
    return told.select(F.element_at(F.split("path", "/"), -1).alias("file"), "name", "dtype", F.array_join(F.transform("shape", lambda n: n.cast("string")), "x").alias("shape"), (F.col("begin") - F.col("header_bytes")).alias("place"), "size")


def _halves(adapted: DataFrame, half: Column) -> DataFrame:
    prefix = F.regexp_replace("name", r"\.weight$", "")
    shapes = {"A": (8, 1), "B": (1, 8)}
    parts = [adapted.select("file", F.concat(prefix, F.lit(f".lora_{s}")).alias("name"), F.array(*map(F.lit, shape)).alias("shape"), half.alias("values")) for s, shape in shapes.items()]
    return parts[0].unionByName(parts[1])


@query(
    """SELECT CAST(count(*) FILTER (vec_id % 10 > 3) AS BIGINT) AS unchanged, CAST(count(*) FILTER (vec_id % 10 = 1) AS BIGINT) AS adapted, CAST(count(*) FILTER (vec_id % 10 = 2) AS BIGINT) AS missing,
    CAST(count(*) FILTER (vec_id % 10 = 3) AS BIGINT) AS unexpected, CAST(count(*) FILTER (vec_id % 10 = 0) AS BIGINT) AS mismatch, round(max(CASE WHEN vec_id % 10 = 1 THEN (vec_id % 7) * 0.00005 END), 5) AS max_error FROM embeddings"""
)
def q_tensor_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tensor files of a base model, an adapter and what was merged, a little apart, read and compared by tiles."""
    path, k = new_folder(spark), F.col("vec_id") % 10
    named = _named(spark, sf_dir)
    half = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: i / 8)
    delta = F.flatten(F.transform(half, lambda r: F.transform(half, lambda c: r * c * 0.5)))
    apart = (F.col("vec_id") % 7) * F.lit(0.00005)
    merged = F.when(k == 1, F.zip_with("values", delta, lambda v, d: v + d + apart)).when(k == 0, F.transform("values", lambda v: v + 1)).otherwise(F.col("values"))
    parts = {"base": named.where(k != 3), "merged": named.where(k != 2).withColumn("values", merged), "adapter": _halves(named.where(k == 1), half)}
    tiles = {}
    for name, rows in parts.items():
        tensorfiles.write_tensors(rows.select("file", "name", "shape", "values"), f"{path}/{name}")
        tiles[name] = tensorfiles.read_tiles(tensorfiles.read_headers(spark, f"{path}/{name}"), 3, 3)
    checked = tensors.reconcile_tiles(tiles["base"], tiles["merged"], tiles["adapter"], 0.5)
    return tensors.reconciliation(checked).withColumn("max_error", F.round("max_error", 5))


@query(
    """SELECT 'images' AS part, c_custkey AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS place, c_name || ' "{[\\ ' || c_mktsegment AS text FROM customer
    UNION ALL SELECT 'annotations', o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1, CAST(o_custkey AS VARCHAR) FROM orders"""
)
def q_coco_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document of customers and orders, written by many tasks and read by many, in parts of 16 KB that begin anywhere."""
    path = new_folder(spark)
    table(spark, sf_dir, "region").limit(0).write.parquet(path)  # the folder must be there
    name = F.concat("c_name", F.lit(' "{[\\ '), "c_mktsegment")
    pictures = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), name.alias("file_name"), F.lit(1).alias("width"), F.lit(1).alias("height"))
    notes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("image_id"), F.array(F.array(F.lit(0.5))).alias("segmentation"))
    sinks.write_coco(pictures, notes, f"{path}/coco.json")
    images, annotations, _ = datasets.read_coco(spark, f"{path}/coco.json", 1 << 14)
    place = F.col("place").cast("long").alias("place")
    return images.select(F.lit("images").alias("part"), "id", place, F.col("file_name").alias("text")).union(annotations.select(F.lit("annotations"), "id", place, F.col("image_id").cast("string")))


@query(
    """WITH v AS (SELECT vec_id, [CAST(floor(abs(CAST(x AS DOUBLE)) * 1024) AS BIGINT) % 256 FOR x IN embedding] AS g, vec_id % 4 AS l, vec_id % 3 AS t, 5 + vec_id % 4 AS r, 4 + vec_id % 5 AS b FROM embeddings)
    SELECT vec_id, r - l AS width, b - t AS height, CAST(sum(g[8 * y + x + 1] * (1 + x - l + 8 * (y - t))) AS BIGINT) AS mark FROM v, range(8) AS i(x), range(8) AS j(y) WHERE x >= l AND x < r AND y >= t AND y < b GROUP BY ALL"""
)
def q_crop_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops out of pictures of vectors, as PNG, read again: their sides and a mark of all of their pixels in place."""

    @F.pandas_udf("binary")
    def picture(v):  # noqa: ANN001, ANN202
        import numpy as np

        grey = lambda x: (np.floor(np.abs(np.asarray(x, np.float64)) * 1024).astype(np.int64) % 256).astype(np.uint8).reshape(8, 8)
        return v.map(lambda x: pictures.encoded(np.repeat(grey(x)[:, :, None], 3, axis=2)))

    @F.pandas_udf("width long, height long, mark long")
    def read(content):  # noqa: ANN001, ANN202
        import numpy as np
        import pandas as pd

        out = []
        for c in content:
            x = pictures.raster(bytes(c)).astype(np.int64)
            height, width, _ = x.shape
            out.append((width, height, int((x[:, :, 1] * (1 + np.arange(width)[None, :] + 8 * np.arange(height)[:, None])).sum())))
        return pd.DataFrame(out, columns=["width", "height", "mark"])

    k = F.col("vec_id")
    e = table(spark, sf_dir, "embeddings").select(k.alias("page"), "vec_id", "embedding")
    crops = e.select("page", F.lit(0).alias("order"), F.array(k % 4, k % 3, 5 + k % 4, 4 + k % 5).cast("array<int>").alias("box"))
    made = pictures.crop_pictures(crops, e.select("page", picture("embedding").alias("content")))
    return made.select(F.col("page").alias("vec_id"), read("picture").alias("p")).select("vec_id", "p.*")


@query(
    """SELECT p_partkey AS line_number, CASE p_partkey % 6 WHEN 0 THEN 'missing_image' WHEN 1 THEN 'invalid_image' WHEN 4 THEN 'duplicate_image' WHEN 5 THEN 'unsafe_image_path' END AS reason,
    CASE WHEN p_partkey % 6 IN (2, 3) THEN 2 + p_size WHEN p_partkey % 6 = 4 THEN 2 + (SELECT b.p_size FROM part b WHERE b.p_partkey = a.p_partkey - 1) END AS width FROM part a"""
)
def q_named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label lines and a folder of pictures: some are missing, cut off, copies of the one before or outside the folder."""
    path = new_folder(spark)
    p = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey") % 6)

    @F.pandas_udf("binary")
    def picture(width, key):  # noqa: ANN001, ANN202
        import numpy as np

        return width.combine(key, lambda w, n: pictures.encoded(np.resize(np.frombuffer(int(n).to_bytes(8, "big"), np.uint8), (4, 2 + int(w), 3))))

    made = p.where("k in (1, 2, 3)").select("p_partkey", "k", picture("p_size", "p_partkey").alias("content"))
    copies = made.where("k = 3").select((F.col("p_partkey") + 1).alias("p_partkey"), F.lit(4).alias("k"), "content")
    name = F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".png"))
    cut = F.when(F.col("k") == 1, F.substring("content", 1, 50)).otherwise(F.col("content"))
    fragments.write_pieces(made.unionByName(copies).select(name.alias("file"), F.lit(0).alias("place"), cut.alias("content")), f"{path}/pictures")
    boxes = F.lit('\t[{"transcription":"a","points":[[0,0],[2,0],[2,2],[0,2]]}]')
    lines = p.select(F.lit("d").alias("source"), F.col("p_partkey").alias("line_number"), F.concat(F.when(F.col("k") == 5, "../").otherwise(""), name, boxes).alias("value"), F.lit(f"{path}/pictures").alias("root"))
    rows, _ = admission.detection_of_files(lines)
    return rows.select("line_number", "reason", F.when(F.col("reason").isNull() | (F.col("reason") == "duplicate_image"), F.col("width")).alias("width"))
