"""Audit of layout datasets: all violations, not only the first; counts by class; leakage; fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.dims import LABELS, label_table
from scriptoria.functions import geometry as g

SLACK = 1e-4


def _listed(*checks: tuple[str, Column]) -> Column:
    """The names of the checks that hold, in order, a line each; '' if none does. Plain expressions, which lambdas over an array are not."""
    return F.concat_ws("\n", *(F.when(F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in checks))


def _found(rows: DataFrame, problems: Column) -> DataFrame:
    """(split, id, problems) of the rows that have any, from what _listed() gives."""
    told = rows.select("split", "id", problems.alias("__told")).where("__told <> ''")
    return told.select("split", "id", F.split("__told", "\n").alias("problems"))


def taxonomy_problems(categories: DataFrame) -> DataFrame:
    """(label_id, expected, found) where the categories (id, name) are not the taxonomy in its order."""
    expected = label_table(categories.sparkSession).select("label_id", F.col("label").alias("expected"))
    found = categories.select(F.col("id").alias("label_id"), F.col("name").alias("found"))
    return expected.join(found, "label_id", "full").where(~F.col("expected").eqNullSafe(F.col("found")))


def image_problems(images: DataFrame) -> DataFrame:
    """(split, id, problems) of images (split, id, file_name, width, height, exists)."""
    times = images.groupBy("split", "id").agg(F.count("*").alias("times")).where("times > 1")  # few, so joined by broadcast where they are
    name = F.col("file_name")
    problems = _listed(
        ("image id is missing", F.col("id").isNull()),
        ("image id is not unique", F.col("times") > 1),
        ("bad file name", name.isNull() | (name == "") | name.startswith("/")),
        ("file name leaves the folder", name.rlike(r"(^|/)\.\.(/|$)")),
        ("file is missing", ~F.col("exists")),
        ("bad size", F.coalesce((F.col("width") <= 0) | (F.col("height") <= 0), F.lit(True))),
    )
    return _found(images.join(times, ["split", "id"], "left"), problems)


def annotation_problems(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """(split, id, problems) of annotations (split, id, image_id, category_id, bbox, segmentation, area, read_order).

    The area that an annotation states is not compared with that of its polygons.
    """
    times = annotations.groupBy("split", "id").agg(F.count("*").alias("times")).where("times > 1")  # few, so joined by broadcast where they are
    # Of an image that is told twice the smaller sides count, whatever the order of the rows.
    sizes = images.groupBy("split", F.col("id").alias("image_id")).agg(F.min("width").alias("width"), F.min("height").alias("height"), F.lit(True).alias("known"))
    box = [F.get("bbox", F.lit(i)) for i in range(4)]
    numbers = lambda a: F.coalesce(F.forall(a, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))
    only = F.get("segmentation", F.lit(0))
    single = (F.size("segmentation") == 1) & F.size(only).isin(6, 8)  # one triangle or quadrilateral: plain expressions
    total = F.when(single, g.flat_area(only)).otherwise(F.aggregate(F.transform(F.transform("segmentation", g.flat_points), g.area), F.lit(0.0), lambda s, v: s + v))
    few = F.coalesce(g.all_finite(only, 8), F.lit(False))
    bad_polygon = F.when(single, ~few).otherwise(F.exists(F.transform("segmentation", lambda s: numbers(s) & g.flat_points(s).isNotNull()), lambda ok: ~ok))
    whole_box = F.coalesce((F.size("bbox") == 4) & g.all_finite(F.col("bbox"), 4), F.lit(False))
    problems = _listed(
        ("annotation id is missing", F.col("id").isNull()),
        ("annotation id is not unique", F.col("times") > 1),
        ("unknown image", F.col("known").isNull()),
        ("bad category", ~F.coalesce(F.col("category_id").between(1, len(LABELS)), F.lit(False))),
        ("bad box", ~whole_box | (box[0] < 0) | (box[1] < 0) | (box[2] <= 0) | (box[3] <= 0)),
        ("box leaves the image", (box[0] + box[2] > F.col("width") + SLACK) | (box[1] + box[3] > F.col("height") + SLACK)),
        ("no segmentation", F.coalesce(F.size("segmentation"), F.lit(0)) < 1),
        ("bad polygon", bad_polygon),
        ("bad area", ~F.coalesce((F.col("area") > 0) & (F.col("area") < F.lit(float("inf"))), F.lit(False))),
        ("polygon has no area", total <= 0),
        ("bad read order", F.coalesce(F.col("read_order") < 0, F.lit(True))),
    )
    joined = annotations.join(times, ["split", "id"], "left").join(sizes, ["split", "image_id"], "left")
    return _found(joined, problems)


def order_gaps(annotations: DataFrame, group: list[str], order: str = "read_order") -> DataFrame:
    """Groups whose orders are not 0, 1, ... n-1: told by count, distinct count, least and greatest, all partial sums."""
    by = annotations.groupBy(*group).agg(F.count("*").alias("n"), F.count_distinct(order).alias("distinct"), F.min(order).alias("lo"), F.max(order).alias("hi"))
    return by.where(~((F.col("distinct") == F.col("n")) & (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)))


def leaks(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that both sides have."""
    return left.select(key).intersect(right.select(key))


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key no parent has."""
    return rows.join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


def class_counts(rows: DataFrame, label: str, labels: DataFrame) -> DataFrame:
    """(label, n) of all labels, also of those without rows."""
    n = rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return labels.select("label").join(n, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


def fingerprint(files: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One digest of (path, sha256) rows in the order of their paths, for each group if `by` is given."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda f: F.concat(f["path"], f["sha256"]))
    return files.groupBy(*(by or [])).agg(F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("fingerprint"))


def tree_fingerprint(files: DataFrame, by: list[str] | None = None, digits: int = 3) -> DataFrame:
    """As fingerprint(), for any number of files: the digest of the digests of buckets, so that no row holds all paths.

    A file's bucket is the first hexadecimal digits of its path's digest.
    """
    by = by or []
    bucket = F.left(F.sha2(F.col("path").cast("binary"), 256), F.lit(digits))
    parts = fingerprint(files.withColumn("bucket", bucket), [*by, "bucket"])
    return fingerprint(parts.select(*by, F.col("bucket").alias("path"), F.col("fingerprint").alias("sha256")), by)


def full_report(images: DataFrame, annotations: DataFrame, files: DataFrame) -> DataFrame:
    """One JSON document of an audit: totals by split, annotations by class and split, what splits share, and the fingerprint of the files (path, sha256).

    Totals and classes are few; all else in it is counts.
    """
    spark = images.sparkSession
    totals = report(images, annotations)
    named = label_table(spark)
    by_class = annotations.groupBy("split", F.col("category_id").cast("int").alias("label_id")).agg(F.count("*").alias("n")).join(named, "label_id").select("split", "label", "n")
    shared = lambda c: images.where("split = 'train'").select(c).intersect(images.where("split = 'validation'").select(c)).agg(F.count("*").alias("n"))
    one = lambda df, column, name: df.agg(F.array_sort(F.collect_list(column)).alias(name))
    parts = [
        one(totals, F.struct("split", "images", "annotations", "problems"), "splits"), one(by_class, F.struct("split", "label", "n"), "classes"),
        shared("id").select(F.col("n").alias("shared_ids")), shared("file_name").select(F.col("n").alias("shared_names")), tree_fingerprint(files).select("fingerprint"),
    ]
    out = parts[0]
    for p in parts[1:]:  # one row each
        out = out.join(F.broadcast(p))
    return out.select(F.to_json(F.struct("*")).alias("report"))


def report(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """(split, images, annotations, problems): the totals of an audit."""
    n_images = images.groupBy("split").agg(F.count("*").alias("images"))
    n_annotations = annotations.groupBy("split").agg(F.count("*").alias("annotations"))
    found = image_problems(images).unionByName(annotation_problems(annotations, images)).groupBy("split").agg(F.sum(F.size("problems")).alias("problems"))
    joined = n_images.join(n_annotations, "split", "full").join(found, "split", "full")
    return joined.select("split", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("images", "annotations", "problems")))
