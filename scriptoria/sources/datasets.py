"""Datasets in parquet shards, prepared JSON lines, label files and summaries."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.operators.split import chosen_splits
from scriptoria.scratch import staged

# Fixed value: the name of a shard; what follows the count is a run without a dot.
_SHARD = r"^(.+)-\d{5}-of-\d{5}(?:-[^.]+)?\.parquet$"


def split_of_file(name: Column) -> Column:
    """The split that a shard's file name tells, else train."""
    found = F.regexp_extract(name, _SHARD, 1)
    return F.when(found == "", "train").otherwise(found)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """All shards of a dataset with split and file, from its data folder or from itself. Images stay undecoded columns, which Spark leaves unread where they are not used.

    A folder with the marker files of a saved dataset is read by read_saved().
    """
    if is_saved(spark, path):
        return read_saved(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(conf)
    # The data folder first, then the dataset's own: whatever can be listed, not only local files.
    globs = [g for g in (f"{path}/data/*.parquet", f"{path}/*.parquet") if fs.globStatus(jvm.org.apache.hadoop.fs.Path(g))]
    if not globs:
        raise FileNotFoundError(f"no parquet files in {path}")
    rows = spark.read.parquet(*globs)
    return rows.withColumn("file", F.col("_metadata.file_name")).withColumn("split", split_of_file(F.col("file")))


def _matches(spark: SparkSession, glob: str) -> list[str]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(glob)
    return [str(s.getPath()) for s in path.getFileSystem(conf).globStatus(path) or ()]


def is_saved(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a dataset as Arrow files, told by its marker files, and not parquet shards."""
    return any(_matches(spark, f"{path}/{name}") for name in ("dataset_dict.json", "state.json"))


def read_saved(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All rows of a dataset saved as Arrow streams, with split and file: one folder, or one for each split. `columns`: those to unpack, all if null.

    A file's record batches are read by many tasks. The columns are those of the first file.
    """
    from scriptoria.sources.arrowfiles import read_batches

    dictionary = bool(_matches(spark, f"{path}/dataset_dict.json"))
    glob = f"{path}/*/*.arrow" if dictionary else f"{path}/*.arrow"
    found = _matches(spark, glob)
    if not found:
        raise FileNotFoundError(f"no Arrow files in {path}")
    rows = read_batches(spark, glob, min(found), columns)
    split = F.element_at(F.split("path", "/"), -2) if dictionary else F.lit("train")
    return rows.withColumns({"split": split, "file": F.element_at(F.split("path", "/"), -1)}).drop("path")


def train_and_validation(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the splits to use. The names of splits are few: they are all that comes to the driver."""
    train, validation = chosen_splits([r[0] for r in rows.select("split").distinct().collect()])
    return rows.where(F.col("split") == train), None if validation is None else rows.where(F.col("split") == validation)


def require_columns(rows: DataFrame) -> None:
    """A dataset has an image, and a label or a text."""
    if "image" not in rows.columns:
        raise ValueError("the dataset has no column image")
    if not {"label", "text"} & set(rows.columns):
        raise ValueError("the dataset has neither a column label nor text")


def task_column_problem(datasets: dict[str, list[str]]) -> str | None:
    """Of several sources all must tell their tasks, or none: what is wrong, if anything. Columns by source."""
    having = {name for name, columns in datasets.items() if "task" in columns}
    missing = sorted(set(datasets) - having)
    return f"no task column in {missing}" if having and missing and len(datasets) > 1 else None


RECORD = "image_info array<struct<image_url:string,matched_text_index:int>>, text_info array<struct<text:string,tag:string>>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, value) of text files, numbered from 1, blank lines too; a byte-order mark is taken off.

    Large files are read in splits. A split's lines are numbered by themselves, which sorts no more than a
    split, and the lines of the splits before it in its file are added.
    """
    split = ["path", "at"]
    # Spark gives names as in URIs.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    raw = spark.read.text(path).select(name.alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("place"), "value")
    sizes = raw.groupBy(*split).agg(F.count("*").alias("n"))  # a row a split
    before = sizes.select(*split, F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = raw.withColumn("own", F.row_number().over(Window.partitionBy(*split).orderBy("place"))).join(before, split)
    line = (F.col("before") + F.col("own")).cast("long")
    return numbered.select("file", line.alias("line_number"), F.when(line == 1, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value")).alias("value"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Prepared training records with their place, and error where a line is no record; blank lines are skipped."""
    return records_of(read_lines(spark, path))


def records_of(lines: DataFrame) -> DataFrame:
    """As read_records(), of lines (file, line_number, value)."""
    from scriptoria.dims import PROMPTS
    from scriptoria.functions.grammar import record_error, target_error_of
    from scriptoria.functions.text import task_of_prompt

    rows = lines.where(F.trim("value") != "").withColumn("record", F.from_json("value", RECORD)).withColumn("sound", F.try_parse_json("value").isNotNull())
    rows = rows.select("file", "line_number", "value", "sound", "record.*")
    shape = F.when(~F.col("sound"), "json").otherwise(record_error(F.col("image_info"), F.col("text_info"), tuple(PROMPTS.values())))
    rows = rows.withColumn("error", shape)
    # Grammars run over records of a good shape only.
    good = rows.where("error is null").withColumn("error", target_error_of(F.col("text_info")[1]["text"], task_of_prompt(F.col("text_info")[0]["text"])))
    out = good.unionByName(rows.where("error is not null"))
    return out.select("file", "line_number", "image_info", "text_info", "error")


#: Bytes of each validation file that are read first; twice as many next, where these hold too few valid records.
FIRST_BYTES = 1 << 18


def first_valid(spark: SparkSession, path: str, limit: int, first_bytes: int = FIRST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(the first `limit` valid records of each file of a path, how far each file was read: path, length, at, lines, found).

    Files are read in rounds from their beginnings. A file takes part in the next round while it holds more and has shown fewer valid records
    than asked for, so what lies far behind the last of them is neither read nor parsed. All files of a round are read at once; only their
    number comes to the driver.
    """
    from scriptoria.sources.ranges import files, stretch_lines

    progress = files(spark, path).select("path", "length", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("lines"), F.lit(0).cast("long").alias("found"))
    valid: DataFrame | None = None
    take, progress = first_bytes, staged(progress)
    while True:
        open_ = (F.col("found") < limit) & (F.col("at") < F.col("length"))
        going = progress.where(open_)
        if going.isEmpty():
            break
        lines = staged(stretch_lines(going.select("path", "length", "at", "lines"), take))
        name = F.element_at(F.split("path", "/"), -1)
        good = staged(records_of(lines.select(name.alias("file"), "line_number", "value")).where("error is null"))
        valid = good if valid is None else valid.unionByName(good)
        ends = lines.groupBy("path").agg(F.max("end").alias("end"), F.max("line_number").alias("last"))
        shown = good.groupBy("file").agg(F.count("*").alias("more"))
        after = going.join(ends, "path", "left").join(shown, F.col("file") == name, "left")
        after = after.select("path", "length", F.coalesce("end", "length").alias("at"), F.coalesce("last", "lines").alias("lines"), (F.col("found") + F.coalesce("more", F.lit(0))).alias("found"))
        progress = staged(after.unionByName(progress.where(~open_)))
        take *= 2
    if valid is None:
        valid = records_of(spark.createDataFrame([], "file string, line_number long, value string"))
    ranked = valid.withColumn("rank", F.row_number().over(Window.partitionBy("file").orderBy("line_number"))).where(F.col("rank") <= limit).drop("rank")
    return ranked, progress


def read_validation(spark: SparkSession, path: str, limit: int) -> DataFrame:
    """The first `limit` valid records of each validation file with dataset, image, target and task."""
    from scriptoria.functions.text import task_of_prompt

    rows, _ = first_valid(spark, path, limit)
    dataset = F.regexp_replace(F.regexp_replace("file", r"\.jsonl$", ""), "^validation-", "")
    return rows.select(dataset.alias("dataset"), "line_number", F.col("image_info")[0]["image_url"].alias("image"), F.col("text_info")[1]["text"].alias("target"), task_of_prompt(F.col("text_info")[0]["text"]).alias("task"))


def read_predictions(spark: SparkSession, path: str, candidate: str | None = None) -> DataFrame:
    """Predictions in JSON lines, those of one candidate if it is named."""
    from scriptoria.schema import PREDICTION

    rows = spark.read.schema(PREDICTION).json(path)
    return rows if candidate is None else rows.where(F.col("candidate") == candidate)


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Detection label files: (file, line_number, value), a byte-order mark taken off."""
    return read_lines(spark, path)


def label_source(path: str) -> tuple[str, str]:
    """(root, label file) of a workspace folder, a metadata folder in it, or a label file itself."""
    p = Path(path)
    if p.is_file():
        return str(p.parent), str(p)
    for root, folder in ((p, p), (p, p / ".labels"), (p.parent, p)):
        for name in ("Label.txt", "label.txt", "labels.txt"):
            if (folder / name).is_file():
                return str(root), str(folder / name)
    raise FileNotFoundError(f"no label file in {path}")


def read_coco(spark: SparkSession, path: str, chunk_bytes: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, categories) of a COCO file with the place of each in its list. The document is read by as many tasks as it has parts."""
    from scriptoria.schema import COCO
    from scriptoria.sources.jsonparts import read_elements

    found = staged(read_elements(spark, path, **({"chunk_bytes": chunk_bytes, "partition_bytes": chunk_bytes} if chunk_bytes else {})))
    kinds = {f.name: f.dataType.elementType for f in spark.createDataFrame([], COCO).schema}
    of = lambda name: found.where(F.col("name") == name).select(F.col("place").cast("int").alias("place"), F.from_json("element", kinds[name]).alias("x")).select("place", "x.*")
    return of("images"), of("annotations"), of("categories")


#: Distinct lines that an alphabet file may have; a file of more is refused.
ALPHABET_LINES = 200_000


def read_alphabet(spark: SparkSession, path: str) -> str:
    """The characters of an alphabet file, one a line, and the space. It is a small file by its nature."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("c")).where("c <> ''").distinct()
    found = lines.limit(ALPHABET_LINES + 1).collect()
    if len(found) > ALPHABET_LINES:
        raise ValueError(f"{path} has more than {ALPHABET_LINES} lines, and so is no alphabet")
    return "".join(sorted({r[0] for r in found} | {" "}))


def read_tensor_header(spark: SparkSession, path: str) -> DataFrame:
    """(name, shard, dtype, shape) of the tensors of the files of a path, of which nothing but the headers is read."""
    from scriptoria.sources.tensorfiles import read_headers

    return read_headers(spark, path).select("name", F.element_at(F.split("path", "/"), -1).alias("shard"), "dtype", "shape")


def read_shard_index(spark: SparkSession, path: str) -> DataFrame:
    """(name, shard) of a tensor index."""
    return spark.read.schema("weight_map map<string,string>").json(path, multiLine=True).select(F.explode("weight_map").alias("name", "shard"))


def check_summary(spark: SparkSession, summary: dict, folder: str) -> DataFrame:
    """(file, declared, found, problem) of a prepared summary's sources; probabilities are checked before."""
    from scriptoria.operators.mix import summary_tasks

    summary_tasks(summary)
    for name in ("train_probabilities", "validation_probabilities"):
        if name in summary and abs(sum(summary[name]) - 1) > 1e-6:
            raise ValueError(f"{name} do not sum to one")
    declared = spark.createDataFrame([(s["file"], int(s["samples"])) for s in summary["sources"]], "file string, declared long")
    found = read_lines(spark, folder).where(F.trim("value") != "").groupBy("file").agg(F.count("*").alias("found"))
    joined = declared.join(found, "file", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return joined.withColumn("problem", F.when(F.col("found") != F.col("declared"), "count"))


def read_summary(path: str) -> dict:
    """A prepared run's summary; keys that the engine does not know stay."""
    from scriptoria.operators.mix import summary_tasks

    return summary_tasks(json.loads(Path(path).read_text(encoding="utf-8")))
