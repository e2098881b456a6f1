"""Reconciliation of tensors by name, merged weights, and comparison of logits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def array_errors(left: Column, right: Column) -> Column:
    """struct(max_abs_error, mean_abs_error, argmax_equal) of two arrays of one length."""
    delta = F.zip_with(left, right, lambda a, b: F.abs(a.cast("double") - b.cast("double")))
    mean = F.aggregate(delta, F.lit(0.0), lambda s, v: s + v) / F.size(delta)
    peak = lambda x: F.array_position(x, F.array_max(x))
    return F.struct(F.array_max(delta).alias("max_abs_error"), mean.alias("mean_abs_error"), (peak(left) == peak(right)).alias("argmax_equal"))


def within(errors: Column, max_abs: float = 1.0, mean_abs: float = 0.2) -> Column:
    """Whether the errors of logits are tolerable."""
    return (errors["max_abs_error"] <= max_abs) & (errors["mean_abs_error"] <= mean_abs)


def close(actual: Column, expected: Column, rtol: float = 5e-4, atol: float = 5e-4) -> Column:
    """Whether all of two arrays agree within atol + rtol * |expected|."""
    return F.forall(F.zip_with(actual, expected, lambda a, e: F.abs(a.cast("double") - e.cast("double")) <= atol + rtol * F.abs(e.cast("double"))), lambda ok: F.coalesce(ok, F.lit(False)))


def bfloat16(x: np.ndarray) -> np.ndarray:
    """float32 rounded to the nearest bfloat16, ties to even, as float32."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    rounded = (bits + np.uint32(0x7FFF) + ((bits >> np.uint32(16)) & np.uint32(1))) & np.uint32(0xFFFF0000)
    return np.where(np.isnan(x), np.float32(np.nan), rounded.view(np.float32))


def merged_weight(base: np.ndarray, a: np.ndarray, b: np.ndarray, scaling: float, low_precision: bool = False) -> np.ndarray:
    """base + (a @ b * scaling), turned to the base's layout; in low precision the delta and the sum are rounded, as stored weights are."""
    delta = (a.astype(np.float32) @ b.astype(np.float32) * np.float32(scaling)).T
    return bfloat16(base.astype(np.float32) + bfloat16(delta)) if low_precision else base.astype(np.float32) + delta


def reconcile(base: DataFrame, merged: DataFrame, adapter: DataFrame, scaling: float, low_precision: bool = False) -> DataFrame:
    """(name, status, error) of tensors (name, shape, values): missing, unexpected, unchanged, adapted, or mismatch of one of these.

    Adapter tensors are '<prefix>.lora_A' and '<prefix>.lora_B' for '<prefix>.weight'. A tensor must fit a task.
    """
    of = lambda df, p: df.select("name", F.col("shape").alias(f"{p}_shape"), F.col("values").alias(f"{p}_values"))
    half = lambda s, p: of(adapter.where(F.col("name").endswith(s)).withColumn("name", F.concat(F.regexp_replace("name", r"\.lora_[AB]$", ""), F.lit(".weight"))), p)
    joined = of(base, "base").join(of(merged, "merged"), "name", "full").join(half(".lora_A", "a"), "name", "left").join(half(".lora_B", "b"), "name", "left")

    def judge(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if r.base_values is None or r.merged_values is None:
                    out.append((r.name, "missing" if r.merged_values is None else "unexpected", None))
                    continue
                tensor = lambda p, r=r: np.asarray(getattr(r, f"{p}_values"), np.float32).reshape([int(n) for n in getattr(r, f"{p}_shape")])
                base_, merged_ = tensor("base"), tensor("merged")
                adapted = r.a_values is not None and r.b_values is not None
                expected = merged_weight(base_, tensor("a"), tensor("b"), scaling, low_precision) if adapted else base_
                same_shape = merged_.shape == expected.shape
                error = float(np.abs(merged_ - expected).max()) if same_shape and merged_.size else 0.0
                good = same_shape and (np.allclose(merged_, expected, rtol=5e-4, atol=5e-4) if adapted else np.array_equal(merged_, expected))
                out.append((r.name, ("adapted" if adapted else "unchanged") if good else "mismatch", error))
            yield pd.DataFrame(out, columns=["name", "status", "error"])

    return joined.mapInPandas(judge, "name string, status string, error double")


def _products(adapter: DataFrame, scaling: float) -> DataFrame:
    """(name, r, c, delta): tiles of the turned product of each adapter's halves, times `scaling`.

    A tile of a's rows c and b's columns r meet for each block of the rank; products of several blocks are added up.
    """
    half = lambda s: adapter.where(F.col("name").endswith(s)).withColumn("name", F.concat(F.regexp_replace("name", r"\.lora_[AB]$", ""), F.lit(".weight")))
    a = half(".lora_A").select("name", F.col("r").alias("c"), F.col("c").alias("k"), F.col("rows").alias("n"), F.col("columns").alias("depth"), F.col("values").alias("a"))
    b = half(".lora_B").select("name", F.col("r").alias("k"), F.col("c").alias("r"), F.col("columns").alias("m"), F.col("rows").alias("depth_b"), F.col("values").alias("b"))

    def multiply(batches):
        for pdf in batches:
            out = [np.ascontiguousarray((np.asarray(x.a, np.float32).reshape(x.n, x.depth) @ np.asarray(x.b, np.float32).reshape(x.depth, x.m)).T).ravel() for x in pdf.itertuples(index=False)]
            yield pd.DataFrame({"name": pdf["name"], "r": pdf["r"], "c": pdf["c"], "k": pdf["k"], "part": out})

    parts = a.join(b, ["name", "k"]).where("depth = depth_b").select("name", "r", "c", "k", "n", "m", "depth", "a", "b").mapInPandas(multiply, "name string, r int, c int, k int, part array<float>")
    # As many parts as blocks of the rank, which is small.
    blocks = parts.groupBy("name", "r", "c").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda s: s["part"]).alias("parts"))
    summed = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.element_at("parts", 1), lambda s, p: F.zip_with(s, p, lambda x, y: x + y))
    return blocks.select("name", "r", "c", F.transform(summed, lambda x: x * F.lit(scaling).cast("float")).alias("delta"))


def reconcile_tiles(base: DataFrame, merged: DataFrame, adapter: DataFrame, scaling: float, low_precision: bool = False) -> DataFrame:
    """What reconcile() tells, of tensors in tiles (name, shape, r, c, rows, columns, values), cut alike: no tensor need fit a task.

    The adapter's product is made tile by tile, each tile of the merged tensor is held against its own, and a tensor is good where all its
    tiles are; its error is the greatest of theirs.
    """
    shapes = lambda df, p: df.where("r = 0 and c = 0").select("name", F.col("shape").alias(f"{p}_shape"))
    matrix = lambda s: F.struct(F.aggregate(F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))), F.lit(1).cast("long"), lambda x, y: x * y).alias("rows"), F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(1).cast("long")).alias("columns"))
    half = lambda s, p: shapes(adapter.where(F.col("name").endswith(s)).withColumn("name", F.concat(F.regexp_replace("name", r"\.lora_[AB]$", ""), F.lit(".weight"))), p)
    told = shapes(base, "base").join(shapes(merged, "merged"), "name", "full").join(half(".lora_A", "a"), "name", "left").join(half(".lora_B", "b"), "name", "left")
    adapted = F.col("a_shape").isNotNull() & F.col("b_shape").isNotNull()
    own, a, b = matrix(F.col("base_shape")), matrix(F.col("a_shape")), matrix(F.col("b_shape"))
    fits = (F.col("base_shape") == F.col("merged_shape")) & (~adapted | (own["rows"] == b["columns"]) & (own["columns"] == a["rows"]) & (a["columns"] == b["rows"]))
    told = told.select("name", adapted.alias("adapted"), F.when(F.col("merged_shape").isNull(), "missing").when(F.col("base_shape").isNull(), "unexpected").when(~fits, "mismatch").alias("early"))
    alike = told.where("early is null").select("name")
    tiles = base.join(alike, "name", "left_semi").select("name", "r", "c", F.col("values").alias("base")).join(merged.select("name", "r", "c", F.col("values").alias("merged")), ["name", "r", "c"])
    tiles = tiles.join(_products(adapter, scaling), ["name", "r", "c"], "left")

    def judge(batches):
        for pdf in batches:
            out = []
            for x in pdf.itertuples(index=False):
                actual, expected = np.asarray(x.merged, np.float64), np.asarray(x.base, np.float64)
                if x.delta is not None:
                    delta = np.asarray(x.delta, np.float32)
                    expected = bfloat16(expected.astype(np.float32) + bfloat16(delta)) if low_precision else expected.astype(np.float32) + delta
                    good = np.allclose(actual.astype(np.float32), expected, rtol=5e-4, atol=5e-4)
                else:
                    good = np.array_equal(actual, expected)
                apart = np.abs(actual.astype(np.float32) - expected.astype(np.float32))
                out.append((x.name, bool(good), float(apart.max()) if apart.size else 0.0))
            yield pd.DataFrame(out, columns=["name", "good", "apart"])

    judged = tiles.select("name", "base", "merged", "delta").mapInPandas(judge, "name string, good boolean, apart double")
    worst = judged.groupBy("name").agg(F.bool_and("good").alias("good"), F.max("apart").alias("apart"))
    status = F.coalesce("early", F.when(~F.coalesce("good", F.lit(False)), "mismatch"), F.when(F.col("adapted"), "adapted").otherwise("unchanged"))
    return told.join(worst, "name", "left").select("name", status.alias("status"), F.when(F.col("early") == "mismatch", 0.0).when(F.col("early").isNull(), F.col("apart")).alias("error"))


def reconciliation(checked: DataFrame) -> DataFrame:
    """Counts by status and the greatest error of adapted tensors."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return checked.agg(n("unchanged"), n("adapted"), n("missing"), n("unexpected"), n("mismatch"), F.max(F.when(F.col("status") == "adapted", F.col("error"))).alias("max_error"))


def missing_projections(names: DataFrame, required: tuple[str, ...], name: str = "name") -> DataFrame:
    """(projection): which of the required projections no adapter parameter in `names` has."""
    found = names.select(F.regexp_extract(name, r"\.([a-z_]+)\.lora_", 1).alias("projection")).distinct()
    return names.sparkSession.createDataFrame([(p,) for p in required], "projection string").join(found, "projection", "left_anti")


def shape_differences(model: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """(name, problem) of tensors (name, shape) that a checkpoint lacks or has in another shape."""
    joined = model.join(checkpoint.select("name", F.col("shape").alias("found")), "name", "left")
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("shape"), "shape")
    return joined.select("name", problem.alias("problem")).where("problem is not null")
