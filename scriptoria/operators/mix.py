"""Mixing: probabilities of sources, weights of runs, and their union."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.dims import PROMPTS, lookup


def sqrt_probabilities(counts: DataFrame, n: str = "n") -> DataFrame:
    """`counts` with probability: the share of the square root. One row a source, so one window over all is small."""
    root = F.sqrt(F.col(n).cast("double"))
    return counts.withColumn("probability", root / F.sum(root).over(Window.partitionBy()))


def normalised_weights(weights: list[float]) -> list[float]:
    """Positive finite weights as shares."""
    if not weights or any(not math.isfinite(w) or w <= 0 for w in weights):
        raise ValueError("weights must be finite and positive")
    total = math.fsum(weights)
    return [w / total for w in weights]


def union_runs(runs: list[DataFrame], weights: list[float] | None = None) -> DataFrame:
    """Sources of several runs (model, source, probability, ...) with run and probability = weight x the run's own.

    All runs must name one model. A single run keeps its probabilities.
    """
    shares = normalised_weights(weights or [1.0] * len(runs))
    models = reduce(DataFrame.unionByName, [r.select("model") for r in runs]).distinct().limit(2).collect()
    if len(models) != 1 or not models[0]["model"]:
        raise ValueError("runs use different base models, or none")
    parts = [r.withColumn("run", F.lit(i)).withColumn("probability", F.col("probability") * F.lit(w)) for i, (r, w) in enumerate(zip(runs, shares, strict=True))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sums_to_one(total: Column) -> Column:
    return F.abs(total - 1) <= 1e-6


def merged_rejections(maps: DataFrame, rejected: str = "rejected") -> DataFrame:
    """(reason, n): maps of counts, summed by reason."""
    return maps.select(F.explode(rejected).alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("n")).orderBy("reason")


def distinct_tasks(rows: DataFrame, task: str = "task") -> DataFrame:
    """One row (tasks, prompts): the tasks that occur, in their order, and their prompts. Tasks are few."""
    found = rows.where(F.col(task).isNotNull()).agg(F.sort_array(F.collect_set(task)).alias("tasks"))
    return found.select("tasks", F.transform("tasks", lambda x: lookup(PROMPTS, x)).alias("prompts"))


def max_steps(samples: Column, epochs: float, accumulation: int, devices: int = 1, batch: int = 1) -> Column:
    """Optimiser steps, rounded up."""
    return F.ceil(samples * F.lit(float(epochs)) / (batch * accumulation * devices)).cast("long")


def summary_tasks(summary: dict) -> dict:
    """A prepared summary with its tasks and prompts in order, also where it names one task the old way."""
    tasks = summary.get("tasks") or None
    if tasks is None:
        task = summary.get("task", "ocr")
        if task == "mixed":
            raise ValueError("a mixed summary needs a list of tasks")
        tasks = [task]
    if not all(isinstance(x, str) for x in tasks):
        raise TypeError("tasks must be strings")
    tasks = sorted(set(tasks))
    if unknown := [x for x in tasks if x not in PROMPTS]:
        raise ValueError(f"unknown tasks {unknown}")
    prompts = [PROMPTS[x] for x in tasks]
    if summary.get("prompt", prompts[0]) not in prompts:
        raise ValueError("the prompt is not that of a task")
    if "prompts" in summary and (not isinstance(summary["prompts"], list) or set(summary["prompts"]) != set(prompts)):
        raise ValueError("the prompts are not those of the tasks")
    out = {k: v for k, v in summary.items() if k not in ("task", "prompt")} | {"tasks": tasks, "prompts": prompts}
    return out | ({"task": tasks[0], "prompt": prompts[0]} if len(tasks) == 1 else {"task": "mixed"})
