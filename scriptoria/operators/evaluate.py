"""Scoring of predictions, coverage of fixtures, gates against regressions, and choice of checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions import distance


def with_distance(predictions: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """`predictions` with edits (code points), once for all metrics. Long texts cost most: rows are dealt out evenly first, whatever they hold."""
    return predictions.hint("rebalance").withColumn("edits", distance.edits(F.col(target), F.col(prediction)))


def similarity(edits: Column, target: Column, prediction: Column) -> Column:
    """1 for the same texts, 0 for nothing in common: higher is better."""
    return 1 - edits / F.greatest(F.length(target), F.length(prediction), F.lit(1))


def metrics(scored: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    """(scope, name, samples, cer, exact_match, normalized_edit_distance): overall, by dataset, and by task where there is one.

    One pass: grouping sets of plain sums. cer is all edits over all target characters (0 if there are none).
    """
    size = F.length(target)
    rows = scored.select("dataset", "task", "edits", size.cast("long").alias("chars"), F.col(target).eqNullSafe(F.col(prediction)).cast("int").alias("same"), similarity(F.col("edits"), F.col(target), F.col(prediction)).alias("near"))
    sets = rows.groupingSets([[], [F.col("dataset")], [F.col("task")]], F.col("dataset"), F.col("task"))
    out = sets.agg(F.grouping_id().alias("set"), F.count("*").alias("samples"), F.sum("edits").alias("edits"), F.sum("chars").alias("chars"), F.avg("same").alias("exact_match"), F.avg("near").alias("normalized_edit_distance"))
    scope = F.when(F.col("set") == 3, "overall").when(F.col("set") == 1, "dataset").otherwise("task")
    name = F.when(F.col("set") == 3, "overall").when(F.col("set") == 1, F.col("dataset")).otherwise(F.col("task"))
    out = out.select(scope.alias("scope"), name.alias("name"), "samples", F.when(F.col("chars") > 0, F.col("edits") / F.col("chars")).otherwise(0.0).alias("cer"), "exact_match", "normalized_edit_distance")
    return out.where(~((F.col("scope") == "task") & F.col("name").isNull()))


def truncation(generated: Column, limit: Column, ends: Column) -> Column:
    """struct(ended_with_eos, truncated, finish_reason) of a generation of so many tokens that ends in an end token or not."""
    cut = (generated >= limit) & ~ends
    return F.struct(ends.alias("ended_with_eos"), cut.alias("truncated"), F.when(cut, "length").when(ends, "eos").otherwise("stop").alias("finish_reason"))


def coverage_problems(predictions: DataFrame, candidates: list[str], fixtures: int) -> DataFrame:
    """(candidate, problem): every candidate must have each of `fixtures` fixtures (dataset, image) once, and all the same ones."""
    spark = predictions.sparkSession
    expected = spark.createDataFrame([(c,) for c in candidates], "candidate string")
    seen = predictions.groupBy("candidate", "dataset", "image").agg(F.count("*").alias("times"))
    by = seen.groupBy("candidate").agg(F.sum("times").alias("n"), F.count("*").alias("distinct"))
    # Fixtures of the first candidate that each one has: it has the same ones if these are all of its own and all of the first's.
    reference = seen.where(F.col("candidate") == min(candidates)).select("dataset", "image")
    same = seen.join(reference, ["dataset", "image"]).groupBy("candidate").agg(F.count("*").alias("same"))
    known = expected.join(by, "candidate", "left").join(same, "candidate", "left").select("candidate", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "distinct", "same")))
    first = reference.agg(F.count("*").alias("of_first"))
    problem = F.when(F.col("n") > F.col("distinct"), "duplicate fixture").when(F.col("n") != fixtures, "incomplete").when((F.col("same") != F.col("distinct")) | (F.col("same") != F.col("of_first")), "other fixtures")
    # one row joined to a few
    own = known.join(F.broadcast(first)).select("candidate", problem.alias("problem")).where("problem is not null")
    return own.unionByName(by.join(expected, "candidate", "left_anti").select("candidate", F.lit("unexpected candidate").alias("problem")))


def set_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """`expected` minus `actual` as missing, and the other way round as unexpected; repeated rows count."""
    missing = expected.exceptAll(actual).withColumn("problem", F.lit("missing"))
    return missing.unionByName(actual.exceptAll(expected).withColumn("problem", F.lit("unexpected")))


def contract_problems(base: DataFrame, fixtures: DataFrame) -> DataFrame:
    """(dataset, image, problem) of base predictions against fixtures: all must be there, with the same target and task."""
    b = base.select("dataset", "image", F.col("target").alias("b_target"), F.col("task").alias("b_task"), F.lit(1).alias("in_base"))
    f = fixtures.select("dataset", "image", F.col("target").alias("f_target"), F.col("task").alias("f_task"), F.lit(1).alias("in_fixtures"))
    both = f.join(b, ["dataset", "image"], "full")
    problem = F.when(F.col("in_base").isNull(), "missing").when(F.col("in_fixtures").isNull(), "unexpected").when(~F.col("b_target").eqNullSafe(F.col("f_target")), "target").when(~F.col("b_task").eqNullSafe(F.col("f_task")), "task")
    return both.select("dataset", "image", problem.alias("problem")).where("problem is not null")


def gate_failures(base: DataFrame, merged: DataFrame, predictions: DataFrame | None = None, min_similarity: float = 0.5, max_cer: float = 1.0) -> DataFrame:
    """(type, scope, metric, base, merged, bound) of all that keeps a model from passing, by metrics() of it and of its base.

    Scopes are overall and the merged model's tasks; tasks of the base alone are not looked at. Equal is no regression.
    """
    scoped = merged.where("scope in ('overall', 'task')")
    joined = scoped.join(base.select("scope", "name", *(F.col(c).alias(f"b_{c}") for c in ("cer", "exact_match", "normalized_edit_distance"))), ["scope", "name"], "left")
    checks = F.array(
        F.struct(F.lit("normalized_edit_distance_below_minimum").alias("type"), F.lit("normalized_edit_distance").alias("metric"), F.lit(None).cast("double").alias("base"), F.col("normalized_edit_distance").alias("merged"), F.lit(min_similarity).alias("bound"), (F.col("normalized_edit_distance") < min_similarity).alias("fails")),
        F.struct(F.lit("cer_above_maximum").alias("type"), F.lit("cer").alias("metric"), F.lit(None).cast("double").alias("base"), F.col("cer").alias("merged"), F.lit(max_cer).alias("bound"), (F.col("cer") > max_cer).alias("fails")),
        *(
            F.struct(F.lit("regression_vs_base").alias("type"), F.lit(m).alias("metric"), F.col(f"b_{m}").alias("base"), F.col(m).alias("merged"), F.lit(None).cast("double").alias("bound"), F.coalesce((F.col(m) > F.col(f"b_{m}")) if m == "cer" else (F.col(m) < F.col(f"b_{m}")), F.lit(False)).alias("fails"))
            for m in ("cer", "exact_match", "normalized_edit_distance")
        ),
    )
    out = joined.select("name", F.explode(checks).alias("c")).where("c.fails").select("c.type", F.col("name").alias("scope"), "c.metric", "c.base", "c.merged", "c.bound")
    if predictions is not None:
        cut = predictions.where("truncated").select(F.lit("truncated_generation").alias("type"), F.concat_ws("/", "candidate", "dataset", "image").alias("scope"), F.lit("generated_tokens").alias("metric"), F.lit(None).cast("double").alias("base"), F.col("generated_tokens").cast("double").alias("merged"), F.col("max_new_tokens").cast("double").alias("bound"))
        out = out.unionByName(cut)
    return out


def eligible(reports: DataFrame, smoke: bool = False) -> DataFrame:
    """Reports with status passed; if there are none, all in smoke mode, else no rows."""
    passed = F.col("status") == "passed"
    any_passed = F.max(passed.cast("int")).over(Window.partitionBy())  # a few reports
    marked = reports.withColumn("__any", any_passed)
    return marked.where(passed | (F.lit(smoke) & (F.col("__any") == 0))).drop("__any")


def best_checkpoint(reports: DataFrame) -> DataFrame:
    """The report with the least cer, then most exact matches, then most similarity, then first name."""
    return reports.orderBy("cer", F.desc("exact_match"), F.desc(F.coalesce("normalized_edit_distance", F.lit(0.0))), "checkpoint").limit(1)


def latest_checkpoints(names: DataFrame, k: int) -> DataFrame:
    """The final adapter, and the k checkpoints with the highest numbers."""
    numbered = names.select("checkpoint", F.regexp_extract("checkpoint", r"^checkpoint-(\d+)$", 1).alias("n")).where("n <> ''")
    top = numbered.orderBy(F.desc(F.col("n").cast("long"))).limit(k).select("checkpoint")
    return names.sparkSession.createDataFrame([("adapter",)], "checkpoint string").union(top)


def verification(failures: Column, verified: Column) -> Column:
    return F.when(~verified, "unverified").when(failures > 0, "failed").otherwise("passed")


def report(metric_rows: DataFrame) -> DataFrame:
    """One JSON document of metrics(): overall, datasets and tasks by name."""
    entry = F.struct("samples", "cer", "exact_match", "normalized_edit_distance")
    named = lambda scope: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("scope") == scope, F.struct(F.col("name"), entry.alias("m"))))))
    return metric_rows.agg(F.to_json(F.struct(F.max(F.when(F.col("scope") == "overall", entry)).alias("overall"), named("dataset").alias("datasets"), named("task").alias("tasks"))).alias("report"))
