"""Queries of evaluation: predictions made from the benchmark's texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions import text as t
from scriptoria.operators import evaluate, tensors
from scriptoria.plans.rows import table
from scriptoria.registry import query


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a base and a merged model for every benchmark item. Targets are ASCII, as DuckDB's distance counts bytes."""
    b = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_replace("text", r"[^\x00-\x7f]", "~").alias("target"))
    b = b.withColumn("dataset", F.concat(F.lit("set"), (F.col("item_id") % 3).cast("string"))).withColumn("image", F.concat(F.lit("i"), F.col("item_id").cast("string")))
    b = b.withColumn("task", F.when(F.col("item_id") % 4 == 0, F.lit(None)).when(F.col("item_id") % 4 == 1, "ocr").otherwise("formula"))
    base = b.withColumn("candidate", F.lit("base")).withColumn("prediction", F.when(F.col("item_id") % 2 == 0, F.col("target")).otherwise(F.replace("target", F.lit("th"), F.lit("t"))))
    merged = b.withColumn("candidate", F.lit("merged")).withColumn("prediction", F.when(F.col("item_id") % 5 == 0, F.replace("target", F.lit("e"), F.lit("ee"))).otherwise(F.col("target")))
    return base.unionByName(merged).withColumn("generated_tokens", F.length("prediction")).withColumn("max_new_tokens", F.lit(300))


_PREDICTIONS = r"""
    WITH b AS (SELECT item_id, regexp_replace(text, '[^\x00-\x7f]', '~', 'g') AS target, 'set' || (item_id % 3) AS dataset, 'i' || item_id AS image,
        CASE item_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'ocr' ELSE 'formula' END AS task FROM benchmark),
    p AS (SELECT *, 'base' AS candidate, CASE WHEN item_id % 2 = 0 THEN target ELSE replace(target, 'th', 't') END AS prediction FROM b
        UNION ALL SELECT *, 'merged', CASE WHEN item_id % 5 = 0 THEN replace(target, 'e', 'ee') ELSE target END FROM b),
    d AS (SELECT *, levenshtein(target, prediction) AS edits FROM p),
    m AS (SELECT candidate, CASE WHEN grouping(dataset) = 0 THEN 'dataset' WHEN grouping(task) = 0 THEN 'task' ELSE 'overall' END AS scope,
        CASE WHEN grouping(dataset) = 0 THEN dataset WHEN grouping(task) = 0 THEN task ELSE 'overall' END AS name, count(*) AS samples,
        CASE WHEN sum(length(target)) > 0 THEN sum(edits) / sum(length(target)) ELSE 0.0 END AS cer, avg(CAST(target = prediction AS INTEGER)) AS exact_match,
        avg(1 - edits / greatest(length(target), length(prediction), 1)) AS ned
        FROM d GROUP BY GROUPING SETS ((candidate), (candidate, dataset), (candidate, task))),
    g AS (SELECT * FROM m WHERE name IS NOT NULL)
"""


@query(_PREDICTIONS + "SELECT candidate, scope, name, samples, round(cer, 9) AS cer, round(exact_match, 9) AS exact_match, round(ned, 9) AS normalized_edit_distance FROM g")
def q_metrics_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics overall, by dataset and by task, of both models."""
    scored = evaluate.with_distance(predictions(spark, sf_dir))
    out = None
    for c in ("base", "merged"):
        m = evaluate.metrics(scored.where(F.col("candidate") == c)).withColumn("candidate", F.lit(c))
        out = m if out is None else out.unionByName(m)
    return out.select("candidate", "scope", "name", "samples", *(F.round(c, 9).alias(c) for c in ("cer", "exact_match", "normalized_edit_distance")))


@query(
    """WITH p AS (SELECT lang AS dataset, source AS task, text AS target, CASE doc_id % 3 WHEN 0 THEN replace(text, 'th', '') WHEN 1 THEN translate(text, 'e', '\U0001d522') ELSE '\u00df' || replace(text, ' ', '  ') END AS prediction,
        CASE doc_id % 3 WHEN 0 THEN length(text) - length(replace(text, 'th', '')) WHEN 1 THEN length(text) - length(replace(text, 'e', '')) ELSE 1 + length(text) - length(replace(text, ' ', '')) END AS edits
        FROM documents WHERE text IS NOT NULL),
    g AS (SELECT CASE WHEN grouping(dataset) = 0 THEN 'dataset' WHEN grouping(task) = 0 THEN 'task' ELSE 'overall' END AS scope, CASE WHEN grouping(dataset) = 0 THEN dataset WHEN grouping(task) = 0 THEN task ELSE 'overall' END AS name, count(*) AS samples,
        CASE WHEN sum(length(target)) > 0 THEN sum(edits) / sum(length(target)) ELSE 0.0 END AS cer, avg(CAST(target = prediction AS INTEGER)) AS exact_match, avg(1 - edits / greatest(length(target), length(prediction), 1)) AS ned
        FROM p GROUP BY GROUPING SETS ((), (dataset), (task)))
    SELECT scope, name, samples, round(cer, 9) AS cer, round(exact_match, 9) AS exact_match, round(ned, 9) AS normalized_edit_distance FROM g WHERE NOT (scope = 'task' AND name IS NULL)"""
)
def q_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of whole documents against edited copies, whose distances are known: pieces left out, letters replaced by ones beyond the BMP, or characters added."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    k, text = F.col("doc_id") % 3, F.col("text")
    copy = F.when(k == 0, F.replace(text, F.lit("th"), F.lit(""))).when(k == 1, F.translate(text, "e", "\U0001d522")).otherwise(F.concat(F.lit("\u00df"), F.replace(text, F.lit(" "), F.lit("  "))))
    p = d.select(F.col("lang").alias("dataset"), F.col("source").alias("task"), text.alias("target"), copy.alias("prediction"))
    m = evaluate.metrics(evaluate.with_distance(p))
    return m.select("scope", "name", "samples", *(F.round(c, 9).alias(c) for c in ("cer", "exact_match", "normalized_edit_distance")))


@query(
    _PREDICTIONS
    + """, j AS (SELECT m.name AS scope, m.cer, m.exact_match, m.ned, b.cer AS b_cer, b.exact_match AS b_exact, b.ned AS b_ned FROM g m LEFT JOIN g b ON b.candidate = 'base' AND b.scope = m.scope AND b.name = m.name
        WHERE m.candidate = 'merged' AND m.scope IN ('overall', 'task')),
    f AS (SELECT 'normalized_edit_distance_below_minimum' AS type, scope, 'normalized_edit_distance' AS metric, ned AS merged FROM j WHERE ned < 0.99
        UNION ALL SELECT 'cer_above_maximum', scope, 'cer', cer FROM j WHERE cer > 0.01
        UNION ALL SELECT 'regression_vs_base', scope, 'cer', cer FROM j WHERE cer > b_cer
        UNION ALL SELECT 'regression_vs_base', scope, 'exact_match', exact_match FROM j WHERE exact_match < b_exact
        UNION ALL SELECT 'regression_vs_base', scope, 'normalized_edit_distance', ned FROM j WHERE ned < b_ned
        UNION ALL SELECT 'truncated_generation', candidate || '/' || dataset || '/' || image, 'generated_tokens', CAST(length(prediction) AS DOUBLE) FROM p WHERE length(prediction) >= 300)
    SELECT type, scope, metric, round(merged, 9) AS merged FROM f"""
)
def q_gate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that keeps the merged model from passing under strict bounds."""
    p = predictions(spark, sf_dir).withColumn("truncated", evaluate.truncation(F.col("generated_tokens"), F.col("max_new_tokens"), F.lit(False))["truncated"])
    scored = evaluate.with_distance(p)
    base, merged = (evaluate.metrics(scored.where(F.col("candidate") == c)) for c in ("base", "merged"))
    return evaluate.gate_failures(base, merged, p, 0.99, 0.01).select("type", "scope", "metric", F.round("merged", 9).alias("merged"))


@query(
    """WITH p AS (SELECT CASE item_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'x' END AS candidate, item_id // 3 AS k FROM benchmark), c AS (SELECT candidate, count(*) AS n, list_sort(list(k)) AS s FROM p GROUP BY candidate),
    e AS (SELECT * FROM (VALUES ('a'), ('b'), ('c')) v(candidate)), w AS (SELECT count(*) // 3 AS n FROM benchmark)
    SELECT e.candidate, CASE WHEN coalesce(c.n, 0) <> (SELECT n FROM w) THEN 'incomplete' WHEN c.s <> (SELECT s FROM c WHERE candidate = 'a') THEN 'other fixtures' END AS problem FROM e LEFT JOIN c USING (candidate)
    WHERE coalesce(c.n, 0) <> (SELECT n FROM w) OR c.s <> (SELECT s FROM c WHERE candidate = 'a')
    UNION ALL SELECT candidate, 'unexpected candidate' FROM c WHERE candidate = 'x'"""
)
def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that lack fixtures or are not expected."""
    b = table(spark, sf_dir, "benchmark")
    k = F.col("item_id") % 3
    p = b.select(F.when(k == 0, "a").when(k == 1, "b").otherwise("x").alias("candidate"), F.lit("d").alias("dataset"), F.floor(F.col("item_id") / 3).cast("string").alias("image"))
    return evaluate.coverage_problems(p, ["a", "b", "c"], b.count() // 3)


@query("SELECT item_id, 'missing' AS problem FROM benchmark WHERE item_id % 7 = 0 UNION ALL SELECT item_id + 1000000, 'unexpected' FROM benchmark WHERE item_id % 11 = 0")
def q_fixture_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures that are missing or not expected."""
    b = table(spark, sf_dir, "benchmark").select("item_id")
    return evaluate.set_differences(b, b.where("item_id % 7 <> 0").union(b.where("item_id % 11 = 0").select(F.col("item_id") + 1000000)))


@query(
    """SELECT 'd' AS dataset, 'i' || item_id AS image, CASE item_id % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'target' ELSE 'task' END AS problem FROM benchmark WHERE item_id % 5 < 3
    UNION ALL SELECT 'd', 'j' || item_id, 'unexpected' FROM benchmark WHERE item_id % 9 = 0"""
)
def q_base_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base predictions that do not fit their fixtures."""
    b = table(spark, sf_dir, "benchmark")
    k = F.col("item_id") % 5
    fixtures = b.select(F.lit("d").alias("dataset"), F.concat(F.lit("i"), F.col("item_id").cast("string")).alias("image"), F.col("text").alias("target"), F.lit("ocr").alias("task"))
    base = b.where(k != 0).select(F.lit("d").alias("dataset"), F.concat(F.lit("i"), F.col("item_id").cast("string")).alias("image"), F.when(k == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("target"), F.when(k == 2, F.lit(None)).otherwise("ocr").alias("task"))
    extra = b.where("item_id % 9 = 0").select(F.lit("d").alias("dataset"), F.concat(F.lit("j"), F.col("item_id").cast("string")).alias("image"), F.col("text").alias("target"), F.lit("ocr").alias("task"))
    return evaluate.contract_problems(base.unionByName(extra), fixtures)


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report for each supplier, as if it were a checkpoint."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.concat(F.lit("checkpoint-"), F.col("s_suppkey").cast("string")).alias("checkpoint"), (F.col("s_nationkey") % 5 / 10).alias("cer"), (F.col("s_suppkey") % 3 / 4).alias("exact_match"), F.when(F.col("s_suppkey") % 2 == 0, F.lit(0.5)).alias("normalized_edit_distance"), F.when(F.col("s_suppkey") % 4 == 0, "failed").otherwise("passed").alias("status"))


_REPORTS = "WITH r AS (SELECT 'checkpoint-' || s_suppkey AS checkpoint, s_nationkey % 5 / 10 AS cer, s_suppkey % 3 / 4 AS exact_match, CASE WHEN s_suppkey % 2 = 0 THEN 0.5 END AS normalized_edit_distance, CASE WHEN s_suppkey % 4 = 0 THEN 'failed' ELSE 'passed' END AS status FROM supplier) "


@query(_REPORTS + "SELECT checkpoint, cer, exact_match FROM r WHERE status = 'passed' ORDER BY cer, exact_match DESC, coalesce(normalized_edit_distance, 0.0) DESC, checkpoint LIMIT 1")
def q_best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of the reports that passed."""
    return evaluate.best_checkpoint(evaluate.eligible(_reports(spark, sf_dir))).select("checkpoint", "cer", "exact_match")


@query(_REPORTS + "SELECT 'adapter' AS checkpoint UNION ALL (SELECT checkpoint FROM r ORDER BY CAST(substr(checkpoint, 12) AS BIGINT) DESC LIMIT 5)")
def q_latest_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final adapter and the five latest checkpoints."""
    return evaluate.latest_checkpoints(_reports(spark, sf_dir), 5)


@query(_REPORTS + "SELECT status, count(*) AS n FROM r GROUP BY status")
def q_eligible_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports in smoke mode by status: as some passed, those of each status apart."""
    r = _reports(spark, sf_dir)
    return evaluate.eligible(r, smoke=True).unionByName(evaluate.eligible(r.where("status = 'failed'"), smoke=True)).groupBy("status").agg(F.count("*").alias("n"))


@query(
    """SELECT conv_id, turn, length(text) >= 300 AND turn % 2 = 0 AS truncated, CASE WHEN length(text) >= 300 AND turn % 2 = 0 THEN 'length' WHEN turn % 2 = 1 THEN 'eos' ELSE 'stop' END AS finish_reason FROM conversations"""
)
def q_gen_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How generations of so many tokens ended."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", evaluate.truncation(F.length("text"), F.lit(300), F.col("turn") % 2 == 1).alias("s")).select("conv_id", "turn", "s.truncated", "s.finish_reason")


_NAMES = "WITH n AS (SELECT p_partkey, 'model.layers.' || p_size || CASE p_partkey % 4 WHEN 0 THEN '.self_attn.q_proj.lora_A' WHEN 1 THEN '.mlp.up_proj.lora_B' WHEN 2 THEN '.mlp.norm.weight' ELSE '.vision_model.k_proj.lora_A' END AS name FROM part) "


@query(_NAMES + "SELECT p_partkey, regexp_full_match(name, '(model\\.)?model\\.layers\\.[0-9]+\\.(self_attn\\.(q|k|v|o)_proj|mlp\\.(up|gate|down)_proj)\\.lora_[AB]') AS in_scope, contains(name, '.vision_model.') OR starts_with(name, 'visual.') AS is_vision FROM n".replace("\\\\", "\\"))
def q_parameter_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parameters inside and outside of what adapters may train."""
    k = F.col("p_partkey") % 4
    name = F.concat(F.lit("model.layers."), F.col("p_size").cast("string"), F.when(k == 0, ".self_attn.q_proj.lora_A").when(k == 1, ".mlp.up_proj.lora_B").when(k == 2, ".mlp.norm.weight").otherwise(".vision_model.k_proj.lora_A"))
    return table(spark, sf_dir, "part").select("p_partkey", t.in_adapter_scope(name).alias("in_scope"), t.is_vision(name).alias("is_vision"))


@query("SELECT x.p AS projection FROM (VALUES ('q_proj'), ('k_proj'), ('v_proj'), ('o_proj'), ('up_proj'), ('gate_proj'), ('down_proj')) x(p) WHERE x.p NOT IN ('q_proj', 'up_proj', 'k_proj')")
def q_missing_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projections that no adapter parameter has."""
    k = F.col("p_partkey") % 3
    name = F.concat(F.lit("model.layers.1.x."), F.when(k == 0, "q_proj").when(k == 1, "up_proj").otherwise("k_proj"), F.lit(".lora_A"))
    return tensors.missing_projections(table(spark, sf_dir, "part").select(name.alias("name")), t.PROJECTIONS)


@query(
    """SELECT a.vec_id, round(list_max(d), 6) AS max_abs_error, round(list_avg(d), 6) AS mean_abs_error, same AS argmax_equal, list_max(d) <= 0.3 AND list_avg(d) <= 0.2 AS tolerable
    FROM (SELECT a.vec_id, [abs(CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) FOR i IN range(1, 65)] AS d, list_position(a.embedding, list_max(a.embedding)) = list_position(b.embedding, list_max(b.embedding)) AS same
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1) a"""
)
def q_logits_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the next one, as if they were logits."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    both = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")
    x = both.select("vec_id", tensors.array_errors(F.col("embedding"), F.col("other")).alias("e"))
    return x.select("vec_id", F.round("e.max_abs_error", 6).alias("max_abs_error"), F.round("e.mean_abs_error", 6).alias("mean_abs_error"), "e.argmax_equal", tensors.within(F.col("e"), 0.3, 0.2).alias("tolerable"))


@query(
    """SELECT CAST(count(*) FILTER (vec_id % 10 > 3) AS BIGINT) AS unchanged, CAST(count(*) FILTER (vec_id % 10 = 1) AS BIGINT) AS adapted, CAST(count(*) FILTER (vec_id % 10 = 2) AS BIGINT) AS missing,
    CAST(count(*) FILTER (vec_id % 10 = 3) AS BIGINT) AS unexpected, CAST(count(*) FILTER (vec_id % 10 = 0) AS BIGINT) AS mismatch FROM embeddings"""
)
def q_tensor_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as tensors of a base and a merged model with an adapter of rank one."""
    e = table(spark, sf_dir, "embeddings").withColumn("k", F.col("vec_id") % 10)
    named = e.select("k", F.concat(F.lit("t"), F.col("vec_id").cast("string"), F.lit(".weight")).alias("name"), F.array(F.lit(8), F.lit(8)).alias("shape"), F.col("embedding").cast("array<double>").alias("values"))
    half = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: i / 8)
    # a is 8 x 1 and b 1 x 8: what they add to row r and column c of the turned delta is b[r] * a[c]
    delta = F.flatten(F.transform(half, lambda r: F.transform(half, lambda c: r * c * 0.5)))
    merged = F.when(F.col("k") == 1, F.zip_with("values", delta, lambda v, d: v + d)).when(F.col("k") == 0, F.transform("values", lambda v: v + 1)).otherwise(F.col("values"))
    base = named.where("k <> 3").drop("k")
    merged = named.where("k <> 2").withColumn("values", merged).drop("k")
    adapted = named.where("k = 1").select(F.regexp_replace("name", r"\.weight$", "").alias("prefix"))
    parts = [adapted.select(F.concat("prefix", F.lit(f".lora_{s}")).alias("name"), F.array(*(F.lit(n) for n in shape)).alias("shape"), half.alias("values")) for s, shape in (("A", (8, 1)), ("B", (1, 8)))]
    checked = tensors.reconcile(base, merged, parts[0].unionByName(parts[1]), 0.5)
    return tensors.reconciliation(checked).drop("max_error")


@query("SELECT 't' || vec_id AS name, CASE WHEN vec_id % 6 = 0 THEN 'missing' ELSE 'shape' END AS problem FROM embeddings WHERE vec_id % 6 < 2")
def q_shape_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tensors that a checkpoint lacks or has in another shape."""
    e = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("t"), F.col("vec_id").cast("string")).alias("name"), F.array(F.size("embedding")).alias("shape"), (F.col("vec_id") % 6).alias("k"))
    found = e.where("k <> 0").withColumn("shape", F.when(F.col("k") == 1, F.array(F.lit(1))).otherwise(F.col("shape")))
    return tensors.shape_differences(e.drop("k"), found.drop("k"))
