import math

import pytest
from pyspark.sql import functions as F

from scriptoria import config
from scriptoria.functions.grammar import CELL  # noqa: F401
from scriptoria.operators import admission, annotate, dedup, evaluate, mix, split, tensors
from scriptoria.schema import BLOCK


def test_metrics_golden(spark):
    rows = spark.createDataFrame([("d", "ocr", "abc", "abc"), ("d", None, "abcd", "abXd")], "dataset string, task string, target string, prediction string")
    m = {(r["scope"], r["name"]): r for r in evaluate.metrics(evaluate.with_distance(rows)).collect()}
    assert set(m) == {("overall", "overall"), ("dataset", "d"), ("task", "ocr")}
    o = m["overall", "overall"]
    assert (o["samples"], o["exact_match"], o["normalized_edit_distance"]) == (2, 0.5, 0.875) and math.isclose(o["cer"], 1 / 7)
    assert evaluate.report(evaluate.metrics(evaluate.with_distance(rows))).first()["report"].startswith('{"overall":{"samples":2')


def test_multitask_counts(spark):
    rows = [("ok", None, 100, 100), ("", None, 100, 100), ("a\x07", None, 100, 100), ("ok", None, 1, 100), ("ok", None, 100_000, 100_000), ("x" * 3000, None, 100, 100), ("ok", "nope", 100, 100), ("no table", "table", 100, 100)]
    df = spark.createDataFrame(rows, "text string, task string, w int, h int")
    got = {r["reason"]: r["n"] for r in admission.reason_counts(admission.multitask(df, admission.BudgetLimits(), width="w", height="h")).collect()}
    assert got == {"empty_text": 1, "control_character": 1, "invalid_image": 1, "pixel_limit_exceeded": 1, "token_budget_exceeded": 1, "invalid_task": 1, "invalid_target_schema": 1}


def test_detection_bad_first_occurrence_does_not_shadow(spark):
    good = '[{"transcription":"a","points":[[0,0],[9,0],[9,9],[0,9]]}]'
    lines = [("s", 1, "a.png\t[", 10, 10, "h"), ("s", 2, f"a.png\t{good}", 10, 10, "h"), ("s", 3, f"b.png\t{good}", 10, 10, "h"), ("t", 1, "a.png\t[", 10, 10, "h"), ("t", 2, f"/a.png\t{good}", 10, 10, "k"), ("t", 3, "", None, None, None)]
    rows, lost = admission.detection(spark.createDataFrame(lines, "source string, line_number long, value string, width int, height int, sha256 string"))
    got = {(r["source"], r["line_number"]): r["reason"] for r in rows.collect()}
    assert got == {("s", 1): "invalid_json", ("s", 2): None, ("s", 3): "duplicate_image", ("t", 1): "duplicate_image", ("t", 2): "unsafe_image_path", ("t", 3): "empty_line"}
    assert lost.count() == 5


def test_dedup_equals_a_loop(spark):
    rows = [(i, f"d{i * 7 % 5}", i % 3 != 0) for i in range(60)]
    got = {r["i"]: r["verdict"] for r in dedup.first_admitted(spark.createDataFrame(rows, "i int, d string, ok boolean"), F.col("d"), F.col("i"), F.col("ok")).collect()}
    seen, expected = set(), {}
    for i, d, ok in rows:
        expected[i] = "duplicate" if d in seen else "admitted" if ok else "own"
        if ok:
            seen.add(d)
    assert got == expected


@pytest.mark.parametrize(("n", "ratio", "k"), [(10, 0.2, 2), (20, 0.2, 4), (1, 0.5, 0), (2, 0.9, 1), (5, 0.5, 2), (0, 0.5, 0)])
def test_holdout_size(spark, n, ratio, k):
    assert spark.range(1).select(split.holdout_size(F.lit(n).cast("long"), ratio)).first()[0] == k


def test_split_is_disjoint_and_whole(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("s"))
    got = split.stratified(rows, "s", "id", 0.1, 1)
    assert got.count() == 1000 == got.select("id").distinct().count()
    assert {r["n"] for r in got.where("split = 'validation'").groupBy("s").agg(F.count("*").alias("n")).collect()} == {14}


def test_chosen_splits():
    assert split.chosen_splits(["train", "dev", "test"]) == ("train", "dev")
    assert split.chosen_splits(["all"]) == ("all", None)
    with pytest.raises(ValueError):
        split.chosen_splits(["a", "b"])


def test_mixing(spark):
    p = mix.sqrt_probabilities(spark.createDataFrame([(9,), (1,)], "n int")).collect()
    assert [r["probability"] for r in p] == [0.75, 0.25]
    assert mix.normalised_weights([3, 1]) == [0.75, 0.25]
    for bad in ([], [0], [math.nan]):
        with pytest.raises(ValueError):
            mix.normalised_weights(bad)
    assert mix.summary_tasks({"task": "ocr"})["prompts"] == ["OCR:"]
    with pytest.raises(ValueError):
        mix.summary_tasks({"task": "mixed"})


def test_best_checkpoint_ties(spark):
    rows = [("b", 0.1, 0.5, None, "passed"), ("a", 0.1, 0.5, None, "passed"), ("c", 0.1, 0.4, 0.9, "passed"), ("d", 0.0, 1.0, 1.0, "failed")]
    reports = spark.createDataFrame(rows, "checkpoint string, cer double, exact_match double, normalized_edit_distance double, status string")
    assert evaluate.best_checkpoint(evaluate.eligible(reports)).first()["checkpoint"] == "a"
    assert evaluate.eligible(reports.where("status = 'failed'")).count() == 0
    assert evaluate.eligible(reports.where("status = 'failed'"), smoke=True).count() == 1


def test_gate_equal_is_no_regression(spark):
    m = spark.createDataFrame([("overall", "overall", 1, 0.1, 0.5, 0.9), ("task", "ocr", 1, 0.1, 0.5, 0.9)], "scope string, name string, samples long, cer double, exact_match double, normalized_edit_distance double")
    assert evaluate.gate_failures(m, m).count() == 0
    worse = m.withColumn("cer", F.col("cer") + 0.01)
    assert {(r["type"], r["scope"]) for r in evaluate.gate_failures(m, worse).collect()} == {("regression_vs_base", "overall"), ("regression_vs_base", "ocr")}


def test_bfloat16_ties_to_even():
    import numpy as np

    x = np.array([1.0, 1.00390625, 1.01171875, -2.5, 3.14159], np.float32)
    assert tensors.bfloat16(x).tolist() == [1.0, 1.0, 1.015625, -2.5, 3.140625]


def test_read_order_after_skipping(spark):
    block = lambda i, order, skipped: (f"{i}", order, "x", [[0.0, 0.0], [5.0, 0.0], [5.0, 5.0], [0.0, 5.0]], None, "layout", "text", "ocr", skipped, None)
    df = spark.createDataFrame([([block(0, 2, False), block(1, 1, True), block(2, 0, False)],)], f"blocks array<{BLOCK}>")
    assert [(b["id"], b["order"]) for b in df.select(annotate.read_order(F.col("blocks")).alias("b")).first()["b"]] == [("2", 0), ("0", 1)]
    assert df.select(annotate.page_text(F.col("blocks")).alias("t")).first()["t"] == "x\nx"


def test_results(spark):
    texts, scores = F.lit(["a", " ", "b"]), F.array(F.lit("0.5"), F.lit("0.5"), F.lit("2"))
    quad = F.lit([[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]])
    got = spark.range(1).select(annotate.ocr_result(texts, scores, F.array(quad, quad, quad)).alias("b")).first()["b"]
    assert [(b["order"], b["text"], b["score"]) for b in got] == [(0, "a", 0.5)]
    v = spark.range(1).select(F.parse_json(F.lit('{"res":{"boxes":[{"label":"text"},{"label":"x"}]}}')).alias("v"))
    assert v.select(F.size(annotate.result_boxes(F.col("v")))).first()[0] == 2
    m = spark.range(1).select(F.parse_json(F.lit('{"content":[{"text":"a"},{"text":"b"}]}')).alias("a"), F.parse_json(F.lit('{"content":"","reasoning_content":"r"}')).alias("b"))
    assert tuple(m.select(annotate.llm_content(F.col("a")), annotate.llm_content(F.col("b"))).first()) == ("ab", "r")


def test_settings():
    config.MultitaskRun()
    for make in (lambda: config.RecognitionRun(epochs=0), lambda: config.DetectionRun(crop=100), lambda: config.MultitaskRun(min_pixels=10, max_pixels=5), lambda: config.Service(port=0), lambda: config.Service(device="tpu")):
        with pytest.raises(ValueError):
            make()
