"""Admission cascades: every row is admitted, or rejected for the first reason that holds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.functions import geometry as g
from scriptoria.functions import text as t
from scriptoria.functions.grammar import target_error_of
from scriptoria.scratch import staged


def first_reason(checks: list[tuple[str, Column, Column | None]]) -> tuple[Column, Column]:
    """(reason, detail) of the first check that holds; both null where none does. Later checks may rely on earlier ones."""
    reason = why = F.lit(None).cast("string")
    for name, holds, detail in reversed(checks):
        fails = F.coalesce(holds, F.lit(False))
        reason = F.when(fails, F.lit(name)).otherwise(reason)
        why = F.when(fails, detail if detail is not None else F.lit("")).otherwise(why)
    return reason, t.detail(why)


@dataclass(frozen=True)
class RecognitionLimits:
    alphabet: str
    max_text_length: int = 80
    max_image_pixels: int = 100_000_000

    def __post_init__(self) -> None:
        if self.max_text_length <= 0 or self.max_image_pixels <= 0:
            raise ValueError("limits must be positive")


def image_problem(width: Column, height: Column, max_pixels: int, min_side: int = 1) -> Column:
    """invalid_image for sides up to min_side or unknown, pixel_limit_exceeded for too many pixels, else null."""
    return F.when(width.isNull() | height.isNull() | (width <= min_side) | (height <= min_side), "invalid_image").when(width.cast("long") * height.cast("long") > max_pixels, "pixel_limit_exceeded")


def recognition(rows: DataFrame, limits: RecognitionLimits, label: str = "label", text: str = "text", load_error: str | None = None, width: str | None = None, height: str | None = None) -> DataFrame:
    """`rows` with target, reason and detail. Image sides are checked where their columns are named (an image over the limit is invalid)."""
    source = lambda name: F.col(name) if name in rows.columns else F.lit(None).cast("string")
    out = rows.withColumn("target", t.recognition_text(source(label), source(text)))
    target = F.col("target")
    unknown = t.unsupported(target, limits.alphabet + " ")
    checks = [
        ("empty_text", target == "", None),
        ("control_character", t.has_control(target), None),
        ("text_too_long", F.length(target) > limits.max_text_length, t.too_long_detail(target, limits.max_text_length)),
        ("unsupported_characters", t.has_unsupported(target, limits.alphabet + " "), F.array_join(unknown, "")),
    ]
    if load_error:
        checks.insert(0, ("row_load_error", F.col(load_error).isNotNull(), F.col(load_error)))
    if width and height:
        problem = image_problem(F.col(width), F.col(height), limits.max_image_pixels)
        checks.append(("invalid_image", problem.isNotNull(), problem))
    reason, why = first_reason(checks)
    return out.withColumn("reason", reason).withColumn("detail", why)


@dataclass(frozen=True)
class BudgetLimits:
    max_seq_len: int = 2048
    min_pixels: int = 50_176
    max_pixels: int = 451_584
    max_image_pixels: int = 100_000_000
    default_task: str = "ocr"

    def __post_init__(self) -> None:
        if min(self.max_seq_len, self.min_pixels, self.max_pixels, self.max_image_pixels) <= 0 or self.min_pixels > self.max_pixels:
            raise ValueError("limits must be positive and in order")


def multitask(rows: DataFrame, limits: BudgetLimits, task: str = "task", label: str = "label", text: str = "text", width: str | None = None, height: str | None = None, tokenizer: object = None) -> DataFrame:
    """`rows` with task, prompt, target, reason and detail: tasks, grammars and the token budget.

    The grammars run in Python, and only over table, chart and formula rows: the other rows are plain
    expressions, and both parts are put together again.
    """
    source = lambda name: F.col(name) if name in rows.columns else F.lit(None).cast("string")
    out = rows.withColumn("__raw_task", source(task)).withColumn("task", t.resolved_task(F.col("__raw_task"), limits.default_task)).withColumn("prompt", t.prompt_of(F.col("task"))).withColumn("target", t.target_text(source(label), source(text)))
    hard = F.coalesce(F.col("task").isin("table", "chart", "formula") & (F.col("target") != ""), F.lit(False))
    out = out.where(hard).withColumn("__schema", target_error_of("target", "task")).unionByName(out.where(~hard).withColumn("__schema", F.lit(None).cast("string")))
    # Long expressions are columns of their own, so that they stand in the plan once, whatever uses them.
    target = F.col("target")
    n = g.text_tokens(F.col("prompt"), target, tokenizer)
    if width and height:
        w, h = F.col(width), F.col(height)
        out = out.withColumn("__visual", g.visual_tokens(h, w, limits.min_pixels, limits.max_pixels)).withColumn("__problem", image_problem(w, h, limits.max_image_pixels))
        n = n + F.col("__visual")
    out = out.withColumn("n_tokens", n.cast("long"))
    checks = [
        ("invalid_task", F.col("task").isNull(), F.col("__raw_task")),
        ("empty_text", target == "", None),
        ("invalid_target_schema", F.col("__schema").isNotNull(), F.col("__schema")),
        ("control_character", t.has_control(target, keep_line_feed=True), None),
    ]
    if width and height:
        problem = F.col("__problem")
        checks += [("pixel_limit_exceeded", problem == "pixel_limit_exceeded", None), ("invalid_image", (problem == "invalid_image") | F.col("__visual").isNull(), None)]
    n = F.col("n_tokens")
    checks.append(("token_budget_exceeded", n > limits.max_seq_len, F.concat(n.cast("string"), F.lit(f" > {limits.max_seq_len}"))))
    reason, why = first_reason(checks)
    return out.withColumn("reason", reason).withColumn("detail", why).drop("__schema", "__raw_task", "__visual", "__problem")


def unsafe_path(path: Column) -> Column:
    return (path == "") | path.startswith("/") | path.rlike(r"(^|/)\.\.(/|$)")


BOX = "struct<transcription:string,points:array<array<double>>>"


def parsed_label_line(lines: DataFrame, value: str = "value", unless: Column | None = None) -> DataFrame:
    """A line 'path TAB json' in parts: path, payload, and the boxes that the payload has, if it is an array of objects.

    Where `unless` holds, the payload is left as it is, and json and boxes are null.

    Elements are read one by one from a VARIANT, so that one bad box (a truth value or text for a number)
    spoils no other.
    """
    parts = F.split(F.col(value), "\t", 2)
    out = lines.withColumn("path", parts[0]).withColumn("payload", F.get(parts, F.lit(1)))
    json = F.try_parse_json("payload")
    out = out.withColumn("json", json if unless is None else F.when(~unless, json))
    return out.withColumn("boxes", F.try_variant_get("json", "$", "array<variant>"))


_NUMBER = r"(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"


def box_points(box: Column) -> Column:
    """The points of a box as doubles; null coordinates for what is not a number. Null if there is no list of points.

    Points that are numbers throughout are read in one go; only others are looked at one by one.
    """
    whole = F.try_variant_get(box, "$.points", "variant")
    points = F.try_variant_get(box, "$.points", "array<variant>")
    number = lambda v: F.when(F.schema_of_variant(v).rlike(f"^{_NUMBER}$"), F.try_variant_get(v, "$", "double"))
    mixed = F.transform(points, lambda p: F.transform(F.try_variant_get(p, "$", "array<variant>"), number))
    plain = F.schema_of_variant(whole).rlike(rf"^ARRAY<ARRAY<{_NUMBER}>>$")
    return F.when(plain, F.try_variant_get(box, "$.points", "array<array<double>>")).otherwise(mixed)


def detection(lines: DataFrame, min_area: float = 1.0, max_image_pixels: int = 100_000_000) -> tuple[DataFrame, DataFrame]:
    """(rows, rejections) of detection label lines.

    `lines` has source, line_number, value, and of the image that the line names (null where it is missing)
    width, height and sha256. Of lines with the same image, over all sources, the first good one is admitted;
    a bad one before it takes nothing from it, and all behind it are duplicates. A line may be admitted while
    some of its boxes are rejected: these are rejections of their own.
    """
    w, h = F.col("width"), F.col("height")
    path = F.split("value", "\t", 2)[0]
    before = [
        ("empty_line", t.is_blank(F.col("value")), None),
        ("invalid_line", F.size(F.split("value", "\t", 2)) < 2, F.lit("missing tab separator")),
        ("unsafe_image_path", unsafe_path(path), path),
        ("missing_image", F.col("sha256").isNull(), path),
        ("invalid_image", image_problem(w, h, max_image_pixels, 0).isNotNull(), image_problem(w, h, max_image_pixels, 0)),
    ]
    if "file_problem" in lines.columns:  # what reading the file has shown comes before what its sides do
        told = F.col("file_problem")
        before[3:4] = [("missing_image", told == "missing", path), ("unsafe_image_path", told == "outside", path), ("invalid_image", told.isNotNull(), F.col("file_detail"))]
    early, early_detail = first_reason(before)
    # What fails so far is not parsed: no one asks for its boxes.
    out = parsed_label_line(lines.withColumn("early", early).withColumn("early_detail", early_detail), unless=F.col("early").isNotNull())
    # Each step is a transform of its own, so that what it has computed is bound and not computed again.
    raw = F.transform("boxes", lambda b: F.struct(t.transcription(F.try_variant_get(b, "$.transcription", "string")).alias("transcription"), F.when(F.schema_of_variant(b).startswith("OBJECT"), box_points(b)).alias("raw")))
    snapped = F.transform(raw, lambda b: b.withField("points", g.snapped(b["raw"], w, h)))
    judged = F.transform(snapped, lambda b: b.withField("problem", g.polygon_problem(b["raw"], b["points"], min_area)))
    out = out.withColumn("judged", judged)
    out = out.withColumn("labels", F.transform(F.filter("judged", lambda b: b["problem"].isNull()), lambda b: F.struct(b["transcription"], b["points"])))
    behind = [
        ("invalid_json", F.col("json").isNull(), None),
        ("empty_boxes", F.coalesce(F.size("boxes"), F.lit(0)) < 1, F.lit("at least one box is required")),
        ("no_valid_boxes", F.size("labels") == 0, None),
    ]
    late, late_detail = first_reason(behind)
    out = out.withColumn("late", F.when(F.col("early").isNull(), late)).withColumn("late_detail", late_detail)
    # Two read this: the winners, and the lines that they are joined to. Parsing and geometry are done once.
    out = staged(out.select("source", "line_number", "path", "sha256", "width", "height", "judged", "labels", "early", "early_detail", "late", "late_detail"))
    place = F.struct("source", "line_number")
    good = F.col("early").isNull() & F.col("late").isNull()
    # The winners are one row for each image, summed up in the tasks before they are shuffled, and joined back.
    winners = out.where(good).groupBy(F.col("sha256").alias("won")).agg(F.min(place).alias("first"))
    out = out.join(winners, F.col("sha256") == F.col("won"), "left")
    duplicate = F.col("early").isNull() & (place > F.col("first"))
    reason = F.when(F.col("early").isNotNull(), F.col("early")).when(duplicate, "duplicate_image").otherwise(F.col("late"))
    why = F.when(F.col("early").isNotNull(), F.col("early_detail")).when(duplicate, F.col("sha256")).otherwise(F.col("late_detail"))
    out = out.withColumn("reason", reason).withColumn("detail", why)
    rows = out.select("source", "line_number", "path", "sha256", "width", "height", "reason", "detail", F.when(F.col("reason").isNull(), F.col("labels")).alias("labels"))
    # One pass: a line's own rejection and those of its boxes are one array.
    none = F.lit(None).cast("int")
    of_line = F.when(F.col("reason").isNotNull(), F.array(F.struct(none.alias("box_index"), F.col("reason").alias("reason"), F.col("detail").alias("detail"))))
    read = F.col("reason").isNull() | (F.col("reason") == "no_valid_boxes")
    placed = F.transform("judged", lambda b, i: F.struct(F.when(b["problem"].isNotNull(), i).alias("box_index"), F.lit("invalid_box").alias("reason"), b["problem"].alias("detail")))
    of_boxes = F.when(read, F.filter(placed, lambda e: e["box_index"].isNotNull()))
    empty = F.filter(F.array(F.struct(none.alias("box_index"), F.lit("").alias("reason"), F.lit("").alias("detail"))), lambda e: e["reason"] != "")
    events = F.concat(F.coalesce(of_boxes, empty), F.coalesce(of_line, empty))
    return rows, out.select("source", "line_number", F.explode(events).alias("e")).select("source", "line_number", "e.box_index", "e.reason", "e.detail")


def detection_of_files(lines: DataFrame, min_area: float = 1.0, max_image_pixels: int = 100_000_000) -> tuple[DataFrame, DataFrame]:
    """As detection(), of label lines (source, line_number, value, root) alone: the files that they name under `root` are looked up and read.

    Each distinct file is read once, by one task, and no file that no line names; lines whose path leaves the root are not looked up.
    What is told of the files is written out before it is joined to the lines, of which many may name one file.
    """
    from scriptoria.sources.images import named_files

    path = F.split("value", "\t", 2)[0]
    wanted = ~t.is_blank(F.col("value")) & (F.size(F.split("value", "\t", 2)) > 1) & ~unsafe_path(path)
    full = F.when(wanted, F.concat(F.rtrim(F.col("root"), F.lit("/")), F.lit("/"), path))
    placed = lines.withColumn("file_path", full)
    told = staged(named_files(placed.select(F.col("file_path").alias("path"), "root"), max_image_pixels))
    told = told.select(F.col("path").alias("file_path"), "width", "height", "sha256", F.col("problem").alias("file_problem"), F.col("detail").alias("file_detail"))
    return detection(placed.join(told, "file_path", "left").drop("file_path", "root"), min_area, max_image_pixels)


def reason_counts(rows: DataFrame) -> DataFrame:
    """Rejections by reason, in its order.

    Counted, not filtered first: Spark would move a filter on the reason below what computes it, and compute it twice.
    """
    return rows.groupBy("reason").agg(F.count("reason").alias("n")).where("n > 0").orderBy("reason")


def ledger(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, reason, detail) of the rejected rows: taken out of an array that admitted rows do not have, for the same cause."""
    told = F.when(F.col("reason").isNotNull(), F.array(F.struct("reason", "detail")))
    return rows.select(*keys, F.explode(told).alias("__r")).select(*keys, "__r.reason", "__r.detail")
