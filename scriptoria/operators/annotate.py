"""Blocks of annotated pages: array expressions on ARRAY<STRUCT>, so that a page stays one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.dims import LABEL_TASK, LABELS
from scriptoria.functions import geometry as g
from scriptoria.functions import text as t
from scriptoria.functions.grammar import target_error_of


def changed(block: Column, **values: Column) -> Column:
    """`block` with some fields set."""
    for name, value in values.items():
        block = block.withField(name, value)
    return block


def in_order(blocks: Column) -> Column:
    """Blocks by order, ties as they were."""
    placed = F.transform(blocks, lambda b, i: F.struct(b["order"].alias("o"), i.alias("i"), b.alias("b")))
    return F.transform(F.array_sort(placed, lambda a, b: F.when((a["o"] < b["o"]) | ((a["o"] == b["o"]) & (a["i"] < b["i"])), -1).otherwise(1)), lambda p: p["b"])


def renumbered(blocks: Column) -> Column:
    """Blocks in their order, numbered from 0."""
    return F.transform(in_order(blocks), lambda b, i: changed(b, order=i))


def normalised(blocks: Column, width: Column, height: Column) -> Column:
    """Renumbered blocks with their polygons inside the picture."""
    return F.transform(renumbered(blocks), lambda b: changed(b, polygon=g.clamp(b["polygon"], width, height)))


def ocr_text(blocks: Column) -> Column:
    """All texts in order, a line each."""
    return F.array_join(F.transform(in_order(blocks), lambda b: b["text"]), "\n", "")


def page_text(blocks: Column) -> Column:
    """The filled texts of blocks that have a task and are not skipped."""
    used = F.filter(in_order(blocks), lambda b: ~F.coalesce(b["skipped"], F.lit(False)) & b["task"].isNotNull())
    return F.array_join(F.filter(F.transform(used, lambda b: t.strip(F.coalesce(b["text"], F.lit("")))), lambda x: x != ""), "\n")


def read_order(blocks: Column) -> Column:
    """Blocks that an export keeps, numbered anew: not skipped, of the taxonomy, with an area."""
    kept = F.filter(in_order(blocks), lambda b: ~F.coalesce(b["skipped"], F.lit(False)) & b["layout_label"].isin(*LABELS) & (g.area(b["polygon"]) > 0))
    return F.transform(kept, lambda b, i: changed(b, order=i))


def ocr_result(texts: Column, scores: Column, polygons: Column) -> Column:
    """Blocks of a recognition result; those with a blank text, a bad polygon or a bad score are dropped. Arrays of different length are an error."""
    same = (F.size(texts) == F.size(scores)) & (F.size(texts) == F.size(polygons))
    rows = F.transform(F.arrays_zip(texts.alias("t"), scores.alias("s"), polygons.alias("p")), lambda z: F.struct(t.strip(z["t"]).alias("text"), z["p"].alias("polygon"), g.score(z["s"]).alias("score"), F.lit("ocr").alias("source")))
    good = F.filter(rows, lambda b: (b["text"] != "") & (F.size(b["polygon"]) == 4) & g.finite(b["polygon"]) & b["score"].isNotNull())
    return F.when(same, F.transform(good, lambda b, i: b.withField("order", i))).otherwise(F.raise_error(F.lit("result arrays have different lengths")))


def detection_result(scores: Column, polygons: Column) -> Column:
    """As ocr_result(), of a detector: every text is the word 'text'."""
    return ocr_result(F.transform(polygons, lambda _: F.lit("text")), scores, polygons)


def layout_result(boxes: Column) -> Column:
    """Blocks of a layout result (label, coordinate, score); unknown labels and bad boxes are dropped, bad scores become null."""
    from scriptoria.dims import lookup

    rows = F.transform(boxes, lambda b: F.struct(t.strip(b["label"]).alias("layout_label"), g.layout_polygon(b["coordinate"]).alias("polygon"), g.score(b["score"]).alias("score"), F.lit("layout").alias("source")))
    good = F.filter(rows, lambda b: b["layout_label"].isin(*LABELS) & b["polygon"].isNotNull())
    return F.transform(good, lambda b, i: b.withField("task", lookup(LABEL_TASK, b["layout_label"])).withField("order", i))


def result_boxes(result: Column) -> Column:
    """The boxes of a layout result, a VARIANT, wherever they are nested."""
    paths = ("$.boxes", "$.result.boxes", "$.res.boxes", "$.res")
    return F.coalesce(*(F.try_variant_get(result, p, "array<variant>") for p in paths), F.array().cast("array<variant>"))


def llm_content(message: Column) -> Column:
    """The text of a chat answer, a VARIANT: a string, the joined text parts, or what it reasoned."""
    parts = F.transform(F.try_variant_get(message, "$.content", "array<variant>"), lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit("")))
    kind = F.schema_of_variant(F.try_variant_get(message, "$.content", "variant"))
    said = F.when(kind.startswith("ARRAY"), F.array_join(parts, "")).otherwise(F.try_variant_get(message, "$.content", "string"))
    return F.when(F.coalesce(said, F.lit("")) != "", said).otherwise(F.try_variant_get(message, "$.reasoning_content", "string"))


def ocr_completion_problem(blocks: Column) -> Column:
    """Why an OCR page cannot be completed, null if it can."""
    return (
        F.when(F.size(F.array_distinct(F.transform(blocks, lambda b: b["id"]))) < F.size(blocks), "block ids must be unique")
        .when(F.exists(blocks, lambda b: t.is_blank(b["text"])), "blocks need text")
    )


def source_problem(block: Column) -> Column:
    """Blocks drawn by hand have no score, recognised ones have one."""
    return F.when((block["source"] == "manual") & block["score"].isNotNull(), "manual block has a score").when((block["source"] == "ocr") & block["score"].isNull(), "recognised block has no score")


def completion_problems(blocks: DataFrame, page: str = "page") -> DataFrame:
    """(page, problem) of pages that cannot be completed, from one row a block: page, width, height and the block's fields.

    Rows without a task are judged by expressions; only those with one pass through the grammars.
    """
    active = blocks.where(~F.coalesce("skipped", F.lit(False)))
    tasked = active.where(F.col("task").isNotNull() & ~t.is_blank(F.col("text"))).withColumn("__target", target_error_of("text", "task"))
    plain = active.where(~(F.col("task").isNotNull() & ~t.is_blank(F.col("text")))).withColumn("__target", F.lit(None).cast("string"))
    all_active = tasked.unionByName(plain)
    area = g.area(g.clamp(F.col("polygon"), F.col("width"), F.col("height")))
    rank = F.when(~F.coalesce(F.col("layout_label").isin(*LABELS), F.lit(False)), 2).when(area <= 0, 3).when(F.col("task").isNotNull() & t.is_blank(F.col("text")), 4).when(F.col("__target").isNotNull(), 5)
    found = all_active.select(page, "order", rank.alias("rank")).where("rank is not null").groupBy(page).agg(F.min(F.struct("order", "rank")).alias("m")).select(page, F.col("m.rank").alias("rank"))
    none = blocks.groupBy(page).agg(F.max((~F.coalesce("skipped", F.lit(False))).cast("int")).alias("any")).where("any = 0").select(page, F.lit(1).alias("rank"))
    names = F.create_map(*(F.lit(x) for pair in {1: "no active block", 2: "label outside the taxonomy", 3: "no area", 4: "no text", 5: "invalid target"}.items() for x in pair))
    return found.unionByName(none).select(page, F.element_at(names, F.col("rank")).alias("problem"))


def fresh_validation(block: Column) -> Column:
    """The block's validation, null if its text has changed since."""
    return F.when(block["validation"]["text_hash"] == F.sha2(block["text"].cast("binary"), 256), block["validation"])


def eligible_for_validation(block: Column, selected: Column) -> Column:
    return selected & ~F.coalesce(block["skipped"], F.lit(False)) & block["task"].isin("ocr", "table", "chart") & ~t.is_blank(block["text"])


def issue_ok(text: Column, start: Column, end: Column, excerpt: Column) -> Column:
    """Whether an issue's offsets lie in the text and cut out its excerpt."""
    return F.coalesce((start >= 0) & (start < end) & (end <= F.length(text)) & (t.span(text, start, end) == excerpt), F.lit(False))


def needs_prelabel(blocks: Column, replace: bool = False) -> Column:
    """Whether some active block lacks a text (or there is one at all, where texts are replaced)."""
    return F.exists(blocks, lambda b: ~F.coalesce(b["skipped"], F.lit(False)) & b["task"].isNotNull() & (F.lit(replace) | t.is_blank(b["text"])))


def prelabelled(blocks: Column, texts: Column, selected: Column | None = None, replace: bool = False) -> Column:
    """Blocks with texts[id] for active ones that have none (or any, where texts are replaced)."""
    wanted = lambda b: ~F.coalesce(b["skipped"], F.lit(False)) & b["task"].isNotNull() & (F.lit(replace) | t.is_blank(b["text"])) & (F.array_contains(selected, b["id"]) if selected is not None else F.lit(True)) & F.map_contains_key(texts, b["id"])
    return F.transform(blocks, lambda b: F.when(F.coalesce(wanted(b), F.lit(False)), changed(b, text=F.element_at(texts, b["id"]), source=F.lit("vl"))).otherwise(b))


def unknown_ids(selected: Column, blocks: Column) -> Column:
    return F.array_except(selected, F.transform(blocks, lambda b: b["id"]))


def migrated(version: Column, status: Column, blocks: Column) -> Column:
    """struct(version, status, blocks) of a first-version sidecar: the label 'manual' is text, and pages without active blocks are not complete."""
    old = version == 1
    moved = F.transform(blocks, lambda b: F.when(b["layout_label"] == "manual", changed(b, layout_label=F.lit("text"))).otherwise(b))
    idle = ~F.exists(moved, lambda b: ~F.coalesce(b["skipped"], F.lit(False)))
    return F.struct(F.when(old, 2).otherwise(version).alias("version"), F.when(old & (status == "completed") & idle, "edited").otherwise(status).alias("status"), F.when(old, moved).otherwise(blocks).alias("blocks"))


def low_confidence(block: Column, selected_id: Column, bound: float = 0.6) -> Column:
    return (block["source"] == "ocr") & (block["score"] < bound) & ~block["id"].eqNullSafe(selected_id)


def hand_edited(block: Column) -> Column:
    """An edit by hand leaves no score and no validation."""
    return changed(block, source=F.lit("manual"), score=F.lit(None).cast("double"), validation=F.lit(None).cast("void"))


def catalog_status(catalog: DataFrame, sidecars: DataFrame, without: str = "not_ocr") -> DataFrame:
    """The images with the status of their sidecar (by path stem): error where the image has one, `without` where there is no sidecar."""
    found = catalog.join(sidecars.select("stem", F.col("status").alias("__status")), "stem", "left")
    return found.withColumn("status", F.when(F.col("error").isNotNull(), "error").otherwise(F.coalesce("__status", F.lit(without)))).drop("__status")


def filtered(images: DataFrame, status: str = "all", term: str = "") -> DataFrame:
    """Images of a status whose name has the term, case apart."""
    domain = ("all", "not_ocr", "ocr", "draft", "detected", "edited", "completed", "error")
    if status not in domain:
        raise ValueError(f"unknown status {status!r}")
    return images.where((F.lit(status == "all") | (F.col("status") == status)) & F.lower("name").contains(term.lower()))


def source_unchanged(catalog: DataFrame, current: DataFrame) -> DataFrame:
    """(image_id, unchanged): whether size, time and digest of a file are what the catalogue has."""
    keys = ("size_bytes", "mtime_ns", "sha256")
    now = current.select("image_id", *(F.col(k).alias(f"now_{k}") for k in keys))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"now_{k}"))
    return catalog.join(now, "image_id", "left").select("image_id", same.alias("unchanged"))


# Steps of an editor on the blocks of a page. An id that no block has leaves the blocks as they are; orders are numbered anew.


def _of(blocks: Column, block_id: Column, step) -> Column:
    return F.transform(blocks, lambda b: F.when(b["id"] == block_id, step(b)).otherwise(b))


def with_text(blocks: Column, block_id: Column, text: Column) -> Column:
    return renumbered(_of(blocks, block_id, lambda b: changed(b, text=text)))


def with_corner(blocks: Column, block_id: Column, corner: Column, x: Column, y: Column, width: Column, height: Column) -> Column:
    """One corner of a block's polygon, counted from 0, moved to (x, y) inside the picture."""
    point = F.get(g.clamp(F.array(F.array(x.cast("double"), y.cast("double"))), width, height), F.lit(0))
    moved = lambda b: changed(b, polygon=F.transform(b["polygon"], lambda p, i: F.when(i == corner, point).otherwise(p)))
    return renumbered(_of(blocks, block_id, moved))


def with_move(blocks: Column, block_id: Column, dx: Column, dy: Column, width: Column, height: Column) -> Column:
    return renumbered(_of(blocks, block_id, lambda b: changed(b, polygon=g.moved(b["polygon"], dx, dy, width, height))))


def with_block(blocks: Column, block: Column, width: Column, height: Column) -> Column:
    """One block more (of the blocks' own type) behind the others: inside the picture, drawn by hand, and so without a score."""
    new = changed(block, order=F.size(blocks), polygon=g.clamp(block["polygon"], width, height), source=F.lit("manual"), score=F.lit(None).cast("double"))
    return renumbered(F.concat(renumbered(blocks), F.array(new)))


def without_block(blocks: Column, block_id: Column) -> Column:
    return renumbered(F.filter(blocks, lambda b: b["id"] != block_id))


def with_place(blocks: Column, block_id: Column, place: Column) -> Column:
    """A block moved to a place in the order, counted from 0 among the others."""
    ordered = in_order(blocks)
    rest = F.filter(ordered, lambda b: b["id"] != block_id)
    at = g.between(place, 0, F.size(rest)).cast("int")
    whole = F.concat(F.slice(rest, F.lit(1), at), F.filter(ordered, lambda b: b["id"] == block_id), F.slice(rest, at + 1, F.size(rest)))
    return F.transform(whole, lambda b, i: changed(b, order=i))


def saved_blocks(blocks: Column) -> Column:
    """Blocks as a save leaves them: validations of texts that have changed since are gone."""
    return F.transform(blocks, lambda b: changed(b, validation=fresh_validation(b)))


def issue_count(block: Column) -> Column:
    """How many issues a block's validation has; 0 without one."""
    return F.when(block["validation"]["issues"].isNull(), 0).otherwise(F.size(block["validation"]["issues"]))


def with_issues(blocks: DataFrame, issues: DataFrame, page: str = "page") -> DataFrame:
    """`blocks` (page, id, ...) with n_issues: how many rows of `issues` (page, id) each one has. Issues are summed up before they are joined."""
    n = issues.groupBy(page, "id").agg(F.count("*").alias("n_issues"))
    return blocks.join(n, [page, "id"], "left").withColumn("n_issues", F.coalesce("n_issues", F.lit(0)))


def annotation_matches(catalog: DataFrame, annotations: DataFrame) -> DataFrame:
    """(image_id, matches): whether an annotation (image_id, path, width, height, sha256) was made of the picture in the catalogue; without one it is null."""
    keys = ("path", "width", "height", "sha256")
    own = annotations.select("image_id", F.lit(True).alias("annotated"), *(F.col(k).alias(f"a_{k}") for k in keys))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"a_{k}"))
    return catalog.join(own, "image_id", "left").select("image_id", F.when(F.col("annotated"), same).alias("matches"))
