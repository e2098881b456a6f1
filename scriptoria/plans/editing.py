"""Queries of engines' results, editors' steps, batches and pictures, over parts, turns and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.functions import geometry as g
from scriptoria.functions import grammar
from scriptoria.functions import text as t
from scriptoria.operators import admission, annotate, evaluate, mix
from scriptoria.plans.pages import _BLOCKS, pages, region_tables, turn_blocks
from scriptoria.plans.rows import ALPHABET, sql_strip, table
from scriptoria.registry import query
from scriptoria.sources import images
from scriptoria.streaming import revisions


def square() -> object:
    return F.array(*(F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (9, 0), (9, 9), (0, 9))))


@query(
    """SELECT p_partkey, 'ocr' AS kind, 0 AS place, p_name AS text, round(p_size / 60.0, 6) AS score FROM part
    UNION ALL SELECT p_partkey, 'ocr', 1, p_type, 0.9 FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0
    UNION ALL SELECT p_partkey, 'detection', 0, 'text', round(p_size / 60.0, 6) FROM part UNION ALL SELECT p_partkey, 'detection', 1, 'text', 0.5 FROM part
    UNION ALL SELECT p_partkey, 'detection', 2, 'text', 0.9 FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0"""
)
def q_engine_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of recognition and detection results with blank texts, bad scores and bad polygons."""
    k3, k5 = F.col("p_partkey") % 3 == 0, F.col("p_partkey") % 5 == 0
    texts = F.array("p_name", F.lit("  "), "p_type")
    scores = F.array(F.col("p_size") / 60.0, F.lit(0.5), F.when(k3, 1.5).otherwise(0.9))
    polygons = F.array(square(), square(), F.when(k5, F.slice(square(), 1, 3)).otherwise(square()))
    p = table(spark, sf_dir, "part")
    parts = [p.select("p_partkey", F.lit(kind).alias("kind"), F.explode(blocks).alias("b")) for kind, blocks in (("ocr", annotate.ocr_result(texts, scores, polygons)), ("detection", annotate.detection_result(scores, polygons)))]
    return parts[0].unionByName(parts[1]).select("p_partkey", "kind", F.col("b.order").alias("place"), "b.text", F.round("b.score", 6).alias("score"))


@query("SELECT p_partkey, 0 AS place, 'table' AS layout_label, 'table' AS task, 0.5 AS score, 4 AS corners FROM part UNION ALL SELECT p_partkey, 1, 'image', NULL, NULL, 4 FROM part UNION ALL SELECT p_partkey, 2, 'text', 'ocr', NULL, 4 FROM part WHERE p_partkey % 4 <> 0")
def q_layout_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of layout results: unknown labels and bad boxes go, bad scores become null."""
    n = F.col("p_size").cast("double")
    box = lambda label, numbers, score: F.struct(F.lit(label).alias("label"), numbers.alias("coordinate"), F.lit(score).alias("score"))
    four, eight = F.array(F.lit(0.0), F.lit(0.0), n, n), F.array(F.lit(0.0), F.lit(0.0), n, F.lit(0.0), n, n, F.lit(0.0), n)
    last = F.when(F.col("p_partkey") % 4 == 0, F.array(n, n, n)).otherwise(eight)
    boxes = F.array(box(" table ", four, "0.5"), box("nonsense", four, "0.5"), box("image", eight, "x"), box("text", last, "2.0"))
    b = table(spark, sf_dir, "part").select("p_partkey", F.explode(annotate.layout_result(boxes)).alias("b"))
    return b.select("p_partkey", F.col("b.order").alias("place"), "b.layout_label", "b.task", "b.score", F.size("b.polygon").alias("corners"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 0 ELSE 2 END AS n, CASE WHEN event_id % 5 <> 4 THEN 'a' || event_id END AS first FROM events")
def q_layout_nesting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of layout results, wherever they are nested."""
    k = F.col("event_id") % 5
    boxes = F.format_string('[{"label":"a%d"},{"label":"b"}]', "event_id")
    json = F.when(k == 0, F.concat(F.lit('{"boxes":'), boxes, F.lit("}"))).when(k == 1, F.concat(F.lit('{"result":{"boxes":'), boxes, F.lit("}}"))).when(k == 2, F.concat(F.lit('{"res":{"boxes":'), boxes, F.lit("}}"))).when(k == 3, F.concat(F.lit('{"res":'), boxes, F.lit("}"))).otherwise('{"other":1}')
    e = table(spark, sf_dir, "events").select("event_id", annotate.result_boxes(F.parse_json(json)).alias("b"))
    return e.select("event_id", F.size("b").alias("n"), F.try_variant_get(F.get("b", F.lit(0)), "$.label", "string").alias("first"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'x' || event_id WHEN 1 THEN 'a' || event_id WHEN 2 THEN 'r' || event_id END AS content FROM events")
def q_llm_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of chat answers: plain, in parts, or only reasoned."""
    k = F.col("event_id") % 4
    json = F.when(k == 0, F.format_string('{"content":"x%d"}', "event_id")).when(k == 1, F.format_string('{"content":[{"text":"a"},{"image":1},{"text":"%d"}]}', "event_id")).when(k == 2, F.format_string('{"content":"","reasoning_content":"r%d"}', "event_id")).otherwise('{"content":null}')
    return table(spark, sf_dir, "events").select("event_id", annotate.llm_content(F.parse_json(json)).alias("content"))


@query(_BLOCKS + f"SELECT conv_id, CASE WHEN conv_id % 11 = 0 AND count(*) > 1 THEN 'block ids must be unique' WHEN bool_or({sql_strip('text')} = '') THEN 'blocks need text' END AS problem FROM b GROUP BY conv_id")
def q_ocr_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why OCR pages cannot be completed."""
    rows = turn_blocks(spark, sf_dir).withColumn("id", F.when(F.col("conv_id") % 11 == 0, "same").otherwise(F.col("id")))
    return rows.groupBy("conv_id").agg(F.collect_list(F.struct("id", "text")).alias("blocks")).select("conv_id", annotate.ocr_completion_problem(F.col("blocks")).alias("problem"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN 'manual block has a score' WHEN event_id % 2 = 1 AND event_id % 3 = 0 THEN 'recognised block has no score' END AS problem FROM events")
def q_block_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks whose score does not go with their source."""
    e = table(spark, sf_dir, "events")
    block = F.struct(F.when(F.col("event_id") % 2 == 0, "manual").otherwise("ocr").alias("source"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("score"))
    return e.select("event_id", annotate.source_problem(block).alias("problem"))


@query(_BLOCKS + f"SELECT conv_id, bool_or(coalesce(NOT skipped AND task IS NOT NULL AND {sql_strip('text')} = '', FALSE)) AS needed, bool_or(coalesce(NOT skipped AND task IS NOT NULL, FALSE)) AS replaceable FROM b GROUP BY conv_id")
def q_prelabel_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with active blocks that lack a text, and with active blocks at all."""
    b = F.col("blocks")
    return pages(spark, sf_dir).select("conv_id", annotate.needs_prelabel(b).alias("needed"), annotate.needs_prelabel(b, True).alias("replaceable"))


@query("WITH c AS (SELECT conv_id, list(conv_id || '-' || turn) AS ids FROM conversations GROUP BY conv_id) SELECT conv_id, array_to_string([x FOR x IN [conv_id || '-0', conv_id || '-5', 'x'] IF NOT list_contains(ids, x)], ',') AS unknown FROM c")
def q_unknown_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected blocks that their page does not have."""
    name = lambda k: F.concat_ws("-", "conv_id", F.lit(k))
    return pages(spark, sf_dir).select("conv_id", t.csv(annotate.unknown_ids(F.array(name("0"), name("5"), F.lit("x")), F.col("blocks"))).alias("unknown"))


@query("SELECT conv_id, turn, 'manual' AS source, CAST(NULL AS DOUBLE) AS score, turn % 2 = 0 AS validated, CAST(turn % 3 AS INTEGER) AS n_issues FROM conversations")
def q_hand_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks edited by hand, those that keep their validation through a save, and their issues."""
    sha = F.sha2(F.col("text").cast("binary"), 256)
    validation = F.struct(F.when(F.col("turn") % 2 == 0, sha).otherwise("other").alias("text_hash"), F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (F.col("turn") % 3).cast("int")).alias("issues"))
    b = turn_blocks(spark, sf_dir).withColumn("validation", validation)
    whole = F.struct("text", "source", "score", "validation")
    kept = F.get(annotate.saved_blocks(F.array(whole)), F.lit(0))
    e = b.select("conv_id", "turn", annotate.hand_edited(whole).alias("e"), kept.alias("k"), annotate.issue_count(whole).alias("n_issues"))
    return e.select("conv_id", "turn", "e.source", F.col("e.score").cast("double").alias("score"), F.col("k.validation").isNotNull().alias("validated"), "n_issues")


@query("WITH i AS (SELECT user_id AS conv_id, user_id || '-' || (event_id % 4) AS id, count(*) AS n FROM events GROUP BY ALL) SELECT c.conv_id, c.conv_id || '-' || turn AS id, CAST(coalesce(n, 0) AS BIGINT) AS n_issues FROM conversations c LEFT JOIN i ON i.conv_id = c.conv_id AND i.id = c.conv_id || '-' || turn")
def q_issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of each block: events as issues."""
    issues = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id"), F.concat_ws("-", "user_id", (F.col("event_id") % 4).cast("string")).alias("id"))
    return annotate.with_issues(turn_blocks(spark, sf_dir).select("conv_id", "id"), issues, "conv_id")


@query("SELECT p_partkey AS image_id, CASE WHEN p_partkey % 4 <> 3 THEN p_partkey % 4 <> 1 END AS matches FROM part")
def q_annotation_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations that are of the picture that the catalogue has; some pictures have none."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("image_id"), F.col("p_name").alias("path"), F.col("p_size").alias("width"), F.lit(None).cast("int").alias("height"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha256"))
    notes = p.where("image_id % 4 <> 3").withColumn("width", F.col("width") + (F.col("image_id") % 4 == 1).cast("int"))
    return annotate.annotation_matches(p, notes)


@query(
    """WITH s AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity * 40 AS DOUBLE) AS w, CAST(l_linenumber * 150 + 1 AS DOUBLE) AS h FROM lineitem),
    f AS (SELECT *, least(800 / w, 600 / h, 1.0) AS sc FROM s), v AS (SELECT *, (800 - w * sc) / 2 AS x, (600 - h * sc) / 2 AS y, greatest(least(w / 160, 8), 0.1) AS z FROM f)
    SELECT l_orderkey, l_linenumber, round(sc, 6) AS scale, round(x, 6) AS x, round(100 - (100 - x) / sc * z + 5, 6) AS zoomed_x, round(50 - (50 - y) / sc * z - 3, 6) AS zoomed_y, z AS zoom, round((400 - x) / sc, 6) AS image_x, round((400 - x) / sc * sc + x, 6) AS screen_x FROM v"""
)
def q_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures fitted into a view, zoomed at a point, and panned."""
    fitted = g.fit_view(F.lit(800.0), F.lit(600.0), (F.col("l_quantity") * 40).cast("double"), (F.col("l_linenumber") * 150 + 1).cast("double"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", fitted.alias("v"))
    v = F.col("v")
    zoomed = g.panned_view(g.zoomed_view(v, F.lit(100.0), F.lit(50.0), F.col("l_quantity") / 4), F.lit(5.0), F.lit(-3.0))
    at = g.to_image(F.lit(400.0), v["scale"], v["x"])
    r = lambda c, name: F.round(c, 6).alias(name)
    return rows.select("l_orderkey", "l_linenumber", r(v["scale"], "scale"), r(v["x"], "x"), r(zoomed["x"], "zoomed_x"), r(zoomed["y"], "zoomed_y"), zoomed["scale"].alias("zoom"), r(at, "image_x"), r(g.to_screen(at, v["scale"], v["x"]), "screen_x"))


@query(
    """WITH b AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 60 AS DOUBLE) AS a, CAST(l_suppkey % 40 AS DOUBLE) AS b, CAST(l_quantity AS DOUBLE) AS q, CAST(l_linenumber AS DOUBLE) AS n, l_linenumber % 4 AS k FROM lineitem),
    s AS (SELECT *, least(a, q) AS x1, greatest(a, q) AS x2, least(b, n) AS y1, greatest(b, n) AS y2 FROM b),
    m AS (SELECT *, least(greatest(q - 30, -x1), 63 - x2) AS dx, least(greatest(n - 4, -y1), 47 - y2) AS dy FROM s)
    SELECT l_orderkey, l_linenumber, [x1, y1, x2, y2] AS box, [x1 + dx, y1 + dy, x2 + dx, y2 + dy] AS moved,
        [CASE k WHEN 3 THEN least(greatest(q + 20, 0), 63, greatest(x2 - 1, 0)) ELSE x1 END, CASE k WHEN 0 THEN least(greatest(q - 25, 0), 47, greatest(y2 - 1, 0)) ELSE y1 END,
         CASE k WHEN 1 THEN least(63, greatest(least(greatest(q + 20, 0), 63), least(63, x1 + 1))) ELSE x2 END, CASE k WHEN 2 THEN least(47, greatest(least(greatest(q - 25, 0), 47), least(47, y1 + 1))) ELSE y2 END] AS resized FROM m"""
)
def q_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles drawn, moved, and dragged at an edge, in a picture of 64 by 48."""
    q, n = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double")
    box = g.dragged_box((F.col("l_partkey") % 60).cast("double"), (F.col("l_suppkey") % 40).cast("double"), q, n)
    edge = F.element_at(F.array(*map(F.lit, ("top", "right", "bottom", "left"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "lineitem").withColumn("rect", box)
    w, h = F.lit(64), F.lit(48)
    moved, resized = g.moved(F.col("rect"), q - 30, n - 4, w, h), g.resized_edge(F.col("rect"), edge, q + 20, q - 25, w, h)
    return rows.select("l_orderkey", "l_linenumber", g.bounds(F.col("rect")).alias("box"), g.bounds(moved).alias("moved"), F.array(resized[0][0], resized[0][1], resized[2][0], resized[2][1]).alias("resized"))


@query(
    """WITH s AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS q, l_partkey % 60 + 0.25 AS x, l_suppkey % 40 + 0.75 AS y, l_linenumber AS n FROM lineitem),
    b AS (SELECT *, floor(x) AS l, floor(y) AS t, least(greatest(ceil(x + q / 2), floor(x) + 1), 64) AS r, least(greatest(ceil(y + n), floor(y) + 1), 48) AS e FROM s),
    z AS (SELECT *, CASE WHEN n % 2 = 0 THEN least(300 / (r - l), 200 / (e - t)) ELSE least(greatest(q / 10, 0.25), 4) END AS sc FROM b)
    SELECT l_orderkey, l_linenumber, [l, t, r - l, e - t] AS box, round(sc, 6) AS scale, round((greatest(300, greatest(1, (r - l) * sc)) - greatest(1, (r - l) * sc)) / 2, 6) AS clip_left, round(-t * sc, 6) AS image_top,
        least(greatest(q * 20, 340), greatest(340, least(760, n * 300 - 245 - 9 - 420))) AS pane, round(least(greatest(n * 100 * least(greatest(q / 50, 0.2), 0.72), 130), greatest(130, n * 100 - 9 - 180)), 6) AS height,
        round(least(greatest(least(greatest(q * 10, 130), greatest(130, n * 100 - 9 - 180)) / (n * 100), 0.2), 0.72), 6) AS share FROM z"""
)
def q_inspector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops of blocks as an inspector shows them, and the sides of its panes."""
    q, n = F.col("l_quantity").cast("double"), F.col("l_linenumber")
    x, y = F.col("l_partkey") % 60 + 0.25, F.col("l_suppkey") % 40 + 0.75
    rows = table(spark, sf_dir, "lineitem").withColumn("box", g.crop_rect(g.box_polygon(F.array(x, y, x + q / 2, y + n)), F.lit(64), F.lit(48)))
    view = g.crop_view(F.col("box"), F.lit(64), F.lit(48), F.lit(300), F.lit(200), F.when(n % 2 == 1, q / 10))
    rows = rows.withColumn("v", view)
    r = lambda c, name: F.round(c, 6).alias(name)
    box = F.array("box.left", "box.top", "box.width", "box.height")
    return rows.select("l_orderkey", "l_linenumber", box.alias("box"), r(F.col("v.scale"), "scale"), r(F.col("v.clip_left"), "clip_left"), r(F.col("v.image_top"), "image_top"), g.inspector_width(q * 20, n * 300).alias("pane"), r(g.crop_height(n * 100, q / 50), "height"), r(g.crop_share(n * 100, q * 10), "share"))


@query(
    """WITH c AS (SELECT conv_id, turn, conv_id || '-' || turn AS id, CASE WHEN turn = 1 THEN 'new' WHEN turn % 4 = 3 THEN '  ' ELSE ' ' || text END AS text FROM conversations)
    SELECT conv_id, sha256(string_agg(text, chr(10) ORDER BY turn DESC)) AS text_sha, coalesce(string_agg(CASE WHEN turn <> 1 THEN id END, ',' ORDER BY turn DESC), '') AS less, string_agg(id, ',' ORDER BY turn DESC) || ',more' AS more,
        CASE WHEN max(turn) >= 1 THEN array_to_string([x FOR x IN list(id ORDER BY turn DESC) IF x <> conv_id || '-0'][:1] || [conv_id || '-0'] || [x FOR x IN list(id ORDER BY turn DESC) IF x <> conv_id || '-0'][2:], ',') ELSE conv_id || '-0' END AS placed,
        [39.0, 0.0] AS corner, [10.0, 3.0] AS shifted FROM c GROUP BY conv_id HAVING min(turn) = 0"""
)
def q_editor_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages after a change of text, a block less, one more, one in another place, a corner and a block moved."""
    p = pages(spark, sf_dir).withColumn("first", F.concat_ws("-", "conv_id", F.lit("0"))).withColumn("second", F.concat_ws("-", "conv_id", F.lit("1")))
    p = p.where(F.exists("blocks", lambda b: b["id"] == F.col("first")))
    b, first, second, w = F.col("blocks"), F.col("first"), F.col("second"), F.lit(40)
    ids = lambda blocks: t.csv(F.transform(blocks, lambda x: x["id"]))
    of = lambda blocks: F.get(F.filter(blocks, lambda x: x["id"] == first), F.lit(0))["polygon"]
    more = annotate.with_block(b, annotate.changed(F.get(b, F.lit(0)), id=F.lit("more")), w, w)
    return p.select(
        "conv_id", F.sha2(annotate.ocr_text(annotate.with_text(b, second, F.lit("new"))).cast("binary"), 256).alias("text_sha"), ids(annotate.without_block(b, second)).alias("less"), ids(more).alias("more"),
        ids(annotate.with_place(b, first, F.lit(1))).alias("placed"), F.get(of(annotate.with_corner(b, first, F.lit(2), F.lit(500), F.lit(-3), w, w)), F.lit(2)).alias("corner"), F.get(of(annotate.with_move(b, first, F.lit(10), F.lit(3), w, w)), F.lit(0)).alias("shifted"),
    )


@query(
    """WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, event_id % 5 < 3 AS claims FROM events),
    g AS (SELECT *, k - row_number() OVER (PARTITION BY user_id, claims ORDER BY event_id) AS island FROM e),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, claims, island ORDER BY event_id) AS nth FROM g)
    SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq, 'saved' AS outcome, k AS revision, CASE WHEN NOT claims THEN 'draft' WHEN nth % 2 = 1 THEN 'completed' ELSE 'edited' END AS status FROM r"""
)
def q_completed_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saves that claim to be completed: each changes the page, so every second one in a row is edited."""
    stored = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), stored.cast("long").alias("revision"), F.when(F.col("event_id") % 5 < 3, "completed").otherwise("draft").alias("status"), F.col("event_id").cast("string").alias("content"))
    return revisions.replay(e)


@query(
    """WITH s AS (SELECT event_id, ['draft', 'detected', 'edited', 'completed'][event_id % 4 + 1] AS status, ['detect', 'prelabel', 'validate', 'edit', 'complete', 'reopen'][event_id % 6 + 1] AS action, event_id % 7 <> 0 AS ok FROM events)
    SELECT event_id, CASE WHEN status = 'completed' AND action NOT IN ('complete', 'reopen') THEN 'read-only' WHEN action = 'complete' AND NOT ok THEN 'not complete' END AS problem,
        CASE WHEN status = 'completed' AND action NOT IN ('complete', 'reopen') OR action = 'complete' AND NOT ok OR action = 'reopen' AND status <> 'completed' OR action = 'validate' THEN status
            WHEN action = 'complete' THEN 'completed' WHEN action = 'reopen' THEN 'draft' WHEN action = 'detect' THEN 'detected' ELSE 'edited' END AS after,
        CASE WHEN status = 'completed' AND event_id % 3 = 0 THEN 'edited' ELSE 'completed' END AS saved FROM s"""
)
def q_status_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of every status after every action, and what a save that claims to be completed leaves."""
    pick = lambda names: F.element_at(F.array(*map(F.lit, names)), (F.col("event_id") % len(names) + 1).cast("int"))
    status = pick(("draft", "detected", "edited", "completed"))
    e = table(spark, sf_dir, "events").select("event_id", status.alias("status"), revisions.acted(status, pick(("detect", "prelabel", "validate", "edit", "complete", "reopen")), F.col("event_id") % 7 != 0).alias("a"))
    saved = revisions.saved_status(F.col("status"), F.lit("completed"), F.col("event_id") % 3 == 0)
    return e.select("event_id", F.col("a.problem").alias("problem"), F.col("a.status").alias("after"), saved.alias("saved"))


@query(
    """WITH s AS (SELECT event_id, event_id % 10 = 0 AS bad, CASE WHEN event_id % 3 = 0 THEN 'completed' ELSE 'draft' END AS status, event_id % 4 AS n, event_id % 5 <> 0 AS needed, event_id % 2 = 0 AS wanted, event_id % 11 <> 0 AS ready, event_id % 7 <> 0 AS eligible FROM events),
    o AS (SELECT *, CASE WHEN bad THEN 'failed' WHEN status = 'completed' OR n > 0 THEN 'skipped' ELSE 'processed' END AS detected, CASE WHEN bad THEN 'failed' WHEN status = 'completed' OR NOT needed THEN 'skipped' ELSE 'processed' END AS prelabelled,
        CASE WHEN event_id % 3 = 0 THEN 'timeout' WHEN event_id % 3 = 1 THEN CASE WHEN event_id % 2 = 0 THEN 'semantic' END END AS failure FROM s)
    SELECT event_id, detected, prelabelled, failure, CASE WHEN prelabelled = 'processed' AND wanted THEN CASE WHEN NOT ready THEN 'LLM validation failed' WHEN eligible THEN failure END END AS error FROM o"""
)
def q_batch_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of detection and prelabel batches, and of the validation behind them, which asks once more after a semantic error."""
    i = F.col("event_id")
    status = F.when(i % 3 == 0, "completed").otherwise("draft")
    first = F.when(i % 3 == 0, "timeout").when(i % 3 == 1, "semantic")
    failure = revisions.retried(first, F.when(i % 2 == 0, "semantic"))
    prelabelled = revisions.prelabel_outcome(i % 10 == 0, status, i % 5 != 0)
    return table(spark, sf_dir, "events").select("event_id", revisions.detect_outcome(i % 10 == 0, status, i % 4).alias("detected"), prelabelled.alias("prelabelled"), failure.alias("failure"), revisions.validation_error(prelabelled, i % 2 == 0, i % 11 != 0, i % 7 != 0, failure).alias("error"))


@query("SELECT event_id, array_to_string([x FOR x IN [CASE WHEN event_id % 2 = 0 THEN 'fingerprint' END, CASE WHEN event_id % 3 = 0 THEN 'backend' END, CASE WHEN event_id % 5 = 0 THEN 'model' END] IF x IS NOT NULL], ',') AS problems FROM events")
def q_resume_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings in which resumed runs differ from the earlier ones."""
    i = F.col("event_id")
    own = lambda n: F.when(i % n == 0, F.lit(None)).otherwise("a")
    earlier = {k: F.lit("a") for k in ("fingerprint", "backend", "model")}
    return table(spark, sf_dir, "events").select("event_id", t.csv(revisions.resume_problems(earlier, {"fingerprint": own(2), "backend": own(3), "model": own(5)})).alias("problems"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size * 1000 AS BIGINT) END AS trainable, CASE p_partkey % 7 WHEN 0 THEN 'no counts' WHEN 1 THEN 'no names' WHEN 2 THEN 'no adapter parameters' WHEN 3 THEN 'parameters outside the adapter''s scope'
        ELSE CASE WHEN p_size * 1000 > 40000 THEN 'too much is trainable' END END AS problem FROM part"""
)
def q_trainable_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and names of trainable parameters, read from a trainer's log, and whether training may start."""
    k = F.col("p_partkey") % 7
    counts = F.concat(F.lit("step 1\nTrainable parameters: "), F.format_number(F.col("p_size") * 1000, 0), F.lit(" of\n all parameters = 2e+05\n"))
    names = F.when(k == 1, '["a", 7, ""]').when(k == 2, '["model.layers.1.mlp.up_proj.weight"]').when(k == 3, r'["model.layers.1.mlp.up_proj.lora_A", "visual.q_proj.lora_A"]').otherwise('["model.layers.1.mlp.up_proj.lora_A", "model.model.layers.12.self_attn.q_proj.lora_B"]')
    log = F.concat(F.when(k == 0, "nothing\n").otherwise(counts), F.lit("NAMES="), names, F.lit("\nend"))
    p = table(spark, sf_dir, "part").select("p_partkey", t.trainable_report(log, "NAMES").alias("r"))
    return p.select("p_partkey", "r.trainable", t.trainable_problem(F.col("r")).alias("problem"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS at, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS run, o_orderstatus || ',' || o_orderkey AS row FROM orders")
def q_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps of runs and records, and rows joined by commas; the session is in UTC."""
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", t.utc_stamp(at).alias("at"), t.run_stamp(at).alias("run"), t.csv(F.array("o_orderstatus", F.col("o_orderkey").cast("string"))).alias("row"))


@query("""SELECT p_partkey, replace(replace(replace(replace(replace('<b a="1">' || p_name || '&''</b>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#39;') AS html FROM part""")
def q_html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names between signs that HTML needs escaped."""
    return table(spark, sf_dir, "part").select("p_partkey", t.html_escaped(F.concat(F.lit('<b a="1">'), "p_name", F.lit("&'</b>"))).alias("html"))


def _bitmap(width: object, height: object, rows: object) -> object:
    """The bytes of a bitmap of 24 bits with a header for width and height, and `rows` zero rows."""
    le = lambda n: F.format_string("%02x%02x0000", (n % 256).cast("int"), F.floor(n / 256).cast("int"))
    row = F.ceil(width * 3 / 4) * 4
    head = F.concat(F.lit("424d"), F.lit("00000000" * 2), le(F.lit(54)), le(F.lit(40)), le(width), le(height), F.lit("01001800"), F.lit("00000000" * 6))
    return F.unhex(F.concat(head, F.repeat(F.lit("00"), (row * rows).cast("int"))))


@query(
    """SELECT p_partkey, CASE p_partkey % 8 WHEN 5 THEN NULL WHEN 7 THEN NULL WHEN 6 THEN 'pixel_limit_exceeded' ELSE 'invalid_image' END AS problem, CASE WHEN p_partkey % 8 IN (0, 1, 2) THEN NULL WHEN p_partkey % 8 = 4 THEN 1 WHEN p_partkey % 8 = 6 THEN 300 ELSE 40 END AS width,
        CASE p_partkey % 8 WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 7 THEN NULL WHEN 6 THEN 'pixel_limit_exceeded' ELSE 'invalid_image' END AS detection FROM part"""
)
def q_image_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures missing, empty, broken, cut off, a pixel wide, too large and good, by the rules of both admissions."""
    k, side = F.col("p_partkey") % 8, F.lit(40)
    content = (
        F.when(k == 1, F.lit(b"")).when(k == 2, F.lit(b"no picture at all")).when(k == 3, _bitmap(side, side, F.lit(20))).when(k == 4, _bitmap(F.lit(1), F.lit(10), F.lit(10)))
        .when(k == 5, _bitmap(side, side, side)).when(k == 6, _bitmap(F.lit(300), F.lit(300), F.lit(1))).when(k == 7, F.lit(images.png(40, 40, bytes(range(240)) * 20)))
    )
    p = table(spark, sf_dir, "part").select("p_partkey", content.alias("content"))
    judged = p.select("p_partkey", images.admitted(50_000)("content").alias("a"), images.admitted(50_000, 0)("content").alias("d"))
    return judged.select("p_partkey", "a.problem", "a.width", F.col("d.problem").alias("detection"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'row_load_error' WHEN p_partkey % 6 = 1 THEN 'empty_text' WHEN p_partkey % 6 IN (2, 3, 4) THEN 'invalid_image' END AS reason,
        CASE p_partkey % 6 WHEN 0 THEN 'cannot read' WHEN 1 THEN '' WHEN 2 THEN 'invalid_image' WHEN 3 THEN 'pixel_limit_exceeded' WHEN 4 THEN 'invalid_image' END AS detail FROM part"""
)
def q_recognition_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognition rows whose pictures do not load, are not known, too large or too narrow."""
    k = F.col("p_partkey") % 6
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(k == 1, " ").otherwise(F.col("p_name")).alias("text"), F.when(k == 0, "cannot read").alias("error"), F.when(k == 2, F.lit(None)).when(k == 3, 20_000).when(k == 4, 1).otherwise(64).cast("int").alias("width"), F.when(k == 3, 20_000).otherwise(48).alias("height"))
    rows = admission.recognition(p, admission.RecognitionLimits(ALPHABET), load_error="error", width="width", height="height")
    return rows.select("p_partkey", "reason", "detail")


@query(
    """SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'invalid_task' WHEN 1 THEN 'empty_text' WHEN 2 THEN 'invalid_target_schema' WHEN 3 THEN 'control_character' WHEN 4 THEN 'pixel_limit_exceeded' WHEN 5 THEN 'invalid_image' WHEN 6 THEN 'token_budget_exceeded' END AS reason FROM part"""
)
def q_multitask_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reason of the multi-task cascade: tasks, targets, control characters, pictures and the budget."""
    k = F.col("p_partkey") % 9
    task = F.when(k == 0, "summary").when(k.isin(2, 8), "table").when(k == 3, "formula").otherwise("ocr")
    text = F.when(k == 1, " \n").when(k == 2, "<fcel>a<lcel>").when(k == 3, F.concat("p_name", F.lit("\x07"))).when(k == 8, F.concat(F.lit("<fcel>"), "p_name", F.lit("<nl>"))).otherwise(F.col("p_name"))
    p = table(spark, sf_dir, "part").select("p_partkey", task.alias("task"), text.alias("text"), F.when(k == 4, 20_000).when(k == 5, 9_000).when(k == 6, 600).otherwise(64).alias("width"), F.when(k == 4, 20_000).when(k == 5, 30).when(k == 6, 600).otherwise(48).alias("height"))
    rows = admission.multitask(p, admission.BudgetLimits(max_seq_len=300), width="width", height="height")
    return rows.select("p_partkey", "reason")




@query("WITH n AS (SELECT n_regionkey, count(*) AS k FROM nation GROUP BY n_regionkey) SELECT r_regionkey, CAST(3 + 2 * k AS INTEGER) AS grown, CAST(1 + k AS INTEGER) AS shrunk, CAST(2 + 2 * k AS INTEGER) AS split, 2 AS merged, r_name AS text FROM region JOIN n ON r_regionkey = n_regionkey WHERE r_regionkey NOT IN (1, 2)")
def q_table_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with a row more, a column less, a cell split, and put together again."""
    c = region_tables(spark, sf_dir).withColumn("cells", grammar.otsl_cells_of("target")).where("cells is not null")
    c = c.withColumn("split", grammar.split_cells_of("cells", F.lit(0), F.lit(0))).withColumn("merged", grammar.merged_cells_of("split", F.lit(0), F.lit(0), F.lit("right")))
    head = F.get(F.filter("merged", lambda x: (x["row"] == 0) & (x["column"] == 0)), F.lit(0))
    grown, shrunk = grammar.resized_cells_of("cells", F.lit("row"), F.lit(True)), grammar.resized_cells_of("cells", F.lit("column"), F.lit(False))
    return c.select("r_regionkey", F.size(grown).alias("grown"), F.size(shrunk).alias("shrunk"), F.size("split").alias("split"), head["colspan"].alias("merged"), head["text"].alias("text"))


@query("SELECT p_partkey, [p_name, 'size', ''] AS headers, ['left', 'center', 'none'] AS alignments, 2 AS n_rows, 1 AS narrow FROM part")
def q_chart_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charts with a row and a column more, another alignment, and down to the last column."""
    text = F.concat(F.lit("| "), "p_name", F.lit(" | size |\n|:---|---:|\n| a | "), F.col("p_size").cast("string"), F.lit(" |"))
    p = table(spark, sf_dir, "part").select("p_partkey", grammar.markdown_of(text).alias("m"))
    p = p.withColumn("wide", grammar.resized_chart_of(F.col("m"), F.lit("column"), F.lit(True))).withColumn("long", grammar.resized_chart_of(F.col("wide"), F.lit("row"), F.lit(True)))
    p = p.withColumn("set", grammar.aligned_chart_of(F.col("long"), F.lit(1), F.lit("center"))).withColumn("less", grammar.resized_chart_of(F.col("m"), F.lit("column"), F.lit(False)))
    p = p.withColumn("last", grammar.resized_chart_of(F.col("less"), F.lit("column"), F.lit(False)))
    return p.select("p_partkey", "set.headers", "set.alignments", F.size("set.rows").alias("n_rows"), F.size("last.headers").alias("narrow"))


@query("SELECT p_partkey, p_partkey % 4 <> 2 AS parses, p_partkey % 4 IN (0, 3) AS valid, CASE WHEN p_partkey % 4 = 2 THEN 'html_table' END AS error FROM part WHERE p_partkey % 4 <> 1 UNION ALL SELECT p_partkey, TRUE, FALSE, NULL FROM part WHERE p_partkey % 4 = 1")
def q_inspect_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that parse, are valid, or neither; the error of blank ones is left out."""
    k = F.col("p_partkey") % 4
    text = F.when(k == 1, "  ").when(k == 2, "<table>x</table>").when(k == 3, "<fcel>a<nl>").otherwise(F.col("p_name"))
    task = F.when(k == 2, "formula").when(k == 3, "table").otherwise("ocr")
    p = table(spark, sf_dir, "part").select("p_partkey", grammar.inspect_of(text, task).alias("i"))
    return p.select("p_partkey", "i.parses", "i.valid", F.when(k != 1, F.col("i.error")).alias("error"))


@query("SELECT p_partkey, left(sha256('img/' || p_partkey), 24) AS image_id, sha256(p_name) AS sha FROM part")
def q_opaque_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of pictures by their paths, and digests of their bytes."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", images.opaque_id(F.format_string("img/%d", "p_partkey")).alias("image_id"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha"))


@query("SELECT event_id, '{\"a\":[1,{\"c\":null,\"d\":' || event_id || '}],\"b\":\"x\"}' AS frozen FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 3 = 0")
def q_canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested values as texts that are equal where the values are."""
    json = F.when(F.col("event_id") % 3 == 0, "{no").when(F.col("event_id") % 3 == 1, F.format_string('{"b": "x", "a": [1, {"d": %d, "c": null}]}', "event_id")).otherwise(F.format_string('{"a":[1,{"c":null, "d":%d}],"b":"x"}', "event_id"))
    return table(spark, sf_dir, "events").select("event_id", t.canonical_json(json).alias("frozen"))


@query("SELECT list(DISTINCT x.task ORDER BY x.task) AS tasks, ['Chart Recognition:', 'OCR:', 'Table Recognition:'] AS prompts FROM (SELECT CASE event_id % 4 WHEN 0 THEN 'table' WHEN 1 THEN 'ocr' WHEN 2 THEN 'chart' END AS task FROM events) x WHERE task IS NOT NULL")
def q_distinct_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks that rows have, and their prompts."""
    k = F.col("event_id") % 4
    return mix.distinct_tasks(table(spark, sf_dir, "events").select(F.when(k == 0, "table").when(k == 1, "ocr").when(k == 2, "chart").alias("task")))


@query(
    """WITH p AS (SELECT o_orderstatus AS dataset, o_orderkey % 2 AS k, o_orderkey % 5 <> 0 AS same FROM orders)
    SELECT count(*) AS samples, round(avg(CAST(same AS INTEGER)), 6) AS exact_match, count(DISTINCT dataset) AS datasets, count(DISTINCT k) AS tasks, 'failed' AS status FROM p"""
)
def q_evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of an evaluation as one document, read again."""
    p = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("dataset"), F.when(F.col("o_orderkey") % 2 == 0, "ocr").otherwise("table").alias("task"), F.col("o_orderpriority").alias("target"), F.when(F.col("o_orderkey") % 5 == 0, "?").otherwise(F.col("o_orderpriority")).alias("prediction"))
    r = evaluate.report(evaluate.metrics(evaluate.with_distance(p)))
    kind = "struct<samples:long,cer:double,exact_match:double>"
    d = r.select(F.from_json("report", f"overall {kind}, datasets map<string,{kind}>, tasks map<string,{kind}>").alias("d"))
    return d.select("d.overall.samples", F.round("d.overall.exact_match", 6).alias("exact_match"), F.size("d.datasets").cast("long").alias("datasets"), F.size("d.tasks").cast("long").alias("tasks"), evaluate.verification(F.lit(1), F.lit(True)).alias("status"))


@query(
    """SELECT event_id, event_id % 7 IN (0, 1, 2) AS polls, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 4 <> 0 AND event_id % 2 = 0 THEN 750 END AS delay, event_id % 3 = 0 AND event_id % 5 <> 0 AS leaves, event_id % 4 <> 0 AS asks, event_id % 3 = 1 OR event_id % 3 = 0 AND event_id % 2 = 0 AS pans FROM events"""
)
def q_editor_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When an editor looks again, leaves a page, asks before it deletes, and moves the view."""
    i = F.col("event_id")
    state = F.element_at(F.array(*map(F.lit, ("queued", "running", "cancelling", "completed", "cancelled", "failed", "other"))), (i % 7 + 1).cast("int"))
    text = F.when(i % 4 == 0, " ").otherwise("a")
    return table(spark, sf_dir, "events").select("event_id", revisions.keeps_polling(state).alias("polls"), revisions.poll_delay(i % 2 == 0, i % 3 == 0, i % 4 == 0).alias("delay"), revisions.navigates(i % 3 == 0, i % 5 == 0).alias("leaves"), revisions.asks_before_delete(text).alias("asks"), revisions.pans(i % 3, i % 2 == 0).alias("pans"))
