"""Queries of annotated pages, targets and audits: conversations as pages, turns as blocks, orders as quadrilaterals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.dims import LABELS, PROMPTS, label_table
from scriptoria.functions import geometry as g
from scriptoria.functions import grammar
from scriptoria.functions import text as t
from scriptoria.operators import annotate, audit
from scriptoria.plans.rows import sql_strip, table
from scriptoria.registry import query
from scriptoria.sources import sinks


def quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quadrilateral for each order line; some are twisted, small, or lie outside."""
    q, d = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    x, y = F.col("l_partkey") % 90 - 10.25, F.col("l_suppkey") % 70 - 5.5
    k = F.col("l_orderkey") % 5
    twisted = F.array(F.array(x, y), F.array(x + q, y + d * 4), F.array(x + q, y), F.array(x, y + d * 4))
    plain = F.array(F.array(x, y), F.array(x + q, y), F.array(x + q, y + d * 4), F.array(x, y + d * 4))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(k == 0, twisted).when(k == 1, F.slice(plain, 1, 3)).otherwise(plain).alias("points"))


_QUADS = """
    WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, CAST(l_linenumber AS DOUBLE) * 4 AS d, l_partkey % 90 - 10.25::DOUBLE AS x, l_suppkey % 70 - 5.5::DOUBLE AS y, l_orderkey % 5 AS k FROM lineitem),
    p AS (SELECT l_orderkey, l_linenumber, k, CASE k WHEN 0 THEN [[x, y], [x + q, y + d], [x + q, y], [x, y + d]] WHEN 1 THEN [[x, y], [x + q, y], [x + q, y + d]] ELSE [[x, y], [x + q, y], [x + q, y + d], [x, y + d]] END AS points FROM b),
    a AS (SELECT *, abs(list_sum([points[i][1] * points[i % len(points) + 1][2] - points[i % len(points) + 1][1] * points[i][2] FOR i IN range(1, len(points) + 1)])) / 2 AS area,
        [[least(greatest(round_even(c[1], 0), 0), 63), least(greatest(round_even(c[2], 0), 0), 47)] FOR c IN points] AS s FROM p)
"""


@query(_QUADS + "SELECT l_orderkey, l_linenumber, round(area, 6) AS area, list_min([c[1] FOR c IN points]) AS x, list_min([c[2] FOR c IN points]) AS y, list_max([c[1] FOR c IN points]) - list_min([c[1] FOR c IN points]) AS w FROM a")
def q_polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas and boxes of quadrilaterals."""
    box = g.bounds_xywh(F.col("points"))
    return quads(spark, sf_dir).select("l_orderkey", "l_linenumber", F.round(g.area(F.col("points")), 6).alias("area"), box[0].alias("x"), box[1].alias("y"), box[2].alias("w"))


@query(
    _QUADS
    + """, z AS (SELECT *, len(list_distinct(s)) AS corners, abs(list_sum([s[i][1] * s[i % len(s) + 1][2] - s[i % len(s) + 1][1] * s[i][2] FOR i IN range(1, len(s) + 1)])) / 2 AS snapped FROM a)
    SELECT l_orderkey, l_linenumber, CASE WHEN k = 1 THEN 'points must contain at least four vertices' WHEN corners < 3 THEN 'polygon has fewer than three unique points'
        WHEN k = 0 AND corners = 4 THEN 'polygon is self-intersecting' WHEN snapped < 1 THEN 'area' END AS problem FROM z"""
)
def q_polygon_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with quadrilaterals in a picture of 64 by 48."""
    problem = g.polygon_problem(F.col("points"), F.col("snapped"), 1.0)
    return quads(spark, sf_dir).withColumn("snapped", g.snapped(F.col("points"), F.lit(64), F.lit(48))).select("l_orderkey", "l_linenumber", F.when(problem.startswith("polygon area"), "area").otherwise(problem).alias("problem"))


@query(
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey % 90 - 10.25::DOUBLE AS x1, l_suppkey % 70 - 5.5::DOUBLE AS y1, l_partkey % 90 - 10.25 + l_quantity - 25 AS x2, l_suppkey % 70 - 5.5 + l_linenumber AS y2 FROM lineitem),
    c AS (SELECT *, greatest(0, least(CAST(floor(least(x1, x2)) AS INTEGER), 63)) AS l, greatest(0, least(CAST(ceil(greatest(x1, x2)) AS INTEGER), 64)) AS r,
        greatest(0, least(CAST(floor(least(y1, y2)) AS INTEGER), 47)) AS t, greatest(0, least(CAST(ceil(greatest(y1, y2)) AS INTEGER), 48)) AS b FROM b)
    SELECT l_orderkey, l_linenumber, [l, t, CASE WHEN r <= l THEN least(64, l + 1) ELSE r END, CASE WHEN b <= t THEN least(48, t + 1) ELSE b END] AS box FROM c"""
)
def q_crop_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-pixel boxes inside a picture of 64 by 48."""
    x, y = F.col("l_partkey") % 90 - 10.25, F.col("l_suppkey") % 70 - 5.5
    box = F.array(x, y, x + F.col("l_quantity") - 25, y + F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", g.crop_box(box, F.lit(64), F.lit(48)).alias("box"))


@query("SELECT event_id, CASE WHEN value BETWEEN 0 AND 100 THEN value / 100 END AS score, CASE event_id % 3 WHEN 0 THEN 4 WHEN 1 THEN 4 END AS corners FROM events")
def q_score_and_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and boxes of layout results, null where they are no such thing."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    numbers = F.when(F.col("event_id") % 3 == 0, F.array(v, v, v + 1, v + 1)).when(F.col("event_id") % 3 == 1, F.array(v, v, v, v, v, v, v, v)).otherwise(F.array(v, v))
    return e.select("event_id", g.score((v / 100).cast("string")).alias("score"), F.size(g.layout_polygon(numbers)).alias("corners")).withColumn("corners", F.when(F.col("corners") > 0, F.col("corners")))


def turn_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a turn with the fields of a block; order falls, some are skipped or have no task."""
    c = table(spark, sf_dir, "conversations")
    label = F.element_at(F.array(*map(F.lit, LABELS)), ((F.col("conv_id") + F.col("turn")) % 25 + 1).cast("int"))
    x = F.col("turn").cast("double") * 10
    polygon = F.array(F.array(x, x), F.array(x + 5, x), F.array(x + 5, x + 5), F.array(x, x + 5))
    return c.select(
        "conv_id", F.concat_ws("-", "conv_id", "turn").alias("id"), (10 - F.col("turn")).cast("int").alias("order"), F.when(F.col("turn") % 4 == 3, F.lit("  ")).otherwise(F.concat(F.lit(" "), "text")).alias("text"), polygon.alias("polygon"),
        F.lit(0.5).alias("score"), F.lit("layout").alias("source"), label.alias("layout_label"), t.task_of_label(label).alias("task"), (F.col("turn") % 5 == 4).alias("skipped"), F.lit(None).cast("struct<text_hash:string>").alias("validation"), "turn",
    )


_FIELDS = ("id", "order", "text", "polygon", "score", "source", "layout_label", "task", "skipped", "validation")
_TASK_ROWS = ", ".join(f"({i}, '{x}', {'NULL' if k is None else repr(k)})" for i, (x, k) in enumerate((x, __import__('scriptoria.dims', fromlist=['LABEL_TASK']).LABEL_TASK.get(x)) for x in LABELS))
_BLOCKS = f"""
    WITH d(i, label, task) AS (VALUES {_TASK_ROWS}),
    b AS (SELECT conv_id, turn, 10 - turn AS o, CASE WHEN turn % 4 = 3 THEN '  ' ELSE ' ' || text END AS text, label, task, turn % 5 = 4 AS skipped FROM conversations JOIN d ON (conv_id + turn) % 25 = i)
"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as pages with their blocks in one array."""
    rows = turn_blocks(spark, sf_dir)
    return rows.groupBy("conv_id").agg(F.collect_list(F.struct(*_FIELDS)).alias("blocks"))


@query(_BLOCKS + "SELECT conv_id, conv_id || '-' || turn AS id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY o) - 1 AS INTEGER) AS place FROM b")
def q_blocks_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of pages in order, numbered from 0."""
    p = pages(spark, sf_dir).select("conv_id", F.explode(annotate.renumbered(F.col("blocks"))).alias("b"))
    return p.select("conv_id", "b.id", F.col("b.order").alias("place"))


@query(_BLOCKS + f"SELECT conv_id, sha256(coalesce(string_agg(CASE WHEN NOT skipped AND task IS NOT NULL AND {sql_strip('text')} <> '' THEN {sql_strip('text')} END, chr(10) ORDER BY o), '')) AS page_sha, sha256(string_agg(text, chr(10) ORDER BY o)) AS ocr_sha FROM b GROUP BY conv_id")
def q_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of pages, of both kinds."""
    p = pages(spark, sf_dir)
    return p.select("conv_id", F.sha2(annotate.page_text(F.col("blocks")).cast("binary"), 256).alias("page_sha"), F.sha2(annotate.ocr_text(F.col("blocks")).cast("binary"), 256).alias("ocr_sha"))


@query(_BLOCKS + "SELECT conv_id, conv_id || '-' || turn AS id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY o) - 1 AS INTEGER) AS read_order FROM b WHERE NOT skipped")
def q_read_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that an export keeps, with their reading order."""
    p = pages(spark, sf_dir).select("conv_id", F.explode(annotate.read_order(F.col("blocks"))).alias("b"))
    return p.select("conv_id", "b.id", F.col("b.order").alias("read_order"))


@query(
    _BLOCKS
    + f""", r AS (SELECT conv_id, o, CASE WHEN task IS NOT NULL AND {sql_strip('text')} = '' THEN 4 WHEN task IN ('table', 'chart') THEN 5 END AS k FROM b WHERE NOT skipped),
    m AS (SELECT conv_id, arg_min(k, o) AS k FROM r WHERE k IS NOT NULL GROUP BY conv_id UNION ALL SELECT conv_id, 1 FROM b GROUP BY conv_id HAVING bool_and(skipped))
    SELECT conv_id, CASE k WHEN 1 THEN 'no active block' WHEN 4 THEN 'no text' ELSE 'invalid target' END AS problem FROM m"""
)
def q_completion_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why pages cannot be completed: prose is no table."""
    rows = turn_blocks(spark, sf_dir).withColumn("width", F.lit(200)).withColumn("height", F.lit(200))
    return annotate.completion_problems(rows, "conv_id")


@query("SELECT conv_id, turn, turn % 2 = 0 AS fresh FROM conversations")
def q_stale_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validations whose text has not changed since."""
    c = table(spark, sf_dir, "conversations")
    checked = F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit(".")))
    block = F.struct("text", F.struct(F.sha2(checked.cast("binary"), 256).alias("text_hash")).alias("validation"))
    return c.select("conv_id", "turn", annotate.fresh_validation(block).isNotNull().alias("fresh"))


@query("SELECT doc_id, substr(text, 6, 15) AS cut, length(text) >= 20 AS fits FROM documents")
def q_span_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of documents by offsets, and whether an issue there is sound."""
    d = table(spark, sf_dir, "documents")
    cut = t.span(F.col("text"), F.lit(5), F.lit(20))
    return d.select("doc_id", cut.alias("cut"), annotate.issue_ok(F.col("text"), F.lit(5), F.lit(20), cut).alias("fits"))


@query(_BLOCKS + f"SELECT conv_id, turn, coalesce(NOT skipped AND task IN ('ocr', 'table', 'chart') AND {sql_strip('text')} <> '' AND turn <> 1, FALSE) AS eligible FROM b")
def q_eligible_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that a validation looks at."""
    b = turn_blocks(spark, sf_dir)
    return b.select("conv_id", "turn", F.coalesce(annotate.eligible_for_validation(F.struct(*_FIELDS), F.col("turn") != 1), F.lit(False)).alias("eligible"))


@query(_BLOCKS + f"SELECT conv_id, conv_id || '-' || turn AS id, CASE WHEN NOT skipped AND task IS NOT NULL AND {sql_strip('text')} = '' THEN 'new' ELSE text END AS text FROM b")
def q_prelabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks without text get one."""
    p = pages(spark, sf_dir)
    texts = F.map_from_entries(F.transform("blocks", lambda b: F.struct(b["id"], F.lit("new"))))
    return p.select("conv_id", F.explode(annotate.prelabelled(F.col("blocks"), texts)).alias("b")).select("conv_id", "b.id", "b.text")


@query(_BLOCKS + "SELECT conv_id, 2 AS version, CASE WHEN bool_and(skipped) THEN 'edited' ELSE 'completed' END AS status FROM b GROUP BY conv_id")
def q_migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-version pages brought to the second."""
    p = pages(spark, sf_dir).select("conv_id", annotate.migrated(F.lit(1), F.lit("completed"), F.col("blocks")).alias("m"))
    return p.select("conv_id", "m.version", "m.status")


@query("SELECT event_id, user_id, event_type AS status FROM events WHERE event_type = 'click' AND contains(lower('IMG_' || user_id), '_1')")
def q_image_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of a status with a term in their name."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") == "click", "edited").otherwise("ocr").alias("status"), F.concat(F.lit("IMG_"), F.col("user_id").cast("string")).alias("name"))
    return annotate.filtered(e, "edited", "_1").select("event_id", "user_id", F.lit("click").alias("status"))


@query("SELECT event_id, event_id % 3 = 0 AND value / 100 < 0.6 AND event_id <> 6 AS low FROM events")
def q_low_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised blocks with a low score that are not selected."""
    e = table(spark, sf_dir, "events")
    block = F.struct(F.col("event_id").alias("id"), F.when(F.col("event_id") % 3 == 0, "ocr").otherwise("manual").alias("source"), (F.col("value") / 100).alias("score"))
    return e.select("event_id", annotate.low_confidence(block, F.lit(6).cast("long")).alias("low"))


@query(
    """WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
    SELECT doc_id, sha256(array_to_string([substr(l[1], 1, 4), substr(l[1], 5)] || l[2:], chr(10))) AS split_sha, sha256(CASE WHEN len(l) > 1 THEN array_to_string([l[1] || l[2]] || l[3:], chr(10)) ELSE l[1] END) AS merged_sha,
        sha256(array_to_string([substr(l[1], 1, 4) || 'a', 'b' || substr(l[1], 5)] || l[2:], chr(10))) AS pasted_sha FROM s"""
)
def q_line_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents split, merged and pasted into."""
    lines = F.split("text", "\n", -1)
    sha = lambda x: F.sha2(F.array_join(x, "\n").cast("binary"), 256)
    d = table(spark, sf_dir, "documents").select("doc_id", lines.alias("l"))
    l = F.col("l")  # noqa: E741
    return d.select("doc_id", sha(t.line_split(l, F.lit(0), F.lit(4))).alias("split_sha"), sha(t.line_merge(l, F.lit(1))).alias("merged_sha"), sha(t.line_paste(l, F.lit(0), F.lit(4), F.lit("a\r\nb"))).alias("pasted_sha"))


@query(
    """SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'OCR:' ELSE 'Formula Recognition:' END AS prompt, text AS target, 'mask' AS tag, CASE WHEN role = 'system' THEN 'task_mask' END AS problem FROM conversations"""
)
def q_training_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training records as JSON, read back and checked."""
    c = table(spark, sf_dir, "conversations")
    prompt = t.prompt_of(F.when(F.col("role") == "user", "ocr").otherwise("formula"))
    record = sinks.training_record(F.lit("x.png"), prompt, F.col("text"))
    record = F.when(F.col("role") == "system", F.replace(record, F.lit('"matched_text_index":0'), F.lit('"matched_text_index":1'))).otherwise(record)
    r = c.select("conv_id", "turn", F.from_json(record, "image_info array<struct<image_url:string,matched_text_index:int>>, text_info array<struct<text:string,tag:string>>").alias("r"))
    texts = F.col("r.text_info")
    return r.select("conv_id", "turn", texts[0]["text"].alias("prompt"), texts[1]["text"].alias("target"), texts[0]["tag"].alias("tag"), grammar.record_error(F.col("r.image_info"), texts, tuple(PROMPTS.values())).alias("problem"))


def region_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table target for each region: its name over two columns, then nations with their keys; regions 1 and 2 have a defect."""
    n = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("ns"))
    r = table(spark, sf_dir, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"))
    rows = F.array_join(F.transform("ns", lambda x: F.concat(F.lit("<fcel>"), x["n_nationkey"].cast("string"), F.lit("<fcel>"), x["n_name"], F.lit("<nl>"))), "")
    k = F.col("r_regionkey")
    return r.select("r_regionkey", F.concat(F.lit("<fcel>"), F.when(k == 1, "<b>").otherwise(""), F.col("r_name"), F.when(k == 2, "<nl>").otherwise("<lcel><nl>"), rows).alias("target"))


@query("SELECT r_regionkey, CASE r_regionkey WHEN 1 THEN 'unknown_tag' WHEN 2 THEN 'ragged_rows' END AS error FROM region")
def q_otsl_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table targets with what is wrong."""
    return region_tables(spark, sf_dir).select("r_regionkey", grammar.target_error_of("target", F.lit("table")).alias("error"))


@query(
    """WITH n AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation WHERE n_regionkey NOT IN (1, 2))
    SELECT r_regionkey, 0 AS row, 0 AS column, 1 AS rowspan, 2 AS colspan, r_name AS text FROM region WHERE r_regionkey NOT IN (1, 2)
    UNION ALL SELECT n_regionkey, CAST(k AS INTEGER), 0, 1, 1, CAST(n_nationkey AS VARCHAR) FROM n UNION ALL SELECT n_regionkey, CAST(k AS INTEGER), 1, 1, 1, n_name FROM n"""
)
def q_otsl_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of sound table targets."""
    cells = region_tables(spark, sf_dir).select("r_regionkey", F.explode(grammar.otsl_cells_of("target")).alias("c"))
    return cells.select("r_regionkey", "c.*")


@query(
    """WITH n AS (SELECT n_regionkey, string_agg('<tr><td>' || n_nationkey || '</td><td>' || n_name || '</td></tr>', '' ORDER BY n_nationkey) AS rows FROM nation GROUP BY n_regionkey)
    SELECT r_regionkey, '<table><tr><td colspan="2">' || r_name || '</td></tr>' || rows || '</table>' AS html FROM region JOIN n ON r_regionkey = n_regionkey WHERE r_regionkey NOT IN (1, 2)"""
)
def q_otsl_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table targets as HTML."""
    return region_tables(spark, sf_dir).select("r_regionkey", grammar.cells_html_of(grammar.otsl_cells_of("target")).alias("html")).where("html is not null")


@query("WITH n AS (SELECT n_regionkey, count(*) AS k FROM nation GROUP BY n_regionkey) SELECT r_regionkey, CAST(1 + 2 * k AS BIGINT) AS cells, TRUE AS same FROM region JOIN n ON r_regionkey = n_regionkey WHERE r_regionkey NOT IN (1, 2)")
def q_otsl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table targets built again from their cells."""
    c = region_tables(spark, sf_dir).withColumn("cells", grammar.otsl_cells_of("target")).where("cells is not null")
    return c.select("r_regionkey", F.size("cells").cast("long").alias("cells"), (grammar.build_otsl_of("cells") == F.col("target")).alias("same"))


@query(
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'ragged_rows' WHEN 2 THEN 'bad_separator' WHEN 3 THEN 'blank_row' END AS error, CASE WHEN p_partkey % 4 = 0 THEN p_name || ' | x' END AS header FROM part"""
)
def q_markdown_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown tables of parts with what is wrong, and a header cell that holds a bar."""
    k = F.col("p_partkey") % 4
    head = F.concat(F.lit("| "), F.col("p_name"), F.lit(r" \| x | size |"))
    rule = F.when(k == 2, "|--|---|").otherwise("|:---|---:|")
    row = F.when(k == 1, "| a |").otherwise(F.concat(F.lit("| "), F.col("p_type"), F.lit(" | "), F.col("p_size").cast("string"), F.lit(" |")))
    text = F.concat_ws("\n", head, rule, F.when(k == 3, F.concat(row, F.lit("\n"))).otherwise(row))
    p = table(spark, sf_dir, "part").select("p_partkey", text.alias("text"))
    return p.select("p_partkey", grammar.target_error_of("text", F.lit("chart")).alias("error"), grammar.markdown_of("text")["headers"][0].alias("header"))


@query("SELECT l.x AS label, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM (VALUES ('click'), ('view'), ('purchase'), ('never')) l(x) LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) c ON c.event_type = l.x")
def q_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type, also of types without events."""
    labels = spark.createDataFrame([(x,) for x in ("click", "view", "purchase", "never")], "label string")
    return audit.class_counts(table(spark, sf_dir, "events"), "event_type", labels)


@query("SELECT conv_id FROM (SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN turn + 1 ELSE turn END AS turn FROM conversations) GROUP BY conv_id HAVING NOT (count(DISTINCT turn) = count(*) AND min(turn) = 0 AND max(turn) = count(*) - 1)")
def q_contiguous_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose turns are not numbered from 0 without gaps."""
    c = table(spark, sf_dir, "conversations").select("conv_id", F.when(F.col("conv_id") % 7 == 0, F.col("turn") + 1).otherwise(F.col("turn")).alias("read_order"))
    return audit.order_gaps(c, ["conv_id"]).select("conv_id")


@query("SELECT sha256(text) AS sha FROM documents WHERE doc_id % 10 = 0 INTERSECT SELECT sha256(text) FROM documents WHERE doc_id % 10 <> 0")
def q_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that both sides of a split have."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    return audit.leaks(d.where("doc_id % 10 = 0"), d.where("doc_id % 10 <> 0"), "sha")


@query(
    """WITH f AS (SELECT source, 'f' || doc_id AS path, sha256(text) AS sha, left(sha256('f' || doc_id), 3) AS bucket FROM documents),
    p AS (SELECT source, bucket, sha256(string_agg(path || sha, '' ORDER BY path)) AS part FROM f GROUP BY source, bucket)
    SELECT source, sha256(string_agg(bucket || part, '' ORDER BY bucket)) AS fingerprint FROM p GROUP BY source"""
)
def q_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each source's files: no row holds all paths of a source."""
    d = table(spark, sf_dir, "documents").select("source", F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return audit.tree_fingerprint(d, ["source"])


def coco(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as images and their lines as annotations, with defects of each kind."""
    o = table(spark, sf_dir, "orders")
    images = o.select(F.lit("train").alias("split"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 101 == 0, "../x.png").otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".png"))).alias("file_name"), F.lit(100).alias("width"), F.when(F.col("o_orderkey") % 103 == 0, 0).otherwise(100).alias("height"), F.lit(True).alias("exists"))
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    q = F.col("l_quantity")
    box = F.array(F.lit(1.0), F.lit(2.0), q + 55, F.lit(10.0))
    flat = F.array(F.lit(1.0), F.lit(2.0), q + 56, F.lit(2.0), q + 56, F.when(F.col("l_suppkey") % 13 == 0, 2.0).otherwise(12.0))
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    notes = l.select(F.lit("train").alias("split"), key.alias("id"), F.when(F.col("l_partkey") % 97 == 0, -1).otherwise(F.col("l_orderkey")).alias("image_id"), (F.col("l_partkey") % 26).alias("category_id"), box.alias("bbox"), F.array(flat).alias("segmentation"), q.alias("area"), (F.col("l_linenumber") - 1).alias("read_order"))
    return images, notes


@query(
    """WITH a AS (SELECT l_orderkey * 10 + l_linenumber AS id, count(*) OVER (PARTITION BY l_orderkey * 10 + l_linenumber) AS times, CASE WHEN l_partkey % 97 = 0 THEN -1 ELSE l_orderkey END AS image_id, l_partkey % 26 AS c, l_quantity AS q, l_suppkey % 13 = 0 AS thin FROM lineitem),
    i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 103 = 0 THEN 0 ELSE 100 END AS h FROM orders)
    SELECT a.id, array_to_string(list_filter([CASE WHEN times > 1 THEN 'annotation id is not unique' END, CASE WHEN o_orderkey IS NULL THEN 'unknown image' END, CASE WHEN c = 0 THEN 'bad category' END,
        CASE WHEN o_orderkey IS NOT NULL AND (1 + q + 55 > 100.0001 OR 12 > h + 0.0001) THEN 'box leaves the image' END, CASE WHEN thin THEN 'polygon has no area' END], lambda x: x IS NOT NULL), ';') AS problems
    FROM a LEFT JOIN i ON a.image_id = o_orderkey WHERE times > 1 OR o_orderkey IS NULL OR c = 0 OR 1 + q + 55 > 100.0001 OR 12 > h + 0.0001 OR thin"""
)
def q_coco_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations with all that is wrong with them."""
    images, notes = coco(spark, sf_dir)
    return audit.annotation_problems(notes, images).select("id", F.array_join("problems", ";").alias("problems"))


@query("SELECT o_orderkey AS id, array_to_string(list_filter([CASE WHEN o_orderkey % 101 = 0 THEN 'file name leaves the folder' END, CASE WHEN o_orderkey % 103 = 0 THEN 'bad size' END], lambda x: x IS NOT NULL), ';') AS problems FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0")
def q_coco_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with all that is wrong with them."""
    images, _ = coco(spark, sf_dir)
    return audit.image_problems(images).select("id", F.array_join("problems", ";").alias("problems"))


@query(
    """WITH k AS (SELECT DISTINCT p_partkey % 27 AS id FROM part)
    SELECT v.* FROM (VALUES (3, 'aside_text', 'oops'), (25, 'vision_footnote', NULL), (26, NULL, 'extra')) v(label_id, expected, found) WHERE v.label_id = 25 OR v.label_id IN (SELECT id FROM k)"""
)
def q_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that parts use and that are not the taxonomy: one has another name, one is not used, one is unknown."""
    k = F.col("label_id")
    used = table(spark, sf_dir, "part").select((F.col("p_partkey") % 27).cast("int").alias("label_id")).where(k != 25).distinct()
    c = used.join(label_table(spark), "label_id", "left").select(k.cast("int").alias("id"), F.when(k == 3, "oops").when(k == 26, "extra").otherwise(F.col("label")).alias("name"))
    return audit.taxonomy_problems(c)


@query(
    """WITH d AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
    SELECT d.source, b.n AS batch, w.n AS workers, (d.n + b.n - 1) // b.n AS batches, 'not_run' AS status FROM d, (VALUES (1), (2), (4)) b(n), (VALUES (2), (4), (6), (8)) w(n)"""
)
def q_benchmark_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loader benchmark's cells for each source of documents, none of which has run, and the batches that each would load."""
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    cells = d.withColumn("batch", F.explode(F.array(*map(F.lit, (1, 2, 4))))).withColumn("workers", F.explode(F.array(*map(F.lit, (2, 4, 6, 8)))))
    return cells.select("source", "batch", "workers", F.ceil(F.col("n") / F.col("batch")).cast("long").alias("batches"), F.lit("not_run").alias("status"))


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'error' WHEN o.n IS NULL THEN 'draft' ELSE 'edited' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey"""
)
def q_catalog_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as images, with a sidecar where they have orders."""
    catalog = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("stem"), F.when(F.col("c_custkey") % 9 == 0, "bad").alias("error"))
    cars = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("stem")).agg(F.lit("edited").alias("status"))
    return annotate.catalog_status(catalog, cars, "draft").select("c_custkey", "status")


@query("SELECT p_partkey AS image_id, p_partkey % 3 <> 1 AS unchanged FROM part")
def q_source_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are still what the catalogue has."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("image_id"), F.col("p_size").alias("size_bytes"), F.lit(None).cast("long").alias("mtime_ns"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha256"))
    now = p.withColumn("size_bytes", F.col("size_bytes") + F.when(F.col("image_id") % 3 == 1, 1).otherwise(0))
    return annotate.source_unchanged(p, now)
