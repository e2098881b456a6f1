"""Queries of admission: lines of documents, turns of conversations, label lines made from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.dims import LABEL_TASK, LABELS, PROMPTS
from scriptoria.functions import geometry as g
from scriptoria.functions import text as t
from scriptoria.operators import admission, dedup
from scriptoria.plans.rows import ALPHABET, ALPHABET_CLASS, sql_strip, table
from scriptoria.registry import query

LIMITS = admission.RecognitionLimits(ALPHABET)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, with a blank, a control character or a foreign sign put into some of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("line", "raw"))
    k = (F.col("doc_id") * 31 + F.col("line")) % 23
    text = F.when(k == 0, F.lit("  ")).when(k == 1, F.concat("raw", F.lit("\x07"), F.lit("x"))).when(k == 2, F.concat(F.lit(" "), "raw", F.lit(" Ω中"))).when(k == 3, F.concat("raw", F.lit("\té "))).otherwise(F.col("raw"))
    return docs.select("doc_id", "source", "line", text.alias("text"))


_LINES = """
    WITH l AS (
        SELECT doc_id, source, CAST(unnest(range(0, len(string_split(text, chr(10))))) AS INTEGER) AS line, unnest(string_split(text, chr(10))) AS raw FROM documents
    ), s AS (
        SELECT doc_id, source, line, CASE (doc_id * 31 + line) % 23 WHEN 0 THEN ' ' || chr(160) WHEN 1 THEN raw || chr(7) || 'x'
            WHEN 2 THEN chr(8195) || raw || ' ' || chr(937) || chr(20013) WHEN 3 THEN raw || chr(9) || 'e' || chr(769) || ' ' ELSE raw END AS text FROM l
    ), n AS (
        SELECT doc_id, source, line, {strip} AS target FROM s
    ), a AS (
        SELECT *, list_sort(list_distinct(string_split(regexp_replace(target, '{alphabet}', '', 'g'), ''))) AS unknown FROM n
    ), r AS (
        SELECT *, CASE WHEN target = '' THEN 'empty_text' WHEN regexp_matches(target, '\\p{{Cc}}') THEN 'control_character' WHEN length(target) > 80 THEN 'text_too_long'
            WHEN regexp_replace(target, '{alphabet}', '', 'g') <> '' THEN 'unsupported_characters' END AS reason FROM a
    )
""".format(strip=sql_strip(r"regexp_replace(nfc_normalize(text), '\r\n|[\r\n\t]', ' ', 'g')"), alphabet=ALPHABET_CLASS).replace("\\\\p", "\\p")


@query(_LINES + "SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason")
def q_admit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejections of recognition lines by reason."""
    return admission.reason_counts(admission.recognition(lines(spark, sf_dir), LIMITS))


@query(
    _LINES
    + """SELECT doc_id, line, reason, CASE reason WHEN 'text_too_long' THEN length(target) || ' > 80' WHEN 'unsupported_characters' THEN array_to_string(unknown, '') ELSE '' END AS detail
    FROM r WHERE reason IS NOT NULL"""
)
def q_admit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of rejected recognition lines."""
    return admission.ledger(admission.recognition(lines(spark, sf_dir), LIMITS), "doc_id", "line")


@query(_LINES + "SELECT source, CAST(count(*) FILTER (reason IS NULL) AS BIGINT) AS admitted, CAST(count(*) FILTER (reason IS NOT NULL) AS BIGINT) AS rejected FROM r GROUP BY source")
def q_dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admitted and rejected lines by source."""
    rows = admission.recognition(lines(spark, sf_dir), LIMITS)
    return rows.groupBy("source").agg(F.count_if(F.col("reason").isNull()).alias("admitted"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))


@query(f"SELECT doc_id, list_sort(list_distinct(list_filter(string_split(regexp_replace(text, '{ALPHABET_CLASS}', '', 'g'), ''), lambda c: c <> ''))) AS unknown FROM documents")
def q_unsupported_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of each document outside the alphabet."""
    return table(spark, sf_dir, "documents").select("doc_id", t.unsupported(F.col("text"), ALPHABET + " ").alias("unknown"))


@query(
    """
    WITH c AS (SELECT *, CASE (conv_id + turn) % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ocr ' WHEN 3 THEN 'formula' ELSE 'summary' END AS raw_task FROM conversations),
    n AS (SELECT *, CASE WHEN raw_task IS NULL OR raw_task = '' THEN 'ocr' WHEN trim(raw_task) IN ('ocr', 'table', 'formula', 'chart') THEN trim(raw_task) END AS task,
        regexp_replace(nfc_normalize(text), '\\r\\n?', chr(10), 'g') AS target FROM c),
    r AS (SELECT *, length(CASE task WHEN 'ocr' THEN 'OCR:' ELSE 'Formula Recognition:' END) + length(target) + 1 AS n_tokens FROM n),
    z AS (SELECT CASE WHEN task IS NULL THEN 'invalid_task' WHEN trim(target) = '' THEN 'empty_text' WHEN n_tokens > 400 THEN 'token_budget_exceeded' ELSE 'admitted' END AS reason FROM r)
    SELECT reason, count(*) AS n FROM z GROUP BY reason
    """.replace("\\\\", "\\")
)
def q_vl_admit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations under the multi-task cascade, with tasks of all kinds."""
    k = (F.col("conv_id") + F.col("turn")) % 5
    task = F.when(k == 0, F.lit(None)).when(k == 1, "").when(k == 2, " ocr ").when(k == 3, "formula").otherwise("summary")
    rows = admission.multitask(table(spark, sf_dir, "conversations").withColumn("task", task), admission.BudgetLimits(max_seq_len=400))
    return rows.groupBy(F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count("*").alias("n"))


_RESIZE = """
    WITH s AS (SELECT p_partkey, CAST(p_size * 37 + 5 AS DOUBLE) AS h, CAST((p_partkey % 97) * 29 + 3 AS DOUBLE) AS w FROM part),
    a AS (SELECT *, CASE WHEN h < 28 THEN round_even(w * 28 / h, 0) ELSE w END AS w1, greatest(h, 28) AS h1 FROM s),
    b AS (SELECT *, CASE WHEN w1 < 28 THEN round_even(h1 * 28 / w1, 0) ELSE h1 END AS h2, greatest(w1, 28) AS w2 FROM a),
    c AS (SELECT *, round_even(h2 / 28, 0) * 28 AS rh, round_even(w2 / 28, 0) * 28 AS rw FROM b),
    d AS (SELECT *, CASE WHEN rh * rw > 451584 THEN floor(h2 / sqrt(h2 * w2 / 451584) / 28) * 28 WHEN rh * rw < 50176 THEN ceil(h2 * sqrt(50176 / (h2 * w2)) / 28) * 28 ELSE rh END AS oh,
        CASE WHEN rh * rw > 451584 THEN floor(w2 / sqrt(h2 * w2 / 451584) / 28) * 28 WHEN rh * rw < 50176 THEN ceil(w2 * sqrt(50176 / (h2 * w2)) / 28) * 28 ELSE rw END AS ow FROM c)
    SELECT p_partkey, CASE WHEN greatest(h2, w2) / least(h2, w2) <= 200 AND oh > 0 AND ow > 0 THEN CAST(floor(oh / 14) * floor(ow / 14) / 4 AS INTEGER) END AS visual_tokens FROM d
"""


@query(_RESIZE)
def q_visual_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of pictures with sides made from the parts."""
    return table(spark, sf_dir, "part").select("p_partkey", g.visual_tokens(F.col("p_size") * 37 + 5, (F.col("p_partkey") % 97) * 29 + 3).alias("visual_tokens"))


_DET = r"""
    WITH o AS (
        SELECT o_orderkey, o_custkey, 'd' || (o_orderkey % 3) AS source, o_orderkey AS line_number, 'img/' || o_custkey || '.png' AS path, sha256(CAST(o_custkey AS VARCHAR)) AS sha, o_orderkey % 11 AS k,
            CAST(o_orderkey % 50 AS DOUBLE) AS x, CAST(o_custkey % 40 AS DOUBLE) AS y FROM orders
    ), b AS (
        SELECT *, CASE k WHEN 0 THEN 'empty_line' WHEN 1 THEN 'invalid_line' WHEN 2 THEN 'unsafe_image_path' WHEN 3 THEN 'missing_image' WHEN 4 THEN 'invalid_image' END AS early,
            CASE k WHEN 5 THEN 'invalid_json' WHEN 6 THEN 'empty_boxes' WHEN 7 THEN 'no_valid_boxes' END AS late FROM o
    ), f AS (
        SELECT sha, min({'s': source, 'l': line_number}) AS first FROM b WHERE early IS NULL AND late IS NULL GROUP BY sha
    ), v AS (
        SELECT b.*, coalesce(early, CASE WHEN {'s': source, 'l': line_number} > f.first THEN 'duplicate_image' END, late) AS reason FROM b LEFT JOIN f ON b.sha = f.sha
    )
"""


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label line for each order: the customer's picture with two boxes, one of them bad, and lines with every defect."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 11).alias("k"), (F.col("o_orderkey") % 50).alias("x"), (F.col("o_custkey") % 40).alias("y"))
    path = F.concat(F.lit("img/"), F.col("o_custkey").cast("string"), F.lit(".png"))
    good = F.format_string('[{"transcription":" ### ","points":[[%d.5,%d],[%d,%d],[%d,%d.5],[%d,%d]]},{"transcription":"a","points":[[1,true],[2,2],[3,3],[4,4]]}]', "x", "y", F.col("x") + 20, "y", F.col("x") + 20, F.col("y") + 10, "x", F.col("y") + 10)
    k = F.col("k")
    payload = F.when(k == 5, "[{").when(k == 6, "[]").when(k == 7, '[{"transcription":"a","points":[[0,0],[1,1],[2,2]]},7]').otherwise(good)
    value = F.when(k == 0, "  ").when(k == 1, path).when(k == 2, F.concat(F.lit("../x.png\t"), payload)).otherwise(F.concat(path, F.lit("\t"), payload))
    known = k != 3
    return o.select(
        F.concat(F.lit("d"), (F.col("o_orderkey") % 3).cast("string")).alias("source"), F.col("o_orderkey").alias("line_number"), value.alias("value"),
        F.when(known, F.when(k == 4, 0).otherwise(100)).alias("width"), F.when(known, 80).alias("height"), F.when(known, F.sha2(F.col("o_custkey").cast("string").cast("binary"), 256)).alias("sha256"),
    )


@query(_DET + "SELECT source, line_number, reason FROM v")
def q_det_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection label lines with their first reason, and none for those that are admitted."""
    rows, _ = admission.detection(label_lines(spark, sf_dir))
    return rows.select("source", "line_number", "reason")


@query(
    _DET
    + """SELECT reason, count(*) AS n FROM (SELECT reason FROM v WHERE reason IS NOT NULL
        UNION ALL SELECT 'invalid_box' FROM v WHERE reason IS NULL UNION ALL SELECT 'invalid_box' FROM v, range(2) WHERE reason = 'no_valid_boxes') GROUP BY reason"""
)
def q_det_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejection events of detection labels, boxes included."""
    return admission.reason_counts(admission.detection(label_lines(spark, sf_dir))[1])


@query(
    _DET
    + """SELECT line_number, '###' AS transcription, [[CAST(round_even(x + 0.5, 0) AS INTEGER), CAST(y AS INTEGER)], [CAST(x + 20 AS INTEGER), CAST(y AS INTEGER)],
        [CAST(x + 20 AS INTEGER), CAST(round_even(y + 10.5, 0) AS INTEGER)], [CAST(x AS INTEGER), CAST(y + 10 AS INTEGER)]] AS points FROM v WHERE reason IS NULL"""
)
def q_det_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes of admitted detection labels."""
    rows, _ = admission.detection(label_lines(spark, sf_dir))
    return rows.where("reason is null").select("line_number", F.explode("labels").alias("b")).select("line_number", "b.transcription", "b.points")


@query(
    """
    WITH d AS (SELECT doc_id, sha256(text) AS h, doc_id % 7 <> 0 AS ok FROM documents), f AS (SELECT h, min(doc_id) AS first FROM d WHERE ok GROUP BY h)
    SELECT doc_id, CASE WHEN doc_id > first THEN 'duplicate' WHEN doc_id = first THEN 'admitted' ELSE 'own' END AS verdict FROM d LEFT JOIN f ON d.h = f.h
    """
)
def q_dedup_first_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by digest of the text, where some fail on their own."""
    docs = table(spark, sf_dir, "documents")
    found = dedup.first_admitted(docs, F.sha2(F.col("text").cast("binary"), 256), F.col("doc_id"), F.col("doc_id") % 7 != 0)
    return found.select("doc_id", "verdict")


@query(
    f"""SELECT conv_id, turn, regexp_replace(nfc_normalize(text || chr(13) || chr(10) || 'e' || chr(769)), '\\r\\n?', chr(10), 'g') AS target,
    {sql_strip("regexp_replace(nfc_normalize(chr(8195) || text || chr(9)), '\\r\\n|[\\r\\n\\t]', ' ', 'g')")} AS line FROM conversations"""
)
def q_target_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets and lines of turns after normalisation."""
    c, none = table(spark, sf_dir, "conversations"), F.lit(None).cast("string")
    raw = F.concat("text", F.lit("\r\né"))
    return c.select("conv_id", "turn", t.target_text(none, raw).alias("target"), t.recognition_text(F.lit("  "), F.concat(F.lit(" "), "text", F.lit("\t"))).alias("line"))


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())


@query(f"SELECT event_type, value_task, p.prompt, p.task AS task_again FROM (SELECT event_type, CASE event_id % 4 WHEN 0 THEN 'ocr' WHEN 1 THEN 'table' WHEN 2 THEN 'chart' ELSE 'other' END AS value_task FROM events) e LEFT JOIN (VALUES {_values(PROMPTS)}) p(task, prompt) ON p.task = value_task")
def q_prompt_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of tasks, and tasks of prompts."""
    k = F.col("event_id") % 4
    e = table(spark, sf_dir, "events").select("event_type", F.when(k == 0, "ocr").when(k == 1, "table").when(k == 2, "chart").otherwise("other").alias("value_task"))
    e = e.withColumn("prompt", t.prompt_of(F.col("value_task")))
    return e.withColumn("task_again", t.task_of_prompt(F.col("prompt")))


_LABEL_ROWS = ", ".join(f"({i}, '{x}', {'NULL' if x not in LABEL_TASK else repr(LABEL_TASK[x])})" for i, x in enumerate(LABELS))


@query(f"WITH d(i, label, task) AS (VALUES {_LABEL_ROWS}) SELECT p_partkey, label, task, task IS NULL AS skippable FROM part JOIN d ON p_partkey % 25 = i")
def q_label_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of layout labels, and labels that may be skipped."""
    label = F.element_at(F.array(*(F.lit(f" {x} ") for x in LABELS)), (F.col("p_partkey") % 25 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", t.strip(label).alias("label"), t.task_of_label(label).alias("task"), t.is_skippable(label).alias("skippable"))


@query(
    """SELECT s_suppkey, s_acctbal AS n, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey * 1000 AS BIGINT) ELSE CAST(1500000000 AS BIGINT) END AS trainable, regexp_matches(s_name, '^Supplier') AS named FROM supplier"""
)
def q_log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts read from lines of a training log."""
    s = table(spark, sf_dir, "supplier")
    log = F.concat(F.lit("step 1 Trainable params: "), F.when(F.col("s_suppkey") % 2 == 0, F.format_number(F.col("s_suppkey") * 1000, 0)).otherwise("1.5e+09"), F.lit(" all"))
    return s.select("s_suppkey", F.col("s_acctbal").alias("n"), t.log_counts(log, "Trainable params").alias("trainable"), F.col("s_name").rlike("^Supplier").alias("named"))
