"""Queries of event logs: saves, batches and editing sessions made from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.plans.rows import table
from scriptoria.registry import query
from scriptoria.streaming import revisions


@query(
    """WITH RECURSIVE e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, event_id % 4 AS claim FROM events),
    f AS (SELECT user_id, event_id, k, CASE WHEN claim <> 3 THEN 1 ELSE 0 END AS revision, CASE WHEN claim <> 3 THEN 'saved' ELSE 'conflict' END AS outcome FROM e WHERE k = 1
        UNION ALL SELECT e.user_id, e.event_id, e.k, CASE WHEN e.claim <> 3 THEN f.revision + 1 ELSE f.revision END, CASE WHEN e.claim <> 3 THEN 'saved' ELSE 'conflict' END FROM f JOIN e ON e.user_id = f.user_id AND e.k = f.k + 1)
    SELECT CAST(user_id AS VARCHAR) AS key, event_id AS seq, outcome, CAST(revision AS BIGINT) AS revision FROM f"""
)
def q_revision_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saves by user; every fourth kind claims a revision that is not the stored one."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % 4 == 3).alias("wrong"))
    good = F.sum((~F.col("wrong")).cast("long")).over(Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1))
    events = e.withColumn("stored", F.coalesce(good, F.lit(0))).select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), (F.col("stored") + F.when(F.col("wrong"), 1).otherwise(0)).alias("revision"), F.lit("edited").alias("status"), F.col("event_id").cast("string").alias("content"))
    return revisions.replay(events).select("key", "seq", "outcome", "revision")


@query(
    """SELECT user_id % 10 AS job, CAST(count(*) FILTER (event_id % 10 > 2) AS BIGINT) AS processed, CAST(count(*) FILTER (event_id % 10 = 1) AS BIGINT) AS skipped,
    CAST(count(*) FILTER (event_id % 10 IN (0, 2)) AS BIGINT) AS failed, CAST(0 AS BIGINT) AS validation_failed, count(*) AS done FROM events GROUP BY user_id % 10"""
)
def q_batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of ten jobs under the batch policy."""
    k = F.col("event_id") % 10
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("job"), revisions.batch_outcome(k == 0, k == 1, k == 2).alias("outcome"))
    return revisions.batch_progress(e)


@query(
    """WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'queued' WHEN 2 THEN 'running' ELSE 'completed' END AS a, CASE event_id % 3 WHEN 0 THEN 'queued' WHEN 1 THEN 'running' ELSE 'completed' END AS b FROM events)
    SELECT event_id, coalesce(a || '>', '>') || b IN ('>queued', 'queued>running', 'running>completed') AS allowed FROM s"""
)
def q_batch_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of batch jobs that are allowed."""
    a, b = F.col("event_id") % 4, F.col("event_id") % 3
    before = F.when(a == 0, F.lit(None)).when(a == 1, "queued").when(a == 2, "running").otherwise("completed")
    after = F.when(b == 0, "queued").when(b == 1, "running").otherwise("completed")
    return table(spark, sf_dir, "events").select("event_id", revisions.transition_allowed(before, after).alias("allowed"))


@query("SELECT event_type, max(value) AS peak FROM events GROUP BY event_type")
def q_gauge_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The peak of a polled gauge."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("value").alias("peak"))


@query("SELECT event_id, event_id % 5 <> 0 AS stale FROM events")
def q_stale_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that come too late."""
    k = F.col("event_id") % 5
    now = {"generation": F.lit(3), "image": F.lit("a"), "version": F.lit(7)}
    got = {"generation": F.when(k == 1, 2).otherwise(3), "image": F.when(k == 2, "b").when(k == 3, F.lit(None)).otherwise("a"), "version": F.when(k == 4, 8).otherwise(7)}
    return table(spark, sf_dir, "events").select("event_id", revisions.stale(got, now).alias("stale"))


@query(
    """WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n, event_id % 6 AS c, CAST(value AS VARCHAR) AS v FROM events),
    f AS (SELECT DISTINCT user_id, n, CAST(0 AS BIGINT) AS k, '' AS text, 'draft' AS status, FALSE AS dirty, CAST([] AS VARCHAR[]) AS undo, CAST([] AS VARCHAR[]) AS redo FROM e
        UNION ALL SELECT user_id, n, k, CASE WHEN typed THEN v WHEN undone THEN undo[-1] WHEN redone THEN redo[-1] ELSE text END,
            CASE WHEN typed OR undone OR redone THEN CASE WHEN status = 'completed' THEN 'edited' ELSE status END WHEN done THEN 'completed' ELSE status END, dirty OR typed OR undone OR redone OR done,
            CASE WHEN typed THEN list_append(undo, text)[-50:] WHEN undone THEN list_slice(undo, 1, len(undo) - 1) WHEN redone THEN list_append(undo, text) ELSE undo END,
            CASE WHEN typed THEN CAST([] AS VARCHAR[]) WHEN undone THEN list_append(redo, text) WHEN redone THEN list_slice(redo, 1, len(redo) - 1) ELSE redo END
        FROM (SELECT f.* REPLACE (e.k AS k), v, c < 3 AND v <> text AS typed, c = 3 AND len(undo) > 0 AS undone, c = 4 AND len(redo) > 0 AS redone, c = 5 AND trim(text) <> '' AS done FROM f JOIN e ON e.user_id = f.user_id AND e.k = f.k + 1))
    SELECT CAST(user_id AS VARCHAR) AS session, text, status, CAST(0 AS BIGINT) AS revision, dirty, CAST(len(undo) AS INTEGER) AS undo_steps, CAST(len(redo) AS INTEGER) AS redo_steps FROM f WHERE k = n"""
)
def q_editor_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editing sessions by user after all their events (an order-dependent fold)."""
    k = F.col("event_id") % 6
    kind = F.when(k < 3, "edit").when(k == 3, "undo").when(k == 4, "redo").otherwise("complete")
    return revisions.fold_sessions(table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("seq"), kind.alias("kind"), F.col("value").cast("string").alias("text"), F.lit(0).alias("revision")))


@query(
    """WITH RECURSIVE e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, CASE WHEN event_id % 8 = 0 THEN 'wrong' WHEN event_id % 8 < 6 THEN 'save' ELSE 'complete' END AS kind,
        CASE WHEN event_id % 3 = 0 THEN 'completed' ELSE 'edited' END AS claim, event_type || '/' || (event_id % 2) || '/' || (event_id % 3) AS blocks, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS validated FROM events),
    f AS (SELECT user_id, event_id, k, CASE kind WHEN 'wrong' THEN 'conflict' WHEN 'save' THEN 'saved' ELSE 'missing' END AS outcome, CASE WHEN kind = 'save' THEN 1 ELSE 0 END AS revision, CASE WHEN kind = 'save' THEN claim END AS status,
            CASE WHEN kind = 'save' THEN blocks END AS blocks, CASE WHEN kind = 'save' THEN validated ELSE 0 END AS validated FROM e WHERE k = 1
        UNION ALL SELECT e.user_id, e.event_id, e.k, CASE WHEN e.kind = 'wrong' THEN 'conflict' WHEN e.kind = 'save' THEN 'saved' WHEN f.revision = 0 THEN 'missing' ELSE 'completed' END,
            CASE WHEN e.kind = 'save' OR e.kind = 'complete' AND f.revision > 0 THEN f.revision + 1 ELSE f.revision END,
            CASE WHEN e.kind = 'save' THEN CASE WHEN f.status = 'completed' AND e.claim = 'completed' AND e.blocks <> f.blocks THEN 'edited' ELSE e.claim END WHEN e.kind = 'complete' AND f.revision > 0 THEN 'completed' ELSE f.status END,
            CASE WHEN e.kind = 'save' THEN e.blocks ELSE f.blocks END, CASE WHEN e.kind = 'save' THEN e.validated ELSE f.validated END
        FROM f JOIN e ON e.user_id = f.user_id AND e.k = f.k + 1)
    SELECT CAST(user_id AS VARCHAR) AS page, event_id AS seq, outcome, CAST(revision AS BIGINT) AS revision, status, CASE WHEN revision > 0 THEN 2 ELSE 0 END AS n_blocks, validated AS n_validated FROM f"""
)
def q_page_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saves of pages with two blocks and completions, by user: what each event leaves of revision, status, blocks and validations."""
    from pyspark.sql import Window

    from scriptoria.streaming import pages

    k = F.col("event_id") % 8
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.when(k < 6, "save").otherwise("complete").alias("kind"), (k == 0).alias("wrong"))
    earlier = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    good = (F.col("kind") == "save") & ~F.col("wrong")
    e = e.withColumn("there", F.coalesce(F.max(good).over(earlier), F.lit(False)))
    stored = F.coalesce(F.count_if(good | (F.col("kind") == "complete") & F.col("there")).over(earlier), F.lit(0))
    block = lambda i, text, validated: F.struct(F.lit(i).alias("id"), text.alias("text"), F.lit(False).alias("skipped"), validated.alias("validated"))
    text = F.col("event_type")
    blocks = F.array(block("a", text, F.when(F.col("event_id") % 2 == 0, F.sha2(text.cast("binary"), 256)).otherwise("stale")), block("b", (F.col("event_id") % 3).cast("string"), F.lit(None).cast("string")))
    status = F.when(F.col("event_id") % 3 == 0, "completed").otherwise("edited")
    events = e.select(F.col("user_id").cast("string").alias("page"), F.col("event_id").alias("seq"), "kind", (stored + F.col("wrong").cast("int")).alias("revision"), status.alias("status"), blocks.alias("blocks"))
    return pages.replay(events)
