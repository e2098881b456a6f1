"""Page state: the stream against the batch replay and a plain loop, a restart in the middle, sessions that end."""

import hashlib

from pyspark.sql import functions as F

from scriptoria.streaming import pages

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_steps():
    b = lambda text, validated=None, skipped=False, place=0: (place, text, skipped, validated)
    page, blocks, outcome = pages.step(None, {}, "save", 0, "draft", {"a": b("x", sha("x")), "b": b("y", sha("x"), place=1)})
    assert (page, outcome) == ((1, "draft"), "saved") and blocks == {"a": b("x", sha("x")), "b": b("y", None, place=1)}
    assert pages.step(page, blocks, "save", 0, "draft", {})[2] == "conflict" and pages.step(None, {}, "complete", None, None, None)[2] == "missing"
    page, new, _ = pages.step(page, blocks, "validate", None, None, {"b": b(""), "none": b("")})
    assert page == (2, "draft") and new["b"][3] == sha("y") and pages.step(page, new, "validate", None, None, {"none": b("")})[2] == "no eligible block"
    page, _, outcome = pages.step(page, new, "complete", None, None, None)
    assert (page, outcome) == ((3, "completed"), "completed") and pages.step(page, new, "validate", None, None, {"a": b("")})[2] == "read-only"
    assert pages.step(page, new, "save", 3, "completed", new)[0] == (4, "completed") and pages.step(page, new, "save", 3, "completed", {"a": b("z")})[0] == (4, "edited")
    assert pages.step(page, new, "reopen", None, None, None)[0] == (4, "draft") and pages.step((4, "draft"), new, "reopen", None, None, None)[2] == "not completed"
    assert pages.step((4, "draft"), {"a": b(" ")}, "complete", None, None, None)[2] == "no text" and pages.step((4, "draft"), {"a": b("x", None, True)}, "complete", None, None, None)[2] == "no active block"


def events_of(spark, small):
    """Events out of the table `events`: a few users' saves (some of a wrong revision), validations, completions and reopenings."""
    e = spark.read.parquet(f"{small}/events.parquet").where("event_id < 400")
    k = F.col("event_id") % 11
    kind = F.when(k < 6, "save").when(k < 8, "validate").when(k < 10, "complete").otherwise("reopen")
    text = F.when(F.col("event_id") % 13 == 0, "").otherwise((F.col("event_id") % 3).cast("string"))
    block = lambda i, t, v: F.struct(F.lit(i).alias("id"), t.alias("text"), (F.col("event_id") % 17 == 0).alias("skipped"), v.alias("validated"))
    blocks = F.array(block("a", text, F.sha2(text.cast("binary"), 256)), block("b", F.lit("y"), F.when(F.col("event_id") % 2 == 0, F.sha2(F.lit("y").cast("binary"), 256))), block("c", F.lit("z"), F.lit("stale")))
    at = (F.lit("2026-01-01").cast("timestamp").cast("long") + F.col("event_id") * 60).cast("timestamp")
    return e.select((F.col("user_id") % 7).cast("string").alias("page"), F.col("event_id").alias("seq"), at.alias("at"), kind.alias("kind"), (F.floor(F.col("event_id") / 7) % 8).cast("long").alias("revision"), F.when(k % 2 == 0, "completed").otherwise("edited").alias("status"), F.slice(blocks, 1, (F.col("event_id") % 3 + 1).cast("int")).alias("blocks"))


def plain(rows):
    state, out = {}, []
    for r in sorted(rows, key=lambda r: r["seq"]):
        page, blocks = state.get(r["page"], (None, {}))
        given = {b["id"]: (i, b["text"], b["skipped"], b["validated"]) for i, b in enumerate(r["blocks"])}
        page, new, outcome = pages.step(page, blocks, r["kind"], r["revision"], r["status"], given)
        blocks = blocks if new is None else new
        state[r["page"]] = page, blocks
        out.append((r["page"], r["seq"], outcome, page[0] if page else 0, page[1] if page else None, len(blocks), sum(b[3] is not None for b in blocks.values())))
    return out


def test_stream_is_the_replay_across_a_restart(spark, small, tmp_path):
    """Three files, the stream ended and started again from its checkpoint after each: events fold on from the state that was kept; sessions end once the watermark has passed."""
    events = events_of(spark, small)
    rows = events.collect()
    want = plain(rows)
    assert sorted(map(tuple, pages.replay(events).collect())) == sorted(want) and len({w[2] for w in want}) >= 6
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        for low, high in ((0, 100), (100, 230), (230, 400)):
            events.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = pages.follow(spark.readStream.schema(pages.EVENT).parquet(str(tmp_path / "in")), 300_000, "1 minute")
            run = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
            run.awaitTermination(120)
        got = list(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    assert sorted(r for r in got if r[1] is not None) == sorted(want)
    ended = [r for r in got if r[1] is None]
    # Five minutes without an event ends a session, as far as the last file's watermark reaches; the counts are of its own events.
    assert ended and all(r[2].startswith("idle after ") and int(r[2].split()[2]) >= 1 for r in ended)


def test_every_cell_and_category_comes_from_a_table(spark):
    """Neither the benchmark's cells nor the categories are made up: Spark reads a given table for both."""
    import __spark_entry__ as entry

    for name, table in (("q_benchmark_matrix", "documents"), ("q_taxonomy", "part")):
        read = entry.queries()[name](spark, "/root/testdata/sf0.001").inputFiles()
        assert any(f"/{table}.parquet" in path for path in read), name
