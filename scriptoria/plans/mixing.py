"""Queries of splits and mixing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions import text as t
from scriptoria.operators import mix, split
from scriptoria.plans.rows import table
from scriptoria.registry import query

_SIZE = "CASE WHEN count(*) OVER ({w}) < 2 THEN 0 ELSE least(greatest(round_even(count(*) OVER ({w}) * {r}, 0), 1), count(*) OVER ({w}) - 1) END"


@query(f"SELECT doc_id, source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY sha256('42:' || doc_id), doc_id) <= {_SIZE.format(w='PARTITION BY source', r=0.02)} THEN 'validation' ELSE 'train' END AS split FROM documents")
def q_split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split within their sources."""
    return split.stratified(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 0.02, 42).select("doc_id", "source", "split")


@query("SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY sha256('7:' || c_custkey)) = 1 THEN 'validation' ELSE 'train' END AS split FROM customer")
def q_split_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strata of one row each: one row of all is for validation."""
    return split.stratified(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", "c_custkey", 0.1, 7).select("c_custkey", "split")


@query(
    f"""WITH p AS (SELECT DISTINCT conv_id FROM conversations), s AS (SELECT conv_id, CASE WHEN row_number() OVER (ORDER BY sha256('42:' || conv_id), conv_id) <= {_SIZE.format(w="", r=0.1)} THEN 'validation' ELSE 'train' END AS split FROM p)
    SELECT conv_id, turn, split FROM conversations JOIN s USING (conv_id)"""
)
def q_page_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations split as wholes."""
    return split.by_group(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", 0.1, 42).select("conv_id", "turn", "split")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3")
def q_first_n_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three documents of each source."""
    return split.first_n(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"], 3)


@query("SELECT p_partkey, sha256('43:' || p_partkey) AS place FROM part")
def q_shuffle_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in seeded order."""
    return split.shuffled(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", 43).withColumn("place", split.seeded(43, F.col("p_partkey")))


@query("WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source) SELECT source, n, round(sqrt(n) / sum(sqrt(n)) OVER (), 9) AS probability FROM c")
def q_sqrt_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of sources by the roots of their sizes."""
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return mix.sqrt_probabilities(counts).withColumn("probability", F.round("probability", 9))


_RUNS = """
    WITH r AS (SELECT CAST(hash_run AS INTEGER) AS run, source, count(*) AS n FROM (SELECT *, CAST(substr(source, 4) AS INTEGER) % 3 AS hash_run FROM documents) GROUP BY run, source),
    p AS (SELECT run, source, n, sqrt(n) / sum(sqrt(n)) OVER (PARTITION BY run) * CASE run WHEN 0 THEN 0.5 WHEN 1 THEN 0.3 ELSE 0.2 END AS probability FROM r)
"""


def _runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    docs = table(spark, sf_dir, "documents").withColumn("r", F.substring("source", 4, 9).cast("int") % 3)
    counts = docs.groupBy("r", "source").agg(F.count("*").alias("n"))
    return [mix.sqrt_probabilities(counts.where(F.col("r") == i)).select(F.lit("base").alias("model"), "source", "n", "probability") for i in range(3)]


@query(_RUNS + "SELECT run, source, n, round(probability, 9) AS probability FROM p")
def q_run_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs with weights 5, 3 and 2."""
    return mix.union_runs(_runs(spark, sf_dir), [5.0, 3.0, 2.0]).select("run", "source", "n", F.round("probability", 9).alias("probability"))


@query(_RUNS + "SELECT count(*) AS sources, CAST(sum(n) AS BIGINT) AS samples, abs(sum(probability) - 1) <= 1e-6 AS sound FROM p")
def q_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the union, and whether its probabilities sum to one."""
    union = mix.union_runs(_runs(spark, sf_dir), [5.0, 3.0, 2.0])
    return union.agg(F.count("*").alias("sources"), F.sum("n").alias("samples"), mix.sums_to_one(F.sum("probability")).alias("sound"))


@query("SELECT event_type AS reason, CAST(sum(event_id % 5 + 1) AS BIGINT) AS n FROM events GROUP BY event_type")
def q_rejected_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of counts summed by reason."""
    maps = table(spark, sf_dir, "events").select(F.create_map("event_type", F.col("event_id") % 5 + 1).alias("rejected"))
    return mix.merged_rejections(maps)


@query("SELECT source, CAST(ceil(count(*) * 3.0 / (1 * 1 * 32 * 2)) AS BIGINT) AS steps FROM documents GROUP BY source")
def q_max_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optimiser steps by source."""
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).select("source", mix.max_steps(F.col("n"), 3, 32, 2).alias("steps"))


@query(
    """WITH f AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'train-00001-of-00004.parquet' WHEN 1 THEN 'valid-00000-of-00001-abc123.parquet' WHEN 2 THEN 'other.parquet' ELSE 'test-00000-of-00001.parquet' END AS file FROM part)
    SELECT p_partkey, CASE WHEN regexp_extract(file, '^(.+)-[0-9]{5}-of-[0-9]{5}(-[0-9A-Za-z]+)?[.]parquet$', 1) = '' THEN 'train' ELSE regexp_extract(file, '^(.+)-[0-9]{5}-of-[0-9]{5}(-[0-9A-Za-z]+)?[.]parquet$', 1) END AS split FROM f"""
)
def q_split_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits that names of parquet files tell."""
    from scriptoria.sources.datasets import split_of_file

    k = F.col("p_partkey") % 4
    file = F.when(k == 0, "train-00001-of-00004.parquet").when(k == 1, "valid-00000-of-00001-abc123.parquet").when(k == 2, "other.parquet").otherwise("test-00000-of-00001.parquet")
    return table(spark, sf_dir, "part").select("p_partkey", split_of_file(file).alias("split"))


@query(
    """WITH n AS (SELECT s_suppkey, s_name || CASE s_suppkey % 3 WHEN 0 THEN '-007b' WHEN 1 THEN '-10A' ELSE '-9a' END AS name FROM supplier)
    SELECT name, array_to_string(list_transform(regexp_extract_all(name, '[0-9]+|[^0-9]+'), lambda p: CASE WHEN regexp_matches(p, '^[0-9]') THEN lpad(CAST(CAST(p AS HUGEINT) AS VARCHAR), 20, '0') ELSE lower(p) END), chr(1)) AS key FROM n"""
)
def q_natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with the key of their natural order, in it."""
    k = F.col("s_suppkey") % 3
    n = table(spark, sf_dir, "supplier").select(F.concat("s_name", F.when(k == 0, "-007b").when(k == 1, "-10A").otherwise("-9a")).alias("name"))
    return n.withColumn("key", t.natural_key(F.col("name"))).orderBy("key", "name")


@query("SELECT lower(p_name) AS stem, count(*) AS n FROM part GROUP BY lower(p_name) HAVING count(*) > 1")
def q_duplicate_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that differ in case at most."""
    from scriptoria.sources.images import duplicate_stems

    return duplicate_stems(table(spark, sf_dir, "part").select(F.col("p_name").alias("stem")))


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang")
def q_union_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets with different columns appended, then counted by source and language."""
    docs = table(spark, sf_dir, "documents")
    parts = [docs.where("doc_id % 2 = 0").select("source", "lang", "n_chars"), docs.where("doc_id % 2 <> 0 or doc_id is null").select("lang", "source")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy("source", "lang").agg(F.count("*").alias("n"))
