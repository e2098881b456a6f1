"""First admitted of several rows with one digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_admitted(rows: DataFrame, digest: Column, order: Column, ok: Column) -> DataFrame:
    """`rows` with verdict: admitted for the first good row of a digest by `order`, duplicate for all rows behind it, own for others.

    'own' rows have failed for a reason of their own, before any good row. The first good row is found by an
    aggregation with partial sums in the tasks, so a digest that very many rows have is no hot group.
    """
    keyed = rows.withColumn("__digest", digest).withColumn("__order", order).withColumn("__ok", ok)
    firsts = keyed.where("__ok").groupBy("__digest").agg(F.min("__order").alias("__first"))
    joined = keyed.join(firsts, "__digest", "left")
    verdict = F.when(F.col("__order") > F.col("__first"), "duplicate").when(F.col("__order") == F.col("__first"), "admitted").otherwise("own")
    return joined.withColumn("verdict", verdict).drop("__digest", "__order", "__ok", "__first")
