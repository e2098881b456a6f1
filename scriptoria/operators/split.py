"""Deterministic splits: the order is that of a hash of seed and id, so it needs no state and is the same anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded(seed: int, key: Column) -> Column:
    """What rows are shuffled by."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def holdout_size(n: Column, ratio: float) -> Column:
    """At least one and at most all but one, rounded half to even; none of fewer than two."""
    k = F.least(F.greatest(F.bround(n.cast("double") * ratio).cast("long"), F.lit(1).cast("long")), n - 1)
    return F.when(n < 2, F.lit(0).cast("long")).otherwise(k)


def stratified(rows: DataFrame, stratum: str, key: str, ratio: float, seed: int) -> DataFrame:
    """`rows` with split: in each stratum, `holdout_size` rows in seeded order are for validation.

    If no stratum has two rows, one row of all is for validation. Ranks within a stratum are counted by
    ranges of the hash: the rows before a range are summed up, and only a range is sorted in one task, so
    a stratum that holds most rows is no hot group.
    """
    order = seeded(seed, F.col(key))
    keyed = rows.withColumn("__order", order).withColumn("__range", F.substring("__order", 1, 3))
    sizes = keyed.groupBy(F.col(stratum), "__range").agg(F.count("*").alias("n"))
    running = Window.partitionBy(stratum).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(stratum)
    # 4096 ranges a stratum at most
    before = sizes.select(stratum, "__range", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("__before"), F.sum("n").over(whole).alias("__n"))
    rank = F.row_number().over(Window.partitionBy(stratum, "__range").orderBy("__order", key)) + F.col("__before")
    ranked = keyed.join(before.withColumnRenamed(stratum, "__stratum"), (F.col(stratum).eqNullSafe(F.col("__stratum"))) & (keyed["__range"] == before["__range"])).drop(before["__range"])
    ranked = ranked.withColumn("__valid", rank <= holdout_size(F.col("__n"), ratio))
    alone = sizes.groupBy(stratum).agg(F.sum("n").alias("n")).agg(F.max("n").alias("most"))
    if (alone.first()["most"] or 0) < 2:
        least = keyed.agg(F.min(F.struct("__order", key)).alias("m")).first()["m"]
        ranked = ranked.withColumn("__valid", F.lit(False) if least is None else (F.col("__order") == least[0]) & (F.col(key) == least[1]))
    return ranked.withColumn("split", F.when(F.col("__valid"), "validation").otherwise("train")).drop("__order", "__range", "__stratum", "__before", "__n", "__valid")


def by_group(rows: DataFrame, group: str, ratio: float, seed: int) -> DataFrame:
    """`rows` with split: whole groups (pages) go to one side."""
    groups = rows.select(group).distinct().withColumn("__all", F.lit(0))
    return rows.join(stratified(groups, "__all", group, ratio, seed).select(group, "split"), group)


def first_n(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; Spark keeps n rows of a group in each task before it shuffles them."""
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col("__rank") <= n).drop("__rank")


def shuffled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """`rows` in seeded order."""
    return rows.orderBy(seeded(seed, F.col(key)), key)


def chosen_splits(names: list[str]) -> tuple[str, str | None]:
    """(train, validation) of the splits that a dataset has; a test split is never used.

    Train is 'train', or the only split but for those of validation and test; validation is the first there is of validation,
    valid and dev.
    """
    validation = next((x for x in ("validation", "valid", "dev") if x in names), None)
    others = [x for x in names if x not in ("validation", "valid", "dev", "test")]
    if "train" in names:
        return "train", validation
    if len(others) == 1:
        return others[0], validation
    if len(names) == 1:
        return names[0], None
    raise ValueError(f"no train split among {sorted(names)}")
