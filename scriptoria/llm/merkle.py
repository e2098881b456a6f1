"""A Merkle manifest of a dataset: leaves by group, one subroot a group, one root of all, and a proof for each row.

All steps are DataFrame operations. Rows are numbered in written ranges, so that no group is sorted in one task;
levels are grouped by number // fanout; siblings come down from the root by one join a level, on runs rather than
rows: all leaves of a run share the path above it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.llm.common import cut_lineage

FANOUT = 16
#: Rows of one range of the numbering.
RANGE_ROWS = 20_000
#: The digests left and right of a node in its run, for each level from the leaf up.
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: `-` if null, else its count of UTF-8 bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return digest(F.concat(*map(field, values)))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def numbered(written: DataFrame, order: list[str]) -> DataFrame:
    """`written` (a table as stored) with `idx`, the number of each row in its `grp` from 0, and `total`, the rows of the group.

    Rows are dealt into ranges by group and order, and written; a number in a range is added to the counts of the group in
    the ranges before. Rows that are equal in `order` are told apart by where they lie, so they too spread over ranges.
    """
    ranges = max(1, -(-written.count() // RANGE_ROWS))
    dealt = written.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(ranges, "grp", *order, "_at")
    dealt = cut_lineage(dealt.withColumn("_range", F.spark_partition_id()))
    # One row for each range and group in it: as many as groups and ranges together.
    by_group = Window.partitionBy("grp")
    counts = dealt.groupBy("grp", "_range").agg(F.count("*").alias("_n"))
    counts = counts.select("grp", "_range", (F.sum("_n").over(by_group.orderBy("_range")) - F.col("_n")).alias("_before"), F.sum("_n").over(by_group).alias("total"))
    place = F.row_number().over(Window.partitionBy("grp", "_range").orderBy(*order, "_at")) - 1
    found = dealt.withColumn("_place", place).join(counts, ["grp", "_range"])
    return found.withColumn("idx", F.col("_before") + F.col("_place")).drop("_at", "_range", "_place", "_before")


def levels_up(leaves: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """From (grp, idx, total, digest, ...) to (the runs of each level, what remains of each group as (grp, digest)).

    A run (grp, idx, total, digest, kids) is a node of the level above: its number there, the nodes of its group on that
    level, and its children in order, as structs of their idx and whatever else they have.
    """
    nodes, levels, tops = leaves, [], []
    most = leaves.agg(F.max("total")).first()[0] or 0
    while True:
        tops.append(nodes.where("total = 1").select("grp", "digest"))
        if most <= 1:
            return levels, reduce(DataFrame.unionByName, tops)
        kid = F.struct("idx", *(c for c in nodes.columns if c not in ("grp", "idx", "total")))
        by = ["grp", F.floor(F.col("idx") / fanout).alias("run"), F.ceil(F.col("total") / fanout).alias("above")]
        runs = nodes.where("total > 1").groupBy(*by).agg(F.array_sort(F.collect_list(kid)).alias("kids"))
        runs = cut_lineage(runs.select("grp", F.col("run").alias("idx"), F.col("above").alias("total"), digest(F.array_join("kids.digest", "")).alias("digest"), "kids"))
        levels.append(runs)
        nodes = runs.select("grp", "idx", "total", "digest")
        most = -(-most // fanout)


def _kids(runs: DataFrame, paths: DataFrame) -> DataFrame:
    """(grp, kid, path, rest of `paths`) for each child: the digests beside it in its run, then the path of its parent."""
    rest = [c for c in paths.columns if c not in ("grp", "idx", "path")]
    one = runs.select("grp", "idx", "kids").join(paths, ["grp", "idx"]).select("grp", *rest, "path", F.col("kids.digest").alias("_all"), F.posexplode("kids").alias("_i", "kid"))
    beside = F.struct(F.array_join(F.slice("_all", F.lit(1), F.col("_i")), "").alias("left"), F.array_join(F.slice("_all", F.col("_i") + 2, F.size("_all")), "").alias("right"))
    return one.select("grp", "kid", F.concat(F.array(beside), "path").alias("path"), *rest)


def paths_down(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(grp, kid, path, rest of `tops`) for each leaf, where `tops` has the path on from the top of each group.

    On each level, runs that are tops take the path of their group, the others come from the runs of the level above.
    """
    here: DataFrame | None = None
    for j in range(len(levels) - 1, -1, -1):
        own = levels[j].where("total = 1").select("grp", "idx").join(tops, "grp")
        if here is not None:
            came = _kids(levels[j + 1], here)
            own = own.unionByName(came.select("grp", F.col("kid.idx").alias("idx"), *(c for c in came.columns if c not in ("grp", "kid"))))
        here = cut_lineage(own)
    alone = leaves.where("total = 1")
    kid = F.struct("idx", *(c for c in leaves.columns if c not in ("grp", "idx", "total"))).alias("kid")
    alone = alone.select("grp", kid).join(tops, "grp")
    return alone if here is None else _kids(levels[0], here).unionByName(alone)


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", tampered: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """One row (id_col, leaf, held, subroot, root, path) for each row of `docs`.

    `leaf` hashes `columns` in their order; `held` hashes them with those of `tampered` in their place, and is the
    leaf where nothing differs. Leaves of one group ascend by id (null first, then by leaf) and become nodes by runs of
    `fanout`, until one is left, the subroot; subroots, by group (null first), likewise give the root. `path` has the
    siblings of each level, through the subroot to the root.

    A null in any column is told from an empty text. Null groups are one group, null ids are ids. Repeated rows have a
    leaf each, with a path of its own. An empty table gives an empty result. Other columns of `docs` are not read. Texts of
    any length are hashed whole, where they lie: only hashes are shuffled.
    """
    spark, of = docs.sparkSession, {c: F.col(f"`{c}`") for c in columns}
    held = leaf_hash(*((tampered or {}).get(c, v) for c, v in of.items()))
    leaves = docs.select(of.get(id_col, F.col(f"`{id_col}`")).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("")).alias("grp"), leaf_hash(*of.values()).alias("digest"), held.alias("held"))
    # A group's key is "" for null, else "=" and the value: bytewise order as asked.
    leaves = cut_lineage(numbered(cut_lineage(leaves.withColumn("held", F.when(F.col("held") != F.col("digest"), F.col("held")))), ["id", "digest"]))
    levels, subroots = levels_up(leaves, fanout)
    subroots = cut_lineage(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest"))
    subroots = cut_lineage(numbered(subroots, ["member"]))
    upper, roots = levels_up(subroots, fanout)
    root = roots.first()
    start = spark.range(1).select(F.lit("").alias("grp"), F.array().cast(PATH).alias("path"))
    tops = cut_lineage(paths_down(subroots, upper, start).select(F.col("kid.member").alias("grp"), "path", F.col("kid.digest").alias("subroot")))
    found = paths_down(leaves, levels, tops)
    return found.select(F.col("kid.id").alias(id_col), F.col("kid.digest").alias("leaf"), F.coalesce("kid.held", "kid.digest").alias("held"), "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"), "path")


def proof(path: Column) -> Column:
    """All siblings of a path as one text: level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


__all__ = ["FANOUT", "PATH", "digest", "folded", "leaf_hash", "levels_up", "manifest", "numbered", "paths_down", "proof"]
