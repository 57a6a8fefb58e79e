"""Counting, merging and classing of outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.functions.constants import AGG, BANDS, DROP, LEAF, MERGE_FLOOR, TERM
from arbora.plans.tables import stored

KEY = ["node", "stm", "move", "child", "bucket"]


def tally(plays: DataFrame) -> DataFrame:
    """Outcome counts of each edge and band."""
    return plays.groupBy(*KEY).agg(F.count("*").alias("n"), F.sum("ww").alias("ww"), F.sum("d").alias("d"))


def merge(tallies: list[DataFrame], floor: int = MERGE_FLOOR) -> DataFrame:
    """Several tallies as one, without the nodes whose total is below the floor."""
    rows = tallies[0]
    for t in tallies[1:]:
        rows = rows.unionByName(t)
    rows = stored(rows.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in ("n", "ww", "d"))), "merged")
    kept = rows.groupBy("node").agg(F.sum("n").alias("total")).where(F.col("total") >= floor)
    return rows.join(kept.select("node"), "node", "left_semi")


def node_totals(edges: DataFrame) -> DataFrame:
    """Totals by node and band and by node; bucket is null in the latter."""
    return edges.groupingSets([[F.col("node"), F.col("bucket")], [F.col("node")]], "node", "bucket").agg(*(F.sum(c).alias(c) for c in ("n", "ww", "d")))


def classify(edges: DataFrame, drop: int = DROP, leaf: int = LEAF) -> DataFrame:
    """(node, total, class): DROPPED under drop, LEAF under leaf, else FULL."""
    rows = edges.groupBy("node").agg(F.sum("n").alias("total"))
    return rows.withColumn("class", F.when(F.col("total") < drop, "DROPPED").when(F.col("total") < leaf, "LEAF").otherwise("FULL"))


def pool(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges of kept nodes; moves of leaves, and to dropped or unknown children, are pooled under one pseudo-move."""
    own = classes.where(F.col("class") != "DROPPED").select("node", F.col("class").alias("own"))
    to = classes.select(F.col("node").alias("child"), F.col("class").alias("to"))
    rows = edges.join(own, "node").join(to, "child", "left")
    real = F.col("move") != TERM
    pooled = real & ((F.col("own") == "LEAF") | F.coalesce(F.col("to") == "DROPPED", F.lit(True)))
    rows = rows.withColumns({"move": F.when(pooled, AGG).otherwise(F.col("move")), "child": F.when(~pooled, F.col("child"))})
    return rows.groupBy("node", "stm", "move", "child", "bucket").agg(*(F.sum(c).alias(c) for c in ("n", "ww", "d")))


def pivot_bands(edges: DataFrame) -> DataFrame:
    """One row per node and move, with a column of counts for each band."""
    return edges.groupBy("node", "move").agg(*(F.coalesce(F.sum(F.when(F.col("bucket") == b, F.col("n"))), F.lit(0)).alias(f"n{b}") for b in range(BANDS)))


def join_months(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of both tallies by node and move; nodes that only the right one has are left out."""
    sums = lambda t, x: t.groupBy("node", "move").agg(*(F.sum(c).alias(f"{x}_{c}") for c in ("n", "ww", "d")))
    inside = right.join(left.select("node").distinct(), "node", "left_semi")
    rows = sums(left, "o").join(sums(inside, "m"), ["node", "move"], "full")
    return rows.select("node", "move", *(F.coalesce(f"{x}_{c}", F.lit(0)).alias(f"{x}_{c}") for x in "om" for c in ("n", "ww", "d")))


def add(edges: DataFrame, delta: DataFrame) -> DataFrame:
    """edges with the counts of delta; rows of nodes that delta does not have are passed on without a sum."""
    changed = delta.select("node").distinct()
    both = edges.join(changed, "node", "left_semi").unionByName(delta.select(edges.columns))
    summed = both.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in ("n", "ww", "d")))
    return edges.join(changed, "node", "left_anti").select(*KEY, "n", "ww", "d").unionByName(summed)


def reclassify(classes: DataFrame, edges: DataFrame, delta: DataFrame, drop: int = DROP, leaf: int = LEAF) -> DataFrame:
    """classify() of the edges, of which only the nodes in delta have changed since the classes were made."""
    changed = delta.select("node").distinct()
    return classes.join(changed, "node", "left_anti").select("node", "total", "class").unionByName(classify(edges.join(changed, "node", "left_semi"), drop, leaf))
