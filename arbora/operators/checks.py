"""Checks of stored values against the tallies that they were made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import AGG, BANDS, K0, MIN_MOVE_GAMES, MIN_NODE_GAMES, MIN_SUPPORT, TERM, VALUE_TOLERANCE
from arbora.operators import graph as G
from arbora.plans.tables import stored


def child_range(edges: DataFrame, evals: DataFrame) -> DataFrame:
    """(node, bucket, low, high) of what the side to move can get from the children that it can choose."""
    rows = G.children(edges, G.band_sums(edges), evals).where(R.is_real(F.col("move")))
    value = F.when(F.col("stm") == "w", F.col("x_w")).otherwise(F.col("x_b"))
    return rows.groupBy("node", "bucket").agg(F.min(value).alias("low"), F.max(value).alias("high"))


def cells(edges: DataFrame, evals: DataFrame, value_tolerance: float = VALUE_TOLERANCE) -> DataFrame:
    """A row of findings for each node and band that has games; evals: (node, bucket, best_move, eval_w, eval_b)."""
    edges = stored(edges, "edges")
    sums = G.band_sums(edges)
    rows = stored(G.children(edges, sums, evals), "children")
    crowd = G.chance(rows)
    ranked = stored(G.candidates(rows, crowd, G.neighbour_prior(sums)), "candidates")
    first = F.struct((-R.side(F.col("stm")) * F.col("bound")).alias("b"), "move")
    best = ranked.groupBy("node", "bucket").agg(F.min_by(F.struct("move", "score", "evidence", "strength"), first).alias("pick"))
    span = child_range(edges, evals)
    here = edges.select("node", "bucket", F.col("move").alias("kept"), F.lit(True).alias("known"))
    old = evals.select("node", "bucket", F.col("best_move").alias("kept"), "eval_w", "eval_b")
    rows = crowd.join(sums, ["node", "bucket"]).join(best, ["node", "bucket"], "left").join(span, ["node", "bucket"], "left").join(old, ["node", "bucket"], "left").join(here, ["node", "bucket", "kept"], "left")
    white, own = F.col("stm") == "w", F.coalesce(F.col("pick.score"), F.col("pts") / F.col("cnt"))
    rows = rows.withColumns({"chooser": F.when(white, F.col("eval_w")).otherwise(F.col("eval_b")), "other": F.when(white, F.col("eval_b")).otherwise(F.col("eval_w")), "expected": F.when(white, F.col("chance_b")).otherwise(F.col("chance_w"))})
    yes = lambda c: F.coalesce(c, F.lit(False))
    finite = F.col("eval_w").isNotNull() & F.col("eval_b").isNotNull() & ~F.isnan("eval_w") & ~F.isnan("eval_b")
    pseudo = yes(F.col("kept").isin(TERM, AGG))
    checked = F.col("kept").isNotNull() & ~pseudo & yes(F.col("known"))
    thin = F.col("pick.evidence") < MIN_MOVE_GAMES
    support = F.col("pick.evidence") + F.col("pick.strength") + K0 < MIN_SUPPORT
    outside = (F.col("chooser") > F.col("high") + value_tolerance) | (F.col("chooser") < F.col("low") - value_tolerance)
    return rows.select(
        "node", "bucket", F.col("cnt").alias("games"), (~finite).alias("eval_not_finite"), yes(finite & ((F.least("eval_w", "eval_b") < 0) | (F.greatest("eval_w", "eval_b") > 1))).alias("eval_out_of_range"),
        (F.col("pick").isNotNull() & F.col("kept").isNull()).alias("move_missing"), (F.col("pick").isNull() & F.col("kept").isNotNull()).alias("move_spurious"), pseudo.alias("move_is_pseudo"),
        (F.col("kept").isNotNull() & ~pseudo & ~yes(F.col("known"))).alias("move_not_in_node"), checked.alias("checked"), yes(checked & (F.col("kept") != F.col("pick.move"))).alias("move_mismatch"),
        F.when(checked, F.abs(F.col("chooser") - own)).alias("value_delta"), F.when(checked, F.abs(F.col("other") - F.col("expected"))).alias("chance_delta"),
        yes(checked & thin).alias("thin_move"), yes(checked & support).alias("thin_support"), yes(checked & outside).alias("outside_child_range"),
    )


FLAGS = ["eval_not_finite", "eval_out_of_range", "move_missing", "move_spurious", "move_is_pseudo", "move_not_in_node", "move_mismatch"]
GATED = ["thin_move", "thin_support", "outside_child_range"]


def counters(found: DataFrame, nodes: int, visited: int, value_tolerance: float = VALUE_TOLERANCE, least_games: int = MIN_NODE_GAMES) -> DataFrame:
    """One row that counts cells(); findings of thin support warn only in well-played nodes, and are counted in all."""
    well = F.col("games") >= least_games
    delta = lambda c: F.coalesce(F.max(c), F.lit(0.0))
    over = lambda c: F.count_if(F.col(c) > value_tolerance)
    return found.agg(
        F.lit(nodes).cast("long").alias("index_nodes"), F.lit(visited).cast("long").alias("visited"), F.lit(nodes - visited).cast("long").alias("unreachable"), F.count_if("checked").alias("checked"),
        *(F.count_if(f).alias(f) for f in FLAGS), over("value_delta").alias("value_mismatch"), over("chance_delta").alias("chance_mismatch"), F.count_if(F.col("checked") & well).alias("well_played"),
        *(F.count_if(F.col(g) & well).alias(g) for g in GATED), *(F.count_if(g).alias(f"{g}_all") for g in GATED), delta("value_delta").alias("worst_value_delta"), delta("chance_delta").alias("worst_chance_delta"),
    )


def unreachable(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """(node) of the nodes with games that are not among the reached ones."""
    return edges.select("node").distinct().exceptAll(reached.select("node").distinct())


def top_children(edges: DataFrame, root: str, depth: int, most: int, width: int = 2, band: int = BANDS // 2) -> DataFrame:
    """(node, depth) of at most `most` nodes that lie on the `width` moves most played in the middle band, nearest first."""
    have = edges.select(F.col("node").alias("child")).distinct()
    steps = edges.where(R.is_real(F.col("move"))).groupBy("node", "move", "child").agg(F.sum(F.when(F.col("bucket") == band, F.col("n")).otherwise(0)).alias("n")).join(have, "child", "left_semi")
    steps = stored(steps.withColumn("place", F.row_number().over(W.partitionBy("node").orderBy(F.desc("n"), "move"))).where(F.col("place") <= width).select("node", "child"), "steps")
    seen = stored(edges.where(F.col("node") == root).select("node", F.lit(0).alias("depth")).distinct(), "seen")
    edge = seen
    for k in range(1, depth + 1):
        edge = stored(edge.select("node").join(steps, "node").select(F.col("child").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(k)), "edge")
        if edge.isEmpty():
            break
        seen = stored(seen.unionByName(edge), "seen")
    return seen.orderBy("depth", "node").limit(most)


def self_check(edges: DataFrame, evals: DataFrame, root: str, depth: int = 12, most: int = 300) -> DataFrame:
    """(checked, agreed): stored picks of top_children() that one more backup confirms."""
    few = top_children(edges, root, depth, most).select("node")
    sums = G.band_sums(edges)
    again = G.backup(edges, sums, G.neighbour_prior(sums), evals).select("node", "bucket", F.col("best_move").alias("pick"))
    rows = evals.join(few, "node", "left_semi").join(again, ["node", "bucket"]).where("best_move is not null")
    return rows.agg(F.count("*").alias("checked"), F.count_if(F.col("best_move") == F.col("pick")).alias("agreed"))
