"""Games that are drawn move by move: playouts by hero policies, descents and single replies.

Draws depend on band, game, ply and arm alone, through a linear congruence on whole numbers, so results do not depend
on how rows are dealt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import AGG, SIDELINE_SHARE, TERM
from arbora.operators.analysis import draw_rows, draw_tables, popular_moves, uniform
from arbora.plans.tables import stored

ARMS = ["crowd", "policy", "popular"]
STOPS = ["ended", "pooled", "unseen_child", "no_move", "ply_cap"]


def playouts_from(edges: DataFrame, picks: DataFrame, starts: DataFrame, games: int, plies: int) -> DataFrame:
    """(bucket, start, hero, arm, sims, wins, draws, losses, obs_hero, se, mean_plies, stop_...) of games from each start.

    starts is (bucket, start, hero, place): `games` games by each arm from the node `start`, with draws of their own for
    each place. At the hero's turn the policy arm plays the pick (node, bucket, best_move), the popular arm the most
    played move; all other moves are the crowd's. A game ends where an end or a pooled move is drawn, where the child has
    no games in the band, where the hero has no move, or at the ply cap. Its result is drawn from the last edge's counts,
    in the last two cases from the node's. A hero's move that has no games in the band counts as none. Starts that have
    no games in their band are left out.

    A game meets one row of its node and draws among the options inside it, so games do not multiply on their way.
    """
    keys = ["node", "bucket"]
    chosen = picks.where("best_move is not null").select(*keys, F.col("best_move").alias("policy"))
    popular = popular_moves(edges).select(*keys, F.col("move").alias("popular"))
    tables = stored(draw_rows(edges).join(chosen, keys, "left").join(popular, keys, "left"), "draws")
    have = tables.select(F.col("node").alias("child"), "bucket", F.lit(True).alias("seen"))
    number = sum((F.when(F.col("arm") == a, k).otherwise(0) for k, a in enumerate(ARMS[1:], 1)), F.lit(0))
    here = starts.withColumn("node", F.col("start")).join(tables.select(*keys), keys, "left_semi")
    at = here.withColumn("arm", F.explode(F.array(*map(F.lit, ARMS)))).withColumn("game", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(games - 1).cast("long"))))
    own = (F.substring("node", 1, 1) == F.col("hero")) & (F.col("arm") != "crowd")
    wanted = F.when(F.col("arm") == "policy", F.col("policy")).otherwise(F.col("popular"))
    name, over = ["bucket", "start", "hero", "place", "arm", "game"], None
    for ply in range(plies):
        u = uniform(F.col("bucket") * 7919, F.col("game"), F.lit(ply * 31) + F.col("place") * 613, number * 101) * F.col("all")
        drawn = at.join(tables, keys).withColumns({"u": u, "wanted": wanted})
        below = F.size(F.filter("options", lambda o: o["high"] <= F.col("u")))
        mine = F.get(F.filter("options", lambda o: o["move"] == F.col("wanted")), F.lit(0))
        rows = drawn.withColumn("o", F.when(own, mine).otherwise(F.get("options", below))).withColumn("child", F.col("o.child")).join(have, ["child", "bucket"], "left")
        move = F.col("o.move")
        stop = F.when(move.isNull(), "no_move").when(move == TERM, "ended").when(move == AGG, "pooled").when(F.col("seen").isNull(), "unseen_child")
        rows = rows.withColumn("stop", stop).withColumn("plies", F.when(F.col("stop").isin("ended", "pooled", "no_move"), ply).otherwise(ply + 1))
        of = lambda c, whole: F.when(F.col("stop") == "no_move", F.col(whole)).otherwise(F.col(f"o.{c}")).alias(c)
        rows = stored(rows.select(*name, F.coalesce("child", "node").alias("node"), "stop", "plies", of("n", "all"), of("ww", "ww"), of("d", "d")), "games")
        done = rows.where("stop is not null").drop("node")
        over = done if over is None else over.unionByName(done)
        at = rows.where("stop is null").select(*name, "node")
    capped = at.join(tables, keys).select(*name, F.lit("ply_cap").alias("stop"), F.lit(plies).alias("plies"), F.col("all").alias("n"), "ww", "d")
    rows = capped if over is None else over.unionByName(capped)
    u = uniform(F.col("bucket") * 104729, F.col("game"), F.lit(17) + F.col("place") * 613, number * 101) * F.col("n")
    white = F.when(u < F.col("ww"), 1.0).when(u < F.col("ww") + F.col("d"), 0.5).otherwise(0.0)
    rows = rows.withColumn("points", F.when(F.col("hero") == "w", white).otherwise(1 - white))
    se = F.sqrt(F.greatest(F.lit(0.0), F.avg(F.col("points") * F.col("points")) - F.avg("points") * F.avg("points")) / F.count("*"))
    results = [F.count_if(F.col("points") == x).alias(c) for c, x in (("wins", 1.0), ("draws", 0.5), ("losses", 0.0))]
    stops = [F.count_if(F.col("stop") == s).alias(f"stop_{s}") for s in STOPS]
    return rows.groupBy("bucket", "start", "hero", "arm").agg(F.count("*").alias("sims"), *results, F.avg("points").alias("obs_hero"), se.alias("se"), F.avg("plies").alias("mean_plies"), *stops)


def _root(edges: DataFrame, root: str, hero: str) -> DataFrame:
    return edges.where(F.col("node") == root).select("bucket", F.col("node").alias("start"), F.lit(hero).alias("hero"), F.lit(0).alias("place")).distinct()


def playouts(edges: DataFrame, picks: DataFrame, root: str, games: int, plies: int, hero: str = "w") -> DataFrame:
    """playouts_from() the root in every band, for one hero: without start and hero."""
    return playouts_from(edges, picks, _root(edges, root, hero), games, plies).drop("start", "hero")


def sampled_starts(edges: DataFrame, evals: DataFrame, root: str, walks: int, depth: int, per_side: int, least_depth: int = 0, least_games: int = 1) -> DataFrame:
    """(bucket, start, hero, place, depth, visits): for each band and side to move, up to `per_side` nodes of those that
    the crowd's walks from the root meet, without replacement, by a hash of the name.

    A node counts from `least_depth` on if it has enough games and a pick in the band; its depth is the least at which
    it was met, its visits are those of all such depths. The hero is the side to move.
    """
    met = descents(edges, root, walks, depth - 1).where(F.col("depth") >= least_depth).groupBy("bucket", "node").agg(F.min("depth").alias("depth"), F.sum("visits").alias("visits"))
    fit = edges.groupBy("node", "bucket").agg(F.sum("n").alias("games")).where(F.col("games") >= least_games).select("node", "bucket")
    fit = fit.join(evals.where("best_move is not null").select("node", "bucket"), ["node", "bucket"], "left_semi")
    rows = met.join(fit, ["node", "bucket"], "left_semi").withColumn("hero", F.substring("node", 1, 1))
    place = F.row_number().over(W.partitionBy("bucket", "hero").orderBy(F.md5("node"), "node"))
    return rows.withColumn("place", place).where(F.col("place") <= per_side).select("bucket", F.col("node").alias("start"), "hero", "place", "depth", "visits")


def simulated(edges: DataFrame, evals: DataFrame, starts: DataFrame, games: int, plies: int) -> DataFrame:
    """playouts_from() the starts with what was known of each before: games, values, pick, its share, the crowd's points."""
    played = playouts_from(edges, evals, starts.select("bucket", "start", "hero", "place"), games, plies)
    here = edges.join(starts.select(F.col("start").alias("node"), "bucket").distinct(), ["node", "bucket"], "left_semi").withColumnRenamed("node", "start")
    facts = here.groupBy("start", "bucket").agg(F.sum("n").alias("games"), (F.sum(F.col("ww") + F.lit(0.5) * F.col("d")) / F.sum("n")).alias("crowd"))
    known = evals.select(F.col("node").alias("start"), "bucket", "best_move", "eval_w", "eval_b")
    share = here.select("start", "bucket", F.col("move").alias("best_move"), F.col("n").alias("best_n"))
    rows = played.join(facts, ["start", "bucket"]).join(known, ["start", "bucket"]).join(share, ["start", "bucket", "best_move"], "left")
    white = F.col("hero") == "w"
    flip = lambda w, b: F.when(white, F.col(w)).otherwise(1 - F.col(b))
    more = [c for c in ("depth", "visits") if c in starts.columns]
    if more:
        rows = rows.join(starts.select("bucket", "start", "hero", *more, white.alias("white_to_move")), ["bucket", "start", "hero"])
        more.insert(1, "white_to_move")
    return rows.select(
        "bucket", F.col("start").alias("node"), *more, "hero", "games", "eval_w", "eval_b", flip("eval_w", "eval_b").alias("pred_hero"),
        "best_move", (F.coalesce("best_n", F.lit(0)) / F.col("games")).alias("best_share"), flip("crowd", "crowd").alias("crowd_hero"), "arm", "sims", "wins", "draws", "losses", "obs_hero", "se", "mean_plies", *(f"stop_{s}" for s in STOPS),
    )


def simulation_table(edges: DataFrame, evals: DataFrame, root: str, games: int, plies: int, hero: str = "w") -> DataFrame:
    """simulated() from the root in every band."""
    return simulated(edges, evals, _root(edges, root, hero), games, plies)


def descents(edges: DataFrame, root: str, walks: int, depth: int) -> DataFrame:
    """(bucket, node, depth, visits) of walks down from the root by the crowd's draws, each band by itself.

    A walk stops at an end, at a pooled move and where the child has no games in its band.
    """
    tables = stored(draw_tables(edges), "draws")
    at = tables.where(F.col("node") == root).select("bucket", "node").distinct().withColumn("walk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(walks - 1).cast("long"))))
    have, out = tables.select("node", "bucket").distinct(), None
    for step in range(depth + 1):
        at = stored(at, "walks")
        seen = at.groupBy("bucket", "node").agg(F.count("*").alias("visits")).withColumn("depth", F.lit(step))
        out = seen if out is None else out.unionByName(seen)
        u = uniform(F.col("bucket") * 7919, F.col("walk"), F.lit(step * 37)) * F.col("all")
        drawn = at.join(tables, ["node", "bucket"]).where((F.col("low") <= u) & (u < F.col("high")) & R.is_real(F.col("move")))
        at = drawn.select("bucket", "walk", F.col("child").alias("node")).join(have, ["node", "bucket"], "left_semi")
    return out.select("bucket", "node", "depth", "visits")


def weighted_reply(edges: DataFrame, *keys: Column) -> DataFrame:
    """(node, bucket, move, share, sideline): one real move of each node and band, drawn by its games among real moves."""
    w = W.partitionBy("node", "bucket")
    to = F.sum("n").over(w.orderBy("move").rowsBetween(W.unboundedPreceding, 0))
    rows = edges.where(R.is_real(F.col("move"))).withColumns({"to": to, "all": F.sum("n").over(w)})
    u = uniform(*keys) * F.col("all")
    drawn = rows.where((F.col("to") - F.col("n") <= u) & (u < F.col("to")))
    share = F.col("n") / F.col("all")
    return drawn.select("node", "bucket", "move", share.alias("share"), (share < SIDELINE_SHARE).alias("sideline"))
