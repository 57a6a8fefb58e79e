"""Targets at a fixed ply: layers that can still reach them, hero policies, and how much of the crowd they keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import AGG, BANDS, TERM
from arbora.operators.analysis import shares
from arbora.plans.tables import stored


def _steps(edges: DataFrame) -> DataFrame:
    return edges.where(R.is_real(F.col("move")) & F.col("child").isNotNull()).select("node", "move", "child").distinct()


def target_layers(edges: DataFrame, root: str, target: str, plies: int) -> DataFrame:
    """(ply, node, alive) of the nodes that real moves reach from the root, where alive ones reach the target at `plies`.

    A node is listed only where its shortest way to the target fits into the plies that are left. A node may stand in
    several layers. Without such a way there are no rows.
    """
    steps = stored(_steps(edges), "steps")
    near = stored(steps.select(F.lit(target).alias("node"), F.lit(0).alias("far")).limit(1), "near")
    edge = near
    for far in range(1, plies + 1):
        edge = stored(steps.join(edge.select(F.col("node").alias("child")), "child", "left_semi").select("node").distinct().join(near, "node", "left_anti").withColumn("far", F.lit(far)), "near")
        near = near.union(edge)
    near = stored(near, "near")
    layers = [near.where((F.col("node") == root) & (F.col("far") <= plies)).select("node")]
    for ply in range(1, plies + 1):
        close = near.where(F.col("far") <= plies - ply).select("node")
        layers.append(stored(layers[-1].join(steps, "node").select(F.col("child").alias("node")).distinct().join(close, "node", "left_semi"), "layer"))
    alive = layers[-1].where(F.col("node") == target)
    out = None
    for ply in range(plies, -1, -1):
        if ply < plies:
            ahead = steps.join(alive.select(F.col("node").alias("child")), "child", "left_semi").select("node").distinct()
            alive = stored(layers[ply].join(ahead, "node", "left_semi"), "alive")
        rows = layers[ply].join(alive.select("node", F.lit(True).alias("yes")), "node", "left").select(F.lit(ply).alias("ply"), "node", F.col("yes").isNotNull().alias("alive"))
        out = rows if out is None else out.union(rows)
    return stored(out, "layers")


def census(layers: DataFrame) -> DataFrame:
    """(ply, enumerated, survivors, widest): nodes of each layer, those alive, and the largest layer of all."""
    rows = layers.groupBy("ply").agg(F.count("*").alias("enumerated"), F.count_if("alive").alias("survivors"))
    return rows.crossJoin(F.broadcast(rows.agg(F.max("enumerated").alias("widest"))))  # one row


def _dense(alive: DataFrame) -> DataFrame:
    return alive.select("node", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("bucket"))


def policy_values(edges: DataFrame, layers: DataFrame, plies: int, policy: str, plan: list[str] | None = None, hero: str = "w", book: DataFrame | None = None) -> DataFrame:
    """(ply, node, bucket, value): chance of reaching the target from each alive node of a layer, in every band.

    The crowd moves by its shares. The hero, by policy: `best` picks the alive child of the largest value; `plan` the
    alive move that stands first in the plan, or none; `field` moves like the crowd among its alive moves. Shares come from
    `book`, if given.
    """
    steps, field = stored(_steps(edges), "steps"), stored(shares(edges if book is None else book).where(R.is_real(F.col("move"))), "shares")
    own = F.substring("node", 1, 1) == hero
    last = layers.where(f"alive and ply = {plies}").select("node")
    value = stored(_dense(last).withColumn("value", F.lit(1.0)), "value")
    out = value.withColumn("ply", F.lit(plies))
    for ply in range(plies - 1, -1, -1):
        here = layers.where(f"alive and ply = {ply}").select("node")
        ahead = value.select(F.col("node").alias("child"), "bucket", "value")
        met = here.join(field, "node").join(ahead, ["child", "bucket"])
        crowd = met.where(~own).groupBy("node", "bucket").agg(F.sum(F.col("share") * F.col("value")).alias("value"))
        if policy == "field":
            mine = met.where(own).groupBy("node", "bucket").agg((F.sum(F.col("share") * F.col("value")) / F.sum("share")).alias("value"))
        elif policy == "best":
            mine = here.where(own).join(steps, "node").join(ahead, "child").groupBy("node", "bucket").agg(F.max("value").alias("value"))
        else:
            place = F.array_position(F.array(*map(F.lit, plan or [""])), F.col("move"))
            chosen = here.where(own).join(steps, "node").join(ahead.select("child").distinct(), "child", "left_semi").withColumn("place", place).where("place > 0")
            mine = chosen.groupBy("node").agg(F.min_by("child", "place").alias("child")).join(ahead, "child").select("node", "bucket", "value")
        found = _dense(here).join(crowd.unionByName(mine), ["node", "bucket"], "left").select("node", "bucket", F.coalesce("value", F.lit(0.0)).alias("value"))
        value = stored(found, "value")
        out = out.unionByName(value.withColumn("ply", F.lit(ply)))
    return out.select("ply", "node", "bucket", "value")


def commitment(edges: DataFrame, layers: DataFrame, root: str, plies: int, hero: str = "w") -> DataFrame:
    """(bucket, commitment, arrived): of the crowd's choices at the hero's turns, by mass, the share that keeps the target
    reachable; and the mass that arrives when the hero moves like the crowd among those."""
    field = stored(shares(edges).where(R.is_real(F.col("move"))), "shares")
    at = _dense(layers.where((F.col("ply") == 0) & F.col("alive") & (F.col("node") == root)).select("node")).withColumn("mass", F.lit(1.0))
    kept = None
    for ply in range(plies):
        alive = layers.where(f"alive and ply = {ply + 1}").select(F.col("node").alias("child"))
        moves = at.join(field, ["node", "bucket"], "left").join(alive.withColumn("yes", F.lit(True)), "child", "left")
        moves = moves.withColumn("share", F.when(F.col("yes"), F.col("share")).otherwise(0.0))
        sums = moves.groupBy("node", "bucket").agg(F.max("mass").alias("mass"), F.sum("share").alias("all"))
        own = F.substring("node", 1, 1) == hero
        sums = stored(sums, "sums")
        turn = sums.where(own).select("bucket", "mass", (F.col("mass") * F.col("all")).alias("kept"))
        kept = turn if kept is None else kept.union(turn)
        moved = moves.where("yes").drop("mass").join(sums, ["node", "bucket"]).where("all > 0")
        flow = F.col("mass") * F.col("share") / F.when(own, F.col("all")).otherwise(1.0)
        at = stored(moved.groupBy(F.col("child").alias("node"), "bucket").agg(F.sum(flow).alias("mass")), "mass")
    arrived = at.groupBy("bucket").agg(F.sum("mass").alias("arrived"))
    rows = kept.groupBy("bucket").agg((F.sum("kept") / F.sum("mass")).alias("commitment"))
    return rows.join(arrived, "bucket", "left").select("bucket", "commitment", F.coalesce("arrived", F.lit(0.0)).alias("arrived"))


def in_the_wild(edges: DataFrame, root: str, target: str) -> DataFrame:
    """(bucket, root_games, target_games, ratio) of games that stood at the target against those at the root."""
    games = edges.where(F.col("node").isin(root, target)).groupBy("bucket")
    rows = games.agg(*(F.coalesce(F.sum(F.when(F.col("node") == n, F.col("n"))), F.lit(0)).alias(f"{c}_games") for n, c in ((root, "root"), (target, "target"))))
    return rows.where("root_games > 0").withColumn("ratio", F.col("target_games") / F.col("root_games"))


SINKS = ["crowd_deviated", "ended", "pooled", "off_book", "band_dry", "hero_stuck", "hero_unplayed"]


def _hero_moves(steps: DataFrame, alive: DataFrame, policy: str, ahead: DataFrame | None, plan: list[str] | None) -> DataFrame:
    """(node, bucket, child): where the hero goes from a node in each band, by the plan or by the best value ahead."""
    open_ = steps.join(alive, "child", "left_semi")
    if policy == "plan":
        place = F.array_position(F.array(*map(F.lit, plan or [""])), F.col("move"))
        first = open_.withColumn("place", place).where("place > 0").groupBy("node").agg(F.min_by("child", "place").alias("child"))
        return first.select("node", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("bucket"), "child")
    order = F.struct((-F.round("value", 12)).alias("value"), F.col("move"))
    return open_.join(ahead, "child").groupBy("node", "bucket").agg(F.min_by("child", order).alias("child"))


def hero_flow(edges: DataFrame, book: DataFrame, layers: DataFrame, plies: int, policy: str, plan: list[str] | None = None, hero: str = "w", endings: bool = False) -> DataFrame:
    """(bucket, sink, mass) of one unit of games in each band from the root of `layers`: `arrived`, or one of SINKS.

    edges are the moves that layers were made of; shares come from `book`, which may lack nodes, bands and moves of them.
    The crowd leaves by a move that gives the target up, by an end or a pooled move, where the book lacks the node, or
    where the node has no games of the band. The hero, by policy (see policy_values): is stuck where no move is left that
    the policy would take; under `field`, is unplayed where the book has none of the alive moves in the band. endings:
    under `field` the hero's band may also end the game. Masses of a band add up to one; without a living root, no rows.
    """
    steps, field = stored(_steps(edges), "steps"), stored(shares(book), "shares")
    known = stored(field.select("node").distinct().withColumn("known", F.lit(True)), "known")
    values = stored(policy_values(edges, layers, plies, "best", hero=hero, book=book), "values") if policy == "best" else None
    own = F.substring("node", 1, 1) == hero
    at, done = _dense(layers.where("ply = 0 and alive")).withColumn("mass", F.lit(1.0)), []
    for ply in range(plies):
        alive = layers.where(f"alive and ply = {ply + 1}").select(F.col("node").alias("child"))
        on = alive.withColumn("on", F.lit(True))
        played = at.join(field, ["node", "bucket"], "left").join(on, "child", "left").join(known, "node", "left")
        ends = F.when(F.col("move") == TERM, "ended").when(F.col("move") == AGG, "pooled")
        lost = F.when(F.col("known").isNull(), "off_book").when(F.col("move").isNull(), "band_dry")
        crowd = played.where(~own).select("bucket", F.col("child").alias("to"), F.coalesce(lost, ends, F.when(F.col("on").isNull(), "crowd_deviated")).alias("sink"), (F.col("mass") * F.coalesce("share", F.lit(1.0))).alias("mass"))
        if policy == "field":
            open_ = F.col("on").isNotNull() | (F.col("move") == TERM) if endings else F.col("on").isNotNull()
            weighed = played.where(own).withColumn("weight", F.when(open_, F.col("share")).otherwise(0.0))
            sums = weighed.groupBy("node", "bucket").agg(F.sum("weight").alias("all"))
            moved = weighed.where("weight > 0").join(sums, ["node", "bucket"])
            mine = moved.select("bucket", F.col("child").alias("to"), ends.alias("sink"), (F.col("mass") * F.col("weight") / F.col("all")).alias("mass"))
            unplayed = at.where(own).join(sums.where("all > 0"), ["node", "bucket"], "left_anti")
            mine = mine.unionByName(unplayed.select("bucket", F.lit(None).cast("string").alias("to"), F.lit("hero_unplayed").alias("sink"), "mass"))
        else:
            ahead = values.where(f"ply = {ply + 1}").select(F.col("node").alias("child"), "bucket", "value") if values else None
            chosen = at.where(own).join(_hero_moves(steps, alive, policy, ahead, plan), ["node", "bucket"], "left")
            mine = chosen.select("bucket", F.col("child").alias("to"), F.when(F.col("child").isNull(), "hero_stuck").alias("sink"), "mass")
        # where a mass ends does not matter, only how
        out = crowd.unionByName(mine).groupBy("bucket", F.when(F.col("sink").isNull(), F.col("to")).alias("node"), "sink").agg(F.sum("mass").alias("mass"))
        out = stored(out, "flow")
        done.append(out.where("sink is not null").select("bucket", "sink", "mass"))
        at = out.where("sink is null").select("node", "bucket", "mass")
    total = at.select("bucket", F.lit("arrived").alias("sink"), "mass")
    for rows in done:
        total = total.union(rows)
    return total.groupBy("bucket", "sink").agg(F.sum("mass").alias("mass")).where("mass > 0")
