"""Reachability, one backup of expected scores, and its repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import BANDS, FREEZE_AFTER, MOST_SWEEPS, SETTLED, SOLID
from arbora.operators.settling import settle, sized
from arbora.plans.tables import discard, stored

VALUES = ["node", "stm", "bucket", "best_move", "eval_w", "eval_b"]
#: Sweeps in one job.
TOGETHER = 8


def reachable(edges: DataFrame, classes: DataFrame, root: str, most: int | None = None) -> DataFrame:
    """(node, depth) of what the root reaches when only FULL nodes are expanded and DROPPED ones are not entered.

    most: depth at which it stops; without it, all that is reachable is found.
    """
    steps = edges.join(classes.where("class = 'FULL'").select("node"), "node", "left_semi").select("node", "child").where("child is not null").distinct()
    steps = stored(steps.join(classes.where("class <> 'DROPPED'").select(F.col("node").alias("child")), "child", "left_semi"), "steps")
    seen = stored(classes.where((F.col("node") == root) & (F.col("class") != "DROPPED")).select("node", F.lit(0).alias("depth")), "seen")
    edge, depth = seen, 0
    while most is None or depth < most:
        depth += 1
        edge = stored(edge.select("node").join(steps, "node").select(F.col("child").alias("node")).distinct().join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)), "frontier")
        if edge.isEmpty():
            break
        seen = seen.union(edge) if depth % 16 else stored(seen.union(edge), "seen")
    return seen


def band_sums(edges: DataFrame) -> DataFrame:
    """(node, bucket, cnt, pts): games and White's points, pseudo-moves included."""
    return edges.groupBy("node", "bucket").agg(F.sum("n").alias("cnt"), F.sum(F.col("ww") + F.lit(0.5) * F.col("d")).alias("pts"))


def neighbour_prior(sums: DataFrame) -> DataFrame:
    """(node, bucket, prior, kish) of every band, from the other bands' games weighted by distance."""
    other = sums.select("node", F.col("bucket").alias("a"), "cnt", "pts", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("bucket")).where("a <> bucket")
    w = R.neighbour_weight(F.col("bucket"), F.col("a"))
    rows = other.groupBy("node", "bucket").agg(F.sum(w * F.col("pts")).alias("p"), F.sum(w * F.col("cnt")).alias("c"), F.sum(w * w * F.col("cnt")).alias("cc"))
    return rows.select("node", "bucket", (F.col("p") / F.col("c")).alias("prior"), (F.col("c") * F.col("c") / F.col("cc")).alias("kish"))


def empty_band_prior(sums: DataFrame) -> DataFrame:
    """(node, bucket, own): the band's average, or where it has no games the other bands' by distance."""
    rows = neighbour_prior(sums).join(sums, ["node", "bucket"], "full")
    return rows.select("node", "bucket", F.coalesce(F.col("pts") / F.col("cnt"), F.col("prior")).alias("own"))


def children(edges: DataFrame, sums: DataFrame, evals: DataFrame | None) -> DataFrame:
    """Edges with their score, the child's games in the band, and what White and Black can expect after them."""
    rows = edges.withColumn("edge", R.edge_score(F.col("n"), F.col("ww"), F.col("d")))
    rows = rows.join(sums.select(F.col("node").alias("child"), "bucket", F.col("cnt").alias("child_cnt")), ["child", "bucket"], "left")
    if evals is None:
        rows = rows.withColumns({"eval_w": F.lit(None).cast("double"), "eval_b": F.lit(None).cast("double")})
    else:
        rows = rows.join(evals.select(F.col("node").alias("child"), "bucket", "eval_w", "eval_b"), ["child", "bucket"], "left")
    known = R.is_real(F.col("move")) & (F.coalesce("child_cnt", F.lit(0)) > 0) & F.col("eval_w").isNotNull()
    return rows.withColumn("resolved", known).withColumns({"x_w": F.when(known, F.col("eval_w")).otherwise(F.col("edge")), "x_b": F.when(known, F.col("eval_b")).otherwise(F.col("edge"))})


def chance(rows: DataFrame) -> DataFrame:
    """(node, stm, bucket, chance_w, chance_b): what the crowd's choice leads to."""
    return rows.groupBy("node", "stm", "bucket").agg(*((F.sum(F.col("n") * F.col(f"x_{s}")) / F.sum("n")).alias(f"chance_{s}") for s in "wb"))


def candidates(rows: DataFrame, crowd: DataFrame, prior: DataFrame) -> DataFrame:
    """Real moves with score, deviation, bound, support and solid."""
    rows = rows.where(R.is_real(F.col("move"))).join(crowd.drop("stm"), ["node", "bucket"])
    rows = rows.join(prior.select(F.col("node").alias("child"), "bucket", "prior", "kish"), ["child", "bucket"], "left")
    rows = rows.withColumns({"prior": F.coalesce("prior", F.lit(0.5)), "kish": F.coalesce("kish", F.lit(0.0))})
    white = F.col("stm") == "w"
    rows = rows.withColumns({"value": F.when(white, F.col("x_w")).otherwise(F.col("x_b")), "evidence": F.when(F.col("resolved"), F.col("child_cnt")).otherwise(F.col("n")).cast("double"), "chance": F.when(white, F.col("chance_w")).otherwise(F.col("chance_b")), "strength": R.effective_strength(F.col("bucket"), F.col("kish"))})
    rows = rows.withColumn("score", R.score(*map(F.col, ("value", "evidence", "prior", "strength", "chance")))).withColumn("sd", R.deviation(F.col("evidence"), F.col("strength"), F.col("kish")))
    rows = rows.withColumns({"bound": R.bound(F.col("score"), F.col("sd"), F.col("stm")), "support": F.col("evidence") + F.col("kish")})
    return rows.withColumn("solid", F.col("support") > SOLID)


def picks(ranked: DataFrame) -> DataFrame:
    """(node, bucket, best_move, best_score): the best bound for the side to move; the first move on a tie."""
    key = F.struct(R.place(F.col("bound"), F.col("stm")).alias("b"), "move")
    best = ranked.groupBy("node", "bucket").agg(F.min_by(F.struct("move", "score"), key).alias("x"))
    return best.select("node", "bucket", F.col("x.move").alias("best_move"), F.col("x.score").alias("best_score"))


def rank_all(ranked: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """Candidates with their rank from 0; flagged (node, move) pairs come last, in the same order."""
    order = [-R.side(F.col("stm")) * F.col("bound"), F.col("move")]
    if flags is not None:
        ranked = ranked.join(flags.select("node", "move", F.lit(1).alias("flag")), ["node", "move"], "left").withColumn("flag", F.coalesce("flag", F.lit(0)))
        order.insert(0, F.col("flag"))
    return ranked.withColumn("rank", F.row_number().over(W.partitionBy("node", "bucket").orderBy(*order)) - 1)


def backup(edges: DataFrame, sums: DataFrame, prior: DataFrame, evals: DataFrame | None, frozen: DataFrame | None = None) -> DataFrame:
    """(node, stm, bucket, best_move, eval_w, eval_b): the side to move gets its pick's score, the other the crowd's.

    frozen: (node, bucket, best_move) of picks that are kept whatever the scores.
    """
    rows = children(edges, sums, evals)
    crowd = chance(rows)
    ranked = candidates(rows, crowd, prior)
    if frozen is not None:
        ranked = ranked.join(frozen.select("node", "bucket", F.col("best_move").alias("move")), ["node", "bucket", "move"], "left_semi")
    best = picks(ranked)
    out = crowd.join(best, ["node", "bucket"], "left").join(sums, ["node", "bucket"])
    own = F.coalesce("best_score", F.col("pts") / F.col("cnt"))
    white = F.col("stm") == "w"
    return out.select("node", "stm", "bucket", "best_move", F.when(white, own).otherwise(F.col("chance_w")).alias("eval_w"), F.when(white, F.col("chance_b")).otherwise(own).alias("eval_b"))


def weighed(edges: DataFrame) -> DataFrame:
    """The edges of a graph in which every child with games in the band has a value, with all that no sweep changes.

    prior and kish are the child's, evidence, strength and sd those of ranking; own: the node's average in the band.
    """
    sums = stored(band_sums(edges), "sums")
    own = sums.select("node", "bucket", (F.col("pts") / F.col("cnt")).alias("own"))
    child = sums.select(F.col("node").alias("child"), "bucket", F.col("cnt").alias("child_cnt"))
    prior = neighbour_prior(sums).select(F.col("node").alias("child"), "bucket", "prior", "kish")
    rows = edges.join(own, ["node", "bucket"]).join(child, ["child", "bucket"], "left").join(prior, ["child", "bucket"], "left")
    real = R.is_real(F.col("move"))
    rows = rows.withColumns({"edge": R.edge_score(F.col("n"), F.col("ww"), F.col("d")), "real": real, "resolved": real & (F.coalesce("child_cnt", F.lit(0)) > 0), "prior": F.coalesce("prior", F.lit(0.5)), "kish": F.coalesce("kish", F.lit(0.0))})
    rows = rows.withColumns({"evidence": F.when(F.col("resolved"), F.col("child_cnt")).otherwise(F.col("n")).cast("double"), "strength": R.effective_strength(F.col("bucket"), F.col("kish"))})
    rows = rows.withColumn("sd", R.deviation(F.col("evidence"), F.col("strength"), F.col("kish")))
    return rows.select("node", "stm", "bucket", "move", "child", "n", "own", "edge", "real", "resolved", "prior", "evidence", "strength", "sd")


def around(rows: DataFrame, inside: DataFrame | None = None, known: DataFrame | None = None, kept: tuple[str, ...] = ()) -> DataFrame:
    """rows of weighed() for step(): each with the node whose value it waits for (`via`), and one more for the node itself.

    A row whose child's value no sweep changes waits for its own node, and has that value (x_w, x_b). inside: (node,
    child) of the links that sweeps change; without it, all that are resolved. known: values of the other children.
    kept: further columns of rows that stay, null in a node's own row.
    """
    if inside is None:
        rows = rows.withColumn("inside", F.col("resolved"))
    else:
        rows = rows.join(inside.select("node", "child", F.lit(True).alias("link")), ["node", "child"], "left")
        rows = rows.withColumn("inside", F.col("resolved") & F.coalesce("link", F.lit(False))).drop("link")
    if known is None:
        rows = rows.withColumns({"eval_w": F.lit(None).cast("double"), "eval_b": F.lit(None).cast("double")})
    else:
        rows = rows.join(known.select(F.col("node").alias("child"), "bucket", "eval_w", "eval_b"), ["child", "bucket"], "left")
    x = lambda c: F.when(F.col("resolved"), F.col(c)).otherwise(F.col("edge"))
    rows = rows.withColumns({"x_w": x("eval_w"), "x_b": x("eval_b"), "via": F.when(F.col("inside"), F.col("child")).otherwise(F.col("node")), "self": F.lit(False)})
    rows = rows.select("node", "stm", "bucket", "via", "move", "n", "own", "x_w", "x_b", "inside", "real", "prior", "evidence", "strength", "sd", "self", *kept)
    none = {c: F.lit(None).cast(rows.schema[c].dataType) for c in kept}
    none |= {"via": F.col("node"), "move": F.lit(None).cast(rows.schema["move"].dataType), "n": F.lit(0).cast("long"), "x_w": F.lit(0.0), "x_b": F.lit(0.0), "inside": F.lit(False), "real": F.lit(False), "self": F.lit(True)}
    own = rows.groupBy("node", "stm", "bucket").agg(F.first("own").alias("own"))
    own = own.withColumns(none | {k: F.lit(0.0) for k in ("prior", "evidence", "strength", "sd")})
    return rows.unionByName(own)


def step(rows: DataFrame, values: DataFrame) -> DataFrame:
    """backup() of rows of around(): values with what the node had before, as struct `old`, and `asked`.

    values: (node, stm, bucket, best_move, eval_w, eval_b) and further columns. Nodes without a value take no part.
    asked: any child inside has moved; null where values do not say.
    """
    kept = [c for c in values.columns if c not in ("node", "bucket", "stm")]
    met = rows.join(values.select(F.col("node").alias("via"), "bucket", *(F.col(c).alias(f"v_{c}") for c in kept)), ["via", "bucket"])
    x = lambda c: F.when(F.col("inside"), F.col(f"v_eval_{c}")).otherwise(F.col(f"x_{c}"))
    white = F.col("stm") == "w"
    met = met.withColumns({"x_w": x("w"), "x_b": x("b")})
    moves = F.collect_list(F.when(F.col("real"), F.struct("move", F.when(white, F.col("x_w")).otherwise(F.col("x_b")).alias("value"), "prior", "evidence", "strength", "sd")))
    sums = [(F.sum(F.col("n") * F.col(f"x_{c}")) / F.sum("n")).alias(f"chance_{c}") for c in "wb"]
    asked = F.bool_or(F.when(F.col("inside"), F.col("v_moved"))) if "moved" in kept else F.lit(None).cast("boolean")
    old = F.any_value(F.when(F.col("self"), F.struct(*(F.col(f"v_{c}").alias(c) for c in kept))), F.lit(True))
    out = met.groupBy("node", "stm", "bucket").agg(F.first("own").alias("own"), *sums, moves.alias("moves"), asked.alias("asked"), old.alias("old"))
    return valued(out).select("node", "stm", "bucket", "best_move", "eval_w", "eval_b", "asked", "old")


def valued(out: DataFrame) -> DataFrame:
    """out with best_move, eval_w and eval_b from its columns moves, own, chance_w and chance_b."""
    white = F.col("stm") == "w"
    chance = F.when(white, F.col("chance_w")).otherwise(F.col("chance_b"))

    def ranked(m):
        score = R.score(m["value"], m["evidence"], m["prior"], m["strength"], chance)
        return F.struct(R.place(R.bound(score, m["sd"], F.col("stm")), F.col("stm")).alias("b"), m["move"].alias("move"), score.alias("score"))

    out = out.withColumn("best", F.array_min(F.transform("moves", ranked)))
    mine = F.coalesce("best.score", "own")
    return out.withColumns({"best_move": F.col("best.move"), "eval_w": F.when(white, mine).otherwise(F.col("chance_w")), "eval_b": F.when(white, F.col("chance_b")).otherwise(mine)})


def keeping(rows: DataFrame, picks: DataFrame) -> DataFrame:
    """rows of around() in which only the picks (node, bucket, best_move) are candidates, whatever the scores."""
    rows = rows.join(picks.select("node", "bucket", F.col("best_move").alias("kept")), ["node", "bucket"], "left")
    return rows.withColumn("real", F.col("real") & F.coalesce(F.col("move") == F.col("kept"), F.lit(False))).drop("kept")


def solve(edges: DataFrame, sweeps: int, tolerance: float | None = None, freeze_after: int = FREEZE_AFTER) -> DataFrame:
    """Repeated backup() from 0.5, so many times or until no value moves by the tolerance or more.

    With a tolerance, picks are kept from the sweep `freeze_after` on, since values may jump as long as picks change; if
    the sweeps do not suffice, it raises. Bands are settled one by one then, small ones within a task each.
    """
    rows = stored(around(weighed(stored(edges, "edges"))), "around")
    if tolerance is None:
        return _swept(rows, sweeps, None, freeze_after)
    size = {r["bucket"]: r["small"] for r in sized(rows, ["bucket"]).collect()}  # a row for each band
    small, large = ([k for k, v in size.items() if v == x] for x in (True, False))
    found = stored(settle(rows.where(F.col("bucket").isin(small)), ["bucket"], tolerance, freeze_after, sweeps, False), "settled")
    if not found.where("moved").isEmpty():
        raise RuntimeError(f"{found.where('moved').count()} values still move after {sweeps} sweeps")
    found = found.select(VALUES)
    for band in large:
        found = found.unionByName(_swept(rows.where(F.col("bucket") == band), sweeps, tolerance, freeze_after))
    return found


def _swept(rows: DataFrame, sweeps: int, tolerance: float | None, freeze_after: int) -> DataFrame:
    """solve() of rows of around() by joins. TOGETHER sweeps are one job, so it may go on for that many after it has settled."""
    kind = rows.schema["move"].dataType
    evals = rows.where("self").select("node", "stm", "bucket", F.lit(None).cast(kind).alias("best_move"), F.lit(0.5).alias("eval_w"), F.lit(0.5).alias("eval_b"))
    evals, done, moved = stored(evals, "evals"), 0, None
    while done < sweeps:
        until = min([sweeps, done + TOGETHER] + ([freeze_after] if tolerance is not None and done < freeze_after else []))
        new = evals
        for _ in range(until - done):
            new = step(rows, new.select(VALUES))
        far = F.greatest(*(F.abs(F.col(c) - F.col(f"old.{c}")) for c in ("eval_w", "eval_b")))
        new, before, done = stored(new.select(*VALUES, far.alias("far")), "evals"), evals, until
        discard(before)
        evals = new
        if tolerance is not None:
            moved = new.agg(F.max("far")).first()[0]
            if moved is None or moved < tolerance:
                break
            if done == freeze_after:
                rows = stored(keeping(rows, evals), "around")
    else:
        if tolerance is not None:
            raise RuntimeError(f"values still move by {moved} after {sweeps} sweeps")
    return evals.select(VALUES)


def settled(edges: DataFrame) -> DataFrame:
    """The fixed point of backup()."""
    return solve(edges, MOST_SWEEPS, SETTLED)


def verify(edges: DataFrame, evals: DataFrame, tolerance: float = 2e-3) -> DataFrame:
    """Stored values against one more backup: (node, bucket, delta, same_pick, within)."""
    sums = band_sums(edges)
    again = backup(edges, sums, neighbour_prior(sums), evals)
    old = evals.select("node", "bucket", F.col("eval_w").alias("w"), F.col("eval_b").alias("b"), F.col("best_move").alias("m"))
    rows = again.join(old, ["node", "bucket"])
    delta = F.greatest(F.abs(F.col("eval_w") - F.col("w")), F.abs(F.col("eval_b") - F.col("b")))
    return rows.select("node", "bucket", delta.alias("delta"), F.col("m").eqNullSafe(F.col("best_move")).alias("same_pick"), (delta <= tolerance).alias("within"))
