"""Questions asked of tallies: shares, calibration, target odds, draws, playouts and training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import AGG, BANDS, EXCELLENT_MARGIN, GRID, N_DRIFT, S_CAP, SIDELINE_SHARE, TARGET_MIN, TERM
from arbora.plans.tables import stored


def shares(edges: DataFrame) -> DataFrame:
    """Each edge's share of its node's games in the band."""
    w = W.partitionBy("node", "bucket")
    return edges.select("node", "bucket", "move", "child", (F.col("n") / F.sum("n").over(w)).alias("share"))


def position_stats(edges: DataFrame, node: str) -> DataFrame:
    """Moves of a node by games, with White's score and the share within the band."""
    rows = edges.where(F.col("node") == node)
    w = W.partitionBy("bucket")
    return rows.select("bucket", "move", "n", "ww", "d", (F.col("n") - F.col("ww") - F.col("d")).alias("bw"), R.edge_score(F.col("n"), F.col("ww"), F.col("d")).alias("score"), (F.col("n") / F.sum("n").over(w)).alias("share"), F.row_number().over(w.orderBy(F.desc("n"), "move")).alias("place"))


def popular_moves(edges: DataFrame) -> DataFrame:
    """The most played real move of each node and band; the first one on a tie."""
    rows = edges.where(R.is_real(F.col("move"))).groupBy("node", "bucket")
    return rows.agg(F.min_by("move", F.struct((-F.col("n")).alias("n"), "move")).alias("move"), F.max("n").alias("n"))


def calibration_cells(sums: DataFrame, least: int = TARGET_MIN, drift_least: int = N_DRIFT) -> DataFrame:
    """(bucket, w, n_targets, sse, drift_cells, drift_sse): how well other bands predict a band, by distance weight."""
    grid = F.explode(F.array(*map(F.lit, GRID)))
    other = sums.select("node", F.col("bucket").alias("a"), "cnt", "pts", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("bucket")).where("a <> bucket").withColumn("w", grid)
    weight = F.pow(F.col("w"), F.abs(F.col("bucket") - F.col("a")).cast("double"))
    near = other.groupBy("node", "bucket", "w").agg(F.sum(weight * F.col("pts")).alias("p"), F.sum(weight * F.col("cnt")).alias("c")).where("c > 0")
    rows = near.join(sums.where(F.col("cnt") >= least), ["node", "bucket"])
    miss = F.col("p") / F.col("c") - F.col("pts") / F.col("cnt")
    drift = F.col("cnt") >= drift_least
    return rows.groupBy("bucket", "w").agg(F.count("*").alias("n_targets"), F.sum(miss * miss).alias("sse"), F.count_if(drift).alias("drift_cells"), F.coalesce(F.sum(F.when(drift, miss * miss)), F.lit(0.0)).alias("drift_sse"))


def calibrate(edges: DataFrame, sums: DataFrame, least: int = TARGET_MIN, drift_least: int = N_DRIFT) -> DataFrame:
    """(bucket, w, mse, strength): the best weight of each band and the strength that its drift allows."""
    cells = calibration_cells(sums, least, drift_least)
    best = cells.groupBy("bucket").agg(F.min_by(F.struct("w", "n_targets", "sse", "drift_cells", "drift_sse"), F.struct((F.col("sse") / F.col("n_targets")).alias("m"), "w")).alias("x")).select("bucket", "x.*")
    per = edges.groupBy("node", "bucket").agg(F.sum("n").alias("n"), F.sum("ww").alias("ww"), F.sum("d").alias("d"))
    value = R.edge_score(F.col("n"), F.col("ww"), F.col("d"))
    inner = (F.col("ww") / F.col("n") + 0.25 * F.col("d") / F.col("n") - value * value) * F.col("n")
    spread = per.withColumn("inner", inner).groupBy("bucket").agg((F.sum("inner") / F.sum("n")).alias("sigma2"), F.coalesce(F.sum(F.when(F.col("n") >= drift_least, F.col("inner") / F.col("n") / F.col("n"))), F.lit(0.0)).alias("noise"))
    rows = best.join(spread, "bucket")
    drift2 = F.greatest(F.lit(0.0), (F.col("drift_sse") - F.col("noise")) / F.col("drift_cells"))
    strength = F.when(F.col("drift_cells") == 0, None).when(drift2 == 0, S_CAP).otherwise(F.least(F.lit(S_CAP), F.col("sigma2") / drift2))
    return rows.select("bucket", "w", (F.col("sse") / F.col("n_targets")).alias("mse"), strength.alias("strength"))


def spread(edges: DataFrame, root: str, depth: int) -> DataFrame:
    """(bucket, positions, mass, cover50, cover90, cover99) of where the crowd is after `depth` moves from the root."""
    step = stored(shares(edges).where(R.is_real(F.col("move"))), "shares")
    at = step.where(F.col("node") == root).select("bucket", "node").distinct().withColumn("mass", F.lit(1.0))
    for _ in range(depth):
        at = stored(at.join(step, ["node", "bucket"]).groupBy("bucket", F.col("child").alias("node")).agg(F.sum(F.col("mass") * F.col("share")).alias("mass")), "mass")
    return coverage(at)


def coverage(at: DataFrame) -> DataFrame:
    """(bucket, positions, mass, cover50, cover90, cover99) of (bucket, node, mass): how few positions hold a share of it.

    Masses are summed by classes first; single positions are ranked only in the classes where a share is reached.
    """
    heavy = F.round("mass", 12)
    at = stored(at.withColumn("class", F.floor(-8 * F.log2(F.greatest(heavy, F.lit(1e-300))))), "classed")
    w = W.partitionBy("bucket")
    before = w.orderBy("class").rowsBetween(W.unboundedPreceding, -1)
    sums = at.groupBy("bucket", "class").agg(F.sum("mass").alias("m"), F.count("*").alias("n"))
    sums = sums.withColumns({"run": F.coalesce(F.sum("m").over(before), F.lit(0.0)), "place": F.coalesce(F.sum("n").over(before), F.lit(0)), "all": F.sum("m").over(w), "positions": F.sum("n").over(w)})
    reached = lambda run, q: run / F.col("all") >= q / 100 - 1e-9
    holds = [~reached(F.col("run"), q) & reached(F.col("run") + F.col("m") * (1 + 1e-9), q) for q in (50, 90, 99)]
    open_ = stored(sums.where(holds[0] | holds[1] | holds[2]).select("bucket", "class", "run", "place", "all"), "open")
    order = W.partitionBy("bucket", "class").orderBy(heavy.desc(), "node")
    rows = at.join(open_, ["bucket", "class"]).withColumns({"to": F.col("run") + F.sum("mass").over(order.rowsBetween(W.unboundedPreceding, 0)), "at": F.col("place") + F.row_number().over(order)})
    covers = rows.groupBy("bucket").agg(*(F.min(F.when(reached(F.col("to"), q), F.col("at"))).cast("int").alias(f"cover{q}") for q in (50, 90, 99)))
    return sums.groupBy("bucket").agg(F.max("positions").alias("positions"), F.max("all").alias("mass")).join(covers, "bucket")


def target_flow(edges: DataFrame, root: str, target: str, plies: int) -> DataFrame:
    """(bucket, sink, mass): whether the crowd reaches the target within so many plies, or where it goes instead."""
    step = stored(shares(edges), "shares")
    at = step.where(F.col("node") == root).select("bucket", "node").distinct().withColumn("mass", F.lit(1.0))
    done = None
    for _ in range(plies):
        moved = at.join(step, ["node", "bucket"], "left").withColumn("mass", F.col("mass") * F.coalesce("share", F.lit(1.0)))
        sink = F.when(F.col("move").isNull(), "stuck").when(F.col("move") == TERM, "ended").when(F.col("move") == AGG, "pooled").when(F.col("child") == target, "arrived")
        moved = stored(moved.groupBy("bucket", F.col("child").alias("node"), sink.alias("sink")).agg(F.sum("mass").alias("mass")), "flow")
        out = moved.where("sink is not null").select("bucket", "sink", "mass")
        done = out if done is None else done.union(out)
        at = moved.where("sink is null").select("bucket", "node", "mass")
    done = done.union(at.select("bucket", F.lit("unplayed").alias("sink"), "mass"))
    return done.groupBy("bucket", "sink").agg(F.sum("mass").alias("mass"))


def uniform(*keys) -> object:
    """A number in [0, 1) that depends on the keys alone: squares and multiples of 48271 modulo the prime 2147483647.

    Squares part neighbouring keys; without them all draws of a game would be moved by the same amounts.
    """
    x = F.lit(20260905).cast("long")
    for k in (*keys, 7, 13):
        x = (x + k) % 2147483646 + 1
        x = x * x % 2147483647 * 48271 % 2147483647
    return x / F.lit(2147483647.0)


def draw_tables(edges: DataFrame) -> DataFrame:
    """Rows of each node and band with the interval of the games drawn that choose them."""
    w = W.partitionBy("node", "bucket")
    to = F.sum("n").over(w.orderBy("move").rowsBetween(W.unboundedPreceding, 0))
    return edges.select("node", "bucket", "move", "child", "n", "ww", "d", (to - F.col("n")).alias("low"), to.alias("high"), F.sum("n").over(w).alias("all"))


def draw_rows(edges: DataFrame) -> DataFrame:
    """One row for each node and band: all, ww and d in sum, and options (high, move, child, n, ww, d) in order of moves.

    high is the running count of games, so that a draw looks into one row; a row holds as many options as its node has
    moves.
    """
    option = F.struct("high", "move", "child", "n", "ww", "d")
    sums = [F.max("all").alias("all"), F.sum("ww").alias("ww"), F.sum("d").alias("d")]
    return draw_tables(edges).groupBy("node", "bucket").agg(*sums, F.sort_array(F.collect_list(option)).alias("options"))


def sample_nodes(edges: DataFrame, per_side: int, least: int) -> DataFrame:
    """The same number of nodes for each band and side to move, without replacement, by a hash of the name."""
    rows = edges.groupBy("node", "stm", "bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return rows.withColumn("place", F.row_number().over(W.partitionBy("bucket", "stm").orderBy(F.md5(F.encode("node", "utf-8")), "node"))).where(F.col("place") <= per_side)


def training_rows(ranked: DataFrame) -> DataFrame:
    """Candidates with rank, share of the real moves, loss against the best, grade and whether they are a sideline."""
    w = W.partitionBy("node", "bucket")
    best = F.first("score").over(w.orderBy("rank"))
    rows = ranked.withColumn("loss", F.greatest(F.lit(0.0), R.side(F.col("stm")) * (best - F.col("score")))).withColumn("share", F.col("n") / F.sum("n").over(w))
    grade = F.when(F.col("rank") == 0, "best").when(F.col("loss") <= EXCELLENT_MARGIN, "excellent").otherwise("suboptimal")
    return rows.select("node", "bucket", "move", "rank", "loss", "share", grade.alias("grade"), (F.col("share") < SIDELINE_SHARE).alias("sideline"))


def latency_histogram(events: DataFrame, bounds: list[float]) -> DataFrame:
    """(le, n, total): counts of the values up to each upper bound and over the one before, and of all up to it.

    Every bound has a row; the one above all bounds has a null bound.
    """
    counts = [F.count_if((F.col("value") <= b) if k == 0 else (F.col("value") > bounds[k - 1]) & (F.col("value") <= b)).alias(f"n{k}") for k, b in enumerate(bounds)]
    one = events.where("value is not null").agg(*counts, F.count_if(F.col("value") > bounds[-1]).alias(f"n{len(bounds)}"))
    names = [F.col(f"n{k}") for k in range(len(bounds) + 1)]
    rows = F.array(*(F.struct((F.lit(float(bounds[k])) if k < len(bounds) else F.lit(None).cast("double")).alias("le"), names[k].alias("n"), sum(names[1 : k + 1], names[0]).alias("total")) for k in range(len(names))))
    return one.select(F.inline(rows))


def calibrate_pooled(edges: DataFrame, sums: DataFrame, least: int = TARGET_MIN, drift_least: int = N_DRIFT) -> DataFrame:
    """(w, mse, strength) for all bands at once: the weight of the least mean of the bands' errors, and the upper median of
    the strengths that the bands get by themselves. Without a band to learn from, no row."""
    cells = calibration_cells(sums, least, drift_least).withColumn("mse", F.col("sse") / F.col("n_targets"))
    pooled = cells.groupBy("w").agg(F.avg("mse").alias("mse"))
    best = pooled.agg(F.min_by(F.struct("w", "mse"), F.struct(F.round("mse", 12).alias("m"), "w")).alias("x")).where("x is not null").select("x.*")
    strengths = calibrate(edges, sums, least, drift_least).where("strength is not null")
    sorted_ = F.array_sort(F.collect_list("strength"))  # one for each band
    middle = strengths.agg(F.get(sorted_, F.floor(F.size(sorted_) / 2).cast("int")).alias("strength"))
    return best.crossJoin(F.broadcast(middle))  # a row each


def header_filter(games: DataFrame) -> DataFrame:
    """Games fit for counting: both ratings known and at most 200 apart, changes under 40, no bot, slow enough, finished.

    Columns: game_id, white_elo, black_elo, white_diff, black_diff, time_control, white_title, black_title, result, as
    the text of their tags, null where a tag is absent.
    """
    number = lambda c: F.expr(f"try_cast({c} as int)")
    calm = lambda c: F.coalesce(F.abs(number(c)) < 40, F.lit(True))
    base = F.expr("try_cast(split(time_control, '[+]')[0] as int)")
    slow = F.col("time_control").isNull() | (F.contains("time_control", F.lit("+")) & F.coalesce(base >= 180, F.lit(False)))
    human = lambda c: F.coalesce(F.col(c) != "BOT", F.lit(True))
    rows = games.withColumns({"w": number("white_elo"), "b": number("black_elo")}).where(F.col("w").isNotNull() & F.col("b").isNotNull() & (F.abs(F.col("w") - F.col("b")) <= 200))
    rows = rows.where(calm("white_diff") & calm("black_diff") & slow & human("white_title") & human("black_title") & F.col("result").isin("1-0", "0-1", "1/2-1/2"))
    average = F.floor((F.col("w") + F.col("b")) / 2)
    return rows.select("game_id", R.rating_band(average).alias("bucket"), (F.col("result") == "1-0").cast("int").alias("ww"), (F.col("result") == "1/2-1/2").cast("int").alias("d"))


def edge_kinds(edges: DataFrame, depths: DataFrame) -> DataFrame:
    """Edges of the nodes in depths: TREE one step down, BACK to a node seen before, THIN out of them, TERM and AGG."""
    to = depths.select(F.col("node").alias("child"), F.col("depth").alias("to"))
    rows = edges.select("node", "move", "child").distinct().join(depths, "node").join(to, "child", "left")
    kind = F.when(F.col("move") == TERM, "TERM").when(F.col("move") == AGG, "AGG").when(F.col("to").isNull(), "THIN").when(F.col("to") == F.col("depth") + 1, "TREE").otherwise("BACK")
    return rows.select("node", "move", "child", "depth", kind.alias("kind"))


def target_value(edges: DataFrame, target: str, plies: int, best: bool) -> DataFrame:
    """(node, bucket, value): chance of reaching the target within so many plies. best: White picks, else all follow the crowd."""
    step = stored(shares(edges).where(R.is_real(F.col("move"))), "shares")
    value = step.select("node", "bucket").distinct().withColumn("value", F.lit(0.0))
    hit = F.when(F.col("child") == target, 1.0).otherwise(F.coalesce("below", F.lit(0.0)))
    for _ in range(plies):
        rows = step.join(value.select(F.col("node").alias("child"), "bucket", F.col("value").alias("below")), ["child", "bucket"], "left").withColumn("hit", hit)
        crowd = F.sum(F.col("share") * F.col("hit"))
        pick = F.when(F.substring(F.col("node"), 1, 1) == "w", F.max("hit")).otherwise(crowd) if best else crowd
        value = stored(rows.groupBy("node", "bucket").agg(pick.alias("value")), "value")
    return value


def beam(edges: DataFrame, root: str, depth: int, width: int) -> DataFrame:
    """(bucket, node, mass) after `depth` moves, of which only the `width` nodes of the largest mass in any band go on."""
    step = stored(shares(edges).where(R.is_real(F.col("move"))), "shares")
    at = step.where(F.col("node") == root).select("bucket", "node").distinct().withColumn("mass", F.lit(1.0))
    for _ in range(depth):
        rows = stored(at.join(step, ["node", "bucket"]).groupBy("bucket", F.col("child").alias("node")).agg(F.sum(F.col("mass") * F.col("share")).alias("mass")), "mass")
        top = rows.groupBy("node").agg(F.round(F.max("mass"), 12).alias("m")).orderBy(F.desc("m"), "node").limit(width)
        at = stored(rows.join(top.select("node"), "node", "left_semi"), "beam")
    return at


def offenders(checked: DataFrame, most: int = 15) -> DataFrame:
    """The largest deviations of a verification."""
    return checked.orderBy(F.desc(F.round("delta", 9)), "node", "bucket").limit(most)


def rates(events: DataFrame) -> DataFrame:
    """Change of the value per second since the user's event before; null for the first."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = (at - F.lag(at).over(w)) / F.lit(1e6)
    return events.select("event_id", ((F.col("value") - F.lag("value").over(w)) / seconds).alias("rate"))


def flagged_moves(lines: DataFrame) -> DataFrame:
    """(node, move, reason) from text lines `node | move | reason`; blank lines and lines that start with # are skipped.

    A line without three parts raises.
    """
    rows = lines.select(F.trim("value").alias("line")).where("line <> '' and not startswith(line, '#')").withColumn("part", F.split("line", r"\s*\|\s*"))
    checked = F.when(F.size("part") == 3, F.col("part")).otherwise(F.raise_error(F.concat(F.lit("not `node | move | reason`: "), "line")).cast("array<string>"))
    return rows.select(checked.alias("part")).select(*(F.col("part")[k].alias(c) for k, c in enumerate(("node", "move", "reason"))))
