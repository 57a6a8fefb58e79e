"""Event journeys as games: blocks of eight consecutive events of a user.

plays: game_id, ply, stm, node, move, child, bucket, ww, d. A block of at least five events is a game; its events are
the moves, the side to move alternates, and a last row says where it ended. ww and d say whether the block's values
add up to a win or a draw for White.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions.constants import BANDS, TERM

BLOCK, LEAST, WIN, DRAW = 8, 5, 450, 350


def plays(events: DataFrame, paths: bool = False, bands: int = BANDS) -> DataFrame:
    """paths: nodes are whole prefixes, so the graph is a tree; else the last event, so it has cycles. bands: over nine are
    not known ones."""
    ordered = W.partitionBy("user_id").orderBy("ts", "event_id")
    rows = events.select("user_id", "event_type", "value", (F.row_number().over(ordered) - 1).alias("at"))
    rows = rows.withColumn("block", F.floor(F.col("at") / BLOCK)).withColumn("ply", (F.col("at") % BLOCK).cast("int"))
    block = W.partitionBy("user_id", "block")
    seen = F.array_join(F.collect_list("event_type").over(block.orderBy("ply").rowsBetween(W.unboundedPreceding, -1)), "/")
    before = F.concat(F.lit("^/"), seen) if paths else F.coalesce(F.lag("event_type").over(block.orderBy("ply")), F.lit("^"))
    rows = rows.withColumns({"total": F.sum("value").over(block), "length": F.count("*").over(block), "before": before}).where(F.col("length") >= LEAST)
    after = F.concat("before", F.when(F.col("ply") == 0, "").otherwise("/"), "event_type") if paths else F.col("event_type")
    stm = lambda ply: F.when(ply % 2 == 0, "w").otherwise("b")
    rows = rows.select(
        F.concat_ws("-", "user_id", "block").alias("game_id"), "ply", stm(F.col("ply")).alias("stm"),
        F.concat(stm(F.col("ply")), F.lit(":"), "before").alias("node"), F.col("event_type").alias("move"),
        F.concat(stm(F.col("ply") + 1), F.lit(":"), after).alias("child"), (F.col("user_id") % bands).cast("int").alias("bucket"),
        (F.col("total") >= WIN).cast("int").alias("ww"), F.when((F.col("total") >= DRAW) & (F.col("total") < WIN), 1).otherwise(0).alias("d"), "length",
    )
    # each game's last row also becomes the row that says where it ended, in the same pass
    last = F.when(F.col("ply") == F.col("length") - 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = rows.withColumn("ended", F.explode(last))
    pick = lambda ended, moved: F.when(F.col("ended"), ended).otherwise(moved)
    ply = pick(F.col("ply") + 1, F.col("ply"))
    return rows.select("game_id", ply.alias("ply"), stm(ply).alias("stm"), pick(F.col("child"), F.col("node")).alias("node"), pick(F.lit(TERM), F.col("move")).alias("move"), F.when(~F.col("ended"), F.col("child")).alias("child"), "bucket", "ww", "d")


def staged(rows: DataFrame, length: int) -> DataFrame:
    """plays() whose nodes also say in which stage of so many plies they are reached: states of a later stage never lead back."""
    stage = lambda c, ply: F.concat(c, F.lit("@"), F.floor(ply / length).cast("string"))
    return rows.withColumns({"node": stage(F.col("node"), F.col("ply")), "child": stage(F.col("child"), F.col("ply") + 1)})
