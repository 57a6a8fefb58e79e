"""What a reader of one position sees: returns for a side, orders of its moves, and grades of played ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import EXCELLENT_MARGIN


def ordinals(edges: DataFrame) -> DataFrame:
    """Edges with the place, from 0, of their move among the node's real moves; -1 for pseudo-moves."""
    real = R.is_real(F.col("move"))
    place = F.dense_rank().over(W.partitionBy("node", real).orderBy("move")) - 1
    return edges.withColumn("ordinal", F.when(real, place).otherwise(-1))


def expected_return(side: str) -> Column:
    """What the side can expect from values (eval_w, eval_b), on its own axis."""
    return F.col("eval_w") if side == "w" else 1 - F.col("eval_b")


def sorted_rows(rows: DataFrame, column: str, best_first: bool = True) -> DataFrame:
    """rows (node, bucket, move, n, ...) with their place from 1 when a table is sorted by a column.

    `rank` puts the best first by its smallest value, `move` by the alphabet, others by the largest value. Nulls come last
    in either direction; ties go to more games, then to the move.
    """
    up = best_first == (column in ("rank", "move"))
    key = F.col(column).asc_nulls_last() if up else F.col(column).desc_nulls_last()
    return rows.withColumn("place", F.row_number().over(W.partitionBy("node", "bucket").orderBy(key, F.desc("n"), "move")))


def best_rows(rows: DataFrame) -> DataFrame:
    """(node, bucket, best): the move of rank 0, else the one marked is_best, else the first; rows without a score do not count."""
    scored = rows.where("score is not null").groupBy("node", "bucket")
    return scored.agg(F.coalesce(F.min(F.when(F.col("rank") == 0, F.col("move"))), F.min(F.when(F.col("is_best"), F.col("move"))), F.min("move")).alias("best"))


def grades(rows: DataFrame, played: DataFrame) -> DataFrame:
    """(node, bucket, move, best, loss, grade, pending) of each played move (node, bucket, move, custom).

    rows: (node, stm, bucket, move, rank, is_best, score on White's axis). A move without a score is unknown; a reader's
    own line is custom whatever it loses; loss is in percentage points and never negative.
    """
    best = best_rows(rows)
    value = rows.select("node", "bucket", "move", F.when(F.col("stm") == "w", F.col("score")).otherwise(1 - F.col("score")).alias("value"))
    out = played.join(best, ["node", "bucket"], "left").join(value, ["node", "bucket", "move"], "left")
    out = out.join(value.select("node", "bucket", F.col("move").alias("best"), F.col("value").alias("top")), ["node", "bucket", "best"], "left")
    loss = F.greatest(F.lit(0.0), (F.col("top") - F.col("value")) * 100)
    unknown = F.col("value").isNull() | F.col("top").isNull()
    grade = F.when(unknown, "unknown").when(F.col("custom"), "custom").when(F.col("move") == F.col("best"), "best").when(loss <= 100 * EXCELLENT_MARGIN, "excellent").otherwise("suboptimal")
    out = out.withColumn("grade", grade)
    zero = F.col("grade").isin("unknown", "best")
    return out.select("node", "bucket", "move", "best", F.when(zero, 0.0).otherwise(loss).alias("loss"), "grade", F.col("grade").isin("unknown", "suboptimal").alias("pending"))
