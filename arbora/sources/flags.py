"""Lists of flagged moves: text files whose lines are numbered across splits, read with every error they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.plans.tables import stored

BLANK = " \t\r\n\f\v"


def numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, line, value) of text files or folders, numbered from 1 in each file.

    Lines are numbered inside their split, whose rows one task reads in order, and the splits of a file by their running
    total; so neither a file nor a split is sorted or gathered. Blank lines count.
    """
    raw = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    raw = stored(raw, "lines")
    blocks = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    before = F.sum("size").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"))
    return raw.join(blocks, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")


def flagged_list(lines: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(file, line, node, move, reason, error) of lines `node | move | reason`: of each line that is neither blank nor opens
    with #.

    error is null where a line is sound. Otherwise it says what is wrong first: fewer than three fields, no reason, no
    or several moves, a node or a move that `edges`, if given, lack, or a move that an earlier line of the file flags. A reason
    may hold bars and signs of any kind.
    """
    text = lines.select("file", "line", F.btrim("value", F.lit(BLANK)).alias("text")).where("text <> '' and not startswith(text, '#')")
    rows = text.withColumn("one", F.instr("text", "|")).withColumn("two", F.expr("locate('|', text, one + 1)"))
    rows = rows.withColumn("whole", (F.col("one") > 0) & (F.col("two") > 0))
    field = lambda e: F.when(F.col("whole"), F.btrim(F.expr(e), F.lit(BLANK)))
    rows = rows.select("file", "line", "whole", field("substring(text, 1, one - 1)").alias("node"), field("substring(text, one + 1, two - one - 1)").alias("move"), field("substring(text, two + 1)").alias("reason"))
    wrong = F.when(~F.col("whole"), "expected three fields parted by |").when(F.col("reason") == "", "the reason is empty")
    several = (F.col("move") == "") | F.col("move").rlike(r"\s")
    if edges is not None:
        moves = edges.where(R.is_real(F.col("move"))).select("node", "move").distinct()
        rows = rows.join(edges.select("node", F.lit(True).alias("has_node")).distinct(), "node", "left").join(moves.withColumn("has_move", F.lit(True)), ["node", "move"], "left")
        wrong = wrong.when(F.col("has_node").isNull(), "no such node")
    wrong = wrong.when(several, "the middle field must name one move")
    if edges is not None:
        wrong = wrong.when(F.col("has_move").isNull(), "no such move")
    rows = rows.withColumn("error", wrong)
    again = F.row_number().over(W.partitionBy("file", "node", "move", F.col("error").isNull()).orderBy("line")) > 1
    error = F.coalesce("error", F.when(again, "already flagged"))
    return rows.select("file", "line", "node", "move", "reason", error.alias("error"))


def sound(flags: DataFrame, told: int = 20) -> DataFrame:
    """(node, move, reason) of flagged_list(), or a ValueError that tells how many lines are wrong and the first of them."""
    bad = flags.where("error is not null")
    first = bad.orderBy("file", "line").limit(told).collect()
    if first:
        raise ValueError("\n".join([f"{bad.count()} lines are wrong", *(f"{r.file}:{r.line}: {r.error}" for r in first)]))
    return flags.select("node", "move", "reason")
