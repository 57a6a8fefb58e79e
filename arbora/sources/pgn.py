"""Game text: one row per game with its tags, from plain or compressed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAGS = {"white_elo": "WhiteElo", "black_elo": "BlackElo", "white_diff": "WhiteRatingDiff", "black_diff": "BlackRatingDiff", "time_control": "TimeControl", "white_title": "WhiteTitle", "black_title": "BlackTitle", "result": "Result"}


def games(spark: SparkSession, path: str) -> DataFrame:
    """game_id, the tags of TAGS as text (null where absent), and movetext without comments.

    Files are split where a line starts with [Event, and .zst, .gz and .bz2 are read as they are.
    """
    rows = spark.read.option("lineSep", "\n[Event ").text(path).where(F.col("value").contains("\n[")).withColumn("value", F.regexp_replace("value", "\r", ""))
    tag = lambda name: F.nullif(F.regexp_extract("value", rf'\[{name} "([^"]*)"\]', 1), F.lit(""))
    moves = F.regexp_replace(F.regexp_extract("value", r"(?s)\n\n(.*)", 1), r"\{[^}]*\}", " ")
    return rows.select(F.xxhash64("value").alias("game_id"), *(tag(name).alias(c) for c, name in TAGS.items()), F.trim(F.regexp_replace(moves, r"\s+", " ")).alias("movetext"))


def san_moves(games_: DataFrame, most: int = 40) -> DataFrame:
    """(game_id, ply, san) of the first plies of each game, without move numbers, annotations and the result."""
    words = F.filter(F.split("movetext", " "), lambda w: ~w.rlike(r"^(\d+\.+|1-0|0-1|1/2-1/2|\*|\$\d+|)$"))
    moves = F.transform(words, lambda w: F.regexp_replace(F.regexp_replace(w, r"^\d+\.+", ""), r"[!?]+$", ""))
    return games_.select("game_id", F.posexplode(F.slice(moves, 1, most)).alias("ply", "san"))
