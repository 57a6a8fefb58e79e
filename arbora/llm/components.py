"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.workspace import discard, stored


#: Ways in which the links of a node are dealt, so that a node with very many is no task of its own.
SALTS = 16


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every end of a link; component is the smallest id that the links reach.

    links has the long columns a and b; nulls, loops and repeats are ignored; no links give no rows. Minima are
    aggregated before they are shuffled, so a node with very many links costs no more than its rows, and each round is
    written to the shared folder, and the one before removed. The many links of one node meet its minimum in several
    tasks.
    """
    found = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(found, "edges")
    before = _state(edges)
    for _ in range(rounds):
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        dealt = least.select("x", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        far = both.where("y > x").withColumn("salt", F.pmod(F.xxhash64("y"), F.lit(SALTS)).cast("int"))
        large = far.join(dealt, ["x", "salt"]).select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, edges = edges, stored(small.union(least).distinct(), "edges")
        discard(old)
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"the components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
