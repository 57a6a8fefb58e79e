"""Tallies as Parquet: sorted and sharded files, several folders as one, and subtrees with their description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import BANDS, MERGE_FLOOR
from arbora.operators.tally import KEY
from arbora.plans.tables import stored

ORDER = ["node", "move", "bucket"]


def shard(key: Column) -> Column:
    """The top six bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 58).cast("int")


def product64(key: Column, factor: int) -> Column:
    """key * factor modulo 2 ** 64, as a signed long; a plain product raises where it does not fit."""
    whole = key.cast("decimal(19,0)") * F.lit(str(factor)).cast("decimal(19,0)")  # fits into 38 digits
    rest = F.pmod(whole, F.lit(str(1 << 64)).cast("decimal(20,0)"))
    return F.when(rest < F.lit(str(1 << 63)).cast("decimal(20,0)"), rest).otherwise(rest - F.lit(str(1 << 64)).cast("decimal(20,0)")).cast("long")


def known_bands(rows: DataFrame) -> DataFrame:
    """Rows whose band is one of the nine."""
    return rows.where(F.col("bucket").between(0, BANDS - 1))


def in_order(edges: DataFrame) -> DataFrame:
    """Edges range-sorted by node, move and band."""
    return edges.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def write_sorted(edges: DataFrame, path: str) -> None:
    """Writes in_order(); readers skip files and row groups by the smallest and largest node."""
    in_order(edges).write.parquet(path)


def read(spark: SparkSession, *folders: str, pattern: str = "agg-*") -> DataFrame:
    """The tallies of all folders, from their entries of the given name."""
    return spark.read.parquet(*(f"{f.rstrip('/')}/{pattern}" for f in folders))


def write_bucketed(edges: DataFrame, table: str, buckets: int, path: str) -> None:
    """A tally as a table of so many buckets by node, sorted within; months with as many buckets merge where they lie."""
    rows = edges.select(*KEY, "n", "ww", "d").repartition(buckets, "node")  # one file a bucket
    rows.write.bucketBy(buckets, "node").sortBy(*ORDER).option("path", path).saveAsTable(table)


def merge_bucketed(spark: SparkSession, left: str, right: str, floor: int = MERGE_FLOOR) -> DataFrame:
    """merge() of two tables by write_bucketed() with as many buckets each, without a shuffle: bucket meets bucket.

    What a node has in each is gathered, joined by node and summed within the node, which has a row for each move and band.
    """
    rest, counts = [c for c in KEY if c != "node"], ["n", "ww", "d"]
    cells = lambda t, x: spark.table(t).groupBy("node").agg(F.collect_list(F.struct(F.struct(*rest).alias("k"), *counts)).alias(x))
    none = F.array().cast(cells(left, "l").schema["l"].dataType)
    rows = cells(left, "l").join(cells(right, "r"), "node", "full").select("node", F.concat(F.coalesce("l", none), F.coalesce("r", none)).alias("rows"))
    total = lambda rows, c: F.aggregate(rows, F.lit(0).cast("long"), lambda a, x: a + x[c])

    def summed(k):
        own = F.filter("rows", lambda x: x["k"].eqNullSafe(k))
        return F.struct(k.alias("k"), *(total(own, c).alias(c) for c in counts))

    keys = F.array_distinct(F.transform("rows", lambda x: x["k"]))
    kept = rows.where(total(F.col("rows"), "n") >= floor).select("node", F.explode(F.transform(keys, summed)).alias("x"))
    return kept.select("node", "x.k.*", *(f"x.{c}" for c in counts)).select(*KEY, *counts)


def running_total(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """rows with the sum of value over all rows before, in a total order: ranges are summed by themselves, and a table of
    one row a range carries the sums of those before."""
    ranged = stored(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_all"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("_range", before("_all", W.orderBy("_range")).alias("_offset"))
    own = ranged.withColumn("_own", before(value, W.partitionBy("_range").orderBy(*order)))
    return own.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_offset") + F.col("_own")).drop("_range", "_own", "_offset")


def subtree_nodes(edges: DataFrame, depths: DataFrame) -> DataFrame:
    """(node, depth, white_to_move, is_leaf, n_moves, move_start) of the nodes in depths, in the order of depth and node.

    A leaf has no real move to a node of the subtree. move_start: the moves of all nodes before.
    """
    inside = depths.select(F.col("node").alias("child"), F.lit(True).alias("inside"))
    moves = edges.select("node", "move", "child").distinct().join(depths, "node").join(inside, "child", "left")
    rows = moves.groupBy("node", "depth").agg(F.count("*").alias("n_moves"), (~F.coalesce(F.bool_or("inside"), F.lit(False))).alias("is_leaf"))
    rows = running_total(rows, ["depth", "node"], "n_moves", "move_start")
    return rows.select("node", "depth", (F.substring("node", 1, 1) == "w").alias("white_to_move"), "is_leaf", "n_moves", "move_start")


def subtree_moves(left: DataFrame, right: DataFrame, kinds: DataFrame) -> DataFrame:
    """(node, move, kind, child, o_count, o_wins, o_draws, m_count, m_wins, m_draws): arrays by band of two tallies."""

    def arrays(rows: DataFrame, name: str) -> DataFrame:
        of = lambda c: F.array(*(F.coalesce(F.sum(F.when(F.col("bucket") == b, F.col(c))), F.lit(0)) for b in range(BANDS)))
        return rows.groupBy("node", "move").agg(*(of(c).alias(f"{name}_{x}") for c, x in (("n", "count"), ("ww", "wins"), ("d", "draws"))))

    zeros = F.array(*[F.lit(0).cast("long")] * BANDS)
    rows = kinds.select("node", "move", "kind", "child").join(arrays(left, "o"), ["node", "move"], "left").join(arrays(right, "m"), ["node", "move"], "left")
    return rows.select("node", "move", "kind", "child", *(F.coalesce(f"{s}_{x}", zeros).alias(f"{s}_{x}") for s in "om" for x in ("count", "wins", "draws")))


def subtree_counts(nodes: DataFrame, kinds: DataFrame) -> DataFrame:
    """(what, n): nodes, leaves, and moves of each kind."""
    n = F.count("*").alias("n")
    leaves = nodes.where("is_leaf").agg(n).select(F.lit("leaves").alias("what"), "n")
    return kinds.groupBy(F.col("kind").alias("what")).agg(n).unionByName(nodes.agg(n).select(F.lit("nodes").alias("what"), "n")).unionByName(leaves)


def write_subtree(nodes: DataFrame, moves: DataFrame, path: str) -> None:
    """Writes path/nodes and path/moves as sorted Parquet, and path/meta as JSON."""
    nodes.repartitionByRange("depth", "node").sortWithinPartitions("depth", "node").write.parquet(f"{path}/nodes")
    moves.repartitionByRange("node", "move").sortWithinPartitions("node", "move").write.parquet(f"{path}/moves")
    spark = nodes.sparkSession
    subtree_counts(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/moves")).coalesce(1).write.json(f"{path}/meta")


def write_simulation(rows: DataFrame, path: str) -> None:
    """Writes a simulation table as CSV with a header."""
    rows.orderBy("bucket", "arm").coalesce(1).write.option("header", True).csv(path)  # a row for each band and arm
