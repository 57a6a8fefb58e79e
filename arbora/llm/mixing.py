"""Mixing sources to target weights over a time-varying curriculum, in DataFrame functions only.

A source's rate at training time t in [0, 1] is its target times 1 + slope * (2 t - 1). The integral of that is the
demand for its words up to t; a document's place among its source's words, put into the inverse of the demand, is
its training position. Documents are then range-sorted by position.

The order within a source is that of a hash. Its running sum is taken in two parts, over hash classes and within a
class, so a source with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.llm.text import SPACES, word_array
from arbora.llm.workspace import stored


@dataclass(frozen=True)
class Params:
    """weights: given to the sources in code point order, repeating, null last. slopes: of their schedules.

    most: a source's target is at most so many times its words. per_class: rows of a hash class, about.
    """

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    slopes: tuple[float, ...] = (0.5, 0.0, -0.5)
    most: int = 3
    per_class: int = 1_500


def targets(sizes: DataFrame, p: Params) -> DataFrame:
    """(source_key, source_size, target, slope) from (source_key, source, source_size), one row per source.

    Targets share the total by weight; what exceeds a source's cap is shared again until none is above. The sources
    that reach their cap are those of the smallest cap per weight, so one running sum in that order finds the level.
    """
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(p.weights) + 1
    rows = sizes.withColumn("place", place)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, p.weights)), F.col("place"))).withColumn("slope", F.element_at(F.array(*map(F.lit, p.slopes)), F.col("place")))
    rows = rows.withColumn("cap", p.most * F.col("source_size").cast("double")).withColumn("level", F.col("cap") / F.col("weight"))
    by_level = W.orderBy("level", "source_key")
    spent = F.coalesce(F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    heavy = F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("common", (F.sum("source_size").over(W.partitionBy()) - spent) / heavy)
    water = F.min(F.when(F.col("common") <= F.col("level"), F.struct("level", "source_key", "common"))).over(W.partitionBy())
    return rows.withColumn("water", water["common"]).select("source_key", "source_size", F.least("cap", F.col("water") * F.col("weight")).alias("target"), "slope")


def _moment(share: Column, slope: Column) -> Column:
    """The time at which a source's demand reaches a share of its target."""
    curved = (slope - 1 + F.sqrt((1 - slope) ** 2 + 4 * slope * share)) / (2 * F.when(slope != 0, slope))
    return F.when(slope == 0, share).otherwise(curved)


def mix(docs: DataFrame, p: Params = Params(), keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, size, source_size, target, taken, positions) of each row of docs; row is a struct of the columns `keep`.

    Uses doc_id, text and source; keep is all columns unless given. size counts words, of a null text 0. taken is how many of a document's words the mix
    takes: all of them once per full pass over the source, and in the last pass those before the target is met, so at
    most one document of a source is taken in part. positions: of each pass that takes it. A null source is a source;
    repeated rows are taken like different ones; of no rows there is no mix.
    """
    key = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source").cast("string")))
    order = F.xxhash64("doc_id", F.xxhash64("text")).bitwiseAND(F.lit(2**60 - 1))
    sized = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col("doc_id").alias("doc"), F.size(word_array(F.col("text"))).cast("long").alias("size"), key.alias("source_key"), F.col("source").cast("string").alias("source"), order.alias("draw"))
    narrow = stored(sized.select("source_key", "source", "size", F.shiftright("draw", 40).alias("fine")).groupBy("source_key", "source", "fine").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "sizes")
    bits = max(0, ((narrow.agg(F.sum("n")).first()[0] or 0) // p.per_class).bit_length())
    place = F.shiftright("draw", 60 - min(bits, 20))
    classes = narrow.withColumn("class", F.shiftright("fine", 20 - min(bits, 20))).groupBy("source_key", "source", "class").agg(F.sum("size").alias("size"))
    classes = stored(classes, "classes")
    goals = targets(classes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size")), p)
    in_source = W.partitionBy("source_key").orderBy("class").rowsBetween(W.unboundedPreceding, -1)
    starts = classes.withColumn("begin", F.coalesce(F.sum("size").over(in_source), F.lit(0))).drop("size", "source").join(goals, "source_key")
    starts = stored(starts, "starts")
    in_class = W.partitionBy("source_key", "class").orderBy("draw", "doc").rowsBetween(W.unboundedPreceding, -1)
    rows = sized.drop("source").withColumn("class", place).withColumn("within", F.coalesce(F.sum("size").over(in_class), F.lit(0)))
    rows = rows.join(starts, ["source_key", "class"]).withColumn("before", F.col("begin") + F.col("within"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("passes", passes.cast("long"))
    partly = F.greatest(F.lit(0), F.least(F.col("size"), F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long") - F.col("before")))
    rows = rows.withColumn("partly", partly.cast("long")).withColumn("taken", F.col("passes") * F.col("size") + F.col("partly"))
    copies = F.col("passes") + (F.col("partly") > 0).cast("long")
    share = lambda k: F.least(F.lit(1.0), (k * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.col("target"))
    times = F.when((copies > 0) & (F.col("size") > 0), F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), lambda k: _moment(share(k), F.col("slope")))).otherwise(F.array().cast("array<double>"))
    return rows.select("row", "size", "source_size", "target", "taken", times.alias("positions"))


def in_training_order(plan: DataFrame, tie: str = "doc_id") -> DataFrame:
    """The rows of a plan once each, range-sorted by first position; those that the mix leaves out come last.

    tie: a column whose hash orders rows of one position, so that the left-out rows are spread over tasks as well.
    """
    order = ["position", "tie"]
    rows = plan.withColumn("position", F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))).withColumn("tie", F.xxhash64(tie))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")


def curriculum(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs that a mix trains on, as often as it takes them, range-sorted by position.

    Only the columns of docs are returned. The one document of a source that the last pass takes in part has there the
    words that were taken, with single spaces between them.
    """
    rows = mix(docs, p).select("*", F.posexplode("positions").alias("pass", "position"))
    rows = rows.withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size")))
    cut = F.concat_ws(" ", F.slice(F.split(F.btrim("row.text", F.lit(" \t\n\x0b\f\r")), SPACES), F.lit(1), F.col("words").cast("int")))
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("row.text"))
    columns = [text.alias("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns]
    return rows.select("position", *columns).repartitionByRange("position").sortWithinPartitions("position").drop("position") if "position" not in docs.columns else rows.repartitionByRange("position").sortWithinPartitions("position").select(*columns)
