"""How document filters interact: what each one removes in every order, and who is removed by it alone.

Four filters judge a text by itself; the fifth fails every copy of a text but the one of the smallest doc_id. Copies are
found by refining a partition of the rows: by length in code points, then by the hash of one block of the text after the
other. After each step rows that are alone in their class are dropped. What is left is compared in full with the text of
the smallest id of its class; rows that differ from it (two texts of one hash) form the next classes, until all are
settled. Then only the combinations of failures are counted, of which there are at most 32 in each part.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.llm.text import word_array
from arbora.llm.workspace import discard, stored

FILTERS = "ABCDE"
#: Code points of the successive blocks; the last block is all that follows.
BLOCKS = (64, 1024, 16384)
#: A class with over a thousandth of the rows is dealt to so many tasks; there are less than a thousand of these.
SALTS = 64
#: Words of 64 bits of the sieve that keeps texts without a partner from being shuffled.
SIEVE = 1 << 15


def own_failures(text: Column) -> Column:
    """Bits 0 to 3: under 50 words; 100 * distinct words < 65 * words; over 5 % of A-Z; a character of [#$%&*|]."""
    words = word_array(text)
    n = F.size(words)
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = (n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]"))
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def block_hashes(text: Column, blocks: tuple[int, ...] = BLOCKS) -> Column:
    """A hash of each block; a block behind the text's end is empty."""
    starts = [1 + sum(blocks[:i]) for i in range(len(blocks) + 1)]
    parts = [F.substring(text, s, b) for s, b in zip(starts, blocks)]
    return F.array(*map(F.xxhash64, parts), F.xxhash64(F.substring(text, starts[-1], 2**31 - 1)))


def _prepared(docs: DataFrame, hashes) -> DataFrame:
    """(doc_id, part, text, n, blocks) with a null text as an empty one and a null source as an empty part."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumns({"n": F.length("text").cast("long"), "blocks": hashes(F.col("text"))})


def _split(rows: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose class has at least two, (class, least, heavy) of these classes)."""
    classes = stored(rows.groupBy("class").agg(F.count("*").alias("k"), F.min("doc_id").alias("least")).where("k > 1").select("class", "least", (F.col("k") * 1000 > total).alias("heavy")), "classes")
    flagged = rows.join(F.broadcast(classes.where("heavy").select("class", "heavy")), "class", "left")
    light = flagged.where("heavy is null").join(classes.where("not heavy").select("class"), "class", "left_semi")
    return flagged.where("heavy").unionByName(light).drop("heavy"), classes


def refined(narrow: DataFrame, total: int, steps: int) -> DataFrame:
    """(class, least, heavy) of the classes of rows (doc_id, n, blocks) that stay together through all steps."""
    rows, classes, old = narrow.select("doc_id", "blocks", F.col("n").alias("class")), None, []
    for step in range(steps + 1):
        if step:
            rows = rows.withColumn("class", F.xxhash64("class", F.col("blocks")[step - 1]))
        if classes is not None:
            discard(classes)
        rows, classes = _split(rows, total)
        if step < steps:
            rows = stored(rows, "together")
            discard(*old)
            old = [rows]
    discard(*old)
    return classes


def sieved(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows whose class may be one of the classes: a bitmap of a fixed size drops most others before any shuffle."""
    word, bit = F.pmod(F.shiftright("class", 6), F.lit(SIEVE)).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("class").bitwiseAND(63).cast("int"))
    bits = classes.select(word, bit.alias("b")).groupBy("word").agg(F.bit_or("b").alias("bits"))
    return rows.withColumn("word", word).join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")


def _salted(rows: DataFrame, dealt: bool) -> DataFrame:
    """Rows of heavy classes dealt to salts (dealt), or one copy for each salt."""
    if dealt:
        return rows.withColumn("salt", F.when(F.col("heavy"), F.pmod(F.xxhash64("doc_id", "part"), F.lit(SALTS))).otherwise(0).cast("int"))
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("heavy"), SALTS - 1).otherwise(0))))


def later_copies(docs: DataFrame, narrow: DataFrame, total: int, hashes, steps: int) -> DataFrame:
    """(doc_id, part, text) of the rows whose text equals that of a row with a smaller doc_id."""
    classes = refined(narrow, total, steps)
    of_row = F.col("n")
    for i in range(steps):
        of_row = F.xxhash64(of_row, F.col("blocks")[i])
    rows = sieved(_prepared(docs, hashes).select("doc_id", "part", "text", of_row.alias("class")), classes)
    heavy = F.broadcast(classes.where("heavy"))
    known = rows.join(heavy, "class", "left")
    light = known.where("heavy is null").drop("least", "heavy").join(classes.where("not heavy"), "class")
    members, marked = stored(known.where("heavy").unionByName(light), "members"), []
    discard(classes)
    while True:
        first = _salted(members.where("doc_id = least").groupBy("class", "heavy").agg(F.min("text").alias("first")), False).select("class", "salt", "first")
        met = _salted(members, True).join(first, ["class", "salt"])
        marked.append(stored(met.where("text = first and doc_id > least").select("doc_id", "part", "text"), "copies"))
        rest = stored(met.where("text <> first").select("doc_id", "part", "text", "class"), "others")
        discard(members)
        if rest.isEmpty():
            discard(rest)
            break
        rows, classes = _split(rest, total)
        members = stored(rows.join(classes, "class"), "members")
        discard(rest, classes)
    found = marked[0]
    for more in marked[1:]:
        found = found.unionByName(more)
    return found


def failure_counts(docs: DataFrame, labels: DataFrame, blocks: tuple[int, ...] = BLOCKS, hashes=None) -> DataFrame:
    """(part, mask, n, good, toxic): rows by source and by the filters that they fail, as bits in the order of FILTERS.

    docs has doc_id, source and text, labels has doc_id, quality and toxic; other columns are ignored. A null text counts
    as empty, and so does a null source. A row with a null doc_id is no copy, nor is any row its copy. Of repeated rows
    with one doc_id none is the other's copy, and all are counted. Several labels of a doc_id count as good or toxic if
    one of them does. Of no rows there are no counts. hashes: what gives the blocks' hashes of a text column.
    """
    hashes = hashes or (lambda text: block_hashes(text, blocks))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    narrow = stored(_prepared(docs, hashes).select("doc_id", "part", "n", "blocks", own_failures(F.col("text")).alias("mask")), "narrow")
    total = narrow.count()
    copies = later_copies(docs, narrow, total, hashes, len(blocks) + 1)
    copies = copies.select("doc_id", "part", own_failures(F.col("text")).alias("mask"))
    late = F.lit(1 << FILTERS.index("E"))
    moved = F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("n"), F.col("mask")), F.struct(F.lit(1).cast("long").alias("n"), (F.col("mask") + late).alias("mask"))))
    rows = narrow.select("doc_id", "part", F.lit(1).cast("long").alias("n"), "mask").unionByName(copies.select("doc_id", "part", moved.alias("x")).select("doc_id", "part", "x.*"))
    rows = rows.join(marks, "doc_id", "left")
    sums = [F.sum("n").alias("n"), *(F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic"))]
    return rows.groupBy("part", "mask").agg(*sums)


def audit(docs: DataFrame, labels: DataFrame, blocks: tuple[int, ...] = BLOCKS, hashes=None) -> DataFrame:
    """One row per part, order of the filters and step, with long counts of rows.

    kept: after the step. removed: by it. redundant: fail its filter, removed before. unique_fails: fail its filter only.
    good_lost, toxic_lost: removed by it and labelled so. shapley: what its filter removes, summed over all orders. Rows
    and nulls count as in failure_counts().
    """
    counts = failure_counts(docs, labels, blocks, hashes)
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # at most 32
    steps = [{"filter_order": order, "step": i + 1, "own": 1 << FILTERS.index(f), "before": sum(1 << FILTERS.index(x) for x in order[:i])} for order in map("".join, permutations(FILTERS)) for i, f in enumerate(order)]
    step = F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, before: int>>"))
    rows = cells.select("part", "cells", step.alias("s")).select("part", "cells", "s.*")
    own, before = F.col("own"), F.col("before")

    def total(which, value="n"):
        return F.aggregate(F.filter("cells", lambda x: which(x["mask"])), F.lit(0).cast("long"), lambda a, x: a + (value(x) if callable(value) else x[value]))

    fails, gone = lambda m: m.bitwiseAND(own) != 0, lambda m: m.bitwiseAND(before) != 0
    removed = lambda m: fails(m) & ~gone(m)
    orders = len(steps) // len(FILTERS)
    share = lambda x: (x["n"] * F.lit(orders) / F.bit_count(x["mask"])).cast("long")  # noqa: E731 -- 1 to 5 divide 120
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m) & ~gone(m)).alias("kept"), total(removed).alias("removed"), total(lambda m: fails(m) & gone(m)).alias("redundant"), total(lambda m: m == own).alias("unique_fails"),
        total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"), total(fails, share).alias("shapley"),
    )
