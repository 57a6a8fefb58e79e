"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules need enough words and little repetition. Documents that pass are described by a few transformed rates, and
for each language and source a minimum-covariance-determinant estimate of their centre and spread is sought from several
starts by concentration steps: the documents nearest to the present estimate make the next one, as long as its
determinant falls; the start with the smallest determinant wins. Documents at a large Mahalanobis distance are rejected.
Groups that are too small for an estimate of their own are judged by that of their language, or of all documents.

Vectors are whole multiples of 1/256, so every sum is exact and reruns agree. A concentration step is one aggregation
of counts and moments by distance class, of which the class at the border counts in part; nothing is sorted and no
group is gathered.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.llm.text import word_array
from arbora.llm.workspace import discard, stored

UNIT = 256.0
DIMENSIONS = 4


@dataclass(frozen=True)
class Params:
    """coverage: share of a group that the estimate rests on. steps: concentration steps at most, after which the smallest
    determinant so far stands. false_rate: of a normal group, rejected.

    floors: least standard deviation of log word length and of the three log rates, since most texts of a tidy source
    have none of the faults that the rates count. shrink: words by which a text counts as longer in its rates, so that
    one sign in a short text is no high rate. least_group: documents of a group that is judged by its own estimate;
    least_all: documents without which none is judged.
    """

    coverage: float = 0.75
    steps: int = 30
    false_rate: float = 1e-4
    floors: tuple[float, float, float, float] = (0.1, 0.45, 0.45, 0.45)
    shrink: int = 20
    least_group: int = 50
    least_all: int = 10


def chi2(x: float, dof: int) -> float:
    """Distribution of chi-square for an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(dof // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(share: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2(mid, dof) < share else (low, mid)
    return high


def base_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(c) for c in keep)).alias("kept"), text.alias("t"))
    rows = rows.select("kept", "t", word_array(F.col("t")).alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "kept",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.expr("if(size(words) >= 8, transform(sequence(1, size(words) - 7), i -> xxhash64(slice(words, i, 8))), array())").cast("array<bigint>").alias("windows"),
    )
    rows = rows.select(
        "kept", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("if(size(array_distinct(windows)) < size(windows), array_sort(transform(windows, (h, i) -> struct(h, i))), null)").alias("sorted"),
    )
    again = "transform(filter(sorted, (x, k) -> get(sorted, k - 1).h <=> x.h or get(sorted, k + 1).h <=> x.h), x -> x.i)"
    rows = rows.select("kept", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.expr(f"array_sort({again})").alias("at"))
    covered = F.expr("aggregate(transform(at, (x, k) -> least(8, coalesce(get(at, k + 1) - x, 8))), 0L, (a, x) -> a + x)")
    rows = rows.select("kept", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("kept.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


def _vector(p: Params) -> list[Column]:
    per = lambda c: F.log1p(100.0 * F.col(c) / (F.col("n_words") + p.shrink))
    values = [F.log(F.col("word_chars") / F.col("n_words")), per("n_symbols"), per("n_dup_lines"), per("n_repeat_words")]
    return [F.round(v * UNIT).alias(f"x{j}") for j, v in enumerate(values)]


def _group(name: str) -> Column:
    """A key in which null is a group of its own."""
    return F.when(F.col(name).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(name).cast("string")))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution in the Cholesky factor l00, l10, ... of a group."""
    solved: list[Column] = []
    for j in range(DIMENSIONS):
        y = F.col(f"x{j}") - F.col(f"m{j}")
        for k in range(j):
            y = y - F.col(f"l{j}{k}") * solved[k]
        solved.append(y / F.col(f"l{j}{j}"))
    return sum((y * y for y in solved[1:]), solved[0] * solved[0])


MOMENTS = [(j, k) for j in range(DIMENSIONS) for k in range(j + 1)]


def _bound(value: Column, then) -> Column:
    """then(value), with the value computed once, however often it occurs there."""
    return F.transform(F.array(value), then)[0]


def _factor(p: Params, whole: float, known: tuple[Column, ...] = ()) -> Column:
    """The Cholesky factor, in the order of MOMENTS, of the second moments q00, q10, ... around the centre m0, ..."""
    if len(known) == len(MOMENTS):
        return F.array(*known)
    j, k = MOMENTS[len(known)]
    value = whole * (F.col(f"q{j}{k}") - F.col(f"m{j}") * F.col(f"m{k}"))
    if j == k:
        floor = (p.floors[j] * UNIT) ** 2
        value = F.greatest(value, F.lit(floor)) + floor / 400
    at = lambda a, b: known[MOMENTS.index((a, b))]
    for i in range(k):
        value = value - at(j, i) * at(k, i)
    return _bound(F.sqrt(value) if j == k else value / at(k, k), lambda x: _factor(p, whole, (*known, x)))


def _estimate(classes: DataFrame, p: Params, whole: float) -> DataFrame:
    """Centre, Cholesky factor and its determinant of each group and start, from the moments of its nearest classes.

    Variances under a floor are raised to it. A small part of each floor is added to all, so that the factor exists.
    """
    order = W.partitionBy("g", "s").orderBy("class")
    ranked = classes.withColumn("before", F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("all", F.sum("n").over(W.partitionBy("g", "s")))
    part = F.least(F.lit(1.0), (F.ceil(p.coverage * F.col("all")) - F.col("before")) / F.col("n"))
    near = ranked.withColumn("part", part).where("part > 0")
    total = lambda c: F.sum(F.col("part") * F.col(c)).alias(c)
    sums = near.groupBy("g", "s").agg(F.max("all").alias("size"), total("n"), *(total(f"s{j}") for j in range(DIMENSIONS)), *(total(f"s{j}{k}") for j, k in MOMENTS))
    sums = sums.select("g", "s", "size", *((F.col(f"s{j}") / F.col("n")).alias(f"m{j}") for j in range(DIMENSIONS)), *((F.col(f"s{j}{k}") / F.col("n")).alias(f"q{j}{k}") for j, k in MOMENTS))
    sums = sums.withColumn("factor", _factor(p, whole))
    sums = sums.select("g", "s", "size", *(f"m{j}" for j in range(DIMENSIONS)), *(F.col("factor")[i].alias(f"l{j}{k}") for i, (j, k) in enumerate(MOMENTS)))
    det = sum((F.log(f"l{j}{j}") for j in range(1, DIMENSIONS)), F.log("l00"))
    return sums.select("g", "s", "size", *(f"m{j}" for j in range(DIMENSIONS)), *(f"l{j}{k}" for j, k in MOMENTS), det.alias("det"))


def _best(fit: DataFrame, p: Params) -> DataFrame:
    """The estimate of smallest determinant of each group in fit (g, x0, ...)."""
    h = chi2_quantile(p.coverage, DIMENSIONS)
    whole = p.coverage / chi2(h, DIMENSIONS + 2)
    places = range(DIMENSIONS)
    middle = stored(_medians(fit), "medians")
    off = [F.col(f"x{j}") - F.col(f"m{j}") for j in places]
    spread = _medians(fit.join(middle, "g").select("g", *(F.abs(off[j]).alias(f"x{j}") for j in places)))
    start = stored(middle.join(spread.select("g", *(F.col(f"m{j}").alias(f"d{j}") for j in places)), "g"), "starts")
    floor = [p.floors[j] * UNIT for j in places]
    by_floor = [(off[j] / floor[j]) ** 2 for j in places]
    by_spread = [(off[j] / F.greatest(F.lit(floor[j]), 1.4826 * F.col(f"d{j}"))) ** 2 for j in places]
    ways = [sum(by_floor[1:], by_floor[0]), sum(by_spread[1:], by_spread[0]), F.greatest(*by_spread)]
    placed = fit.join(start, "g").select("g", *(f"x{j}" for j in places), F.posexplode(F.array(*ways)).alias("s", "distance"))
    best = stored(_estimate(_classes(placed, F.col("distance")), p, whole), "estimate")
    for _ in range(p.steps):
        new = _estimate(_classes(fit.join(best, "g"), _distance()), p, whole)
        both = new.alias("b").join(best.select("g", "s", F.col("det").alias("old")), ["g", "s"])
        better = stored(both.where("det < old - 1e-9").select(*best.columns), "better")
        if better.isEmpty():
            break
        last, best = best, stored(best.join(better.select("g", "s"), ["g", "s"], "left_anti").unionByName(better), "estimate")
        discard(last, better)
    first = W.partitionBy("g").orderBy("det", "s")
    return best.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place", "s")


def _classes(rows: DataFrame, distance: Column) -> DataFrame:
    """Counts and moments by group, start and class of distance."""
    return rows.groupBy("g", "s", F.floor(F.log1p(distance) * 64).alias("class")).agg(F.count("*").alias("n"), *(F.sum(f"x{j}").alias(f"s{j}") for j in range(DIMENSIONS)), *(F.sum(F.col(f"x{j}") * F.col(f"x{k}")).alias(f"s{j}{k}") for j, k in MOMENTS))


def _medians(rows: DataFrame) -> DataFrame:
    """Exact medians of each coordinate, from how often each of its values occurs."""
    long = rows.select("g", F.explode(F.array(*(F.struct(F.lit(j).alias("j"), F.col(f"x{j}").alias("x")) for j in range(DIMENSIONS)))).alias("c")).groupBy("g", "c.j", "c.x").count()
    w = W.partitionBy("g", "j")
    cumulative = long.withColumn("to", F.sum("count").over(w.orderBy("x"))).withColumn("all", F.sum("count").over(w))
    middle = cumulative.where("2 * to >= all").groupBy("g", "j").agg(F.min("x").alias("x"))
    return middle.groupBy("g").agg(*(F.max(F.when(F.col("j") == j, F.col("x"))).alias(f"m{j}") for j in range(DIMENSIONS)))


def judge(docs: DataFrame, p: Params = Params(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """base_statistics() of each row with distance (squared Mahalanobis, null where not judged) and kept.

    Uses text, lang and source; other columns matter only where named in keep. A null or blank text has no words and
    fails the base rules; a null lang or source is a group of its own. Groups of fewer than p.least_group documents that
    pass the base rules are judged by the estimate of their language, or, where that is too small as well, of all;
    with fewer than p.least_all documents all that pass are kept. Rows are neither merged nor dropped; equal rows get
    equal verdicts. A kept column that is named like one of the new ones is returned as kept_ and its name.
    """
    inner = docs.select(*(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)), _group("lang").alias("lang_key"), _group("source").alias("source_key"), "text")
    names = [f"kept_{i}" for i in range(len(keep))]
    levels = [F.concat_ws("\0", "lang_key", "source_key"), F.concat(F.lit("\1"), "lang_key"), F.lit("\2")]
    rows = stored(base_statistics(inner.withColumns({f"g{i}": g for i, g in enumerate(levels)}), [*names, "g0", "g1", "g2"]), "statistics")
    passed = rows.where("not base_failed").select("g0", "g1", "g2", *_vector(p))
    sizes = stored(passed.groupBy("g0", "g1").agg(F.count("*").alias("n0")), "sizes")
    sizes = sizes.withColumn("n1", F.sum("n0").over(W.partitionBy("g1")))
    own = F.when(F.col("n0") >= p.least_group, F.col("g0")).when(F.col("n1") >= p.least_group, F.col("g1")).otherwise(F.lit("\2"))
    owner = stored(sizes.select("g0", own.alias("g")), "owners")
    every = F.array("g0", "g1", "g2")
    fit = passed.select(F.explode(every).alias("g"), *(f"x{j}" for j in range(DIMENSIONS))).join(owner.select("g").distinct(), "g", "left_semi")
    fit = stored(fit, "vectors")
    best = stored(_best(fit, p), "best")
    discard(fit)
    cut = chi2_quantile(1 - p.false_rate, DIMENSIONS)
    judged = rows.select("*", *(F.when(~F.col("base_failed"), v).alias(f"x{j}") for j, v in enumerate(_vector(p)))).join(owner, "g0", "left").join(best, "g", "left")
    distance = F.when(~F.col("base_failed") & (F.col("size") >= p.least_all), _distance())
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = judged.select(*(F.col(n).alias(f"kept_{c}" if c in (*new, "distance", "kept") else c) for n, c in zip(names, keep, strict=True)), *new, distance.alias("distance"))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True)))
