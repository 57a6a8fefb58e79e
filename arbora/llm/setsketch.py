"""Near-duplicate documents by SetSketch registers.

A register keeps the minimum of an exponential variate over a document's shingles on a logarithmic scale of base b,
cut off at both ends, so sketches of parts merge by the elementwise maximum. Bands of registers propose pairs; the
Jaccard similarity of a pair is estimated by maximum likelihood from how many registers are larger, smaller and
equal; pairs that may reach the threshold are confirmed on their full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.components import SALTS, connected
from arbora.llm.text import few, hashed, mix, signed, split_words, tidy
from arbora.llm.workspace import discard, stored


@dataclass(frozen=True)
class Params:
    """words: of a shingle. percent: links need 100 * intersection >= percent * union.

    registers, band: a pair at similarity 0.8 shares none of its 32 bands once in 2e7. slack: how far below the
    threshold an estimate still leads to a check, five standard errors. small: members of a bucket whose pairs are
    looked at one by one; larger ones are compared in blocks of about `block` documents and `volume` shingles.
    """

    words: int = 5
    percent: int = 80
    registers: int = 128
    band: int = 4
    base: float = 1.001
    rate: float = 20.0
    slack: float = 0.18
    small: int = 64
    block: int = 512
    volume: int = 1_000_000
    seed: int = 20240517


TOP = 65535


class Sketcher:
    def __init__(self, p: Params):
        self.p = p
        rng = np.random.default_rng(p.seed)
        self.mul = rng.integers(0, 2**63, p.registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 2**64, p.registers, dtype=np.uint64)

    def shingles(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The distinct shingles of each text as sorted 64-bit hashes."""
        words, index, sizes = split_words(column, folded=True)
        h = hashed(words)[index] if len(words) else np.empty(0, np.uint64)
        ends = np.cumsum(sizes)
        for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
            width = min(self.p.words, size)
            got = np.full(size - width + 1 if size else 0, width, np.uint64)
            for k in range(width):
                got = mix(got * np.uint64(0x9E3779B97F4A7C15) + h[end - size + k : end - width + 1 + k])
            yield np.unique(got)

    def registers(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(self.p.registers, 2**64 - 1, np.uint64)
        for at in range(0, len(shingles), 1024):
            np.minimum(least, (shingles[at : at + 1024, None] * self.mul + self.add).min(0), out=least)
        uniform = ((least >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
        with np.errstate(divide="ignore"):
            scale = 1 - np.log(-np.log1p(-uniform) / self.p.rate) / np.log(self.p.base)
        return np.clip(np.floor(scale), 0, TOP).astype(np.uint16) if len(shingles) else np.zeros(self.p.registers, np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def estimate(more: np.ndarray, less: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, base: float) -> np.ndarray:
    """Most likely Jaccard similarity, given how many registers of a are larger, smaller and equal, and both set sizes."""
    u = n_a / (n_a + n_b)
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    def slope(j):
        """Sign of the log-likelihood's derivative in j, which falls as j grows."""
        step = 1e-6
        a1, a2, b1, b2 = p(u - v * (j - step)), p(u - v * (j + step)), p(v - u * (j - step)), p(v - u * (j + step))
        tiny = 1e-12
        value = lambda x, y: more * np.log(x + tiny) + less * np.log(y + tiny) + equal * np.log(np.clip(1 - x - y, tiny, 1))
        return value(a2, b2) - value(a1, b1)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(18):
        mid = (low + high) / 2
        up = slope(mid) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


SKETCHES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig1", pa.int64()), ("sig2", pa.int64()), ("registers", pa.binary())])


def sketches(docs: DataFrame, p: Params) -> DataFrame:
    """(doc_id, n, sig1, sig2, registers) of each row of docs; equal sets have equal n, sig1 and sig2."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(p)
        for part in few(parts):
            n, one, two, regs = [], [], [], []
            for s in sketcher.shingles(part.column("text")):
                n.append(len(s))
                one.append(int(mix(s).sum(dtype=np.uint64)))
                two.append(int(mix(s ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)))
                regs.append(sketcher.registers(s).astype("<u2").tobytes())
            signs = [signed(np.array(x, np.uint64)) for x in (one, two)]
            yield pa.record_batch([part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), *map(pa.array, signs), pa.array(regs, pa.binary())], schema=SKETCHES)

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, n long, sig1 long, sig2 long, registers binary")


def _promising(pairs: DataFrame, reps: DataFrame, p: Params) -> DataFrame:
    """(a, b, est) of the pairs whose estimate may reach the threshold."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(part.num_rows, -1) for c in ("ra", "rb"))
            n_a, n_b = (part.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            est = estimate((x > y).sum(1), (x < y).sum(1), (x == y).sum(1), n_a, n_b, p.base)
            keep = np.flatnonzero(est >= p.percent / 100 - p.slack)
            yield pa.record_batch([part.column("a").take(pa.array(keep)), part.column("b").take(pa.array(keep)), pa.array(est[keep])], names=["a", "b", "est"])

    for side in "ab":
        pairs = pairs.join(reps.select(F.col("rep").alias(side), F.col("registers").alias(f"r{side}"), F.col("n").alias(f"n{side}")), side)
    return pairs.where("least(na, nb) * 100 >= greatest(na, nb) * %d" % p.percent).mapInArrow(run, "a long, b long, est double")


def _confirmed(pairs: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) that are linked by their full shingle sets."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(p)
        for part in few(few(parts, column="ta"), column="tb"):
            kept = []
            for k, (x, y) in enumerate(zip(sketcher.shingles(part.column("ta")), sketcher.shingles(part.column("tb")), strict=True)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= p.percent * (len(x) + len(y) - both):
                    kept.append(k)
            yield pa.record_batch([part.column(c).take(pa.array(kept, pa.int64())) for c in ("a", "b")], names=["a", "b"])

    texts = docs.select("doc_id", "text")
    for side in "ab":
        pairs = pairs.join(texts.select(F.col("doc_id").cast("long").alias(side), F.col("text").alias(f"t{side}")), side)
    return pairs.select("a", "b", "ta", "tb").mapInArrow(tidy(run), "a long, b long")


def _small_bucket_pairs(members: DataFrame, reps: DataFrame, p: Params) -> DataFrame:
    """Promising pairs of different components within buckets of at most p.small members.

    A pair that shares several bands is proposed by the first of them only.
    """

    def compare(group: pa.Table) -> pa.Table:
        n, part, rep = group.column("n").to_numpy().astype(float), group.column("part").to_numpy(), group.column("rep").to_numpy()
        regs = np.frombuffer(b"".join(group.column("registers").to_pylist()), "<u2").reshape(len(n), -1)
        i, j = np.triu_indices(len(n), 1)
        fit = (part[i] != part[j]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * p.percent)
        i, j = i[fit], j[fit]
        equal = regs[i] == regs[j]
        bands = equal[:, : p.registers // p.band * p.band].reshape(len(i), p.registers // p.band, p.band).all(2)
        first = bands.argmax(1) == group.column("band")[0].as_py() if len(i) else np.zeros(0, bool)
        i, j, equal = i[first], j[first], equal[first].sum(1)
        more = (regs[i] > regs[j]).sum(1)
        good = estimate(more, regs.shape[1] - equal - more, equal, n[i], n[j], p.base) >= p.percent / 100 - p.slack
        return pa.table([np.minimum(rep[i], rep[j])[good], np.maximum(rep[i], rep[j])[good]], names=["a", "b"])

    rows = members.where(F.col("bucket_n").between(3, p.small)).join(reps.select("rep", "n", "registers"), "rep")
    return rows.select("key", "band", "rep", "part", "n", "registers").groupBy("key").applyInArrow(compare, "a long, b long")


def _crowd_links(members: DataFrame, reps: DataFrame, docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """(rep, crowd) of the documents that larger buckets hold together, and links between components within a crowd.

    Of a crowd's components the largest needs no comparison within itself: all other members, the loose ones, are held
    against the whole crowd, block against block. Registers tell which documents of two blocks may be linked with one
    of another component; only those documents' full shingle sets travel, and are intersected by products of 0/1
    matrices. Of a pair of blocks only links that join two components become rows.
    """
    large = members.where(F.col("bucket_n") > p.small)
    crowds = connected(large.select(F.col("rep").alias("a"), F.col("lo").alias("b"))).select(F.col("node").alias("rep"), F.col("component").alias("crowd"))
    crowds = crowds.join(large.select("rep", "part").distinct(), "rep").join(reps.select("rep", "n", "registers"), "rep")
    crowds = stored(crowds, "crowds")
    bodies = crowds.groupBy("crowd", "part").agg(F.count("*").alias("size"), F.sum("n").alias("volume")).groupBy("crowd")
    bodies = bodies.agg(F.max_by("part", F.struct("size", "part")).alias("body"), F.sum("size").alias("size"), F.max("size").alias("own"), F.sum("volume").alias("volume"))
    blocks = lambda size, volume: F.greatest(F.ceil(size / p.block), F.ceil(volume / p.volume)).cast("int")
    bodies = bodies.withColumn("rows", blocks(F.col("size"), F.col("volume")))
    rest = (F.col("size") - F.col("own")) / F.col("size")
    bodies = bodies.withColumn("heads", F.greatest(F.lit(1), F.least("rows", F.ceil(F.col("rows") * rest).cast("int"))))
    # a large crowd's members meet its facts in several tasks
    facts = bodies.select("crowd", "body", "rows", "heads", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = crowds.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
    placed = salted.join(facts, ["crowd", "salt"]).withColumn("loose", F.col("part") != F.col("body"))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    columns = ["rep", "part", "loose", "n", "registers"]
    heads = placed.where("loose").select("crowd", *columns, own("heads").alias("i"), F.explode(F.expr("sequence(0, rows - 1)")).alias("j"), F.lit(True).alias("head"))
    tails = placed.select("crowd", *columns, F.explode(F.expr("sequence(0, heads - 1)")).alias("i"), own("rows").alias("j"), F.lit(False).alias("head"))

    def sides(group: pa.Table) -> tuple[np.ndarray, ...]:
        """Places of the heads and tails, and which of their pairs are to be looked at: a pair of loose ones once."""
        rep, part = group.column("rep").to_numpy(), group.column("part").to_numpy()
        loose, head = (group.column(c).to_numpy(zero_copy_only=False) for c in ("loose", "head"))
        left, right = np.flatnonzero(head), np.flatnonzero(~head)
        open_ = (part[left][:, None] != part[right]) & (~loose[right] | (rep[left][:, None] < rep[right]))
        return rep, part, left, right, open_

    def promising(group: pa.Table) -> pa.Table:
        rep, part, left, right, open_ = sides(group)
        n = group.column("n").to_numpy().astype(float)
        regs = np.frombuffer(b"".join(group.column("registers").to_pylist()), "<u2").reshape(len(n), -1)
        open_ &= np.minimum(n[left][:, None], n[right]) * 100 >= np.maximum(n[left][:, None], n[right]) * p.percent
        equal = np.zeros(open_.shape, np.uint16)
        for k in range(regs.shape[1]):
            equal += regs[left, k][:, None] == regs[right, k]
        x, y = np.nonzero(open_ & (equal >= (p.percent / 100 - 1.5 * p.slack) * regs.shape[1]))
        good = np.zeros(len(n), bool)
        for at in range(0, len(x), 20_000):
            i, j = left[x[at : at + 20_000]], right[y[at : at + 20_000]]
            more, same = (regs[i] > regs[j]).sum(1), equal[x[at : at + 20_000], y[at : at + 20_000]].astype(int)
            fine = estimate(more, regs.shape[1] - same - more, same, n[i], n[j], p.base) >= p.percent / 100 - p.slack
            good[i[fine]] = good[j[fine]] = True
        return group.filter(pa.array(good)).select(["crowd", "i", "j", "head", "rep", "part", "loose"])

    spots = "crowd long, i int, j int, head boolean, rep long, part long, loose boolean"
    asked = stored(heads.unionByName(tails).groupBy("crowd", "i", "j").applyInArrow(promising, spots), "asked")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(p)
        for part in few(batches):
            yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array([x.tobytes() for x in sketcher.shingles(part.column("text"))], pa.binary())], names=["rep", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    sets = stored(asked.select("rep").distinct().join(texts, "rep").mapInArrow(tidy(load), "rep long, shingles binary").dropDuplicates(["rep"]), "crowd_sets")

    def meet(group: pa.Table) -> pa.Table:
        rep, part, left, right, open_ = sides(group)
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        root = {int(x): int(x) for x in part}
        out: list[tuple[int, int]] = []

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        found = links_between(sets, left, right, p) if len(left) and len(right) else open_
        for x, y in zip(*np.nonzero(found & open_), strict=True):
            i, j = int(left[x]), int(right[y])
            a, b = find(int(part[i])), find(int(part[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(rep[i]), int(rep[j])))
        return pa.table([pa.array([min(x) for x in out], pa.int64()), pa.array([max(x) for x in out], pa.int64())], names=["a", "b"])

    links = stored(asked.join(sets, "rep").groupBy("crowd", "i", "j").applyInArrow(meet, "a long, b long"), "crowd_links")
    discard(asked, sets)
    return crowds, links


def links_between(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, p: Params, columns: int = 4096) -> np.ndarray:
    """Which documents of left and right are linked by their full sets."""
    size = np.array([len(x) for x in sets])
    known, index = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(index, kind="stable")
    index, owner = index[order], owner[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(known), columns):
        a, b = np.searchsorted(index, [at, at + columns])
        here = np.zeros((len(sets), min(columns, len(known) - at)), np.float32)
        here[owner[a:b], index[a:b] - at] = 1
        both += here[left] @ here[right].T
    union = size[left][:, None] + size[right][None, :] - both
    return (100 * both >= p.percent * union) & (both > 0)


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs: one document of each component is kept.

    docs has doc_id and text; other columns are ignored. A document with fewer words than a shingle has its whole
    sequence as its one shingle; without words it has none and links with nothing. Documents with equal sets form one
    class, and only its smallest id is compared with others. Rows with the same doc_id are one document, linked where
    any of them is, even those without words; a null doc_id links with nothing, has a null component and is kept. Of no rows, none.
    """
    sk = stored(sketches(docs, p), "sketches")
    filled = sk.where("n > 0 and doc_id is not null")
    same = ["n", "sig1", "sig2"]
    classes = stored(filled.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    reps = stored(filled.withColumnRenamed("doc_id", "rep").join(classes, [*same, "rep"]).dropDuplicates([*same, "rep"]).select("rep", "n", "registers"), "reps")
    width = 2 * p.band
    keys = F.expr(f"transform(sequence(0, {p.registers // p.band - 1}), i -> xxhash64(i, substring(registers, i * {width} + 1, {width})))")
    banded = reps.select("rep", F.posexplode(keys).alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("bucket_n"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("bucket_n > 1 and lo <> hi")
    members = stored(banded.join(buckets, "key"), "members")
    pivot = F.explode(F.array("lo", "hi")).alias("pivot")
    pairs = members.select("rep", pivot).where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    hopeful = stored(_promising(pairs, reps, p), "hopeful")
    # first each document's most similar partner, then whatever lies between the components that remain
    either = hopeful.select("a", "b", "est", F.explode(F.array("a", "b")).alias("end"))
    best = either.groupBy("end").agg(F.max(F.struct("est", F.negate("a").alias("na"), F.negate("b").alias("nb"))).alias("x"))
    best = stored(best.select((-F.col("x.na")).alias("a"), (-F.col("x.nb")).alias("b")).distinct(), "best")
    linked = stored(_confirmed(best, docs, p), "linked")
    parts_of = stored(connected(linked), "parts")
    placed = members.join(parts_of, F.col("rep") == F.col("node"), "left").withColumn("part", F.coalesce("component", "rep"))
    placed = stored(placed.select("key", "band", "rep", "bucket_n", members["lo"], "part"), "placed")
    split = placed.groupBy("key").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most").select("key")
    open_ = stored(placed.join(split, "key"), "split_buckets")
    discard(members, placed)
    crowds, crowd_links = _crowd_links(open_, reps, docs, p)
    rest = hopeful.select("a", "b").union(_small_bucket_pairs(open_, reps, p)).distinct()
    rest = rest.join(best, ["a", "b"], "left_anti")
    for side in "ab":
        rest = rest.join(parts_of.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
        rest = rest.join(crowds.select(F.col("rep").alias(side), F.col("crowd").alias(f"d{side}")), side, "left")
    rest = stored(rest.where("coalesce(ca, a) <> coalesce(cb, b) and not coalesce(da = db, false)").select("a", "b"), "rest")
    discard(open_, crowds, hopeful, reps, parts_of)
    # different texts under one id are one document
    named = filled.select("doc_id", *same).join(classes, same).select("doc_id", "rep").distinct()
    several = named.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("doc_id")
    ids = named.join(several, "doc_id").select("doc_id", "rep")
    every = stored(linked.union(_confirmed(rest, docs, p)).union(crowd_links).union(ids), "all_links")
    final = connected(every)
    discard(every, rest, best, linked, crowd_links)
    named = classes.join(final, F.col("rep") == F.col("node"), "left").select(*same, F.coalesce("component", "rep").alias("class_component"))
    out = sk.drop("registers").join(named, same, "left")
    # rows that share an id share a component, those without words too
    bare = sk.where("coalesce(n, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    beside = filled.join(bare, "doc_id", "left_semi").join(named, same).groupBy("doc_id").agg(F.min("class_component").alias("beside"))
    out = out.join(beside, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("class_component")), "beside", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
