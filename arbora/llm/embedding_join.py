"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are projected on the leading principal axes and sorted by label and grid cell, cells being as wide as the
largest distance of a link. The sorted sequence is cut into blocks with bounding boxes, and consecutive blocks travel
together as tiles. Pairs of sequence intervals are split again and again from the whole sequence down to tiles and, in
tasks, to blocks; pairs whose boxes are provably farther apart than a link are dropped on the way. The remaining pairs
of blocks are compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.components import connected
from arbora.llm.text import signed
from arbora.llm.workspace import stored


@dataclass(frozen=True)
class Params:
    """cosine: least of a link. axes: of the grid. block: vectors in a block. tile: bytes of vectors, in double precision,
    that make a tile. sample: vectors that place the axes, which decide what is skipped and never what is found. fan:
    parts into which an interval is split. partners: successive tiles that one task group compares a tile with. spread:
    vectors that share a task while they are sorted."""

    cosine: float = 0.93
    axes: int = 8
    block: int = 512
    tile: int = 2_000_000
    sample: int = 20_000
    fan: int = 8
    partners: int = 4
    spread: int = 20_000

    def vectors(self, dim: int) -> int:
        """Vectors of a tile: whole blocks, one at least."""
        return max(1, self.tile // (8 * dim * self.block)) * self.block


def _vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, h1, h2, vector) of the rows that can link; vector holds float64 components."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            column = part.column("embedding")
            flat, ends = column.values, column.offsets.to_numpy()
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            out: list[list] = [[] for _ in range(6)]
            for k, (vec, label, ok) in enumerate(zip(part.column("vec_id").to_pylist(), part.column("label").to_pylist(), column.is_valid().to_pylist(), strict=True)):
                x = values[ends[k] : ends[k + 1]]  # null components are NaN here
                if vec is None or label is None or not ok or not len(x) or not np.isfinite(x).all() or not x.any():
                    continue
                body = x.tobytes()
                h = xxhash.xxh3_128_intdigest(body)
                for o, v in zip(out, (vec, label, len(x), h >> 64, h & (2**64 - 1), body), strict=True):
                    o.append(v)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()), *(pa.array(signed(np.array(o, np.uint64))) for o in out[3:5]), pa.array(out[5], pa.binary())], names=["vec_id", "label", "dim", "h1", "h2", "vector"])

    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return rows.mapInArrow(run, "vec_id long, label string, dim int, h1 long, h2 long, vector binary")


def _axes(vectors: DataFrame, n: int, p: Params) -> dict[int, np.ndarray]:
    """Principal axes for each dimension that occurs in the sample; the first coordinates serve elsewhere."""
    taken = vectors.where(F.pmod("h1", F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, p.sample / max(n, 1)))).select("dim", "vector").toPandas()
    found = {}
    for dim, own in taken.groupby("dim"):
        x = unit(own["vector"].tolist(), int(dim))
        found[int(dim)] = np.linalg.eigh(x.T @ x / len(x) - np.outer(x.mean(0), x.mean(0)))[1][:, ::-1][:, : p.axes]
    return found


def unit(vectors: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), float).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


BLOCKS = "part int, seq int, label string, dim int, lo array<double>, hi array<double>, ids array<long>, times array<long>, single boolean, leaves binary, vectors binary"
BODY = ("dim", "ids", "times", "single", "leaves", "vectors")


def _blocks(reps: DataFrame, p: Params) -> DataFrame:
    """The representatives in epsilon grid order, cut into tiles of one label and dimension.

    leaves holds the corners of the boxes of a tile's blocks. single: whether the vectors are stored in single precision,
    which they are where that changes none of them.
    """
    n = reps.count()
    axes = reps.sparkSession.sparkContext.broadcast(_axes(reps, n, p))
    width = math.sqrt(2 - 2 * p.cosine)

    def project(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            dims, bodies = part.column("dim").to_numpy(), part.column("vector").to_pylist()
            at = [None] * len(bodies)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                x = unit([bodies[i] for i in own], int(dim))
                a = axes.value.get(int(dim))
                spots = x @ a if a is not None else x[:, : p.axes]
                for i, v in zip(own, np.pad(spots, ((0, 0), (0, p.axes - spots.shape[1]))), strict=True):
                    at[i] = v.tolist()
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(at, pa.list_(pa.float64()))], names=[*part.schema.names, "at"])

    placed = reps.select("label", "dim", "rep", "times", "vector").mapInArrow(project, "label string, dim int, rep long, times long, vector binary, at array<double>")
    cells = [F.floor(F.col("at")[k] / width).alias(f"cell{k}") for k in range(p.axes)]
    order = ["label", "dim", *(f"cell{k}" for k in range(p.axes)), "rep"]
    ordered = placed.select("*", *cells).repartitionByRange(max(8, n // p.spread), *order).sortWithinPartitions(*order).select("label", "dim", "rep", "times", "vector", "at")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seq, held, kind = TaskContext.get().partitionId(), 0, [], None

        def block():
            nonlocal seq
            at = np.array([r[3] for r in held])
            starts = np.arange(0, len(held), p.block)
            leaves = np.stack([np.minimum.reduceat(at, starts), np.maximum.reduceat(at, starts)])
            x = np.frombuffer(b"".join(r[2] for r in held), float)
            with np.errstate(all="ignore"):
                short = x.astype(np.float32)
            single = bool((short == x).all())
            row = (number, seq, *kind, at.min(0).tolist(), at.max(0).tolist(), [r[0] for r in held], [r[1] for r in held], single, leaves.tobytes(), (short if single else x).tobytes())
            seq += 1
            types = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_(), pa.binary(), pa.binary())
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=["part", "seq", "label", "dim", "lo", "hi", "ids", "times", "single", "leaves", "vectors"])

        for part in parts:
            for label, dim, *row in zip(*(part.column(c).to_pylist() for c in ("label", "dim", "rep", "times", "vector", "at")), strict=True):
                if held and ((label, dim) != kind or len(held) == p.vectors(dim)):
                    yield block()
                    held = []
                kind = (label, dim)
                held.append(row)
        if held:
            yield block()

    return ordered.mapInArrow(cut, BLOCKS)


NEAR = "aggregate(transform(sequence(0, size(a.lo) - 1), k -> greatest(0D, a.lo[k] - b.hi[k], b.lo[k] - a.hi[k])), 0D, (s, g) -> s + g * g) <= {}D"


def _near_pairs(blocks: DataFrame, p: Params) -> DataFrame:
    """(i, j) of the tiles that may hold a link, found from the whole sequence downwards; each is paired with itself."""
    limit = 2 - 2 * p.cosine + 1e-9
    nodes = blocks.select("node", F.struct("label", "dim").alias("first"), F.struct("label", "dim").alias("last"), "lo", "hi")
    levels, n = [nodes], nodes.count()
    box = lambda f, c: F.array(*(f(F.col(c)[k]) for k in range(p.axes))).alias(c)
    while n > 1:
        up = levels[-1].groupBy(F.floor(F.col("node") / p.fan).alias("node")).agg(F.min("first").alias("first"), F.max("last").alias("last"), box(F.min, "lo"), box(F.max, "hi"))
        levels.append(stored(up, "intervals"))
        n = -(-n // p.fan)
    pairs = levels[-1].select(F.col("node").alias("i"), F.col("node").alias("j"))
    for below in reversed(levels[:-1]):
        child = below.withColumn("up", F.floor(F.col("node") / p.fan))
        a, b = child.alias("a"), child.alias("b")
        pairs = pairs.join(a, F.col("i") == F.col("a.up")).join(b, F.col("j") == F.col("b.up")).where("a.node <= b.node and a.first <= b.last and b.first <= a.last").where(NEAR.format(repr(limit)))
        pairs = stored(pairs.select(F.col("a.node").alias("i"), F.col("b.node").alias("j")), "pairs")
    return pairs


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def compare(x: np.ndarray, y: np.ndarray, ids_x: np.ndarray, ids_y: np.ndarray, times_x: np.ndarray, times_y: np.ndarray, p: Params, same: bool) -> tuple[np.ndarray, ...]:
    """(a, b, n): a vector, the smallest id that it reaches within these two blocks, and how many rows it links with."""
    links = x @ y.T >= p.cosine
    if same:
        np.fill_diagonal(links, False)
    rows, cols = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
    links = links[np.ix_(rows, cols)]
    left, right = ids_x[rows], ids_y[cols]
    n_left, n_right = links @ times_y[cols], times_x[rows] @ links
    reach, over, big = left.copy(), right.copy(), np.iinfo(np.int64).max
    while len(rows):
        new = np.minimum(reach, np.where(links, over, big).min(1))
        far = np.minimum(over, np.where(links.T, new, big).min(1))
        if (new == reach).all() and (far == over).all():
            break
        reach, over = new, far
    if same:
        return left, reach, n_left
    return np.concatenate([left, right]), np.concatenate([reach, over]), np.concatenate([n_left, n_right])


@dataclass
class Tile:
    x: np.ndarray
    ids: np.ndarray
    times: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    @classmethod
    def of(cls, row: dict, p: Params) -> Tile:
        x = np.frombuffer(row["vectors"], np.float32 if row["single"] else float).astype(float)
        lo, hi = np.frombuffer(row["leaves"], float).reshape(2, -1, p.axes)
        return cls(unit([x.tobytes()], row["dim"]), np.array(row["ids"], np.int64), np.array(row["times"], np.int64), lo, hi)

    def meet(self, other: Tile, p: Params) -> Iterator[tuple[np.ndarray, ...]]:
        """What compare() finds in each pair of near blocks of two tiles, or of one with itself."""
        gap = np.maximum(0, np.maximum(self.lo[:, None] - other.hi, other.lo - self.hi[:, None]))
        near = (gap**2).sum(2) <= 2 - 2 * p.cosine + 1e-9
        for s, t in np.argwhere(np.triu(near) if self is other else near):
            a, b = (slice(k * p.block, (k + 1) * p.block) for k in (s, t))
            found = compare(self.x[a], other.x[b], self.ids[a], other.ids[b], self.times[a], other.times[b], p, self is other and s == t)
            if len(found[0]):
                yield found


def near_duplicates(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding, label); other columns are ignored.

    Vectors link when their labels are equal and not null, their dimensions are equal and their cosine is at least
    p.cosine. A vector that is null, empty, zero or has null or non-finite components links with nothing, nor does one
    without an id, whose component is null. Equal vectors are compared once and count as often as they occur. Of no
    rows, none.
    """
    vectors = stored(_vectors(rows), "vectors")
    kind = ["label", "dim", "h1", "h2"]
    classes = stored(vectors.groupBy(*kind).agg(F.min("vec_id").alias("rep"), F.count("*").alias("times")), "classes")
    reps = vectors.join(classes, [*kind]).where("vec_id = rep").dropDuplicates(kind).select("label", "dim", "h1", "rep", "times", "vector")
    blocks = stored(_blocks(stored(reps, "representatives"), p), "blocks")
    offset, offsets = 0, []
    for part, n in sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.count("*").alias("n")).collect()):  # a row per partition
        offsets.append((part, offset))
        offset += n
    numbers = rows.sparkSession.createDataFrame(offsets, "part int, begin long")
    blocks = blocks.join(numbers, "part").withColumn("node", F.col("begin") + F.col("seq"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, chunk = (k.as_py() for k in key)
        nodes = table.column("node").to_pylist()
        own = Tile.of(table.slice(nodes.index(i), 1).to_pylist()[0], p)
        found = list(own.meet(own, p)) if i // p.partners == chunk else []
        for k, node in enumerate(nodes):
            if node != i:
                found += own.meet(Tile.of(table.slice(k, 1).to_pylist()[0], p), p)
        return pa.Table.from_batches([pa.record_batch([pa.array(v) for v in f], schema=LINKS) for f in found], LINKS)

    # a group brings its tile once, and once each of the few tiles after it that it meets
    pairs = _near_pairs(blocks, p).withColumn("chunk", F.floor(F.col("j") / p.partners))
    groups = stored(pairs.select("i", "chunk").distinct(), "groups")
    n = groups.count()
    wanted = groups.withColumn("node", F.col("i")).unionByName(pairs.where("i < j").select("i", "chunk", F.col("j").alias("node")))
    met = wanted.join(blocks.select("node", *BODY), "node").repartition(max(1, min(n, 2000) + n // 16), "i", "chunk")
    links = stored(met.groupBy("i", "chunk").applyInArrow(run, "a long, b long, n long"), "links")
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    parts_of = connected(links)
    known = classes.join(counts, "rep", "left").join(parts_of, F.col("rep") == F.col("node"), "left")
    known = known.select(*kind, (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    able = vectors.drop("vector").join(known, kind).select("vec_id", "n", "component")
    able = able.groupBy("vec_id").agg(F.max("n").alias("n"), F.min("component").alias("component"))
    out = rows.select(F.col("vec_id").cast("long").alias("vec_id")).join(able, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
