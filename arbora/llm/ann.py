"""Nearest neighbours by few stable projections, a kd-tree over them, and a chi-square stopping test.

Largest inner products are smallest distances once every vector has one more component that brings it to the length of
the longest, and a query has a zero there. Components of a normal (2-stable) projection of a difference are normal with
the distance as deviation, so projected over true squared distance is chi-square distributed with as many degrees of
freedom as there are projections. A query therefore takes its projected neighbours in order of distance, verifies them
against the original vectors, and stops once what comes next is so far off that a vector as near as the worst of those
that it has would be there with probability 1 - confidence at most.

The upper levels of the kd-tree are fitted on a bounded sample and cut the vectors into cells; each cell is a task's group
and carries the lower levels, down to leaves, in its own order. Queries are vectors as well: those of a cell travel
together. A block of queries first searches its own cell, which bounds what the other cells have to offer; then it goes,
without the queries whose test already holds, to the cells that remain. Equal vectors are searched for once, and of more
than k + 1 equal ones only the smallest ids can be among the nearest of anything.
"""

from __future__ import annotations

import functools
import math
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbora.llm.workspace import discard, stored


@dataclass(frozen=True)
class Params:
    """k: neighbours of each query. confidence: of the stopping test. dims: projections. cell: vectors of a cell.

    cells: where there would be more, cells are larger, so that fewer copies of queries and cells travel, up to `room`
    components each. sample: vectors that the upper kd-tree is fitted on, at most; it has at most a cell for 64 of them.
    leaf: vectors of a leaf. block: queries of a block. share: queries whose results meet in one group. reach: blocks that
    share one copy of a cell, at least; as many queries as a cell has vectors may.
    """

    k: int = 20
    confidence: float = 0.95
    dims: int = 8
    cell: int = 4096
    cells: int = 64
    room: int = 1 << 21
    leaf: int = 64
    sample: int = 65_536
    block: int = 256
    share: int = 32
    reach: int = 8
    seed: int = 12


def chi_square(x: float, dims: int) -> float:
    """Distribution function of the chi-square distribution, by the series of the incomplete gamma function."""
    a, z = dims / 2, x / 2
    term = total = math.exp(a * math.log(z) - z - math.lgamma(a + 1)) if z > 0 else 0.0
    n = a
    while term > 1e-17 * total:
        n += 1
        term *= z / n
        total += term
    return total


@functools.lru_cache(8)
def chi_square_quantile(share: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, dims) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dims) < share else (low, middle)
    return high


@dataclass(frozen=True)
class Space:
    """The projection of vectors of up to `width` components, whose greatest squared length is `most`."""

    width: int
    most: float
    dims: int
    seed: int

    @functools.cached_property
    def matrix(self) -> np.ndarray:
        return np.random.default_rng(self.seed).standard_normal((self.width + 1, self.dims))

    def points(self, x: np.ndarray) -> np.ndarray:
        return x @ self.matrix[:-1] + np.sqrt(np.maximum(self.most - (x * x).sum(1), 0))[:, None] * self.matrix[-1]

    def queries(self, x: np.ndarray) -> np.ndarray:
        return x @ self.matrix[:-1]

    def distance(self, x: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distance of queries to vectors with which they have these inner products."""
        return np.maximum((x * x).sum(1) + self.most - 2 * score, 0)


def kd_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """An order in which each `leaf` rows are a leaf of a kd-tree: halves by the widest dimension, cut at whole leaves."""
    order, todo = np.arange(len(points)), [(0, len(points))]
    while todo:
        a, b = todo.pop()
        if b - a <= leaf:
            continue
        own = points[order[a:b]]
        middle = max(1, round((b - a) / 2 / leaf)) * leaf
        if middle >= b - a:
            middle = leaf
        axis = int(np.argmax(np.ptp(own, axis=0)))
        order[a:b] = order[a:b][np.argpartition(own[:, axis], middle - 1)]
        todo += [(a, a + middle), (a + middle, b)]
    return order


@dataclass(frozen=True)
class Tree:
    """The upper levels: inner node i has children 2i + 1 and 2i + 2, and cuts at `cut` along `axis`."""

    depth: int
    axis: np.ndarray
    cut: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, cells: int) -> Tree:
        depth = max(0, math.ceil(math.log2(max(cells, 1))))
        axis, cut = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
        rows = {0: sample}
        for i in range(len(axis)):
            own = rows.pop(i)
            if len(own):
                axis[i] = np.argmax(np.ptp(own, axis=0))
                cut[i] = np.median(own[:, axis[i]])
            left = own[:, axis[i]] < cut[i]
            rows[2 * i + 1], rows[2 * i + 2] = own[left], own[~left]
        return cls(depth, axis, cut)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.cut[node])
        return node - len(self.axis)


def boxes(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, len(points), leaf)
    return np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)


def box_distance(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared projected distance of each query to each box."""
    out = np.zeros((len(queries), len(low)))
    for k in range(queries.shape[1]):
        x = queries[:, k : k + 1]
        out += np.maximum(np.maximum(low[:, k] - x, x - high[:, k]), 0) ** 2
    return out


@dataclass
class Best:
    """The best `keep` of each query so far: inner products from the greatest, ties by id. Missing ones are -inf."""

    score: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls, queries: int, keep: int) -> Best:
        return cls(np.full((queries, keep), -np.inf), np.full((queries, keep), np.iinfo(np.int64).max))

    def take(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = score.max(1) >= self.score[rows, -1]
        rows, score, ids = rows[better], score[better], ids[better]
        score, ids = np.concatenate([self.score[rows], score], 1), np.concatenate([self.ids[rows], ids], 1)
        order = np.lexsort((ids, -score), axis=1)[:, : self.score.shape[1]]
        self.score[rows], self.ids[rows] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


class Cell:
    """Vectors in kd_order(), by leaves, to be searched by many queries."""

    def __init__(self, space: Space, vectors: np.ndarray, ids: np.ndarray, p: Params):
        self.space, self.p = space, p
        self.low, self.high = boxes(space.points(vectors), p.leaf)
        short = -len(vectors) % p.leaf
        self.vectors = np.concatenate([vectors, np.zeros((short, vectors.shape[1]))]).reshape(-1, p.leaf, vectors.shape[1])
        self.ids = np.concatenate([ids, np.full(short, np.iinfo(np.int64).max)]).reshape(-1, p.leaf)
        self.real = (np.arange(len(vectors) + short) < len(vectors)).reshape(-1, p.leaf)

    def search(self, queries: np.ndarray, bound: np.ndarray) -> Best:
        """The best of the cell for each query, as far as they are at least as good as the query's bound."""
        most = max(1, (1 << 20) // len(self.low))  # so that a table of queries and leaves stays small
        parts = [self._some(queries[i : i + most], bound[i : i + most]) for i in range(0, len(queries), most)]
        return Best(*(np.concatenate([getattr(x, c) for x in parts]) for c in ("score", "ids"))) if parts else Best.none(0, self.p.k + 1)

    def _some(self, queries: np.ndarray, bound: np.ndarray) -> Best:
        """search(). Each query takes the leaves from the nearest on until the stopping test holds."""
        p, space, limit = self.p, self.space, chi_square_quantile(self.p.confidence, self.space.dims)
        best = Best.none(len(queries), p.k + 1)
        far = box_distance(space.queries(queries), self.low, self.high)
        order = np.argsort(far, axis=1, kind="stable")
        squares = (queries * queries).sum(1)
        slack = space.width * 1e-15 * np.sqrt(squares * space.most)  # by which a matrix product may be off
        active = np.arange(len(queries))
        for turn in range(order.shape[1]):
            leaf, least = order[active, turn], np.maximum(best.score[active, -1], bound[active])
            goes = far[active, leaf] <= limit * np.maximum(squares[active] + space.most - 2 * least, 0)
            active, leaf, least = active[goes], leaf[goes], least[goes]
            if not len(active):
                break
            by = np.argsort(leaf, kind="stable")
            active, leaf, least = active[by], leaf[by], least[by]
            x, about = queries[active], np.empty((len(active), p.leaf))
            cuts = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                np.matmul(x[a:b], self.vectors[leaf[a]].T, out=about[a:b])
            row, place = np.nonzero((about >= (least - slack[active])[:, None]) & self.real[leaf])
            if not len(row):
                continue
            exact = np.empty(len(row))  # summed in one order whatever the place, so that equal vectors tie
            for k in range(0, len(row), 1 << 13):
                r, c = row[k : k + (1 << 13)], place[k : k + (1 << 13)]
                exact[k : k + (1 << 13)] = np.einsum("pd,pd->p", self.vectors[leaf[r], c], x[r])
            some, at = np.unique(row, return_inverse=True)
            score = np.full((len(some), p.leaf), -np.inf)
            score[at, place] = exact
            best.take(active[some], score, self.ids[leaf[some]])
        return best


def usable(v: Column) -> Column:
    """Whether a vector takes part: not null, without null, infinite or undefined components, and not all zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


PACKED = pa.schema([("kind", pa.int32()), ("cell", pa.int32()), ("name", pa.int64()), ("blob", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
PACKED_SQL = "kind int, cell int, name long, blob binary, low array<double>, high array<double>"
CELL, BLOCK = 0, 1
FOUND = pa.schema([("name", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())])
FOUND_SQL = "name long, part int, blob binary"


def _usable_rows(vectors: DataFrame, query: Column) -> DataFrame:
    """(key, vec_id, vector, q): rows that take part; equal vectors have equal keys."""
    kind = vectors.schema["embedding"].dataType.elementType
    kind = kind if isinstance(kind, T.FloatType) else T.DoubleType()
    vector = F.transform("embedding", lambda x: x.cast(kind) + F.lit(0).cast(kind))  # -0.0 and 0.0 are one
    rows = vectors.where("vec_id is not null").select("vec_id", vector.alias("vector"), F.coalesce(query, F.lit(False)).alias("q"))
    return rows.where(usable(F.col("vector"))).withColumn("key", F.unhex(F.sha2(F.col("vector").cast("string").cast("binary"), 256)))


def neighbours(vectors: DataFrame, query: Column, p: Params = Params()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row, the nearest found by inner product in double precision.

    vectors has vec_id and embedding; other columns are ignored. query: a boolean over these columns; every row is a
    candidate for all queries but itself. rank counts from 1, ties go to the smaller vec_id. Rows without a vec_id, and
    vectors that are null, zero, or hold null or non-finite components, take no part. Shorter vectors count as if zeros
    followed. Fewer candidates than k are all returned; without a candidate or a query there are no rows. Repeated rows
    of one vec_id and vector are one row.
    """
    spark = vectors.sparkSession
    rows = _usable_rows(vectors, query)
    asks = stored(rows.where("q").select("key", "vec_id").distinct(), "asks")
    first = rows.select("key", "vec_id", "vector").dropDuplicates(["key", "vec_id"])
    first = first.withColumn("place", F.row_number().over(W.partitionBy("key").orderBy("vec_id"))).where(F.col("place") <= p.k + 1)
    wanted = asks.select("key").distinct().withColumn("asks", F.lit(True))
    points = stored(first.join(wanted, "key", "left").select("key", "vec_id", "vector", (F.coalesce("asks", F.lit(False)) & (F.col("place") == 1)).alias("asks")), "points")
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, width, most = points.agg(F.count("*"), F.max(F.size("vector")), F.max(norm)).first()
    space = Space(int(width or 1), float(most or 0.0), p.dims, p.seed)

    few = points.select("vector", "key").where(F.pmod(F.xxhash64("key", "vec_id"), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, p.sample / max(total, 1))))
    sample = few.select("vector").limit(2 * p.sample).toArrow()
    size = min(max(p.cell, -(-total // p.cells)), max(p.leaf, p.room // space.width))
    tree = Tree.of(space.points(_matrix(sample.column("vector"), space.width)), min(-(-total // size), max(1, sample.num_rows // 64)))
    plain = np.float32 if isinstance(points.schema["vector"].dataType.elementType, T.FloatType) else np.float64  # in which vectors travel
    shared = spark.sparkContext.broadcast((space, tree))

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, tree = shared.value
        for part in parts:
            cell = tree.cell(space.points(_matrix(part.column("vector"), space.width)))
            yield pa.record_batch([*part.columns, pa.array(cell.astype(np.int32))], names=[*part.schema.names, "cell"])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        """The cell in kd_order(), with its box, and its queries in blocks with what they find in it."""
        space, _ = shared.value
        table = table.sort_by([("vec_id", "ascending")])
        x, ids = _matrix(table.column("vector"), space.width), table.column("vec_id").to_numpy()
        at = space.points(x)
        order = kd_order(at, p.leaf)
        x, ids, at = x[order], ids[order], at[order]
        asking = table.column("asks").to_numpy()[order]
        names = np.array(table.column("key").to_pylist(), object)[order]
        cell = key[0].as_py()
        out = [(CELL, cell, 0, pickle.dumps((ids, x.astype(plain)), protocol=5), at.min(0).tolist(), at.max(0).tolist())]
        q = np.flatnonzero(asking)
        best = Cell(space, x, ids, p).search(x[q], np.full(len(q), -np.inf))
        for i in range(0, len(q), p.block):
            own, at = q[i : i + p.block], slice(i, i + p.block)
            out.append((BLOCK, cell, cell << 32 | i // p.block, pickle.dumps((names[own].tolist(), x[own].astype(plain), best.score[at], best.ids[at]), protocol=5), None, None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), PACKED, strict=True)], schema=PACKED)

    dealt = points.mapInArrow(placed, T.StructType([*points.schema, T.StructField("cell", T.IntegerType())]))
    packed = stored(dealt.groupBy("cell").applyInArrow(pack, PACKED_SQL), "cells")
    # as many boxes as the sample allows cells
    known = packed.where(F.col("kind") == CELL).select("cell", "low", "high").orderBy("cell").toPandas()
    low, high = (np.array(known[c].tolist(), float).reshape(-1, p.dims) for c in ("low", "high"))
    around = spark.sparkContext.broadcast((known["cell"].to_numpy(np.int64), low, high))

    def reached(parts: Iterator[pa.RecordBatch], more: float = 1.0) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(name, queries, the worst that each has, numbers of the other cells that may have something for them, which of the queries each may)."""
        cells, low, high = around.value
        space, limit = shared.value[0], chi_square_quantile(p.confidence, p.dims)
        for part in parts:
            for cell, name, blob in zip(*(part.column(c) for c in ("cell", "name", "blob")), strict=True):
                _, x, score, _ = pickle.loads(blob.as_py())
                wide = x.astype(float)
                goes = box_distance(space.queries(wide), low, high) <= more * limit * space.distance(wide, score[:, -1])[:, None]
                yield name.as_py(), x, score[:, -1], np.flatnonzero(goes.any(0) & (cells != cell.as_py())), goes

    def group(name: int) -> int:
        return zlib.crc32(b"%d" % name) % groups

    def pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = around.value[0]
        for name, _, _, to, _ in reached(parts, 1 + 1e-9):  # another machine may round otherwise; a guest needs its host
            yield pa.record_batch([pa.array(cells[to], pa.int32()), pa.array(np.full(len(to), group(name)), pa.int64())], names=["cell", "group"])

    def visits(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The queries of a block that another cell may still have something for, by cell."""
        cells = around.value[0]
        for name, x, worst, to, goes in reached(parts):
            for c in to:
                own = np.flatnonzero(goes[:, c])
                yield pa.record_batch([pa.array([int(cells[c])], pa.int32()), pa.array([group(name)], pa.int64()), pa.array([name]), pa.array([pickle.dumps((own.astype(np.int32), x[own], worst[own]), protocol=5)], pa.binary())], names=["cell", "group", "name", "blob"])

    blocks = packed.where(F.col("kind") == BLOCK).select("cell", "name", "blob")
    groups = -(-blocks.count() // max(p.reach, total // max(1, len(known)) // p.block))
    # what visits is sent as it is found: stored, its blobs would be read back thousands at a time
    going = stored(blocks.mapInArrow(pairs, "cell int, group long").distinct(), "pairs")
    hosts = packed.where(F.col("kind") == CELL).select("cell", "blob").join(going, "cell")

    def meet(key: tuple, host: pa.Table, guests: pa.Table) -> pa.Table:
        if not guests.num_rows:
            return FOUND.empty_table()
        space, _ = shared.value
        ids, x = pickle.loads(host.column("blob")[0].as_py())
        cell, out = Cell(space, x.astype(float), ids, p), []
        each = [pickle.loads(b.as_py()) for b in guests.column("blob")]
        ends = np.cumsum([len(own) for own, _, _ in each])
        bounds = np.concatenate([bound for _, _, bound in each])
        all_ = cell.search(np.concatenate([x for _, x, _ in each]).astype(float), bounds)
        for name, (own, _, bound), end in zip(guests.column("name").to_pylist(), each, ends, strict=True):
            best = Best(all_.score[end - len(own) : end], all_.ids[end - len(own) : end])
            row, place = np.nonzero((best.score >= bound[:, None]) & np.isfinite(best.score))
            for part in np.unique(own[row] // p.share):
                i = own[row] // p.share == part
                out.append((name, int(part), pickle.dumps((own[row][i], best.score[row[i], place[i]], best.ids[row[i], place[i]]), protocol=5)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 3, FOUND, strict=True)], schema=FOUND)

    def opened(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the blocks have found at home, by parts of a block."""
        for part in parts:
            for name, blob in zip(part.column("name").to_pylist(), part.column("blob").to_pylist(), strict=True):
                keys, _, score, ids = pickle.loads(blob)
                for i in range(0, len(keys), p.share):
                    row = np.repeat(np.arange(i, min(i + p.share, len(keys)), dtype=np.int32), score.shape[1])
                    data = pickle.dumps((row, score[i : i + p.share].ravel(), ids[i : i + p.share].ravel(), keys[i : i + p.share]), protocol=5)
                    yield pa.record_batch([pa.array([name]), pa.array([i // p.share], pa.int32()), pa.array([data], pa.binary())], schema=FOUND)

    best_type = "key binary, best array<struct<vec_id: long, score: double>>"
    pair = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())]))

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        each = [pickle.loads(b) for b in table.column("blob").to_pylist()]
        keys = next(e[3] for e in each if len(e) == 4)
        row, score, ids = (np.concatenate([e[k] for e in each]) for k in range(3))
        row = row - key[1].as_py() * p.share
        real = np.isfinite(score)
        row, score, ids = row[real], score[real], ids[real]
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        at = np.searchsorted(row, np.arange(len(keys) + 1))
        best = [[{"vec_id": v, "score": s} for v, s in zip(ids[a:b][: p.k + 1].tolist(), score[a:b][: p.k + 1].tolist(), strict=True)] for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.table([pa.array(keys, pa.binary()), pa.array(best, pair)], names=["key", "best"])

    guests = packed.select(*(F.col(c).alias(c) for c in packed.columns)).where(F.col("kind") == BLOCK).select("cell", "name", "blob").mapInArrow(visits, "cell int, group long, name long, blob binary")
    met = hosts.groupBy("cell", "group").cogroup(guests.groupBy("cell", "group")).applyInArrow(meet, FOUND_SQL)
    best = met.unionByName(blocks.mapInArrow(opened, FOUND_SQL)).groupBy("name", "part").applyInArrow(merge, best_type)
    best = stored(best, "best")
    discard(points, packed, going)
    total = asks.count()
    often = F.broadcast(asks.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * 1000 > total).select("key"))  # under a thousand
    rest = asks.join(often, "key", "left_anti").join(best, "key")
    answered = rest.unionByName(asks.join(F.broadcast(best.join(often, "key", "left_semi")), "key"))
    own = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("vec_id")), 1, p.k)
    return answered.select(F.col("vec_id").alias("query_id"), F.posexplode(own).alias("place", "x")).select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
