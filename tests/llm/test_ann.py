"""Nearest neighbours against comparing everything with everything."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arbora.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, key string"


def by_hand(rows, query, k):
    kept = {i: np.array(v, float) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    width = max((len(v) for v in kept.values()), default=0)
    kept = {i: np.pad(v, (0, width - len(v))) for i, v in kept.items()}
    out = {}
    for q in filter(query, kept):
        out[q] = sorted(((-float((kept[q] * v).sum()), i) for i, v in kept.items() if i != q))[:k]
    return out


def answers(found):
    out = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    return out


def compare(found, want, k, recall):
    got = answers(found)
    assert set(got) == {q for q, near in want.items() if near}
    hits = total = 0
    for q, near in got.items():
        assert [r for r, _, _ in near] == [*range(1, len(want[q]) + 1)]
        assert [(-s, i) for _, i, s in near] == sorted((-s, i) for _, i, s in near)
        hits += len({i for _, i, _ in near} & {i for _, i in want[q]})
        total += len(want[q])
    assert hits >= recall * total


def vectors(n, width, seed=1, lengths=False):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width)) * 2
    x = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, width))
    return x if lengths else x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_over_many_cells(spark, lengths):
    x = vectors(1500, 24, lengths=lengths).astype(np.float32).tolist()
    rows = [(i, v, None, 3, "x") for i, v in enumerate(x)]
    p = ann.Params(k=10, cell=100, leaf=8, block=16, share=8, reach=2)
    found = ann.neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, p)
    compare(found, by_hand(rows, lambda i: i % 20 == 0, 10), 10, 0.95)


def test_everything_is_found_at_full_confidence(spark):
    x = vectors(400, 6, 3).tolist()
    rows = [(i, v, None, 3, "x") for i, v in enumerate(np.float32(x).tolist())]
    p = ann.Params(k=5, cell=64, leaf=4, block=16, share=8, confidence=1 - 1e-12)
    found = answers(ann.neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, p))
    for q, near in by_hand(rows, lambda i: i % 20 == 0, 5).items():
        assert [i for _, i, _ in found[q]] == [i for _, i in near]
        np.testing.assert_allclose([s for _, _, s in found[q]], [-s for s, _ in near], rtol=1e-12)


def test_copies_ties_and_odd_vectors(spark):
    same = [0.5, 0.5, 0.0]
    rows = [(i, same, 1, 1, "x") for i in range(300)] + [(i, [0.5, 0.5, -0.0], 1, 1, "x") for i in range(300, 340)]
    rows += [(1000, None, 1, 1, "x"), (1020, [0.0, 0.0, 0.0], 1, 1, "x"), (1040, [1.0, None, 0.0], 1, 1, "x"), (1060, [math.nan, 1.0, 0.0], 1, 1, "x"), (1080, [math.inf, 1.0, 0.0], 1, 1, "x")]
    rows += [(None, [9.0, 9.0, 9.0], 1, 1, "x"), (2000, [3.0], None, 1, "x"), (2001, [0.0, 0.0, 4.0], None, 1, "x"), (2020, [], None, 1, "x"), (20, same, 1, 1, "x"), (20, same, 1, 1, "x")]
    found = ann.neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, ann.Params(k=20, cell=64))
    got, want = answers(found), by_hand(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    for q in want:
        assert [(i, round(s, 9)) for _, i, s in got[q]] == [(i, round(-s, 9)) for s, i in want[q]], q


def test_few_rows(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0], 1, 1, "x")], SCHEMA)
    assert ann.neighbours(one, F.col("vec_id") == 0).count() == 0
    assert ann.neighbours(one.where("false"), F.col("vec_id") == 0).count() == 0
    assert [tuple(r) for r in ann.neighbours(one.union(one.selectExpr("7L", "embedding", "label", "rank", "key")), F.col("vec_id") == 0).collect()] == [(0, 1, 7, 5.0)]


def test_quantiles():
    for dims, share, x in ((2, 0.95, -2 * math.log(0.05)), (4, 0.9, 7.779440339734858), (8, 0.95, 15.507313055865453)):
        assert ann.chi_square_quantile(share, dims) == pytest.approx(x, rel=1e-9)


def test_copies_of_queries_are_not_stored(spark, monkeypatch):
    """Evenly spread vectors send most queries to most cells; what is stored, and so read back many blobs at once, follows the input."""
    x = np.random.default_rng(2).standard_normal((2000, 16)).astype(np.float32)
    rows = [(i, v, None, 3, "x") for i, v in enumerate(x.tolist())]
    sizes = {}

    def kept(df, name, f=ann.stored):
        out = f(df, name)
        if "blob" in out.columns:
            sizes[name] = out.agg(F.sum(F.length("blob"))).first()[0]
        return out

    monkeypatch.setattr(ann, "stored", kept)
    found = ann.neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 4 == 0, ann.Params(k=5, cell=16, leaf=8, block=8))
    compare(found, by_hand(rows, lambda i: i % 4 == 0, 5), 5, 0.9)
    assert sum(sizes.values()) <= 8 * x.nbytes, sizes


def test_a_cell_searched_by_many_queries_equals_brute_force():
    rng = np.random.default_rng(4)
    x = np.repeat(rng.standard_normal((150, 7)), 2, axis=0)  # in pairs of equal vectors, so ties go by id
    p = ann.Params(k=4, leaf=8, confidence=1 - 1e-12)
    space = ann.Space(7, float((x * x).sum(1).max()), p.dims, p.seed)
    order = ann.kd_order(space.points(x), p.leaf)
    queries = rng.standard_normal((90, 7))
    best = ann.Cell(space, x[order], order, p).search(queries, np.full(90, -np.inf))
    for i, q in enumerate(queries):
        score = np.array([float((q * v).sum()) for v in x[::2]])
        want = [j for s in np.argsort(-score)[:3] for j in (2 * s, 2 * s + 1)][:5]
        assert best.ids[i].tolist() == want
