import numpy as np
import pytest

from arbora.llm import embedding_join as ej
from arbora.llm.embedding_join import Params


def brute(rows, cosine=0.93):
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def unit(v):
        x = np.array(v, float) / np.abs(v).max()
        return x / np.linalg.norm(x)

    ok = {i: unit(v) for i, v, l in rows if l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    label, n = {r[0]: r[2] for r in rows}, {r[0]: 0 for r in rows}
    for i in ok:
        for j in ok:
            if i < j and label[i] == label[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine:
                n[i] += 1
                n[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (n[i], find(i), find(i) == i) for i in root}


@pytest.mark.parametrize(("seed", "tile"), [(1, 0), (2, 16 * 12 * 8 * 3)])
def test_equals_comparing_every_pair(spark, seed, tile):
    rng = np.random.default_rng(seed)
    rows, centres = [], rng.normal(size=(25, 12))
    for _ in range(300):
        v = centres[rng.integers(25)] * rng.uniform(0.1, 9) + rng.normal(size=12) * rng.choice([0.02, 0.2, 0.3, 1.0])
        rows.append((v.tolist(), int(rng.integers(3)) if rng.random() < 0.95 else None))
    rows += rows[:20] + [rows[0]] * 5 + [([0.0] * 12, 1), (None, 1), ([], 1), ([1.0, None] + [0.0] * 10, 1), ([float("nan")] * 12, 1), ([float("inf")] * 12, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1e-200] * 12, 1), ([3e200] * 12, 1)]
    order = rng.permutation(len(rows))
    rows = [(int(i) * 3 + 1, *rows[k]) for i, k in enumerate(order)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, rep string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ej.near_duplicates(frame, Params(block=16, fan=3, axes=3, tile=tile, partners=2)).collect()}
    assert got == brute(rows)


def test_no_rows_and_null_ids(spark):
    assert ej.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    frame = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (9, [1.0, 0.01], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in ej.near_duplicates(frame).collect()), key=str)
    assert got == [(4, 1, 4), (9, 1, 4), (None, 0, None)]
