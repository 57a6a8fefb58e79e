import random

import pytest

from arbora.llm import mixing
from arbora.llm.mixing import Params


def water(sizes, weights, most):
    """Targets by sharing the excess again and again."""
    total, target, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while free:
        heavy = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / heavy >= most * sizes[i]}
        if not over:
            for i in free:
                target[i] = left * weights[i] / heavy
            break
        for i in over:
            target[i] = most * sizes[i]
            left -= target[i]
        free -= over
    return target


def table(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(i, None if rng.random() < 0.03 else "w " * rng.choice([0, 1, 5, 40, 300]), rng.choice(["a", "b", "b", "b", "c", "Z", None, "tiny"]) if rng.random() < 0.6 else "b", 1) for i in range(n)]
    return rows + rows[:3], spark.createDataFrame(rows + rows[:3], "doc_id long, text string, source string, size int")


def test_targets_and_taken_words(spark):
    rows, docs = table(spark, 1)
    got = mixing.mix(docs, Params(per_class=20)).collect()
    assert len(got) == len(rows)
    order = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    size = {s: sum(len((r[1] or "").split()) for r in rows if r[2] == s) for s in order}
    want = dict(zip(order, water([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 3), strict=True))
    for s in order:
        own = [r for r in got if r["row"].source == s]
        assert all(r.source_size == size[s] and r.target == pytest.approx(want[s]) for r in own)
        assert sum(r.taken for r in own) == pytest.approx(want[s], abs=1)
    assert all(r.taken <= 3 * r["size"] and len(r.positions) >= (r.taken > 0) and all(0 <= x <= 1 for x in r.positions) for r in got)
    again = mixing.mix(docs.repartition(7), Params(per_class=20)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_demand_follows_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * 10, s) for i in range(400) for s in "abc"], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    for s, slope in zip("abc", (0.5, 0.0, -0.5), strict=True):
        rows = [r for r in got if r["row"].source == s]
        times = sorted(x for r in rows for x in r.positions)
        for t in (0.25, 0.5, 0.75):
            assert sum(x <= t for x in times) / len(times) == pytest.approx((1 - slope) * t + slope * t * t, abs=0.01)


def test_curriculum_rows(spark):
    rows, docs = table(spark, 5)
    out = mixing.curriculum(docs)
    assert out.columns == docs.columns
    plan = mixing.mix(docs).collect()
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(r.taken for r in plan)
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0 and mixing.curriculum(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0.0)] * 2


def test_training_order(spark):
    _, docs = table(spark, 7)
    plan = mixing.mix(docs, keep=("doc_id",)).select("row.doc_id", "taken", "positions")
    got = mixing.in_training_order(plan).collect()
    assert [r.position for r in got] == sorted(r.position for r in got) and len(got) == docs.count()
    assert all((r.position == 2.0) == (not r.positions) for r in got)
