"""Runs against their definition."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from arbora.llm import periodic, queries


def by_hand(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            e = i
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            begin, end = i, e + q
            if e > i and end - begin >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(begin, end - p)) for p in range(1, q)):
                out.append((begin, end - begin, q))
            i = max(e, i) + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def digest(w):
    runs = by_hand(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def sequences():
    rng = random.Random(7)
    for k in range(250):
        letters = "abcdefgh"[: rng.randrange(1, 5)]
        w = []
        while len(w) < rng.randrange(1, 260):
            piece = [rng.choice(letters) for _ in range(rng.randrange(1, 24))]
            w += (piece * rng.randrange(1, 8))[: rng.randrange(1, 120)]
        yield w
    fib = ["a"], ["a", "b"]
    for _ in range(11):
        fib = fib[1], fib[1] + fib[0]
    yield fib[1]
    yield ["a"] * 300
    yield (["x"] * 11 + ["y"]) * 9


@pytest.mark.parametrize("window", [1 << 17, 16])
def test_runs_equal_their_definition(monkeypatch, window):
    monkeypatch.setattr(periodic, "WINDOW", window)
    texts = list(sequences())
    words = sorted({x for w in texts for x in w})
    ids = np.array([words.index(x) for w in texts for x in w], np.int64)
    found = periodic.find_runs(ids, np.array([len(w) for w in texts]))
    for r, w in enumerate(texts):
        assert found.get(r, []) == by_hand(w), w


def test_operator_keeps_rows_and_columns(spark):
    rows = [(1, "z a b a b a b a b c", "l"), (1, "z a b a b a b a b c", "l"), (None, None, None), (2, "", "l"), (3, " \n", "l"), (4, "x\tx x\n\nx x x", "l"), (5, "no run here", "l"), (6, "w " * 100_000 + "end", "l")]
    found = periodic.collapse(spark.createDataFrame(rows, "doc_id long, text string, runs string"), keep=("doc_id", "text"))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=str)
    want = [(1, 10, [(1, 8, 2)], "z a b c")] * 2 + [(None, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "x"), (5, 3, [], "no run here"), (6, 100_001, [(0, 100_000, 1)], "w end")]
    assert got == sorted(want, key=str)
    assert periodic.collapse(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(w) for w in list(sequences())[:60]] + [" ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(0, 200))) for _ in range(140)] + [None, "", "x", "x y  z"]
    table = pa.table({"doc_id": pa.array([*range(len(texts))], pa.int64()), "text": texts})
    import pyarrow.parquet as pq

    pq.write_table(table, tmp_path / "documents.parquet")
    found = {r[0]: tuple(r)[1:] for r in queries.op12_periodic(spark, str(tmp_path)).collect()}
    planted = 0
    for i, text in enumerate(texts):
        w, h = (text or "").split(), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
            planted += 1
        assert found[i] == digest(w), (i, text)
    assert planted > 5 and len(found) == len(texts)
