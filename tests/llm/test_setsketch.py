import random

import numpy as np
import pytest

from arbora.llm import setsketch
from arbora.llm.setsketch import Params, Sketcher


def shingle_set(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(docs, k):
    """Smallest reachable id by comparing every pair."""
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingle_set(t, k)) for i, t in docs]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 30, 120, 300]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            copy = list(base)
            for _ in range(int(len(base) * rng.choice([0, 0.01, 0.04, 0.07, 0.1]))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    docs += [None, "", " \n ", "Word", "word", "two words", "TWO  words", "two word"]
    rng.shuffle(docs)
    return [(i * 7 + 3, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("k", [2, 5])
def test_equals_comparing_every_pair(spark, k):
    docs = corpus(k)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n long, rep string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(frame, Params(words=k, small=5, block=8)).collect()}
    assert got == brute(docs, k)


def test_no_documents_and_null_ids(spark):
    assert setsketch.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    frame = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(frame).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (None, None, True)]


def test_rows_of_one_id_share_a_component(spark):
    frame = spark.createDataFrame([(2, None), (2, "a b c d e f"), (2, " "), (1, "a b c d e f"), (3, ""), (None, "")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(frame).collect()), key=str)
    assert got == [(1, 1, True), (2, 1, False), (2, 1, False), (2, 1, False), (3, 3, True), (None, None, True)]


def test_sketches_merge_and_estimate():
    s = Sketcher(Params(registers=2048))
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[600:])
    ra, rb = s.registers(a), s.registers(b)
    assert (setsketch.merge(ra, rb) == s.registers(np.unique(x))).all()
    est = setsketch.estimate(*(np.array([f(ra, rb).sum()]) for f in (np.greater, np.less, np.equal)), np.array([2000.0]), np.array([2400.0]), 1.001)
    assert abs(est[0] - 1400 / 3000) < 0.05
