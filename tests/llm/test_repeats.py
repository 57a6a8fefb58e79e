import hashlib
import random

import pytest
from pyspark.sql import functions as F

from arbora.llm import repeats
from arbora.llm.repeats import Params


def brute(docs, length):
    """What is left of each document, string by string."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = (t or "").encode()
        drop = bytearray(len(b))
        for k in range(len(b) - length + 1):
            x = b[k : k + length]
            if x in seen:
                drop[k : k + length] = b"\x01" * length
            seen.add(x)
        left = bytes(c for c, d in zip(b, drop, strict=True) if not d)
        runs = sum(d and not (k and drop[k - 1]) for k, d in enumerate(drop))
        out[i] = (len(b), sum(drop), runs, hashlib.sha256(left).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "été", "naïve", "x", "señor", "long-word-here", "\n", "  "] + [f"w{i}" for i in range(300)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [make(rng.randrange(15, 90)) for _ in range(6)]
    docs = []
    for _ in range(60):
        parts = [make(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            x = rng.choice(passages)
            a = rng.randrange(0, len(x) // 3)
            parts += [x[a : len(x) - rng.randrange(0, len(x) // 3)], make(rng.randrange(0, 30))]
        docs.append(" ".join(parts))
    for _ in range(15):
        t = list(rng.choice(docs))
        for _ in range(rng.randrange(0, 4)):
            if t:
                t[rng.randrange(len(t))] = rng.choice("aé\0")
        docs.append("".join(t))
    docs += [docs[0]] * 4 + ["a" * 1000, "ab" * 300, "a" * 99, "a" * 100, "", None, "spam spam " * 90, "ham spam spam " * 80]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("seed", "p"), [(1, Params()), (2, Params(crowd=2)), (3, Params(length=40, gram=11))])
def test_equals_checking_every_string(spark, seed, p, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(repeats, "PIECE", 300)
    docs = corpus(seed)
    frame = spark.createDataFrame([(i, t, "b", 1) for i, t in docs], "doc_id long, text string, body string, n long").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.deduplicate(frame, p).collect()}
    want = brute(docs, p.length)
    assert {i: (got.get(i), want[i]) for i in want if got.get(i) != want[i]} == {}


def test_repeated_rows_null_ids_and_no_rows(spark):
    assert repeats.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    a = " ".join(f"word{i}" for i in range(40))
    got = [(r.doc_id, r.n_removed) for r in repeats.deduplicate(spark.createDataFrame([(5, a), (5, a), (None, a), (7, "x" + a)], "doc_id long, text string")).collect()]
    n = len(a)
    assert sorted(got, key=str) == sorted([(5, 0), (5, 0), (None, n), (7, n)], key=str)


def test_many_rows_without_an_id(spark):
    rng = random.Random(8)
    make = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(30))
    texts = [make() for _ in range(3000)]
    shared = make()
    texts[7], texts[1900] = texts[7] + shared, texts[1900] + " " + shared
    rows = [(None, t) for t in texts] + [(3, shared + " x"), (3, "y " + shared)]
    got = repeats.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_removed", F.length("text").alias("left"), "n_bytes").collect()
    assert len(got) == 3002 and all(r.left == r.n_bytes - r.n_removed for r in got)
    cut = [r for r in got if r.n_removed]
    assert len(cut) == 3 and sorted(r.doc_id or 0 for r in cut) == [0, 0, 3] and all(r.n_removed - len(shared) in (0, 1) for r in cut)


def test_hot_anchors(spark):
    rng = random.Random(6)
    phrase = "a common phrase of some length that stands in every text, "
    docs = [(i, "".join(chr(97 + rng.randrange(26)) for _ in range(60)) + phrase + "".join(chr(97 + rng.randrange(26)) for _ in range(60)) + ("again and again " * 9 if i % 3 == 0 else "")) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.deduplicate(frame, Params(hot=5, crowd=20)).collect()}
    assert got == brute(docs, 100)


def test_groups_are_maximal_and_whole(spark):
    a, b = " ".join(f"word{i}" for i in range(40)), " ".join(f"other{i}" for i in range(40))
    keys = repeats.np.zeros(3, repeats.np.uint64)
    left, right = [b"zyx"[::-1], b"zyx"[::-1], b"yyx"[::-1]], [a.encode()[:90], a.encode()[:90], a.encode()[:90]]
    groups = {(l, r, tuple(sorted(x))) for l, r, x in repeats.maximal_repeats(keys, left, right, Params(length=91, gram=10))}
    assert (3, 90, (0, 1)) in groups and (2, 90, (0, 1, 2)) in groups and len(groups) == 2
    assert b
