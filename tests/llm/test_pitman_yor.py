import math
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from arbora.llm import pitman_yor as py
from arbora.llm.pitman_yor import Params
from arbora.llm.queries import op9_pitman_yor
from arbora.llm.text import split_words

SF = "/root/testdata/sf0.01"


def test_base_columns_and_held_out_gain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), b"\n"] for r in docs}
    out = {i for i in tokens if zlib.crc32(str(i).encode()) % 10 == 0}
    c = Counter(w for i, x in tokens.items() if i not in out for w in x)
    total, kinds = sum(c.values()), len(c)
    got = {r.doc_id: r for r in op9_pitman_yor(spark, SF).collect()}
    assert got.keys() == tokens.keys()
    for i, x in tokens.items():
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in x)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in out, len(x), sum(c[w] > 0 for w in x), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    # the base gives every unseen word the weight of a tenth of one that was seen; the model spells it
    gains = [got[i].score - got[i].base_score for i in out]
    known = [got[i].score - got[i].base_score for i in out if got[i].n_known >= 0.98 * got[i].n_tokens > 20]
    assert sum(gains) > 0 and len(known) > 10 and sum(g > 0 for g in known) > 0.9 * len(known)


def test_word_probabilities_are_a_distribution(spark):
    texts = ["a b a c ab abc a a b", "b a cab", None, "", "A B"]
    docs = spark.createDataFrame([(i, t, True, 1) for i, t in enumerate(texts)], "doc_id long, text string, learn boolean, n int")
    words, total, kinds, model = py.train(docs)
    rows = {bytes(r.word): r for r in words.collect()}
    assert total == 9 + 3 + 2 + 5 and kinds == len(rows) == 7 and rows[b"\n"].n == 5
    seen = pa.array(list(rows), pa.binary())
    unseen = np.mean([weight * (1 - np.exp(s.log_words(seen)).sum()) for weight, s in model.spellings])
    assert sum(10**r.log10_prob for r in rows.values()) + unseen == pytest.approx(1)
    two = model.unseen(pa.array([b"cat", b"q" * 40], pa.binary()))
    assert two[0] > two[1] + 10


def test_spelling_restaurants_sum_to_one():
    s = py.Spelling(Params())
    codes, n = np.unique(py.spelled(pa.array([b"abc", b"abd", b"b", b"ab", b"cab"], pa.binary()))[1], return_counts=True)
    for sweep in range(4):
        s = s.swept(codes, n + sweep, sweep)
    end = py.SYMBOLS - 1
    for x, y in ((end, end), (end, 97), (97, 98), (122, 122)):
        for k in range(3):
            every = ((x * py.SYMBOLS + y) * py.SYMBOLS + np.arange(py.SYMBOLS)) % py.SYMBOLS ** (k + 1)
            assert s.of(k, every).sum() == pytest.approx(1, abs=1e-9)
    owner, codes = py.spelled(pa.array([b"xy", b"a"], pa.binary()))
    assert owner.tolist() == [0, 0, 0, 1, 1]
    pairs = [(c // py.SYMBOLS**2, c // py.SYMBOLS % py.SYMBOLS, c % py.SYMBOLS) for c in codes.tolist()]
    assert pairs == [(end, end, 120), (end, 120, 121), (120, 121, end), (end, end, 97), (end, 97, end)]


def partitions(n):
    """All ways to seat n customers, as lists of table sizes."""
    if not n:
        yield []
        return
    for part in partitions(n - 1):
        yield [*part, 1]
        for k in range(len(part)):
            yield [*part[:k], part[k] + 1, *part[k + 1 :]]


def test_tables_follow_the_chinese_restaurant():
    d, strength, others, base, c = 0.4, 1.0, 3, 0.2, 6
    weight = Counter()
    for sizes in partitions(c):
        new = np.prod([(strength + d * (others + j)) * base for j in range(len(sizes))])
        weight[len(sizes)] += new * np.prod([np.prod([k - d for k in range(1, n)]) for n in sizes])
    want = np.array([weight[t] for t in range(1, c + 1)]) / sum(weight.values())
    ways = py.stirling(c, d)
    for t in range(1, c + 1):
        assert np.exp(ways[c, t]) == pytest.approx(sum(np.prod([np.prod([k - d for k in range(1, n)]) for n in sizes]) for sizes in partitions(c) if len(sizes) == t))
    n = 40_000
    got = py.draw_tables(np.full(n, c), np.full(n, others), np.full(n, base), d, np.arange(n, dtype=np.uint64), 3, Params(strength=strength))
    assert np.abs(np.bincount(got, minlength=c + 1)[1:] / n - want).max() < 0.01


@pytest.mark.parametrize("d", [0.05, 0.3, 0.8, 0.95])
def test_integrals_equal_the_stirling_recursion(d):
    most = 700
    ways = py.stirling(most, d)
    for c in (20, 513, most):
        t = np.array(sorted({*range(1, min(c, 40)), *range(40, c, 37), c}))
        got = py.log_together(np.full(len(t), c), t, d) + py.log_gamma(np.array([c + 1.0])) - py.log_gamma(t + 1.0) - t * np.log(d)
        np.testing.assert_allclose(got[t <= 0.9 * c], ways[c, t[t <= 0.9 * c]], atol=1e-4)
        np.testing.assert_allclose(got, ways[c, t], atol=0.02)


def exact_tables(c, others, base, d, p):
    t = np.arange(1, c + 1)
    w = py.stirling(c, d)[c, 1:] + np.cumsum(np.log(p.strength + d * (others + t - 1)) + np.log(base))
    q = np.exp(w - w.max())
    return q / q.sum()


@pytest.mark.parametrize(("d", "base", "others"), [(0.8, 0.05, 50), (0.5, 0.2, 5), (0.8, 0.05, 0), (0.5, 0.01, 20_000), (0.3, 0.5, 2000)])
def test_large_dishes_follow_the_same_distribution_as_small_ones(d, base, others):
    """At 600 customers against all numbers of tables, and level with what the table of Stirling numbers gives at 512."""
    p, n = py.Params(), 500
    keys = np.arange(n, dtype=np.uint64) * np.uint64(977)
    draw = lambda c, p=p: py.draw_tables(np.full(n, c), np.full(n, others), np.full(n, base), d, keys, 1, p)
    want, got = exact_tables(600, others, base, d, p), draw(600)
    cells = np.searchsorted(np.cumsum(want), py.uniform(keys, 1 << 20)) + 1
    assert (np.abs(got - cells) <= 1).all() and (got == cells).mean() > 0.97  # the same uniform draws, inverted
    assert draw(513).mean() == pytest.approx(draw(512).mean(), rel=0.01)
    assert draw(40, py.Params(exact=16)).tolist() == draw(40).tolist()


def test_no_rows_and_nothing_to_learn(spark):
    assert py.score(spark.createDataFrame([], "doc_id long, text string, learn boolean"), "learn").count() == 0
    got = py.score(spark.createDataFrame([(1, "a b", False), (None, "a" * 5000, None)], "doc_id long, text string, learn boolean"), "learn").collect()
    assert {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in got} == {1: (3, 0, 0), None: (2, 0, 0)}
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def test_order_of_words_matters(spark):
    texts = ["red fox runs to blue lake", "red fox sees blue lake"] * 30
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(100, "red fox runs to blue lake", False), (101, "lake to red blue runs fox", False), (102, "red fox", False), (103, "fox red new", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = {r.doc_id: r for r in py.score(docs, "learn").collect()}
    assert got[100].base_score == pytest.approx(got[101].base_score) and got[100].score > got[101].score + 5


@pytest.mark.parametrize("bucket", [4_000_000, 12])
def test_followers_are_a_distribution(spark, bucket):
    texts = ["a b a c ab abc a a b", "b a cab a b a b", None, "a b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    p = Params(bucket=bucket)
    m = py.learn(docs, p)
    d = m.deal.value
    assert (bucket == 12) == bool(len(d.shared()))
    alone = {r.h % 2**64: r.log10_prob for r in m.words.collect()}
    pairs, words = {}, {}
    for r in py._answers(m, p).collect():
        if r.kind == py.PAIRS:
            u, w, more = d.unpack(r.blob)
            pairs.update(zip(zip(u.tolist(), w.tolist(), strict=True), more.tolist(), strict=True))
        else:
            h, _, value = d.unpack(r.blob)
            for a, b in zip(h.tolist(), value.tolist(), strict=True):
                assert words.setdefault(a, b) == pytest.approx(b)
    assert words.keys() == alone.keys() and len(pairs) > 10
    spelled = [r.word for r in m.words.collect()]
    unseen = np.mean([weight * (1 - np.exp(s.log_words(pa.array(map(bytes, spelled), pa.binary()))).sum()) for weight, s in m.spellings])
    for u, value in words.items():
        back = value - alone[u]
        each = [alone[w] + back + pairs.get((u, w), 0.0) for w in alone]
        assert sum(10**x for x in each) + unseen * 10**back == pytest.approx(1, abs=1e-6)


def test_scores_do_not_depend_on_how_rows_are_dealt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("learn", py.F.col("doc_id") % 3 > 0)
    want = {r.doc_id: r for r in py.score(docs, "learn").collect()}
    for rows, p in ((docs.repartition(7), Params()), (docs, Params(bucket=3000, batch=20_000))):
        got = {r.doc_id: r for r in py.score(rows, "learn", p).collect()}
        assert got.keys() == want.keys()
        for i, r in want.items():
            assert got[i].score == pytest.approx(r.score, abs=1e-3) and got[i].base_score == pytest.approx(r.base_score)


def test_unseen_words_are_spelled(spark):
    texts = ["the cat sat on the mat", "the cat ran to the cat", "a dog sat on the rat"] * 20
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(900, "the cats", False), (901, "the " + "xqzjvw" * 7, False), (902, "the cat", False)]
    got = {r.doc_id: r.score for r in py.score(spark.createDataFrame(rows, "doc_id long, text string, learn boolean"), "learn").collect()}
    assert got[902] > got[900] > got[901] + 20


def test_pairs_are_grouped_by_one_sort_in_little_memory():
    rng = np.random.default_rng(3)
    n = 400_000
    w = rng.zipf(1.3, n).astype(np.uint64) % np.uint64(50_000)
    u, row = np.roll(w, 1), np.sort(rng.integers(0, 2_000, n))
    tracemalloc.start()
    one, many, first, by_pair = py._grouped(u, w, row)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    _, index, inverse, counts = np.unique(py._pair(u, w), return_index=True, return_inverse=True, return_counts=True)
    assert (one == index).all() and (many == counts).all() and (first == np.cumsum(counts) - counts).all()
    assert (by_pair == row[np.argsort(inverse, kind="stable")]).all()
    assert most < 5 * 8 * n, most


def test_places_and_orders_of_hashes():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**64, 5000, np.uint64)
    keys[:40] = (keys[0] & ~np.uint64(63)) + np.arange(40, dtype=np.uint64)[::-1]  # they share their first bits
    keys = rng.permutation(np.unique(np.append(keys, np.uint64(2**64 - 1))))
    for own in (keys, np.sort(keys), keys[keys < 2**64 - 1], keys[:1], keys[:0], np.arange(3000, dtype=np.uint64)):
        place = {int(k): i for i, k in enumerate(own)}
        wanted = np.concatenate([own, own + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        hit, at = py.Lookup(own).find(wanted)
        assert hit.tolist() == [int(k) in place for k in wanted]
        assert at[hit].tolist() == [place[int(k)] for k in wanted[hit]]
        twice = np.concatenate([own, own])
        assert (py._order(twice) == np.argsort(twice, kind="stable")).all()


def test_places_of_pairs_are_grouped_alike_whether_they_fit_one_number_or_not():
    rng = np.random.default_rng(4)
    n = 20_000
    w = rng.zipf(1.3, n) % 700
    u, row = np.roll(w, 1), np.sort(rng.integers(0, 200, n))
    got, wide = py._grouped_places(u, w, row, 700), py._grouped_places(u, w, row, 2**25)
    _, index, inverse, counts = np.unique(u * 1000 + w, return_index=True, return_inverse=True, return_counts=True)
    want = (index, counts, np.cumsum(counts) - counts, row[np.argsort(inverse, kind="stable")])
    for x, y, z in zip(got, wide, want, strict=True):
        assert x.tolist() == y.tolist() == z.tolist()


def test_lookups_and_integrals_take_few_cpu_seconds():
    """The CPU seconds of the whole job go into these; both took several times as long."""
    rng = np.random.default_rng(6)
    keys = np.sort(rng.integers(0, 2**64, 2_000_000, np.uint64))
    wanted = rng.choice(keys, 1_000_000)
    place = py.Lookup(keys)
    assert least_seconds(lambda: place.find(wanted)) < 0.6 * least_seconds(lambda: np.searchsorted(keys, wanted))
    c, t = rng.integers(513, 5000, 200)[:, None], np.arange(1.0, 33)
    z = rng.random((200, 32, 33)) * 0.4 * np.exp(1j)
    complex_ = lambda: (np.log(1 - z**0.7), np.log(1 - z), np.exp(z))
    assert least_seconds(lambda: py.log_together(c, t, 0.7)) < 1.2 * least_seconds(complex_)


def least_seconds(run):
    found = []
    for _ in range(4):
        start = time.process_time()
        run()
        found.append(time.process_time() - start)
    return min(found)


def test_words_between_spaces_are_split_without_empty_ones():
    texts = pa.array(["xx", " A b  a\n", None, "", "  ", "b ", "\tA", "b a"])
    for column in (texts[1:], texts[1:1], pa.array(["a b", "b"])):
        words, index, sizes = split_words(column, folded=True)
        spelled = [words[i].as_py() for i in index]
        assert b"" not in words.to_pylist() and len(set(words.to_pylist())) == len(words)
        at = np.concatenate([[0], np.cumsum(sizes)])
        assert [spelled[a:b] for a, b in zip(at, at[1:])] == [(x or "").lower().encode().split() for x in column.to_pylist()]
