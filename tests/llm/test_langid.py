import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from arbora.llm import langid
from arbora.llm.queries import op2_langid
from arbora.llm.text import signed

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op2_langid(spark, SF).collect()
    assert len(got) == len(truth)
    out = [r for r in got if r.held_out and truth[r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) <= 0.02 * len(got)


def table_of(words, order):
    """The rows that kneser_ney() takes, counted in plain Python."""
    names, rows = {}, Counter()
    _, _, found = langid.grams(words, order)
    flat = [(w, i) for w, x in enumerate(words) for i in range(len(x))]
    for at, (w, i) in enumerate(flat):
        for k in range(1, order + 1):
            if i > 0 and i + 1 >= k:
                key = int(found[k - 1][at])
                names[key, k] = (int(found[k - 2][at]) if k > 1 else 0, int(found[k - 2][at - 1]) if k > 1 else 0, i + 1 == k)
                rows[key, k] += 1
    cols = {"gram": [], "suffix": [], "context": [], "k": [], "n": [], "begins": [], "language": []}
    for (key, k), n in rows.items():
        s, c, b = names[key, k]
        for name, v in zip(cols, (key, s, c, k, n, b, 0), strict=True):
            cols[name].append(v)
    return {c: np.array(v, np.uint64 if c in ("gram", "suffix", "context") else bool if c == "begins" else float if c == "n" else np.int64) for c, v in cols.items()}


def test_probabilities_sum_to_one_and_follow_the_formula():
    rng = random.Random(4)
    words = [" " + "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) + " " for _ in range(60)]
    model = langid.kneser_ney(["x"], table_of(words, 3), 3)
    for start in (" a", " ab", " abc", " dd"):
        total = 0
        for c in "abcd ":
            both, _ = model.score([start, start + c])
            total += math.exp(both[1, 0] - both[0, 0])
        unseen, _ = model.score([start, start + "z"])
        assert total + math.exp(unseen[1, 0] - unseen[0, 0]) == pytest.approx(1, abs=1e-9)


def plain_kneser_ney(words, order):
    """Interpolated Kneser-Ney in plain Python: probability of a character after a context, by recursion."""
    chars = {c for w in words for c in w[1:]}
    raw = Counter(w[i + 1 - k : i + 1] for w in words for k in range(1, order + 1) for i in range(1, len(w)) if i + 1 >= k)
    starts = {w[:k] for w in words for k in range(2, order + 1)}

    def count(g):
        if len(g) == order or g in starts:
            return raw[g]
        return sum(raw[c + g] > 0 for c in chars | {" "})

    def discount(k):
        c = Counter(count(g) for g in raw if len(g) == k)
        return min(0.95, max(0.1, c[1] / max(c[1] + 2 * c[2], 1)))

    off = {k: discount(k) for k in range(1, order + 1)}

    def prob(context, c):
        if len(context) >= order:
            return prob(context[-(order - 1) :], c)
        lower = 1 / (len(chars) + 1) if not context else prob(context[1:], c)
        after = [count(context + x) for x in chars if raw[context + x]]
        if not sum(after):
            return lower
        own = count(context + c) if raw[context + c] else 0
        k = len(context) + 1
        return (max(own - off[k], 0) + off[k] * len(after) * lower) / sum(after)

    return prob


def test_probabilities_equal_the_formula():
    rng = random.Random(9)
    words = [" " + "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 6))) + " " for _ in range(40)]
    model, prob = langid.kneser_ney(["x"], table_of(words, 3), 3), plain_kneser_ney(words, 3)
    for w in [*words, " zab ", " aaaaaa ", " ez "]:
        want = sum(math.log(prob(w[:i], w[i])) for i in range(1, len(w)))
        assert model.score([w])[0][0, 0] == pytest.approx(want, abs=1e-9), w


def test_limits_are_exceeded_by_the_stated_share():
    rng = np.random.default_rng(2)
    p = langid.Params(false_rate=0.01, lengths=(8, 16, 32))
    place = np.repeat([0, 1], 6000)
    language = rng.integers(0, 2, 12000)
    language[:20] = 2
    entropy = rng.normal(2 + language, 0.1)
    limits = langid.limits_of(place, language, entropy, 3, p)
    for k in range(2):
        for j in range(2):
            own = entropy[(place == k) & (language == j)]
            assert (own > limits[k, j]).mean() == pytest.approx(0.01, abs=0.002)
    assert 4.1 < limits[0, 2] < 4.5 and (limits[2] == limits[1]).all()


def test_unlearned_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    rng = random.Random(1)
    clean = [r.text for r in docs.where("lang = 'en' and n_chars between 300 and 3000").orderBy("doc_id").limit(60).collect()]
    odd = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz" + "  ") for _ in range(400)) for _ in range(20)]
    odd += ["hyvää huomenta kaikille ystäville jotka asuvat pohjoisessa järven rannalla ja kävelevät metsässä " * 3, "jak se máte dnes ráno když přišel čtvrtek a všichni šli domů přes řeku žluťoučký kůň " * 3]
    rows = spark.createDataFrame(list(enumerate(clean + odd)), "doc_id long, text string")
    got = {r.doc_id: r.rejected for r in langid.identify(rows, model, ["doc_id"]).collect()}
    assert sum(got[i] for i in range(60)) <= 2 and sum(got[i] for i in range(60, 82)) >= 20


def test_defined_results(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "", "de"), (5, "12 34 !!", None), (5, "the dog", None), (6, "x" * 30000, "en")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = langid.identify(docs, langid.train(docs), ["doc_id", "text", "score"])
    assert got.columns == ["doc_id", "text", "kept_score", "lang_pred", "score", "cross_entropy", "rejected"]
    got = [(r[0], r[3]) for r in got.collect()]
    assert sorted(got, key=str)[:4] == [(1, "en"), (2, "de"), (3, "und"), (4, "und")] and (5, "und") in got and (5, "en") in got
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify(empty, langid.train(empty), ["doc_id"]).count() == 0
    assert [r.lang_pred for r in langid.identify(docs, langid.train(empty), ["doc_id"]).collect()] == ["und"] * len(rows)
    assert signed(np.array([2**64 - 1], np.uint64))[0] == -1


def test_many_new_words_are_scored_in_little_memory():
    rng = random.Random(7)
    words = [" " + "".join(rng.choice("abcdefgh") for _ in range(9)) + " " for _ in range(60_000)]
    model = langid.kneser_ney(["x"], table_of(words[:300], 3), 3)
    reader = langid.Reader(model)
    new = list(dict.fromkeys(w.strip().encode() for w in words))
    tracemalloc.start()
    at = reader.learn(new)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6, most
    each, sizes = model.score([f" {w.decode()} " for w in new])
    assert (reader.scores[at] == each).all() and (reader.lengths[at] == sizes).all()


def test_a_kept_text_goes_to_the_tasks_once(spark):
    docs = spark.createDataFrame([(1, "ein Text"), (2, None)], "doc_id long, text string")
    out = langid.identify(docs, langid.Model([], 5), ["doc_id", "text"])
    assert [(r.doc_id, r.text, r.lang_pred) for r in out.orderBy("doc_id").collect()] == [(1, "ein Text", "und"), (2, None, "und")]
    plan = out._jdf.queryExecution().analyzed()
    while not plan.nodeName().startswith("MapInArrow"):
        plan = plan.children().head()
    assert [x.split("#")[0] for x in plan.children().head().output().mkString(" ").split()] == ["kept_0", "kept_1"]
