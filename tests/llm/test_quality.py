import math
import random
import re

import numpy as np

from arbora.llm import quality
from arbora.llm.quality import Params
from arbora.llm.queries import op1_quality

SF = "/root/testdata/sf0.01"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def brute_kept(rows, p):
    """Verdicts by plain concentration steps on sorted documents, from many random starts and those of the operator."""
    vectors, own = {}, {}
    for i, (text, lang, source) in enumerate(rows):
        n, c, s, d, r, failed = base(text)
        if not failed:
            v = [math.log(c / n), *(math.log1p(100 * x / (n + p.shrink)) for x in (s, d, r))]
            vectors[i] = [math.floor(x * 256 + 0.5) for x in v]
            for g in ((lang, source), (lang,), ()):
                own.setdefault(g, []).append(i)
    floor = (np.array(p.floors) * 256) ** 2
    cut = quality.chi2_quantile(1 - p.false_rate, 4)
    whole = p.coverage / quality.chi2(quality.chi2_quantile(p.coverage, 4), 6)

    def of(sub):
        cov = whole * np.cov(sub.T, bias=True)
        cov[np.diag_indices(4)] = np.maximum(np.diag(cov), floor) + floor / 400
        return sub.mean(0), cov

    def estimate(x):
        h, rng, found = math.ceil(p.coverage * len(x)), np.random.default_rng(1), []
        off = (x - np.median(x, 0)) ** 2
        for start in [*(rng.permutation(len(x)) for _ in range(30)), np.argsort((off / floor).sum(1), kind="stable")]:
            m, cov = of(x[start[: max(8, h // 4)]])
            for _ in range(40):
                d = ((x - m) @ np.linalg.inv(cov) * (x - m)).sum(1)
                m, cov = of(x[np.argsort(d, kind="stable")[:h]])
            found.append((np.linalg.slogdet(cov)[1], tuple(m), cov))
        return min(found, key=lambda f: f[0])

    at, out = {}, {}
    for i in range(len(rows)):
        if i not in vectors:
            out[i] = None
            continue
        text, lang, source = rows[i]
        g = next((g for g in ((lang, source), (lang,)) if len(own[g]) >= p.least_group), ())
        if g not in at:
            at[g] = estimate(np.array([vectors[k] for k in own[g]], float))
        off = np.array(vectors[i]) - np.array(at[g][1])
        out[i] = off @ np.linalg.inv(at[g][2]) @ off / cut
    return out


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(260):
        words = [rng.choice(["alpha", "be", "gamma", "to", "epsilon", "the"]) + str(rng.randrange(50)) for _ in range(rng.randrange(0, 80))]
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\t"]) for w in words)
        if i % 17 == 0:
            text = text.replace("a", "#").replace("e", "|")
        if i % 19 == 0:
            text = text + text[: len(text) // 3]
        if i % 23 == 0:
            text = "x" * 500 + text
        rows.append((text, rng.choice(["en", None]), rng.choice(["s", "t"])))
    rows += [(None, "en", "s"), ("", "en", "s"), (" \n\t", None, None), ("été\x0bnaïve\x0cx " * 30, "fr", "s"), ("same line\n" * 12, "en", "s")] + rows[:3]
    p = Params(least_group=40, false_rate=1e-2)
    frame = spark.createDataFrame([(i, *r, 1, True) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, g int, kept boolean")
    got = {r.doc_id: r for r in quality.judge(frame, p, ("doc_id", "g", "kept")).collect()}
    assert {i: tuple(got[i])[3:9] for i in got} == {i: base(t) for i, (t, _, _) in enumerate(rows)} and got[0].kept_kept
    want = brute_kept(rows, p)
    assert all((got[i].distance is None) == (want[i] is None) for i in want)
    clear = {i: want[i] <= 1 for i in want if want[i] is not None and not 0.6 < want[i] < 1.6}
    assert {i: got[i].kept for i in clear} == clear and len(clear) > 0.9 * sum(x is not None for x in want.values()) and 5 < sum(not k for k in clear.values()) < 60


def test_moderate_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(3)
    make = lambda n: " ".join(rng.choice(["alpha", "be", "gamma", "to", "epsilon", "the"]) + str(rng.randrange(900)) for _ in range(n))
    clean = [(make(rng.randrange(25, 400)), rng.choice(["en", "de"]), f"s{rng.randrange(40)}") for _ in range(600)]
    clean += [(make(30) + " a & b", "en", "s1"), (make(22) + " $", "de", "rare")]
    odd = [(" ".join(w + (" #" if k % 6 == 0 else "") for k, w in enumerate(make(120).split())), "en", "s1"), ("same line here\n" * 14 + make(100), "de", "s2"), (" ".join(x * 4 for x in make(80).split()), "en", "rare")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(clean + odd)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert all(got[i].distance is not None for i in got if not got[i].base_failed)
    assert sum(got[i].kept for i in range(len(clean))) >= 0.99 * len(clean) and got[600].kept and got[601].kept
    assert not any(got[i].kept for i in range(len(clean), len(got)))


def test_empty_table_and_good_documents(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0
    one = quality.judge(spark.createDataFrame([(None, "word " * 3 + "other " + " ".join(map(str, range(30))), None, None)], "doc_id long, text string, lang string, source string")).collect()
    assert [(r.kept, r.distance) for r in one] == [(True, None)]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op1_quality(spark, SF).collect()
    passed = [r for r in got if not r.base_failed]
    good = [r for r in passed if label.get(r.doc_id) == 1]
    assert len(got) == 1000 and all(r.distance is not None for r in passed)
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(not r.kept for r in passed) > 0


def test_factor_is_the_cholesky_factor_and_stays_small(spark):
    """Each element is computed once: the plan's text grows with their number, not with the ways to expand them."""
    p = quality.Params()
    rng = np.random.default_rng(2)
    n = quality.DIMENSIONS
    x = rng.standard_normal((50, n)) @ rng.standard_normal((n, n)) * 4000
    m, q = x.mean(0), x.T @ x / len(x)
    row = {f"m{j}": float(m[j]) for j in range(n)} | {f"q{j}{k}": float(q[j, k]) for j, k in quality.MOMENTS}
    rows = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row)).withColumn("f", quality._factor(p, 1.0))
    cov = q - np.outer(m, m)
    floors = np.array([(f * quality.UNIT) ** 2 for f in p.floors])
    cov[np.diag_indices(n)] = np.maximum(np.diag(cov), floors) + floors / 400
    want = np.linalg.cholesky(cov)
    np.testing.assert_allclose(rows.first().f, [want[j, k] for j, k in quality.MOMENTS], rtol=1e-8)
    assert len(rows._jdf.queryExecution().optimizedPlan().toString()) < 20_000
