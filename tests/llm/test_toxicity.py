import base64
import itertools
import math
import random
import time

import numpy as np
import pytest

from arbora.llm import toxicity
from arbora.llm.queries import op7_toxicity, table
from arbora.llm.toxicity import Params, Restorer, lattice

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_documents(spark):
    truth = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    got = op7_toxicity(spark, SF).collect()
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    out = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    caught = [p for t, p in out if t]
    assert sum(caught) >= 0.88 * len(caught) and sum(p for t, p in out if not t) <= 0.01 * len(out)


def test_disguises_are_restored(spark, model):
    restore = Restorer(model.letters, Params())
    disguised = {"1d10t": "idiot", "idiooooot": "idiot", "m.o.r.o.n": "moron", "p@th3tic": "pathetic", "l0ser": "loser", "w0rthl3ss": "worthless", "$cum": "scum"}
    assert {x: restore(x) for x in disguised} == disguised
    assert [x[-1] for x in restore.apart(["idiot", "youloser", "1d10tmoron"])] == ["idiot", "loser", "moron"]
    clean = "of the and that with from this on in to " * 3
    rows = [(0, clean)] + [(i + 1, f"{clean} {x} {clean} {y}") for i, (x, y) in enumerate([("1d10t", "l0s3r"), ("i d i o t", "l o s e r"), ("idiooot", "moroooon"), ("m.o.r.o.n", "s_c_u_m"), ("p@th3tic", "$cum")])]
    rows += [(20, f"{clean} such a m o r o n {clean} y o u l o s e r"), (21, f"{clean} i d i o t  m o r o n {clean}")]
    rows += [(90, None), (91, ""), (92, "x" * 40000), (93, "!!! ??? 123 | |")]
    docs = spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, score double")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id", "score"]).collect()}
    assert all(got[i] >= 0.7 for i in (*range(1, 6), 20, 21)) and all(got[i] < 0.5 for i in (0, 90, 91, 92, 93)), got


def test_viterbi_finds_the_cheapest_path(model):
    p = Params()
    restore = Restorer(model.letters, p)
    for text in ("1d10t", "aab-b1", "thhhe", "s0m3"):
        best = None
        for path in itertools.product(*lattice(text, p)):
            word = "".join(x for x, _ in path)
            total = sum(c for _, c in path) - model.letters.score([f" {word} "])[0][0, 0]
            if best is None or total < best[0]:
                best = (total, word)
        assert restore(text) == best[1]


def test_long_words_take_time_in_proportion(model):
    """A quarter of a megabyte of base64, of letters that stand apart, and of signs with several readings."""
    rng = random.Random(5)
    restore = Restorer(model.letters, Params())
    began = time.perf_counter()
    coded = base64.b64encode(rng.randbytes(190_000)).decode().lower()
    spelled = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(125_000))
    assert toxicity.suspicious(coded) and len(restore(coded)) > 150_000
    assert "".join(restore.apart([spelled])[0]) == spelled
    assert restore("a" + "1!" * 10_000)
    assert time.perf_counter() - began < 60
    assert toxicity.core(b"x" + b"!" * 1_000_000 + b"y") == "x" + "!" * 1_000_000 + "y"


def test_words_beside_each_other_do_not_matter(model):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeil0134578@$!|.-é") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    restore = Restorer(model.letters, Params())
    together = restore.many(words, together=64, ahead=100)
    assert together == [Restorer(model.letters, Params(), most=10)(w) for w in words]


def test_repeated_rows(spark, model):
    docs = spark.createDataFrame([(1, "such an 1d10t"), (1, "such an 1d10t"), (None, "such an 1d10t")], "doc_id long, text string")
    got = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(got) == 3 and len({r.score for r in got}) == 1


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    m = toxicity.train(docs, labels)
    assert [r.predicted for r in toxicity.score(docs, m, ["doc_id"]).collect()] == [0, 0]
    assert toxicity.score(docs.where("false"), m, ["doc_id"]).count() == 0
    assert np.isfinite(m.weights).all()


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    """Of 40,000 labelled documents all are counted, and the weights are those of Newton steps over every one."""
    docs = spark.range(40_000).selectExpr("id doc_id", "if(id % 10 = 0, 'vile words', 'kind words') text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 10 = 0) toxic")
    seen = []
    monkeypatch.setattr(toxicity, "logistic", lambda x, f=toxicity.logistic: seen.append(x.agg({"n": "sum", "toxic": "sum"}).first()) or f(x))
    m = toxicity.train(docs, labels)
    assert sorted(seen[0]) == [4_000, 40_000]
    table = spark.createDataFrame([(0.0, 6, 1), (2.5, 3, 1), (4.0, 4, 4)], "evidence double, n long, toxic long")
    w = toxicity.logistic(table)
    x, n, y = (np.array(c) for c in ([0.0, 2.5, 4.0], [6, 3, 4], [1, 1, 4]))
    rest = y - n * toxicity.score_of(w, x[:, None])
    assert abs(rest.sum() - 1e-6 * w[0]) < 1e-6 and abs((rest * x).sum() - 0.05 * w[1]) < 1e-6
    assert [r.predicted for r in toxicity.score(docs.where("doc_id in (0, 1)"), m, ["doc_id"]).orderBy("doc_id").collect()] == [1, 0]


def test_only_names_of_enough_toxic_documents_are_counted_in_the_others(spark, monkeypatch):
    rows = [(i, f"idiot text{i} plain words", 1) for i in range(20)] + [(100 + i, f"other clean{i} plain", 0) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    known = spark.createDataFrame([(t, x) for _, t, x in rows], "text string, toxic int")
    counted, plain = [], toxicity._frequent
    monkeypatch.setattr(toxicity, "_frequent", lambda *a: counted.append(plain(*a)) or counted[-1])
    words, begins = toxicity._evidence(known, Params())
    of = lambda toxic, clean: math.log(max(toxic - 1.5 * math.sqrt(toxic), 0.05) / 21) - math.log((clean + 0.5) / 301)
    assert words == pytest.approx({"idiot": of(20, 0), "words": of(20, 0), "plain": of(20, 300)})
    assert set(begins) == {"idio", "idiot", "word", "words"}
    assert {r["name"] for r in counted[1].collect()} == {"plain", "plain^", "plai^"}
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    assert toxicity.train(docs, labels).evidence == pytest.approx(words)
