"""Every stage of the pipeline against a plain version of it, on its own input."""

import zlib
from collections import Counter

import pytest

import corpus_pipeline as cp
from arbora.llm import langid, tokens
from tests.llm.test_mixing import water
from tests.llm.test_repeats import brute as brute_repeats
from tests.llm.test_setsketch import brute as brute_near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        found.append((docs.toPandas(), out.toPandas()))
        docs = out
    return found


def plain(frame):
    return [(int(r.doc_id), r.text) for r in frame.itertuples()]


def test_columns(stages):
    for _, out in stages[:-1]:
        assert list(out.columns) == cp.COLUMNS


def test_languages(spark, stages):
    before, after = stages[0]
    truth = dict(zip(before.doc_id, before.lang, strict=True))
    assert len(after) >= 0.97 * before.text.str.contains(r"[^\W\d_]", na=False).sum()
    assert sum(truth[r.doc_id] == r.lang for r in after.itertuples()) >= 0.97 * len(after)
    junk = spark.createDataFrame([(900001, "12 34 ...", "en", "s", 9), (900002, "漢字仮名交じり文の例です" * 20, None, "s", 240), (900003, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.identify_languages(spark, spark.read.parquet(f"{SF}/documents.parquet").select(*cp.COLUMNS).union(junk), SF)
    assert kept.where("doc_id > 900000").count() == 0 and langid.UNKNOWN == "und"


def test_near_duplicates(stages):
    before, after = stages[1]
    want = brute_near(plain(before), 5)
    assert sorted(after.doc_id) == sorted(i for i in before.doc_id if want[i][1] == i)


def test_repeats(stages):
    before, after = stages[2]
    want = brute_repeats(plain(before), 100)
    assert sorted(after.doc_id) == sorted(i for i, (n, cut, _, _) in want.items() if cut == 0 or cut < n)
    for r in after.itertuples():
        n, cut, _, _ = want[r.doc_id]
        assert cut or r.text == dict(plain(before))[r.doc_id]
        assert len((r.text or "").encode()) <= n - cut


def test_mixing(stages):
    before, after = stages[3]
    words = lambda t: len((t or "").split())
    order = sorted(before.source.dropna().unique())
    size = [int(before[before.source == s].text.map(words).sum()) for s in order]
    for s, n in zip(order, water(size, [(5, 2, 1)[i % 3] for i in range(len(order))], 3), strict=True):
        assert after[after.source == s].text.map(words).sum() == pytest.approx(n, abs=1)
    assert max(Counter(after.doc_id).values()) <= 3


def test_packing(stages):
    before, after = stages[4]
    own = tokens.byte_bpe_50k()
    want, got = Counter(), Counter()
    for _, t in plain(before):
        want[len(own.ids(t or "")) + 1] += 1
    assert after.length.sum() == sum(n * k for n, k in want.items())
    for r in after[after.start == 0].itertuples():
        got[r.doc_tokens] += 1
    assert got == want
    assert after.groupby("sequence_id").length.sum().max() <= 2048 and zlib.crc32(b"") == 0


def test_run_and_empty(spark):
    assert cp.run(spark, SF).count() > 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_nulls_repeats_and_other_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    same = "a b c d e f g h"
    rows = [(5, None, "en", "s", 0, "x"), (5, "", "en", None, 0, "y"), (None, same, "en", "s", 15, "z"), (7, same, None, "s", 15, "z"), (8, same, "en", "s", 15, "z"), (8, None, "en", "s", None, "z")]
    docs = spark.createDataFrame(rows, schema)
    near, cut = cp.drop_near_duplicates(spark, docs, SF), cp.cut_repeats(spark, docs, SF)
    assert near.columns == cut.columns == cp.COLUMNS
    assert sorted(map(str, near.collect())) == sorted(map(str, docs.where("coalesce(doc_id, 0) <> 8").select(*cp.COLUMNS).collect()))
    assert sorted(map(str, cut.collect())) == sorted(map(str, docs.select(*cp.COLUMNS).collect()))
    none = docs.where("false")
    assert cp.drop_near_duplicates(spark, none, SF).count() == cp.cut_repeats(spark, none, SF).count() == 0
