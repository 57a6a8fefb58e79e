import duckdb
import pytest

from arbora.llm import queries
from arbora.llm.rollup import Rollup, changes

SF = "/root/testdata/sf0.01"


def rows(spark, data):
    return spark.createDataFrame([(*r, "x") for r in data], "source string, lang string, tokenizer string, old_tokens long, tokens long, documents string")


def test_commits_once_and_adds_up(spark, tmp_path):
    store = Rollup(spark, f"file://{tmp_path}/totals")
    assert store.totals().count() == 0
    came = changes(inserted=rows(spark, [("a", "en", "v1", None, 5), ("a", "en", "v1", None, None), (None, None, "v1", None, 7)]))
    assert store.commit("one", came) and not store.commit("one", came)
    assert store.commit("two", changes(deleted=rows(spark, [("a", "en", "v1", None, 5)]), revised=rows(spark, [(None, None, "v1", 7, 9)])))
    want = {("a", "en", "v1", 1, 0), (None, None, "v1", 1, 9)}
    assert {tuple(r) for r in store.totals().collect()} == want
    store.compact()
    assert {tuple(r) for r in store.totals().collect()} == want and not store.commit("one", came)
    assert store.commit("three", changes(deleted=rows(spark, [("a", "en", "v1", None, 0)])))
    assert store.commit("empty", changes(inserted=rows(spark, [])))
    store.compact()
    assert {tuple(r) for r in store.totals().collect()} == {(None, None, "v1", 1, 9)}
    with pytest.raises(ValueError, match="name"):
        store.commit("../x", came)
    with pytest.raises(ValueError, match="needs"):
        changes()


def test_compactions_crashes_and_races_lose_nothing(spark, tmp_path):
    store = Rollup(spark, f"file://{tmp_path}/totals")
    one = lambda n: changes(inserted=rows(spark, [("a", "en", "v1", None, n)]))
    tokens = lambda: [r.tokens for r in store.totals().collect()]
    assert store.commit("a", one(5))
    store.compact()
    assert store.commit("d", one(7))
    store.compact()
    store.compact()
    assert tokens() == [12] and store.committed("a") and store.committed("d")
    lost = store._write(one(100).groupBy("source", "lang", "tokenizer").sum("documents", "tokens"))  # no entry names it
    assert tokens() == [12] and (tmp_path / "totals" / lost).exists()
    number, _, live = store._log()
    assert store._publish(number, "e", store._write(one(1).select("source", "lang", "tokenizer", "documents", "tokens")), [])
    assert not store._publish(number, None, lost, live)  # its number is taken
    assert tokens() == [13] and not store.commit("e", one(1)) and store.commit("f", one(2)) and tokens() == [15]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.OP5_SQL)
    names = [c[0] for c in cur.description]
    got = queries.op5_rollup(spark, SF)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in got.collect())
