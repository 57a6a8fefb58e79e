"""The filter audit against counting every order by hand."""

import re
from itertools import permutations

import duckdb
from pyspark.sql import functions as F

from arbora.llm import filter_audit, queries

DOCS = "doc_id long, text string, source string, lang string, mask int, class long"
LABELS = "doc_id long, quality int, toxic int, part string"


def by_hand(docs, labels):
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    rows = []
    for i, text, source, *_ in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, x in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t]), strict=True) if x}
        rows.append((source or "", fails, i in good, i in toxic))
    first = {}
    for part, fails, *_ in rows:
        for order in permutations("ABCDE"):
            hit = [f for f in order if f in fails]
            if hit:
                first[part, hit[0]] = first.get((part, hit[0]), 0) + 1
    out = set()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                alive = [r for r in own if not r[1] & before]
                gone = [r for r in alive if f in r[1]]
                out.add((part, "".join(order), k + 1, len(alive) - len(gone), len(gone), sum(f in r[1] and bool(r[1] & before) for r in own), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), first.get((part, f), 0)))
    return out


LONG = " ".join(f"w{i}" for i in range(70))
CASES = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG, "b"), (3, LONG, "b"), (None, LONG, "a"), (None, "only here", None), (4, "x " * 60, "a"), (5, None, "a"), (6, "", None), (7, LONG.upper(), "b"),
    (8, LONG + " $", ""), (9, LONG[:-1] + "x", "a"), (10, "é" * 3000 + LONG, "b"), (11, "é" * 3000 + LONG, "a"), (12, "é" * 20000 + LONG, "b"), (0, "é" * 20000 + LONG, "b"), (13, "A", "a"), (14, "A", "b"), (15, "no\x0bbreak\x85here", "c"),
]


def _tables(spark):
    docs = [(i, t, s, "xx", 7, 9) for i, t, s in CASES]
    labels = [(2, 1, 0, "p"), (2, 0, 1, "p"), (4, 0, 1, "p"), (7, 1, None, "p"), (99, 1, 1, "p"), (None, 1, 1, "p"), (14, 1, 0, "p")]
    return docs, labels, spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_audit_equals_counting_by_hand(spark):
    docs, labels, d, l = _tables(spark)
    found = filter_audit.audit(d, l)
    assert {tuple(r) for r in found.collect()} == by_hand(docs, labels)
    assert dict(found.dtypes)["kept"] == "bigint" and dict(found.dtypes)["step"] == "int"


def test_colliding_hashes_are_settled_by_the_texts(spark):
    docs, labels, d, l = _tables(spark)
    same = lambda text: F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))
    docs = [(i, f"{c}{'é' * 30}", "a", "xx", 7, 9) for i, c in enumerate("abcabcabdxyzq")] + docs
    d = spark.createDataFrame(docs, DOCS)
    assert {tuple(r) for r in filter_audit.audit(d, l, blocks=(8,), hashes=same).collect()} == by_hand(docs, labels)


def test_large_groups_of_copies_are_dealt(spark):
    docs = [(i, LONG if i % 3 else f"{LONG} {i}", "hot" if i % 5 else None, "xx", 7, 9) for i in range(3000)]
    found = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
    assert {tuple(r) for r in found.collect()} == by_hand(docs, [])


def test_empty_tables(spark):
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_sql_gives_the_same(spark, tmp_path):
    docs, labels, d, l = _tables(spark)
    kept = d.select("doc_id", "text", "source").toPandas()
    marks = l.select("doc_id", "quality", "toxic").toPandas()
    with duckdb.connect() as c:
        c.register("documents", kept)
        c.register("labels", marks)
        rows = c.execute(f"SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley FROM ({queries.OP11_SQL})").fetchall()
    assert set(rows) == by_hand(docs, labels)
