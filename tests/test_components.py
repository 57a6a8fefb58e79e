"""Components against reachability by hand, layered solving against sweeps over the whole graph."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from arbora.operators import components, graph, settling, tally
from arbora.plans import queries as q
from arbora.plans import solving
from arbora.plans.tables import stored
from tests.test_journeys import SF, rows

EDGES = "node string, stm string, move string, child string, bucket int, n long, ww long, d long"


def made(links, seed=0, more=1):
    """Edges of two bands with counts that the seed gives; a node ending in an even number is White's. Every node also ends."""
    rng = random.Random(seed)
    nodes = sorted({x for pair in links for x in pair})
    out = []
    for a, b in sorted(links) + [(x, None) for x in nodes]:
        for band in (3, 4):
            n = rng.randrange(50, 400) * more
            w = rng.randrange(0, n)
            out.append((a, "wb"[int(a[1:]) % 2], f"to {b}" if b else "(TERM)", b, band, n, w, rng.randrange(0, n - w)))
    return out


def reach(links):
    nodes = {x for pair in links for x in pair}
    far = {x: {x} for x in nodes}
    while True:
        more = {x: far[x].union(*(far[b] for a, b in links if a in far[x])) for x in nodes}
        if more == far:
            return far
        far = more


def test_components_and_layers_by_hand(spark):
    rng = random.Random(5)
    links = set()
    for g in range(4):  # several graphs of their own, from sparse to dense
        links |= {(f"n{g * 20 + rng.randrange(9)}", f"n{g * 20 + rng.randrange(9)}") for _ in range(4 + 3 * g)}
    links |= {(f"n{200 + i}", f"n{200 + (i + 1) % 4}") for i in range(4)} | {("n5", "n200"), ("n203", "n300"), ("n300", "n301")}
    edges = spark.createDataFrame(made(links), EDGES)
    far = reach(links)
    want = {x: min(y for y in far[x] if x in far[y]) for x in far}
    found = components.strong_components(edges)
    got = {r.node: (r.component, r.size) for r in found.collect()}
    assert got == {x: (c, sum(v == c for v in want.values())) for x, c in want.items()}
    height = dict.fromkeys(want.values(), 0)
    for _ in height:
        for a, b in links:
            if want[a] != want[b]:
                height[want[a]] = max(height[want[a]], height[want[b]] + 1)
    assert {r.component: r.layer for r in components.layers(edges, found).collect()} == height


def fixed(edges, found, tolerance):
    """One more sweep over the whole graph, as graph.backup() computes it, moves nothing and picks the same."""
    rows = graph.verify(edges, found, tolerance).collect()
    return len(rows) == found.count() and all(r.within and r.same_pick for r in rows)


def test_solved_components_are_a_fixed_point(spark):
    links = {("n0", "n1"), ("n1", "n2"), ("n2", "n1"), ("n2", "n3")}
    edges = stored(spark.createDataFrame(made(links, 2), EDGES), "edges")
    found, census = components.solve_by_component(edges, 2e-2)
    assert fixed(edges, stored(found, "found"), 2e-2)
    facts = {r.component: r for r in census.collect()}
    assert {c: (r["size"], r.layer) for c, r in facts.items()} == {"n0": (1, 2), "n1": (2, 1), "n3": (1, 0)}
    assert all(r.sweeps == 1 and r.backups == 2 for c, r in facts.items() if c != "n1")
    assert facts["n1"].sweeps > 1 and facts["n1"].backups <= facts["n1"].sweeps * 4


def test_only_the_restless_component_is_frozen(spark):
    """One component passes most on to itself and moves for long; the other mostly ends and settles at once."""
    slow = [("n0", "w", "a", "n1", 3, 300, 10, 0), ("n1", "b", "b", "n0", 3, 300, 100, 10), ("n0", "w", "(TERM)", None, 3, 60, 60, 0)]
    quick = [("n2", "w", "a", "n3", 3, 10, 5, 0), ("n3", "b", "b", "n2", 3, 10, 5, 0), ("n2", "w", "(TERM)", None, 3, 90000, 45000, 0), ("n3", "b", "(TERM)", None, 3, 90000, 45000, 0)]
    _, census = components.solve_by_component(spark.createDataFrame(slow + quick, EDGES), 2e-2, freeze_after=2)
    facts = {r.component: r for r in census.collect()}
    assert facts["n0"].frozen and not facts["n2"].frozen
    assert facts["n2"].sweeps <= 2 < facts["n0"].sweeps
    assert facts["n2"].backups < facts["n0"].backups
    total = components.census_totals(spark.createDataFrame(list(facts.values()), census.schema)).first()
    assert (total.components, total.cyclic, total.largest, total.slowest, total.frozen) == (2, 2, 2, facts["n0"].sweeps, 1)


def test_an_added_month_equals_a_rebuild(spark):
    links = {("n0", "n1"), ("n0", "n3"), ("n3", "n4")}
    edges = stored(spark.createDataFrame(made(links, 1), EDGES), "edges")
    delta = spark.createDataFrame([("n3", "b", "to n4", "n4", 3, 500, 400, 10), ("n3", "b", "to n9", "n9", 4, 700, 100, 0), ("n9", "b", "(TERM)", None, 4, 700, 100, 0)], EDGES)
    values = stored(components.solve_by_component(edges, 1e-6)[0], "values")
    new, found, census = components.add_month(edges, values, delta, 1e-6)
    assert fixed(new, stored(found, "found"), 1e-6)
    assert {r.component for r in census.collect()} == {"n0", "n3", "n9"}
    summed = lambda t: sorted(map(tuple, t.groupBy(*tally.KEY).agg(F.sum("n"), F.sum("ww"), F.sum("d")).collect()), key=str)
    assert summed(new) == summed(edges.unionByName(delta))


def test_empty_graph(spark):
    none = spark.createDataFrame([], EDGES)
    found, census = components.solve_by_component(none)
    assert found.count() == census.count() == components.strong_components(none).count() == 0


@pytest.mark.parametrize("name", ["staged_components", "month_reclassed"])
def test_queries_equal_duckdb(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    cur = con.execute(q.SQL[name])
    got = getattr(solving, name)(spark, SF)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows([c[0] for c in cur.description], cur.fetchall())


def test_parts_settled_in_tasks_equal_joins(spark, monkeypatch):
    """The same values, picks and counts of sweeps, whether bands are settled within tasks or by joins over all rows."""
    edges = stored(spark.createDataFrame(made({("n0", "n1"), ("n1", "n2"), ("n2", "n1"), ("n1", "n1"), ("n2", "n0"), ("n2", "n3")}, 4), EDGES), "edges")

    def got():
        values, census = components.solve_by_component(edges, 1e-4, freeze_after=3)
        both = [values, graph.solve(edges, 500, 1e-9, 5)]
        return [{(r.node, r.bucket): (r.best_move, round(r.eval_w, 6), round(r.eval_b, 6)) for r in x.collect()} for x in both], sorted(map(tuple, census.collect()))

    asked = []
    monkeypatch.setattr(graph, "step", lambda *a, f=graph.step: asked.append(1) or f(*a))
    here = got()
    assert not asked  # no job by joins for a small graph
    monkeypatch.setattr(settling, "MOST_ROWS", 0)
    assert got() == here and asked


def test_backups_by_component_equal_those_of_the_whole_graph(spark, monkeypatch):
    """Loops, cycles, single nodes above and beneath them, within tasks and by joins, before they have settled."""
    links = {("n0", "n1"), ("n1", "n2"), ("n2", "n1"), ("n2", "n2"), ("n2", "n3"), ("n4", "n0"), ("n4", "n3"), ("n5", "n5"), ("n5", "n4"), ("n3", "n6")}
    edges = stored(spark.createDataFrame(made(links, 6, 50), EDGES), "edges")
    got = lambda t: {(r.node, r.stm, r.bucket): (r.best_move, round(r.eval_w, 9), round(r.eval_b, 9)) for r in t.collect()}
    want = got(graph.solve(edges, 9))
    assert got(components.backups_by_component(edges, 9)) == want
    monkeypatch.setattr(settling, "MOST_ROWS", 12)
    assert got(components.backups_by_component(edges, 9)) == want
    assert components.backups_by_component(spark.createDataFrame([], EDGES), 3).count() == 0


def test_unsettled_values_equal_duckdb(spark):
    """At this size one band has not settled after the SQL's sweeps."""
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    cur = con.execute(q.SQL["solve_by_component"])
    got = solving.solve_by_component(spark, sf)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows([c[0] for c in cur.description], cur.fetchall())
