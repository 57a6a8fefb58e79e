"""Every query against DuckDB, golden values of the ranking rule, and game headers."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import AGG, TERM
from arbora.operators import analysis, checks, graph, settling, simulate, tally, targets, view
from arbora.plans import policies
from arbora.plans import queries as q
from arbora.sources import pgn, tallies
from arbora.streaming.service import allowances, counter_totals, replayed, spend, strict_reports, strict_totals

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("customer", "orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(names, data):
    return sorted(str([round(v, 5) + 0.0 if isinstance(v, float) else v for v in (dict(zip(names, r, strict=True))[n] for n in sorted(names))]) for r in data)


#: Minutes each; tests/test_components.py solves small graphs instead.
LONG = {"solve_by_component", "component_census", "month_added"}


@pytest.mark.parametrize("name", sorted(set(q.SQL) - LONG))
def test_equals_duckdb(spark, duck, name):
    cur = duck.execute(q.SQL[name])
    names = [c[0] for c in cur.description]
    got = q.ALL[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, cur.fetchall())


@pytest.mark.parametrize(
    ("value", "evidence", "prior", "kish", "band", "want"),
    [(0.55, 1000, 0.53, 1400, 4, (440.391676867, 0.542989736, 0.011473861)), (0.80, 4, 0.5, 10, 4, (9.846743295, 0.527368053, 0.042201407)), (0.60, 20, 0.5, 0, 8, (0, 0.54, 0.04472136))],
)
def test_golden_values(spark, value, evidence, prior, kish, band, want):
    row = spark.createDataFrame([(value, float(evidence), prior, float(kish), band, 0.5)], "v double, e double, p double, k double, b int, c double")
    s = R.effective_strength(F.col("b"), F.col("k"))
    got = row.select(s, R.score(F.col("v"), F.col("e"), F.col("p"), s, F.col("c")), R.deviation(F.col("e"), s, F.col("k"))).first()
    assert tuple(got) == pytest.approx(want, abs=1e-8)


def test_bands(spark):
    got = spark.createDataFrame([(x,) for x in (999, 1000, 1199, 1200, 2399, 2400)], "r int").select(R.rating_band(F.col("r"))).collect()
    assert [r[0] for r in got] == [0, 1, 1, 2, 7, 8]


def test_classes_at_their_limits(spark):
    edges = spark.createDataFrame([(str(n), "w", "x", None, 0, n, 0, 0) for n in (49, 50, 149, 150)], "node string, stm string, move string, child string, bucket int, n long, ww long, d long")
    assert {r.node: r["class"] for r in tally.classify(edges).collect()} == {"49": "DROPPED", "50": "LEAF", "149": "LEAF", "150": "FULL"}
    assert [r.node for r in tally.merge([edges.where("n < 100")], 50).collect()] == ["50"]


def test_solution_settles(spark):
    edges = q._edges(spark, SF)
    a = graph.solve(edges, 80, 1e-4)
    sums = graph.band_sums(edges)
    b = graph.backup(edges, sums, graph.neighbour_prior(sums), a)
    pairs = a.join(b.select("node", "bucket", F.col("eval_w").alias("w")), ["node", "bucket"]).collect()
    assert max(abs(r.eval_w - r.w) for r in pairs) < 1e-3


CYCLE = [("w:a", "w", "x", "b:a", 4, 400, 260, 40), ("w:a", "w", "(TERM)", None, 4, 1500, 750, 1), ("b:a", "b", "x", "w:a", 4, 390, 180, 10), ("b:a", "b", "y", "w:b", 4, 90, 30, 1), ("b:a", "b", "(TERM)", None, 4, 1500, 500, 1), ("w:b", "w", "x", "b:a", 4, 30, 20, 0), ("w:b", "w", "y", "gone", 4, 50, 20, 5), ("w:b", "w", "(TERM)", None, 4, 376, 0, 1)]


def by_hand(edges, sweeps):
    """The same values in plain Python, for one band: no neighbours, so no prior."""
    cnt, value = {}, {}
    for node, _, _, _, _, n, _, _ in edges:
        cnt[node] = cnt.get(node, 0) + n
    value = {node: (0.5, 0.5) for node in cnt}
    for _ in range(sweeps):
        new = {}
        for node in cnt:
            own = [(move, *([*value[child], cnt[child]] if child in cnt else [(ww + d / 2) / n] * 2 + [n]), n) for at, _, move, child, _, n, ww, d in edges if at == node]
            crowd = [sum(x[-1] * x[k] for x in own) / cnt[node] for k in (1, 2)]
            s = 0 if node[0] == "w" else 1
            sign = 1 - 2 * s
            score = {x[0]: ((x[3] * x[1 + s] + 30 * crowd[s]) / (x[3] + 30), 0.5 * x[3] ** 0.5 / (x[3] + 30)) for x in own if x[0] != "(TERM)"}
            best = max(score, key=lambda m: sign * score[m][0] - 2 * score[m][1])
            crowd[s] = score[best][0]
            new[node] = tuple(crowd)
        value = new
    return value


def test_converged_values_are_the_fixed_point(spark):
    edges = spark.createDataFrame(CYCLE, "node string, stm string, move string, child string, bucket int, n long, ww long, d long")
    want = by_hand(CYCLE, 200)
    assert max(abs(x - y) for k in want for x, y in zip(want[k], by_hand(CYCLE, q.SWEEPS)[k], strict=True)) > 1e-3
    got = {r.node: (r.eval_w, r.eval_b) for r in graph.settled(edges).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)
    sums = graph.band_sums(edges)
    for move in "xy":
        frozen = spark.createDataFrame([("w:b", 4, move), ("w:a", 4, "x"), ("b:a", 4, "x")], "node string, bucket int, best_move string")
        kept = graph.backup(edges, sums, graph.neighbour_prior(sums), None, frozen).where("node = 'w:b'")
        assert [r.best_move for r in kept.collect()] == [move]
    with pytest.raises(RuntimeError, match="still move"):
        graph.solve(edges, 2, 1e-6)


def test_bounds_that_differ_by_rounding_only_tie(spark):
    """The first move is picked, as in the SQL, by picks(), by the sweeps' joins and within a task."""
    ranked = spark.createDataFrame([("a", 0, "w", "y", 0.1 + 0.2, 1.0), ("a", 0, "w", "x", 0.3, 2.0)], "node string, bucket int, stm string, move string, bound double, score double")
    assert graph.picks(ranked).first().best_move == "x"
    moves = [("y", 0.1 + 0.2, 0.5, 100.0, 10.0, 0.1), ("x", 0.3, 0.5, 100.0, 10.0, 0.1)]
    one = spark.createDataFrame([("w", 0.5, 0.2, 0.2, moves)], "stm string, own double, chance_w double, chance_b double, moves array<struct<move: string, value: double, prior: double, evidence: double, strength: double, sd: double>>")
    assert graph.valued(one).first().best_move == "x"
    fact = {"node": "a", "stm": "w", "bucket": 0, "via": "a", "own": 0.5, "inside": False, "prior": 0.5, "evidence": 100.0, "strength": 10.0, "sd": 0.1}
    part = [fact | {"move": m, "n": 5, "x_w": v, "x_b": v, "real": True, "self": False} for m, v in (("y", 0.1 + 0.2), ("x", 0.3))]
    part.append(fact | {"move": None, "n": 0, "x_w": 0.0, "x_b": 0.0, "real": False, "self": True})
    assert settling.sweeps(pd.DataFrame(part), 1e-6, 10, 10, False).best_move.tolist() == ["x"]


def test_every_new_query_has_sql():
    assert {policies.playout_arms.__name__, "policy_plan", "verify_counters", "rate_limit_decisions"} <= q.SQL.keys()


def test_draws_are_even_and_unrelated(spark):
    two = spark.range(20_000).select(analysis.uniform(F.lit(0), F.col("id"), F.lit(0), F.lit(0)).alias("a"), analysis.uniform(F.lit(0), F.col("id"), F.lit(31), F.lit(0)).alias("b"))
    r = two.agg(F.avg("a").alias("m"), F.var_pop("a").alias("v"), F.corr("a", "b").alias("c"), F.avg(((F.col("a") < 0.2) & (F.col("b") < 0.2)).cast("int")).alias("both")).first()
    assert abs(r.m - 0.5) < 0.01 and abs(r.v - 1 / 12) < 0.003 and abs(r.c) < 0.03 and abs(r.both - 0.04) < 0.006


def test_hero_flow_names_every_sink(spark):
    """Masses by hand: the hero (w) moves from r; at b:x the crowd replies."""
    schema = "node string, stm string, move string, child string, bucket int, n long, ww long, d long"
    rows = [("w:r", "a", "b:x", 6), ("w:r", "c", "b:y", 2), ("w:r", "e", "b:z", 2), ("b:x", "t", "w:T", 5), ("b:x", "u", "w:O", 2), (("b:x"), TERM, None, 2), ("b:x", AGG, None, 1), ("b:y", "t", "w:T", 3), ("b:z", "o", "w:O", 9)]
    edges = spark.createDataFrame([(n, n[0], m, c, 0, k, 0, 0) for n, m, c, k in rows] + [("b:y", "b", "t", "w:T", 1, 4, 0, 0), ("w:r", "w", "e", "b:z", 2, 4, 0, 0), ("w:r", "w", "a", "b:x", 3, 1, 0, 0), ("w:r", "w", TERM, None, 3, 3, 0, 0)], schema)
    layers = targets.target_layers(edges, "w:r", "w:T", 2)
    book = edges.where("node <> 'b:y'")

    def flow(policy, plan=None, **more):
        got = {}
        for r in targets.hero_flow(edges, book, layers, 2, policy, plan, **more).collect():
            got.setdefault(r.bucket, {})[r.sink] = round(r.mass, 9)
        assert all(abs(sum(x.values()) - 1) < 1e-9 for x in got.values()) and len(got) == 9
        return got

    field = flow("field")
    assert field[0] == {"arrived": 0.375, "crowd_deviated": 0.15, "ended": 0.15, "pooled": 0.075, "off_book": 0.25}
    assert field[2] == field[5] == {"hero_unplayed": 1.0} and field[3] == {"band_dry": 1.0}
    assert flow("field", endings=True)[3] == {"ended": 0.75, "band_dry": 0.25}
    best = flow("best")
    assert best[0] == {"arrived": 0.5, "crowd_deviated": 0.2, "ended": 0.2, "pooled": 0.1} and best[1] == {"band_dry": 1.0}
    assert flow("plan", ["e", "c"])[0] == {"off_book": 1.0} and flow("plan", ["e"])[0] == {"hero_stuck": 1.0}
    values = {r.bucket: r.value for r in targets.policy_values(edges, layers, 2, "best", book=book).where("ply = 0").collect()}
    assert all(abs(values[b] - best[b].get("arrived", 0.0)) < 1e-9 for b in values)
    assert targets.hero_flow(edges, book, targets.target_layers(edges, "w:r", "w:nowhere", 2), 2, "field").count() == 0


def test_playouts_count_every_stop(spark):
    """One band, whole numbers: each arm meets the stop that its moves lead to."""
    data = [("w:r", "w", "a", "b:a", 10), ("w:r", "w", "b", "b:gone", 30), ("w:r", "w", TERM, None, 5), ("b:a", "b", AGG, None, 4), ("b:a", "b", "c", "w:c", 6), ("w:c", "w", TERM, None, 6)]
    edges = spark.createDataFrame([(*x[:4], 0, x[4], 2, 1) for x in data], "node string, stm string, move string, child string, bucket int, n long, ww long, d long")
    picks = spark.createDataFrame([("w:r", 0, "a"), ("w:c", 0, None)], "node string, bucket int, best_move string")
    got = {r.arm: r for r in simulate.playouts(edges, picks, "w:r", 400, 5).collect()}
    stops = {arm: {x: r[f"stop_{x}"] for x in simulate.STOPS if r[f"stop_{x}"]} for arm, r in got.items()}
    assert stops["popular"] == {"unseen_child": 400} and stops["policy"].keys() == {"pooled", "no_move"} and stops["crowd"].keys() == {"ended", "pooled", "unseen_child"}
    assert all(r.sims == 400 == r.wins + r.draws + r.losses for r in got.values()) and got["popular"].mean_plies == 1
    capped = simulate.playouts(edges, picks, "w:r", 50, 1).where("arm = 'policy'").first()
    assert capped.stop_ply_cap == 50 and 0 <= capped.obs_hero <= 1 and capped.se == pytest.approx((max(0, (capped.wins + capped.draws / 4) / 50 - capped.obs_hero**2) / 50) ** 0.5)


def test_reach_has_no_cap(spark):
    chain = spark.createDataFrame([(f"w:{i}", "w", "x", f"w:{i + 1}", 0, 200, 1, 1) for i in range(70)] + [("w:70", "w", TERM, None, 0, 200, 1, 1)], "node string, stm string, move string, child string, bucket int, n long, ww long, d long")
    got = graph.reachable(chain, tally.classify(chain), "w:0")
    assert got.count() == 71 and got.agg(F.max("depth")).first()[0] == 70
    assert graph.reachable(chain, tally.classify(chain), "w:0", 3).count() == 4
    assert checks.unreachable(chain, got).count() == 0


def test_forward_and_backward_odds_agree(spark):
    edges, layers = policies._layers(spark, SF)
    back = {r.bucket: r.value for r in targets.policy_values(edges, layers, policies.PLIES, "field").where(f"ply = 0 and node = '{q.ROOT}'").collect()}
    rows = targets.commitment(edges, layers, q.ROOT, policies.PLIES).collect()
    assert len(rows) == 9 and all(r.arrived == pytest.approx(back[r.bucket], abs=1e-9) and 0 < r.commitment <= 1 for r in rows)
    assert targets.target_layers(edges, "w:nowhere", q.TARGET, 3).count() == 0


def test_coverage_of_known_masses(spark):
    at = spark.createDataFrame([(0, f"n{i}", m) for i, m in enumerate([0.5, 0.3, 0.15, 0.05])] + [(1, f"n{i}", 0.01) for i in range(100)], "bucket int, node string, mass double")
    got = {r.bucket: (r.positions, r.cover50, r.cover90, r.cover99) for r in analysis.coverage(at).collect()}
    assert got == {0: (4, 1, 3, 4), 1: (100, 50, 90, 99)}


def test_sorted_rows_put_nulls_last(spark):
    rows = spark.createDataFrame([("n", 0, "a", 5, 1, 0.3), ("n", 0, "b", 9, None, None), ("n", 0, "c", 5, 0, 0.3), ("n", 0, "d", 7, None, 0.9)], "node string, bucket int, move string, n long, rank int, score double")
    order = lambda *x: [r.move for r in view.sorted_rows(rows, *x).orderBy("place").collect()]
    assert (order("rank"), order("rank", False)) == (["c", "a", "b", "d"], ["a", "c", "b", "d"])
    assert (order("score"), order("score", False), order("move", False)) == (["d", "a", "c", "b"], ["a", "c", "d", "b"], ["d", "c", "b", "a"])


def test_files_come_back(spark, tmp_path):
    edges = q._edges(spark, SF, keep=True)
    for month, part in (("a/agg-1", edges.where("bucket < 4")), ("b/agg-2", edges.where("bucket >= 4")), ("b/other", edges)):
        tallies.write_sorted(part, f"{tmp_path}/{month}")
    back = tallies.read(spark, f"{tmp_path}/a", f"{tmp_path}/b/")
    assert sorted(map(tuple, back.select(*edges.columns).collect()), key=str) == sorted(map(tuple, edges.collect()), key=str)
    edges, depths = policies._subtree(spark, SF)
    nodes, kinds = tallies.subtree_nodes(edges, depths), analysis.edge_kinds(edges, depths)
    tallies.write_subtree(nodes, tallies.subtree_moves(edges, edges, kinds), f"{tmp_path}/tree")
    meta = {r.what: r.n for r in spark.read.json(f"{tmp_path}/tree/meta").collect()}
    moves = spark.read.parquet(f"{tmp_path}/tree/moves")
    assert meta["nodes"] == nodes.count() and sum(n for k, n in meta.items() if k.isupper()) == moves.count() and len(moves.first().o_count) == 9
    ends = nodes.orderBy("move_start").collect()
    assert [r.move_start for r in ends] == [sum(x.n_moves for x in ends[:i]) for i in range(len(ends))]
    pooled = policies._pooled_edges(spark, SF)
    tallies.write_simulation(simulate.simulation_table(pooled, policies._one_backup(pooled), policies.TOP, 20, 4), f"{tmp_path}/sim")
    csv = spark.read.option("header", True).csv(f"{tmp_path}/sim")
    assert csv.count() == 27 and {"stop_ply_cap", "pred_hero", "se"} <= set(csv.columns)


def game(white="1500", black="1520", tc="300+3", result="1-0", more="", moves="1. e4 { [%clk 0:05:00] } 1... e5 2. Nf3! Nc6 1-0"):
    return f'[Event "x"]\n[WhiteElo "{white}"]\n[BlackElo "{black}"]\n[TimeControl "{tc}"]\n{more}[Result "{result}"]\n\n{moves}\n\n'


def test_games_from_text(spark, tmp_path):
    cases = [game(), game("1500", "1700"), game("1500", "1701"), game(tc="179+1"), game(tc="180+0"), game(tc="-"), game(result="*"), game("?"), game(more='[WhiteTitle "BOT"]\n'), game(more='[WhiteTitle "GM"]\n'), game(more='[WhiteRatingDiff "+39"]\n'), game(more='[BlackRatingDiff "-40"]\n'), game("999", "1000").replace("\n", "\r\n")]
    (tmp_path / "games.pgn").write_bytes("".join(cases[:-1]).encode() + cases[-1].encode())
    found = pgn.games(spark, str(tmp_path))
    assert found.count() == len(cases)
    kept = analysis.header_filter(found.withColumn("game_id", F.concat_ws(" ", "white_elo", "black_elo", "time_control", "white_title", "white_diff")))
    assert sorted((r.game_id, r.bucket) for r in kept.collect()) == sorted([("1500 1520 300+3", 3), ("1500 1700 300+3", 4), ("1500 1520 180+0", 3), ("1500 1520 300+3 GM", 3), ("1500 1520 300+3 +39", 3), ("999 1000 300+3", 0)])
    moves = pgn.san_moves(found.limit(1)).orderBy("ply").collect()
    assert [(r.ply, r.san) for r in moves] == [(0, "e4"), (1, "e5"), (2, "Nf3"), (3, "Nc6")]


def test_allowance_and_counters(spark):
    tokens = 40.0
    for _ in range(40):
        tokens, allowed, _ = spend(tokens, 5.0, 5.0)
        assert allowed
    assert spend(tokens, 5.0, 5.0) == (0.0, False, 0.125)
    got = counter_totals(spark.createDataFrame([("pl=412,ch=3,cm=1",), ("ch=2,zz=x,=4",), (None,)], "header string")).collect()
    assert {r.k: r.total for r in got} == {"pl": 412, "ch": 5, "cm": 1}


def test_counter_headers(spark):
    fine = ["pl=412,ch=3,cm=1", "zz=1", "zz=1,zz=2", "ws=1,wn=1", "pl=600000,ch=10000"]
    bad = ["", None, "ch=1,ch=2", "ws=2,wn=1", "=1", "ch=10001", "pl=600001", "ch=1,", "ch", "ch=", "ch=-1", "ch= 1", "ch=1234567890", "zz=" + "1" * 8 + ",y=1" * 62]
    rows = spark.createDataFrame([(x,) for x in fine + bad], "header string")
    got = strict_reports(rows).collect()
    assert [r.accepted for r in got] == [True] * len(fine) + [False] * len(bad) and all((r.counts is not None) == r.accepted for r in got)
    assert {r.k: r.total for r in strict_totals(rows).collect()} == {"pl": 600412, "ch": 10003, "cm": 1, "ws": 1, "wn": 1}


def test_allowances_as_a_stream_and_as_a_table(spark, tmp_path):
    times = [("a", 5.0)] * 41 + [("b", 1.0 + i / 100) for i in range(60)] + [("a", 5.2)] * 2
    want, state = [], {}
    for c, at in sorted(times):
        tokens, seen = state.get(c, (40.0, at))
        tokens, allowed, wait = spend(tokens, seen, at)
        state[c] = (tokens, at)
        want.append((c, at, allowed, pytest.approx(wait)))
    frame = spark.createDataFrame(times, "client string, at double").repartition(5)
    key = lambda r: (r[0], r[1], not r[2], r[3])
    assert sorted(map(tuple, replayed(frame).collect()), key=key) == want and sum(not w[2] for w in want) > 10
    frame.write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # a client's requests come in several batches
    stream = allowances(spark.readStream.schema("client string, at double").parquet(f"{tmp_path}/in"))
    stream.writeStream.format("memory").queryName("decisions").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination(120)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, spark.table("decisions").collect()), key=key) == want


def test_compressed_games_and_ply_window(spark, tmp_path):
    import zstandard

    body = game(moves=" ".join(f"{i + 1}. Nf3 Nf6 {i + 1}... Ng1" if i % 2 else f"{i + 1}. Nf3 Nf6" for i in range(30)) + " 1-0")
    (tmp_path / "games.pgn.zst").write_bytes(zstandard.ZstdCompressor().compress((game() + body).encode()))
    found = pgn.games(spark, str(tmp_path))
    assert found.count() == 2 and {r.n for r in pgn.san_moves(found).groupBy("game_id").agg(F.count("*").alias("n")).collect()} == {4, 40}


def test_flagged_moves(spark):
    lines = spark.createDataFrame([("# note",), ("",), ("w:^ | click | too thin",)], "value string")
    assert [tuple(r) for r in analysis.flagged_moves(lines).collect()] == [("w:^", "click", "too thin")]
    with pytest.raises(Exception, match="node"):
        analysis.flagged_moves(spark.createDataFrame([("a | b",)], "value string")).collect()
