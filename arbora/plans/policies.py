"""Queries over targets, simulated games, checks, views and files, each with the same result in DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from arbora.functions.constants import COUNTERS
from arbora.operators import analysis as A
from arbora.operators import checks as C
from arbora.operators import graph as G
from arbora.operators import simulate as S
from arbora.operators import tally as T
from arbora.operators import targets as X
from arbora.operators import view as V
from arbora.plans.queries import CLASSES, GRAPH, ONE, ROOT, SHARES, SOLVE, SWEEPS, TARGET, TREE, _edges, _step_sql, _table, _with, query, rounded
from arbora.plans.queries import _BEST, _CAL, _POOL, _SPREAD, PRIOR, SUMS
from arbora.plans.tables import shared_dir, stored
from arbora.sources import flags, tallies
from arbora.streaming import service

PLIES, PLAN = 5, ["view", "purchase", "signup", "click"]
REAL = "move NOT IN ('(TERM)', '(AGG)')"
STEPS = f"steps AS (SELECT DISTINCT node, move, child FROM edges WHERE {REAL} AND child IS NOT NULL)"


def _layers_sql(n: int) -> list[str]:
    out = [STEPS, f"back AS (SELECT '{TARGET}' AS node, 0 AS d UNION SELECT s.node, b.d + 1 FROM back b JOIN steps s ON s.child = b.node WHERE b.d < {n})", "near AS (SELECT node, min(d) AS far FROM back GROUP BY node)", f"l0 AS (SELECT node FROM near WHERE node = '{ROOT}' AND far <= {n})"]
    out += [f"l{k} AS (SELECT DISTINCT s.child AS node FROM l{k - 1} l JOIN steps s USING (node) JOIN near n ON n.node = s.child AND n.far <= {n - k})" for k in range(1, n + 1)]
    out.append(f"a{n} AS (SELECT node FROM l{n} WHERE node = '{TARGET}')")
    return out + [f"a{k} AS (SELECT DISTINCT l.node FROM l{k} l JOIN steps s USING (node) JOIN a{k + 1} a ON a.node = s.child)" for k in range(n - 1, -1, -1)]


LAYERS = ["RECURSIVE " + GRAPH[0], *GRAPH[1:], *_layers_sql(PLIES), "layers AS (" + " UNION ALL ".join(f"SELECT {k} AS ply, l.node, a.node IS NOT NULL AS alive FROM l{k} l LEFT JOIN a{k} a ON a.node = l.node" for k in range(PLIES + 1)) + ")"]


def _layers(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    return edges, X.target_layers(edges, ROOT, TARGET, PLIES)


@query(_with(*LAYERS) + "SELECT * FROM layers")
def target_alive_layers(spark, sf_dir):
    return _layers(spark, sf_dir)[1]


@query(_with(*LAYERS) + "SELECT ply, count(*) AS enumerated, count(*) FILTER (alive) AS survivors, max(count(*)) OVER () AS widest FROM layers GROUP BY ply")
def target_census(spark, sf_dir):
    return X.census(_layers(spark, sf_dir)[1])


def _policy_sql(policy: str) -> list[str]:
    out = [SHARES, "bands AS (SELECT unnest(range(9))::INT AS bucket)", f"v{PLIES} AS (SELECT node, bucket, 1.0::DOUBLE AS value FROM a{PLIES}, bands)"]
    for k in range(PLIES - 1, -1, -1):
        met = f"a{k} a JOIN shares s USING (node) JOIN v{k + 1} v ON v.node = s.child AND v.bucket = s.bucket WHERE {REAL} AND left(s.node, 1)"
        mine = {
            "field": f"SELECT s.node, s.bucket, sum(share * value) / sum(share) AS value FROM {met} = 'w' GROUP BY ALL",
            "best": f"SELECT s.node, v.bucket, max(value) AS value FROM a{k} a JOIN steps s USING (node) JOIN v{k + 1} v ON v.node = s.child WHERE left(s.node, 1) = 'w' GROUP BY ALL",
            "plan": f"SELECT c.node, v.bucket, v.value FROM (SELECT s.node, min_by(s.child, list_position({PLAN}, move)) AS child FROM a{k} a JOIN steps s USING (node) JOIN a{k + 1} n ON n.node = s.child WHERE left(s.node, 1) = 'w' AND list_contains({PLAN}, move) GROUP BY s.node) c JOIN v{k + 1} v ON v.node = c.child",
        }[policy]
        out.append(f"x{k} AS (SELECT s.node, s.bucket, sum(share * value) AS value FROM {met} = 'b' GROUP BY ALL UNION ALL {mine})")
        out.append(f"v{k} AS (SELECT d.node, d.bucket, coalesce(x.value, 0.0) AS value FROM (SELECT node, bucket FROM a{k}, bands) d LEFT JOIN x{k} x ON x.node = d.node AND x.bucket = d.bucket)")
    return out


_ALL_PLIES = " UNION ALL ".join(f"SELECT {k} AS ply, node, bucket, round(value, 6) AS value FROM v{k}" for k in range(PLIES + 1))


def _policy(policy: str):
    def run(spark, sf_dir):
        edges, layers = _layers(spark, sf_dir)
        return rounded(X.policy_values(edges, layers, PLIES, policy, PLAN))

    run.__name__ = f"policy_{policy}"
    return query(_with(*LAYERS, *_policy_sql(policy)) + _ALL_PLIES)(run)


policy_field, policy_best, policy_plan = map(_policy, ("field", "best", "plan"))


def _black(sql: str) -> str:
    """The same expression with the sides changed: Black is the hero, White the crowd."""
    return sql.replace("= 'w'", "= '?'").replace("= 'b'", "= 'w'").replace("= '?'", "= 'b'")


def _hero_flow_sql(policy: str, endings: bool = False) -> list[str]:
    out = [CLASSES, _POOL, "book AS (SELECT node, stm, move, child, bucket, sum(n) AS n FROM pooled GROUP BY ALL HAVING sum(n) >= 4)", "known AS (SELECT DISTINCT node FROM book)"]
    out += _policy_sql("best") if policy == "best" else [SHARES, "bands AS (SELECT unnest(range(9))::INT AS bucket)"]
    out = [SHARES.replace("FROM edges", "FROM book") if x == SHARES else x for x in out]
    out.append("f0 AS (SELECT node, bucket, 1.0::DOUBLE AS mass FROM a0, bands)")
    for k in range(PLIES):
        met = f"f{k} f LEFT JOIN shares s USING (node, bucket) LEFT JOIN a{k + 1} a ON a.node = s.child"
        open_ = "(a.node IS NOT NULL OR s.move = '(TERM)')" if endings else "a.node IS NOT NULL"
        ends = "WHEN s.move = '(TERM)' THEN 'ended' WHEN s.move = '(AGG)' THEN 'pooled'"
        crowd = f"SELECT f.bucket, s.child AS node, CASE WHEN k.node IS NULL THEN 'off_book' WHEN s.move IS NULL THEN 'band_dry' {ends} WHEN a.node IS NULL THEN 'crowd_deviated' END AS sink, mass * coalesce(share, 1.0) AS mass FROM {met} LEFT JOIN known k ON k.node = f.node WHERE left(f.node, 1) = 'b'"
        if policy == "field":
            out.append(f"g{k} AS (SELECT f.node, f.bucket, f.mass, coalesce(sum(share) FILTER ({open_}), 0.0) AS total FROM {met} WHERE left(f.node, 1) = 'w' GROUP BY ALL)")
            mine = f"SELECT bucket, NULL, 'hero_unplayed', mass FROM g{k} WHERE total = 0 UNION ALL SELECT f.bucket, s.child, CASE {ends} END, mass * share / total FROM {met.replace(f'f{k} f', f'g{k} f')} WHERE total > 0 AND {open_}"
        else:
            to = f"steps s JOIN a{k + 1} a ON a.node = s.child"
            out.append(
                f"p{k} AS (SELECT node, bucket, child FROM (SELECT s.node, v.bucket, s.child, row_number() OVER (PARTITION BY s.node, v.bucket ORDER BY -round(value, 12), move) AS rk FROM {to} JOIN v{k + 1} v ON v.node = s.child) WHERE rk = 1)"
                if policy == "best"
                else f"p{k} AS (SELECT * FROM (SELECT s.node, min_by(s.child, list_position({PLAN}, move)) AS child FROM {to} WHERE list_contains({PLAN}, move) GROUP BY s.node), bands)"
            )
            mine = f"SELECT f.bucket, p.child, CASE WHEN p.child IS NULL THEN 'hero_stuck' END, mass FROM f{k} f LEFT JOIN p{k} p USING (node, bucket) WHERE left(f.node, 1) = 'w'"
        out.append(f"o{k} AS ({crowd} UNION ALL {mine})")
        out.append(f"f{k + 1} AS (SELECT node, bucket, sum(mass) AS mass FROM o{k} WHERE sink IS NULL GROUP BY ALL)")
    sinks = " UNION ALL ".join(f"SELECT bucket, sink, mass FROM o{k} WHERE sink IS NOT NULL" for k in range(PLIES))
    return [*map(_black, out), f"flow AS (SELECT bucket, sink, sum(mass) AS mass FROM (SELECT bucket, 'arrived' AS sink, mass FROM f{PLIES} UNION ALL {sinks}) GROUP BY ALL HAVING sum(mass) > 0)"]


def _hero_flow(policy: str, endings: bool = False):
    """Black as the hero, so that the last move to the target is the crowd's."""

    def run(spark, sf_dir):
        edges, layers = _layers(spark, sf_dir)
        book = stored(T.pool(edges, T.classify(edges)).where("n >= 4"), "book")
        return rounded(X.hero_flow(edges, book, layers, PLIES, policy, PLAN, "b", endings))

    run.__name__ = f"hero_flow_{policy}{'_endings' if endings else ''}"
    return query(_with(*LAYERS, *_hero_flow_sql(policy, endings)) + "SELECT bucket, sink, round(mass, 6) AS mass FROM flow")(run)


hero_flow_field, hero_flow_best, hero_flow_plan = map(_hero_flow, ("field", "best", "plan"))
hero_flow_field_endings = _hero_flow("field", True)


def _commitment_sql() -> list[str]:
    out = [SHARES, "bands AS (SELECT unnest(range(9))::INT AS bucket)", f"m0 AS (SELECT node, bucket, 1.0::DOUBLE AS mass FROM a0, bands WHERE node = '{ROOT}')"]
    for k in range(PLIES):
        out.append(f"f{k} AS (SELECT m.node, m.bucket, m.mass, coalesce(sum(share) FILTER (a.node IS NOT NULL), 0.0) AS total FROM m{k} m LEFT JOIN shares s ON s.node = m.node AND s.bucket = m.bucket AND {REAL} LEFT JOIN a{k + 1} a ON a.node = s.child GROUP BY ALL)")
        out.append(f"m{k + 1} AS (SELECT s.child AS node, s.bucket, sum(mass * share / CASE WHEN left(s.node, 1) = 'w' THEN total ELSE 1.0 END) AS mass FROM f{k} f JOIN shares s ON s.node = f.node AND s.bucket = f.bucket AND {REAL} JOIN a{k + 1} a ON a.node = s.child WHERE total > 0 GROUP BY ALL)")
    return out


@query(_with(*LAYERS, *_commitment_sql(), "kept AS (" + " UNION ALL ".join(f"SELECT bucket, mass, mass * total AS k FROM f{k} WHERE left(node, 1) = 'w'" for k in range(PLIES)) + ")") + f"SELECT bucket, round(sum(k) / sum(mass), 6) AS commitment, round(coalesce((SELECT sum(mass) FROM m{PLIES} m WHERE m.bucket = kept.bucket), 0.0), 6) AS arrived FROM kept GROUP BY bucket")
def target_commitment(spark, sf_dir):
    edges, layers = _layers(spark, sf_dir)
    return rounded(X.commitment(edges, layers, ROOT, PLIES))


@query(_with(*GRAPH) + f"SELECT bucket, CAST(r AS BIGINT) AS root_games, CAST(t AS BIGINT) AS target_games, round(t / r, 6) AS ratio FROM (SELECT bucket, coalesce(sum(n) FILTER (node = '{ROOT}'), 0) AS r, coalesce(sum(n) FILTER (node = '{TARGET}'), 0) AS t FROM edges GROUP BY bucket) WHERE r > 0")
def in_the_wild(spark, sf_dir):
    return rounded(X.in_the_wild(_edges(spark, sf_dir), ROOT, TARGET))


def _uniform_sql(*keys: str) -> str:
    """x -> (x + k) % (p - 1) + 1, squared and times 48271 modulo p, for each key; powers as products of one list entry."""
    x = "20260905::BIGINT"
    for k in (*keys, "7", "13"):
        x = f"list_extract(list_transform([(({x} + {k}) % 2147483646 + 1)::BIGINT], lambda y: y * y % 2147483647 * 48271 % 2147483647), 1)"
    return f"({x} / 2147483647.0::DOUBLE)"


GAMES, CAP = 60, 7
_TREE_POOLED = [*(x.replace("edges AS (", "raw AS (", 1) for x in TREE), CLASSES.replace("FROM edges", "FROM raw"), _POOL.replace("edges e", "raw e"), "edges AS (SELECT node, stm, move, child, bucket, CAST(sum(n) AS BIGINT) n, CAST(sum(ww) AS BIGINT) ww, CAST(sum(d) AS BIGINT) d FROM pooled GROUP BY ALL)"]
TOP = "w:^/"
_DRAWS = "draws AS (SELECT *, h - n AS low, h AS high FROM (SELECT *, sum(n) OVER (PARTITION BY node, bucket ORDER BY move ROWS UNBOUNDED PRECEDING) AS h, sum(n) OVER (PARTITION BY node, bucket) AS total FROM edges))"


def _playout_sql(starts: list[str] | None = None) -> list[str]:
    """starts: expressions that end in starts(bucket, start, hero, place); None: the root, for White."""
    out = [*_TREE_POOLED, SUMS, PRIOR, *_step_sql(1, None), _DRAWS, "totals AS (SELECT node, bucket, sum(n) AS n, sum(ww) AS ww, sum(d) AS d FROM edges GROUP BY ALL)"]
    out.append(f"chosen AS (SELECT node, bucket, 'policy' AS arm, best_move AS move FROM pick1 UNION ALL SELECT node, bucket, 'popular', move FROM (SELECT *, row_number() OVER (PARTITION BY node, bucket ORDER BY n DESC, move) AS rk FROM edges WHERE {REAL}) WHERE rk = 1)")
    out.append(f"arms AS (SELECT unnest(['crowd', 'policy', 'popular']) AS arm, unnest([0, 1, 2]) AS nr), {', '.join(starts or [f"starts AS (SELECT DISTINCT bucket, node AS start, 'w' AS hero, 0 AS place FROM edges WHERE node = '{TOP}')"])}, w0 AS (SELECT bucket, start AS node, start, hero, place, arm, nr, g.game FROM starts, arms, (SELECT unnest(range({GAMES})) AS game) g)")
    for k in range(CAP):
        u = _uniform_sql("w.bucket * 7919", "w.game", f"({k * 31} + w.place * 613)", "w.nr * 101")
        out.append(f"c{k} AS (SELECT w.bucket, w.start, w.hero, w.place, w.arm, w.nr, w.game, w.node, d.move, d.child, d.n, d.ww, d.d FROM w{k} w JOIN draws d USING (node, bucket) WHERE (left(w.node, 1) <> w.hero OR w.arm = 'crowd') AND d.low <= {u} * d.total AND {u} * d.total < d.high UNION ALL SELECT w.bucket, w.start, w.hero, w.place, w.arm, w.nr, w.game, w.node, d.move, d.child, d.n, d.ww, d.d FROM w{k} w LEFT JOIN chosen p ON p.node = w.node AND p.bucket = w.bucket AND p.arm = w.arm LEFT JOIN draws d ON d.node = w.node AND d.bucket = w.bucket AND d.move = p.move WHERE left(w.node, 1) = w.hero AND w.arm <> 'crowd')")
        out.append(f"s{k} AS (SELECT c.*, t.n AS tn, t.ww AS tww, t.d AS td, CASE WHEN c.move IS NULL THEN 'no_move' WHEN c.move = '(TERM)' THEN 'ended' WHEN c.move = '(AGG)' THEN 'pooled' WHEN x.node IS NULL THEN 'unseen_child' END AS stop FROM c{k} c JOIN totals t USING (node, bucket) LEFT JOIN totals x ON x.node = c.child AND x.bucket = c.bucket)")
        out.append(f"w{k + 1} AS (SELECT bucket, child AS node, start, hero, place, arm, nr, game FROM s{k} WHERE stop IS NULL)")
    parts = [f"SELECT bucket, start, hero, place, arm, nr, game, stop, CASE WHEN stop IN ('ended', 'pooled', 'no_move') THEN {k} ELSE {k + 1} END AS plies, CASE WHEN stop = 'no_move' THEN tn ELSE n END AS n, CASE WHEN stop = 'no_move' THEN tww ELSE ww END AS ww, CASE WHEN stop = 'no_move' THEN td ELSE d END AS d FROM s{k} WHERE stop IS NOT NULL" for k in range(CAP)]
    parts.append(f"SELECT w.bucket, start, hero, place, arm, nr, game, 'ply_cap', {CAP}, n, ww, d FROM w{CAP} w JOIN totals USING (node, bucket)")
    u = _uniform_sql("bucket * 104729", "game", "(17 + place * 613)", "nr * 101")
    out.append("over_ AS (" + " UNION ALL ".join(parts) + ")")
    out.append(f"played AS (SELECT *, CASE WHEN hero = 'w' THEN white ELSE 1 - white END AS points FROM (SELECT *, CASE WHEN {u} * n < ww THEN 1.0::DOUBLE WHEN {u} * n < ww + d THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS white FROM over_))")
    stops = ", ".join(f"count(*) FILTER (stop = '{s}') AS stop_{s}" for s in S.STOPS)
    out.append(f"sims AS (SELECT bucket, start, hero, arm, count(*) AS sims, count(*) FILTER (points = 1) AS wins, count(*) FILTER (points = 0.5) AS draws, count(*) FILTER (points = 0) AS losses, avg(points) AS obs_hero, sqrt(greatest(0.0, avg(points * points) - avg(points) * avg(points)) / count(*)) AS se, avg(plies) AS mean_plies, {stops} FROM played GROUP BY bucket, start, hero, arm)")
    return out


def _pooled_edges(spark, sf_dir):
    raw = _edges(spark, sf_dir, True, True)
    return stored(T.pool(raw, T.classify(raw)), "pooled")


def _one_backup(edges):
    sums = stored(G.band_sums(edges), "sums")
    return stored(G.backup(edges, sums, G.neighbour_prior(sums), None), "evals")


_SIM = ", ".join(["bucket", "arm", "sims", "wins", "draws", "losses", "round(obs_hero, 6) AS obs_hero", "round(se, 6) AS se", "round(mean_plies, 6) AS mean_plies", *(f"stop_{s}" for s in S.STOPS)])


@query(_with(*_playout_sql()) + f"SELECT {_SIM} FROM sims")
def playout_arms(spark, sf_dir):
    edges = _pooled_edges(spark, sf_dir)
    return rounded(S.playouts(edges, _one_backup(edges), TOP, GAMES, CAP))


@query(_with(*_playout_sql(), f"here AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS games, sum(ww + 0.5::DOUBLE * d) / sum(n) AS crowd FROM edges WHERE node = '{TOP}' GROUP BY bucket)") + f"SELECT s.bucket, '{TOP}' AS node, 'w' AS hero, games, round(eval_w, 6) AS eval_w, round(eval_b, 6) AS eval_b, round(eval_w, 6) AS pred_hero, best_move, round(coalesce(e.n, 0) / games, 6) AS best_share, round(crowd, 6) AS crowd_hero, {_SIM.replace('bucket, arm', 'arm')} FROM sims s JOIN here USING (bucket) JOIN v1 v ON v.node = '{TOP}' AND v.bucket = s.bucket LEFT JOIN edges e ON e.node = '{TOP}' AND e.bucket = s.bucket AND e.move = best_move")
def simulation_table(spark, sf_dir):
    edges = _pooled_edges(spark, sf_dir)
    return rounded(S.simulation_table(edges, _one_backup(edges), TOP, GAMES, CAP))


def _descent_sql(walks: int, depth: int, root: str = ROOT, w: str = "w") -> list[str]:
    out = [_DRAWS, f"{w}0 AS (SELECT DISTINCT bucket, node, g.walk FROM draws, (SELECT unnest(range({walks})) AS walk) g WHERE node = '{root}')"]
    for k in range(depth):
        u = _uniform_sql("w.bucket * 7919", "w.walk", str(k * 37))
        out.append(f"{w}{k + 1} AS (SELECT w.bucket, d.child AS node, w.walk FROM {w}{k} w JOIN draws d USING (node, bucket) WHERE d.low <= {u} * d.total AND {u} * d.total < d.high AND {REAL} AND EXISTS (SELECT 1 FROM edges e WHERE e.node = d.child AND e.bucket = w.bucket))")
    return out


#: Walks, plies, starts for each side, least depth and games of the sampled positions.
SAMPLE = (80, 4, 2, 1, 20)


def _starts_sql() -> list[str]:
    walks, depth, per_side, least_depth, least_games = SAMPLE
    met = " UNION ALL ".join(f"SELECT bucket, node, {k} AS depth FROM walk{k}" for k in range(least_depth, depth))
    return [
        *_descent_sql(walks, depth - 1, TOP, "walk")[1:],
        f"met AS (SELECT bucket, node, CAST(min(depth) AS INT) AS depth, count(*) AS visits, left(node, 1) AS hero FROM ({met}) m WHERE (SELECT sum(n) FROM edges e WHERE e.node = m.node AND e.bucket = m.bucket) >= {least_games} AND EXISTS (SELECT 1 FROM pick1 p WHERE p.node = m.node AND p.bucket = m.bucket) GROUP BY bucket, node)",
        f"starts AS (SELECT * FROM (SELECT bucket, node AS start, hero, CAST(row_number() OVER (PARTITION BY bucket, hero ORDER BY md5(node), node) AS INT) AS place, depth, visits FROM met) WHERE place <= {per_side})",
    ]


@query(
    _with(*_playout_sql(_starts_sql()), "here AS (SELECT node, bucket, CAST(sum(n) AS BIGINT) AS games, sum(ww + 0.5::DOUBLE * d) / sum(n) AS crowd FROM edges GROUP BY ALL)")
    + f"SELECT s.bucket, s.start AS node, depth, hero = 'w' AS white_to_move, visits, hero, games, round(eval_w, 6) AS eval_w, round(eval_b, 6) AS eval_b, round(CASE WHEN hero = 'w' THEN eval_w ELSE 1 - eval_b END, 6) AS pred_hero, best_move, round(coalesce(e.n, 0) / games, 6) AS best_share, round(CASE WHEN hero = 'w' THEN crowd ELSE 1 - crowd END, 6) AS crowd_hero, {_SIM.replace('bucket, arm', 'arm')} FROM sims s JOIN starts USING (bucket, start, hero) JOIN here h ON h.node = s.start AND h.bucket = s.bucket JOIN v1 v ON v.node = s.start AND v.bucket = s.bucket LEFT JOIN edges e ON e.node = s.start AND e.bucket = s.bucket AND e.move = best_move"
)
def position_simulations(spark, sf_dir):
    edges = _pooled_edges(spark, sf_dir)
    evals = _one_backup(edges)
    starts = stored(S.sampled_starts(edges, evals, TOP, *SAMPLE), "starts")
    return rounded(S.simulated(edges, evals, starts, GAMES, CAP))


@query(_with(*GRAPH, *_descent_sql(80, 6)) + " UNION ALL ".join(f"SELECT bucket, node, {k} AS depth, count(*) AS visits FROM w{k} GROUP BY ALL" for k in range(7)))
def descent_walks(spark, sf_dir):
    return S.descents(_edges(spark, sf_dir), ROOT, 80, 6)


@query(_with(*GRAPH, f"r AS (SELECT *, sum(n) OVER (PARTITION BY node, bucket ORDER BY move ROWS UNBOUNDED PRECEDING) AS h, sum(n) OVER (PARTITION BY node, bucket) AS total, {_uniform_sql('bucket * 7919', 'length(node)', '5')} AS u FROM edges WHERE {REAL})") + "SELECT node, bucket, move, round(n / total, 6) AS share, n / total < 0.05 AS sideline FROM r WHERE h - n <= u * total AND u * total < h")
def weighted_reply(spark, sf_dir):
    return rounded(S.weighted_reply(_edges(spark, sf_dir), F.col("bucket") * 7919, F.length("node"), F.lit(5)))


K = SWEEPS + 1
#: Stored values with one fault in each of some bands, so that every check has something to find.
_FAULTY = f"stored_ AS (SELECT node, bucket, CASE bucket WHEN 5 THEN 'nowhere' WHEN 6 THEN NULL WHEN 7 THEN '(TERM)' WHEN 2 THEN 'view' ELSE best_move END AS best_move, CASE bucket WHEN 3 THEN eval_w + 0.5 WHEN 8 THEN NULL ELSE eval_w END AS eval_w, CASE bucket WHEN 4 THEN eval_b + 0.01 ELSE eval_b END AS eval_b FROM v{SWEEPS})"


def _check_sql() -> list[str]:
    out = [*SOLVE[: -len(_step_sql(K, "x"))], _FAULTY, *_step_sql(K, "stored_")]
    flag = lambda c: f"coalesce({c}, false)"
    out.append(f"span AS (SELECT node, bucket, min(CASE WHEN stm = 'w' THEN x_w ELSE x_b END) AS low, max(CASE WHEN stm = 'w' THEN x_w ELSE x_b END) AS high FROM rows{K} WHERE {REAL} GROUP BY ALL)")
    out.append(f"pick AS (SELECT node, bucket, move, score, evidence, strength FROM (SELECT *, row_number() OVER (PARTITION BY node, bucket ORDER BY round(-sgn * bound, 12), move) AS rk FROM cand{K}) WHERE rk = 1)")
    out.append(f"base AS (SELECT w.node, w.bucket, s.cnt AS games, p.move, p.evidence, p.strength, p.score, span.low, span.high, o.best_move AS kept, e.move IS NOT NULL AS known, o.eval_w, o.eval_b, CASE WHEN w.stm = 'w' THEN o.eval_w ELSE o.eval_b END AS chooser, CASE WHEN w.stm = 'w' THEN o.eval_b ELSE o.eval_w END AS other, CASE WHEN w.stm = 'w' THEN chance_b ELSE chance_w END AS expected, coalesce(p.score, pts / cnt) AS own FROM crowd{K} w JOIN sums s USING (node, bucket) LEFT JOIN pick p USING (node, bucket) LEFT JOIN span USING (node, bucket) LEFT JOIN stored_ o USING (node, bucket) LEFT JOIN edges e ON e.node = w.node AND e.bucket = w.bucket AND e.move = o.best_move)")
    out.append("sure AS (SELECT *, kept IS NOT NULL AND kept NOT IN ('(TERM)', '(AGG)') AND known AS checked, coalesce(kept IN ('(TERM)', '(AGG)'), false) AS pseudo, eval_w IS NOT NULL AND eval_b IS NOT NULL AS finite FROM base)")
    out.append(
        "found AS (SELECT node, bucket, games, NOT finite AS eval_not_finite, " + flag("finite AND (least(eval_w, eval_b) < 0 OR greatest(eval_w, eval_b) > 1)") + " AS eval_out_of_range, move IS NOT NULL AND kept IS NULL AS move_missing, move IS NULL AND kept IS NOT NULL AS move_spurious, pseudo AS move_is_pseudo, kept IS NOT NULL AND NOT pseudo AND NOT known AS move_not_in_node, checked, "
        + flag("checked AND kept <> move") + " AS move_mismatch, CASE WHEN checked THEN abs(chooser - own) END AS value_delta, CASE WHEN checked THEN abs(other - expected) END AS chance_delta, " + flag("checked AND evidence < 20") + " AS thin_move, " + flag("checked AND evidence + strength + 30 < 50") + " AS thin_support, " + flag("checked AND (chooser > high + 2e-3 OR chooser < low - 2e-3)") + " AS outside_child_range FROM sure)"
    )
    return out


def _faulty(evals):
    b = F.col("bucket")
    return evals.select(
        "node", "bucket", F.when(b == 5, "nowhere").when(b == 6, None).when(b == 7, "(TERM)").when(b == 2, "view").otherwise(F.col("best_move")).alias("best_move"),
        F.when(b == 3, F.col("eval_w") + 0.5).when(b == 8, None).otherwise(F.col("eval_w")).alias("eval_w"), F.when(b == 4, F.col("eval_b") + 0.01).otherwise(F.col("eval_b")).alias("eval_b"),
    )


@query(_with(*_check_sql()) + "SELECT * REPLACE (round(value_delta, 6) AS value_delta, round(chance_delta, 6) AS chance_delta) FROM found")
def verify_cells(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    return rounded(C.cells(edges, stored(_faulty(G.solve(edges, SWEEPS)), "evals")))


_REACHED = f"reach AS (SELECT '{ROOT}' AS node UNION SELECT e.child FROM reach r JOIN edges e ON e.node = r.node WHERE {REAL} AND e.child IN (SELECT node FROM edges))"
_COUNT = lambda c, w="": f"count(*) FILTER ({c}{w})"


@query(
    _with(*(["RECURSIVE " + (x := _check_sql())[0], *x[1:], _REACHED])) + "SELECT (SELECT count(DISTINCT node) FROM edges) AS index_nodes, (SELECT count(*) FROM reach) AS visited, (SELECT count(DISTINCT node) FROM edges) - (SELECT count(*) FROM reach) AS unreachable, count(*) FILTER (checked) AS checked, "
    + ", ".join(f"{_COUNT(f)} AS {f}" for f in C.FLAGS) + f", {_COUNT('value_delta > 2e-3')} AS value_mismatch, {_COUNT('chance_delta > 2e-3')} AS chance_mismatch, {_COUNT('checked AND games >= 100')} AS well_played, "
    + ", ".join(f"{_COUNT(g, ' AND games >= 100')} AS {g}" for g in C.GATED) + ", " + ", ".join(f"{_COUNT(g)} AS {g}_all" for g in C.GATED) + ", round(coalesce(max(value_delta), 0.0), 6) AS worst_value_delta, round(coalesce(max(chance_delta), 0.0), 6) AS worst_chance_delta FROM found"
)
def verify_counters(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    found = C.cells(edges, stored(_faulty(G.solve(edges, SWEEPS)), "evals"))
    reached = G.reachable(edges, T.classify(edges, 0, 0), ROOT)
    return rounded(C.counters(found, edges.select("node").distinct().count(), reached.count(), least_games=100))


@query(_with(*SOLVE) + f"SELECT node, bucket, round(min(CASE WHEN stm = 'w' THEN x_w ELSE x_b END), 6) AS low, round(max(CASE WHEN stm = 'w' THEN x_w ELSE x_b END), 6) AS high FROM rows{K} WHERE {REAL} GROUP BY ALL")
def child_range(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    return rounded(C.child_range(edges, G.solve(edges, SWEEPS)))


@query(f"WITH RECURSIVE {','.join([*TREE, CLASSES])}, reach AS (SELECT node FROM classes WHERE node = '{TOP}' AND class <> 'DROPPED' UNION SELECT e.child FROM reach r JOIN classes c ON c.node = r.node AND c.class = 'FULL' JOIN edges e ON e.node = r.node JOIN classes k ON k.node = e.child AND k.class <> 'DROPPED') SELECT DISTINCT node FROM edges EXCEPT SELECT node FROM reach")
def unreachable_nodes(spark, sf_dir):
    edges = _edges(spark, sf_dir, True, True)
    return C.unreachable(edges, G.reachable(edges, T.classify(edges), TOP))


@query(f"WITH RECURSIVE {','.join([*TREE, CLASSES])}, reach AS (SELECT node FROM classes WHERE node = '{TOP}' AND class <> 'DROPPED' UNION SELECT e.child FROM reach r JOIN classes c ON c.node = r.node AND c.class = 'FULL' JOIN edges e ON e.node = r.node JOIN classes k ON k.node = e.child AND k.class <> 'DROPPED') SELECT * FROM edges WHERE node IN (SELECT node FROM reach)")
def reachable_edges(spark, sf_dir):
    edges = _edges(spark, sf_dir, True, True)
    return tallies.in_order(edges.join(G.reachable(edges, T.classify(edges), TOP).select("node"), "node", "left_semi"))


_TOP2 = [
    f"st AS (SELECT * FROM (SELECT node, child, row_number() OVER (PARTITION BY node ORDER BY n DESC, move) AS rk FROM (SELECT node, move, child, coalesce(sum(n) FILTER (bucket = 4), 0) AS n FROM edges WHERE {REAL} AND child IN (SELECT node FROM edges) GROUP BY ALL)) WHERE rk <= 2)",
    f"way AS (SELECT '{ROOT}' AS node, 0 AS depth UNION SELECT s.child, w.depth + 1 FROM way w JOIN st s ON s.node = w.node WHERE w.depth < 12)",
    "few AS (SELECT node, CAST(min(depth) AS INT) AS depth FROM way GROUP BY node ORDER BY 2, 1 LIMIT 300)",
]


@query(_with("RECURSIVE " + GRAPH[0], *GRAPH[1:], *_TOP2) + "SELECT node, depth FROM few")
def top_two_descent(spark, sf_dir):
    return C.top_children(_edges(spark, sf_dir, keep=True), ROOT, 12, 300)


@query(_with("RECURSIVE " + SOLVE[0], *SOLVE[1:], *_TOP2) + f"SELECT count(*) AS checked, count(*) FILTER (a.best_move = b.best_move) AS agreed FROM v{SWEEPS} a JOIN v{K} b USING (node, bucket) WHERE a.best_move IS NOT NULL AND a.node IN (SELECT node FROM few)")
def self_check_sample(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    return C.self_check(edges, G.solve(edges, SWEEPS), ROOT)


@query(_with(*GRAPH) + f"SELECT *, CAST(CASE WHEN {REAL} THEN dense_rank() OVER (PARTITION BY node, {REAL} ORDER BY move) - 1 ELSE -1 END AS INT) AS ordinal FROM edges")
def move_ordinals(spark, sf_dir):
    return V.ordinals(_edges(spark, sf_dir))


@query(_with(*ONE) + "SELECT node, bucket, round(eval_w, 6) AS white, round(1 - eval_b, 6) AS black FROM v1")
def perspectives(spark, sf_dir):
    return rounded(_one_backup(_edges(spark, sf_dir, keep=True)).select("node", "bucket", V.expected_return("w").alias("white"), V.expected_return("b").alias("black")))


_RANKS = "ranks AS (SELECT e.node, e.stm, e.bucket, e.move, e.n, (e.ww / e.n)::DOUBLE AS white, r.rank, r.score FROM edges e LEFT JOIN (SELECT node, bucket, move, score, row_number() OVER (PARTITION BY node, bucket ORDER BY -sgn * bound, move) - 1 AS rank FROM cand1) r USING (node, bucket, move))"


def _ranks(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    sums = G.band_sums(edges)
    rows = G.children(edges, sums, None)
    ranked = G.rank_all(G.candidates(rows, G.chance(rows), G.neighbour_prior(sums))).select("node", "bucket", "move", "rank", "score")
    return stored(edges.select("node", "stm", "bucket", "move", "n", (F.col("ww") / F.col("n")).alias("white")).join(ranked, ["node", "bucket", "move"], "left"), "ranks")


@query(_with(*ONE, _RANKS) + "SELECT node, bucket, move, " + ", ".join(f"CAST(row_number() OVER (PARTITION BY node, bucket ORDER BY {o} NULLS LAST, n DESC, move) AS INT) AS {c}" for c, o in (("by_rank", "rank"), ("by_rank_back", "rank DESC"), ("by_white", "white DESC"), ("by_white_back", "white"), ("by_move", "move"))) + " FROM ranks")
def table_orders(spark, sf_dir):
    rows = _ranks(spark, sf_dir)
    for name, column, first in (("by_rank", "rank", True), ("by_rank_back", "rank", False), ("by_white", "white", True), ("by_white_back", "white", False), ("by_move", "move", True)):
        rows = V.sorted_rows(rows, column, first).withColumnRenamed("place", name)
    return rows.select("node", "bucket", "move", "by_rank", "by_rank_back", "by_white", "by_white_back", "by_move")


#: Some bands know no ranks, and some of those no pick either.
_SEEN = "seen AS (SELECT node, stm, bucket, move, score, CASE WHEN bucket % 3 = 0 THEN rank END AS rank, coalesce(bucket % 3 < 2 AND rank = 1, false) AS is_best FROM ranks)"
_BESTS = "bests AS (SELECT node, bucket, coalesce(min(move) FILTER (rank = 0), min(move) FILTER (is_best), min(move)) AS best FROM seen WHERE score IS NOT NULL GROUP BY ALL)"


def _seen(spark, sf_dir):
    b = F.col("bucket")
    return _ranks(spark, sf_dir).select("node", "stm", "bucket", "move", "score", F.when(b % 3 == 0, F.col("rank")).alias("rank"), F.coalesce((b % 3 < 2) & (F.col("rank") == 1), F.lit(False)).alias("is_best"))


@query(_with(*ONE, _RANKS, _SEEN, _BESTS) + "SELECT * FROM bests")
def best_rows(spark, sf_dir):
    return V.best_rows(_seen(spark, sf_dir))


_PLAYED = "played AS (SELECT DISTINCT node, bucket, unnest(['click', 'view', 'signup', '(TERM)', 'resign']) AS move FROM edges)"
_VALUES = "vals AS (SELECT node, bucket, move, CASE WHEN stm = 'w' THEN score ELSE 1 - score END AS value FROM seen)"


@query(_with(*ONE, _RANKS, _SEEN, _BESTS, _PLAYED, _VALUES, "graded AS (SELECT p.node, p.bucket, p.move, b.best, greatest(0.0, (t.value - v.value) * 100) AS loss, CASE WHEN v.value IS NULL OR t.value IS NULL THEN 'unknown' WHEN p.move = 'click' AND p.bucket % 2 = 0 THEN 'custom' WHEN p.move = b.best THEN 'best' WHEN greatest(0.0, (t.value - v.value) * 100) <= 2 THEN 'excellent' ELSE 'suboptimal' END AS grade FROM played p LEFT JOIN bests b USING (node, bucket) LEFT JOIN vals v ON v.node = p.node AND v.bucket = p.bucket AND v.move = p.move LEFT JOIN vals t ON t.node = p.node AND t.bucket = p.bucket AND t.move = b.best)") + "SELECT node, bucket, move, best, CASE WHEN grade IN ('unknown', 'best') THEN 0.0 ELSE round(loss, 6) END AS loss, grade, grade IN ('unknown', 'suboptimal') AS pending FROM graded")
def grade_moves(spark, sf_dir):
    rows = stored(_seen(spark, sf_dir), "seen")
    moves = F.explode(F.array(*map(F.lit, ["click", "view", "signup", "(TERM)", "resign"]))).alias("move")
    played = rows.select("node", "bucket").distinct().select("node", "bucket", moves).withColumn("custom", (F.col("move") == "click") & (F.col("bucket") % 2 == 0))
    return rounded(V.grades(rows, played))


@query(_with(*TREE) + "SELECT * FROM edges")
def sorted_tallies(spark, sf_dir):
    return tallies.in_order(_edges(spark, sf_dir, True))


@query(_with(*(x.replace("user_id % 9", "user_id % 11") for x in GRAPH)) + "SELECT * FROM edges WHERE bucket BETWEEN 0 AND 8")
def known_bands(spark, sf_dir):
    from arbora.sources import journeys

    return T.tally(tallies.known_bands(journeys.plays(_table(spark, sf_dir, "events"), bands=11)))


@query("SELECT event_id, CAST((event_id * 92233720368547) >> 58 AS INT) AS shard FROM events")
def shard_ids(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", tallies.shard(tallies.product64(F.col("event_id"), 92233720368547)).alias("shard"))


_DEPTHS = ["RECURSIVE " + GRAPH[0], *GRAPH[1:], "kept AS (SELECT node FROM edges GROUP BY node HAVING sum(n) >= 50)", f"reach AS (SELECT node, 0 AS depth FROM kept WHERE node = '{ROOT}' UNION SELECT e.child, r.depth + 1 FROM reach r JOIN edges e ON e.node = r.node JOIN kept k ON k.node = e.child WHERE r.depth < 5)", "depths AS (SELECT node, CAST(min(depth) AS INT) AS depth FROM reach GROUP BY node)", "mv AS (SELECT DISTINCT e.node, e.move, e.child, a.depth, b.depth AS to_ FROM edges e JOIN depths a ON a.node = e.node LEFT JOIN depths b ON b.node = e.child)", "kinds AS (SELECT node, move, child, depth, CASE WHEN move = '(TERM)' THEN 'TERM' WHEN move = '(AGG)' THEN 'AGG' WHEN to_ IS NULL THEN 'THIN' WHEN to_ = depth + 1 THEN 'TREE' ELSE 'BACK' END AS kind FROM mv)", "subs AS (SELECT node, depth, count(*) AS n_moves, NOT coalesce(bool_or(to_ IS NOT NULL), false) AS is_leaf FROM mv GROUP BY node, depth)"]


def _subtree(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    depths = stored(G.reachable(edges, T.classify(edges, 50, 50), ROOT, 5), "depths")
    return edges, depths


@query(_with(*_DEPTHS) + "SELECT node, depth, left(node, 1) = 'w' AS white_to_move, is_leaf, n_moves, CAST(coalesce(sum(n_moves) OVER (ORDER BY depth, node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS move_start FROM subs")
def subtree_nodes(spark, sf_dir):
    return tallies.subtree_nodes(*_subtree(spark, sf_dir))


def _arrays_sql(where: str, name: str) -> str:
    of = lambda c: " || ',' || ".join(f"coalesce(sum({c}) FILTER (bucket = {b}), 0)::BIGINT" for b in range(9))
    return f"{name} AS (SELECT node, move, {of('n')} AS {name}_count, {of('ww')} AS {name}_wins, {of('d')} AS {name}_draws FROM edges WHERE {where} GROUP BY ALL)"


_SIX = [f"{s}_{x}" for s in "om" for x in ("count", "wins", "draws")]


@query(_with(*_DEPTHS, _arrays_sql("bucket < 6", "o"), _arrays_sql("bucket >= 6", "m")) + "SELECT k.node, k.move, kind, child, " + ", ".join(f"coalesce({c}, '0,0,0,0,0,0,0,0,0') AS {c}" for c in _SIX) + " FROM kinds k LEFT JOIN o USING (node, move) LEFT JOIN m USING (node, move)")
def subtree_moves(spark, sf_dir):
    edges, depths = _subtree(spark, sf_dir)
    rows = tallies.subtree_moves(edges.where("bucket < 6"), edges.where("bucket >= 6"), A.edge_kinds(edges, depths))
    return rows.select("node", "move", "kind", "child", *(F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in _SIX))


@query(_with(*_DEPTHS) + "SELECT kind AS what, count(*) AS n FROM kinds GROUP BY kind UNION ALL SELECT 'nodes', count(*) FROM subs UNION ALL SELECT 'leaves', count(*) FROM subs WHERE is_leaf")
def subtree_counts(spark, sf_dir):
    edges, depths = _subtree(spark, sf_dir)
    return tallies.subtree_counts(tallies.subtree_nodes(edges, depths), A.edge_kinds(edges, depths))


@query(_with(*GRAPH, SUMS, _CAL, _BEST, _SPREAD, "s AS (SELECT CASE WHEN dk = 0 THEN NULL WHEN dsse <= noise THEN 2000.0 ELSE least(2000.0, sigma2 / ((dsse - noise) / dk)) END::DOUBLE AS strength FROM best JOIN spread USING (bucket))", "p AS (SELECT w, avg(mse) AS mse FROM (SELECT bucket, w, sum(miss * miss) / count(*) AS mse FROM cal GROUP BY bucket, w) GROUP BY w ORDER BY round(avg(mse), 12), w LIMIT 1)") + "SELECT w, round(mse, 6) AS mse, (SELECT round(list_sort(list(strength))[count(*) // 2 + 1], 6) FROM s WHERE strength IS NOT NULL) AS strength FROM p")
def calibrate_pooled(spark, sf_dir):
    edges = _edges(spark, sf_dir, keep=True)
    return rounded(A.calibrate_pooled(edges, G.band_sums(edges), 50, 100))


_HEADER = "'pl=' || (event_id * 97 % 700000) || ',wn=' || (user_id % 5) || ',ws=' || (event_id % 4) || CASE event_id % 11 WHEN 0 THEN ',ch=1,ch=2' WHEN 1 THEN ',=3' WHEN 2 THEN ',zz=4,zz=5' WHEN 3 THEN ',' WHEN 4 THEN ',cm=10001' WHEN 5 THEN ',cm=9999' WHEN 6 THEN ',ee=x' ELSE ',vr=2' END"


@query(f"WITH h AS (SELECT event_id, {_HEADER} AS header FROM events), p AS (SELECT event_id, header, unnest(string_split(header, ',')) AS pair FROM h), q AS (SELECT event_id, header, pair, regexp_extract(pair, '^([^=]*)=', 1) AS k, TRY_CAST(CASE WHEN regexp_matches(pair, '^[^=]*=[0-9]{{1,9}}$') THEN regexp_extract(pair, '=([0-9]+)$', 1) END AS BIGINT) AS v FROM p), f AS (SELECT event_id FROM q GROUP BY event_id, header HAVING length(header) <= 256 AND bool_and(k <> '' AND v IS NOT NULL) AND count(*) FILTER (k IN {tuple(COUNTERS)}) = count(DISTINCT k) FILTER (k IN {tuple(COUNTERS)}) AND bool_and(k NOT IN {tuple(COUNTERS)} OR v <= CASE WHEN k = 'pl' THEN 600000 ELSE 10000 END) AND coalesce(max(v) FILTER (k = 'ws'), 0) <= coalesce(max(v) FILTER (k = 'wn'), 0)) SELECT k, CAST(sum(v) AS BIGINT) AS total FROM q WHERE event_id IN (SELECT event_id FROM f) AND k IN {tuple(COUNTERS)} GROUP BY k")
def strict_counters(spark, sf_dir):
    return service.strict_totals(_table(spark, sf_dir, "events").select(F.expr(_HEADER).alias("header")))


@query('WITH RECURSIVE r AS (SELECT CAST(user_id % 20 AS VARCHAR) AS client, epoch_us(ts) / 1e11::DOUBLE AS "at" FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY "at") AS k FROM r), g AS (SELECT client, "at", k, 39.0::DOUBLE AS tokens, true AS allowed, 0.0::DOUBLE AS retry_after FROM n WHERE k = 1 UNION ALL SELECT n.client, n."at", n.k, CASE WHEN least(40.0, g.tokens + (n."at" - g."at") * 8.0) >= 1 THEN least(40.0, g.tokens + (n."at" - g."at") * 8.0) - 1 ELSE least(40.0, g.tokens + (n."at" - g."at") * 8.0) END, least(40.0, g.tokens + (n."at" - g."at") * 8.0) >= 1, CASE WHEN least(40.0, g.tokens + (n."at" - g."at") * 8.0) >= 1 THEN 0.0 ELSE (1 - least(40.0, g.tokens + (n."at" - g."at") * 8.0)) / 8.0 END FROM g JOIN n ON n.client = g.client AND n.k = g.k + 1) SELECT client, round("at", 6) AS "at", allowed, round(retry_after, 6) AS retry_after FROM g')
def rate_limit_decisions(spark, sf_dir):
    requests = _table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("client"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e11)).alias("at"))
    return rounded(service.replayed(requests))




#: A line of each event, by its id: sound ones, comments, blanks, and one of each error. The same in Spark and DuckDB.
_FLAG_LINE = (
    "CASE event_id % 11 WHEN 0 THEN '# of ' || event_type WHEN 1 THEN '  ' WHEN 2 THEN 'w:^ | ' || event_type WHEN 3 THEN 'b:' || event_type || ' | click |  ' "
    "WHEN 4 THEN 'w:^ | click view | two' WHEN 5 THEN 'w:nowhere | click | ' || event_type WHEN 6 THEN 'w:^ | castle | none' "
    "ELSE CASE event_id % 2 WHEN 0 THEN 'b:' ELSE 'w:' END || event_type || ' | ' || CASE event_id % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'view' ELSE 'purchase' END || ' | on | event # ' || CAST(event_id AS STRING) END"
)
_FLAGS = [
    f"lines AS (SELECT CAST(user_id % 4 AS INT) AS part, CAST(row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS BIGINT) AS line, trim({_FLAG_LINE.replace('STRING', 'VARCHAR')}) AS text FROM events)",
    "cut AS (SELECT part, line, string_split(text, '|') AS f FROM lines WHERE text <> '' AND text[1] <> '#')",
    "named AS (SELECT part, line, len(f) >= 3 AS whole, CASE WHEN len(f) >= 3 THEN trim(f[1]) END AS node, CASE WHEN len(f) >= 3 THEN trim(f[2]) END AS move, CASE WHEN len(f) >= 3 THEN trim(array_to_string(f[3:], '|')) END AS reason FROM cut)",
    f"judged AS (SELECT n.*, CASE WHEN NOT whole THEN 'expected three fields parted by |' WHEN reason = '' THEN 'the reason is empty' WHEN NOT EXISTS (SELECT 1 FROM edges e WHERE e.node = n.node) THEN 'no such node' WHEN move = '' OR contains(move, ' ') THEN 'the middle field must name one move' WHEN NOT EXISTS (SELECT 1 FROM edges e WHERE e.node = n.node AND e.move = n.move AND {REAL.replace('move', 'e.move')}) THEN 'no such move' END AS error FROM named n)",
]


@query(_with(*GRAPH, *_FLAGS) + "SELECT part, line, node, move, reason, coalesce(error, CASE WHEN row_number() OVER (PARTITION BY part, node, move, error IS NULL ORDER BY line) > 1 THEN 'already flagged' END) AS error FROM judged")
def flagged_list(spark, sf_dir):
    """Written as text, a file for each part in the order of event_id, and read with its line numbers."""
    path = f"{shared_dir(spark).rstrip('/')}/arbora-{uuid.uuid4().hex}/flags"
    lines = _table(spark, sf_dir, "events").select((F.col("user_id") % 4).cast("int").alias("part"), "event_id", F.expr(_FLAG_LINE).alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "event_id").select("part", "value").write.partitionBy("part").text(path)
    found = flags.flagged_list(flags.numbered_lines(spark, path), _edges(spark, sf_dir))
    return found.select(F.regexp_extract("file", r"part=(\d+)/", 1).cast("int").alias("part"), "line", "node", "move", "reason", "error")
