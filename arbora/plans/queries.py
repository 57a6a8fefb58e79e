"""Queries over the event journeys, each with the same result in DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.functions import ranking as R
from arbora.functions.constants import GRID, NEIGHBOUR_WEIGHT, S_PRIOR
from arbora.operators import analysis as A
from arbora.operators import graph as G
from arbora.operators import tally as T
from arbora.plans.tables import stored
from arbora.sources import journeys
from arbora.streaming.service import counter_totals

ROOT, TREE_ROOT, TARGET = "w:^", "w:^/", "b:purchase"
BOUNDS = [10.0, 20.0, 40.0, 80.0, 160.0]
MONTH = "2024-01-16"
ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that its result is held against."""

    def add(f):
        ALL[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plays(spark: SparkSession, sf_dir: str, paths: bool = False) -> DataFrame:
    return journeys.plays(_table(spark, sf_dir, "events"), paths)


def _edges(spark: SparkSession, sf_dir: str, paths: bool = False, keep: bool = False) -> DataFrame:
    """keep: written once, for plans that read it several times."""
    edges = T.tally(_plays(spark, sf_dir, paths))
    return stored(edges, "tally") if keep else edges


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*(F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _plays_sql(paths: bool) -> list[str]:
    before = "'^/' || coalesce(string_agg(event_type, '/') OVER (PARTITION BY user_id, blk ORDER BY ply ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')" if paths else "coalesce(lag(event_type) OVER (PARTITION BY user_id, blk ORDER BY ply), '^')"
    after = "before || CASE WHEN ply = 0 THEN '' ELSE '/' END || event_type" if paths else "event_type"
    return [
        "ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM events)",
        "eb AS (SELECT user_id, event_type, value, seq // 8 AS blk, CAST(seq % 8 AS INT) AS ply FROM ev)",
        f"eg AS (SELECT *, sum(value) OVER (PARTITION BY user_id, blk) AS total, count(*) OVER (PARTITION BY user_id, blk) AS len, {before} AS before FROM eb)",
        f"em AS (SELECT user_id || '-' || blk AS game_id, ply, CASE WHEN ply % 2 = 0 THEN 'w' ELSE 'b' END AS stm, before, event_type AS move, CASE WHEN ply % 2 = 0 THEN 'b' ELSE 'w' END || ':' || {after} AS child, CAST(user_id % 9 AS INT) AS bucket, CAST(total >= 450 AS INT) AS ww, CAST(total >= 350 AND total < 450 AS INT) AS d, len FROM eg WHERE len >= 5)",
        "plays AS (SELECT game_id, ply, stm, stm || ':' || before AS node, move, child, bucket, ww, d FROM em UNION ALL SELECT game_id, ply + 1, left(child, 1), child, '(TERM)', NULL, bucket, ww, d FROM em WHERE ply = len - 1)",
        "edges AS (SELECT node, stm, move, child, bucket, count(*) AS n, CAST(sum(ww) AS BIGINT) AS ww, CAST(sum(d) AS BIGINT) AS d FROM plays GROUP BY ALL)",
    ]


GRAPH, TREE = _plays_sql(False), _plays_sql(True)
CLASSES = "classes AS (SELECT node, total, CASE WHEN total < 50 THEN 'DROPPED' WHEN total < 150 THEN 'LEAF' ELSE 'FULL' END AS class FROM (SELECT node, CAST(sum(n) AS BIGINT) AS total FROM edges GROUP BY node))"
SUMS = "sums AS (SELECT node, bucket, CAST(sum(n) AS BIGINT) AS cnt, sum(ww + 0.5::DOUBLE * d) AS pts FROM edges GROUP BY ALL)"
_W = f"list_extract({NEIGHBOUR_WEIGHT}::DOUBLE[], b.bucket + 1)"
PRIOR = f"prior AS (SELECT node, bucket, sum(w * pts) / sum(w * cnt) AS prior, sum(w * cnt) * sum(w * cnt) / sum(w * w * cnt) AS kish FROM (SELECT s.node, b.bucket, s.cnt, s.pts, pow({_W}, abs(s.bucket - b.bucket)) AS w FROM sums s, (SELECT unnest(range(9))::INT AS bucket) b WHERE s.bucket <> b.bucket) GROUP BY node, bucket)"
SHARES = "shares AS (SELECT node, bucket, move, child, n / sum(n) OVER (PARTITION BY node, bucket) AS share FROM edges)"


def _step_sql(k: int, evals: str | None) -> list[str]:
    """The expressions of one backup; its results are rows{k}, cand{k} and v{k}."""
    join = f"LEFT JOIN {evals} v ON e.child = v.node AND e.bucket = v.bucket" if evals else "LEFT JOIN (SELECT NULL::DOUBLE AS eval_w, NULL::DOUBLE AS eval_b) v ON true"
    s = f"list_extract({S_PRIOR}::DOUBLE[], bucket + 1)"
    return [
        f"raw{k} AS (SELECT e.*, (e.ww + 0.5::DOUBLE * e.d) / e.n AS edge, c.cnt AS child_cnt, v.eval_w, v.eval_b, e.move NOT IN ('(TERM)', '(AGG)') AND coalesce(c.cnt, 0) > 0 AND v.eval_w IS NOT NULL AS resolved FROM edges e LEFT JOIN sums c ON e.child = c.node AND e.bucket = c.bucket {join})",
        f"rows{k} AS (SELECT *, CASE WHEN resolved THEN eval_w ELSE edge END AS x_w, CASE WHEN resolved THEN eval_b ELSE edge END AS x_b FROM raw{k})",
        f"crowd{k} AS (SELECT node, stm, bucket, sum(n * x_w) / sum(n) AS chance_w, sum(n * x_b) / sum(n) AS chance_b FROM rows{k} GROUP BY ALL)",
        f"base{k} AS (SELECT r.*, CASE WHEN r.stm = 'w' THEN x_w ELSE x_b END AS value, CAST(CASE WHEN resolved THEN child_cnt ELSE n END AS DOUBLE) AS evidence, CASE WHEN r.stm = 'w' THEN chance_w ELSE chance_b END AS chance, coalesce(p.prior, 0.5) AS prior, coalesce(p.kish, 0.0)::DOUBLE AS kish FROM rows{k} r JOIN crowd{k} w USING (node, bucket) LEFT JOIN prior p ON r.child = p.node AND r.bucket = p.bucket WHERE r.move NOT IN ('(TERM)', '(AGG)'))",
        f"str{k} AS (SELECT *, {s} * kish / ({s} + kish) AS strength FROM base{k})",
        f"cand{k} AS (SELECT *, score - sgn * 2 * sd AS bound, evidence + kish AS support, evidence + kish > 150 AS solid FROM (SELECT *, CASE WHEN stm = 'w' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sgn, (evidence * value + strength * prior + 30 * chance) / (evidence + strength + 30) AS score, 0.5 * sqrt(evidence + CASE WHEN kish > 0 THEN strength * strength / kish ELSE 0 END) / (evidence + strength + 30) AS sd FROM str{k}))",
        f"pick{k} AS (SELECT node, bucket, move AS best_move, score AS best_score FROM (SELECT *, row_number() OVER (PARTITION BY node, bucket ORDER BY round(-sgn * bound, 12), move) AS rk FROM cand{k}) WHERE rk = 1)",
        f"v{k} AS (SELECT w.node, w.stm, w.bucket, best_move, CASE WHEN w.stm = 'w' THEN coalesce(best_score, pts / cnt) ELSE chance_w END AS eval_w, CASE WHEN w.stm = 'w' THEN chance_b ELSE coalesce(best_score, pts / cnt) END AS eval_b FROM crowd{k} w LEFT JOIN pick{k} USING (node, bucket) JOIN sums USING (node, bucket))",
    ]


ONE = [*GRAPH, SUMS, PRIOR, *_step_sql(1, None)]
SWEEPS = 4
SOLVE = [*GRAPH, SUMS, PRIOR, "v0 AS (SELECT node, bucket, 0.5::DOUBLE AS eval_w, 0.5::DOUBLE AS eval_b FROM sums)", *(x for k in range(1, SWEEPS + 2) for x in _step_sql(k, f"v{k - 1}"))]


def _one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of one backup without known values."""
    edges = _edges(spark, sf_dir)
    sums = G.band_sums(edges)
    rows = G.children(edges, sums, None)
    return G.candidates(rows, G.chance(rows), G.neighbour_prior(sums))


@query(_with(*GRAPH) + "SELECT * FROM plays")
def scan_plays(spark, sf_dir):
    return _plays(spark, sf_dir)


@query(_with(*TREE) + "SELECT * FROM edges")
def tally_edges(spark, sf_dir):
    return _edges(spark, sf_dir, True)


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(CASE WHEN c_acctbal < 1000 THEN 0 WHEN c_acctbal >= 2400 THEN 8 ELSE floor((c_acctbal - 1000) / 200) + 1 END AS INT) AS band FROM customer")
def rating_band(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select("c_custkey", R.rating_band(F.col("c_acctbal")).alias("band"))


_MONTHS = [*TREE[:2], *TREE[2:]]


@query(_with(*TREE, "t AS (SELECT node, sum(n) AS total FROM edges GROUP BY node)") + "SELECT e.* FROM edges e JOIN t USING (node) WHERE total >= 5")
def merge_months_floor(spark, sf_dir):
    plays = stored(_plays(spark, sf_dir, True), "plays")
    odd = F.col("bucket") % 2 == 1
    return T.merge([T.tally(plays.where(odd)), T.tally(plays.where(~odd))])


@query(_with(*GRAPH) + "SELECT node, bucket, CAST(sum(n) AS BIGINT) n, CAST(sum(ww) AS BIGINT) ww, CAST(sum(d) AS BIGINT) d FROM edges GROUP BY GROUPING SETS ((node, bucket), (node))")
def node_totals(spark, sf_dir):
    return T.node_totals(_edges(spark, sf_dir))


@query(_with(*TREE, CLASSES) + "SELECT * FROM classes")
def classify_nodes(spark, sf_dir):
    return T.classify(_edges(spark, sf_dir, True))


_REACH = "RECURSIVE " + ",\n".join([*TREE, CLASSES, "reach AS (SELECT node, 0 AS depth FROM classes WHERE node = 'w:^/' AND class <> 'DROPPED' UNION SELECT e.child, r.depth + 1 FROM reach r JOIN classes c ON c.node = r.node AND c.class = 'FULL' JOIN edges e ON e.node = r.node JOIN classes k ON k.node = e.child AND k.class <> 'DROPPED')"])


@query(f"WITH {_REACH}\nSELECT node, CAST(min(depth) AS INT) AS depth FROM reach GROUP BY node")
def reachable_tree(spark, sf_dir):
    edges = _edges(spark, sf_dir, True, True)
    return G.reachable(edges, T.classify(edges), TREE_ROOT)


@query(_with(*TREE, CLASSES) + "SELECT DISTINCT e.child AS node FROM edges e JOIN classes c ON c.node = e.node AND c.class <> 'DROPPED' JOIN classes k ON k.node = e.child AND k.class = 'DROPPED'")
def dropped_children(spark, sf_dir):
    edges = _edges(spark, sf_dir, True, True)
    classes = T.classify(edges)
    kept = classes.where("class <> 'DROPPED'").select("node")
    return edges.join(kept, "node", "left_semi").where("child is not null").select(F.col("child").alias("node")).distinct().join(kept, "node", "left_anti")


_POOL = "pooled AS (SELECT e.node, e.stm, CASE WHEN p THEN '(AGG)' ELSE move END AS move, CASE WHEN p THEN NULL ELSE child END AS child, bucket, n, ww, d FROM (SELECT e.*, e.move <> '(TERM)' AND (c.class = 'LEAF' OR coalesce(k.class = 'DROPPED', true)) AS p FROM edges e JOIN classes c ON c.node = e.node AND c.class <> 'DROPPED' LEFT JOIN classes k ON k.node = e.child) e)"


@query(_with(*TREE, CLASSES, _POOL) + "SELECT node, stm, move, child, bucket, CAST(sum(n) AS BIGINT) n, CAST(sum(ww) AS BIGINT) ww, CAST(sum(d) AS BIGINT) d FROM pooled GROUP BY ALL")
def pooled_children(spark, sf_dir):
    edges = _edges(spark, sf_dir, True, True)
    return T.pool(edges, T.classify(edges))


@query(_with(*GRAPH) + "SELECT node, move, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (bucket = {b}), 0) AS BIGINT) AS n{b}" for b in range(9)) + " FROM edges GROUP BY ALL")
def band_pivot(spark, sf_dir):
    return T.pivot_bands(_edges(spark, sf_dir))


@query(_with(*GRAPH, SUMS) + "SELECT * FROM sums")
def bucket_sums(spark, sf_dir):
    return G.band_sums(_edges(spark, sf_dir))


@query(_with(*TREE, SUMS, PRIOR) + "SELECT node, bucket, round(coalesce(pts / cnt, prior), 6) AS own FROM prior FULL JOIN sums USING (node, bucket)")
def empty_bucket_prior(spark, sf_dir):
    return rounded(G.empty_band_prior(stored(G.band_sums(_edges(spark, sf_dir, True)), "sums")))


@query(_with(*GRAPH, SUMS, PRIOR) + "SELECT node, bucket, round(prior, 6) AS prior, round(kish, 6) AS kish FROM prior")
def neighbour_prior(spark, sf_dir):
    return rounded(G.neighbour_prior(G.band_sums(_edges(spark, sf_dir))))


@query(_with(*ONE) + "SELECT node, stm, bucket, round(chance_w, 6) AS chance_w, round(chance_b, 6) AS chance_b FROM crowd1")
def crowd_value(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return rounded(G.chance(G.children(edges, G.band_sums(edges), None)))


@query(_with(*ONE) + "SELECT node, bucket, move, round(score, 6) AS score, round(sd, 6) AS sd, round(bound, 6) AS bound, round(support, 6) AS support, solid FROM cand1")
def candidate_scores(spark, sf_dir):
    return rounded(_one(spark, sf_dir).select("node", "bucket", "move", "score", "sd", "bound", "support", "solid"))


@query(_with(*ONE) + "SELECT node, bucket, best_move, round(best_score, 6) AS best_score FROM pick1")
def pick_best(spark, sf_dir):
    return rounded(G.picks(_one(spark, sf_dir)))


@query(_with(*ONE) + "SELECT node, bucket, move, CAST(row_number() OVER (PARTITION BY node, bucket ORDER BY -sgn * bound, move) - 1 AS INT) AS rank FROM cand1")
def rank_all(spark, sf_dir):
    return G.rank_all(_one(spark, sf_dir)).select("node", "bucket", "move", "rank")


@query(_with(*ONE) + "SELECT node, bucket, move, CAST(row_number() OVER (PARTITION BY node, bucket ORDER BY CASE WHEN move = 'click' AND stm = 'w' THEN 1 ELSE 0 END, -sgn * bound, move) - 1 AS INT) AS rank FROM cand1")
def rank_demoted(spark, sf_dir):
    flags = _edges(spark, sf_dir).where("move = 'click' and stm = 'w'").select("node", "move").distinct()
    return G.rank_all(_one(spark, sf_dir), flags).select("node", "bucket", "move", "rank")


@query(_with(*GRAPH) + "SELECT node, bucket, move, n FROM (SELECT *, row_number() OVER (PARTITION BY node, bucket ORDER BY n DESC, move) AS rk FROM edges WHERE move NOT IN ('(TERM)', '(AGG)')) WHERE rk = 1")
def popular_move(spark, sf_dir):
    return A.popular_moves(_edges(spark, sf_dir))


@query(_with(*SOLVE) + f"SELECT node, stm, bucket, best_move, round(eval_w, 6) AS eval_w, round(eval_b, 6) AS eval_b FROM v{SWEEPS}")
def solve_cyclic(spark, sf_dir):
    return rounded(G.solve(_edges(spark, sf_dir), SWEEPS))


@query(_with(*SOLVE) + f"SELECT a.node, a.bucket, round(greatest(abs(a.eval_w - b.eval_w), abs(a.eval_b - b.eval_b)), 6) AS delta, a.best_move IS NOT DISTINCT FROM b.best_move AS same_pick, greatest(abs(a.eval_w - b.eval_w), abs(a.eval_b - b.eval_b)) <= 2e-3 AS within FROM v{SWEEPS + 1} a JOIN v{SWEEPS} b USING (node, bucket)")
def verify_invariants(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return rounded(G.verify(edges, G.solve(edges, SWEEPS)))


@query()
def solve_converged(spark, sf_dir):
    return rounded(G.settled(_edges(spark, sf_dir)))


@query()
def verify_converged(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return rounded(G.verify(edges, G.settled(edges)))


@query()
def offenders_converged(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return rounded(A.offenders(G.verify(edges, G.settled(edges))).select("node", "bucket", "delta"))


@query(_with(*GRAPH) + "SELECT bucket, move, n, ww, d, n - ww - d AS bw, round((ww + 0.5 * d) / n, 6) AS score, round(n / sum(n) OVER (PARTITION BY bucket), 6) AS share, CAST(row_number() OVER (PARTITION BY bucket ORDER BY n DESC, move) AS INT) AS place FROM edges WHERE node = 'w:^'")
def position_stats(spark, sf_dir):
    return rounded(A.position_stats(_edges(spark, sf_dir), ROOT))


_CAL = f"cal AS (SELECT o.bucket, o.w, o.p / o.c - s.pts / s.cnt AS miss, s.cnt FROM (SELECT s.node, b.bucket, g.w, sum(pow(g.w, abs(s.bucket - b.bucket)) * pts) AS p, sum(pow(g.w, abs(s.bucket - b.bucket)) * cnt) AS c FROM sums s, (SELECT unnest(range(9))::INT AS bucket) b, (SELECT unnest({GRID}::DOUBLE[]) AS w) g WHERE s.bucket <> b.bucket GROUP BY ALL) o JOIN sums s ON s.node = o.node AND s.bucket = o.bucket WHERE o.c > 0 AND s.cnt >= 50)"


@query(_with(*GRAPH, SUMS, _CAL) + "SELECT bucket, w, count(*) AS n_targets, round(sum(miss * miss), 6) AS sse, count(*) FILTER (cnt >= 100) AS drift_cells, round(coalesce(sum(miss * miss) FILTER (cnt >= 100), 0.0), 6) AS drift_sse FROM cal GROUP BY ALL")
def calibrate_grid(spark, sf_dir):
    return rounded(A.calibration_cells(G.band_sums(_edges(spark, sf_dir)), 50, 100))


_BEST = "best AS (SELECT bucket, w, sse / k AS mse, dk, dsse FROM (SELECT bucket, w, count(*) AS k, sum(miss * miss) AS sse, count(*) FILTER (cnt >= 100) AS dk, coalesce(sum(miss * miss) FILTER (cnt >= 100), 0.0) AS dsse, row_number() OVER (PARTITION BY bucket ORDER BY sum(miss * miss) / count(*), w) AS rk FROM cal GROUP BY bucket, w) WHERE rk = 1)"
_SPREAD = "spread AS (SELECT bucket, sum(i) / sum(n) AS sigma2, coalesce(sum(i / n / n) FILTER (n >= 100), 0.0) AS noise FROM (SELECT *, (ww / n + 0.25::DOUBLE * d / n - pow((ww + 0.5::DOUBLE * d) / n, 2)) * n AS i FROM (SELECT node, bucket, sum(n)::DOUBLE n, sum(ww)::DOUBLE ww, sum(d)::DOUBLE d FROM edges GROUP BY ALL)) GROUP BY bucket)"


@query(_with(*GRAPH, SUMS, _CAL, _BEST, _SPREAD) + "SELECT bucket, w, round(mse, 6) AS mse, round(CASE WHEN dk = 0 THEN NULL WHEN dsse <= noise THEN 2000.0 ELSE least(2000.0, sigma2 / ((dsse - noise) / dk)) END, 6) AS strength FROM best JOIN spread USING (bucket)")
def calibrate_shrinkage(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return rounded(A.calibrate(edges, G.band_sums(edges), 50, 100))


@query(_with(*GRAPH, "o AS (SELECT node, move, CAST(sum(n) AS BIGINT) o_n, CAST(sum(ww) AS BIGINT) o_ww, CAST(sum(d) AS BIGINT) o_d FROM edges WHERE bucket < 6 GROUP BY ALL)", "m AS (SELECT node, move, CAST(sum(n) AS BIGINT) m_n, CAST(sum(ww) AS BIGINT) m_ww, CAST(sum(d) AS BIGINT) m_d FROM edges WHERE bucket >= 6 AND node IN (SELECT node FROM o) GROUP BY ALL)") + "SELECT node, move, coalesce(o_n, 0) o_n, coalesce(o_ww, 0) o_ww, coalesce(o_d, 0) o_d, coalesce(m_n, 0) m_n, coalesce(m_ww, 0) m_ww, coalesce(m_d, 0) m_d FROM o FULL JOIN m USING (node, move)")
def oracle_month_join(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return T.join_months(edges.where("bucket < 6"), edges.where("bucket >= 6"))


@query(_with(*GRAPH, SHARES) + "SELECT node, bucket, move, child, round(share, 6) AS share FROM shares")
def shares(spark, sf_dir):
    return rounded(A.shares(_edges(spark, sf_dir)))


def _flow_sql(depth: int) -> list[str]:
    out = [SHARES, "m0 AS (SELECT DISTINCT bucket, node, 1.0::DOUBLE AS mass FROM shares WHERE node = 'w:^')"]
    return out + [f"m{k} AS (SELECT s.bucket, s.child AS node, sum(mass * share) AS mass FROM m{k - 1} m JOIN shares s USING (node, bucket) WHERE s.move NOT IN ('(TERM)', '(AGG)') GROUP BY ALL)" for k in range(1, depth + 1)]


@query(_with(*GRAPH, *_flow_sql(3), "r AS (SELECT bucket, mass, sum(mass) OVER (PARTITION BY bucket ORDER BY round(mass, 12) DESC, node ROWS UNBOUNDED PRECEDING) / sum(mass) OVER (PARTITION BY bucket) AS run, row_number() OVER (PARTITION BY bucket ORDER BY round(mass, 12) DESC, node) AS place FROM m3)") + "SELECT bucket, count(*) AS positions, round(sum(mass), 6) AS mass, " + ", ".join(f"CAST(min(place) FILTER (run >= {q / 100} - 1e-9) AS INT) AS cover{q}" for q in (50, 90, 99)) + " FROM r GROUP BY bucket")
def spread_depth_3(spark, sf_dir):
    return rounded(A.spread(_edges(spark, sf_dir), ROOT, 3))


def _target_sql(plies: int) -> list[str]:
    out = [SHARES, "t0 AS (SELECT DISTINCT bucket, node, NULL::VARCHAR AS sink, 1.0::DOUBLE AS mass FROM shares WHERE node = 'w:^')"]
    sink = f"CASE WHEN s.move IS NULL THEN 'stuck' WHEN s.move = '(TERM)' THEN 'ended' WHEN s.move = '(AGG)' THEN 'pooled' WHEN s.child = '{TARGET}' THEN 'arrived' END"
    return out + [f"t{k} AS (SELECT m.bucket, s.child AS node, {sink} AS sink, sum(mass * coalesce(share, 1.0)) AS mass FROM t{k - 1} m LEFT JOIN shares s ON s.node = m.node AND s.bucket = m.bucket WHERE m.sink IS NULL GROUP BY ALL)" for k in range(1, plies + 1)]


@query(_with(*GRAPH, *_target_sql(3)) + "SELECT bucket, sink, round(sum(mass), 6) AS mass FROM (" + " UNION ALL ".join(f"SELECT bucket, sink, mass FROM t{k} WHERE sink IS NOT NULL" for k in (1, 2, 3)) + " UNION ALL SELECT bucket, 'unplayed', mass FROM t3 WHERE sink IS NULL) GROUP BY ALL")
def target_flow_sinks(spark, sf_dir):
    return rounded(A.target_flow(_edges(spark, sf_dir), ROOT, TARGET, 3))


@query(_with(*GRAPH) + "SELECT node, bucket, move, child, n, ww, d, CAST(h - n AS BIGINT) AS low, CAST(h AS BIGINT) AS high, CAST(a AS BIGINT) AS \"all\" FROM (SELECT *, sum(n) OVER (PARTITION BY node, bucket ORDER BY move ROWS UNBOUNDED PRECEDING) AS h, sum(n) OVER (PARTITION BY node, bucket) AS a FROM edges)")
def inverse_cdf_draw(spark, sf_dir):
    return A.draw_tables(_edges(spark, sf_dir))


@query(_with(*GRAPH) + "SELECT * FROM (SELECT node, stm, bucket, CAST(sum(n) AS BIGINT) AS n, CAST(row_number() OVER (PARTITION BY bucket, stm ORDER BY md5(node), node) AS INT) AS place FROM edges GROUP BY node, stm, bucket HAVING sum(n) >= 20) WHERE place <= 3")
def sample_stratified(spark, sf_dir):
    return A.sample_nodes(_edges(spark, sf_dir), 3, 20)


_RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY node, bucket ORDER BY -sgn * bound, move) - 1 AS rank FROM cand1)"
_LOSS = "loss AS (SELECT *, greatest(0.0, sgn * (first_value(score) OVER (PARTITION BY node, bucket ORDER BY rank) - score)) AS loss, n / sum(n) OVER (PARTITION BY node, bucket) AS share FROM ranked)"


@query(_with(*ONE, _RANKED, _LOSS) + "SELECT node, bucket, move, CAST(rank AS INT) AS rank, round(loss, 6) AS loss, round(share, 6) AS share, CASE WHEN rank = 0 THEN 'best' WHEN loss <= 0.02 THEN 'excellent' ELSE 'suboptimal' END AS grade, share < 0.05 AS sideline FROM loss")
def training_rows(spark, sf_dir):
    return rounded(A.training_rows(G.rank_all(_one(spark, sf_dir))))


@query(f"WITH b AS (SELECT unnest({[*BOUNDS, None]}::DOUBLE[]) AS le, unnest({[None, *BOUNDS]}::DOUBLE[]) AS over_) SELECT le, (SELECT count(*) FROM events WHERE (over_ IS NULL OR value > over_) AND (le IS NULL OR value <= le)) AS n, (SELECT count(*) FROM events WHERE value IS NOT NULL AND (le IS NULL OR value <= le)) AS total FROM b".replace("None", "NULL"))
def latency_histogram(spark, sf_dir):
    return A.latency_histogram(_table(spark, sf_dir, "events"), BOUNDS)


@query("SELECT event_type AS k, CAST(sum(CAST(value AS BIGINT)) AS BIGINT) AS total FROM (SELECT event_type, floor(value) AS value FROM events WHERE value IS NOT NULL) GROUP BY event_type")
def client_counter_merge(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return counter_totals(events.select(F.concat_ws("=", "event_type", F.floor("value").cast("string")).alias("header")))


_HEADERS = "heads AS (SELECT CAST(o_orderkey AS BIGINT) AS game_id, 1000 + o_custkey % 900 AS we, 1000 + o_orderkey % 900 AS be, o_orderkey % 80 AS wd, CASE WHEN o_orderkey % 7 = 0 THEN 'BOT' END AS title, CASE o_orderpriority[1:1] WHEN '1' THEN '60+0' WHEN '2' THEN '-' ELSE '300+3' END AS tc, CASE o_orderstatus WHEN 'F' THEN '1-0' WHEN 'O' THEN '0-1' ELSE '1/2-1/2' END AS result FROM orders)"


@query(_with(_HEADERS) + "SELECT game_id, CAST(CASE WHEN (we + be) // 2 < 1000 THEN 0 WHEN (we + be) // 2 >= 2400 THEN 8 ELSE ((we + be) // 2 - 1000) // 200 + 1 END AS INT) AS bucket, CAST(result = '1-0' AS INT) AS ww, CAST(result = '1/2-1/2' AS INT) AS d FROM heads WHERE abs(we - be) <= 200 AND abs(wd) < 40 AND coalesce(title <> 'BOT', true) AND tc = '300+3'")
def header_filters(spark, sf_dir):
    k = F.col("o_orderkey")
    first = F.substring("o_orderpriority", 1, 1)
    heads = _table(spark, sf_dir, "orders").select(
        k.alias("game_id"), (1000 + F.col("o_custkey") % 900).cast("string").alias("white_elo"), (1000 + k % 900).cast("string").alias("black_elo"), F.concat(F.lit("+"), (k % 80).cast("string")).alias("white_diff"), F.lit(None).cast("string").alias("black_diff"),
        F.when(first == "1", "60+0").when(first == "2", "-").otherwise("300+3").alias("time_control"), F.when(k % 7 == 0, "BOT").alias("white_title"), F.lit(None).cast("string").alias("black_title"),
        F.when(F.col("o_orderstatus") == "F", "1-0").when(F.col("o_orderstatus") == "O", "0-1").otherwise("1/2-1/2").alias("result"),
    )
    return A.header_filter(heads)


_DENSE = "RECURSIVE " + ",\n".join([*GRAPH, "kept AS (SELECT node FROM edges GROUP BY node HAVING sum(n) >= 50)", "reach AS (SELECT node, 0 AS depth FROM kept WHERE node = 'w:^' UNION SELECT e.child, r.depth + 1 FROM reach r JOIN edges e ON e.node = r.node JOIN kept k ON k.node = e.child WHERE r.depth < 5)", "depths AS (SELECT node, min(depth) AS depth FROM reach GROUP BY node)"])


@query(f"WITH {_DENSE}\nSELECT DISTINCT e.node, e.move, e.child, CAST(a.depth AS INT) AS depth, CASE WHEN e.move = '(TERM)' THEN 'TERM' WHEN e.move = '(AGG)' THEN 'AGG' WHEN b.depth IS NULL THEN 'THIN' WHEN b.depth = a.depth + 1 THEN 'TREE' ELSE 'BACK' END AS kind FROM edges e JOIN depths a ON a.node = e.node LEFT JOIN depths b ON b.node = e.child")
def edge_kinds(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    classes = T.classify(edges, 50, 50)
    return A.edge_kinds(edges, G.reachable(edges, classes, ROOT, 5))


def _value_sql(plies: int, best: bool) -> list[str]:
    hit = f"CASE WHEN s.child = '{TARGET}' THEN 1.0::DOUBLE ELSE coalesce(v.value, 0.0) END"
    crowd = f"sum(share * ({hit}))"
    pick = f"CASE WHEN left(s.node, 1) = 'w' THEN max({hit}) ELSE {crowd} END" if best else crowd
    out = [SHARES, "real AS (SELECT * FROM shares WHERE move NOT IN ('(TERM)', '(AGG)'))", "u0 AS (SELECT DISTINCT node, bucket, 0.0::DOUBLE AS value FROM real)"]
    return out + [f"u{k} AS (SELECT s.node, s.bucket, {pick} AS value FROM real s LEFT JOIN u{k - 1} v ON v.node = s.child AND v.bucket = s.bucket GROUP BY s.node, s.bucket)" for k in range(1, plies + 1)]


@query(_with(*GRAPH, *_value_sql(3, False)) + "SELECT node, bucket, round(value, 6) AS value FROM u3")
def target_value_field(spark, sf_dir):
    return rounded(A.target_value(_edges(spark, sf_dir), TARGET, 3, False))


@query(_with(*GRAPH, *_value_sql(3, True)) + "SELECT node, bucket, round(value, 6) AS value FROM u3")
def target_value_best(spark, sf_dir):
    return rounded(A.target_value(_edges(spark, sf_dir), TARGET, 3, True))


def _beam_sql(depth: int, width: int) -> list[str]:
    out = [SHARES, "b0 AS (SELECT DISTINCT bucket, node, 1.0::DOUBLE AS mass FROM shares WHERE node = 'w:^/')"]
    for k in range(1, depth + 1):
        out.append(f"r{k} AS (SELECT s.bucket, s.child AS node, sum(mass * share) AS mass FROM b{k - 1} m JOIN shares s USING (node, bucket) WHERE s.move NOT IN ('(TERM)', '(AGG)') GROUP BY ALL)")
        out.append(f"b{k} AS (SELECT * FROM r{k} WHERE node IN (SELECT node FROM r{k} GROUP BY node ORDER BY round(max(mass), 12) DESC, node LIMIT {width}))")
    return out


@query(_with(*TREE, *_beam_sql(3, 10)) + "SELECT bucket, node, round(mass, 6) AS mass FROM b3")
def beam_spread(spark, sf_dir):
    return rounded(A.beam(_edges(spark, sf_dir, True), TREE_ROOT, 3, 10))


@query(_with(*SOLVE, f"checked AS (SELECT a.node, a.bucket, greatest(abs(a.eval_w - b.eval_w), abs(a.eval_b - b.eval_b)) AS delta FROM v{SWEEPS + 1} a JOIN v{SWEEPS} b USING (node, bucket))") + "SELECT node, bucket, round(delta, 6) AS delta FROM checked ORDER BY round(delta, 9) DESC, node, bucket LIMIT 15")
def top_offenders(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return rounded(A.offenders(G.verify(edges, G.solve(edges, SWEEPS))).select("node", "bucket", "delta"))


@query("SELECT event_id, round((value - lag(value) OVER w) / ((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6), 6) AS rate FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def rate_per_second(spark, sf_dir):
    return rounded(A.rates(_table(spark, sf_dir, "events")))
