"""Sweeps over parts of a graph that are small enough to be one group of rows each, inside the tasks.

A value hangs on values of its own band only, so a band of a strong component, or of a whole graph, is a part that can
be settled by itself. Parts of more than MOST_ROWS rows are left to the caller, which sweeps over them with joins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.functions.constants import K0, Z

#: Rows of around() in one part.
MOST_ROWS = 50_000


class Part:
    """The rows of one part in arrays, and one backup of its nodes."""

    def __init__(self, rows: pd.DataFrame):
        self.rows = rows = rows.sort_values(["node", "move"], na_position="last", ignore_index=True)  # so that the first of equal bounds is the smallest move
        self.nodes = nodes = rows[rows["self"]].reset_index(drop=True)
        place = pd.Index(nodes["node"])
        self.at, self.via = place.get_indexer(rows["node"]), place.get_indexer(rows["via"])
        number = lambda c, like=float: rows[c].fillna(0).to_numpy(like)
        self.n, self.x_w, self.x_b, self.prior, self.evidence, self.strength, self.sd = map(number, ("n", "x_w", "x_b", "prior", "evidence", "strength", "sd"))
        self.inside, self.real = (rows[c].fillna(False).to_numpy(bool) for c in ("inside", "real"))
        self.count, self.own, self.white = len(nodes), nodes["own"].to_numpy(float), (nodes["stm"] == "w").to_numpy()
        self.side = np.where(self.white, 1.0, -1.0)[self.at]
        self.all_n = np.bincount(self.at, self.n, self.count)

    def backup(self, values: np.ndarray, x_w: np.ndarray, x_b: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of all nodes, rows of their picks or -1), where rows that wait for no node have the values x_w and x_b."""
        at, side = self.at, self.side
        x = np.where(self.inside, values[self.via, 0], x_w), np.where(self.inside, values[self.via, 1], x_b)
        crowd = np.column_stack([np.bincount(at, self.n * y, self.count) / self.all_n for y in x])
        chance = np.where(self.white, crowd[:, 0], crowd[:, 1])[at]
        score = (self.evidence * np.where(side > 0, *x) + self.strength * self.prior + K0 * chance) / (self.evidence + self.strength + K0)
        key = np.where(real, np.round(-side * (score - side * Z * self.sd), 12), np.inf)
        least = np.full(self.count, np.inf)
        np.minimum.at(least, at, key)
        firsts = np.flatnonzero(real & (key == least[at]))
        who, first = np.unique(at[firsts], return_index=True)
        pick = np.full(self.count, -1)
        pick[who] = firsts[first]
        mine = np.where(pick >= 0, score[pick], self.own)
        return np.column_stack([np.where(self.white, mine, crowd[:, 0]), np.where(self.white, crowd[:, 1], mine)]), pick

    def named(self, pick: np.ndarray) -> dict:
        """The nodes with the moves of their picks."""
        moves = self.rows["move"].to_numpy(object)
        return {"node": self.nodes["node"], "stm": self.nodes["stm"], "bucket": self.nodes["bucket"], "best_move": np.where(pick >= 0, moves[pick], None)}


def sweeps(rows: pd.DataFrame, tolerance: float, freeze_after: int, most: int, asked_only: bool) -> pd.DataFrame:
    """A row for each node of one part: its values, sweeps and backups, whether picks were kept, and whether it still moves.

    asked_only: a node is backed up again only if a child has moved by the tolerance since it last told its value, and
    tells its own only then. Otherwise each is backed up in every sweep until none moves.
    """
    part = Part(rows)
    count, real = part.count, part.real
    values, best = np.full((count, 2), 0.5), np.full(count, -1)
    asked = np.ones(count, bool)
    last, backups, moved, frozen, sweep = np.zeros(count, int), np.zeros(count, int), asked, False, 0
    while moved.any() and sweep < most:
        sweep += 1
        new, pick = part.backup(values, part.x_w, part.x_b, real)
        moved = asked & (np.abs(new - values).max(1) >= tolerance)
        values = np.where((moved if asked_only else asked)[:, None], new, values)
        best, last, backups = np.where(asked, pick, best), np.where(asked, sweep, last), backups + asked
        if asked_only:
            asked = np.bincount(part.at[part.inside & moved[part.via]], minlength=count) > 0
        if sweep == freeze_after and moved.any():
            real, frozen = real & (np.arange(len(rows)) == best[part.at]), bool(asked.any())
    return pd.DataFrame({**part.named(best), "eval_w": values[:, 0], "eval_b": values[:, 1], "sweeps": last, "backups": backups, "frozen": frozen, "moved": moved})


def course(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """A row for each node of one part: its pick in sweep `most` of the whole graph from 0.5, and its values after each sweep.

    course_w, course_b of a row: the values of a child outside after each sweep. Where a course ends, its last value stays.
    """
    part = Part(rows)
    given = [part.rows[c].to_numpy(object) for c in ("course_w", "course_b")]
    outer = np.flatnonzero([x is not None for x in given[0]])
    size = np.array([len(x) for x in given[0][outer]], int)
    flat = [np.concatenate(x[outer]).astype(float) if len(outer) else np.zeros(0) for x in given]
    start, longest = np.cumsum(size) - size, max(size, default=0)
    values, found, pick = np.full((part.count, 2), 0.5), [], np.full(part.count, -1)
    for sweep in range(1, most + 1):
        x = [part.x_w.copy(), part.x_b.copy()]
        for y, z in zip(x, flat, strict=True):
            y[outer] = 0.5 if sweep == 1 else z[start + np.minimum(sweep - 1, size) - 1]
        new, pick = part.backup(values, *x, part.real)
        if found and sweep > longest and (new == values).all():
            break  # all further sweeps are this one
        values = new
        found.append(new)
    both = np.array(found).transpose(2, 1, 0)
    return pd.DataFrame({**part.named(pick), "course_w": list(both[0]), "course_b": list(both[1])})


def settle(rows: DataFrame, part: list[str], tolerance: float, freeze_after: int, most: int, asked_only: bool) -> DataFrame:
    """sweeps() over each part of rows of around(), which must be of at most MOST_ROWS rows; part: columns that tell them."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    own = [c for c in part if c != "bucket"]
    schema = ", ".join([f"node {kind['node']}, stm {kind['stm']}, bucket {kind['bucket']}, best_move {kind['move']}, eval_w double, eval_b double, sweeps int, backups long, frozen boolean, moved boolean", *(f"{c} {kind[c]}" for c in own)])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return sweeps(group, tolerance, freeze_after, most, asked_only).assign(**{c: group[c].iloc[0] for c in own})

    return rows.groupBy(*part).applyInPandas(run, schema)


def courses(rows: DataFrame, part: list[str], most: int) -> DataFrame:
    """course() of each part of rows of around() with course_w and course_b."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"node {kind['node']}, stm {kind['stm']}, bucket {kind['bucket']}, best_move {kind['move']}, course_w array<double>, course_b array<double>"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return course(group, most)

    return rows.groupBy(*part).applyInPandas(run, schema)


def sized(rows: DataFrame, part: list[str]) -> DataFrame:
    """(part, small) of every part."""
    return rows.groupBy(*part).agg((F.count("*") <= MOST_ROWS).alias("small"))
