"""Column expressions of the ranking rule; scores are White's points per game."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arbora.functions.constants import AGG, K0, NEIGHBOUR_WEIGHT, S_PRIOR, TERM, Z


def by_band(values: list[float], band: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), band.cast("int") + 1)


def edge_score(n: Column, ww: Column, d: Column) -> Column:
    return (ww + F.lit(0.5) * d) / n


def rating_band(rating: Column) -> Column:
    """0 under 1000, then 200 wide, 8 from 2400 on."""
    return F.width_bucket(rating, F.lit(1000), F.lit(2400), F.lit(7)).cast("int")


def is_real(move: Column) -> Column:
    return ~move.isin(TERM, AGG)


def neighbour_weight(band: Column, other: Column) -> Column:
    return F.pow(by_band(NEIGHBOUR_WEIGHT, band), F.abs(band - other).cast("double"))


def effective_strength(band: Column, kish: Column) -> Column:
    s = by_band(S_PRIOR, band)
    return s * kish / (s + kish)


def score(value: Column, evidence: Column, prior: Column, strength: Column, chance: Column) -> Column:
    return (evidence * value + strength * prior + K0 * chance) / (evidence + strength + K0)


def deviation(evidence: Column, strength: Column, kish: Column) -> Column:
    extra = F.when(kish > 0, strength * strength / kish).otherwise(0.0)
    return 0.5 * F.sqrt(evidence + extra) / (evidence + strength + K0)


def side(stm: Column) -> Column:
    return F.when(stm == "w", 1.0).otherwise(-1.0)


def bound(score_: Column, deviation_: Column, stm: Column) -> Column:
    return score_ - side(stm) * Z * deviation_


def place(bound_: Column, stm: Column) -> Column:
    """What the best pick has least of: its bound from the side to move, to 12 places, so that equal ones tie whatever the order of sums."""
    return F.round(-side(stm) * bound_, 12)
