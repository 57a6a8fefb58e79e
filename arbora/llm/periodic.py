"""Stretches of a text that repeat the same words over and over.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least four periods, which
no neighbouring word extends. Periods are looked for by scale: for blocks of B = 2, 4, 8, ... words, those of (2B - 1) / 3
up to below (4B - 1) / 3 words. A run of such a period holds a block that starts at a multiple of B, and the same block
again one period later. So the blocks at multiples of B become keys of an automaton over word numbers, it is run over the
document, and each place where a block occurs again at a distance of the scale is extended word by word both ways. The
distance is the smallest period unless a run of a smaller scale, or of a smaller distance, has the same ends.

Only stretches in which every four words occur again nearby are looked at; in a run of that scale, all do. The automaton
is built for windows of a stretch, so it stays small as long as the blocks are; for the longest blocks it grows with the
text.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbora.llm.text import few, mix, split_words, tidy

PERIODS, WORDS = 4, 6
WINDOW = 1 << 17
GRAM = 4
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
ODD = np.uint64(0x9E3779B97F4A7C15)


def least_length(period: int) -> int:
    return max(WORDS, PERIODS * period)


def recurrence(ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, distances): where four words of a row begin that the row has again, and how far off the nearest ones are."""
    if len(ids) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.flatnonzero(row[: 1 - GRAM] == row[GRAM - 1 :])
    h = mix(row[place].astype(np.uint64) * ODD + np.uint64(1))
    for k in range(GRAM):
        h = mix(h + ids[place + k].astype(np.uint64))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    gap = np.where(same, np.diff(place[order]), np.iinfo(np.int64).max)
    near = np.minimum(np.append(gap, np.iinfo(np.int64).max), np.insert(gap, 0, np.iinfo(np.int64).max)) if len(place) else gap
    some = near < np.iinfo(np.int64).max
    place, near = place[order][some], near[some]
    order = np.argsort(place)
    return place[order], near[order]


def stretches(place: np.ndarray, least: int) -> np.ndarray:
    """(begin, end) of words of unbroken sequences of places, that are long enough."""
    if not len(place):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(place) > 1)
    found = np.stack([place[np.insert(cut + 1, 0, 0)], place[np.append(cut, len(place) - 1)] + GRAM], 1)
    return found[found[:, 1] - found[:, 0] >= least]


def seeds(ids: np.ndarray, begin: int, end: int, origin: int, block: int, low: int, high: int) -> np.ndarray:
    """(distance, place) where the block at a place occurs again at a distance of the scale, within a window's stretch.

    Blocks begin at multiples of their length, counted from origin.
    """
    last = min(begin + WINDOW, end - block - low + 1)
    first = begin + (origin - begin) % block
    if first >= last:
        return np.zeros((0, 2), np.int64)
    text = tuple(ids[begin : min(end, begin + WINDOW + block + high)].tolist())
    blocks = np.arange(first, last, block)
    keys = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    number = np.empty(len(blocks), np.int64)
    for k, at in enumerate((blocks - begin).tolist()):
        key = text[at : at + block]
        number[k] = keys.get(key, k)
        if number[k] == k:
            keys.add_word(key, k)
    keys.make_automaton()
    hits = np.array(list(keys.iter(text)), np.int64).reshape(-1, 2)
    span = len(text) + high + 1
    code = np.sort(hits[:, 1] * span + hits[:, 0] - block + 1)
    own = number * span + blocks - begin
    left, right = np.searchsorted(code, own + low), np.searchsorted(code, own + high, "right")
    many = right - left
    index = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(np.arange(len(blocks)), many)
    return np.stack([code[index] - own[at], blocks[at]], 1)


def extended(ids: np.ndarray, low: int, high: int, place: int, distance: int, block: int) -> tuple[int, int]:
    """(begin, end) of the longest stretch with this period around a block and its repetition, within low and high."""
    x, step = place + block, 64
    while x + distance < high:
        to = min(x + step, high - distance)
        differ = np.flatnonzero(ids[x:to] != ids[x + distance : to + distance])
        if len(differ):
            x += int(differ[0])
            break
        x, step = to, step * 2
    y, step = place, 64
    while y > low:
        to = max(y - step, low)
        differ = np.flatnonzero(ids[to:y] != ids[to + distance : y + distance])
        if len(differ):
            y = to + int(differ[-1]) + 1
            break
        y, step = to, step * 2
    return y, x + distance


class Found:
    """The runs of one row so far."""

    def __init__(self) -> None:
        self.runs: list[tuple[int, int, int]] = []
        self.ends: set[tuple[int, int]] = set()
        self.begins, self.reach = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def settle(self) -> None:
        """From now on within() knows the runs that were added."""
        order = sorted((a, b) for a, b, _ in self.runs)
        self.begins = np.array([a for a, _ in order], np.int64)
        self.reach = np.maximum.accumulate(np.array([b for _, b in order], np.int64)) if order else self.begins

    def within(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which stretches lie in one run of the scales before."""
        at = np.searchsorted(self.begins, begin, "right") - 1
        return (at >= 0) & (self.reach[np.maximum(at, 0)] >= end) if len(self.begins) else np.zeros(len(begin), bool)

    def add(self, begin: int, end: int, period: int) -> None:
        if end - begin >= least_length(period) and (begin, end) not in self.ends:
            self.ends.add((begin, end))
            self.runs.append((begin, end, period))


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each row that has some, as (start, length, period) by start and period. ids: words of all rows in turn."""
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place, near = recurrence(ids, row)
    found: dict[int, Found] = {}
    block = 2
    while True:
        low, high = -(-(2 * block - 1) // 3), -(-(4 * block - 1) // 3) - 1
        if not len(place) or PERIODS * low > sizes.max():
            break
        parts = stretches(place[near <= high], least_length(low))
        for r in np.unique(row[parts[:, 0]]).tolist() if len(parts) else []:
            own, mine = found.setdefault(r, Found()), parts[row[parts[:, 0]] == r]
            first, last = int(ends[r] - sizes[r]), int(ends[r])
            own.settle()
            mine = mine[~own.within(mine[:, 0], mine[:, 1])]
            each = [seeds(ids, at, int(end), first, block, low, high) for begin, end in mine.tolist() for at in range(begin, end, WINDOW)]
            pairs = np.unique(np.concatenate(each), axis=0) if each else np.zeros((0, 2), np.int64)
            pairs = pairs[~own.within(pairs[:, 1], pairs[:, 1] + pairs[:, 0] + block)]
            known, begin, end = 0, 0, 0
            for distance, at in pairs.tolist():
                if distance != known or at + distance + block > end:
                    begin, end = extended(ids, first, last, at, distance, block)
                    known = distance
                    own.add(begin, end, distance)
        block *= 2
    out = {}
    for r, own in found.items():
        first = int(ends[r] - sizes[r])
        if own.runs:
            out[r] = sorted((a - first, b - a, q) for a, b, q in own.runs)
            out[r].sort(key=lambda x: (x[0], x[2]))
    return out


def _collapsed(words: pa.Array, ids: np.ndarray, sizes: np.ndarray, runs: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    """The words of each row but those that a run repeats, joined by single spaces."""
    first = np.cumsum(sizes) - sizes
    inside = np.zeros(len(ids) + 1, np.int64)
    for r, own in runs.items():
        for start, length, period in own:
            inside[first[r] + start + period] += 1
            inside[first[r] + start + length] -= 1
    keep = np.cumsum(inside)[:-1] == 0
    offsets = np.concatenate([[0], np.cumsum(keep)])[np.append(first, len(ids))]
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), words.cast(pa.large_string()).take(pa.array(ids[keep])))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def collapse(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of keep, n_words, runs (start, length, period; by start, then period) and the collapsed text of each row.

    docs has text and the columns of keep; others are ignored. A null or empty text has no words, no runs, and collapses
    to an empty text. Rows stand for themselves, so repeated ones and null ids give rows of their own; of no rows there
    are none. The collapsed text lacks the words that any run contains after its first period. A long text is a batch of
    its own, whose memory grows with it.
    """
    kinds = [docs.schema[c] for c in keep]
    schema = T.StructType([*kinds, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))
        for part in few(parts):
            words, ids, sizes = split_words(part.column("text"))
            runs = find_runs(ids, sizes)
            of_row = pa.array([[dict(zip(RUN.names, x, strict=True)) for x in runs.get(r, ())] for r in range(part.num_rows)], each)
            columns = [*(part.column(c) for c in keep), pa.array(sizes.astype(np.int64)), of_row, _collapsed(words, ids, sizes, runs)]
            yield pa.record_batch(columns, names=[*keep, "n_words", "runs", "collapsed"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(tidy(run), schema)


def strongest(runs):
    """The run of the greatest length over period; of equal ones the first."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda a, x: F.when(a.isNull() | (x["length"] * a["period"] > a["length"] * x["period"]), x).otherwise(a))
