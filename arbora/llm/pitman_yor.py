"""A nested hierarchical Pitman-Yor language model.

Every word has a restaurant of the words that follow it; the end token's has the first words of texts. These share one
parent, the word restaurant. Its base measure spells a word byte by byte: a restaurant for each two bytes before, whose
parents have the one byte before, whose parent has none, over a uniform choice of 256 bytes and the word's end. The
tables of a restaurant are the customers of its parent; the tables of the word restaurant are the words that get
spelled. So every string of bytes has a probability of its own after every word, seen or not.

Seating is sampled by Gibbs sweeps. A sweep draws, for each dish of a restaurant, the number of tables at which its
customers sit, from its distribution given the tables of the sweep before of all other dishes: weights are generalised
Stirling numbers times those of new tables. Dishes with over `exact` customers have them come in one after another.
Draws are hashes of the dish and the sweep, so that reruns agree however rows are dealt. Word probabilities and the
followers' tables are averaged over the kept samples; the followers' probabilities come from both averages.

Pairs of words are dealt to buckets by the first word's hash, those of very frequent first words by the second one's as
well, and travel as packed arrays. What a text asks for goes to the buckets and comes back as sums. The driver holds the
65,535 most frequent words, as two-byte codes for others' arrays, and the spelling restaurants, of which there are at
most 257 ** 3 dishes whatever the corpus.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.text import few, hashed, mix, signed, spans, split_words, tidy, tidy_group, tidy_groups
from arbora.llm.workspace import discard, stored

#: The spelling of the token that ends a text; no word contains it.
END = b"\n"
END_HASH = hashed(pa.array([END], pa.binary()))[0]
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Symbols of a spelling: bytes, and one for its end, which also stands before its beginning.
SYMBOLS = 257
RARE = 65_535


@dataclass(frozen=True)
class Params:
    """strength: of all restaurants; discounts are estimated. bucket: about so many tokens of training share a bucket.

    exact: customers of a dish up to which its tables are drawn from their exact distribution. batch: bytes of text that
    are read at a time. held: distinct words that a task gathers before it hands them on.
    """

    burn_in: int = 1
    samples: int = 2
    strength: float = 1.0
    exact: int = 512
    bucket: int = 4_000_000
    batch: int = 6_000_000
    held: int = 300_000


def discount(counts: np.ndarray) -> float:
    one, two = (counts == 1).sum(), (counts == 2).sum()
    return rate(one, two)


def rate(one: float, two: float) -> float:
    """A discount from how many dishes have one customer and two."""
    return float(np.clip(one / max(one + 2 * two, 1), 0.05, 0.95))


def uniform(keys: np.ndarray, draw: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the keys and the draw's number alone."""
    salt = mix(np.array([draw], np.uint64) * ODD + np.uint64(1))[0]
    return ((mix(mix(keys ^ salt) + ODD) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


@functools.lru_cache(4)
def stirling(most: int, d: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers of c customers at t tables, in row c and column t."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(most):
        stay = np.maximum(c - d * np.arange(most + 1), 0)
        with np.errstate(divide="ignore"):
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], out[c, 1:] + np.log(stay[1:]))
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers, by Stirling's series from 10 on."""
    x = np.asarray(x, float)
    up = np.maximum(np.ceil(10 - x), 0)
    shift = sum(np.where(k < up, np.log(x + k), 0.0) for k in range(int(up.max(initial=0))))
    y = x + up
    i = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - i * (1 / 360 - i * (1 / 1260 - i / 1680))) / y - shift


def log_together(c: np.ndarray, t: np.ndarray, d: float, nodes: int = 32) -> np.ndarray:
    """Logarithm of the probability that t tables have c customers together, each by itself with Sibuya's distribution.

    The generating function of a table's customers is 1 - (1 - x) ** d, so that this is the generalised Stirling number of
    c and t times t! d ** t / c!. It is Cauchy's integral of the t-th power, on a parabola in 1 - x through the saddle
    point that opens along the branch cut, by the trapezoid rule in a variable in which the integrand falls off doubly
    exponentially.
    """
    c, t = np.broadcast_arrays(np.asarray(c, float), np.asarray(t, float))
    low, high = np.full(c.shape, np.log(1e-13)), np.full(c.shape, np.log(700.0))
    ratio = np.log(t * d / (c + 1))
    for _ in range(32):  # the saddle is at exp(-y); the integral needs it roughly
        middle = (low + high) / 2
        y = np.exp(middle)
        beyond = ratio + (1 - d) * y + np.log(np.expm1(-y) / np.expm1(-d * y)) > 0
        low, high = np.where(beyond, low, middle), np.where(beyond, middle, high)
    saddle = np.exp(-np.exp(high))
    z0 = np.maximum(saddle, np.minimum(0.5, 0.5 / c))
    zd = z0**d
    bend = (c + 1) / (1 - z0) ** 2 - t * (d * (d - 1) * zd / z0**2 * (1 - zd) + (d * zd / z0) ** 2) / (1 - zd) ** 2
    width = np.where(bend > 0, np.minimum(1, 1 / (2 * z0 * np.sqrt(np.maximum(bend, 1e-300)))), 1.0)
    most = np.sqrt(np.expm1(60 / (c + 1 - d * t)) / z0) + 12 * width
    step = np.arcsinh(most / width) / nodes
    v = step[..., None] * np.arange(nodes + 1)
    u = width[..., None] * np.sinh(v)
    # z is z0 * (1 + iu) ** 2; real and imaginary parts apart, as numpy's complex logarithms and powers are slow
    grown, turn = np.exp(d * (np.log(z0)[..., None] + np.log1p(u * u))), 2 * d * np.arctan(u)
    x1, y1 = 1 - grown * np.cos(turn), -grown * np.sin(turn)
    x2, y2 = 1 - z0[..., None] * (1 - u * u), -2 * z0[..., None] * u
    real = (t[..., None] * np.log(x1 * x1 + y1 * y1) - (c[..., None] + 1) * np.log(x2 * x2 + y2 * y2)) / 2
    top = real.max(-1, keepdims=True)
    some = np.nonzero(real > top - 50)  # the others are lost in rounding
    turn = t[some[:-1]] * np.arctan2(y1[some], x1[some]) - (c[some[:-1]] + 1) * np.arctan2(y2[some], x2[some])
    rows = np.zeros(u.shape)
    rows[some] = np.exp((real - top)[some]) * (np.cos(turn) - u[some] * np.sin(turn)) * np.cosh(v[some]) * width[some[:-1]]
    rows[..., 0] /= 2
    found = top[..., 0] + np.log(np.maximum(np.abs(rows.sum(-1)) * step * 2 * z0 / np.pi, 1e-300))
    return np.where(t == c, c * np.log(d), found)


def draw_many(c: np.ndarray, fresh: np.ndarray, base: np.ndarray, d: float, x: np.ndarray, points: int = 32) -> np.ndarray:
    """Tables of dishes with so many customers that their Stirling numbers are not tabulated; x: a uniform draw of each.

    fresh: weight of a first table over the discount. The weight of t is log-concave. Where up to `points` tables hold all
    but exp(-30) of it, each number is weighed; elsewhere the range that does is found from geometric points, and in a
    range of more than twice `points` the logarithm is interpolated between so many, beside the parabola that fits best.
    """
    out = np.ones(len(c), np.int64)

    def weight(i: np.ndarray, t: np.ndarray, ways: np.ndarray | None = None) -> np.ndarray:
        a = fresh[i][:, None]
        return (log_together(c[i][:, None], t, d) if ways is None else ways) + log_gamma(a + t) - log_gamma(t + 1.0) + t * np.log(base[i])[:, None]

    def drawn(i: np.ndarray, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        share = np.cumsum(np.exp(w - w.max(-1, keepdims=True)), -1)
        return np.take_along_axis(t, (share < (x[i] * share[:, -1])[:, None]).sum(1)[:, None], 1)[:, 0]

    for at in np.array_split(np.argsort(c), max(1, len(c) // 60)):
        grid = np.broadcast_to(np.arange(1.0, points + 1), (len(at), points))
        sizes, same = np.unique(c[at], return_inverse=True)
        w = weight(at, grid, log_together(sizes[:, None], grid[:1], d)[same])
        small = w[:, -1] < w.max(1) - 30
        out[at[small]] = drawn(at[small], grid[small], w[small])
        at = at[~small]
        if not len(at):
            continue
        low, high = np.ones(len(at)), c[at].astype(float)
        for n in (points, 2 * points):
            grid = np.rint(np.exp(np.log(high)[:, None] * np.linspace(0, 1, n))) if n == points else np.rint(low[:, None] + (high - low)[:, None] * np.linspace(0, 1, n))
            w = weight(at, grid)
            near = w > w.max(1, keepdims=True) - 30
            first, last = near.argmax(1), n - 1 - near[:, ::-1].argmax(1)
            low, high = np.take_along_axis(grid, np.maximum(first - 1, 0)[:, None], 1)[:, 0], np.take_along_axis(grid, np.minimum(last + 1, n - 1)[:, None], 1)[:, 0]
        grid = np.rint(low[:, None] + (high - low)[:, None] * np.linspace(0, 1, 2 * points))
        w = weight(at, grid)
        for k, i in enumerate(at.tolist()):
            t, own = np.unique(grid[k], return_index=True)
            v, every = w[k][own], np.arange(t[0], t[-1] + 1)
            if len(every) > len(t):
                place = lambda y: (y - t[0]) / (t[-1] - t[0])  # noqa: B023, E731
                curve = np.polynomial.Polynomial.fit(place(t), v, 2)
                v = np.interp(every, t, v - curve(place(t))) + curve(place(every))
            out[i] = drawn(np.array([i]), every[None], v[None])[0]
    return out


def draw_tables(customers: np.ndarray, others: np.ndarray, base: np.ndarray, d: float, keys: np.ndarray, sweep: int, p: Params) -> np.ndarray:
    """Tables of each dish, given the tables of the other dishes of its restaurant and its base probability.

    All are drawn from the same distribution: the Stirling numbers come from a table up to `exact` customers, and from an
    integral beyond.
    """
    tables = (customers > 0).astype(np.int64)
    large = np.flatnonzero(customers > p.exact)
    if len(large):
        tables[large] = draw_many(customers[large], p.strength / d + others[large], base[large], d, uniform(keys[large], sweep << 20))
    small = np.flatnonzero((customers > 1) & (customers <= p.exact))
    if not len(small):
        return tables
    ways = stirling(p.exact, d)
    order = small[np.argsort(customers[small], kind="stable")]
    for at in np.split(order, np.flatnonzero(np.diff(customers[order])) + 1):
        c = int(customers[at[0]])
        for k in range(0, len(at), max(1, 1_000_000 // c)):
            i = at[k : k + max(1, 1_000_000 // c)]
            weight = np.cumsum(np.log(p.strength + d * (others[i][:, None] + np.arange(c))) + np.log(base[i])[:, None], 1) + ways[c, 1 : c + 1]
            share = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            tables[i] = 1 + (share < (uniform(keys[i], sweep << 20) * share[:, -1])[:, None]).sum(1)
    return tables


def spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word of each symbol, the symbol with the two before it as one number) of the spellings of words."""
    begin, sizes, data = spans(words)
    text = np.full(sizes.sum() + len(words), SYMBOLS - 1)  # an end after each word
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = data[begin[0] : begin[-1] + sizes[-1]] if len(words) else 0
    owner = np.repeat(np.arange(len(words)), sizes + 1)
    first = ends - sizes
    before = np.concatenate([[SYMBOLS - 1], text[:-1]])
    second = np.concatenate([[SYMBOLS - 1] * 2, text[:-2]])[: len(text)]
    second[first] = SYMBOLS - 1
    return owner, (second * SYMBOLS + before) * SYMBOLS + text


@dataclass
class Spelling:
    """The spelling restaurants: level k has the k bytes before a symbol as context. codes: of the seen symbols in context."""

    p: Params
    codes: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64)] * 3)
    tables: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64)] * 3)
    prob: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)] * 3)
    contexts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64)] * 3)
    back: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)] * 3)
    places: dict[int, Lookup] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"places": {}}

    def swept(self, codes: np.ndarray, customers: np.ndarray, sweep: int) -> Spelling:
        """After a sweep, with these customers at each code of the top level."""
        new = Spelling(self.p)
        order = np.argsort(codes)
        codes, customers = codes[order], customers[order].astype(np.int64)
        found, rates = {}, {}
        for k in (2, 1, 0):
            context, group = np.unique(codes // SYMBOLS, return_inverse=True)
            d = rates[k] = discount(customers)
            old = np.minimum(customers, 1)
            hit, at = _find(self.codes[k], codes)
            old[hit] = self.tables[k][at[hit]]
            others = np.bincount(group, old, len(context))[group] - old
            base = self.below(k, codes)
            t = draw_tables(customers, others, base, d, mix(codes.astype(np.uint64) + np.uint64(k << 40)), sweep, self.p)
            found[k] = (codes, customers, t, context, group)
            codes, index = np.unique(codes % SYMBOLS**k, return_inverse=True)
            customers = np.bincount(index, t, len(codes)).astype(np.int64)
        for k in range(3):
            codes, customers, t, context, group = found[k]
            d, c = rates[k], np.bincount(found[k][4], found[k][1], len(context))
            fresh = self.p.strength + d * np.bincount(group, t, len(context))
            new.codes[k], new.tables[k], new.contexts[k], new.back[k] = codes, t, context, fresh / (self.p.strength + c)
            new.prob[k] = (customers - d * t) / (self.p.strength + c)[group] + new.back[k][group] * new.below(k, codes)
        return new

    def below(self, k: int, codes: np.ndarray) -> np.ndarray:
        """Probability of symbols under the level below k."""
        return self.of(k - 1, codes % SYMBOLS**k) if k else np.full(len(codes), 1 / SYMBOLS)

    def of(self, k: int, codes: np.ndarray) -> np.ndarray:
        """Probability of symbols in their context of k bytes."""
        if k not in self.places:
            self.places[k] = Lookup(mix(self.codes[k].astype(np.uint64)))
        seen, index = self.places[k].find(mix(codes.astype(np.uint64)))
        out = np.zeros(len(codes))
        out[seen] = self.prob[k][index[seen]]
        rest = codes[~seen]
        known, at = _find(self.contexts[k], rest // SYMBOLS)
        out[~seen] = np.where(known, self.back[k][at] if len(self.back[k]) else 1.0, 1.0) * self.below(k, rest)
        return out

    def log_words(self, words: pa.Array) -> np.ndarray:
        """Logarithm of each word's probability."""
        return self.log_spelled(*spelled(words), len(words))

    def log_spelled(self, owner: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
        """The same of n words' spellings."""
        return np.bincount(owner, np.log(self.of(2, codes)), n)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    index = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[index] == wanted, index


class Lookup:
    """Places of different hashes in an array of them.

    A hash's first bits lead to where those that share them begin among the sorted ones, mostly itself or the one before,
    so that the steps of a search do not grow with the array.
    """

    def __init__(self, keys: np.ndarray):
        self.order = None if (keys[1:] > keys[:-1]).all() else _order(keys)
        own = keys if self.order is None else keys[self.order]
        self.n, self.shift = len(own), np.uint64(64 - len(own).bit_length())
        self.begin = np.zeros(1 << len(own).bit_length(), np.int32)  # built in little memory: there may be millions
        if len(own):
            many = np.bincount((own >> self.shift).view(np.int64))
            np.cumsum(many[: len(self.begin) - 1], out=self.begin[1 : len(many) + 1], dtype=np.int32)
            self.begin[len(many) :] = len(own)
        self.keys = np.append(own, np.uint64(2**64 - 1))  # a search ends there

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each is there, its place)."""
        if not self.n:
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
        at = self.begin[(wanted >> self.shift).view(np.int64)].astype(np.int64)
        there = self.keys[at]
        hit, on = there == wanted, np.flatnonzero(there < wanted)
        while len(on):
            at[on] += 1
            there, want = self.keys[at[on]], wanted[on]
            hit[on], on = there == want, on[there < want]
        beyond = at == self.n
        hit[beyond], at[beyond] = False, 0
        return hit, at if self.order is None else self.order[at]


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of hashes in their order; equal ones stay as they are.

    A hash's first bits and its place are sorted as one number, which is much faster than sorting places by a key. The few
    hashes that share their first bits with others are put in order after that.
    """
    bits = np.uint64(len(keys).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    mixed = keys & ~low | np.arange(len(keys), dtype=np.uint64)
    mixed.sort()
    order = (mixed & low).view(np.int64)
    mixed >>= bits
    own = keys[order]
    if not len(keys):
        return order
    odd = np.flatnonzero((mixed[1:] == mixed[:-1]) & (own[1:] != own[:-1]))
    if len(odd) > 1000:
        return np.argsort(keys, kind="stable")
    for first in np.unique(mixed[odd]):
        part = slice(*np.searchsorted(mixed, [first, first + np.uint64(1)]))
        order[part] = order[part][np.argsort(own[part], kind="stable")]
    return order


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of hashes in their order, where each different one begins among them)."""
    order = _order(keys)
    return order, _begins(keys[order])


def _begins(keys: np.ndarray) -> np.ndarray:
    """Where each different key begins among sorted ones."""
    return np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]])[: len(keys)])


def count_words(docs: DataFrame, p: Params) -> DataFrame:
    """(word, h, n) of every distinct word of docs with its hash, and of the end token that every text has."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[pa.Array, np.ndarray]] = []
        size = 0

        def merged() -> tuple[pa.Array, np.ndarray]:
            words = pa.concat_arrays([w for w, _ in seen]).dictionary_encode()
            n = np.bincount(words.indices.to_numpy(), np.concatenate([n for _, n in seen]), len(words.dictionary))
            return words.dictionary, n.astype(np.int64)

        def out():
            words, n = merged()
            yield from pa.table([words.cast(pa.binary()), pa.array(signed(hashed(words))), pa.array(n)], names=["word", "h", "n"]).to_batches(max_chunksize=50_000)
            seen.clear()

        for part in few(parts, p.batch):
            words, index, _ = split_words(part.column("text"), folded=True)
            seen += [(words, np.bincount(index, minlength=len(words))), (pa.array([END], pa.large_binary()), np.array([part.num_rows]))]
            size += len(words)
            if size > 2 * p.held:
                seen[:] = [merged()]
                size = len(seen[0][0])
                if size > p.held:
                    yield from out()
                    size = 0
        if seen:
            yield from out()

    counted = docs.select("text").mapInArrow(tidy(run), "word binary, h long, n long")
    return counted.groupBy("word").agg(F.min("h").alias("h"), F.sum("n").alias("n"))


def _gathered(parts: Iterator[pa.RecordBatch], most: int = 40_000) -> Iterator[pa.RecordBatch]:
    """Batches of words put together, since each call of the draws costs the same for few words as for many."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        held.append(part)
        if sum(x.num_rows for x in held) >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _symbols(types: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(codes, customers) of the spelling restaurants' top level: each table of a word spells it once."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(parts):
            owner, codes = spelled(part.column("word"))
            order, first = _runs(mix(codes.astype(np.uint64)))
            n = np.add.reduceat(part.column("t").to_numpy()[owner[order]], first)
            yield pa.record_batch([pa.array(codes[order[first]]), pa.array(n)], names=["code", "n"])

    rows = types.select("word", "t").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    return rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def _seat_words(types: DataFrame, spelling: Spelling, p: Params, d: float, everyone: int, sweep: int) -> DataFrame:
    """The words with their tables after a sweep, and their spelled probability."""
    shared = types.sparkSession.sparkContext.broadcast(spelling)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(parts):
            base = np.exp(shared.value.log_words(part.column("word")))
            c, t = part.column("c").to_numpy(), part.column("t").to_numpy()
            t = draw_tables(c, np.maximum(everyone - t, 0), base, d, part.column("h").to_numpy().view(np.uint64), sweep, p)
            yield pa.record_batch([*(part.column(x) for x in ("word", "h", "n", "c")), pa.array(t), part.column("prob"), pa.array(base)], names=["word", "h", "n", "c", "t", "prob", "base"])

    return types.select("word", "h", "n", "c", "t", "prob").mapInArrow(run, "word binary, h long, n long, c long, t long, prob double, base double")


@dataclass
class Deal:
    """Where pairs go: by the first word, and by the second one as well where `parts` says so. ranks: words as two-byte codes."""

    buckets: int
    words: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, top: list[tuple[int, int]], total: int, p: Params) -> Deal:
        """From the (hash, count) of the most frequent words, in that order."""
        h = np.array([x for x, _ in top], np.int64).view(np.uint64)
        n = np.array([x for _, x in top], np.int64)
        order = np.argsort(h)
        most = max(p.bucket / 4, total / RARE)  # fewer words than codes occur more often
        parts = np.where(n > most, np.ceil(n / most), 1).astype(np.int64)
        return cls(max(8, total // p.bucket), h[order], order.astype(np.uint16), n[order], parts[order])

    @functools.cached_property
    def places(self) -> Lookup:
        return Lookup(self.words)

    @functools.cached_property
    def by_code(self) -> np.ndarray:
        """The word of each code."""
        out = np.zeros(RARE + 1, np.uint64)
        out[self.ranks] = self.words
        return out

    def codes(self, h: np.ndarray) -> np.ndarray:
        """Two-byte codes of words, RARE for those that have none."""
        hit, at = self.places.find(h)
        return np.where(hit, self.ranks[at], RARE).astype("<u2") if len(self.words) else np.full(len(h), RARE, "<u2")

    def parts_of(self, h: np.ndarray) -> np.ndarray:
        hit, at = self.places.find(h)
        return np.where(hit, self.parts[at], 1) if len(self.words) else np.ones(len(h), np.int64)

    def of_part(self, u: np.ndarray, part: np.ndarray) -> np.ndarray:
        return ((mix(u + part.astype(np.uint64) * ODD) >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int64)

    def homes(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in u, buckets) of every bucket that has a part of a word's restaurant."""
        parts = self.parts_of(u)
        index = np.repeat(np.arange(len(u)), parts)
        part = np.arange(len(index)) - np.repeat(np.cumsum(parts) - parts, parts)
        found = np.unique(np.stack([index, self.of_part(u[index], part)]), axis=1)
        return found[0], found[1]

    def by_bucket(self, h: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of pairs by bucket, else as they are, where each bucket begins among them); u, w: places in the hashes h."""
        parts, to = self.parts_of(h), self.of_part(h, np.zeros(1, np.int64))[u]
        if (parts > 1).any():
            many = np.flatnonzero(parts[u] > 1)
            to[many] = self.of_part(h[u[many]], (mix(h) >> np.uint64(33)).astype(np.int64)[w[many]] % parts[u[many]])
        order = np.argsort(to.astype(np.min_scalar_type(self.buckets)), kind="stable")
        return order, np.concatenate([[0], np.cumsum(np.bincount(to, minlength=self.buckets))])

    def shared(self) -> np.ndarray:
        """The words whose pairs are in several parts."""
        return self.words[self.parts > 1]

    def pack(self, *columns: np.ndarray | tuple[np.ndarray, np.ndarray]) -> bytes:
        """Arrays as bytes; those of unsigned 64-bit numbers are hashes of words, and pairs of arrays their codes and hashes."""
        out: list = []
        for c in columns:
            if isinstance(c, tuple) or c.dtype == np.uint64:
                code, h = c if isinstance(c, tuple) else (self.codes(c), c)
                out.append((code.view(np.uint8).reshape(-1, 2).T.tobytes(), h[code == RARE]))
            elif c.dtype.kind in "iu":
                out.append(c.astype(np.min_scalar_type(int(c.max(initial=0))) if c.min(initial=0) >= 0 else np.int64))
            else:
                out.append(c)
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(out, protocol=5))

    def unpack(self, blob: bytes) -> list[np.ndarray]:
        out = []
        for c in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
            if isinstance(c, tuple):
                code = np.frombuffer(c[0], np.uint8).reshape(2, -1).T.copy().view("<u2")[:, 0] if len(c[0]) else np.zeros(0, np.uint16)
                values = self.by_code[code]
                values[code == RARE] = c[1]
                out.append(values)
            else:
                out.append(c.astype(np.int64) if c.dtype.kind in "iu" else c)
        return out

    def joined(self, table: pa.Table, kind: int, *types: type) -> list[np.ndarray]:
        """The arrays of all blobs of a kind, one after the other."""
        own = table.filter(pa.array(table.column("kind").to_numpy() == kind)).column("blob").to_pylist()
        if not own:
            return [np.zeros(0, t) for t in types]
        return [np.concatenate(x) for x in zip(*map(self.unpack, own), strict=True)]

    def blobs(self, bucket: int, kind: int, *columns: np.ndarray | tuple[np.ndarray, np.ndarray], most: int = 250_000) -> list[tuple]:
        """Rows of BUCKETED with equally long arrays, in pieces."""
        n = len(columns[-1])
        return [(bucket, kind, self.pack(*(tuple(x[at : at + most] for x in c) if isinstance(c, tuple) else c[at : at + most] for c in columns)), None, None) for at in range(0, n, most)]


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One hash of two words in this order."""
    return mix(mix(u) + w)


BUCKETED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary()), ("w", pa.int64()), ("v", pa.float64())])
BUCKETED_SQL = "bucket int, kind int, blob binary, w long, v double"
PAIRS, FEW, OFTEN, CONTEXTS, WORDS, NEEDED, TABLES, RATES, SHARED = range(9)
#: FEW and TABLES of words without a code; TABLES of such words that have no FEW.
FEW_RARE, TABLES_RARE, TABLES_ONLY = range(9, 12)
ALL_FEW, ALL_TABLES = (FEW, FEW_RARE), (TABLES, TABLES_RARE, TABLES_ONLY)
#: Each word without a code of PAIRS once, and each of OFTEN.
RARE_OF_PAIRS, RARE_OF_OFTEN = (FEW_RARE, TABLES_ONLY), (TABLES_RARE, TABLES_ONLY)


def _rows(rows: list[tuple], *numbers: tuple[int, int, np.ndarray, np.ndarray]) -> pa.Table:
    """A table of BUCKETED from rows and from (bucket, kind, w, v) with many numbers each."""
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    tables = [pa.table([pa.array(c, f.type) for c, f in zip(cols, BUCKETED, strict=True)], schema=BUCKETED)]
    for bucket, kind, w, v in numbers:
        n = len(w)
        tables.append(pa.table([pa.array(np.full(n, bucket, np.int32)), pa.array(np.full(n, kind, np.int32)), pa.nulls(n, pa.binary()), pa.array(signed(w)), pa.array(v.astype(float))], schema=BUCKETED))
    return pa.concat_tables(tables).combine_chunks()


def _tokens(parts: Iterator[pa.RecordBatch], p: Params) -> Iterator[tuple]:
    """(rows, distinct words, places in these by hash, their hashes in order, word before, word, row of each token).

    Of about p.batch bytes at a time. The word before and the word are places among the hashes; the end token has one too,
    and comes after the last of the distinct words.
    """
    for part in few(parts, p.batch):
        words, index, sizes = split_words(part.column("text"), folded=True)
        h = np.append(hashed(words), END_HASH)
        order = np.argsort(h)
        place = np.empty(len(h), np.int64)
        place[order] = np.arange(len(h))
        # an end token after the words of each text; a first word comes after the end of the text before it
        w = place[np.insert(index, np.cumsum(sizes), len(words))]
        yield part, words, order, h[order], np.concatenate([w[-1:], w[:-1]]), w, np.repeat(np.arange(part.num_rows), sizes + 1)


def _grouped_places(u: np.ndarray, w: np.ndarray, row: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What _grouped gives, of pairs of places below `kinds`, in the order of u and then of w.

    Where they fit, pair and token are one number, which sorts much faster than places do by a key.
    """
    pair, token = 2 * kinds.bit_length(), len(u).bit_length()
    if pair + token > 64:
        one, many, first, by_pair = _grouped(u.astype(np.uint64), w.astype(np.uint64), row)
        order = np.lexsort((w[one], u[one]))
        at = np.repeat(first[order], many[order]) + _within(many[order])
        return one[order], many[order], np.cumsum(many[order]) - many[order], by_pair[at]
    keys = (u.astype(np.uint64) << np.uint64(pair // 2) | w.astype(np.uint64)) << np.uint64(token) | np.arange(len(u), dtype=np.uint64)
    keys.sort()
    order = (keys & np.uint64((1 << token) - 1)).view(np.int64)
    keys >>= np.uint64(token)
    first = _begins(keys)
    return order[first], np.diff(first, append=len(order)), first, row[order]


def _within(many: np.ndarray) -> np.ndarray:
    """0, 1, ... of each group of so many."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _grouped(u: np.ndarray, w: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first place of each different pair, its occurrences, where its rows begin, rows by pair), by one sort."""
    pair = _pair(u, w)
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    del pair
    return order[first], np.diff(first, append=len(order)), first, row[order]


def count_pairs(docs: DataFrame, deal, p: Params) -> DataFrame:
    """The pairs of neighbouring words of docs by bucket, counted, and what the sweeps need to know of them.

    PAIRS: word before, word, count of every pair. OFTEN: the same with tables, and their average, of those that occur
    twice or more; the others have one table. CONTEXTS: word, tokens after it, pairs that occur once. FEW, FEW_RARE:
    tables that a word has in pairs that occur once. TABLES, TABLES_RARE, TABLES_ONLY: those in OFTEN. RATES: numbers of pairs that occur once and twice. SHARED: tables that a word before, dealt to
    several buckets, has in this one.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = deal.value
        for _, _, _, h, u, w, row in _tokens(parts, p):
            one, n, _, _ = _grouped_places(u, w, row, len(h))
            u, w, code = u[one], w[one], d.codes(h)
            order, ends = d.by_bucket(h, u, w)
            rows = []
            for b in range(d.buckets):
                if len(i := order[ends[b] : ends[b + 1]]):
                    rows += d.blobs(b, PAIRS, (code[u[i]], h[u[i]]), (code[w[i]], h[w[i]]), n[i])
            yield from _rows(rows).to_batches(max_chunksize=64)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        b, d = key[0].as_py(), deal.value
        u, w, n = d.joined(table, PAIRS, np.uint64, np.uint64, np.int64)
        order, first = _runs(_pair(u, w))
        n = np.add.reduceat(n[order], first)
        u, w = u[order[first]], w[order[first]]
        order, begin = _runs(u)
        u, w, n = u[order], w[order], n[order]
        kinds, many = u[begin], np.diff(begin, append=len(u))
        group = np.repeat(np.arange(len(kinds)), many)
        once, often = n == 1, n > 1
        code_u, code_w = np.repeat(d.codes(kinds), many), d.codes(w)
        few_, tables = np.unique(w[once], return_counts=True)
        ones = np.ones(often.sum(), np.int64)
        rows = d.blobs(b, PAIRS, (code_u, u), (code_w, w), n)
        rows += d.blobs(b, OFTEN, (code_u[often], u[often]), (code_w[often], w[often]), n[often], ones, 0 * ones)
        rows += d.blobs(b, CONTEXTS, kinds, np.bincount(group, n, len(kinds)).astype(np.int64), np.bincount(group, once, len(kinds)).astype(np.int64))
        names, at_first = np.unique(w[often], return_counts=True)
        coded, coded_often = d.places.find(few_)[0], d.places.find(names)[0]
        both = Lookup(few_).find(names)[0]
        numbers = [(kind, few_[i], tables[i]) for kind, i in ((FEW, coded), (FEW_RARE, ~coded))]
        numbers += [(kind, names[i], at_first[i]) for kind, i in ((TABLES, coded_often), (TABLES_RARE, ~coded_often & both), (TABLES_ONLY, ~coded_often & ~both))]
        mine, many = _shared(d, kinds, many)
        return _rows(rows, *((b, *x) for x in numbers), (b, RATES, np.array([1, 2], np.uint64), np.array([once.sum(), (n == 2).sum()])), (b, SHARED, mine, many))

    return docs.select("text").mapInArrow(tidy(run), BUCKETED_SQL).groupBy("bucket").applyInArrow(tidy_group(merge), BUCKETED_SQL)


def _shared(d: Deal, kinds: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mine = np.isin(kinds, d.shared())
    return kinds[mine], tables[mine]


def _of_shared(rows: DataFrame) -> dict[int, float]:
    """Tables of the restaurants that are dealt to several buckets; fewer than there are codes."""
    return {r["w"] % 2**64: r["v"] for r in rows.where(F.col("kind") == SHARED).groupBy("w").agg(F.sum("v").alias("v")).collect()}


def _known(values: np.ndarray, kinds: np.ndarray, known: dict[int, float]) -> np.ndarray:
    """values, with those of some kinds replaced."""
    values = values.astype(float)
    for k in np.flatnonzero(np.isin(kinds, np.fromiter(known, np.uint64, len(known)))):
        values[k] = known[int(kinds[k])]
    return values


def _probabilities(d: Deal, top: np.ndarray, table: pa.Table, w: np.ndarray) -> np.ndarray:
    """What is known of words: from top for those that have a code, else from the rows that came for a bucket."""
    own = table.filter(pa.array(table.column("kind").to_numpy() == NEEDED))  # other kinds have nulls
    names, v = own.column("w").to_numpy().view(np.uint64), own.column("v").to_numpy()
    hit, at = d.places.find(w)
    out = np.empty(len(w))
    out[hit] = top[at[hit]]
    out[~hit] = v[Lookup(names).find(w[~hit])[1]]
    return out


def _top(deal, words: DataFrame, value: str) -> np.ndarray:
    """A column of the words that have a code, in the order of Deal.words; at most as many rows as there are codes."""
    d = deal.value
    if not len(d.words):
        return np.zeros(0)
    least = int(d.counts.min())
    last = int(d.words[d.counts == least].view(np.int64).max())
    rows = words.where((F.col("n") > least) | ((F.col("n") == least) & (F.col("h") <= last))).select("h", F.col(value).alias("v")).toPandas()
    out = np.empty(len(d.words))
    out[np.searchsorted(d.words, rows["h"].to_numpy(np.int64).view(np.uint64))] = rows["v"].to_numpy(float)
    return out


def _contexts(d: Deal, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds, tokens, once = d.joined(table, CONTEXTS, np.uint64, np.int64, np.int64)
    order = _order(kinds)
    return kinds[order], tokens[order], once[order]


def _seat_pairs(state: DataFrame, known: DataFrame, deal, top, shared: dict[int, float], p: Params, rate_: float, sweep: int) -> DataFrame:
    """OFTEN and CONTEXTS after a sweep over the restaurants of pairs, with TABLES and SHARED."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        b, d = key[0].as_py(), deal.value
        u, w, n, t, held = d.joined(left, OFTEN, np.uint64, np.uint64, *[np.int64] * 3)
        kinds, tokens, once = _contexts(d, left)
        at = Lookup(kinds).find(u)[1]
        everyone = _known(once + np.bincount(at, t, len(kinds)), kinds, shared)
        base = _probabilities(d, top.value, right, w)
        t = draw_tables(n, everyone[at] - t, base, rate_, _pair(u, w), sweep, p)
        held = held + t * (sweep > p.burn_in)
        order, first = _runs(w)
        rows = d.blobs(b, OFTEN, u, w, n, t, held) + d.blobs(b, CONTEXTS, kinds, tokens, once)
        return _rows(rows, (b, TABLES, w[order[first]], np.add.reduceat(t[order], first) if len(w) else t), (b, SHARED, *_shared(d, kinds, once + np.bincount(at, t, len(kinds)))))

    return _cogrouped(state, known).applyInArrow(tidy_groups(run), BUCKETED_SQL)


def _cogrouped(left: DataFrame, right: DataFrame):
    """Both sides by bucket; the right one's columns are named anew, as both may come from one table."""
    return left.groupBy("bucket").cogroup(right.select(*(F.col(c).alias(c) for c in right.columns)).groupBy("bucket"))


def _asked(need: DataFrame, words: DataFrame, value: str) -> DataFrame:
    """Rows NEEDED of BUCKETED that bring a column of the words to the buckets that need them."""
    return need.select("bucket", "w").join(words.select(F.col("h").alias("w"), F.col(value).alias("v")), "w").select("bucket", F.lit(NEEDED).alias("kind"), F.lit(None).cast("binary").alias("blob"), "w", "v")


@dataclass
class Learned:
    """words: (word, h, n, log10_prob). spellings: of each sample, with their weights in it. rate: discount of the pairs."""

    words: DataFrame
    total: int
    kinds: int
    spellings: list[tuple[float, Spelling]]
    deal: object
    rate: float
    pairs: DataFrame
    state: DataFrame
    shared: dict[int, float]
    tables: tuple[DataFrame, ...]

    def unseen(self, words: pa.Array) -> np.ndarray:
        """log10 probability of words, of which none has been seen, without a word before."""
        return log_unseen(self.spellings, words)


def log_unseen(spellings: list[tuple[float, Spelling]], words: pa.Array) -> np.ndarray:
    owner, codes = spelled(words)
    each = np.stack([np.log(weight) + s.log_spelled(owner, codes, len(words)) for weight, s in spellings])
    return (np.logaddexp.reduce(each, 0) - np.log(len(spellings))) / np.log(10)


def learn(docs: DataFrame, p: Params = Params()) -> Learned:
    """All restaurants after the last sweep. Of no rows nothing is known, and all words are spelled at random."""
    spark = docs.sparkSession
    types = stored(count_words(docs, p).select("word", "h", "n", F.lit(0).cast("long").alias("c"), F.lit(1).cast("long").alias("t"), F.lit(0.0).alias("prob")), "words")
    kept = types  # what types is made of
    total, kinds = (int(x or 0) for x in types.agg(F.sum("n"), F.count("*")).first())
    top = types.orderBy(F.desc("n"), "h").select("h", "n").limit(RARE).collect()
    deal = spark.sparkContext.broadcast(Deal.of([tuple(r) for r in top], total, p))
    pairs = stored(count_pairs(docs, deal, p), "pairs")
    rates = {r["w"]: r["n"] for r in pairs.where(F.col("kind") == RATES).groupBy("w").agg(F.sum("v").alias("n")).collect()}
    rate_ = rate(rates.get(1, 0), rates.get(2, 0))
    few_ = stored(pairs.where(F.col("kind").isin(*ALL_FEW)).groupBy("w").agg(F.sum("v").alias("v")), "few")
    need = stored(pairs.where(F.col("kind").isin(*RARE_OF_OFTEN)).select("bucket", "w"), "needed")
    state, seated = pairs.where(F.col("kind").isin(OFTEN, CONTEXTS)), pairs
    everyone, spelling, spellings = kinds, Spelling(p), []
    shared, average = _of_shared(pairs), {}
    for sweep in range(1, p.burn_in + p.samples + 1):
        tables = seated.where(F.col("kind").isin(*ALL_TABLES)).select("w", "v")
        customers = few_.unionByName(tables).groupBy("w").agg(F.sum("v").cast("long").alias("c")).withColumnRenamed("w", "h")
        came = stored(types.drop("c").join(customers, "h").select("word", "h", "n", "c", "t", "prob"), "customers")
        come, one, two = (int(x or 0) for x in came.agg(F.sum("c"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first())
        d = rate(one, two)
        spelling = spelling.swept(*_symbols(types), sweep)
        sat = stored(_seat_words(came, spelling, p, d, everyone, sweep), "seated_words")
        discard(kept, came)
        everyone = int(sat.agg(F.sum("t")).first()[0] or 0)
        fresh = p.strength + d * everyone
        sat_now = sat.withColumn("now", (F.col("c") - d * F.col("t") + fresh * F.col("base")) / (p.strength + come))
        if sweep > p.burn_in:
            spellings.append((fresh / (p.strength + come), spelling))
            sat_now = sat_now.withColumn("prob", F.col("prob") + F.col("now"))
        types, kept = sat_now, sat
        old, seated = seated, stored(_seat_pairs(state, _asked(need, types, "now"), deal, spark.sparkContext.broadcast(_top(deal, types, "now")), shared, p, rate_, sweep), "seated_pairs")
        if sweep > 1:
            discard(old)
        state, shared = seated.where(F.col("kind").isin(OFTEN, CONTEXTS)), _of_shared(seated)
        if sweep > p.burn_in:
            average = {k: average.get(k, 0) + v / p.samples for k, v in shared.items()}
    words = types.select("word", "h", "n", F.log10(F.col("prob") / p.samples).alias("log10_prob"))
    discard(few_, need)
    return Learned(words, total, kinds, spellings, deal, rate_, pairs, state, average, (pairs, seated, kept))


def train(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, int, int, Learned]:
    """((word, n, log10_prob) of every word of docs, tokens, distinct tokens, the model).

    These are the word restaurant's, without a word before; the model's unseen() gives those of other words. Every text
    ends with one end token.
    """
    m = learn(docs, p)
    return m.words.select("word", "n", "log10_prob"), m.total, m.kinds, m


def _answers(m: Learned, p: Params) -> DataFrame:
    """By bucket: WORDS with count, log10 probability and log10 weight of the parent; PAIRS with what they add to that."""
    rate_, floor, deal, shared = m.rate, m.total + 0.1 * (m.kinds + 1), m.deal, m.shared

    def homes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = deal.value
        for part in _gathered(parts):
            h, n, prob = (part.column(c).to_numpy() for c in ("h", "n", "log10_prob"))
            index, to = d.homes(h.view(np.uint64))
            order = np.argsort(to, kind="stable")
            index, to = index[order], to[order]
            ends = np.searchsorted(to, np.arange(d.buckets + 1))
            rows = []
            for b in np.unique(to).tolist():
                i = index[ends[b] : ends[b + 1]]
                rows += d.blobs(b, WORDS, h.view(np.uint64)[i], n[i], prob[i])
            yield from _rows(rows).to_batches()

    own = m.words.select("h", "n", "log10_prob").mapInArrow(homes, BUCKETED_SQL)
    known = _asked(m.pairs.where(F.col("kind").isin(*RARE_OF_PAIRS)), m.words, "log10_prob").unionByName(own)
    top = m.words.sparkSession.sparkContext.broadcast(_top(deal, m.words, "log10_prob"))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        b, d = key[0].as_py(), deal.value
        u, w, n = d.joined(left, PAIRS, np.uint64, np.uint64, np.int64)
        often_u, often_w, _, _, held = d.joined(left, OFTEN, np.uint64, np.uint64, *[np.int64] * 3)
        held = held / p.samples
        kinds, tokens, once = _contexts(d, left)
        place = Lookup(kinds)
        everyone = _known(once + np.bincount(place.find(often_u)[1], held, len(kinds)), kinds, shared)
        tokens = _known(tokens, kinds, {int(h): int(d.counts[np.searchsorted(d.words, h)]) for h in d.shared()})
        fresh = p.strength + rate_ * everyone
        tables = np.ones(len(u))
        tables[Lookup(_pair(u, w)).find(_pair(often_u, often_w))[1]] = held
        prob = _probabilities(d, top.value, right, w)
        more = np.log10(1 + (n - rate_ * tables) / (fresh[place.find(u)[1]] * 10**prob)).astype(np.float32) if len(u) else np.zeros(0, np.float32)
        own, count, prob = d.joined(right, WORDS, np.uint64, np.int64, np.float64)
        here, at = place.find(own)
        back = np.zeros(len(own))
        back[here] = np.log10(fresh / (p.strength + tokens))[at[here]]
        for k in np.flatnonzero(np.isin(own, d.shared())):  # a part of a frequent word's restaurant may be empty here
            back[k] = np.log10((p.strength + rate_ * shared[int(own[k])]) / (p.strength + d.counts[np.searchsorted(d.words, own[k])]))
        return _rows(d.blobs(b, PAIRS, u, w, more) + d.blobs(b, WORDS, own, np.log10((count + 0.1) / floor), prob + back))

    left = m.pairs.where(F.col("kind") == PAIRS).unionByName(m.state)
    return _cogrouped(left, known).applyInArrow(tidy_groups(run), BUCKETED_SQL)


def score(docs: DataFrame, learn_column: str, p: Params = Params()) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) of each row of docs.

    docs has doc_id, text and a boolean column of the given name that marks the training rows; other columns are
    ignored. score sums the log10 probability of each token after the one before it. A null text counts as empty, which
    is the end token alone. Repeated rows are learned and scored as often as they occur; of no rows there are none.
    """
    docs = docs.select("doc_id", "text", F.coalesce(F.col(learn_column), F.lit(False)).alias("learn"))
    m = learn(docs.where("learn"), p)
    deal, total, floor = m.deal, m.total, m.total + 0.1 * (m.kinds + 1)
    spellings = docs.sparkSession.sparkContext.broadcast(m.spellings)
    answers = stored(_answers(m, p), "answers")
    discard(*m.tables)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Questions: what a batch of rows asks each bucket; one row has the facts of the batch."""
        batch, d = TaskContext.get().partitionId() << 33, deal.value
        for rows, words, order, h, u, w, row in _tokens(parts, p):
            code = d.codes(h)
            # only words without a code of rows that are not learned can be unknown; the end token is none of them
            new = np.zeros(len(h), bool)
            new[w[~rows.column("learn").to_numpy(zero_copy_only=False)[row]]] = True
            new &= (code == RARE) & (order < len(words))
            spelled_ = np.zeros(len(h))
            if new.any():
                spelled_[new] = log_unseen(spellings.value, words.take(pa.array(order[new])))
            out = []
            tokens = np.bincount(row, minlength=rows.num_rows)
            one, many, first, by_pair = _grouped_places(u, w, row, len(h))
            u, w = u[one], w[one]
            del one, row, order
            by, ends = d.by_bucket(h, u, w)
            for b in range(d.buckets):
                if len(i := by[ends[b] : ends[b + 1]]):
                    at = np.repeat(first[i], many[i]) + _within(many[i])
                    before, after = u[i], w[i]
                    first_own = _begins(before)
                    first_own = first_own[new[before[first_own]]]
                    out.append((b, batch, rows.num_rows, d.pack((code[before], h[before]), (code[after], h[after]), many[i], by_pair[at], first_own, spelled_[before[first_own]]), None))
            facts = [{"doc_id": i, "learn": own, "n_tokens": int(n)} for i, own, n in zip(rows.column("doc_id").to_pylist(), rows.column("learn").to_pylist(), tokens, strict=True)]
            out.append((int(batch % d.buckets), batch, rows.num_rows, None, facts))
            yield from pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), QUESTION, strict=True)], schema=QUESTION).to_batches(max_chunksize=64)
            batch += 1

    def answer(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        d = deal.value
        pair_u, pair_w, more = d.joined(right, PAIRS, np.uint64, np.uint64, np.float32)
        pair = _pair(pair_u, pair_w)
        del pair_u, pair_w
        order = _order(pair)
        pairs, more = Lookup(pair[order]), more[order]
        del pair, order
        words, base, prob = d.joined(right, WORDS, np.uint64, np.float64, np.float64)
        words = Lookup(words)
        out = []
        for b, batch, size, blob, facts in zip(*(left.column(c).to_pylist() for c in QUESTION.names), strict=True):
            if blob is not None:
                u, w, many, row, at, spelled_ = d.unpack(blob)
                hit, k = pairs.find(_pair(u, w))
                first = _begins(u)  # equal words before stand together
                size_u = np.diff(first, append=len(u))
                known, i = words.find(u[first])
                of_base, of_score = np.full(len(first), np.log10(0.1 / floor)), np.zeros(len(first))
                of_score[np.searchsorted(first, at)] = spelled_
                of_base[known], of_score[known] = base[i[known]], prob[i[known]]
                known, of_base, of_score = (np.repeat(x, size_u) for x in (known, of_base, of_score))
                of_score[hit] += more[k[hit]]
                sums = [np.bincount(row, np.repeat(x, many), size) for x in (known, of_base, of_score)]
                at = np.flatnonzero(sums[1])
                blob = d.pack(at, sums[0][at].astype(np.int64), sums[1][at], sums[2][at])
            out.append((b, batch, size, blob, facts))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, QUESTION, strict=True)], schema=QUESTION)

    def add(key: tuple, table: pa.Table) -> pa.Table:
        size = table.column("rows")[0].as_py()
        known, base, prob = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        facts = None
        for _, _, _, blob, own in sorted(zip(*(table.column(c).to_pylist() for c in QUESTION.names), strict=True), key=lambda r: (r[3] is None, r[0])):
            if blob is None:
                facts = own
            else:
                at, *sums = deal.value.unpack(blob)
                for whole, x in zip((known, base, prob), sums, strict=True):
                    whole[at] += x
        return pa.table({"doc_id": pa.array([f["doc_id"] for f in facts], pa.int64()), "learned": pa.array([f["learn"] for f in facts], pa.bool_()), "n_tokens": pa.array([f["n_tokens"] for f in facts], pa.int64()), "n_known": known, "base_score": base, "score": prob})

    asked = docs.mapInArrow(tidy(run), QUESTION_SQL)
    answered = _cogrouped(asked, answers).applyInArrow(tidy_groups(answer), QUESTION_SQL)
    sums = answered.groupBy("batch").applyInArrow(add, "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double")
    return sums.select("doc_id", "learned", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


FACT = pa.struct([("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64())])
QUESTION = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("rows", pa.int32()), ("blob", pa.binary()), ("facts", pa.list_(FACT))])
QUESTION_SQL = "bucket int, batch long, rows int, blob binary, facts array<struct<doc_id: long, learn: boolean, n_tokens: long>>"
