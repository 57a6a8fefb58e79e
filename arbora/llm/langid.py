"""Language identification by interpolated Kneser-Ney character models.

A word is read as its lower-case letters between boundaries; runs of other characters are boundaries too. The models
of all languages share sorted arrays of n-gram hashes with one probability column per language. The language with the
lowest cross-entropy per character wins; its score is a softmax whose temperature is fitted on documents that the
counts have not seen. Stretches of those documents, from 8 letters on in powers of two, give each language and length
a cross-entropy that a stated share of them exceeds; a text beyond that of its language and length is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.text import byte_texts, few, give_back, mix, signed, split_words, tidy
from arbora.llm.workspace import discard, stored

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """documents: labelled texts per language, about, to learn from; one in five of them calibrates.

    false_rate: share of a learned language's texts, about, that is rejected. lengths: letters of the stretches that set
    the limits, `stretches` of each length from a text at most. enough: stretches from which a language sets a limit by
    itself; with fewer, its middle is moved by what all languages together show.
    """

    order: int = 5
    documents: int = 1500
    false_rate: float = 1e-3
    lengths: tuple[int, ...] = (8, 16, 32, 64, 128, 256, 512, 1024)
    stretches: int = 16
    enough: int = 400


def letters(word: bytes) -> str:
    """A word's letters in lower case, with one space around each run of letters; of no letters, nothing."""
    text = word.decode("utf-8", "ignore").lower()
    if not text.isalpha():
        text = " ".join("".join(c if c.isalpha() else " " for c in text).split())
    return f" {text} " if text else ""


def grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(word of each character, its place in the word, hashes of the 1 to order characters that end there)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = [mix(codes + np.uint64(1))]
    for _ in range(order - 1):
        before = np.concatenate([np.zeros(1, np.uint64), found[-1][:-1]]) if len(codes) else found[-1]
        found.append(mix(before * np.uint64(0x9E3779B97F4A7C15) + codes + np.uint64(1)))
    return owner, place, found


@dataclass
class Model:
    """prob[k], back[k]: log probabilities of n-grams and log back-off weights of their contexts, a column per language."""

    languages: list[str]
    order: int
    keys: list[np.ndarray] = field(default_factory=list)
    prob: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    back: list[np.ndarray] = field(default_factory=list)
    floor: float = -20.0
    temperature: float = 1.0
    limits: np.ndarray | None = None

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability under each language, characters predicted) of each word."""
        width = len(self.languages)
        total, length = np.zeros((len(words), width)), np.zeros(len(words))
        full = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)))
        if not len(full):
            return total, length
        owner, place, found = grams([words[i] for i in full], self.order)
        each = np.zeros((len(owner), width))
        at = np.flatnonzero(place > 0)
        for k in range(self.order if width else 0, 0, -1):
            due = place[at] + 1 >= k
            here = at[due]
            if not len(here):
                continue
            hit, index = _find(self.keys[k - 1], found[k - 1][here])
            each[here[hit]] += self.prob[k - 1][index[hit]]
            rest = here[~hit]
            if k == 1:
                each[rest] += self.back[0][0] + self.floor
            else:
                known, index = _find(self.contexts[k - 1], found[k - 2][rest - 1])
                each[rest[known]] += self.back[k - 1][index[known]]
            at = np.concatenate([at[~due], rest])
        if width:
            total[full] = np.add.reduceat(each, np.flatnonzero(place == 0))
        length[full] = np.bincount(owner) - 1
        return total, length


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    index = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[index] == wanted, index


def kneser_ney(languages: list[str], rows: dict[str, np.ndarray], order: int) -> Model:
    """The model from columns language, k, gram, suffix, context, begins and n, a row for each language and n-gram."""
    model, width = Model(languages, order), len(languages)
    chars = max(1, len(np.unique(rows["gram"][rows["k"] == 1])))
    model.floor = -np.log(chars + 1)
    below = None
    counts, by = [], []
    for k in range(1, order + 1):
        at = rows["k"] == k
        own = {c: v[at] for c, v in rows.items()}
        keys, first, index = np.unique(own["gram"], return_index=True, return_inverse=True)
        raw = np.zeros((len(keys), width))
        np.add.at(raw, (index, own["language"]), own["n"])
        counts.append(raw)
        by.append((keys, own["suffix"][first], own["context"][first], own["begins"][first]))
    for k in range(1, order + 1):
        keys, suffix, context, begins = by[k - 1]
        adjusted = counts[k - 1]
        if k < order:  # how many different characters come before
            hit, index = _find(keys, by[k][1])
            before = np.zeros_like(adjusted)
            np.add.at(before, index[hit], counts[k][hit] > 0)
            adjusted = np.where(begins[:, None], adjusted, before)
        once, twice = (adjusted == 1).sum(0), (adjusted == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        contexts, group = np.unique(context, return_inverse=True)
        sums, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(sums, group, adjusted)
        np.add.at(kinds, group, adjusted > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(sums > 0, discount * kinds / sums, 1.0)
            own = np.where(sums[group] > 0, np.maximum(adjusted - discount, 0) / sums[group], 0.0)
        lower = np.full((len(keys), width), np.exp(model.floor)) if k == 1 else np.exp(below[1][_find(below[0], suffix)[1]])
        counts[k - 1] = by[k - 1] = adjusted = None  # the driver's memory is small
        logs = np.log(own + weight[group] * lower)
        model.keys.append(keys)
        model.prob.append(logs)
        model.contexts.append(contexts)
        model.back.append(np.log(weight) if len(weight) else np.zeros((1, width)))
        below = (keys, logs)
    return model


#: Words that are scored at once, and bytes of text that are read at once, about. Results do not depend on them.
TOGETHER, BYTES = 8_192, 1_000_000


class Reader:
    """Scores texts word by word, remembering distinct words of up to `most` bytes in all."""

    def __init__(self, model: Model, most: int = 6_000_000):
        self.model, self.most = model, most
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.held = 0
        self.scores = np.zeros((1 << 12, len(self.model.languages)))
        self.lengths = np.zeros(1 << 12)

    def learn(self, words: list[bytes]) -> np.ndarray:
        """The places of distinct words in scores and lengths."""
        if self.held > self.most:
            self._clear()
        if new := [w for w in words if w not in self.place]:
            k = len(self.place)
            while k + len(new) > len(self.lengths):
                self.scores, self.lengths = np.concatenate([self.scores, np.zeros_like(self.scores)]), np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            for at in range(0, len(new), TOGETHER):  # a word has a dozen numbers for each of its letters
                some = slice(k + at, k + min(at + TOGETHER, len(new)))
                self.scores[some], self.lengths[some] = self.model.score([letters(w) for w in new[at : at + TOGETHER]])
            self.place.update(zip(new, range(k, k + len(new)), strict=True))
            self.held += sum(map(len, new)) + 16 * len(new)
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log probabilities, characters, row) of each word of a column's texts."""
        words, index, sizes = split_words(column)
        at = self.learn(words.to_pylist())
        at = at[index] if len(at) else at
        return self.scores[at], self.lengths[at], np.repeat(np.arange(len(column)), sizes)

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log probability under each language, characters) of each text."""
        scores, lengths, row = self.words(column)
        sums = [np.bincount(row, x, len(column)) for x in (*scores.T, lengths)]
        return np.column_stack(sums[:-1]) if len(sums) > 1 else np.zeros((len(column), 0)), sums[-1]


COUNTS = "language string, k int, gram long, suffix long, context long, begins boolean, n long"


def _counts(docs: DataFrame, order: int) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words: dict[str, Counter] = {}
            for text, language in zip(byte_texts(part.column("text")), part.column("lang").to_pylist(), strict=True):
                words.setdefault(language, Counter()).update(text.split())
            for language, seen in words.items():
                read = Counter()
                for w, n in seen.items():
                    if x := letters(w):
                        read[x] += n
                owner, place, found = grams(list(read), order)
                often = np.fromiter(read.values(), np.int64, len(read))[owner]
                for k in range(1, order + 1):
                    at = np.flatnonzero((place > 0) & (place + 1 >= k))
                    keys, first, index = np.unique(found[k - 1][at], return_index=True, return_inverse=True)
                    at_first = at[first]
                    suffix = found[k - 2][at_first] if k > 1 else np.zeros(len(keys), np.uint64)
                    context = found[k - 2][at_first - 1] if k > 1 else np.zeros(len(keys), np.uint64)
                    n = np.bincount(index, often[at], len(keys)).astype(np.int64)
                    yield pa.record_batch([pa.array([language] * len(keys), pa.string()), pa.array(np.full(len(keys), k, np.int32)), *(pa.array(signed(x)) for x in (keys, suffix, context)), pa.array(place[at_first] + 1 == k), pa.array(n)], names=["language", "k", "gram", "suffix", "context", "begins", "n"])

    seen = docs.select("text", "lang").mapInArrow(tidy(run), COUNTS)
    return seen.groupBy("language", "k", "gram").agg(F.min("suffix").alias("suffix"), F.min("context").alias("context"), F.min("begins").alias("begins"), F.sum("n").alias("n"))


def columns_of(counts: DataFrame, languages: list[str]) -> dict[str, np.ndarray]:
    """The columns that kneser_ney() takes, from rows of _counts(); they come as Arrow, and no column is held twice."""
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("language")) - 1
    table = counts.select(number.cast("int").alias("language"), F.col("k").cast("byte").alias("k"), "gram", "suffix", "context", "begins", "n").toArrow()
    out = {}
    for c in table.column_names:
        out[c] = table.column(c).to_numpy()
        table = table.drop_columns([c])
        if c in ("gram", "suffix", "context"):
            out[c] = out[c].view(np.uint64)
    return out


def train(docs: DataFrame, p: Params = Params()) -> Model:
    """A model from the columns text and lang of labelled documents.

    Of each language it takes about p.documents different texts, chosen by a hash of the text, and all where there are
    fewer; a text counts once however often it occurs. What comes to the driver is bounded by that.
    """
    known = docs.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"), F.abs(F.xxhash64("text") % 1_000_003).alias("draw"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], p.order)
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(int(1_000_003 * min(1.0, p.documents / sizes[k])) + 1))])
    taken = stored(known.where(F.col("draw") < F.try_element_at(share, F.col("lang"))).dropDuplicates(["lang", "h"]).drop("h"), "sample")
    few_ = [k for k in languages if sizes[k] < 50]  # too few to set any aside
    columns = columns_of(_counts(taken.where((F.col("draw") % 5 != 0) | F.col("lang").isin(few_)), p.order), languages)
    model = kneser_ney(languages, columns, p.order)
    del columns
    give_back()
    _calibrate(model, taken.where("draw % 5 = 0"), p)
    discard(taken)
    return model


def _stretches(scores: np.ndarray, lengths: np.ndarray, p: Params) -> Iterator[tuple[int, float]]:
    """(number of the length, cross-entropy) of stretches of whole words, spread evenly over a text."""
    total, letters_ = np.concatenate([[0.0], np.cumsum(scores)]), np.concatenate([[0.0], np.cumsum(lengths)])
    for k, size in enumerate(p.lengths):
        count = int(min(p.stretches, letters_[-1] // size))
        for begin in (np.arange(count) * (letters_[-1] / max(count, 1))).tolist():
            a = int(np.searchsorted(letters_, begin))
            b = int(np.searchsorted(letters_, letters_[min(a, len(lengths))] + size))
            if b <= len(lengths):
                yield k, float((total[a] - total[b]) / (letters_[b] - letters_[a]))


def limits_of(place: np.ndarray, language: np.ndarray, entropy: np.ndarray, width: int, p: Params) -> np.ndarray:
    """For each length and language, the cross-entropy that p.false_rate of the stretches exceeds; none where unknown.

    A longer length that too few stretches show has the limit of the one before it.
    """
    out = np.full((len(p.lengths), width), np.inf)
    for k in range(len(p.lengths)):
        here = place == k
        middles = np.array([np.median(entropy[here & (language == j)]) if (here & (language == j)).any() else np.nan for j in range(width)])
        beyond = entropy[here] - middles[language[here]]
        for j in range(width):
            own = entropy[here & (language == j)]
            if len(own) >= p.enough:
                out[k, j] = np.quantile(own, 1 - p.false_rate)
            elif len(own) and len(beyond) >= p.enough:
                out[k, j] = middles[j] + np.quantile(beyond, 1 - p.false_rate)
            elif k:
                out[k, j] = out[k - 1, j]
    return out


def _calibrate(model: Model, docs: DataFrame, p: Params) -> None:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for part in few(parts, BYTES):
            each, n, row = reader.words(part.column("text"))
            ends = np.searchsorted(row, np.arange(part.num_rows + 1))
            names = part.column("lang").to_pylist()
            found = [(each[a:b].sum(0).tolist(), n[a:b].sum(), list(_stretches(each[a:b, shared.value.languages.index(own)], n[a:b], p))) for own, a, b in zip(names, ends[:-1], ends[1:], strict=True)]
            scores, sizes, own = zip(*found, strict=True)
            kind = pa.list_(pa.struct([("k", pa.int32()), ("entropy", pa.float64())]))
            yield pa.record_batch([part.column("lang"), pa.array(scores, pa.list_(pa.float64())), pa.array(sizes, pa.float64()), pa.array([[{"k": k, "entropy": x} for k, x in s] for s in own], kind)], names=["lang", "scores", "n", "stretches"])

    rows = docs.select("text", "lang").mapInArrow(tidy(run), "lang string, scores array<double>, n double, stretches array<struct<k: int, entropy: double>>").where("n > 0").collect()  # of the sample
    width = len(model.languages)
    model.limits = np.full((len(p.lengths), width), np.inf)
    if not rows:
        return
    number = {k: i for i, k in enumerate(model.languages)}
    scores, truth = np.array([r["scores"] for r in rows]), np.array([number[r["lang"]] for r in rows])

    def loss(t):
        x = scores * t
        x -= x.max(1, keepdims=True)
        return (np.log(np.exp(x).sum(1)) - x[np.arange(len(x)), truth]).mean() + 1e-4 * t  # a cost keeps it finite when all are right

    model.temperature = float(min(np.geomspace(1e-3, 1, 40), key=loss))
    each = [(x["k"], j, x["entropy"]) for r, j in zip(rows, truth, strict=True) for x in r["stretches"]]
    if each:
        place, language, entropy = (np.array(x) for x in zip(*each, strict=True))
        model.limits = limits_of(place, language, entropy, width, p)


PREDICTED = "lang_pred string, score double, cross_entropy double, rejected boolean"


def identify(docs: DataFrame, model: Model, keep: list[str], p: Params = Params()) -> DataFrame:
    """The columns `keep` of docs with lang_pred, score, cross_entropy (nats a character) and rejected.

    Reads text only. A null text, or one without a letter, is `und` with score 0 and rejected; so is every text where
    no language was learned. Texts shorter than the shortest calibrated length are judged by the limit of that length. Ties go to the
    language that comes first. Rows are neither merged nor dropped. A kept column that is named like one of the four
    is returned as kept_ and its name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [docs.schema[c] for c in keep]
    names = [f"kept_{i}" for i in range(len(keep))]
    column = names[keep.index("text")] if "text" in keep else "text"  # a text goes to the task once

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = Reader(model)
        for part in few(parts, BYTES, column):
            scores, n = reader.read(part.column(column))
            known = (n > 0) & bool(model.languages)
            at = scores.argmax(1) if model.languages else np.zeros(len(n), np.int64)
            best = scores[np.arange(len(n)), at] if model.languages else np.zeros(len(n))
            sure = 1 / np.exp((scores - best[:, None]) * model.temperature).sum(1) if model.languages else np.zeros(len(n))
            entropy = -best / np.maximum(n, 1)
            rejected = ~known
            if model.limits is not None:
                k = np.clip(np.searchsorted(p.lengths, n, "right") - 1, 0, None)
                rejected |= entropy > model.limits[k, at]
            tags = np.array([*model.languages, UNKNOWN], object)[np.where(known, at, -1)]
            cols = (pa.array(tags, pa.string()), pa.array(np.where(known, sure, 0.0)), pa.array(entropy, mask=~known), pa.array(rejected))
            yield pa.record_batch([*(part.column(c) for c in names), *cols], names=[*names, *NEW])

    source = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), *([] if "text" in keep else ["text"]))
    out = source.mapInArrow(tidy(run), ", ".join([*(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept, strict=True)), PREDICTED]))
    return out.select(*(F.col(n).alias(f"kept_{c}" if c in NEW else c) for n, c in zip(names, keep, strict=True)), *NEW)


NEW = ["lang_pred", "score", "cross_entropy", "rejected"]
