"""Toxicity of texts that may be disguised, by a noisy channel and a scored restoration.

A written word is a noisy form of an intended one: letters become look-alike digits and signs, are repeated, are
separated by signs, or stand apart one by one. Suspicious words become lattices of what they may stand for, and the
Viterbi path under a character language model and the channel's costs is the restored word. Words of restored text
carry evidence learned from labelled documents, as whole words or by their beginnings, and a logistic curve over the
strong evidence of a document gives its score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm import langid
from arbora.llm.filter_audit import sieved
from arbora.llm.text import byte_texts, tidy
from arbora.llm.workspace import discard, stored

#: What look-alike characters stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i"}
#: What may close or open a word without being part of it.
OUTSIDE = ".,;:?!\"'`´«»“”„‘’()[]{}<>…*_-–—/\\~^#&=%"


ONE = rb"(?:[\x21-\x7e]|[\xc2-\xdf][\x80-\xbf])"
#: Three or more words of one character, a single blank apart; a wider gap or a line's end parts them.
SPACED = re.compile(rb"(?<![^\x20\x09-\x0d])" + ONE + rb"(?:[\x20\x09]" + ONE + rb"(?![^\x20\x09-\x0d])){2,}")


@dataclass(frozen=True)
class Params:
    """support: least share of toxic documents with a piece of evidence.

    strong: least evidence of a word that counts. Costs are in nats; boundary: of a blank that does part two words where
    every letter stands by itself.
    """

    support: float = 0.002
    strong: float = 2.0
    begins: tuple[int, int] = (4, 8)
    order: int = 5
    look: float = 1.5
    repeat: float = 0.7
    separator: float = 1.0
    boundary: float = 2.5
    threshold: float = 0.7


THRICE = re.compile(r"(.)\1\1")
SIGN = re.compile(r"[^\w\s]")


def without_repeated_ends(text: str) -> str:
    """A text without a sign that opens or closes it twice or more in a row."""
    if SIGN.match(text) and text[:2] == text[0] * 2:
        text = text.lstrip(text[0])
    if text and SIGN.match(text[-1]) and text[-2:] == text[-1] * 2:
        text = text.rstrip(text[-1])
    return text


def core(word: bytes) -> str:
    """A word in lower case without what surrounds it; a sign that is repeated at an end is no look-alike."""
    text = word.decode("utf-8", "ignore").lower().strip(OUTSIDE)
    return text if text.isalnum() else without_repeated_ends(text).strip(OUTSIDE)


def suspicious(text: str) -> bool:
    """Whether a word's core has letters, but not only, or one three times in a row."""
    if text.isalpha():
        return THRICE.search(text) is not None
    return any(map(str.isalpha, text))


def lattice(text: str, p: Params) -> list[list[tuple[str, float]]]:
    """For each run of equal characters: what it may stand for, with the channel's costs."""
    out = []
    for c, run in groupby(text):
        n = len(list(run))
        stands = [(c, 0.0)] if c.isalpha() else [(x, p.look) for x in LOOKS.get(c, "")]
        ways = []
        for x, cost in stands:
            if n <= 2:
                ways.append((x * n, cost * n))
            if n >= 2:
                ways += [(x, cost + p.repeat)] + [(x * 2, cost + p.repeat)] * (n > 2)
        if not c.isalpha():
            ways.append(("", p.separator * (3 if c.isdigit() else 1)))
        out.append(ways)
    return out


def spaced_lattice(text: str, p: Params) -> list[list[tuple[str, float]]]:
    """The lattice of characters that stood apart: between any two of them a word may end."""
    out: list[list[tuple[str, float]]] = []
    for c in text:
        out += [lattice(c, p)[0], [("", 0.0), (" ", p.boundary)]]
    return out[:-1]


@dataclass
class Model:
    letters: langid.Model
    evidence: dict[str, float] = field(default_factory=dict)
    begins: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.0]))


class Restorer:
    """Viterbi decoding, with the character model's answers remembered.

    Nothing is pruned: paths that agree in the last order - 1 letters, or since a word's beginning, go on as the best one.
    A path is its last piece and the path before it, so a step costs the same anywhere in a word, and paths that no state
    leads to any more are freed. While a single state has a single way there is nothing to choose, and the model isn't
    asked.
    """

    def __init__(self, model: langid.Model, p: Params, most: int = 200_000):
        self.model, self.p, self.most, self.known = model, p, most, {}

    def _learn(self, wanted: list[tuple[str, str]]) -> None:
        """Costs of (context, letters after it)."""
        if len(self.known) > self.most:
            self.known = {}
        if new := [x for x in dict.fromkeys(wanted) if x not in self.known]:
            total = self.model.score([a + b for a, b in new] + [a for a, _ in new])[0][:, 0]
            self.known.update(zip(new, (total[len(new) :] - total[: len(new)]).tolist(), strict=True))

    def __call__(self, text: str) -> str:
        return self.many([text])[0]

    def apart(self, texts: list[str]) -> list[list[str]]:
        """The words that characters which stood apart spell."""
        return [x.split() for x in self.many(texts, make=spaced_lattice)]

    def _steps(self, places: list[list[tuple[str, float]]], contexts: list[str], wanted: list[tuple[str, str]]) -> tuple[list, list[str]]:
        """For each place its steps (context, piece, cost, context after, whether the model is asked), and the last contexts."""
        width, out = self.model.order - 1, []
        for ways in places:
            choice = len(contexts) * len(ways) > 1
            steps = [(c, x, cost, " " if x == " " else (c + x)[-width:], choice and x != "") for c in contexts for x, cost in ways]
            if choice:
                wanted += [(c, x) for c, x, _, _, asked in steps if asked]
            out.append(steps)
            contexts = list(dict.fromkeys(k for _, _, _, k, _ in steps))
        return out, contexts

    def many(self, texts: list[str], together: int = 256, ahead: int = 4_096, make=lattice) -> list[str]:
        """Restored words. Up to `together` lattices advance side by side, by `ahead` places in all at a time, so that
        the model is asked once for many places; what is ahead is reached without knowing any cost."""
        out = []
        for at in range(0, len(texts), together):
            graphs = [[*make(t, self.p), [(" ", 0.0)]] for t in texts[at : at + together]]
            states: list[dict[str, tuple[float, tuple | None]]] = [{" ": (0.0, None)} for _ in graphs]
            done, left = 0, list(range(len(graphs)))
            while left:
                stride, wanted = max(8, ahead // len(left)), []
                chunks = [self._steps(graphs[k][done : done + stride], list(states[k]), wanted)[0] for k in left]
                self._learn(wanted)
                for k, chunk in zip(left, chunks, strict=True):
                    now = states[k]
                    for steps in chunk:
                        after: dict[str, tuple[float, tuple | None]] = {}
                        for context, x, cost, key, asked in steps:
                            total, path = now[context]
                            total += cost + (self.known[context, x] if asked else 0.0)
                            if key not in after or total < after[key][0]:
                                after[key] = (total, (x, path) if x else path)
                        now = after
                    states[k] = now
                done += stride
                left = [k for k in left if done < len(graphs[k])]
            for s in states:
                path, pieces = min(s.values(), key=lambda v: v[0])[1], []
                while path is not None:
                    pieces.append(path[0])
                    path = path[1]
                out.append("".join(reversed(pieces)).strip())
        return out


class Reader:
    """Evidence of each word of a text, remembering up to `most` distinct words."""

    def __init__(self, model: Model, p: Params, most: int = 400_000):
        self.model, self.p, self.most = model, p, most
        self.restore = Restorer(model.letters, p)
        self.known: dict[bytes, float] = {}
        self.starts = {b[: p.begins[0]] for b in model.begins}

    def word(self, text: str) -> float:
        """Evidence of a restored word; 0 where nothing is known."""
        if (found := self.model.evidence.get(text)) is not None:
            return found
        if text[: self.p.begins[0]] not in self.starts:
            return 0.0
        for n in range(min(self.p.begins[1], len(text)), self.p.begins[0] - 1, -1):
            if (found := self.model.begins.get(text[:n])) is not None:
                return found
        return 0.0

    def _learn(self, words: list[bytes]) -> None:
        cores = list(map(core, words))
        odd = [k for k, x in enumerate(cores) if suspicious(x)]
        for k, x in zip(odd, self.restore.many([cores[k] for k in odd]), strict=True):
            cores[k] = x
        self.known.update(zip(words, map(self.word, cores), strict=True))

    def spaced(self, text: bytes) -> Iterator[str]:
        """The characters of three or more words of a single one in a row."""
        for run in SPACED.findall(text):
            joined = b"".join(run.split()).decode("utf-8", "ignore").lower()
            if any(c.isalpha() for c in joined):
                yield joined

    def evidence(self, texts: list[bytes]) -> Iterator[float]:
        """The sum of the strong evidence of each text's distinct words."""
        at = 0
        while at < len(texts):
            if len(self.known) > self.most:
                self.known.clear()
            end, size = at, 0
            while end < len(texts) and (size == 0 or size + len(texts[end]) < 2_000_000):
                size += len(texts[end])
                end += 1
            split = [list(dict.fromkeys(t.split())) for t in texts[at:end]]
            self._learn(list(dict.fromkeys(w for words in split for w in words if w not in self.known)))
            for text, words in zip(texts[at:end], split, strict=True):
                found = np.fromiter(map(self.known.__getitem__, words), float, len(words))
                total = float(found[found > self.p.strong].sum())
                for word in dict.fromkeys(w for words_ in self.restore.apart(list(self.spaced(text))) for w in words_):
                    if (more := self.word(word)) > self.p.strong:
                        total += more
                yield total
            at = end


def score_of(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -40, 40)))


def logistic(seen: DataFrame, ridge: float = 0.05) -> np.ndarray:
    """Weights by Newton steps; the ridge keeps them finite where the classes are apart.

    seen: (evidence, n, toxic), a row for each evidence with its documents and the toxic ones; a step is one sum over all.
    """
    w, hold = np.zeros(2), np.diag([1e-6, ridge])
    x, n = F.col("evidence"), F.col("n")
    for _ in range(40):
        margin = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.lit(float(w[0])) + F.lit(float(w[1])) * x))
        q = 1 / (1 + F.exp(-margin))
        curve, rest = n * q * (1 - q), F.col("toxic") - n * q
        a, b, c, d, e = seen.agg(*(F.sum(y) for y in (curve, curve * x, curve * x * x, rest, rest * x))).first()
        step = np.linalg.solve(np.array([[a, b], [b, c]]) + hold, np.array([d, e]) - hold @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _named(text: bytes, p: Params) -> set[str]:
    """The words of a text that are letters only, and the beginnings of those, which end in ^."""
    words = {x for w in set(text.split()) if (x := core(w)).isalpha()}
    return words | {f"{x[:n]}^" for x in words for n in range(p.begins[0], min(p.begins[1], len(x)) + 1)}


def _frequent(docs: DataFrame, p: Params, wanted=None, held: int = 300_000) -> DataFrame:
    """(name, n): how many of the texts have each name, or each of the wanted ones. A task hands on what it has counted
    when that is about `held` names, and at its end."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, only = Counter(), wanted.value if wanted else None

        def out():
            yield from pa.table([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["name", "n"]).to_batches(max_chunksize=50_000)
            counts.clear()

        for part in parts:
            for text in byte_texts(part.column("text")):
                names = _named(text, p)
                counts.update(names if only is None else names & only)
            if len(counts) > held:
                yield from out()
        yield from out()

    return docs.select("text").mapInArrow(tidy(run), "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))


def _evidence(known: DataFrame, p: Params) -> tuple[dict[str, float], dict[str, float]]:
    """Log odds of words and of beginnings of words that enough toxic documents have.

    Those are found in the toxic documents; of the others only they are counted. As each has its share of the toxic
    documents, their number is bounded by a text's words over that share.
    """
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    rows = _frequent(known.where("toxic = 1"), p).where(F.col("n") >= max(2.0, p.support * toxic)).withColumnRenamed("n", "toxic").toPandas()
    wanted = known.sparkSession.sparkContext.broadcast(set(rows["name"]))
    others = {r["name"]: r["n"] for r in _frequent(known.where("toxic = 0"), p, wanted).collect()}
    rows["clean"] = rows["name"].map(others).fillna(0).astype(int)
    sure = np.maximum(rows["toxic"] - 1.5 * np.sqrt(rows["toxic"]), 0.05)  # a few documents that share a word prove little
    odds = np.log(sure / (toxic + 1)) - np.log((rows["clean"] + 0.5) / (clean + 1))
    found = dict(zip(rows["name"], odds.astype(float), strict=True))
    return {k: v for k, v in found.items() if k[-1] != "^"}, {k[:-1]: v for k, v in found.items() if k[-1] == "^" and v > 0}


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """A model from labels (doc_id, toxic) and the texts of those documents.

    It learns from all of them; what comes to the driver are counts of n-grams and words, and sums. A document with several
    labels is toxic if any says so; null labels are ignored.
    """
    labels = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.where("text is not null and doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("class"))
    known = sieved(texts, labels.select(F.xxhash64("doc_id").alias("class"))).drop("class").join(labels, "doc_id")
    known = stored(known.select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")), "labelled")
    columns = langid.columns_of(langid._counts(known.select("text", F.lit("x").alias("lang")), p.order), ["x"])
    model = Model(langid.kneser_ney(["x"], columns, p.order), *_evidence(known, p))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, p)
        for part in parts:
            x = list(reader.evidence(byte_texts(part.column("text"))))
            yield pa.record_batch([pa.array(x, pa.float64()), part.column("toxic")], names=["evidence", "toxic"])

    seen = known.mapInArrow(tidy(run), "evidence double, toxic int").groupBy("evidence").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
    seen = stored(seen, "evidence")
    if not seen.isEmpty():
        model.weights = logistic(seen)
    discard(known, seen)
    return model


def score(docs: DataFrame, model: Model, keep: list[str], p: Params = Params()) -> DataFrame:
    """The columns `keep` of docs with score (0 to 1) and predicted (1 from p.threshold on).

    Reads text only. A null or empty text has no evidence and the score that goes with that. Rows are neither merged
    nor dropped, and equal texts get equal scores. A kept column that is named like a new one is returned as kept_ and its
    name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [docs.schema[c] for c in keep]
    names = [f"kept_{i}" for i in range(len(keep))]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = Reader(model, p)
        for part in parts:
            x = np.fromiter(reader.evidence(byte_texts(part.column("text"))), float, part.num_rows).reshape(-1, 1)
            y = score_of(model.weights, x)
            yield pa.record_batch([*(part.column(n) for n in names), pa.array(y), pa.array((y >= p.threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    source = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.col("text").alias("text"))
    out = source.mapInArrow(run, ", ".join([*(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept, strict=True)), "score double, predicted int"]))
    return out.select(*(F.col(n).alias(f"kept_{c}" if c in ("score", "predicted") else c) for n, c in zip(names, keep, strict=True)), "score", "predicted")
