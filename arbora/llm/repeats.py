"""Long repeated passages, found through the interval tree of an enhanced suffix array.

Every 100-byte string contains exactly one anchor: the leftmost of its shortest-hash grams. All strings that share an
anchor place form a clip, at most 100 bytes to the anchor's right and the rest to its left, so equal strings always
meet under one anchor, wherever they stand. Clips that are equal as a whole are settled by the earliest of them. For
an anchor with several different clips, the suffixes that start at the anchor are sorted, their common-prefix lengths
are scanned with a stack into the interval tree, and within each interval the left extensions are told apart in the
same way. What remains are maximal repeats with all their occurrences: no longer string has the same occurrences.
A repeat's bytes are removed from all its occurrences but the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arbora.llm.text import byte_texts, few, signed, tidy
from arbora.llm.workspace import discard, stored

#: A document's place in the order: rows without an id come last.
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Params:
    """length: of the strings that count. gram: of an anchor. clips: in one sorted group, on average.

    crowd: an anchor with more different clips than this is settled string by string instead, with nothing gathered.
    hot: an anchor with more clips than this, and than a hundred-thousandth of all, has its clips dealt by their own
    hash, so that it is no task of its own; there are at most 100,000 of them.
    """

    length: int = 100
    gram: int = 28
    clips: int = 20_000
    crowd: int = 4096
    hot: int = 2000


ODD = [np.uint64(pow(0x9E3779B97F4A7C15, 2**i, 2**64)) for i in range(12)]


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive bytes, put together from those of 1, 2, 4, ... bytes."""
    powers = [data.astype(np.uint64) + np.uint64(1)]
    while 2 << (len(powers) - 1) <= n:
        k = len(powers) - 1
        powers.append(powers[k][: -(1 << k)] * ODD[k] + powers[k][1 << k :])
    out, at, count = None, 0, len(data) - n + 1
    for k in reversed(range(len(powers))):
        if n >> k & 1:
            part = powers[k][at : at + count]
            out = part.copy() if out is None else out * ODD[k] + part
            at += 1 << k
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def window_min(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def anchors(data: np.ndarray, starts: np.ndarray, p: Params) -> tuple[np.ndarray, ...]:
    """For texts that stand one after another: (hash, first string, last string, place) of each clip, places in data."""
    empty = (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    if len(data) < p.length:
        return empty
    width = p.length - p.gram + 1
    grams = gram_hashes(data, p.gram)
    least = window_min(grams, width)
    n = len(least)
    new = np.ones(n + 1, bool)
    new[1:n] = (least[1:] != least[:-1]) | (grams[: n - 1] == least[:-1])
    valid = np.ones(n, bool)
    for s in starts[1:]:  # strings that would cross the end of a text
        valid[max(0, s - p.length + 1) : min(s, n)] = False
        if s < n:
            new[s] = True
    new[1:n] |= valid[1:] != valid[:-1]
    first = np.flatnonzero(new[:n])
    last = np.append(first[1:], n) - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    h, place = least[first], last.copy()
    ahead = np.flatnonzero(grams[last] != h)
    step = np.arange(width)
    for at in range(0, len(ahead), 20_000):
        some = ahead[at : at + 20_000]
        near = grams[np.minimum(last[some, None] + step, len(grams) - 1)] == h[some, None]
        place[some] += near.argmax(1)
    return h, first, last, place


def text_key(text: bytes) -> int:
    """A 64-bit hash that tells apart different texts under one id, or without an id."""
    return xxhash.xxh3_64_intdigest(text, 7)


MARKS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("t", pa.int64()), ("loc", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("settled", pa.bool_())])
MARK_TYPES = "h long, c long, doc long, t long, loc long, left int, right int, settled boolean"
#: Bytes that are hashed, and clips that are compared with each other, at a time.
PIECE, HELD = 400_000, 300_000


def clips(docs: DataFrame, p: Params) -> DataFrame:
    """A row for each clip: anchor hash, clip hash, document, text, place. Copies within a batch are settled at once.

    A settled row says that [loc - left, loc + right) has an earlier occurrence.
    """

    def settle(found: list[list]) -> Iterator[pa.RecordBatch]:
        h, c, doc, t, loc, left, right = (np.concatenate(x) for x in found)
        order = np.lexsort((loc, t, doc, c, h))
        a, b = order[1:], order[:-1]
        equal, itself = (h[a] == h[b]) & (c[a] == c[b]), (doc[a] == doc[b]) & (t[a] == t[b]) & (loc[a] == loc[b])
        same, again = np.zeros(len(h), bool), np.zeros(len(h), bool)
        same[a], again[a] = equal & ~itself, equal & itself
        free = np.flatnonzero(~same & ~again)
        # settled clips that touch become one row
        k = np.flatnonzero(same)
        k = k[np.lexsort((loc[k], t[k], doc[k]))]
        lo, hi = loc[k] - left[k], loc[k] + right[k]
        fresh = np.ones(len(k), bool)
        fresh[1:] = (doc[k][1:] != doc[k][:-1]) | (t[k][1:] != t[k][:-1]) | (lo[1:] > hi[:-1])
        begin = np.flatnonzero(fresh)
        stop = np.append(begin[1:], len(k)) - 1 if len(k) else begin
        s_lo, s_hi = lo[begin], hi[stop]
        none = np.zeros(len(begin), np.int64)
        cols = (
            np.concatenate([signed(h[free]), none]),
            np.concatenate([signed(c[free]), none]),
            np.concatenate([doc[free], doc[k][begin]]),
            np.concatenate([t[free], t[k][begin]]),
            np.concatenate([loc[free], s_lo]),
            np.concatenate([left[free], none]).astype(np.int32),
            np.concatenate([right[free], s_hi - s_lo]).astype(np.int32),
            np.concatenate([np.zeros(len(free), bool), np.ones(len(begin), bool)]),
        )
        for b in pa.table([pa.array(x) for x in cols], schema=MARKS).to_batches(max_chunksize=50_000):
            yield b

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in few(parts, 16_000_000):
            ids, texts = part.column("doc_id").to_pylist(), byte_texts(part.column("text"))
            found: list[list] = [[] for _ in range(7)]
            held = 0
            keys = signed(np.fromiter(map(text_key, texts), np.uint64, len(texts)))
            docs_ = np.array([NO_ID if i is None else i for i in ids], np.int64)
            # a very long text stands in pieces that overlap by one byte less than a string
            pieces = [(k, o, t[o : o + PIECE]) for k, t in enumerate(texts) for o in range(0, max(1, len(t) - p.length + 1), PIECE - p.length + 1)]
            at = 0
            while at < len(pieces):
                end, size = at, 0
                while end < len(pieces) and (size == 0 or size + len(pieces[end][2]) <= PIECE):
                    size += len(pieces[end][2])
                    end += 1
                some = pieces[at:end]
                lengths = np.array([len(t) for _, _, t in some])
                starts = np.cumsum(lengths) - lengths
                joined = b"".join(t for _, _, t in some)
                h, first, last, place = anchors(np.frombuffer(joined, np.uint8), starts, p)
                if len(h):
                    owner = np.searchsorted(starts, first, "right") - 1
                    # empty texts share a start with the next one; the last of equal starts holds the bytes
                    stop = last + p.length
                    c = np.fromiter((xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in zip(first.tolist(), stop.tolist(), strict=True)), np.uint64, len(h))
                    c = c * np.uint64(0x9E3779B97F4A7C15) + (place - first).astype(np.uint64)
                    text_of = np.array([k for k, _, _ in some])[owner]
                    origin = np.array([o for _, o, _ in some], np.int64)[owner]
                    for o, v in zip(found, (h, c, docs_[text_of], keys[text_of], origin + place - starts[owner], place - first, stop - place), strict=True):
                        o.append(v)
                    held += len(h)
                if held > HELD:
                    yield from settle(found)
                    found, held = [[] for _ in range(7)], 0
                at = end
            if held:
                yield from settle(found)

    return docs.select("doc_id", "text").mapInArrow(tidy(run), MARK_TYPES)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the interval tree over a sorted list; lcp[i] is that of i - 1 and i."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        value = lcp[i] if i < len(lcp) else 0
        begin = i - 1
        while stack and stack[-1][0] > value:
            depth, begin = stack.pop()
            yield depth, begin, i - 1
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def maximal_repeats(keys: np.ndarray, left: list[bytes], right: list[bytes], p: Params) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes to the left, bytes to the right, clips) of the maximal repeats of at least p.length bytes.

    left: what stands before each anchor, backwards; right: from the anchor on.
    """
    n = len(keys)
    wide = (p.length + 7) // 8 * 8
    table = np.zeros((n, wide), np.uint8)
    size = np.fromiter(map(len, right), np.int64, n)
    table[np.arange(wide) < size[:, None]] = np.frombuffer(b"".join(right), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    order = np.lexsort([*table.view(">u8").T[::-1], keys])
    table, size, k = table[order], size[order], keys[order]
    differ = table[1:] != table[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), wide)
    lcp = np.where(k[1:] == k[:-1], np.minimum(lcp, np.minimum(size[1:], size[:-1])), 0)
    order = order.tolist()
    for r, first, last in intervals([0, *lcp.tolist()], p.gram):
        need = p.length - r
        group = sorted((left[i], i) for i in order[first : last + 1] if len(left[i]) >= need)
        if len(group) < 2:
            continue
        back = [0, *(common_prefix(group[i - 1][0], group[i][0]) for i in range(1, len(group)))]
        if need <= 0:  # strings that start at the anchor need no byte before it
            yield min(back[1:]), r, [i for _, i in group]
        for l, a, b in intervals(back, max(need, 1)):
            yield l, r, [i for _, i in group[a : b + 1]]


REPEATS = "doc long, t long, loc long, length long, repeat long, first boolean"


def _repeats(asked: DataFrame, p: Params, groups: int) -> DataFrame:
    """Occurrences of the maximal repeats among the clips of each anchor."""

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("h").to_numpy()
        doc, t, loc, n_left = (table.column(c).to_pylist() for c in ("doc", "t", "loc", "left"))
        body = table.column("clip").to_pylist()
        left = [x[:n][::-1] for x, n in zip(body, n_left, strict=True)]
        right = [x[n:] for x, n in zip(body, n_left, strict=True)]
        out: list[list] = [[] for _ in range(6)]
        at = list(zip(doc, t, loc, strict=True))
        for number, (l, r, clips_) in enumerate(maximal_repeats(keys, left, right, p)):
            first = min(clips_, key=at.__getitem__)
            name = (int(keys[first]) + number * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63
            for i in clips_:
                for o, v in zip(out, (doc[i], t[i], loc[i] - l, l + r, name, at[i] == at[first]), strict=True):
                    o.append(v)
        return pa.table([pa.array(o, k) for o, k in zip(out, [pa.int64()] * 5 + [pa.bool_()], strict=True)], names=["doc", "t", "loc", "length", "repeat", "first"])

    return asked.withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups))).groupBy("g").applyInArrow(run, REPEATS)


def _crowded(asked: DataFrame, p: Params) -> DataFrame:
    """The same for anchors with very many different clips: each string is compared by its hash."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[list] = [[] for _ in range(5)]
            for doc, t, loc, left, body in zip(*(part.column(c).to_pylist() for c in ("doc", "t", "loc", "left", "clip")), strict=True):
                for k in range(len(body) - p.length + 1):
                    x = xxhash.xxh3_128_intdigest(body[k : k + p.length])
                    for o, v in zip(out, (x >> 64, x & (2**64 - 1), doc, t, loc - left + k), strict=True):
                        o.append(v)
            cols = [signed(np.array(o, np.uint64)) for o in out[:2]] + [np.array(o, np.int64) for o in out[2:]]
            yield from pa.table(cols, names=["w1", "w2", "doc", "t", "loc"]).to_batches(max_chunksize=50_000)

    strings = stored(asked.select("doc", "t", "loc", "left", "clip").mapInArrow(run, "w1 long, w2 long, doc long, t long, loc long"), "strings")
    # an order on (doc, t, loc) by min alone: three aggregates, each with a partial step before the shuffle
    w = ["w1", "w2"]
    least = strings.groupBy(*w).agg(F.min("doc").alias("d"), F.count("*").alias("n")).where("n > 1")
    shared = stored(strings.join(least, w), "shared_strings")
    text = shared.where("doc = d").groupBy(*w).agg(F.min("t").alias("e"))
    begin = shared.where("doc = d").join(text, w).where("t = e").groupBy(*w, "e").agg(F.min("loc").alias("l"))
    placed = shared.join(begin, w)
    out = placed.select("doc", "t", "loc", F.lit(p.length).cast("long").alias("length"), F.xxhash64("w1", "w2").alias("repeat"), F.expr("doc = d and t = e and loc = l").alias("first"))
    out = stored(out, "crowded")
    discard(strings, shared)
    return out


def _packed_texts(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(kept_0, ..., doc, t, body): each row's text compressed for its way through a shuffle, with some columns."""
    names = [f"kept_{i}" for i in range(len(keep))]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for part in few(parts):
            column = part.column("text")
            texts = byte_texts(column)
            order = pa.array([NO_ID if i is None else i for i in part.column("doc").to_pylist()], pa.int64())
            bodies = pa.array([press.compress(t) if ok else None for t, ok in zip(texts, column.is_valid().to_pylist(), strict=True)], pa.binary())
            yield pa.record_batch([*(part.column(n) for n in names), order, pa.array(signed(np.fromiter(map(text_key, texts), np.uint64, len(texts)))), bodies], names=[*names, "doc", "t", "body"])

    source = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.col("doc_id").cast("long").alias("doc"), F.col("text").alias("text"))
    return source.mapInArrow(tidy(run), ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True)), "doc long, t long, body binary"]))


def _cut_clips(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of each clip that is asked for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            out: list[list] = [[] for _ in range(7)]
            for doc, t, body, items in zip(*(part.column(c).to_pylist() for c in ("doc", "t", "body", "items")), strict=True):
                text = unpack.decompress(body)
                for x in items:
                    for o, v in zip(out, (x["h"], doc, t, x["loc"], x["left"], x["n"], text[x["loc"] - x["left"] : x["loc"] + x["right"]]), strict=True):
                        o.append(v)
            yield from pa.table([pa.array(o, t) for o, t in zip(out, [pa.int64()] * 6 + [pa.binary()], strict=True)], names=["h", "doc", "t", "loc", "left", "n", "clip"]).to_batches(max_chunksize=20_000)

    by_doc = asked.groupBy("doc", "t").agg(F.collect_list(F.struct("h", "loc", "left", "right", "n")).alias("items"))
    texts = _packed_texts(docs).select("doc", "t", "body").where("body is not null").join(by_doc, ["doc", "t"])
    return texts.mapInArrow(tidy(run), "h long, doc long, t long, loc long, left long, n long, clip binary")


def occurrences(docs: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(doc, t, loc, length) that have an earlier occurrence and are settled as whole clips; and the maximal repeats."""
    every = stored(clips(docs, p), "found_clips")
    free = every.where("not settled").drop("settled")
    most = max(p.hot, every.count() // 100_000)
    hot = stored(free.groupBy("h").count().where(F.col("count") > most).select("h"), "hot_anchors")
    inner = W.partitionBy("h", "c").orderBy("doc", "t", "loc")
    # repeated rows of one document are no earlier occurrence of themselves
    facts = {"k": F.row_number().over(inner), **{x: F.first(y).over(inner) for x, y in (("d", "doc"), ("e", "t"), ("l", "loc"))}}
    # at most 100,000 anchors
    cold = free.join(F.broadcast(hot), "h", "left_anti").repartition("h").withColumns(facts).withColumn("n", F.sum((F.col("k") == 1).cast("int")).over(W.partitionBy("h")))
    crowded = stored(free.join(F.broadcast(hot), "h", "left_semi").withColumns(facts), "hot_clips")
    kinds = crowded.where("k = 1").groupBy("h").agg(F.count("*").alias("n"))
    ranked = cold.unionByName(crowded.join(F.broadcast(kinds), "h"))
    ranked = ranked.where("k > 1 or n > 1").selectExpr("if(k = 1 and n > 1, h, null) h", "doc", "t", "loc", "left", "right", "n", "k", "k > 1 and (doc <> d or t <> e or loc <> l) as done")
    settled = every.where("settled").selectExpr("cast(null as long) h", "doc", "t", "loc", "left", "right", "0L as n", "0 as k", "true as done")
    marks = stored(ranked.unionByName(settled), "marks")
    discard(every, hot, crowded)
    whole = marks.where("done").selectExpr("doc", "t", "loc - left as loc", "cast(left + right as long) as length")
    asked = marks.where("h is not null").select("h", "doc", "t", "loc", "left", "right", "n")
    bodies = stored(_cut_clips(asked, docs), "clips")
    groups = max(32, bodies.count() // p.clips)
    found = _repeats(bodies.where(F.col("n") <= p.crowd), p, groups).unionByName(_crowded(bodies.where(F.col("n") > p.crowd), p))
    found = stored(found, "repeats")
    discard(bodies)
    return whole, found


def deduplicate(docs: DataFrame, p: Params = Params(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of each row of docs with text, n_bytes, n_removed, n_spans, kept_sha256 and spans.

    Uses doc_id and text; other columns matter only where named in keep. text is what is left, without the parts of
    characters that a cut went through; the digest is of the bytes that are left. A null text counts as empty, has
    nothing removed and stays null. Repeated rows of a document are that one document; different texts under one id are
    different documents, ordered by a hash of the text; rows without an id come last, in the order of that hash. Of no
    rows, none. spans: [start, end) in bytes of the
    maximal removed runs.
    """
    whole, found = occurrences(docs, p)
    spans = whole.union(found.where("not first").select("doc", "t", "loc", "length")).distinct()
    by_doc = spans.groupBy("doc", "t").agg(F.collect_list(F.struct(F.col("loc").alias("at"), "length")).alias("items"))
    names = [f"kept_{i}" for i in range(len(keep))]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            rows = []
            for body, items in zip(part.column("body").to_pylist(), part.column("items").to_pylist(), strict=True):
                text, runs = b"" if body is None else unpack.decompress(body), []
                for at, end in sorted((x["at"], x["at"] + x["length"]) for x in items or ()):
                    if runs and at <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([at, end])
                ends = [0, *(e for _, e in runs)]
                left = b"".join(text[a:b] for a, b in zip(ends, [*(s for s, _ in runs), len(text)], strict=True))
                rows.append((None if body is None else left.decode("utf-8", "ignore"), len(text), len(text) - len(left), len(runs), hashlib.sha256(left).hexdigest(), [{"start": a, "end": b} for a, b in runs]))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.record_batch([*(part.column(n) for n in names), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=[*names, *OUT])

    joined = _packed_texts(docs, keep).join(by_doc, ["doc", "t"], "left").select(*names, "body", "items")
    types = "text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    out = joined.mapInArrow(run, ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True)), types]))
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), *OUT)


OUT = ["text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
