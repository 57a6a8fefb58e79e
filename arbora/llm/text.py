"""Words, folds and hashes that several operators share.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, which is what bytes.split() yields.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0).cast("long"))


def word_array(text: Column) -> Column:
    """The words of a text as an array; of a null text, an empty one."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACES)).otherwise(F.array().cast("array<string>"))


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def split_words(column: pa.Array, folded: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, each word's place among them, words of each row) of a string column; null has none.

    folded: A-Z become lower case.
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "").take(pa.array(np.arange(len(column))))  # Arrow splits no slice right
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if folded else texts)
    flat = lists.flatten().dictionary_encode()
    words, index, ends = flat.dictionary, flat.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    empty = pc.index(words, "").as_py()  # a text that begins or ends with a space has empty words there
    if empty >= 0:
        full = index != empty
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
        words, index = words.filter(pc.not_equal(words, "")), index[full]
        index = index - (index > empty)
    return words.cast(pa.large_binary()), index, np.diff(ends)


def spans(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each word begins, its size, bytes) of an array of bytes."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    offsets, data = (np.frombuffer(b or b"", kind) for b, kind in zip(words.buffers()[1:], (np.int64, np.uint8), strict=True))
    begin = offsets[words.offset : words.offset + len(words)]
    return begin, offsets[words.offset + 1 : words.offset + len(words) + 1] - begin, data


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, eight bytes of all words at a time."""
    if not len(words):
        return np.empty(0, np.uint64)
    begin, size, data = spans(words)
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    out, at, done = mix(size.astype(np.uint64) + np.uint64(1)), np.arange(len(words)), 0
    while len(at := at[size[at] > done]):
        eight = data[(begin[at] + done)[:, None] + np.arange(8)].view("<u8")[:, 0]
        beyond = np.maximum(done + 8 - size[at], 0).astype(np.uint64) * np.uint64(8)
        out[at] = mix(out[at] * np.uint64(0x9E3779B97F4A7C15) + (eight << beyond))
        done += 8
    return out


def few(parts: Iterator[pa.RecordBatch], size: int = 4_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have about `size` bytes at most; a longer text stands alone."""
    for part in parts:
        ends = np.cumsum(pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < part.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield part.slice(at, end - at)
            at = end


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on from task to task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A mapInArrow function that gives its memory back when a partition ends."""

    def wrapped(parts):
        try:
            yield from run(parts)
        finally:
            give_back()

    return wrapped


def tidy_group(run):
    """An applyInArrow function of a group that gives its memory back after each."""

    def wrapped(key, table):
        try:
            return run(key, table)
        finally:
            give_back()

    return wrapped


def tidy_groups(run):
    """The same of two groups of one key."""

    def wrapped(key, left, right):
        try:
            return run(key, left, right)
        finally:
            give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def batches(schema: pa.Schema, columns: dict, most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Columns of equal length as Arrow batches of at most `most` rows."""
    table = pa.table([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
    yield from table.to_batches(max_chunksize=most)
