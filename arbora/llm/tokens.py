"""Token ids of a public byte-level vocabulary, fast enough for whole corpora.

The vocabulary's pattern never lets a token span the place before a single space, so
"a b" has the ids of "a" followed by those of " b". Ids are therefore looked up by
space-separated chunk and encoded once per distinct chunk. White space just before a
space is the one exception, and such texts are encoded as a whole.
"""

from __future__ import annotations

import base64
import functools
import zlib

import numpy as np


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """ids(text) -> uint32 array, the ids that the tokenizers library gives for the same vocabulary.

    Distinct chunks of up to about `most` bytes are remembered until forget().
    """

    def __init__(self, path: str, pattern: str, specials: dict[str, int], most: int = 6_000_000):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.specials = specials
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.widths[list(ranks.values())] = [len(x) for x in ranks]
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=specials)
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.held = 0
        self.place: dict[str, int] = {}
        self.joined = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.awkward: set[int] = set()
        self.end = 0

    def _learn(self, chunks: list[str]) -> None:
        """Encodes new chunks in one call; the bytes of the tokens tell where each chunk ends."""
        ids = np.frombuffer(self.encoding.encode_to_numpy("".join(chunks), allowed_special=set(), disallowed_special=()), np.uint32)
        ends = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum([len(c.encode()) for c in chunks])) + 1
        k, n, m = len(self.place), len(ids), len(chunks)
        while k + m > len(self.starts):
            self.starts, self.sizes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.sizes))
        while self.end + n > len(self.joined):
            self.joined = np.concatenate([self.joined, np.empty_like(self.joined)])
        self.joined[self.end : self.end + n] = ids
        self.sizes[k : k + m] = np.diff(ends, prepend=0)
        self.starts[k : k + m] = self.end + ends - self.sizes[k : k + m]
        self.place.update(zip(chunks, range(k, k + m), strict=True))
        self.awkward.update(k + i for i, c in enumerate(chunks) if c[-1].isspace())
        self.end += n
        self.held += int(self.widths[ids].sum()) + 16 * m

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode(text, allowed_special="all"), np.uint32)

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if any(s in text for s in self.specials) or text[-1] == " " or "  " in text:
            return self.whole(text)
        if self.held > self.most:
            self.forget()
        first, *rest = text.split(" ")
        chunks = [" " + c for c in rest]
        if first:
            chunks.insert(0, first)
        if new := set(chunks).difference(self.place):
            if first in new:  # without a space before it, it can only stand at the front
                new.remove(first)
                self._learn([first])
            if new:
                self._learn(list(new))
        at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        if self.awkward and not self.awkward.isdisjoint(at[:-1].tolist()):
            return self.whole(text)
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.joined[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1])]


@functools.lru_cache(1)
def byte_bpe_50k(path: str | None = None) -> ChunkEncoder:
    import public_tokenizers

    return ChunkEncoder(path or vocabulary_path(), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
