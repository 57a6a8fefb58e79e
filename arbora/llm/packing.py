"""Vector bin packing of token sequences with the dot-product heuristic.

Each sequence has limits on tokens, on segments and on loss-bearing tokens. An open
sequence takes, among the pieces that fit in all three, the one with the largest
weighted dot product of its demand and the sequence's remaining room; the weights are
each dimension's share of the demand still waiting.

Work is local to a partition of the input: nothing is shuffled, and a task holds at
most `window` pieces. Only the last sequence of a partition can be part empty when
pieces may be cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from arbora.llm import tokens
from arbora.llm.text import few, tidy


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 1024
    loss_tokens: int = 2048


#: A demand that fits nowhere.
PLACED = 1e18


@dataclass
class Packer:
    """Pieces in, closed sequences out. cut: a piece may be split to fill a sequence to its last token."""

    limits: Limits
    cut: bool
    names: list = field(default_factory=list)
    demand: np.ndarray = field(default_factory=lambda: np.empty((0, 3)))

    def add(self, names: list, demand: np.ndarray) -> None:
        self.names += names
        self.demand = np.concatenate([self.demand, demand])

    def close(self, last: bool) -> Iterator[list[tuple[object, int]]]:
        """Sequences as lists of (name, tokens taken from the piece's front, or what is left of it).

        Unless last, it stops when the waiting pieces may not fill another sequence.
        """
        top = np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens], float)
        order = np.argsort(-self.demand[:, 0], kind="stable")
        names = [self.names[i] for i in order]
        want = np.ascontiguousarray((self.demand[order] / top).T)  # a row per limit; a placed piece wants too much
        rest, n_waiting = want.sum(1), len(names)
        while n_waiting and (last or rest[0] >= 2):
            room, taken = np.ones(3), []
            while n_waiting:
                weight = room * rest
                fits = (want[0] <= room[0] + 1e-12) & (want[1] <= room[1] + 1e-12) & (want[2] <= room[2] + 1e-12)
                k = int(np.argmax(np.where(fits, want[0] * weight[0] + want[1] * weight[1] + want[2] * weight[2], -1.0)))
                if fits[k]:
                    amount = want[:, k].copy()
                    want[:, k] = PLACED
                    n_waiting -= 1
                elif self.cut and (found := self._slice(want, room, top)):
                    k, part = found
                    amount = want[:, k] * part / round(want[0, k] * top[0])
                    amount[1] = 1 / top[1]
                    want[:, k] -= amount
                    want[1, k] = 1 / top[1]
                    rest[1] += 1 / top[1]
                else:
                    break
                taken.append((names[k], round(amount[0] * top[0])))
                room, rest = room - amount, np.maximum(rest - amount, 0)
            if not taken:
                raise ValueError("a piece is over the limits of an empty sequence")
            yield taken
        waiting = want[0] < PLACED
        self.names = [names[i] for i in np.flatnonzero(waiting)]
        self.demand = want[:, waiting].T * top

    @staticmethod
    def _slice(want: np.ndarray, room: np.ndarray, top: np.ndarray) -> tuple[int, int] | None:
        """The longest waiting piece and how many of its tokens still fit."""
        if room[1] * top[1] < 1 - 1e-9:
            return None
        k = int(np.argmax(np.where(want[0] < PLACED, want[0], -1)))
        share = min(room[d] / want[d, k] for d in (0, 2) if want[d, k] > 0)
        part = int(round(want[0, k] * top[0]) * share + 1e-9)
        return (k, part) if part else None


PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack_documents(docs: DataFrame, limits: Limits = Limits(), end_id: int = 1, window: int = 4096, vocabulary: str | None = None) -> DataFrame:
    """Each document's token ids and one end id, cut and packed into sequences; a row per piece.

    Uses the columns doc_id and text; others are ignored. A null or empty text is the end id alone; repeated rows are
    packed as often as they occur; no rows give no pieces. sequence_id holds the partition and the sequence's number
    there. All tokens bear loss, so limits.loss_tokens below limits.tokens shortens the sequences.
    """
    longest = min(limits.tokens, limits.loss_tokens)

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.byte_bpe_50k(vocabulary)
        packer = Packer(limits, cut=True)
        held: dict[int, list] = {}
        serial = 0
        sequence = TaskContext.get().partitionId() << 32
        out: dict[str, list] = {n: [] for n in PIECES.names}

        def put(doc, start, ids, total, at):
            for n, v in zip(PIECES.names, (doc, start, len(ids), tokens.crc(ids), total, sequence, at), strict=True):
                out[n].append(v)

        def close(last):
            nonlocal sequence
            for taken in packer.close(last):
                at = 0
                for name, n in taken:
                    doc, start, ids, total = held[name]
                    put(doc, start, ids[:n], total, at)
                    at += n
                    if n == len(ids):
                        del held[name]
                    else:
                        held[name] = [doc, start + n, ids[n:], total]
                sequence += 1

        def flush():
            yield pa.record_batch([pa.array(out[f.name], f.type) for f in PIECES], schema=PIECES)
            for v in out.values():
                v.clear()

        for part in few(parts):
            new = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids = np.append(encoder.ids(text or ""), np.uint32(end_id))
                whole = len(ids) // longest * longest
                for k in range(0, whole, longest):
                    put(doc, k, ids[k : k + longest], len(ids), 0)
                    sequence += 1
                if whole < len(ids):
                    held[serial] = [doc, whole, ids[whole:].copy(), len(ids)]
                    new.append((serial, len(ids) - whole))
                    serial += 1
                if len(new) + len(packer.names) >= window:
                    packer.add([n for n, _ in new], np.array([[n, 1, n] for _, n in new], float))
                    new = []
                    close(False)
                if len(out["start"]) >= 8192:
                    yield from flush()
            if new:
                packer.add([n for n, _ in new], np.array([[n, 1, n] for _, n in new], float))
            yield from flush()
        close(True)
        yield from flush()
        encoder.forget()

    return docs.select("doc_id", "text").mapInArrow(tidy(pack), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


EXAMPLES = "example_id long, sequence_id long, offset long, tokens long, loss_tokens long"


def pack_examples(examples: DataFrame, limits: Limits = Limits(), window: int = 4096) -> DataFrame:
    """Instruction examples (example_id, tokens, loss_tokens), never cut, under all three limits at once.

    A null count is 0; an example of no tokens takes a segment; one over a limit by itself raises.
    """

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sequence, facts, serial = Packer(limits, cut=False), TaskContext.get().partitionId() << 32, {}, 0

        def close(last):
            nonlocal sequence
            rows = []
            for taken in packer.close(last):
                at = 0
                for name, n in taken:
                    example, loss = facts.pop(name)
                    rows.append((example, sequence, at, n, loss))
                    at += n
                sequence += 1
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5, names=["example_id", "sequence_id", "offset", "tokens", "loss_tokens"])

        for part in parts:
            for at in range(0, part.num_rows, window):
                few = part.slice(at, window).to_pydict()
                n, loss = ([x or 0 for x in few[c]] for c in ("tokens", "loss_tokens"))
                names = list(range(serial, serial + len(n)))
                serial += len(n)
                facts |= dict(zip(names, zip(few["example_id"], loss, strict=True), strict=True))
                packer.add(names, np.array([[a, 1, b] for a, b in zip(n, loss, strict=True)], float).reshape(-1, 3))
                yield from close(False)
        yield from close(True)

    return examples.selectExpr("cast(example_id as long) example_id", "cast(tokens as long) tokens", "cast(loss_tokens as long) loss_tokens").mapInArrow(pack, EXAMPLES)
