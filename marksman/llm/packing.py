"""Packing documents into training sequences by minimum bin slack.

Each task encodes its documents, cuts every document into full sequences of
``capacity`` ids and one remainder, and packs the remainders. Among the
remaining lengths it takes the multiset whose sum is closest to the capacity:
the longest remainder is fixed, then a subset-sum dynamic programme over
(length, count) runs on bitsets (bit s: a sum of s can be reached); the best
sum is traced back to the count of each length. Remainders wait in a window of
``window`` items that is refilled as bins leave it, so the choice stays wide and
memory bounded.

When the best sum leaves slack, the shortest waiting remainder that is longer
than the slack is cut to fill it. At a task's end what is left (less than one
sequence) is cut into sequences whose lengths are powers of two, which need no
padding. So no sequence is padded.

There is no shuffle: sequences hold documents of one input partition, their ids
are ``partition << 32 | number``.

Edge cases: null or empty text is just ``end_id`` (one piece); an empty table
gives no row; rows that share an id or lack one (null) are packed one by one;
other columns are ignored; a long document is cut as it comes.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from marksman.llm.common import arrow_rows, map_arrow, text_or_empty
from marksman.llm.tokens import default_vocabulary, tokenizer

CAPACITY = 1024
WINDOW = 2048

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset (length -> how many) that holds the longest length and
    whose sum is closest to ``capacity`` from below.

    Lengths are added longest first; after each, ``reach`` holds the sums that
    can be made so far. It ends early once the capacity itself can be made.
    """
    first = max(counts)
    room = capacity - first
    if room < 0:
        raise ValueError("a length is over the capacity")
    every = (1 << (room + 1)) - 1
    goal = 1 << room
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        have = min(counts[length] - (length == first), room // length)
        copies = 1  # taken in lots of 1, 2, 4, ... and the rest: any number can be made
        while have > 0 and not reach & goal:
            n = min(copies, have)
            steps.append((length, n, reach))
            reach |= (reach << (n * length)) & every
            have -= n
            copies *= 2
        if reach & goal:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = defaultdict(int)
    chosen[first] = 1
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            total -= n * length
            chosen[length] += n
    return dict(chosen)


class Packer:
    """Packs remainders of one task; ``out`` collects the finished rows."""

    def __init__(self, capacity: int = CAPACITY, window: int = WINDOW, first_sequence: int = 0):
        self.capacity, self.window, self.sequence = capacity, window, first_sequence
        self.waiting: dict[int, list[tuple]] = defaultdict(list)
        self.counts: dict[int, int] = {}
        self.n = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.out.append((doc, start, len(ids), crc, total, self.sequence, at))
            at += len(ids)
        self.sequence += 1

    def _wait(self, piece: tuple) -> None:
        k = len(piece[2])
        self.waiting[k].append(piece)
        self.counts[k] = self.counts.get(k, 0) + 1
        self.n += 1

    def _take(self, length: int) -> tuple:
        self.n -= 1
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length]
        return self.waiting[length].pop()

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        """A document's ids (at least one)."""
        c, n = self.capacity, len(ids)
        for start in range(0, n - n % c, c):
            self._emit([(doc, start, ids[start:start + c], n)])
        if n % c:
            self._wait((doc, n - n % c, ids[n - n % c:].copy(), n))
        while self.n >= self.window:
            self._bin()

    def _bin(self) -> None:
        chosen = best_fill(self.counts, self.capacity)
        pieces = [self._take(k) for k, n in chosen.items() for _ in range(n)]
        slack = self.capacity - sum(len(p[2]) for p in pieces)
        if slack and self.n:  # what still waits is longer than the slack
            doc, start, ids, total = self._take(min(self.counts))
            pieces.append((doc, start, ids[:slack], total))
            self._wait((doc, start + slack, ids[slack:], total))
            slack = 0
        if slack == 0:
            self._emit(pieces)
        else:
            self._powers(pieces)

    def _powers(self, pieces: list[tuple]) -> None:
        """An unfilled sequence as sequences of power-of-two lengths."""
        left = sum(len(p[2]) for p in pieces)
        queue = list(pieces)
        while left:
            want = 1 << (left.bit_length() - 1)
            left -= want
            own = []
            while want:
                doc, start, ids, total = queue.pop(0)
                own.append((doc, start, ids[:want], total))
                if len(ids) > want:
                    queue.insert(0, (doc, start + want, ids[want:], total))
                want -= len(own[-1][2])
            self._emit(own)

    def close(self) -> None:
        while self.n:
            self._bin()


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0,
         capacity: int = CAPACITY, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``SCHEMA``: one row per piece of a document in a sequence."""
    path = vocabulary or default_vocabulary()
    end = int(end_id).to_bytes(2, "little")

    def rows(packer: Packer) -> pa.RecordBatch:
        cols = list(zip(*packer.out, strict=True)) or [[]] * 7
        packer.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in cols],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        packer = Packer(capacity, window, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for part in arrow_rows(batch, 2048):
                for doc, raw in zip(part.column(0).to_pylist(),
                                    tok.encode(part.column(1).to_pylist()), strict=True):
                    packer.add(doc, np.frombuffer(raw + end, "<u2"))
                yield rows(packer)
        packer.close()
        yield rows(packer)

    return map_arrow(docs.select("doc_id", text_or_empty(text).alias("text")), run, SCHEMA)


__all__ = ["CAPACITY", "Packer", "best_fill", "pack"]
