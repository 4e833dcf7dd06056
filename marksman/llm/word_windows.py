"""Removal of repeated runs of words, by level-wise doubling.

A *window* is ``length`` = 4 * b consecutive words of one document. A word goes if a
window that covers it has the same words as one that starts earlier: in a document
that comes before (by ``doc_id``) or earlier in the same one. Windows are judged on
the input.

Levels: windows of b words, of 2b, of 4b. Only what is repeated at one length is
extended to twice that length.

1. *b words.* Of each window's (4b words) short windows the one with the least hash,
   the leftmost of equals, is its anchor. Equal windows have equal anchors at equal
   places, so of all short windows only the anchors, about one word in eight, need
   counting. Neighbouring windows with one anchor form a *run*; the words that its
   windows cover are its *context*. Runs whose anchor occurs once end here.
2. Runs with equal contexts form a *group* (counted in each task before the shuffle,
   so a group of copies moves little). All but the first run of a group are repeated
   as a whole; the first one stands for the group from here on.
3. *2b words.* An anchor is extended to the right and to the left. A window of 4b
   words holds at least one of the two extensions; windows that hold one which no
   other group has end here.
4. *4b words.* The windows that survived are hashed (128 bits); of equal ones all but
   the first are repeated.
5. Spans are joined back to their documents and their words are cut out. Greater
   lengths are made of repeated windows of 4b words and would cover no further word.

A word's hash is xxh3; the hash of a longer window mixes those of its halves, so
nothing of it is linear in the words. Hot anchors, extensions and windows are joined
apart, against a broadcast side of a proven size (``joined_by_size``).

Edge cases: null text has no words; texts shorter than a window lose nothing; an
empty table gives no row; documents that share a ``doc_id`` come in the order of their
places in the files, those without one first; repeated rows are documents of their
own; other columns stay, whatever their names (``__file`` and ``__row`` are reserved);
very long texts are processed whole, in pieces of ``PIECE`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marksman.llm.common import arrow_rows, discard, joined_by_size, map_arrow, text_or_empty, written
from marksman.llm.exact_dedup import located
from marksman.llm.suffix_dedup import _window_least, mixed
from marksman.plans.sizing import DEFAULT_BROADCAST_MAX_ROWS

LENGTH = 20
PIECE = 1 << 18
_WORDS = 1 << 20  # word hashes a task keeps
_PLACE_BITS = 20

RUNS = "doc_id long, fid long, row long, at int, windows int, off int, a long, c long, l long, r long"
_DOC = ["doc_id", "fid", "row"]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, 12)
        return h


def paired(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Hash of two halves, in order."""
    return mixed(a + mixed(b ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1)))


def levels(h: np.ndarray, base: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``base`` words, twice and four times as many."""
    short = h
    for i in range(1, base):
        short = paired(short[:len(h) - i], h[i:], seed)
    double = paired(short[:-base], short[base:], seed)
    return short, double, paired(double[:-2 * base], double[2 * base:], seed)


def find_runs(h: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that begin at ``starts`` (ascending) of the word hashes ``h``:
    (first window, windows, anchor's offset from it, anchor, context, left and
    right extension, and whether there are windows that hold each)."""
    base = length // 4
    short, double, whole = levels(h, base)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keyed = (short & ~low) | np.arange(len(short), dtype=np.uint64)
    anchor = (_window_least(keyed, length - base + 1)[starts] & low).astype(np.int64)
    first = np.ones(len(starts), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(first)
    windows = np.diff(np.append(at, len(starts)))
    begin, anchor = starts[at], anchor[at]
    off = anchor - begin
    nth = np.arange(len(starts)) - np.repeat(at, windows)
    context = np.add.reduceat(mixed(whole[starts] ^ mixed((nth + 1).astype(np.uint64))), at)
    has_left, has_right = off >= base, off - (windows - 1) <= 2 * base
    left = double[np.where(has_left, anchor - base, 0)]
    right = double[np.where(has_right, anchor, 0)]
    return begin, windows, off, short[anchor], context, left, right, has_left, has_right


def _slices(batches: Iterator[pa.RecordBatch], text: int, length: int) -> Iterator[tuple]:
    """(rows, words' hashes, pieces' begins and ends) of some documents at a time:
    texts longer than a piece come in pieces that share length - 1 words. A piece
    is (row in the slice, its first word's number)."""
    known = _WordHashes()
    for batch in batches:
        for part in arrow_rows(batch, 256):
            held, of, n = [], [], 0
            for i, raw in enumerate(part.column(text).cast(pa.binary())):
                words = raw.as_py().split()
                for at in range(0, len(words) - length + 1, PIECE):
                    piece = words[at:at + PIECE + length - 1]
                    if n and n + len(piece) > PIECE:
                        yield part, *_hashed(held, known), of
                        held, of, n = [], [], 0
                    held.append(piece)
                    of.append((i, at))
                    n += len(piece)
            if held:
                yield part, *_hashed(held, known), of


def _hashed(pieces: list[list[bytes]], known: _WordHashes) -> tuple[np.ndarray, np.ndarray]:
    n = sum(map(len, pieces))
    h = np.fromiter((known[w] for words in pieces for w in words), np.uint64, n)
    return h, np.array([len(p) for p in pieces], np.int64)


def _window_starts(size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows within pieces that stand one after another, the piece
    of each, and where the pieces begin."""
    begin = np.cumsum(size) - size
    n = size - length + 1
    piece = np.repeat(np.arange(len(size)), n)
    starts = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n) + begin[piece]
    return starts, piece, begin


def runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``RUNS`` of (doc_id, fid, row, text); an extension that none of a run's
    windows holds is null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, h, size, of in _slices(batches, 3, length):
            starts, _, begins = _window_starts(size, length)
            begin, windows, off, a, c, left, right, has_left, has_right = find_runs(h, starts, length)
            piece = np.searchsorted(begins, begin, side="right") - 1
            doc = pa.array(np.array([i for i, _ in of])[piece])
            at = begin - begins[piece] + np.array([p for _, p in of])[piece]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k).take(doc) for k in range(3)), pa.array(at.astype(np.int32)),
                 pa.array(windows.astype(np.int32)), pa.array(off.astype(np.int32)),
                 pa.array(a.view(np.int64)), pa.array(c.view(np.int64)),
                 pa.array(left.view(np.int64), mask=~has_left),
                 pa.array(right.view(np.int64), mask=~has_right)],
                [*_DOC, "at", "windows", "off", "a", "c", "l", "r"])

    return map_arrow(docs.select(*_DOC, "text"), run, RUNS)


def window_hashes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, fid, row, at, w1, w2) of the windows that ``wanted`` names, of
    (doc_id, fid, row, text, wanted: array of (low, high) window numbers)."""
    out = ("doc_id long, fid long, row long, at int, w1 long, w2 long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, h, size, of in _slices(batches, 3, length):
            starts, piece, begins = _window_starts(size, length)
            row = np.array([i for i, _ in of])[piece]
            at = starts - begins[piece] + np.array([p for _, p in of])[piece]
            wanted = part.column(4)
            take = np.zeros(len(starts), bool)
            cuts = np.append(np.flatnonzero(np.append(True, piece[1:] != piece[:-1])), len(piece))
            for b, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                spans = wanted[int(row[b])].values
                lo, hi = (spans.field(k).to_numpy() for k in (0, 1))
                n = e - b
                edge = np.zeros(n + 1, np.int64)
                first = int(at[b])
                np.add.at(edge, np.clip(lo - first, 0, n), 1)
                np.add.at(edge, np.clip(hi - first, 0, n), -1)
                take[b:e] = np.cumsum(edge[:n]) > 0
            k = np.flatnonzero(take)
            w1, w2 = (levels(h, length // 4, seed)[2][starts[k]] for seed in (1, 2))
            doc = pa.array(row[k])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(doc) for c in range(3)), pa.array(at[k].astype(np.int32)),
                 pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64))], [*_DOC, "at", "w1", "w2"])

    return map_arrow(docs.select(*_DOC, "text", "wanted"), run, out)


# ---------------------------------------------------------------- operator

def _order() -> Column:
    """A document's place in the order (null ids first)."""
    return F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "fid", "row", "at")


def _surviving(groups: DataFrame, base: int) -> DataFrame:
    """(doc_id, fid, row, low, high): the windows of every group's first run whose
    extensions other groups have, too."""
    rows = groups.withColumn("g", F.xxhash64("a", "c", "windows", "off"))
    halves = rows.select("g", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("l").alias("h")),
        F.struct(F.lit(1).alias("side"), F.col("r").alias("h")))).alias("e")).select(
        "g", "e.*").filter("h is not null")
    several = written(halves.groupBy("side", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"),
                      "windows-doubled")
    found = joined_by_size(halves, several, ["side", "h"]).groupBy("g").agg(
        F.max(F.col("side") == 0).alias("left"), F.max(F.col("side") == 1).alias("right"))
    rows = rows.join(found, "g")
    low = F.when(F.col("left"), 0).otherwise(F.greatest(F.col("off") - base + 1, F.lit(0)))
    high = F.when(F.col("right"), F.col("windows")).otherwise(
        F.least(F.col("off") - 2 * base, F.col("windows")))
    return (rows.withColumn("low", low).withColumn("high", high).filter("low < high")
            .select("first.doc_id", "first.fid", "first.row",
                    (F.col("first.at") + F.col("low")).alias("low"),
                    (F.col("first.at") + F.col("high")).alias("high")))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(fid, row, start, end): spans of words, covered by windows that occur earlier,
    of (doc_id, fid, row, text). Spans may overlap."""
    if length % 4:
        raise ValueError("the length must be a multiple of 4")
    base = length // 4
    found = written(runs(docs, length), "windows-runs")
    anchors = found.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    every, found = found, written(
        joined_by_size(found, written(anchors, "windows-anchors"), ["a"],
                       max_rows=DEFAULT_BROADCAST_MAX_ROWS).drop("n"), "windows-repeated")
    discard(every)
    key = ["a", "c", "windows", "off"]
    groups = written(found.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.min(_order()).alias("first"), F.first("l").alias("l"),
        F.first("r").alias("r")), "windows-groups")
    copies = joined_by_size(found, groups.filter("n > 1").select(*key, "n", "first"), key)
    whole = copies.filter(_order() != F.col("first")).select(
        "fid", "row", F.col("at").alias("start"),
        (F.col("at") + F.col("windows") - 1 + length).alias("end"))
    wanted = _surviving(groups, base).groupBy("fid", "row").agg(
        F.collect_list(F.struct("low", "high")).alias("wanted"))
    wanted = written(wanted, "windows-wanted")
    held = docs.join(wanted, ["fid", "row"]).select(*_DOC, "text", "wanted")
    windows = written(window_hashes(held, length), "windows-hashed")
    same = windows.groupBy("w1", "w2").agg(
        F.count(F.lit(1)).alias("n"), F.min(_order()).alias("first")).filter("n > 1")
    later = joined_by_size(windows, written(same, "windows-same"), ["w1", "w2"]).filter(
        _order() != F.col("first"))
    return whole.unionByName(later.select("fid", "row", F.col("at").alias("start"),
                                          (F.col("at") + length).alias("end")))


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``docs`` with ``__kept`` (the words left, joined by one space), ``__n_words``
    and ``__n_removed``."""
    columns = docs.columns
    keyed = located(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("__file").alias("fid"),
        F.col("__row").alias("row"), text_or_empty(text).alias("text"),
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)])
    spans = repeated_spans(keyed.select(*_DOC, "text"), length)
    spans = written(spans.groupBy("fid", "row").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")), "windows-spans")

    out = pa.schema([("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])
    rows = keyed.join(spans, ["fid", "row"], "left").select(
        "text", "spans", *[f"__c{i}" for i in range(len(columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_rows(batch, 256):
                done = [_cut(raw.as_py().split(), spans) for raw, spans in zip(
                    part.column(0).cast(pa.binary()), part.column(1), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[2:], *(pa.array([d[k] for d in done], t.type)
                                          for k, t in enumerate(out))],
                    [*part.schema.names[2:], "__kept", "__n_words", "__n_removed"])

    fields = ", ".join(f"`__c{i}` {docs.schema[c].dataType.simpleString()}"
                       for i, c in enumerate(columns))
    done = map_arrow(rows, run, f"{fields}, `__kept` string, `__n_words` long, `__n_removed` long")
    return done.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)],
                       "__kept", "__n_words", "__n_removed")


def _cut(words: list[bytes], spans: pa.ListScalar) -> tuple[str, int, int]:
    """(words left, joined by spaces; words; words that went)."""
    if not spans.is_valid:
        return b" ".join(words).decode(), len(words), 0
    lo, hi = (spans.values.field(k).to_numpy() for k in (0, 1))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi, -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()]).decode(), len(words), len(words) - len(kept)


__all__ = ["LENGTH", "find_runs", "levels", "repeated_spans", "runs", "window_hashes",
           "without_repeats"]
