"""Removal of long byte strings that occur more than once, by suffix arrays.

A *window* is a run of ``length`` bytes of one text. Every byte covered by a
window that also starts anywhere else, in any text, is removed. Windows are
judged on the input.

1. *Anchors.* In every window the ``GRAM``-byte string with the least hash (the
   leftmost of equals) is its anchor. Equal windows have equal anchors at equal
   places, so windows need comparing only with those of the same anchor.
   Neighbouring windows with one anchor form a *run*; a run's *context* is all
   the bytes its windows cover. About two anchors fall on ``length`` bytes.
2. Anchors that occur once are dropped. Of runs with equal contexts one is kept
   with their number (counted in each task before the shuffle, so a group of
   copies moves little); if there are several, all their windows are repeated.
3. *Suffix arrays.* Contexts go to shards by anchor. Stretches of windows whose
   hash no other window of the shard has are left out, of equal stretches one
   is kept; then the shard sorts the suffixes (Larsson-Sadakane), and Kasai's
   common prefixes tell which windows occur twice.
4. *Cross-shard merge.* An anchor with more than ``SHARD_CONTEXTS`` different
   contexts is split over several shards. These send the digests of their
   distinct windows as sorted runs, cut by digest into buckets; each bucket is
   merged by binary search of every run in the merged order. Digests have 128
   bits.
5. Spans are joined back to their documents, merged and cut out.

With ``first`` the first document that has a window keeps it (all its places), and
what one document repeats in itself does not count: of equal contexts those of
later documents go as a whole, in a shard all windows that an earlier document of
it has, and of split anchors those of which another shard has an earlier one.

Documents are identified by the file and row they come from. All texts are read
whole; a text is processed in pieces of ``PIECE`` window starts. ``repeated_spans``
also serves streams of codes of ``unit`` bytes (windows then start at whole codes)
and can ask for repetition in another document (``apart``).

Edge cases: null text is the empty text; texts shorter than a window lose
nothing; an empty table gives no row; repeated rows are documents of their own,
so their texts, if long enough, are repeated; other columns stay, whatever their
names (``__file`` and ``__row`` are reserved).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marksman.llm.common import arrow_rows, hot_keys, joined, let, map_arrow, text_or_empty, written
from marksman.llm.exact_dedup import located
from marksman.llm.suffix_array import common_prefixes, first_eight, suffix_array
from marksman.plans.sizing import broadcast_if_small

LENGTH = 400
GRAM = 32
PIECE = 1 << 16
SHARD_BYTES = 1 << 18
SHARD_CONTEXTS = 1024
_PLACE_BITS = 24  # a place in a chunk of up to 2 * PIECE bytes

RUNS = "fid long, row long, place long, windows int, off int, a long, c long"
SPANS = "fid long, row long, start long, end long"
SHARD_OUT = (SPANS + ", a long, bucket int, d1 binary, d2 binary, fids binary, rows binary, "
             "places binary")


_PRIME = np.uint64((1 << 61) - 1)
_LOW32, _LOW29 = np.uint64((1 << 32) - 1), np.uint64((1 << 29) - 1)
_29, _32, _61 = np.uint64(29), np.uint64(32), np.uint64(61)


def _folded(x: np.ndarray) -> np.ndarray:
    """``x`` modulo 2^61 - 1, but for a few ones above it."""
    return (x & _PRIME) + (x >> _61)


def _canonical(x: np.ndarray) -> np.ndarray:
    x = _folded(x)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _up32(x: np.ndarray) -> np.ndarray:
    """``x`` (below 2^63) times 2^32 modulo 2^61 - 1, folded."""
    return (x >> _29) + ((x & _LOW29) << _32)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo 2^61 - 1 of numbers below that."""
    ah, al, bh, bl = a >> _32, a & _LOW32, b >> _32, b & _LOW32
    middle = _up32(ah * bl + al * bh)
    return _canonical(_folded(al * bl) + _folded(middle) + ((ah * bh) << np.uint64(3)))


class Hashes:
    """Random tables and multipliers for the rolling hashes (fixed by a seed).
    Spans are hashed by a polynomial modulo a prime: modulo a power of two some
    texts (Thue-Morse words) collide whatever the base."""

    def __init__(self, seed: int = 20):
        rng = np.random.default_rng(seed)

        def odd(n: int) -> np.ndarray:
            return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

        self.tables = [odd(256), *(rng.integers(1, 1 << 32, 256, dtype=np.uint64) for _ in range(2))]
        self.steps = odd(5)
        self.salt = odd(1)[0]
        self.bases = rng.integers(1 << 60, (1 << 61) - 1, 2, dtype=np.uint64)
        self.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * 2

    def grams(self, data: np.ndarray) -> np.ndarray:
        """Hash of the ``GRAM`` (2^5) bytes from every place on."""
        h = self.tables[0][data]
        for k, c in enumerate(self.steps):
            m = 1 << k
            h = h[:-m] * c + h[m:]
        return mixed(h)

    def _powers(self, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of a base and of its inverse, at least ``n`` of them."""
        while len(self.powers[k][0]) < n:
            have, prime = len(self.powers[k][0]), (1 << 61) - 1
            base = int(self.bases[k])
            self.powers[k] = tuple(
                np.append(p, product(p, np.uint64(pow(b, have, prime))))
                for p, b in zip(self.powers[k], (base, pow(base, -1, prime)), strict=True))
        return self.powers[k]

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray,
              k: int = 0) -> np.ndarray:
        """Hash of the bytes [start, end) for many spans."""
        n = len(data)
        up, down = self._powers(n + 1, k)
        value = self.tables[1 + k][data]
        each = _folded(_folded(value * (up[:n] & _LOW32)) + _up32(value * (up[:n] >> _32)))
        low, high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(each & _LOW32, out=low[1:])
        np.cumsum(each >> _32, out=high[1:])
        total = _canonical(_folded(low[end] - low[start]) + _folded(_up32(high[end] - high[start])))
        return mixed(product(total, down[start]))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from every place on: prefix and suffix
    minima within blocks of that width."""
    n = len(values)
    blocks = -(-n // width)
    v = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    v[:n] = values
    v = v.reshape(blocks, width)
    before = np.minimum.accumulate(v, axis=1).reshape(-1)
    after = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def find_runs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int,
              hashes: Hashes, unit: int = 1) -> tuple[np.ndarray, ...]:
    """Runs in the pieces [begins, ends) of ``data``: (piece, first window's
    place in the data, windows, anchor's offset from it, anchor, context)."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return (none,) * 4 + (none.astype(np.uint64),) * 2
    gram = hashes.grams(data)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keyed = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    anchor = (_window_least(keyed, length - GRAM + 1) & low).astype(np.int64)
    # window starts inside a piece
    edge = np.zeros(len(anchor) + 1, np.int32)
    fits = ends - begins >= length
    np.add.at(edge, begins[fits], 1)
    np.add.at(edge, ends[fits] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(edge[:-1]))
    if unit > 1:
        own = begins[np.searchsorted(begins, starts, side="right") - 1]
        starts = starts[(starts - own) % unit == 0]
    if not len(starts):
        return (none,) * 4 + (none.astype(np.uint64),) * 2
    a = anchor[starts]
    first = np.ones(len(starts), bool)
    first[1:] = (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + unit)
    at = np.flatnonzero(first)
    place = starts[at]
    windows = np.diff(np.append(at, len(starts)))
    off = a[at] - place
    context = hashes.spans(data, place, place + (windows - 1) * unit + length)
    context = mixed(context + (off * 65536 + windows).astype(np.uint64) * hashes.salt)
    piece = np.searchsorted(begins, place, side="right") - 1
    return piece, place, windows, off, gram[a[at]], context


def _texts(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    col = batch.column(column).cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def _pieces(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (row, begin, end) of bytes, together at most about ``PIECE``."""
    held: list[tuple[int, int, int]] = []
    size = 0
    for row, (b, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for at in range(b, e - length + 1, PIECE):
            piece = (row, at, min(e, at + PIECE + length - 1))
            if held and size + piece[2] - piece[1] > PIECE:
                yield held
                held, size = [], 0
            held.append(piece)
            size += piece[2] - piece[1]
    if held:
        yield held


def runs(docs: DataFrame, length: int = LENGTH, unit: int = 1) -> DataFrame:
    """``RUNS`` of (fid, row, data)."""
    if length < GRAM:
        raise ValueError(f"windows of fewer than {GRAM} bytes have no anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            fid, row = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, offsets = _texts(batch, 2)
            for pieces in _pieces(offsets, length):
                of = np.array([p[0] for p in pieces])
                begin = np.array([p[1] for p in pieces])
                size = np.array([p[2] for p in pieces]) - begin
                own_end = np.cumsum(size)
                own_begin = own_end - size
                part = np.concatenate([data[b:b + n] for b, n in
                                       zip(begin.tolist(), size.tolist(), strict=True)])
                piece, place, windows, off, a, c = find_runs(part, own_begin, own_end, length,
                                                             hashes, unit)
                doc = of[piece]
                in_text = place - own_begin[piece] + begin[piece] - offsets[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fid[doc]), pa.array(row[doc]), pa.array(in_text),
                     pa.array(windows.astype(np.int32)), pa.array(off.astype(np.int32)),
                     pa.array(a.view(np.int64)), pa.array(c.view(np.int64))],
                    ["fid", "row", "place", "windows", "off", "a", "c"])

    return map_arrow(docs.select("fid", "row", "data"), run, RUNS)


# ------------------------------------------------------------ suffix arrays

def repeated_windows(data: np.ndarray, begins: np.ndarray, windows: np.ndarray, length: int,
                     unit: int = 1, owner: np.ndarray | None = None,
                     later: bool = False) -> np.ndarray:
    """For every window of every context (begins, number of windows), in that
    order: does it occur at another window start of these contexts (one whose
    context has another owner, if owners are given; a smaller one, if ``later``)?"""
    words = first_eight(data)
    sa = suffix_array(data, length, words)
    shared = common_prefixes(data, sa, length, words) >= length
    starts = _starts(begins, windows, unit)
    window_at = np.full(len(data), -1, np.int64)
    window_at[starts] = np.arange(len(starts))
    # suffixes with the same first bytes: a group; windows of it at window starts
    group = np.cumsum(~shared)
    window = window_at[sa]
    ours = window >= 0
    group, window = group[ours], window[ours]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(first, len(group)))
    if owner is None:
        enough = np.repeat(size > 1, size)
    else:
        of = np.repeat(owner, windows)[window]
        least = np.minimum.reduceat(of, first)
        if later:
            enough = of > np.repeat(least, size)
        else:
            enough = np.repeat(least != np.maximum.reduceat(of, first), size)
    many = np.zeros(len(starts), bool)
    many[window] = enough
    return many


def later_windows(data: np.ndarray, begins: np.ndarray, windows: np.ndarray, owner: np.ndarray,
                  length: int, hashes: Hashes) -> np.ndarray:
    """For every window: does a context of a smaller owner have it, too? Only
    stretches of windows that share a hash with another owner's go into the
    suffix array."""
    starts = _starts(begins, windows)
    context = np.repeat(np.arange(len(begins)), windows)
    of = owner[context]
    digest = hashes.spans(data, starts, starts + length)
    order = np.argsort(digest, kind="stable")
    new = np.flatnonzero(np.append(True, np.diff(digest[order]) != 0))
    apart = np.minimum.reduceat(of[order], new) != np.maximum.reduceat(of[order], new)
    shared = np.empty(len(starts), bool)
    shared[order] = np.repeat(apart, np.diff(np.append(new, len(order))))
    first = shared.copy()
    first[1:] &= ~shared[:-1] | (context[1:] != context[:-1])
    at = np.flatnonzero(first)
    if not len(at):
        return shared
    n = np.bincount(np.cumsum(first)[shared] - 1, minlength=len(at))
    begin = starts[at]
    size = n + length  # one byte between two stretches
    own = np.cumsum(size) - size
    part = np.zeros(int(size.sum()), np.uint8)
    for b, k, o in zip(begin.tolist(), size.tolist(), own.tolist(), strict=True):
        part[o:o + k - 1] = data[b:b + k - 1]
    shared[shared] = repeated_windows(part, own, n, length, 1, of[at], True)
    return shared


def shard_windows(data: np.ndarray, begins: np.ndarray, windows: np.ndarray, times: np.ndarray,
                  length: int, hashes: Hashes) -> np.ndarray:
    """``repeated_windows`` of contexts found ``times`` times (all windows of
    one found several times are repeated). Only stretches of windows that share
    a hash with another window go into the suffix array, equal ones once."""
    starts = _starts(begins, windows)
    context = np.repeat(np.arange(len(begins)), windows)
    many = times[context] > 1
    digest = hashes.spans(data, starts, starts + length)
    _, of, size = np.unique(digest, return_inverse=True, return_counts=True)
    shared = (size[of] > 1) | many
    first = shared.copy()
    first[1:] &= ~shared[:-1] | (context[1:] != context[:-1])
    at = np.flatnonzero(first)
    if not len(at):
        return many
    stretch = np.cumsum(first) - 1
    n = np.bincount(stretch[shared], minlength=len(at))
    begin = starts[at]
    end = begin + n + length - 1
    key = mixed(hashes.spans(data, begin, end) ^ mixed(n.astype(np.uint64)))
    other = hashes.spans(data, begin, end, 1)
    order = np.lexsort((other, key))
    new = np.append(True, (np.diff(key[order]) != 0) | (np.diff(other[order]) != 0))
    kind = np.empty(len(at), np.int64)
    kind[order] = np.cumsum(new) - 1
    one = order[new]  # of each kind of stretch the one that is kept
    often = np.bincount(kind) > 1
    sizes = end[one] - begin[one] + 1
    own = np.cumsum(sizes) - sizes
    part = np.zeros(int(sizes.sum()), np.uint8)
    for b, e, o in zip(begin[one].tolist(), end[one].tolist(), own.tolist(), strict=True):
        part[o:o + e - b] = data[b:e]
    found = repeated_windows(part, own, n[one], length) | np.repeat(often, n[one])
    # back from kinds to stretches to windows
    from_kind = np.cumsum(n[one]) - n[one]
    inner = np.flatnonzero(shared)
    place = inner - at[stretch[inner]]
    many[inner] |= found[from_kind[kind[stretch[inner]]] + place]
    return many


def _starts(begins: np.ndarray, windows: np.ndarray, unit: int = 1) -> np.ndarray:
    place = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    return np.repeat(begins, windows) + place * unit


def _covered(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans covered by windows at the sorted ``starts``."""
    if not len(starts):
        return starts, starts
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > starts[:-1] + length
    at = np.flatnonzero(first)
    return starts[at], np.append(starts[at[1:] - 1], starts[-1]) + length


class _Shard:
    """Contexts gathered for one suffix array."""

    def __init__(self, length: int, hashes: Hashes, unit: int, apart: bool, first: bool):
        self.length, self.hashes, self.unit = length, hashes, unit
        self.apart, self.first = apart, first
        self.rows: list[dict] = []
        self.size = 0

    def add(self, row: dict) -> None:
        self.rows.append(row)
        self.size += len(row["bytes"]) + 1

    def close(self) -> list[dict]:
        """Result rows: spans, and sorted runs of an anchor that is split."""
        rows, self.rows, self.size = self.rows, [], 0
        if not rows:
            return []
        data = np.frombuffer(b"\0".join(r["bytes"] for r in rows), np.uint8)
        sizes = np.array([len(r["bytes"]) for r in rows])
        begins = np.cumsum(sizes + 1) - sizes - 1
        windows = np.array([r["windows"] for r in rows])
        if self.first:
            docs = [(r["fid"], r["row"]) for r in rows]
            rank = {d: i for i, d in enumerate(sorted(set(docs)))}
            owner = np.array([rank[d] for d in docs])
            many = later_windows(data, begins, windows, owner, self.length, self.hashes)
        elif not self.apart:
            times = np.array([r["n"] for r in rows])
            many = shard_windows(data, begins, windows, times, self.length, self.hashes)
        else:  # a context found in several documents is of none
            docs = {}
            owner = np.array([docs.setdefault((r["fid"], r["row"]), len(docs)) if r["n"] == 1
                              else -1 - i for i, r in enumerate(rows)])
            many = repeated_windows(data, begins, windows, self.length, self.unit, owner)
        ends = np.cumsum(windows)
        out = []
        for r, e, k in zip(rows, ends.tolist(), windows.tolist(), strict=True):
            if r["n"] > 1:
                continue  # its runs are repeated as a whole
            at = np.flatnonzero(many[e - k:e]) * self.unit
            for s, t in zip(*_covered(at, self.length), strict=True):
                out.append({"fid": r["fid"], "row": r["row"], "start": r["place"] + int(s),
                            "end": r["place"] + int(t)})
        if rows[0]["splits"] > 1:  # then all are of one anchor
            out += self._sorted_runs(rows, data, begins, windows, many)
        return out

    def _sorted_runs(self, rows, data, begins, windows, many) -> list[dict]:
        starts = _starts(begins, windows, self.unit)
        d1, d2 = (self.hashes.spans(data, starts, starts + self.length, k) for k in (0, 1))
        context = np.repeat(np.arange(len(rows)), windows)
        fid, row, place, n = (np.array([r[k] for r in rows], np.int64)
                              for k in ("fid", "row", "place", "n"))
        place = place[context] + starts - begins[context]
        # -1: occurs twice already, only other shards want to know of it
        place = np.where(many | (n[context] > 1), -1, place)
        order = np.lexsort((d2, d1))
        if self.first:  # all places of the windows' first documents here
            order = order[~many[order]]
        else:
            order = order[np.append(True, (np.diff(d1[order]) != 0) | (np.diff(d2[order]) != 0))]
        buckets = rows[0]["splits"]
        bucket = (d1[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        out = []
        for b in range(buckets):
            own = order[cuts[b]:cuts[b + 1]]
            if len(own):
                out.append({"a": rows[0]["a"], "bucket": b, "d1": d1[own].tobytes(),
                            "d2": d2[own].tobytes(), "fids": fid[context[own]].tobytes(),
                            "rows": row[context[own]].tobytes(), "places": place[own].tobytes()})
        return out


_SHARD_ARROW = pa.schema([
    ("fid", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
    ("a", pa.int64()), ("bucket", pa.int32()), ("d1", pa.binary()), ("d2", pa.binary()),
    ("fids", pa.binary()), ("rows", pa.binary()), ("places", pa.binary())])
_SPAN_ARROW = pa.schema(list(_SHARD_ARROW)[:4])


def shard_spans(contexts: DataFrame, length: int = LENGTH, unit: int = 1,
                apart: bool = False, first: bool = False) -> DataFrame:
    """``SHARD_OUT`` of contexts (a, part, splits, n, windows, fid, row, place,
    bytes): one suffix array for several anchors or for a part of one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, key = _Shard(length, Hashes(), unit, apart, first), None
        for batch in batches:
            for row in (r for part in arrow_rows(batch, 512) for r in part.to_pylist()):
                own = (row["a"], row["part"])
                alone = row["splits"] > 1 or (shard.rows and shard.rows[0]["splits"] > 1)
                if own != key and (alone or shard.size >= SHARD_BYTES):
                    if found := shard.close():
                        yield pa.RecordBatch.from_pylist(found, _SHARD_ARROW)
                key = own
                shard.add(row)
        if found := shard.close():
            yield pa.RecordBatch.from_pylist(found, _SHARD_ARROW)

    ordered = contexts.repartition("a", "part").sortWithinPartitions("a", "part")
    return map_arrow(ordered, run, SHARD_OUT)


def merge_runs(parts: list[dict], length: int, first: bool = False) -> list[dict]:
    """Spans of windows that occur in two of these sorted runs (one bucket of
    one anchor; each run is distinct). ``first``: that occur in one of a
    smaller document (each run has those of its first documents)."""
    arrays = [{k: np.frombuffer(p[k], np.uint64 if k in ("d1", "d2") else np.int64)
               for k in ("d1", "d2", "fids", "rows", "places")} for p in parts]
    d1, d2, fid, row = (np.concatenate([x[k] for x in arrays]) for k in ("d1", "d2", "fids", "rows"))
    order = np.lexsort((row, fid, d2, d1))
    d1, d2, fid, row = d1[order], d2[order], fid[order], row[order]
    # a digest's second half as its rank, so that one search finds both halves
    new = np.append(True, (np.diff(d1) != 0) | (np.diff(d2) != 0))
    number = np.cumsum(new)
    size = np.bincount(number)
    key1, key2, key_n, key_f, key_r = d1[new], d2[new], size[1:], fid[new], row[new]
    out = []
    for x in arrays:
        at = np.searchsorted(key1, x["d1"])
        # equal first halves of different digests stand side by side
        off = np.flatnonzero(key2[at] != x["d2"])
        while len(off):
            at[off] += 1
            off = off[key2[at[off]] != x["d2"][off]]
        found = ((x["fids"] != key_f[at]) | (x["rows"] != key_r[at])) if first else key_n[at] > 1
        hit = np.flatnonzero(found & (x["places"] >= 0))
        for f, r, p in zip(x["fids"][hit].tolist(), x["rows"][hit].tolist(),
                           x["places"][hit].tolist(), strict=True):
            out.append({"fid": f, "row": r, "start": p, "end": p + length})
    return out


def cross_shard_spans(sent: DataFrame, length: int = LENGTH, first: bool = False) -> DataFrame:
    """``SPANS`` of the sorted runs that split anchors' shards sent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if held and (held[0]["a"], held[0]["bucket"]) != (row["a"], row["bucket"]):
                    yield pa.RecordBatch.from_pylist(merge_runs(held, length, first), _SPAN_ARROW)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist(merge_runs(held, length, first), _SPAN_ARROW)

    ordered = sent.repartition("a", "bucket").sortWithinPartitions("a", "bucket")
    return map_arrow(ordered, run, SPANS)


# ------------------------------------------------------------------ operator

def _contexts(docs: DataFrame, edges: DataFrame, length: int, unit: int) -> DataFrame:
    """The bytes of every context in ``edges``, read from its document."""
    wanted = edges.groupBy("fid", "row").agg(F.collect_list(F.struct(
        "a", "part", "splits", "n", "windows", "place")).alias("wanted"))
    # hashed, so that the texts are not sorted: a document's contexts are few beside it
    rows = docs.select("fid", "row", "data").join(wanted.hint("shuffle_hash"), ["fid", "row"])
    rows = rows.select("fid", "row", "data", F.explode("wanted").alias("w"))
    return rows.select("fid", "row", "w.*", F.expr(
        f"substring(data, int(w.place) + 1, (w.windows - 1) * {unit} + {length})").alias("bytes"))


def _times(apart: bool) -> Column:
    """How often a context occurs; ``apart``: 2 if in several documents, else 1."""
    if not apart:
        return F.count(F.lit(1))
    differ = (F.min("fid") != F.max("fid")) | (F.min("row") != F.max("row"))
    return F.when(differ, 2).otherwise(1).cast("long")


def repeated_spans(docs: DataFrame, length: int = LENGTH, unit: int = 1,
                   apart: bool = False, first: bool = False) -> DataFrame:
    """(fid, row, spans) of (fid, row, data): the repeated spans [start, end) of
    every document that has any, in order and not touching one another. With
    ``apart`` a window must occur in another document; with ``first`` (units of
    one byte) in one that comes before by (fid, row)."""
    found = written(runs(docs, length, unit), "suffix-runs")
    many, _ = broadcast_if_small(found.groupBy("a").count().filter("count > 1").select("a"))
    found = written(found.join(many, "a", "left_semi"), "suffix-repeated-anchors")
    own = F.struct("fid", "row")
    groups = found.groupBy("a", "c").agg(
        (F.count(F.lit(1)) if first else _times(apart)).alias("n"),
        *([F.min(own).alias("lead")] if first else []),
        *[F.first(k).alias(k) for k in ("fid", "row", "place", "windows")])
    groups = written(groups, "suffix-contexts")
    whole = groups.filter("n > 1")
    different = groups.groupBy("a").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1")
    if first:  # copies in later documents go whole; the first one's stand for them
        whole = whole.select("a", "c", "n", "lead")
        copies = joined(found, whole, ["a", "c"], hot_keys(whole, ["a", "c"]))
        whole_runs = copies.filter(own != F.col("lead"))
        leads = copies.filter(own == F.col("lead")).select("a", "c", "fid", "row", "place", "windows")
        groups = leads.unionByName(groups.filter("n = 1").select(*leads.columns)).withColumn(
            "n", F.lit(1).cast("long"))
    else:
        whole, _ = broadcast_if_small(whole.select("a", "c"))
        whole_runs = found.join(whole, ["a", "c"], "left_semi")
    whole_spans = whole_runs.select(
        "fid", "row", F.col("place").alias("start"),
        (F.col("place") + (F.col("windows") - 1) * unit + length).alias("end"))
    different = written(different, "suffix-different")
    edges = (joined(groups, different, ["a"], hot_keys(different, ["a"], "contexts"))
             .withColumn("splits", F.ceil(F.col("contexts") / SHARD_CONTEXTS).cast("int"))
             .withColumn("part", F.pmod("c", F.col("splits")).cast("int")))
    edges = written(edges.drop("c", "contexts"), "suffix-edges")
    sent = written(shard_spans(_contexts(docs, edges, length, unit), length, unit, apart, first),
                   "suffix-shards")
    spans = (whole_spans.unionByName(sent.filter("start is not null").select("fid", "row",
                                                                             "start", "end"))
             .unionByName(cross_shard_spans(sent.filter("bucket is not null").drop(
                 "fid", "row", "start", "end"), length, first)))
    return merged_spans(spans)


def merged_spans(spans: DataFrame) -> DataFrame:
    """(fid, row, spans) with overlapping and touching spans made one: a span that
    begins beyond all before it begins an island."""
    here = Window.partitionBy("fid", "row").orderBy("start", "end")
    reach = F.max("end").over(here.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("new", (reach.isNull() | (reach < F.col("start"))).cast("int"))
    rows = rows.withColumn("island", F.sum("new").over(here))
    islands = rows.groupBy("fid", "row", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    return islands.groupBy("fid", "row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _kept_bytes(raw: Column, spans: Column) -> Column:
    """``raw`` without its spans."""
    gaps = F.transform(spans, lambda s, i: F.struct(
        F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(spans, i - 1)["end"]).alias("b"),
        s["start"].alias("e")))
    last = F.struct(F.element_at(spans, -1)["end"].alias("b"),
                    F.octet_length(raw).cast("bigint").alias("e"))
    parts = F.transform(F.concat(gaps, F.array(last)), lambda g: F.hex(
        F.substring(raw, g["b"].cast("int") + 1, (g["e"] - g["b"]).cast("int"))))
    return F.unhex(F.array_join(parts, ""))


def kept_text(raw: Column, spans: Column) -> Column:
    """The text of ``raw`` without its spans and the characters they cut in two."""
    def text(b: Column) -> Column:
        def inside(at: Column) -> Column:  # a byte that continues a character
            byte = F.hex(b.substr((at + 1).cast("int"), F.lit(1)))
            return (byte >= "80") & (byte < "C0")

        def moved(at: Column, step: int) -> Column:
            return F.when(~inside(at), at).when(~inside(at + step), at + step).when(
                ~inside(at + 2 * step), at + 2 * step).otherwise(at + 3 * step)

        whole = F.transform(spans, lambda s: F.struct(
            moved(s["start"], -1).alias("start"), moved(s["end"], 1).alias("end")))
        return let(whole, lambda s: _kept_bytes(b, s))

    return let(raw, text).cast("string")


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text",
                    first: bool = False) -> DataFrame:
    """``docs`` with three more columns: ``__bytes`` (the text's UTF-8),
    ``__kept`` (what is left of it) and ``__spans`` (what was removed). With
    ``first`` the document of least ``doc_id`` (null is least) keeps a window that
    several have."""
    columns = docs.columns
    docs = located(docs)
    if first:  # identified in the documents' order
        fid = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63))
        row = F.xxhash64("__file", "__row")
    else:
        fid, row = F.xxhash64("__file"), F.col("__row")
    keyed = docs.select(fid.alias("fid"), row.alias("row"),
                        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)])
    at = f"__c{columns.index(text)}"
    data = F.encode(text_or_empty(at), "UTF-8")
    spans = written(repeated_spans(keyed.select("fid", "row", data.alias("data")), length,
                                   first=first), "suffix-spans")
    # a text is shuffled once, not as bytes as well, and not sorted
    rows = keyed.join(spans.hint("shuffle_hash"), ["fid", "row"], "left").withColumn(
        "__bytes", data)
    kept = F.when(F.col("spans").isNull(), F.col("__bytes")).otherwise(
        _kept_bytes(F.col("__bytes"), F.col("spans")))
    return rows.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)], "__bytes",
                       kept.alias("__kept"), F.coalesce("spans", F.array().cast(
                           "array<struct<start:bigint,end:bigint>>")).alias("__spans"))


__all__ = ["LENGTH", "Hashes", "cross_shard_spans", "find_runs", "kept_text", "later_windows",
           "merge_runs", "merged_spans", "product", "repeated_spans", "repeated_windows", "runs", "shard_spans", "without_repeats"]
