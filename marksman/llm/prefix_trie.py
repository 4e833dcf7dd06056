"""The trie of conversation prefixes, from sorted sequences and their LCPs.

A conversation is the sequence of its turns. Conversations that begin with the
same d turns share a node of depth d. Sorted by their sequences, the members of
a node stand side by side: a node is an interval in which all neighbours share
at least d turns.

1. *Sequences.* A turn is the first 16 bytes of a SHA-256 of its role and text
   (``turns``); a conversation is the row of its turns' bytes.
2. *Sorting.* Range partitions by (sequence, conversation), so a sequence that a
   third of all conversations have is split over many of them. A *part* is one
   such partition; it also gets its neighbours' nearest sequences (one row each).
3. *Extents.* In a part, ``extents`` answers for any number of prefixes at once
   how far left and right the common prefixes stay long enough: a sparse table
   holds the least common prefix of every run of 2^k neighbours, and each prefix
   binary-searches its left and right extent in it by itself. Prefixes asked for
   are those of every conversation beyond what it shares with the one before it,
   and those one turn shorter (the parents). The smallest member is another
   range minimum; children, leaves and saved words are differences of running
   sums over the interval.
4. *Edges.* A node that goes on beyond its part's edge is sent as a piece, keyed
   by its prefix; there are no more of them than the first and last conversation
   of the part have turns. Pieces are added up by key, their members' numbers are
   hashed in order, chunk by chunk.

Saved words of a node: every member but the leftmost adds the words of the turns
it shares with its left neighbour, without those above the node.

Edge cases: null role or text is empty; a null turn number comes first; turns of
one conversation with the same number come in the order of their digests; rows
without a conversation number belong to none and are left out; an empty table
gives no row (no root); a conversation without turns is a member of the root; a
repeated row is a turn of its own; other columns are ignored, whatever their
names. Very long texts are hashed whole; a conversation is one row of 16 bytes a
turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marksman.llm.common import map_arrow, text_or_empty, written
from marksman.plans.sizing import broadcast_if_small

WIDTH = 16  # bytes of a turn
PART_TURNS = 1 << 20
LEAST_TURNS = 1 << 12
CHUNK_IDS = 1 << 15
BLOCK, SHARED_TURNS = 20, 4
_NO_IDS = hashlib.sha256(b"").hexdigest()


# --------------------------------------------------------------- sequences

def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, digests, words) of every conversation: its turns in order, as
    hex digests, and the words of each."""
    role, text = text_or_empty("role"), text_or_empty("text")
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    number = F.col("turn").cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            number.isNotNull().alias("numbered"), number.alias("turn"),
            F.substring(F.sha2(whole, 256), 1, 2 * WIDTH).alias("digest"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).alias("t"))
    each = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return each.select("conv_id", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))


def shared_start(conv_id: Column) -> Column:
    """How many turns a conversation takes from its block's first one."""
    return (F.crc32(conv_id.cast("string")) % SHARED_TURNS).cast("int")


def rebuilt(own: DataFrame, block: int = BLOCK) -> DataFrame:
    """``turns`` with every conversation's first turns (``shared_start``) replaced
    by those of the conversation that begins its block of ``block`` numbers."""
    first = own.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("leader"),
        *[F.slice(c, 1, SHARED_TURNS - 1).alias(f"lead_{c}") for c in ("digests", "words")])
    rows = own.withColumn("leader", F.col("conv_id") - F.col("conv_id") % block).withColumn(
        "h", shared_start(F.col("conv_id"))).join(first, "leader", "left")

    def joined(c: str) -> Column:
        lead = F.slice(F.coalesce(F.col(f"lead_{c}"), F.slice(c, 1, 0)), F.lit(1), F.col("h"))
        return F.concat(lead, F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1))))

    return rows.select("conv_id", joined("digests").alias("digests"), joined("words").alias("words"))


# ----------------------------------------------------------------- extents

def common_turns(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For every row but the first the turns it shares with the row before."""
    out = np.zeros(len(size), np.int64)
    alive = np.arange(1, len(size))
    d = 0
    while len(alive):
        alive = alive[(size[alive] > d) & (size[alive - 1] > d)]
        alive = alive[(flat[begin[alive] + d] == flat[begin[alive - 1] + d]).all(axis=1)]
        d += 1
        out[alive] = d
    return out[1:]


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Least of the 2^k values from every place on, for every k that fits."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        last, half = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(last[:-half], last[half:]))
    return table


def range_least(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value between the places ``low`` and ``high``, both included."""
    out = np.empty(len(low), table[0].dtype)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    for k in range(len(table)):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[k][low[at]], table[k][high[at] - (1 << k) + 1])
    return out


def extents(table: list[np.ndarray], n: int, place: np.ndarray,
            depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For prefixes of ``depth`` turns of the conversations at ``place`` (of n)
    the first and last place that share them. ``table`` is over the numbers
    of turns that place i shares with place i - 1."""
    left, right = place.copy(), place.copy()
    for k in range(len(table) - 1, -1, -1):
        step, least = 1 << k, table[k]
        to = right + step
        at = np.flatnonzero(to <= n - 1)
        at = at[least[right[at] + 1] >= depth[at]]
        right[at] = to[at]
        to = left - step
        at = np.flatnonzero(to >= 0)
        at = at[least[to[at] + 1] >= depth[at]]
        left[at] = to[at]
    return left, right


# ------------------------------------------------------------------- parts

OUT = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("above", pa.int64()),
    ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("chunk", pa.int64()), ("ids", pa.binary())])
OUT_SQL = ("kind int, part int, conv_id long, depth long, parent_conv_id long, n_convs long, "
           "n_children long, n_leaves long, saved long, above long, ends_sha256 string, key binary, "
           "parent_key binary, chunk long, ids binary")
NODE, PIECE, CHUNK = 0, 1, 2


def _joined_ids(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _prefix_keys(seq: bytes) -> list[bytes]:
    """A key for each prefix of a sequence, the empty one first."""
    state = hashlib.blake2b(digest_size=16)
    keys = [state.digest()]
    for at in range(0, len(seq), WIDTH):
        state.update(seq[at:at + WIDTH])
        keys.append(state.digest())
    return keys


def part_rows(part: int, before: bytes | None, seqs: list[bytes], convs: np.ndarray,
              words: np.ndarray, after: bytes | None) -> pa.Table:
    """``OUT`` rows of one part: sorted sequences, their conversations, the words of
    all their turns in a row, and the sequences next to the part."""
    n = len(seqs)
    rows = [*([] if before is None else [before]), *seqs, *([] if after is None else [after])]
    size = np.array([len(s) // WIDTH for s in rows], np.int64)
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(rows), np.uint64).reshape(-1, WIDTH // 8)
    shared = common_turns(flat, begin, size)
    shared = np.concatenate([[-1] if before is None else [], shared,
                             [-1] if after is None else []]).astype(np.int64)
    size = np.array([len(s) // WIDTH for s in seqs], np.int64)
    # words of a conversation's first k turns: total[base + k] - total[base]
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    base = np.cumsum(size) - size

    def words_until(i: np.ndarray, k: np.ndarray) -> np.ndarray:
        return total[base[i] + k] - total[base[i]]

    # prefixes that no earlier conversation of the part has
    fresh = size - shared[:n]
    fresh[0] = size[0] + 1  # those that came over the edge, too
    place = np.repeat(np.arange(n), fresh)
    inner = np.arange(len(place)) - np.repeat(np.cumsum(fresh) - fresh, fresh)
    depth = inner + np.where(place == 0, 0, shared[place] + 1)
    table = sparse_table(shared)
    left, right = extents(table, n, place, depth)
    from_before = (left == 0) & (shared[0] >= depth)
    goes_on = (right == n - 1) & (shared[n] >= depth)
    least = sparse_table(convs)
    conv = range_least(least, left, right)
    # children begin where exactly the node's turns are shared and more follow
    at = np.arange(n)
    begins = np.sort((shared[:n] * (n + 1) + at)[(size > shared[:n]) & (shared[:n] >= 0)])
    children = (np.searchsorted(begins, depth * (n + 1) + right, side="right")
                - np.searchsorted(begins, depth * (n + 1) + left, side="left"))
    children += ~from_before & (size[left] > depth)
    ended = np.concatenate([[0], np.cumsum(shared[1:] < size)])
    leaves = ended[right + 1] - ended[left]
    same = np.concatenate([[0], np.cumsum(np.where(
        shared[:n] >= 0, words_until(at, np.maximum(shared[:n], 0)), 0))])
    saved = same[right + 1] - same[np.where(from_before, left, left + 1)]
    above = words_until(left, np.maximum(depth - 1, 0))
    # conversations that end here: a run of equal ones at the interval's start
    equal = (shared[:n] == size) & (np.append(-1, size[:-1]) == size)
    equal[0] = False
    run = np.append(np.flatnonzero(~equal), n)
    run_end = run[np.searchsorted(run, at, side="right")]
    ends = np.where(size[left] == depth, run_end[left], left)
    # parents
    up = np.maximum(depth - 1, 0)
    up_left, up_right = extents(table, n, left, up)
    up_before = (up_left == 0) & (shared[0] >= up)
    up_open = up_before | ((up_right == n - 1) & (shared[n] >= up))
    parent = range_least(least, up_left, up_right)

    first_keys, last_keys = _prefix_keys(seqs[0]), _prefix_keys(seqs[-1])
    is_open = from_before | goes_on
    kinds, keys, parent_keys, shas = is_open.astype(np.int32), [], [], []
    chunks: list[dict] = []
    for i, (o, b, po, pb, d, lo, hi) in enumerate(zip(
            is_open.tolist(), from_before.tolist(), up_open.tolist(), up_before.tolist(),
            depth.tolist(), left.tolist(), ends.tolist(), strict=True)):
        key = (first_keys if b else last_keys)[d] if o else None
        keys.append(key)
        parent_keys.append((first_keys if pb else last_keys)[d - 1] if d and po else None)
        if not o:
            shas.append(hashlib.sha256(_joined_ids(convs[lo:hi])).hexdigest() if hi > lo else _NO_IDS)
            continue
        shas.append(None)
        for c in range(lo, hi, CHUNK_IDS):
            chunks.append({"kind": CHUNK, "part": part, "key": key, "chunk": c,
                           "ids": _joined_ids(convs[c:min(hi, c + CHUNK_IDS)])})
    nodes = pa.Table.from_arrays([
        pa.array(kinds), pa.array(np.full(len(place), part, np.int32)), pa.array(conv),
        pa.array(depth), pa.array(parent, mask=(depth == 0) | up_open),
        pa.array(right - left + 1), pa.array(children), pa.array(leaves), pa.array(saved),
        pa.array(above), pa.array(shas, pa.string()), pa.array(keys, pa.binary()),
        pa.array(parent_keys, pa.binary()), pa.nulls(len(place), pa.int64()),
        pa.nulls(len(place), pa.binary())], schema=OUT)
    return pa.concat_tables([nodes, pa.Table.from_pylist(chunks, OUT)]) if chunks else nodes


def _part_nodes(rows: DataFrame) -> DataFrame:
    """``OUT`` of (part, side, conv_id, seq, words), part by part in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        part = None

        def done() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            side, seq = t["side"].to_numpy(), t["seq"].to_pylist()
            own = np.flatnonzero(side == 1)
            lo, hi = int(own[0]), int(own[-1]) + 1
            mine = t.slice(lo, hi - lo).combine_chunks()
            flat = pa.concat_arrays([c.flatten() for c in mine["words"].chunks])
            yield from part_rows(part, seq[0] if side[0] == 0 else None, seq[lo:hi],
                                 mine["conv_id"].to_numpy(),
                                 flat.to_numpy(zero_copy_only=False).astype(np.int64),
                                 seq[-1] if side[-1] == 2 else None).to_batches(4096)

        for batch in batches:
            ids = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    if held and ids[a] != part:
                        yield from done()
                        held = []
                    part = int(ids[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    return map_arrow(rows, run, OUT_SQL)


def _hashed_ends(chunks: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, part, chunk, ids): one running hash a key."""
    out = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            for i in range(batch.num_rows):
                k, ids = batch.column(0)[i].as_py(), batch.column(3)[i].as_py()
                if k != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pylist(
                            [{"key": key, "ends_sha256": state.hexdigest()}], out)
                    key, state = k, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": state.hexdigest()}], out)

    ordered = chunks.select("key", "part", "chunk", "ids").repartition("key")
    return map_arrow(ordered.sortWithinPartitions("key", "part", "chunk"), run,
                     "key binary, ends_sha256 string")


# ---------------------------------------------------------------- operator

def _parts(turns_total: int, spark) -> int:
    few = min(2 * spark.sparkContext.defaultParallelism, ceil(turns_total / LEAST_TURNS))
    return max(1, few, ceil(turns_total / PART_TURNS))


def prefix_nodes(convs: DataFrame) -> DataFrame:
    """One row for each node of the trie of (conv_id, digests, words): conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    spark = convs.sparkSession
    seqs = written(convs.select("conv_id", F.unhex(F.array_join("digests", "")).alias("seq"),
                                F.col("words").cast("array<int>").alias("words")), "trie-sequences")
    n_turns = seqs.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    ranged = seqs.repartitionByRange(_parts(n_turns, spark), "seq", "conv_id")
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "trie-sorted")
    edges = ranged.groupBy("part").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    beside = Window.orderBy("part")  # a row for each part
    edges = edges.select("part", F.lag("high").over(beside).alias("before"),
                         F.lead("low").over(beside).alias("after"))
    edges = edges.select("part", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("before").alias("seq")),
        F.struct(F.lit(2).alias("side"), F.col("after").alias("seq")))).alias("e"))
    edges = edges.select("part", "e.side", F.lit(None).cast("long").alias("conv_id"), "e.seq",
                         F.lit(None).cast("array<int>").alias("words")).filter("seq is not null")
    rows = ranged.select("part", F.lit(1).alias("side"), "conv_id", "seq", "words").unionByName(edges)
    rows = rows.repartition("part").sortWithinPartitions("part", "side", "seq", "conv_id")
    found = written(_part_nodes(rows), "trie-nodes")
    # nodes that cross the edges of parts
    pieces = found.filter(F.col("kind") == PIECE)
    ends = _hashed_ends(found.filter(F.col("kind") == CHUNK))
    whole = pieces.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent_key", True).alias("parent_key"),
        F.min("conv_id").alias("conv_id"), F.first("above").alias("above"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")])
    whole = written(whole.join(ends, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS))), "trie-crossing")
    named = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    crossing = whole.join(named, "parent_key", "left").withColumn("parent_conv_id", F.col("up"))
    # a node's parent that crosses: looked up by part, so that no key is in all rows
    here, _ = broadcast_if_small(pieces.select("part", F.col("key").alias("parent_key")).join(
        named, "parent_key"))
    inner = found.filter(F.col("kind") == NODE).join(here, ["part", "parent_key"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "up"))
    saved = F.col("saved") - (F.col("n_convs") - 1) * F.col("above")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               saved.alias("saved_tokens"), "ends_sha256"]
    return inner.select(*columns).unionByName(crossing.select(*columns))


__all__ = ["common_turns", "extents", "part_rows", "prefix_nodes", "range_least", "rebuilt",
           "shared_start", "sparse_table", "turns"]
