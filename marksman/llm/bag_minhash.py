"""Near-duplicate groups by BagMinHash signatures of word-shingle multisets.

*Signature.* A text is the multiset of its runs of five words (a shorter text is
one run); a run's weight is how often it occurs. Weights are discretised to
units, unit intervals gathered in (0,1], (1,2], (2,4], (4,8], ... For every run
and interval a Poisson process with the interval's length as rate gives points
in growing order, seeded by the run and the interval alone; a point has a
signature place and, by further bits that halve the interval again and again, a
unit. Points whose unit lies above the weight are dropped: what is left is the
process of exactly the weight. Each signature place keeps its least point, so
two texts agree at a place with probability equal to their weighted Jaccard
similarity. A process ends when its points pass the largest value of the
signature, so most runs draw one or two. The value stored is the point's hash.

*Groups.* Equal texts are one node. A node falls into ``BANDS`` buckets of
``ROWS`` values each. In a bucket every node is paired with one pivot, not with
all others, so pairs grow linearly. Pairs pass if the signatures agree enough
(margin below) and then if the multisets' overlap, counted exactly, is at least
``THRESHOLD``; passed pairs join components. Buckets that still span several
components get a second pivot outside their largest one; what is then still
apart goes through an exact join by prefix filtering, which finds every pair of
different components that can reach the threshold and, of large groups whose
members are not alike enough, hardly any other. Links are joined to components
by contracting the graph with pointer jumping; nothing of it reaches the driver.

Edge cases: null, empty and white-space texts have no words and are equal; equal
texts are one group; an empty table gives no row; rows that share an id are
documents of their own; the group's name is its smallest id (null is smallest),
which row of several with that id stays is decided by their place in the files;
other columns stay in ``deduplicated``, whatever their names; long texts are
processed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marksman.llm.common import hot_keys, joined, map_arrow, text_or_empty, written
from marksman.llm.exact_dedup import located
from marksman.llm.suffix_dedup import Hashes, mixed
from marksman.plans.sizing import broadcast_if_small

SHINGLE = 5
PLACES = 128
BANDS, ROWS = 25, 5  # a pair at 0.8 misses all bands once in 20 000
THRESHOLD = 0.8
# A pair of similarity 0.8 agrees in fewer places with a chance below 1e-6.
LEAST_AGREEING = 78
PIVOT_TURNS = 2
_CHUNK = 1 << 17

SIGNATURES = ("doc_id long, fid long, row long, d1 long, d2 long, bands array<long>, sig binary, n_words int")


# ------------------------------------------------------------- signatures

def normal_words(text: str) -> str:
    """The text's words with single spaces."""
    return " ".join(text.split())


def shingle_counts(data: np.ndarray, n_docs: int, hashes: Hashes,
                   size: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """(doc, shingle, count) of documents (normal words) that each end with a
    line feed, sorted by doc and shingle; and the words of every document."""
    space = (data == 32) | (data == 10)
    first = np.append(True, space[:-1]) & ~space
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    line = np.append(0, np.cumsum(data == 10)[:-1])
    doc = line[starts]
    n_words = np.bincount(doc, minlength=n_docs)
    until = np.cumsum(n_words)
    last = np.minimum(np.arange(len(starts)) + size - 1, until[doc] - 1)
    # full runs, and the only one of a short document
    take = (np.arange(len(starts)) + size <= until[doc]) | (
        np.arange(len(starts)) == until[doc] - n_words[doc])
    h = hashes.spans(data, starts[take], ends[last[take]])
    d = doc[take]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return d[at], h[at], np.diff(np.append(at, len(h))), n_words


def bag_minhash(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n_docs: int,
                places: int = PLACES, seed: int = 7) -> np.ndarray:
    """Signatures (n_docs x places, 64-bit) of weighted sets; zeros for empty
    ones. ``weight`` holds positive integers."""
    least = np.full(n_docs * places, np.inf)
    value = np.zeros(n_docs * places, np.uint64)
    # the intervals of every item: number, and lowest unit
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    source = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(source)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    length = np.maximum(low, 1)
    key = mixed(item[source] + mixed((level + 1 + 64 * seed).astype(np.uint64)))
    d, room = doc[source], weight[source] - low
    x = np.zeros(len(source))
    drawn = []
    golden = np.uint64(0x9E3779B97F4A7C15)
    scale = 1.0 / (1 << 53)
    while len(d):
        key = key + golden
        r = mixed(key)
        x = x - np.log1p(-((r >> np.uint64(11)).astype(np.float64) * scale)) / length
        s = mixed(r ^ golden)
        place = d * places + (s % np.uint64(places)).astype(np.int64)
        # the unit: the interval halved by one bit after another
        unit = (s >> np.uint64(32)).astype(np.int64) & (length - 1)
        valid = unit < room
        np.minimum.at(least, place[valid], x[valid])
        drawn.append((place[valid], x[valid], r[valid]))
        top = least.reshape(n_docs, places).max(axis=1)
        go = x < top[d]
        key, x, d, room, length = key[go], x[go], d[go], room[go], length[go]
    for place, at, r in drawn:
        won = at == least[place]
        value[place[won]] = r[won]
    return value.reshape(n_docs, places)


def band_keys(value: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A hash for each band (n_docs x bands)."""
    out = np.empty((len(value), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(value), b + 1, np.uint64)
        for k in range(rows):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + value[:, b * rows + k])
        out[:, b] = h
    return out


def _joined(texts: list[str]) -> np.ndarray:
    """The texts' bytes, each with a line feed."""
    return np.frombuffer("\n".join([*texts, ""]).encode(), np.uint8)


def signatures(docs: DataFrame) -> DataFrame:
    """``SIGNATURES`` of (doc_id, fid, row, text): SHA-256 (16 bytes) of the words, band hashes
    (none without words) and the low 16 bits of each signature value."""
    def some(ids: pa.RecordBatch, texts: list[str], hashes: Hashes) -> pa.RecordBatch:
        data = _joined(texts)
        doc, item, count, n_words = shingle_counts(data, len(texts), hashes)
        value = bag_minhash(doc, item, count, len(texts))
        keys = band_keys(value).view(np.int64)
        d1, d2 = np.frombuffer(b"".join(hashlib.sha256(t.encode()).digest()[:16] for t in texts),
                               np.int64).reshape(-1, 2).T
        low = (value & np.uint64(0xFFFF)).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [*ids.columns[:3], pa.array(d1), pa.array(d2),
             pa.array([k.tolist() if n else [] for k, n in zip(keys, n_words, strict=True)],
                      pa.list_(pa.int64())),
             pa.array([v.tobytes() for v in low], pa.binary()),
             pa.array(n_words.astype(np.int32))],
            ["doc_id", "fid", "row", "d1", "d2", "bands", "sig", "n_words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            held: list[str] = []
            size = at = 0
            for i in range(batch.num_rows):
                held.append(normal_words(batch.column(3)[i].as_py()))
                size += len(held[-1])
                if size >= _CHUNK or len(held) >= 1024:
                    yield some(batch.slice(at, i + 1 - at), held, hashes)
                    held, size, at = [], 0, i + 1
            if held:
                yield some(batch.slice(at), held, hashes)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "fid", "row", "text"), run,
                     SIGNATURES)


# ------------------------------------------------------------ verification

def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted items, counts)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum()) + int(b[1].sum()) - least
    return least / total if total else 1.0


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (u, v) whose texts' multisets overlap enough. ``texts`` has
    (node, text); pairs of one u come together, its multiset is built once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()

        def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
            _, item, count, _ = shingle_counts(_joined([normal_words(text)]), 1, hashes)
            return item, count

        known: tuple[int, tuple] | None = None
        for batch in batches:
            u, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(batch.num_rows):
                if known is None or known[0] != u[i]:
                    known = (u[i], bag(batch.column(2)[i].as_py()))
                keep.append(overlap(known[1], bag(batch.column(3)[i].as_py())) >= threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, k in zip(u, keep, strict=True) if k], pa.int64()),
                 pa.array([x for x, k in zip(v, keep, strict=True) if k], pa.int64())], ["u", "v"])

    a = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    b = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    rows = pairs.join(b, "v").join(a, "u").select("u", "v", "a", "b")
    return map_arrow(rows.sortWithinPartitions("u"), run, "u long, v long")


# -------------------------------------------------------------- components

def contracted(labels: DataFrame, links: DataFrame, name: str = "near-labels") -> DataFrame:
    """``labels`` (node, label) after joining the components that the ``links``
    (u, v between nodes) connect; a label is a component's least node."""
    def ends(of: DataFrame, edges: DataFrame) -> DataFrame:
        a = of.select(F.col("node").alias("u"), F.col("label").alias("lu"))
        b = of.select(F.col("node").alias("v"), F.col("label").alias("lv"))
        return (edges.join(a, "u").join(b, "v").filter("lu <> lv")
                .select(F.col("lu").alias("u"), F.col("lv").alias("v")).distinct())

    edges = written(ends(labels, links), name)
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # every node hooks to its least neighbour or itself, then to that one's, ...
        hook = written(both.groupBy(F.col("u").alias("node")).agg(
            F.least(F.min("v"), F.first("u")).alias("label")), name)
        while True:
            up = hook.select(F.col("node").alias("label"), F.col("label").alias("above"))
            jumped = written(hook.join(up, "label").select(
                "node", F.col("above").alias("label"),
                (F.col("above") != F.col("label")).alias("moved")), name)
            hook = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        labels = written(labels.join(
            hook.select(F.col("node").alias("label"), F.col("label").alias("above")), "label",
            "left").select("node", F.coalesce("above", "label").alias("label")), name)
        edges = written(ends(hook, edges), name)
    return labels


# ------------------------------------------------------------------ groups

def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in enough places and whose numbers of
    shingles allow the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, PLACES)
                    for i in (2, 3))
            keep = pa.array((a == b).sum(axis=1) >= LEAST_AGREEING)
            yield batch.select([0, 1]).filter(keep)

    a = nodes.select(F.col("node").alias("u"), F.col("sig").alias("a"), F.col("size").alias("m"))
    b = nodes.select(F.col("node").alias("v"), F.col("sig").alias("b"), F.col("size").alias("n"))
    rows = (pairs.join(b, "v").join(a, "u")
            .filter(F.least("m", "n") >= THRESHOLD * F.greatest("m", "n") - 1e-9))
    return map_arrow(rows.select("u", "v", "a", "b"), run, "u long, v long")


def near_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fid, row, d1, d2) of every document, and (d1, d2, label) of every
    distinct text: its group, the least node of a component. ``docs`` has
    (doc_id, fid, row, text), no null text."""
    sigs = written(signatures(docs), "near-signatures")
    classes = sigs.groupBy("d1", "d2").agg(
        *[F.first(c).alias(c) for c in ("fid", "row", "bands", "sig", "n_words")])
    nodes = written(classes.withColumn("node", F.monotonically_increasing_id()).withColumn(
        "size", F.greatest(F.col("n_words") - (SHINGLE - 1), F.lit(1))), "near-nodes")
    placed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    crowded = placed.groupBy("band", "key").count().filter("count > 1").drop("count")
    buckets = written(placed.join(crowded, ["band", "key"])
                      .select(F.xxhash64("band", "key").alias("bucket"), "node"), "near-buckets")
    involved = written(buckets.select("node").distinct(), "near-involved")
    inner = nodes.join(involved, "node", "left_semi")
    where, _ = broadcast_if_small(inner.select("fid", "row", "node"))
    texts = written(docs.select("fid", "row", "text")
                    .join(where, ["fid", "row"]).select("node", "text"), "near-texts")
    inner = written(inner.select("node", "sig", "size"), "near-inner")
    labels = written(involved.select("node", F.col("node").alias("label")), "near-labels")
    tested = None
    for turn in range(PIVOT_TURNS + 1):
        sizes = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "near-sizes")
        hot = hot_keys(sizes, ["bucket"])
        pairs = (_pivot_pairs(buckets, sizes, labels, tested, hot) if turn < PIVOT_TURNS
                 else _prefix_pairs(texts.join(buckets.select("node").distinct(), "node",
                                               "left_semi"), labels, tested))
        pairs = written(pairs, "near-pairs")
        # written in between: one Python worker a task, not one for each function
        agreeing = written(_agreeing(pairs, inner), "near-agreeing")
        links = written(verified(agreeing, texts), "near-links")
        labels = contracted(labels, links)
        tested = pairs if tested is None else tested.unionByName(pairs)
        buckets = written(_open_buckets(buckets, labels, hot), "near-buckets")
        if buckets.isEmpty():
            break
    groups = nodes.select("d1", "d2", "node").join(labels, "node", "left")
    return (sigs.select("doc_id", "fid", "row", "d1", "d2"),
            groups.select("d1", "d2", F.coalesce("label", "node").alias("label")))


def _open_buckets(buckets: DataFrame, labels: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Buckets that still span several components."""
    rows = buckets.join(labels, "node")
    several = (rows.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b"))
               .filter("a <> b").select("bucket"))
    return joined(buckets, several, ["bucket"], hot)


def _pivot_pairs(buckets: DataFrame, sizes: DataFrame, labels: DataFrame,
                 tested: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    """Pairs (u < v) to test: in every bucket a pivot with all nodes of other
    components. The pivot is the node that meets most others in its buckets (of
    edited copies the one nearest to all), later one outside the bucket's
    largest component. ``sizes`` has the buckets' nodes, ``hot`` the buckets that
    must not meet in one task."""
    met = joined(buckets, sizes, ["bucket"], hot).groupBy("node").agg(F.sum("n").alias("met"))
    rows = buckets.join(labels, "node").join(met, "node")
    apart = rows
    if tested is not None:
        largest = (rows.groupBy("bucket", "label").count().groupBy("bucket")
                   .agg(F.max(F.struct("count", "label"))["label"].alias("main")))
        apart = joined(rows, largest, ["bucket"], hot).filter("label <> main")
    pivots = apart.groupBy("bucket").agg(F.max(F.struct("met", "node", "label")).alias("p")).select(
        "bucket", F.col("p.node").alias("pivot"), F.col("p.label").alias("own"))
    pairs = (joined(rows, pivots, ["bucket"], hot).filter("label <> own")
             .select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v"))
             .distinct())
    return pairs if tested is None else pairs.join(tested, ["u", "v"], "left_anti")


def _prefix_pairs(texts: DataFrame, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """All pairs (u < v) of different components among ``texts`` (node, text)
    that can reach the threshold, by prefix filtering: with the shingles (each
    copy of one counting as another) in one order, rare ones first, two such
    multisets share one of their first size - ceil(threshold * size) + 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for i in range(batch.num_rows):
                _, item, count, _ = shingle_counts(
                    _joined([normal_words(batch.column(1)[i].as_py())]), 1, hashes)
                each = np.repeat(item, count)
                copy = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                token = mixed(each + copy.astype(np.uint64)).view(np.int64)
                n = len(token)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n, pa.int64()), pa.array(token),
                     pa.array([n] * n, pa.int32())], ["node", "token", "n"])

    tokens = written(map_arrow(texts, run, "node long, token long, n int"), "near-tokens")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # a token of one node alone comes first in its order and meets nobody
    known = tokens.join(often, "token", "left").select(
        "node", "n", F.struct(F.coalesce("df", F.lit(1)).alias("df"), "token").alias("t"))
    first = known.groupBy("node").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list("t")).alias("ts"))
    head = first.select("node", "n", F.posexplode(F.slice(
        "ts", F.lit(1), (F.col("n") - F.ceil(F.col("n") * THRESHOLD - 1e-9) + 1).cast("int")
    )).alias("at", "t")).filter("t.df > 1").select(
        "node", F.col("t.token").alias("token"), "n", (F.col("n") - F.col("at")).alias("left"))
    head = written(head.join(labels, "node"), "near-prefixes")
    several = (head.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b"))
               .filter("a <> b").select("token"))
    head = head.join(several, "token", "left_semi")
    other = head.select("token", F.col("node").alias("v"), F.col("label").alias("lv"),
                        F.col("n").alias("m"), F.col("left").alias("rest"))
    # from the first shared token on, no more can be shared than is left
    enough = F.least("left", "rest") >= THRESHOLD / (1 + THRESHOLD) * (
        F.col("n") + F.col("m")) - 1e-9
    pairs = (head.join(other, "token").filter("node < v and label <> lv").filter(enough)
             .select(F.col("node").alias("u"), "v").distinct())
    return pairs.join(tested, ["u", "v"], "left_anti")


def _keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"),
                       text_or_empty(text).alias("text"))


def decisions(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, group_size, kept, fid, row) of every located document:
    its group's least id, the group's documents, whether it is the one to stay."""
    members, groups = near_groups(_keyed(docs))
    # per distinct text, then per group; the documents are joined once
    each = members.groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id", "fid", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
    each = each.join(groups, ["d1", "d2"])
    whole = each.groupBy("label").agg(F.min("keep").alias("keep"), F.sum("n").alias("n"))
    named = each.select("d1", "d2", "label").join(whole, "label").drop("label")
    return members.join(named, ["d1", "d2"]).select(
        "doc_id", F.col("keep.doc_id").alias("class_id"), F.col("n").alias("group_size"),
        F.struct("doc_id", "fid", "row").eqNullSafe(F.col("keep")).alias("kept"), "fid", "row")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one a group, all columns unchanged."""
    columns = docs.columns
    docs = located(docs)
    gone = written(decisions(docs).filter("not kept").select(
        F.col("fid").alias("__fid"), F.col("row").alias("__row")), "near-gone")
    gone, _ = broadcast_if_small(gone)
    return (docs.withColumn("__fid", F.xxhash64("__file"))
            .join(gone, ["__fid", "__row"], "left_anti")
            .select(*[F.col(f"`{c}`") for c in columns]))


__all__ = ["bag_minhash", "band_keys", "contracted", "decisions", "deduplicated", "near_groups", "overlap", "shingle_counts",
           "signatures", "verified"]
