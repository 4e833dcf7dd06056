"""Ranked lexical search by hashed max-sketches.

Every item is a query, every document may answer it. A term's *impact* in a
document grows with its frequency and shrinks with the document's length; a
document's score is the sum, over the item's terms, of weight times impact.

1. *Statistics.* One pass counts the documents, their terms and, for the terms
   of the items alone, in how many documents each is (summed in each task first).
2. *Sketches.* A document's impacts are folded into ``COORDINATES`` hashed places,
   each keeping the greatest impact that falls on it. The place of a query term
   is thus never below the term's impact: weights times looked-up places, added
   up, bound the document's score from above. A slice of documents answers all
   items of a block at once.
3. *Rescoring.* Of a slice, an item's documents are scored exactly in the order of
   falling bounds, until the next bound is below the item's k-th best exact score
   so far. Nothing below can enter, so the result is exact. A task keeps k
   documents an item.
4. The tasks' lists are merged, first in ``SALTS`` groups an item, then per item.

Items come in blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_BYTES``
bytes of text; each block is one search over all documents, so what is sent to
the tasks has a fixed bound whatever the number of items.

Terms are runs of ASCII letters and digits and of all other non-ASCII characters,
only A-Z lower-cased. Edge cases: null or empty text has no terms; an item
without terms or without a matching document gives no row; equal scores rank by
ascending doc_id (null last), then by place in the files; rows that share a doc_id
are documents of their own, rows that share an item_id items of their own; empty
tables give no row; other columns are ignored, whatever their names; very long
texts are counted whole, and terms have any length.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marksman.llm.common import arrow_rows, map_arrow, text_or_empty, written
from marksman.llm.exact_dedup import located

COORDINATES = 4096
SLICE = 256
BLOCK_ITEMS, BLOCK_BYTES = 1024, 4 << 20
SALTS = 64

_TERM_BYTES = bytes(c for c in range(256) if c >= 128 or chr(c).isalnum())
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c in _TERM_BYTES else 32 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return raw.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return floor(1000.0 * log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    """What a document of ``n`` terms has in place of its length."""
    return 100 - 75 + (75 * n * n_docs) // n_terms


@dataclass
class Block:
    """Items searched for together: ids and term counts."""
    ids: list[int | None]
    counts: list[Counter]

    def vocabulary(self) -> list[bytes]:
        return sorted(set().union(*self.counts)) if self.counts else []


def blocks(items: DataFrame, max_items: int = BLOCK_ITEMS,
           max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items of (item_id, text), block after block."""
    rows = items.select(F.col("item_id").cast("long"), F.encode(text_or_empty(), "UTF-8"))
    block, size = Block([], []), 0
    for item_id, raw in rows.toLocalIterator():
        raw = bytes(raw)
        if block.ids and (len(block.ids) >= max_items or size + len(raw) > max_bytes):
            yield block
            block, size = Block([], []), 0
        block.ids.append(item_id)
        block.counts.append(Counter(terms(raw)))
        size += len(raw)
    if block.ids:
        yield block


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def statistics(docs: DataFrame, vocabulary: list[bytes]) -> tuple[int, int, list[int]]:
    """(documents with terms, their terms, documents that hold each term of the
    vocabulary) of (..., text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary)}
        wanted = number.keys()
        held: Counter = Counter()
        n_docs = n_terms = 0
        for batch in batches:
            for part in arrow_rows(batch, SLICE):
                for raw in _texts(part.column(0)):
                    found = terms(raw)
                    n_docs += bool(found)
                    n_terms += len(found)
                    held.update(wanted & set(found))
        at = [-1, -2, *(number[t] for t in held)]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(
            [n_docs, n_terms, *held.values()], pa.int64())], ["at", "n"])

    sums = map_arrow(docs.select("text"), run, "at int, n long").groupBy("at").agg(F.sum("n"))
    found = dict(map(tuple, sums.collect()))  # at most a row for each term of a block
    return found.get(-1, 0), found.get(-2, 0), [found.get(i, 0) for i in range(len(vocabulary))]


class _Search:
    """The k best documents of every item among those seen so far."""

    def __init__(self, block: Block, weights: dict[bytes, int], n_docs: int, n_terms: int, k: int):
        self.n_docs, self.n_terms, self.k = n_docs, n_terms, k
        self.items = [[(t, c * weights[t]) for t, c in counts.items() if weights[t]]
                      for counts in block.counts]
        place = {t: crc32(t) % COORDINATES for t in weights}
        self.places = [np.array([place[t] for t, _ in item], np.int64) for item in self.items]
        self.weights = [np.array([w for _, w in item], np.float64) for item in self.items]
        # best documents, best first: (-score, no id, id, file, row)
        self.best: list[list[tuple]] = [[] for _ in self.items]
        self.least = [1] * len(self.items)
        self.scored = 0

    def sketch(self, counts: list[Counter], factors: list[int]) -> np.ndarray:
        """Greatest impact at each place (COORDINATES x documents)."""
        size = [len(c) for c in counts]
        doc = np.repeat(np.arange(len(counts)), size)
        n = len(doc)
        at = np.fromiter((crc32(t) for c in counts for t in c), np.int64, n) % COORDINATES
        tf = np.fromiter((v for c in counts for v in c.values()), np.int64, n)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.array(factors, np.int64)[doc])
        out = np.zeros(COORDINATES * len(counts))
        np.maximum.at(out, at * len(counts) + doc, impact.astype(np.float64))
        return out.reshape(COORDINATES, len(counts))

    def add(self, ids: list, fids: list, rows: list, texts: list[bytes]) -> None:
        lists = [terms(t) for t in texts]
        counts = [Counter(x) for x in lists]
        factors = [length_factor(len(x), self.n_docs, self.n_terms) if x else 25 for x in lists]
        sketch = self.sketch(counts, factors)
        for q, item in enumerate(self.items):
            if not item:
                continue
            bound = self.weights[q] @ sketch[self.places[q]]
            order = np.flatnonzero(bound >= self.least[q])
            order = order[np.argsort(-bound[order], kind="stable")]
            for j, upper in zip(order.tolist(), bound[order].tolist(), strict=True):
                if upper < self.least[q]:
                    break
                self.scored += 1
                count, m, score = counts[j], 8 * factors[j], 0
                for t, w in item:
                    tf = count.get(t)
                    if tf:
                        score += w * ((1_000_000_000 * tf) // (1000 * tf + m))
                if score >= self.least[q]:
                    best = self.best[q]
                    insort(best, (-score, ids[j] is None, ids[j] or 0, fids[j], rows[j]))
                    if len(best) >= self.k:
                        del best[self.k:]
                        self.least[q] = -best[-1][0]

    def rows(self, block: Block) -> list[dict]:
        return [{"item": q, "item_id": block.ids[q], "doc_id": None if b[1] else b[2], "fid": b[3],
                 "row": b[4], "score": -b[0]} for q, best in enumerate(self.best) for b in best]


_OUT = "item int, item_id long, doc_id long, fid long, row long, score long"
_OUT_ARROW = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()),
                        ("fid", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])


def block_hits(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """Each task's best documents for a block's items, of (doc_id, fid, row, text)."""
    vocabulary = block.vocabulary()
    n_docs, n_terms, dfs = statistics(docs, vocabulary)
    weights = {t: weight(n_docs, df) for t, df in zip(vocabulary, dfs, strict=True)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(block, weights, n_docs, n_terms, k)
        for batch in batches:
            for part in arrow_rows(batch, SLICE):
                search.add(*(part.column(i).to_pylist() for i in range(3)), _texts(part.column(3)))
        yield pa.RecordBatch.from_pylist(search.rows(block), _OUT_ARROW)

    return map_arrow(docs.select("doc_id", "fid", "row", "text"), run, _OUT)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of (doc_id, text) for
    every item of (item_id, text), with a score above 0."""
    docs = located(docs).select(F.col("doc_id").cast("long").alias("doc_id"),
                                F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"),
                                text_or_empty().alias("text"))
    found = [written(block_hits(docs, block, k).withColumn("block", F.lit(i)), "search-hits")
             for i, block in enumerate(blocks(items))]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    hits = reduce(DataFrame.unionByName, found)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("fid"), F.asc("row")]
    salt = F.pmod(F.xxhash64("fid", "row"), F.lit(SALTS))
    some = Window.partitionBy("block", "item", "salt").orderBy(*order)
    every = Window.partitionBy("block", "item").orderBy(*order)
    hits = hits.withColumn("salt", salt).withColumn("rank", F.row_number().over(some)).filter(
        F.col("rank") <= k)
    return hits.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


__all__ = ["Block", "block_hits", "blocks", "length_factor", "search", "statistics", "terms", "weight"]
