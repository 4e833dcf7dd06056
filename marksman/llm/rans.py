"""Token ids in files coded by a static range asymmetric numeral system.

Whole documents are encoded to ids (``end_id`` closes each), counted over the
whole corpus into one shared frequency table, range-partitioned and sorted by
document id, and written as a table of self-contained segments:

* a segment holds whole documents (it closes at the first document end at or
  after ``segment_tokens`` ids), with their ids and lengths;
* its ids are cut into independent blocks of ``LANES x STEPS`` ids; the id at
  place t of a block belongs to lane t mod ``LANES``, so a block is ``LANES``
  interleaved coders over one stream of 32-bit words;
* for each block the segment keeps a checkpoint (the lanes' states and the
  place of the block's words), so any block decodes alone and numpy decodes all
  blocks of a segment side by side; a CRC-32 guards each block's ids and the
  whole word stream.

The container of the segments is Parquet, so that Spark's committers and any
store it can write to serve the binary files, and lost tasks are written again.

The coder: 64-bit states in [2^31, 2^63), frequencies summing to
2^``SCALE_BITS``, 32-bit renormalisation. Every id that occurs has a frequency
of at least one, so every corpus can be coded.

Edge cases: null or empty text is just ``end_id``; an empty table writes no
segment and returns no row; rows that share an id or lack one (null, first) are
all coded, in the order of their ids' bytes; other columns are ignored. A very
long document makes a long segment, its blocks are coded a group at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marksman.llm.common import arrow_rows, map_arrow, scratch_path, text_or_empty
from marksman.llm.tokens import default_vocabulary, tokenizer

LANES = 64
STEPS = 256
BLOCK = LANES * STEPS
SCALE_BITS = 20
SEGMENT_TOKENS = 1 << 21
GROUP_BLOCKS = 128  # blocks coded side by side
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)

TOKENS_SCHEMA = "doc_id long, n_tokens long, ids binary, counts boolean"
SEGMENT_SCHEMA = ("part long, segment long, doc_ids array<long>, doc_tokens array<long>, "
                  "n_tokens long, words binary, words_crc32 long, block_words array<long>, "
                  "block_crc32 array<long>, states binary")
DOCUMENT_SCHEMA = ("part long, segment long, place long, doc_id long, in_segment long, "
                   "n_tokens long, ids_crc32 long")


# ------------------------------------------------------------------- coder

def frequency_table(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to sum to ``2**bits``; every counted id keeps at least 1.
    All zeros (an empty corpus) stay zeros."""
    counts = np.asarray(counts, dtype=np.float64)
    seen = counts > 0
    n = int(seen.sum())
    if n == 0:
        return np.zeros(len(counts), np.uint64)
    room = (1 << bits) - n
    if room < 0:
        raise ValueError("more distinct ids than slots")
    share = counts / counts.sum() * room
    freq = np.floor(share)
    rest = room - int(freq.sum())
    # largest remainders, ties by id
    order = np.argsort(-(share - freq), kind="stable")
    freq[order[:rest]] += 1
    freq[seen] += 1
    return freq.astype(np.uint64)


class Coder:
    """Encodes and decodes blocks with one frequency table."""

    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - bits)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16), self.freq.astype(np.int64))
        self.filler = int(np.argmax(freq))

    def encode(self, ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Words of each block and the states its decoder begins with
        (blocks x lanes). The last block may have fewer steps; its last step
        is filled up with the most frequent id."""
        words, states = [], []
        full = len(ids) // BLOCK
        for at in range(0, full, GROUP_BLOCKS):
            n = min(GROUP_BLOCKS, full - at)
            w, s = self._encode(ids[at * BLOCK:(at + n) * BLOCK].reshape(n, STEPS, LANES))
            words += w
            states.append(s)
        tail = ids[full * BLOCK:]
        if len(tail):
            steps = -(-len(tail) // LANES)
            filled = np.full(steps * LANES, self.filler, ids.dtype)
            filled[:len(tail)] = tail
            w, s = self._encode(filled.reshape(1, steps, LANES))
            words += w
            states.append(s)
        return words, (np.concatenate(states) if states else np.zeros((0, LANES), np.uint64))

    def _encode(self, blocks: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        n, steps, lanes = blocks.shape
        x = np.full((n, lanes), _LOW, np.uint64)
        put = np.zeros((n, steps, lanes), bool)
        low = np.zeros((n, steps, lanes), np.uint32)
        for t in range(steps - 1, -1, -1):
            ids = blocks[:, t, :]
            full = x >= self.limit[ids]
            put[:, t, :] = full
            low[:, t, :] = x.astype(np.uint32)  # the low half
            x = np.where(full, x >> _32, x)
            f = self.freq[ids]
            q = x // f
            x = (q << self.bits) + (x - q * f) + self.start[ids]
        # the decoder refills after step t what the encoder put out before it
        return [low[b][put[b]] for b in range(n)], x

    def decode(self, words: list[np.ndarray], states: np.ndarray, n_tokens: int) -> np.ndarray:
        """All ids of a segment from its blocks' words and states."""
        out = []
        full = n_tokens // BLOCK
        for at in range(0, full, GROUP_BLOCKS):
            n = min(GROUP_BLOCKS, full - at)
            out.append(self._decode(words[at:at + n], states[at:at + n], STEPS).reshape(-1))
        rest = n_tokens - full * BLOCK
        if rest:
            steps = -(-rest // LANES)
            out.append(self._decode(words[full:], states[full:], steps).reshape(-1)[:rest])
        return np.concatenate(out) if out else np.zeros(0, np.uint16)

    def _decode(self, words: list[np.ndarray], states: np.ndarray, steps: int) -> np.ndarray:
        n, lanes = states.shape
        stream = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
        ends = np.cumsum([len(w) for w in words])
        at = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        x = states.astype(np.uint64)
        out = np.empty((n, steps, lanes), np.uint16)
        for t in range(steps):
            slot = x & self.mask
            ids = self.symbol[slot.astype(np.int64)]
            out[:, t, :] = ids
            x = self.freq[ids] * (x >> self.bits) + slot - self.start[ids]
            need = x < _LOW
            place = at[:, None] + np.cumsum(need, axis=1) - 1
            x = np.where(need, (x << _32) | stream[np.where(need, place, len(stream) - 1)], x)
            at = at + need.sum(axis=1)
        if not np.array_equal(at, ends) or not (x == _LOW).all():
            raise ValueError("block does not end in its first state")
        return out


# ---------------------------------------------------------------- segments

def encode_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0,
                     text: str = "text") -> DataFrame:
    """``TOKENS_SCHEMA``: the ids of every document as 16-bit integers, and one
    row a task (``counts`` is true) with how often each id occurred there."""
    path = vocabulary or default_vocabulary()
    end = int(end_id).to_bytes(2, "little")
    names = ["doc_id", "n_tokens", "ids", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for part in arrow_rows(batch, 2048):
                ids = tok.encode_column(part.column(1), end)
                _, offsets, data = ids.buffers()
                offsets = np.frombuffer(offsets, np.int32)[:len(ids) + 1] // 2
                total += np.bincount(np.frombuffer(data, "<u2", offsets[-1]), minlength=1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(np.diff(offsets), pa.int64()),
                     ids, pa.array(np.zeros(len(ids), bool))], names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([0], pa.int64()),
             pa.array([total.tobytes()], pa.binary()), pa.array([True])], names)

    return map_arrow(docs.select("doc_id", text_or_empty(text).alias("text")), run, TOKENS_SCHEMA)


def count_ids(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in the whole corpus: the tasks' counts, summed
    by Spark; at most ``size`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.frombuffer(raw, np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    rows = (map_arrow(tokens.filter("counts").select("ids"), run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(size, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def _segment(coder: Coder, part: int, number: int, docs: list[tuple[int | None, bytes]]) -> dict:
    ids = np.frombuffer(b"".join(raw for _, raw in docs), "<u2")
    words, states = coder.encode(ids)
    stream = b"".join(w.astype("<u4").tobytes() for w in words)
    return {
        "part": part, "segment": number, "doc_ids": [d for d, _ in docs],
        "doc_tokens": [len(raw) // 2 for _, raw in docs], "n_tokens": len(ids),
        "words": stream, "words_crc32": zlib.crc32(stream),
        "block_words": [len(w) for w in words],
        "block_crc32": [zlib.crc32(ids[i:i + BLOCK].tobytes())
                        for i in range(0, len(ids), BLOCK)],
        "states": states.astype("<u8").tobytes(),
    }


_SEGMENT_ARROW = pa.schema([
    ("part", pa.int64()), ("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("words", pa.binary()),
    ("words_crc32", pa.int64()), ("block_words", pa.list_(pa.int64())),
    ("block_crc32", pa.list_(pa.int64())), ("states", pa.binary())])


def segments(tokens: DataFrame, freq: np.ndarray,
             segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """``SEGMENT_SCHEMA``: documents in ascending id order, coded."""
    freq = freq.astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        part = TaskContext.get().partitionId()
        number, held, n = 0, [], 0
        for batch in batches:
            for piece in arrow_rows(batch, 256):
                for doc, raw in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(),
                                    strict=True):
                    held.append((doc, raw))
                    n += len(raw) // 2
                    if n >= segment_tokens:
                        yield pa.RecordBatch.from_pylist(
                            [_segment(coder, part, number, held)], _SEGMENT_ARROW)
                        number, held, n = number + 1, [], 0
        if held:
            yield pa.RecordBatch.from_pylist([_segment(coder, part, number, held)],
                                             _SEGMENT_ARROW)

    ordered = (tokens.filter("not counts").select("doc_id", "ids").repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", "ids"))
    return map_arrow(ordered, run, SEGMENT_SCHEMA)


def _decoded(coder: Coder, row: dict) -> np.ndarray:
    raw = row["words"]
    if zlib.crc32(raw) != row["words_crc32"]:
        raise ValueError("word stream is damaged")
    cuts = np.cumsum(np.array(row["block_words"], np.int64))[:-1]
    words = np.split(np.frombuffer(raw, "<u4"), cuts) if row["block_words"] else []
    states = np.frombuffer(row["states"], "<u8").reshape(-1, LANES)
    ids = coder.decode(words, states, row["n_tokens"])
    for i, crc in enumerate(row["block_crc32"]):
        if zlib.crc32(ids[i * BLOCK:(i + 1) * BLOCK].astype("<u2").tobytes()) != crc:
            raise ValueError("block is damaged")
    return ids


def decode_documents(files: DataFrame, freq: np.ndarray) -> DataFrame:
    """``DOCUMENT_SCHEMA``: every document of the files, decoded and summed."""
    freq = freq.astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                raw = _decoded(coder, row).astype("<u4").tobytes()
                lens = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(lens)
                view = memoryview(raw)
                crc = [zlib.crc32(view[4 * (e - k):4 * e])
                       for e, k in zip(ends.tolist(), lens.tolist(), strict=True)]
                m = len(lens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * m, pa.int64()),
                     pa.array([row["segment"]] * m, pa.int64()),
                     pa.array(range(m), pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(ends - lens), pa.array(lens), pa.array(crc, pa.int64())],
                    ["part", "segment", "place", "doc_id", "in_segment", "n_tokens",
                     "ids_crc32"])

    return map_arrow(files, run, DOCUMENT_SCHEMA)


def segment_starts(files: DataFrame) -> DataFrame:
    """(part, segment, segment_start): ids before each segment. Prefix sums
    within parts, then over one total a part (as many as range partitions)."""
    sizes = files.select("part", "segment", "n_tokens")
    within = Window.partitionBy("part").orderBy("segment")
    before = Window.orderBy("part")
    parts = (sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
             .select("part", (F.sum("total").over(before) - F.col("total")).alias("part_start")))
    return (sizes.withColumn("inner_start",
                             F.sum("n_tokens").over(within) - F.col("n_tokens"))
            .join(parts, "part")
            .select("part", "segment",
                    (F.col("part_start") + F.col("inner_start")).alias("segment_start")))


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None,
                      end_id: int = 0) -> np.ndarray:
    """Encode ``docs`` into segment files below ``path``; returns the shared
    frequency table (also written, to ``path``/frequencies)."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    from tokenizers import Tokenizer
    size = Tokenizer.from_file(vocabulary).get_vocab_size()
    # by kind in folders of their own: the counts are read without the ids
    stored = scratch_path(spark, "token-ids")
    encode_documents(docs, vocabulary, end_id).write.partitionBy("counts").parquet(stored)
    tokens = spark.read.schema(TOKENS_SCHEMA).parquet(stored)
    freq = frequency_table(count_ids(tokens, size))
    segments(tokens, freq).write.parquet(f"{path}/segments")
    (spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq)], "id int, frequency int")
     .coalesce(1).write.parquet(f"{path}/frequencies"))
    return freq


def read_token_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    table = spark.read.parquet(f"{path}/frequencies").orderBy("id").collect()  # one a known id
    freq = np.array([r["frequency"] for r in table], np.uint32)
    files = spark.read.parquet(f"{path}/segments")
    return (decode_documents(files, freq).join(segment_starts(files), ["part", "segment"])
            .select("doc_id", (F.col("segment_start") + F.col("in_segment")).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the files of ``docs`` to a fresh shared folder and read them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_files(spark, path)


__all__ = ["Coder", "count_ids", "decode_documents", "encode_documents", "frequency_table",
           "read_token_files", "segment_starts", "segments", "token_files", "write_token_files"]
