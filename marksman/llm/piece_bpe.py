"""SentencePiece BPE ids by backtracking, and the text they decode to.

A text is cut before every space mark that follows another character; no piece
holds a space mark after one, so no merge crosses such a cut and each unit has
its own ids (kept in a bounded cache). Characters without a piece become byte
pieces and end a merge region as well.

A region is encoded without simulating its merges:

* one Aho-Corasick pass finds every piece at every place;
* from left to right the longest piece is taken whose pair with the piece
  before it is *compatible*: merging the two pieces' text again, pair by pair
  by score, gives just these two pieces. A sequence in which every neighbouring
  pair is compatible is the one the merges give, and every prefix has only one;
* if no piece fits at a place, the place is marked in a bitfield (it can never
  be part of the result), the last piece is taken back and a shorter one tried.

Compatibility is kept per pair of ids. The vocabulary must be a BPE model with
byte fallback and without user-defined pieces or normalisation.

Edge cases: null or empty text has no ids and decodes to the empty text; an
empty table gives no row; rows that share an id or lack one are encoded one by
one; other columns are ignored; a long unit is encoded in one pass over it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marksman.llm.common import arrow_rows, map_arrow, text_or_empty

SPACE = "▁"
MAX_UNITS = 600_000
MAX_UNIT_CHARS = 64

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """Encodes texts with the pieces and scores of a BPE model."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        """``pieces``: piece -> (id, score); ``byte_ids``: id of each byte."""
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.scores = {p: s for p, (_, s) in pieces.items()}
        self.texts = {i: p for p, (i, _) in pieces.items()}
        self.byte_ids = byte_ids
        self.cut = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.unknown = re.compile("[^" + re.escape("".join(p for p in pieces if len(p) == 1)) + "]")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self._merged(p) == [p]:  # else no merge order ends in it
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.units: dict[str, bytes] = {}
        # all spaces, then what follows them
        self.unit = re.compile(f"{SPACE}+[^{SPACE}]*" if self.cut else "(?s).+")

    @classmethod
    def from_file(cls, path: str) -> PieceEncoder:
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        bytes_ = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        pieces = {lib.id_to_piece(i): (i, lib.get_score(i)) for i in range(n)
                  if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i)
                          or lib.is_unused(i))}
        return cls(pieces, bytes_)

    def _merged(self, text: str) -> list[str]:
        """Merge characters, best score and then leftmost pair first."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, a: int, b: int) -> bool:
        x, y = self.texts[a], self.texts[b]
        ok = self.pairs[a, b] = self._merged(x + y) == [x, y]
        return ok

    def _region(self, text: str) -> list[int]:
        """Ids of a text whose characters all are pieces."""
        n = len(text)
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(text):
            found[end + 1 - match[0]].append(match)  # by growing length
        pairs, failed = self.pairs, 0
        ids: list[int] = []
        left: list[int] = []  # for each id taken, how many shorter ones are left there
        at, choice, last = 0, len(found[0]), -1
        while at < n:
            while choice:
                choice -= 1
                length, i = found[at][choice]
                if failed >> (at + length) & 1:
                    continue
                if last >= 0:
                    ok = pairs.get((last, i))
                    if ok is None:
                        ok = self._compatible(last, i)
                    if not ok:
                        continue
                ids.append(i)
                left.append(choice)
                at += length
                last = i
                choice = len(found[at]) if at < n else 0
                break
            else:
                failed |= 1 << at
                if not ids:
                    raise ValueError("no sequence of pieces makes up this text")
                at -= len(self.texts[ids.pop()])
                choice = left.pop()
                last = ids[-1] if ids else -1
        return ids

    def _unit(self, unit: str) -> bytes:
        ids: list[int] = []
        at = 0
        for m in self.unknown.finditer(unit):
            if at < m.start():
                ids += self._region(unit[at:m.start()])
            ids += [self.byte_ids[b] for b in m.group().encode()]
            at = m.end()
        if at < len(unit):
            ids += self._region(unit[at:])
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text: the library's, without begin and end ids."""
        if not text:
            return np.zeros(0, np.uint32)
        marked = SPACE + text.replace(" ", SPACE)
        if self.cut and SPACE + SPACE not in marked:
            keys = marked.split(SPACE)[1:]
        else:
            keys = [u[1:] for u in self.unit.findall(marked)]
        try:
            raw = b"".join(map(self.units.__getitem__, keys))
        except KeyError:
            known, out = self.units, []
            if len(known) > MAX_UNITS:
                known.clear()
            if len(self.pairs) > MAX_UNITS:
                self.pairs.clear()
            for key in keys:
                ids = known.get(key)
                if ids is None:
                    ids = self._unit(SPACE + key)
                    if len(key) <= MAX_UNIT_CHARS:
                        known[key] = ids
                out.append(ids)
            raw = b"".join(out)
        return np.frombuffer(raw, "<u4")


@lru_cache(maxsize=2)
def _loaded(path: str):
    """This worker's encoder and the library's decoder."""
    import sentencepiece
    return (PieceEncoder.from_file(path),
            sentencepiece.SentencePieceProcessor(model_file=path))


def encode_decode(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """``SCHEMA``: number and digest of each document's ids, and the digest of
    the text that the library decodes from them."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lib = _loaded(path)
        digits = [str(i) for i in range(lib.get_piece_size())]
        for batch in batches:
            for part in arrow_rows(batch):
                n, by_id, by_text = [], [], []
                for x in part.column(1).to_pylist():
                    ids = encoder.encode(x).tolist()
                    n.append(len(ids))
                    joined = ",".join(map(digits.__getitem__, ids))
                    by_id.append(hashlib.sha256(joined.encode()).hexdigest())
                    by_text.append(hashlib.sha256(lib.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(by_id), pa.array(by_text)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select("doc_id", text_or_empty(text).alias("text")), run, SCHEMA)


__all__ = ["PieceEncoder", "default_model", "encode_decode"]
