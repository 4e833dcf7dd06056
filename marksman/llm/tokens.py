"""Byte-level BPE ids through the tokenizers library, one word at a time.

The splitting pattern of a byte-level BPE vocabulary never lets a token run
across a single space that has a non-space on both sides: the match before it
ends there and the next one begins with it. So a text whose spaces are all of
that kind is the concatenation of its words (" word", the first without the
space), and the ids of a word can be kept. Under the pattern of ``ByteLevel`` a
newline between two non-spaces is a piece of its own and parts words, too, and so
is the punctuation that follows a letter at a word's end. Arrow splits a batch of
texts, finds its distinct words and puts their ids in order; words not seen yet
are encoded by the library, many in a call. Texts with other white space beside a
space, or with the content of one of the vocabulary's added tokens (which the
library finds before it splits), go to the library whole. At ``MAX_WORDS`` the
cache keeps only the words of the texts at hand; that costs time, never changes ids.
"""

from __future__ import annotations

import os
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marksman.llm.common import kept

MAX_WORDS = 1_000_000
MAX_WORD_CHARS = 64


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordTokenizer:
    """Encodes texts to unsigned 16-bit ids (this machine's byte order; workers
    are little-endian)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.lib = Tokenizer.from_file(path)
        # words come to the library once each: its own cache would only cost
        self.once = Tokenizer.from_file(path)
        model = self.once.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)
            self.once.model = model
        if self.lib.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        # ids of tokens that begin with a space, with a newline
        self.starts = {" ": np.zeros(1 << 16, bool), "\n": np.zeros(1 << 16, bool)}
        for token, i in self.lib.get_vocab().items():
            self.starts[" "][i] = token.startswith("Ġ")
            self.starts["\n"][i] = token.startswith("Ċ")
        self.newline = self._encode(["\n"])[0]
        split = self.lib.pre_tokenizer
        self.byte_level = (isinstance(split, ByteLevel) and split.use_regex
                           and not split.add_prefix_space and self.lib.normalizer is None)
        self.marks = string.punctuation if self.byte_level else ""
        # words after a space, kept without it, and words after a newline, kept with it
        self.words: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [array("H", e.ids).tobytes()
                for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Put these words into the cache, but for those that a white space begins
        or ends and very long ones."""
        known = self.words
        after = {" ": [], "\n": []}
        for key in new:
            if not key.isalnum() or len(key) > MAX_WORD_CHARS:
                word = key[1:] if key[:1] == "\n" else key
                if (not word or word[0].isspace() or word[-1].isspace()
                        or len(word) > MAX_WORD_CHARS):
                    continue
                if word is not key:
                    after["\n"].append(key)
                    continue
            after[" "].append(key)
        single = [k for k in after["\n"] if not self.byte_level or "\n" in k[1:]]
        for k, ids in zip(single, self._encode([k[1:] for k in single]), strict=True):
            known[k] = self.newline + ids
        if single:
            after["\n"] = list(set(after["\n"]).difference(single))
        for space, keys in after.items():
            for at in range(0, len(keys), 1000):
                some = keys[at:at + 1000]
                known.update(zip(some, self._encode_words(some, space), strict=True))

    def _encode_words(self, words: list[str], space: str) -> list[bytes]:
        """Ids of each word after a space or (kept with it) a newline, by one call:
        encoded as one text, cut before every id whose token begins with that space
        (no other has one)."""
        gap = " " if space == " " else ""
        ids = self.once.encode_batch_fast([gap + gap.join(words)],
                                          add_special_tokens=False)[0].ids
        ids = np.array(ids, dtype=np.uint16)
        cut = np.flatnonzero(self.starts[space][ids])
        if len(cut) != len(words):  # a vocabulary that cuts elsewhere
            return self._encode([gap + w for w in words])
        raw = ids.tobytes()
        ends = [*(2 * cut[1:]).tolist(), len(raw)]
        return [raw[i:j] for i, j in zip((2 * cut).tolist(), ends, strict=True)]

    def _known(self, keys: list[str]) -> list[bytes | None]:
        """The ids of each word; None for those that are not kept."""
        if len(self.words) > MAX_WORDS:  # keep what is in use now
            self.words = {k: self.words[k] for k in keys if k in self.words}
        get = self.words.get
        out = list(map(get, keys))
        new = [i for i, ids in enumerate(out) if ids is None]
        self._learn([keys[i] for i in new])
        for i in new:
            out[i] = get(keys[i])
        return out

    def _closed(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The words without the punctuation that follows a letter at their end,
        which is a piece of its own, and that punctuation (or the empty text)."""
        base = pc.ascii_rtrim(words, characters=self.marks) if self.marks else words
        letter = pc.utf8_is_alpha(pc.utf8_slice_codeunits(base, -1))
        base = pc.if_else(letter, base, words)
        size = pc.binary_length(base).to_numpy()
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1]
        length = np.diff(offsets) - size
        ends = np.append(0, np.cumsum(length)).astype(np.int32)
        place = np.arange(ends[-1]) + np.repeat(offsets[:-1] + size - ends[:-1], length)
        marks = np.frombuffer(data or b"", np.uint8)[place]
        return base, pa.StringArray.from_buffers(
            len(words), pa.py_buffer(ends), pa.py_buffer(marks.tobytes()))

    def encode_column(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of each text as bytes, each followed by ``end``."""
        n, texts = len(texts), texts.cast(pa.string())
        if not n:
            return pa.array([], pa.binary())
        whole = pc.match_substring(texts, " \n").to_numpy(zero_copy_only=False)
        for token in self.added:
            whole = whole | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        lines = texts
        if self.byte_level:  # texts with newlines beside other white space keep them in words
            lines = pc.if_else(pc.match_substring_regex(texts, r"\s\n|\n\s"), texts,
                               pc.replace_substring(texts, "\n", " \n"))
        split = pc.split_pattern(lines, " ")  # a word a text at least
        at = split.offsets.to_numpy().astype(np.int64)
        first, parts = at[:-1], split.values
        heads = ["\n" + w for w in parts.take(pa.array(first)).to_pylist()]
        coded = parts.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int32)
        code[first] = len(coded.dictionary) + np.arange(n)
        base, marks = (x.dictionary_encode() for x in self._closed(
            pa.concat_arrays([coded.dictionary, pa.array(heads, pa.string())])))
        keys = base.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self._known(keys + ["\n" + m for m in marks.dictionary.to_pylist()])
        size, skip = len(keys), len(self.newline)
        endings = [x if x is None else x[skip:] for x in ids[size:]]
        endings = [b"" if not m else x
                   for m, x in zip(marks.dictionary.to_pylist(), endings, strict=True)]
        word = base.indices.to_numpy().astype(np.int32)
        heads = [x if x is None else x[skip:] for x in map(ids.__getitem__, word[-n:])]
        pool = [*ids[:size], *endings, *heads, end, b""]
        word[-n:] = np.arange(len(pool) - 2 - n, len(pool) - 2)
        mark = marks.indices.to_numpy() + np.int32(size)
        # left: texts with white space beside a space, an added token or a very long word
        missing = np.fromiter((x is None for x in pool), bool, len(pool))
        missing = missing[word] | missing[mark]
        word, mark = word[code], mark[code]
        whole = np.flatnonzero(whole | np.logical_or.reduceat(missing[code], first))
        if len(whole):
            own = np.zeros(n, bool)
            own[whole] = True
            own = np.repeat(own, np.diff(at))
            word[own] = mark[own] = len(pool) - 1
            word[first[whole]] = np.arange(len(pool), len(pool) + len(whole))
            pool += self._encode(texts.take(pa.array(whole)).to_pylist())
        pieces = np.insert(np.stack([word, mark], 1).reshape(-1), 2 * at[1:],
                           size + len(endings) + n)
        joined = pa.array(pool, pa.binary()).take(pa.array(pieces))
        _, offsets, data = joined.buffers()
        ends = np.frombuffer(offsets, np.int32)[2 * at + np.arange(n + 1)]
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), data])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker (kept between its tasks)."""
    return kept(f"tokenizer {path}", lambda: WordTokenizer(path))


__all__ = ["WordTokenizer", "default_vocabulary", "tokenizer"]
