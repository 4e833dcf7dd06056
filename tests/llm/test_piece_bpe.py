"""Piece encoding against the library."""

import hashlib
from collections import Counter

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from marksman.llm.piece_bpe import PieceEncoder, default_model, encode_decode
from tests.llm.data import documents, hard_cases

LIB = sentencepiece.SentencePieceProcessor(model_file=default_model())
OWN = PieceEncoder.from_file(default_model())


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(st.sampled_from("abetinghr  ▁.,\n0é日🙂"), max_size=50), st.text(max_size=30)))
def test_ids_are_the_library_s(text):
    assert OWN.encode(text).tolist() == LIB.encode(text)


def test_long_units():
    for text in ("a" * 4000, "ab" * 3000, "then" * 999 + "e", " " * 300, "=" * 2500, "0" * 999):
        assert OWN.encode(text).tolist() == LIB.encode(text)


def test_backtracking_in_a_tiny_vocabulary():
    # merges: ab, then bc (better), abc never forms "ab"+"c"
    pieces = {p: (i, s) for i, (p, s) in enumerate(
        [("a", 0), ("b", 0), ("c", 0), ("▁", 0), ("bc", -1), ("ab", -2), ("cab", -3)])}
    enc = PieceEncoder(pieces, list(range(100, 356)))
    names = {i: p for p, (i, _) in pieces.items()}
    for text in ("abc", "cabc", "ababc", "bcab", "abab", "ccab", "cabab"):
        got = [names[i] for i in enc.encode(text).tolist()]
        assert got == enc._merged("▁" + text), text


def test_every_document(spark, tmp_path):
    docs = documents(spark, tmp_path)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t in hard_cases():
        ids = LIB.encode(t or "")
        want[i, len(ids), sha(",".join(map(str, ids))), sha(LIB.decode(ids))] += 1
    assert Counter(map(tuple, encode_decode(docs).collect())) == want
    assert encode_decode(docs.filter("false")).collect() == []
