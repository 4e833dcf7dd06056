"""Token ids: the word cache, the coded files and the packing."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marksman.llm import packing, rans
from marksman.llm.tokens import WordTokenizer, default_vocabulary
from tests.llm.data import documents, hard_cases

LIB = Tokenizer.from_file(default_vocabulary())
OWN = WordTokenizer(default_vocabulary())
TEXT = st.text(st.sampled_from("ab c de.,!'s\n\t  é日9<|endoftext|>"), max_size=60)


def expected(text):
    return np.array(LIB.encode(text or "", add_special_tokens=False).ids, np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TEXT, st.text(max_size=30)), max_size=5))
def test_words_give_the_library_ids(texts):
    got = [np.frombuffer(x, "<u2").tolist() for x in OWN.encode(texts)]
    assert got == [expected(t).tolist() for t in texts]


def test_added_tokens_are_the_library_ids():
    added = [t.content for t in LIB.get_added_tokens_decoder().values()]
    assert added
    texts = [f"a{a}b" for a in added] + [f"one {a} two  x{a}" for a in added] + [
        a[:-1] for a in added] + [a + a for a in added]
    got = [np.frombuffer(x, "<u2").tolist() for x in OWN.encode(texts)]
    assert got == [expected(t).tolist() for t in texts]
    assert got[0] == [64, 50256, 65]


def test_ids_survive_an_emptied_cache(monkeypatch):
    monkeypatch.setattr("marksman.llm.tokens.MAX_WORDS", 3)
    tok = WordTokenizer(default_vocabulary())
    for _ in range(3):
        for _, t in hard_cases():
            assert np.frombuffer(tok.encode([t or ""])[0], "<u2").tolist() == expected(t).tolist()


def test_lines_and_punctuation_make_no_new_words():
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    draw = random.Random(4)
    texts = ["".join(draw.choice(words) + draw.choice([" ", ", ", ".\n", "!?\n", "*** ", "'\n"])
                     for _ in range(300)) + "end" for _ in range(40)]
    tok = WordTokenizer(default_vocabulary())
    got = [np.frombuffer(x, "<u2").tolist() for x in tok.encode(texts)]
    assert got == [expected(t).tolist() for t in texts]
    assert len(tok.words) < 2 * len(words) + 20  # each after a space and after a newline


def test_columns_are_encoded_in_place():
    texts = ["left out", "", "a.\nb", "a \nb", "a\n\nb c.\r\nd", "x" * 70 + " y", "\nq", "q\n",
             "it's.\n's, 'll", "1.5, 2.\n3!", "a" + "." * 70, "日本.\n語, é!", "left out, too"]
    want = [expected(t).astype("<u2").tobytes() + b"\7\0" for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        assert OWN.encode_column(column.slice(1, 11), b"\7\0").to_pylist() == want[1:12]
        assert OWN.encode_column(column.slice(1, 0)).to_pylist() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 3 * rans.BLOCK), st.integers(1, 60_000), st.integers(0, 2**32 - 1))
def test_blocks_round_trip(n, alphabet, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.geometric(0.01, n) - 1, min(alphabet, 65_535) - 1).astype(np.uint16)
    coder = rans.Coder(rans.frequency_table(np.bincount(np.append(ids, 0), minlength=65_536)))
    words, states = coder.encode(ids)
    assert np.array_equal(coder.decode(words, states, n), ids)
    if n > rans.BLOCK:  # any block alone
        one = coder._decode(words[1:2], states[1:2], min(rans.STEPS, -(-(n - rans.BLOCK) // rans.LANES)))
        assert np.array_equal(one.reshape(-1)[:n - rans.BLOCK], ids[rans.BLOCK:2 * rans.BLOCK])


def test_code_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 400_000) % 50_000).astype(np.uint16)
    counts = np.bincount(ids, minlength=50_000)
    coder = rans.Coder(rans.frequency_table(counts))
    bits = 32 * sum(len(w) for w in coder.encode(ids)[0])
    p = counts[counts > 0] / len(ids)
    assert bits < 1.03 * len(ids) * -(p * np.log2(p)).sum()


def test_frequencies_cover_every_id_and_sum_up():
    counts = np.zeros(1000, np.int64)
    counts[[3, 500, 999]] = [1, 10**12, 7]
    freq = rans.frequency_table(counts)
    assert freq.sum() == 1 << rans.SCALE_BITS and (freq[[3, 500, 999]] >= 1).all()
    assert rans.frequency_table(np.zeros(5)).sum() == 0


def test_damage_is_found():
    ids = np.arange(40_000, dtype=np.uint16)
    coder = rans.Coder(rans.frequency_table(np.bincount(ids, minlength=65_536)))
    row = rans._segment(coder, 0, 0, [(1, ids.astype("<u2").tobytes())])
    assert np.array_equal(rans._decoded(coder, row), ids)
    bad = bytearray(row["words"])
    bad[100] ^= 1
    with pytest.raises(ValueError):
        rans._decoded(coder, row | {"words": bytes(bad)})
    with pytest.raises(ValueError):
        rans._decoded(coder, row | {"words": bytes(bad), "words_crc32": zlib.crc32(bytes(bad))})


def check_files(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = Counter(), 0
    sizes = []
    for i, t in order:
        ids = np.append(expected(t), 0)
        want[i, len(ids), zlib.crc32(ids.astype("<u4").tobytes())] += 1
        sizes.append((i, len(ids)))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_files_hold_every_document(spark, tmp_path, monkeypatch):
    docs = documents(spark, tmp_path)
    check_files(hard_cases(), rans.token_files(docs).collect())
    none = docs.filter("false")
    assert rans.token_files(none).collect() == []


def test_small_segments(spark, tmp_path):
    docs = documents(spark, tmp_path)
    tokens = rans.encode_documents(docs).cache()
    freq = rans.frequency_table(rans.count_ids(tokens, 50_257))
    files = rans.segments(tokens, freq, segment_tokens=50).cache()
    assert files.count() > 10
    got = rans.decode_documents(files, freq).join(rans.segment_starts(files), ["part", "segment"])
    check_files(hard_cases(), got.selectExpr("doc_id", "segment_start + in_segment as start",
                                             "n_tokens", "ids_crc32").collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9), st.integers(0, 20))
def test_best_fill_is_the_closest_sum(lengths, more):
    capacity = max(lengths) + more
    counts = Counter(lengths)
    first = max(lengths)
    rest = list((counts - Counter([first])).elements())
    sums = {0}
    for x in rest:
        sums |= {s + x for s in sums}
    best = first + max(s for s in sums if first + s <= capacity)
    chosen = packing.best_fill(dict(counts), capacity)
    assert all(chosen[k] <= counts[k] for k in chosen) and chosen[first] >= 1
    assert sum(k * n for k, n in chosen.items()) == best


def check_pieces(rows, got, capacity):
    texts = Counter()
    by_doc = {}
    for i, t in rows:
        ids = np.append(expected(t), 0)
        by_doc.setdefault((i, len(ids)), []).append(ids)
        texts[i] += len(ids)
    seen = Counter()
    sequences = {}
    for r in got:
        options = by_doc[r.doc_id, r.doc_tokens]
        assert any(zlib.crc32(x[r.start:r.start + r.length].astype("<u4").tobytes()) == r.ids_crc32
                   for x in options)
        seen[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == texts
    lengths = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        lengths.append(at)
    assert all(n == capacity or (n < capacity and n & (n - 1) == 0) for n in lengths)


@pytest.mark.parametrize(("capacity", "window"), [(1024, 2048), (64, 5), (7, 1)])
def test_pieces_fill_sequences(spark, tmp_path, capacity, window):
    docs = documents(spark, tmp_path)
    got = packing.pack(docs, capacity=capacity, window=window).collect()
    check_pieces(hard_cases(), got, capacity)
    assert packing.pack(docs.filter("false")).collect() == []


def test_windows_leave_no_padding():
    draw = random.Random(3)
    packer = packing.Packer(window=64)
    total = 0
    for i in range(2000):
        n = draw.randint(1, 900)
        total += n
        packer.add(i, np.zeros(n, np.uint16))
    packer.close()
    used = Counter()
    for row in packer.out:
        used[row[5]] += row[2]
    assert sum(used.values()) == total
    assert sum(n != 1024 for n in used.values()) <= 10  # powers of two at the end
    assert len(packer.out) < 1.4 * 2000  # few documents are cut
