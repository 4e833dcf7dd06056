"""Suffix arrays, and the removal of repeated strings against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marksman.llm import suffix_dedup
from marksman.llm.suffix_array import common_prefixes, suffix_array
from tests.llm.data import COLUMNS, documents, hard_cases, prose


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80) | st.text("ab", min_size=1, max_size=90).map(str.encode),
       st.integers(1, 100), st.integers(1, 40))
def test_suffix_array_and_common_prefixes(raw, depth, cap):
    data = np.frombuffer(raw, np.uint8)
    sa = suffix_array(data, depth)
    assert sorted(sa.tolist()) == list(range(len(raw)))
    padded = [(raw[i:] + b"\0" * depth)[:depth] for i in sa]
    assert padded == sorted(padded)
    shared = common_prefixes(data, sa, cap)
    for k in range(1, len(raw)):
        a, b, n = raw[sa[k - 1]:], raw[sa[k]:], 0
        while n < min(len(a), len(b), cap) and a[n] == b[n]:
            n += 1
        assert shared[k] == n


def brute(texts, length, unit=1, apart=False):
    """Bytes covered by windows that occur twice, per text."""
    where = defaultdict(list)
    for d, b in enumerate(texts):
        for p in range(0, len(b) - length + 1, unit):
            where[b[p:p + length]].append((d, p))
    gone = [np.zeros(len(b), bool) for b in texts]
    for places in where.values():
        if len({d for d, _ in places} if apart else places) > 1:
            for d, p in places:
                gone[d][p:p + length] = True
    return gone


def n_spans(mask):
    return int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())


def check(rows, df, length):
    texts = [(t or "").encode() for _, t in rows]
    gone = brute(texts, length)
    want = Counter((i, b, bytes(np.frombuffer(b, np.uint8)[~m]), n_spans(m))
                   for (i, _), b, m in zip(rows, texts, gone, strict=True))
    got = Counter((r.doc_id, bytes(r["__bytes"]), bytes(r["__kept"]), len(r["__spans"]))
                  for r in df.collect())
    assert got == want
    assert sum(map(np.sum, gone))


def test_hard_cases(spark, tmp_path):
    docs = documents(spark, tmp_path)
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == [*docs.columns, "__bytes", "__kept", "__spans"]
    check(hard_cases(), out, 400)


def shared_rows(seed):
    """Texts around shared passages, periodic ones and ones on few letters."""
    draw = random.Random(seed)
    passages = [prose(draw.randint(10, 60), 1000 + i) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(draw.randint(0, 25), 7 * i + k) for k in range(3)]
        for k in range(draw.randint(0, 3)):
            parts.insert(draw.randint(0, len(parts)), draw.choice(passages))
        rows.append((i, " ".join(parts)))
    rows += [(100, "ab" * 200), (101, "a" * 150), (102, "ab" * 30 + "c" + "ab" * 30)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"SHARD_CONTEXTS": 2}, {"SHARD_BYTES": 300, "PIECE": 256},
                                    {"SHARD_CONTEXTS": 3, "PIECE": 200}])
def test_shards_pieces_and_the_merge(spark, tmp_path, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    rows = shared_rows(4)
    check(rows, suffix_dedup.without_repeats(documents(spark, tmp_path, rows), length=64), 64)


def test_codes_in_other_documents(spark):
    draw = random.Random(5)
    rows = []
    for i in range(12):
        codes = [draw.randrange(3) for _ in range(60)]
        rows.append((1, i, b"".join(c.to_bytes(8, "big") for c in codes)))
    df = spark.createDataFrame(rows, "fid long, row long, data binary")
    found = {r.row: r.spans for r in suffix_dedup.repeated_spans(df, 40, 8, True).collect()}
    gone = brute([r[2] for r in rows], 40, 8, True)
    for i, mask in enumerate(gone):
        got = np.zeros(len(mask), bool)
        for s in found.get(i, []):
            got[s.start:s.end] = True
        # a run that a text repeats in itself is judged at its first place
        assert not (got & ~mask).any()
        assert got.sum() >= 0.9 * mask.sum()


def test_empty(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert suffix_dedup.without_repeats(docs).collect() == []


def thue_morse(n=2048):
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hashes_tell_thue_morse_words_apart():
    one, other = (np.frombuffer(t.encode(), np.uint8) for t in thue_morse())
    both = np.concatenate([one, other])
    hashes = suffix_dedup.Hashes()
    for k in (0, 1):
        a, b = hashes.spans(both, np.array([0, 2048]), np.array([2048, 4096]), k)
        assert a != b


def test_thue_morse_texts_are_no_repeats(spark, tmp_path):
    one, other = thue_morse()
    rows = [(1, one), (2, other), (3, one[:300])]
    check(rows, suffix_dedup.without_repeats(documents(spark, tmp_path, rows), length=300), 300)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**61 - 2), st.integers(0, 2**61 - 2)), min_size=1))
def test_products_modulo_the_prime(pairs):
    a, b = (np.array(x, np.uint64) for x in zip(*pairs, strict=True))
    assert suffix_dedup.product(a, b).tolist() == [x * y % (2**61 - 1) for x, y in pairs]


def test_spans_are_polynomials():
    data = np.random.default_rng(1).integers(0, 256, 500, dtype=np.uint8)
    h = suffix_dedup.Hashes()
    start, end = np.array([0, 3, 490, 250]), np.array([500, 3, 500, 251])
    prime, base = 2**61 - 1, int(h.bases[0])
    want = [sum(int(h.tables[1][c]) * pow(base, i, prime) for i, c in enumerate(data[s:e])) % prime
            for s, e in zip(start, end, strict=True)]
    got = h.spans(data, start, end)
    assert got.tolist() == suffix_dedup.mixed(np.array(want, np.uint64)).tolist()
