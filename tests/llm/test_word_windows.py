"""Removal of repeated runs of words against brute force."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marksman.llm import oracle, queries, word_windows
from tests.llm.data import documents, edited, hard_cases, prose


def brute(rows, length):
    """(doc_id, kept, words, removed) of rows in their order; rows of one id apart."""
    words = [(t or "").encode().split() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    seen, gone = set(), [np.zeros(len(w), bool) for w in words]
    for k in order:
        for p in range(len(words[k]) - length + 1):
            w = tuple(words[k][p:p + length])
            if w in seen:
                gone[k][p:p + length] = True
            seen.add(w)
    return Counter((i, b" ".join(w for w, g in zip(ws, m, strict=True) if not g).decode(), len(ws),
                    int(m.sum())) for (i, _), ws, m in zip(rows, words, gone, strict=True))


def got(df, length):
    rows = word_windows.without_repeats(df, length).select("doc_id", "__kept", "__n_words",
                                                           "__n_removed")
    return Counter(map(tuple, rows.collect()))


@pytest.mark.parametrize("length", [4, 20, 40])
def test_hard_cases(spark, tmp_path, length):
    rows = hard_cases()
    df = documents(spark, tmp_path, rows)
    assert got(df, length) == brute(rows, length)
    assert set(df.columns) <= set(word_windows.without_repeats(df, length).columns)


@pytest.mark.parametrize("seed", range(2))
def test_shared_passages(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(word_windows, "PIECE", 64)
    passages = [prose(n, 100 + n) for n in (19, 20, 21, 37, 55)]
    rows = []
    for i in range(60):
        p = passages[i % 5]
        if i % 7 == 3:
            p = edited(p, 11, i)
        rows.append((i * 3 % 61, " ".join([prose(i % 9, i + seed), p, prose(i % 4, 7 * i), p])))
    rows += [(200, "ha " * 90), (201, "ha " * 30 + "ho"), (202, "a b " * 40)]
    assert got(documents(spark, tmp_path, rows), 20) == brute(rows, 20)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=8, max_size=60))
def test_runs_cover_every_window(words):
    h = np.array(words, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    starts = np.arange(len(words) - 7)
    begin, windows, off, *_ = word_windows.find_runs(h, starts, 8)
    assert np.concatenate([b + np.arange(n) for b, n in
                           zip(begin, windows, strict=True)]).tolist() == starts.tolist()
    assert (off - (windows - 1) >= 0).all() and (off <= 6).all()


def test_hash_is_not_linear():
    """Texts that polynomial hashes modulo 2^64 take for equal stay apart."""
    bits = np.array([bin(i).count("1") & 1 for i in range(2048)], np.uint64)
    one, other = (word_windows.levels(b, 512)[2] for b in (bits, 1 - bits))
    assert one[0] != other[0]


def test_empty_table(spark, tmp_path):
    assert word_windows.without_repeats(documents(spark, tmp_path).limit(0)).collect() == []
    with pytest.raises(ValueError):
        word_windows.repeated_spans(spark.range(1), 18)


def test_query_and_sql(spark):
    from tools.oracle_check import canon, duck
    sf = "/root/testdata/sf0.001"
    df = queries.op12_substring_dedup(spark, sf)
    want = duck(sf).execute(oracle.SUBSTRING_DEDUP)
    assert canon(df.columns, df.collect()) == canon([c[0] for c in want.description], want.fetchall())
