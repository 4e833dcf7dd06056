"""The prefix trie against one built turn by turn."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marksman.llm import oracle, prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, words long, part int, seq string"


def digest(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).hexdigest()


def trie(rows):
    """Nodes of (conv_id, turn, role, text) rows."""
    own = {}
    for c, n, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((n is not None, n or 0, digest(role, text), role or "",
                                          text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = own.get(c - int(np.fmod(c, 20)), [])[:h]
        members[c] = tuple(lead + ts[h:])
    nodes = {}
    for c, ts in members.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    children = Counter(p[:-1] for p in nodes if p)
    out = []
    for p, of in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode().split()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(of) if len(members[c]) == len(p))
        out.append((min(of), len(p), min(nodes[p[:-1]]) if p else None, len(of), children[p],
                    sum(not children[q] for q in below), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], SCHEMA).repartition(3)
    got = prefix_trie.prefix_nodes(prefix_trie.rebuilt(prefix_trie.turns(df)))
    return sorted(map(tuple, got.collect()), key=str)


def sample(n, seed, few=3):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-45, 400), n):
        for t in range(draw.choice([1, 1, 2, 3, 3, 5])):
            rows.append((c, t, draw.choice(["user", "bot"]) if few > 1 else "user",
                         "word " * draw.randrange(few) + "end"))
    return rows


HARD = [(None, 0, "user", "lost"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, "", ""),
        (5, 7, "user", "a b\tc d"), (6, 1, "user", "x"), (6, 1, "user", "x"), (2**62, 0, "u", "big"),
        (-7, 0, "user", "minus"), (41, 0, "user", "no leader"), (60, 3, "user", "w " * 40_000)]


@pytest.mark.parametrize("least", [1 << 12, 16, 1])
def test_equals_the_trie(spark, monkeypatch, least):
    """Whole, and cut into parts so small that most nodes cross edges."""
    monkeypatch.setattr(prefix_trie, "LEAST_TURNS", least)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    rows = sample(150, 1) + HARD
    assert nodes(spark, rows) == trie(rows)


def test_a_group_of_copies_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LEAST_TURNS", 8)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 2)
    rows = [(c, t, "user", f"same {t}") for c in range(90) for t in range(3)]
    rows += [(c, t, "user", f"same {min(t, 2)}") for c in range(100, 115) for t in range(5)]
    assert nodes(spark, rows) == trie(rows)


def test_conversations_without_turns(spark):
    rows = [(c, 0, "user", "only") for c in range(21, 40)]  # no conversation 20
    out = nodes(spark, rows)
    assert out == trie(rows) and any(r[1] == 0 and r[3] == 19 for r in out)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_nodes(prefix_trie.rebuilt(prefix_trie.turns(df))).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.data())
def test_extents(shared, data):
    values = np.array([-1, *shared, -1])
    n = len(values) - 1
    place = np.array(data.draw(st.lists(st.integers(0, n - 1), min_size=1, max_size=20)))
    depth = np.array([data.draw(st.integers(0, 6)) for _ in place])
    left, right = prefix_trie.extents(prefix_trie.sparse_table(values), n, place, depth)
    for p, d, lo, hi in zip(place, depth, left, right, strict=True):
        a = b = p
        while a > 0 and values[a] >= d:
            a -= 1
        while b < n - 1 and values[b + 1] >= d:
            b += 1
        assert (lo, hi) == (a, b)
    table = prefix_trie.sparse_table(values)
    low, high = np.minimum(left, right), np.maximum(left, right)
    assert prefix_trie.range_least(table, low, high).tolist() == [
        values[a:b + 1].min() for a, b in zip(low, high, strict=True)]


def test_query_and_sql(spark):
    from tools.oracle_check import canon, duck
    sf = "/root/testdata/sf0.01"
    df = queries.op13_prefix_trie(spark, sf)
    want = duck(sf).execute(oracle.PREFIX_TRIE)
    assert canon(df.columns, df.collect()) == canon([c[0] for c in want.description], want.fetchall())
