"""Ranked search against scoring every document for every item."""

import re
from collections import Counter
from math import floor, log

import pytest

from marksman.llm import max_sketch, oracle, queries
from tests.llm.data import documents, edited, hard_cases, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k=10):
    lists = [terms(t) for _, t in docs]
    n_docs, n_terms = sum(map(bool, lists)), sum(map(len, lists))
    df = Counter(t for x in lists for t in set(x))
    out = Counter()
    for item_id, text in items:
        scores = []
        for (doc_id, _), found in zip(docs, lists, strict=True):
            tf = Counter(found)
            score = 0
            for t in terms(text):
                if tf[t]:
                    w = floor(1000 * log((2.0 * n_docs + 2) / (2.0 * df[t] + 1)))
                    m = 100 - 75 + 75 * len(found) * n_docs // n_terms
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1):
            out[item_id, rank, None if none else i, -s] += 1
    return out


def items(spark, rows):
    return spark.createDataFrame([(i, t, t, 1, 2) for i, t in rows],
                                 "item_id long, text string, term string, score long, fid long")


QUERIES = [(1, prose(30, 1)), (2, None), (3, ""), (4, "über über STRASSE 日本語のテキスト"),
           (5, "nosuchword anywhere"), (6, edited(prose(120, 2), 9, 3)), (None, "one two two"),
           (8, "a b c d"), (9, "x" * 1500), (10, prose(400, 7))]


@pytest.mark.parametrize("k", [1, 3, 10, 100])
def test_equals_scoring_everything(spark, tmp_path, k):
    docs = documents(spark, tmp_path)
    got = Counter(map(tuple, max_sketch.search(docs, items(spark, QUERIES), k).collect()))
    assert got == brute(hard_cases(), QUERIES, k)


def test_many_documents_blocks_and_ties(spark, tmp_path, monkeypatch):
    rows = [(i, prose(20 + i % 7, i % 60)) for i in range(900)]  # copies: equal scores
    asked = [(i, prose(15, i)) for i in range(40)]
    monkeypatch.setattr(max_sketch, "SALTS", 3)
    docs = documents(spark, tmp_path, rows)
    monkeypatch.setattr(max_sketch.blocks, "__defaults__", (7, 1 << 20))
    got = Counter(map(tuple, max_sketch.search(docs, items(spark, asked)).collect()))
    assert got == brute(rows, asked)
    monkeypatch.setattr(max_sketch.blocks, "__defaults__", (1000, 10))
    assert [len(b.ids) for b in max_sketch.blocks(items(spark, asked[:5]))] == [1] * 5


def test_bounds_hold_and_spare_work():
    docs = [prose(200, i).encode() for i in range(300)]
    block = max_sketch.Block([0], [Counter(max_sketch.terms(prose(30, 5).encode() + b" rare"))])
    df = Counter(t for d in docs for t in set(max_sketch.terms(d)))
    weights = {t: max_sketch.weight(len(docs), df[t]) for t in block.vocabulary()}
    search = max_sketch._Search(block, weights, len(docs), 200 * len(docs), 3)
    counts = [Counter(max_sketch.terms(d)) for d in docs]
    factors = [max_sketch.length_factor(200, len(docs), 200 * len(docs))] * len(docs)
    sketch = search.sketch(counts, factors)
    bound = search.weights[0] @ sketch[search.places[0]]
    for c, m, b in zip(counts, factors, bound, strict=True):
        assert b >= sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t, w in search.items[0] if c[t])
    search.add(list(range(300)), [0] * 300, [0] * 300, docs)
    assert search.scored < 300 and len(search.best[0]) == 3


def test_empty_tables(spark, tmp_path):
    docs = documents(spark, tmp_path)
    none = items(spark, []).limit(0)
    assert max_sketch.search(docs, none).collect() == []
    assert max_sketch.search(docs.limit(0), items(spark, QUERIES)).collect() == []
    empty = documents(spark, tmp_path, [(1, None), (2, "")], "empty")
    assert max_sketch.search(empty, items(spark, QUERIES)).collect() == []


def test_query_and_sql(spark):
    from tools.oracle_check import canon, duck
    sf = "/root/testdata/sf0.001"
    df = queries.op11_ranked_search(spark, sf)
    want = duck(sf).execute(oracle.RANKED_SEARCH)
    assert canon(df.columns, df.collect()) == canon([c[0] for c in want.description], want.fetchall())
