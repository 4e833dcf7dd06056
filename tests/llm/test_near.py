"""BagMinHash and near-duplicate groups against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from marksman.llm import bag_minhash
from marksman.llm.exact_dedup import located
from tests.llm.data import COLUMNS, documents, edited, hard_cases, prose
from tests.llm.test_suffix import thue_morse


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        n = int(rng.integers(3, 80))
        items = rng.integers(1, 2**62, n).astype(np.uint64)
        a = rng.integers(1, 12, n) * (rng.random(n) < 0.8)
        b = np.where(rng.random(n) < 0.6, a, rng.integers(0, 20, n))
        if not a.sum() or not b.sum():
            continue
        x, y = a > 0, b > 0
        doc = np.concatenate([np.zeros(x.sum(), int), np.ones(y.sum(), int)])
        sig = bag_minhash.bag_minhash(doc, np.concatenate([items[x], items[y]]),
                                      np.concatenate([a[x], b[y]]), 2, 1024)
        errors.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.02


def bag(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    both, total = sum((a & b).values()), sum((a | b).values())
    return both / total if total else 1.0


def components(rows):
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= 0.8:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    low = lambda i: (i is not None, i or 0)
    out = Counter()
    for ids in groups.values():
        ids = sorted(ids, key=low)
        for n, i in enumerate(ids):
            out[i, ids[0], len(ids), n == 0] += 1
    return out


def result(docs):
    return Counter((r.doc_id, r.class_id, r.group_size, r.kept)
                   for r in bag_minhash.decisions(located(docs)).collect())


def test_hard_cases(spark, tmp_path):
    docs = documents(spark, tmp_path)
    assert result(docs) == components(hard_cases())
    kept = bag_minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(k[3] * n for k, n in components(hard_cases()).items())


def families(seed, n_bases, copies):
    """Copies of texts with more and more edits: chains, hubs and outliers."""
    draw = random.Random(seed)
    rows = []
    for b in range(n_bases):
        base = prose(150, 500 + b)
        for _ in range(copies):
            words = base.split()
            for _ in range(draw.randint(0, 9)):
                words[draw.randrange(len(words))] = f"w{draw.random()}"
            rows.append((len(rows), " ".join(words)))
        text = base
        for k in range(6):  # each like the one before only
            text = edited(text, 61, 100 * b + k)
            rows.append((len(rows), text))
    return rows


@pytest.mark.parametrize("turns", [1, 2])
def test_families_and_chains(spark, tmp_path, monkeypatch, turns):
    monkeypatch.setattr(bag_minhash, "PIVOT_TURNS", turns)
    rows = families(3, 4, 25)
    assert result(documents(spark, tmp_path, rows)) == components(rows)


def test_contraction_of_a_long_chain(spark):
    n = 60
    order = list(range(n))
    random.Random(1).shuffle(order)
    labels = spark.createDataFrame([(i, i) for i in range(n + 5)], "node long, label long")
    links = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "u long, v long")
    got = {r.node: r.label for r in bag_minhash.contracted(labels, links).collect()}
    assert got == {i: 0 if i < n else i for i in range(n + 5)}


def test_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == components(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert bag_minhash.decisions(located(docs)).collect() == []
    assert bag_minhash.deduplicated(docs).collect() == []


def test_texts_with_equal_polynomial_hashes_stay_apart(spark, tmp_path):
    """Modulo 2^64 a Thue-Morse word and its complement collide in every base."""
    rows = [(i, t) for i, t in enumerate(thue_morse())]
    out = bag_minhash.deduplicated(documents(spark, tmp_path, rows))
    assert sorted(r.doc_id for r in out.collect()) == [0, 1]
