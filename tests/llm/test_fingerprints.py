"""Fingerprints against exact similarities and the contract's edited texts."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marksman.llm import fingerprints
from tests.llm.data import COLUMNS, documents, hard_cases


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def test_sf_small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    rows = fingerprints.fingerprints(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by_text, off = {}, []
    for r in rows:
        t, n = texts[r.doc_id], texts[after[r.doc_id]]
        k = len(t) // 3
        new = t[:len(t) - k] + n[:k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        off.append(r.near_edited - jaccard(t, new))
        assert abs(r.near_next - jaccard(t, n)) < 0.25
    assert abs(sum(off) / len(off)) < 0.02
    assert max(map(abs, off)) < 0.25


def test_hard_cases(spark, tmp_path):
    docs = documents(spark, tmp_path)
    rows = fingerprints.fingerprints(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in hard_cases())
    prints = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    for r in docs.select("text", fingerprints.fingerprint(fingerprints.signature(
            F.coalesce("text", F.lit("")))).alias("f")).collect():
        assert prints.setdefault(r.text or "", r.f) == r.f
        assert (r.f == "") == (not (r.text or "").split())
        assert len(r.f) in (0, fingerprints.BINS)
    # the document after the least id is that of the greatest
    ids = sorted((i for i, _ in hard_cases() if i is not None), reverse=True)
    text = dict(hard_cases())
    last = next(r for r in rows if r.doc_id == ids[0])
    t, n = text[ids[0]], text[ids[1]]
    new = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
    assert last.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(4, "abc def ghi")], "doc_id long, text string")
    [r] = fingerprints.fingerprints(docs).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest()


@pytest.mark.parametrize("share", [0.0, 0.3, 0.6, 0.9])
def test_likeness_is_unbiased(spark, share):
    n, same = 300, int(300 * share)
    rows = []
    for k in range(40):
        common = [f"c{k}x{i}" for i in range(same)]
        rows.append((" ".join(common + [f"a{k}x{i}" for i in range(n - same)]),
                     " ".join(common + [f"b{k}x{i}" for i in range(n - same)])))
    sig = fingerprints.signature
    got = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", fingerprints.likeness(sig(F.col("a")), sig(F.col("b"))).alias("l")).collect()
    errors = [r.l - jaccard(r.a, r.b) for r in got]
    assert abs(sum(errors) / len(errors)) < 0.02 + 0.02 * (share == 0)


def test_empty_and_plan(spark, tmp_path):
    assert fingerprints.fingerprints(spark.createDataFrame([], COLUMNS)).collect() == []
    plan = fingerprints.fingerprints(documents(spark, tmp_path))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))
