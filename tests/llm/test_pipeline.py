"""The corpus pipeline against its stages' brute force, and its registration."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from marksman.llm import queries, suffix_dedup
from tests.llm.data import documents, hard_cases, prose
from tests.llm.test_near import components
from tests.llm.test_tokens import check_pieces


def later(rows, length):
    """Bytes covered by windows that a document with a smaller id has."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    owner, gone = {}, [None] * len(rows)
    for k in order:
        raw = (rows[k][1] or "").encode()
        gone[k] = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if owner.setdefault(raw[p:p + length], k) != k:
                gone[k][p:p + length] = True
    return gone


def test_stages(spark, tmp_path):
    docs = documents(spark, tmp_path)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]

    def step(name, df):
        out = stages[name](spark, df, "")
        if name != "packing":
            assert out.columns == columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        return spark.read.parquet(path)

    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    one = step("language_id", docs)
    assert Counter(rows(one)) <= Counter(hard_cases())
    two = step("exact_dedup", one)
    assert Counter(t or "" for _, t in rows(two)) == Counter({t or "" for _, t in rows(one)})
    three = step("near_dedup", two)
    assert Counter(i for i, _ in rows(three)) == Counter(
        {k[0]: n for k, n in components(rows(two)).items() if k[3]})
    four = step("suffix_dedup", three)
    before = rows(three)
    gone = later(before, corpus_pipeline.PASSAGE)
    want = Counter()
    for (i, t), mask in zip(before, gone, strict=True):
        left = bytes(b for b, m in zip((t or "").encode(), mask, strict=True) if not m)
        want[i, left.decode(errors="ignore") if mask.any() else t] += 1
    assert Counter(rows(four)) == want
    check_pieces(rows(four), step("packing", four).collect(), 1024)


def test_cuts_at_characters_keep_replacement_characters(spark, tmp_path):
    """The repeated bytes begin and end inside of characters."""
    passage = prose(120, 2)
    docs = documents(spark, tmp_path, [(1, f"own \ufffd one \u00e9{passage}\u00e9 end \ufffd"),
                                       (2, f"two \u0129{passage}\u00e8 last"), (3, "\ufffd")])
    rows = corpus_pipeline.repeats(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in rows} == {
        1: f"own \ufffd one \u00e9{passage}\u00e9 end \ufffd", 2: "two  last", 3: "\ufffd"}
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("limits", [{}, {"SHARD_CONTEXTS": 2}, {"SHARD_BYTES": 300, "PIECE": 256},
                                    {"SHARD_CONTEXTS": 3, "PIECE": 300}])
def test_the_first_document_keeps_a_passage(spark, tmp_path, monkeypatch, limits):
    """No passage leaves the corpus; what a text repeats in itself stays."""
    for k, v in limits.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    passages = [prose(60 + 7 * i, 500 + i) for i in range(5)]
    rows = [(97 * i % 41, " ".join([prose(i % 8, i), passages[i % 5], prose(9, 900 + i),
                                    passages[(i + i // 5) % 5], prose(i % 3, 70 + i)]))
            for i in range(40)]
    rows += [(50 + i, prose(30, 40 + i) + " " + (prose(70, 60) + " ") * 2) for i in range(2)]
    rows += [(60, "ab" * 400), (61, "ab" * 200 + "c" + "ab" * 150), (None, passages[0])]
    docs = documents(spark, tmp_path, rows)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.repeats(spark, docs, "").collect())
    want = Counter()
    for (i, t), mask in zip(rows, later(rows, corpus_pipeline.PASSAGE), strict=True):
        want[i, bytes(b for b, m in zip(t.encode(), mask, strict=True) if not m).decode()] += 1
    assert got == want
    for p in passages:
        assert sum(t.count(p) for _, t in got) >= 1
    assert sum(t.count(prose(70, 60)) for _, t in got) == 2  # twice in one document


def test_empty(spark, tmp_path):
    docs = documents(spark, tmp_path).filter("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == [], name


def test_run_on_the_small_table(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and len({r.doc_id for r in rows}) > 150


def test_registered(spark):
    import __spark_entry__
    names = __spark_entry__.queries()
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(names)
