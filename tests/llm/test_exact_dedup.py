"""Streaming exact dedup against brute force."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from marksman.llm import exact_dedup
from tests.llm.data import COLUMNS, documents, hard_cases


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for ids in groups.values():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        for n, i in enumerate(ids):
            out[i, keep, len(ids), n == len(ids) - 1] += 1
    return out


def result(df):
    return Counter(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept").collect()))


def test_decisions(spark, tmp_path):
    docs = documents(spark, tmp_path)
    assert result(exact_dedup.decisions(docs)) == brute(hard_cases())


def test_texts_under_one_digest_are_told_apart(spark, tmp_path):
    rows = hard_cases() + [(100 + n, f"text {n % 7}") for n in range(40)]
    docs = documents(spark, tmp_path, rows)
    weak = lambda text: (
        F.encode(F.substring(F.sha2(text, 256), 1, 1), "UTF-8"))
    assert result(exact_dedup.decisions(docs, digest=weak)) == brute(rows)


def test_state_goes_on(spark, tmp_path):
    rows = hard_cases()
    root = str(tmp_path / "root")
    first = documents(spark, tmp_path, rows[:12], "first")
    assert result(exact_dedup.decisions(first, root)) == brute(rows[:12])
    second = documents(spark, tmp_path, rows[12:] + rows[:3], "second")
    got = result(exact_dedup.decisions(second, root))
    assert got == brute(rows + rows[:3])


def test_kept_rows_and_columns(spark, tmp_path):
    docs = documents(spark, tmp_path)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in hard_cases()})


def test_rows_that_are_no_files(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, None)], "doc_id long, text string")
    assert result(exact_dedup.decisions(docs)) == brute([(1, "a"), (2, "a"), (2, "a"), (3, None)])


def test_empty(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert exact_dedup.decisions(docs).collect() == []
    assert exact_dedup.deduplicated(docs).collect() == []


def test_no_python_in_the_plan(spark, tmp_path):
    plan = exact_dedup.decisions(documents(spark, tmp_path))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
