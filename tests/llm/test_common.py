"""Shared helpers."""

import pytest

from marksman.llm import common


@pytest.mark.parametrize("fits", [True, False])
def test_hot_keys_are_joined_apart(spark, monkeypatch, fits):
    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 7, id) as k")
    table = rows.groupBy("k").count().withColumnRenamed("count", "n").filter("k <> 8")
    want = sorted(map(tuple, rows.join(table, ["k"]).select("id", "k", "n").collect()))
    assert common.hot_keys(table, ["k"]) is None
    monkeypatch.setattr(common, "HOT", 10)
    assert [tuple(r) for r in common.hot_keys(table, ["k"]).collect()] == [(7,)]
    monkeypatch.setattr(common, "broadcast_if_small", lambda df, rows: (df, fits))
    out = common.joined_by_size(rows, table, ["k"]).select("id", "k", "n")
    assert sorted(map(tuple, out.collect())) == want


def test_discard(spark):
    df = common.written(spark.range(3), "test-discard")
    assert df.count() == 3
    common.discard(df)
    path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_kept_until_another_operator():
    common._begin("a")
    first = common.kept("words", dict)
    common._begin("a")
    assert common.kept("words", dict) is first
    common._begin("b")
    assert common.kept("words", dict) is not first


def test_batches_are_bounded_by_bytes(spark):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    texts = spark.range(0, 200, 1, 1).selectExpr("repeat('x', 5000000) as text")
    out = common.map_arrow(texts, run, "n long, size long").collect()
    assert sum(r.n for r in out) == 200 and max(r.size for r in out) < 2 * 5_000_100
