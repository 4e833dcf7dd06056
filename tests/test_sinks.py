import datetime as dt

import pytest
from pyspark.sql import functions as F

from marksman.operators import scorecard, sinks
from marksman.plans import jobs, scoring
from marksman.plans.sizing import scratch_path
from marksman.sources import rows_as_dicts
from tests import golden

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def scores(spark):
    return scoring.score_traders(golden.markets(spark), golden.fills(spark),
                                 golden.INTERMEDIARIES).cache()


def test_upsert_inserts_overwrites_and_keeps(spark, scores):
    first = sinks.coerce_scorecard(scores.where("wallet_address IN ('W1', 'W2')"))
    t = sinks.upsert(sinks.empty_target(spark), first, now=T0)
    second = sinks.coerce_scorecard(
        scores.where("wallet_address IN ('W1', 'W3')").withColumn("profit_usdc", F.lit(9.0)))
    out = {r.wallet_address: r for r in sinks.upsert(t, second, now=T1).collect()}
    assert set(out) == {"W1", "W2", "W3"}
    old = {r.wallet_address: r for r in t.collect()}
    assert out["W1"].profit_usdc == 9.0
    assert out["W1"].created_at == old["W1"].created_at and out["W1"].updated_at == T1
    assert out["W1"].id == old["W1"].id
    assert out["W2"] == old["W2"]
    assert out["W3"].created_at == T1 and out["W3"].updated_at == T1
    ids = [r.id for r in out.values()]
    assert len(set(ids)) == 3


def test_upsert_null_in_batch_overwrites(spark, scores):
    t = sinks.upsert(sinks.empty_target(spark), sinks.coerce_scorecard(scores), now=T0)
    batch = sinks.coerce_scorecard(scores.where("wallet_address = 'W1'")).withColumn(
        "first_trade_at", F.lit(None).cast("timestamp_ntz"))
    out = {r.wallet_address: r for r in sinks.upsert(t, batch, now=T1).collect()}
    assert out["W1"].first_trade_at is None


def test_upsert_twice_only_moves_updated_at(spark, scores):
    b = sinks.coerce_scorecard(scores)
    t1 = sinks.upsert(sinks.empty_target(spark), b, now=T0)
    t2 = sinks.upsert(t1, b, now=T1)
    strip = lambda df: sorted(df.drop("updated_at").collect())
    assert strip(t1) == strip(t2)
    assert {r.updated_at for r in t2.collect()} == {T1}


def test_coerce_bytes_wallet_and_defaults(spark):
    df = spark.createDataFrame([(bytearray(b"0xabc\x00\x00"), 3, 1.5, None)],
                               "wallet_address binary, positions_count long, profit_usdc double, "
                               "annual_avg_roi double")
    r = sinks.coerce_scorecard(df).first()
    assert r.wallet_address == "0xabc"
    assert r.positions_count == 3 and r.markets_count == 0
    assert r.annual_avg_roi == 0.0 and r.first_trade_at is None


def test_coerce_null_measure_fails(spark):
    df = spark.createDataFrame([("w", None)], "wallet_address string, profit_usdc double")
    with pytest.raises(Exception, match="NULL value in column profit_usdc"):
        sinks.coerce_scorecard(df).collect()


def test_key_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("x" * 200,), ("ok",)], "wallet_address string")
    got = {(r.wallet_address, r.n) for r in sinks.key_violations(df).collect()}
    assert got == {("a", 2), (None, 1), ("x" * 200, 1)}


@pytest.mark.parametrize("where", ["batch", "target"])
@pytest.mark.parametrize("keys", [["a", "a"], [None], ["x" * 200]])
def test_upsert_fails_on_broken_keys(spark, keys, where):
    def rows(ks):
        return sinks.coerce_scorecard(spark.createDataFrame(
            [(k, 1.0) for k in ks], "wallet_address string, profit_usdc double"))

    good = sinks.upsert(sinks.empty_target(spark), rows(["ok"]), now=T0)
    bad = good.withColumn("wallet_address", F.explode(F.array(*map(F.lit, keys))))
    with pytest.raises(Exception, match="key constraint broken"):
        if where == "batch":
            sinks.upsert(good, rows(keys), now=T1).collect()
        else:
            sinks.upsert(bad, rows(["ok"]), now=T1).collect()


def test_upsert_has_one_exchange(spark, scores, monkeypatch):
    plans = []
    real = sinks.checkpointed
    monkeypatch.setattr(sinks, "checkpointed", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df))
    b = sinks.coerce_scorecard(scores)
    t = sinks.upsert(sinks.empty_target(spark), b, now=T0)
    plans.clear()
    root = scratch_path(spark, "test-exchange")
    stored = []
    for name, df in (("t", t), ("b", b)):
        df.write.parquet(f"{root}/{name}")
        stored.append(spark.read.schema(df.schema).parquet(f"{root}/{name}"))
    out = sinks.upsert(*stored, now=T1)
    assert plans[0].count("Exchange hashpartitioning") == 1 and "Join" not in plans[0]
    assert "SortAggregate" not in plans[0]
    after = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in after


def test_snapshot_versions(spark, scores):
    root = scratch_path(spark, "test-snap")
    assert sinks.current_version(spark, root) is None
    assert sinks.read_snapshot(spark, root).count() == 0
    b = sinks.coerce_scorecard(scores)
    v1 = sinks.write_snapshot(sinks.upsert(sinks.read_snapshot(spark, root), b, now=T0), root)
    v2 = sinks.write_snapshot(sinks.upsert(sinks.read_snapshot(spark, root), b, now=T1), root)
    assert (v1, v2) == (1, 2)
    assert sinks.snapshot_count(sinks.read_snapshot(spark, root)) == 3
    assert {r.updated_at for r in sinks.read_snapshot(spark, root).collect()} == {T1}


def test_refresh_job_and_summary(spark):
    root = scratch_path(spark, "test-refresh")
    s = jobs.refresh(spark, golden.markets(spark), golden.fills(spark), root,
                     intermediaries=golden.INTERMEDIARIES, limit=2, now=T0)
    assert (s["users_processed"], s["users_stored"], s["total_users_in_db"]) == (2, 2, 2)
    s = jobs.refresh(spark, golden.markets(spark), golden.fills(spark), root,
                     intermediaries=golden.INTERMEDIARIES, limit=3, now=T1)
    assert s["total_users_in_db"] == 3
    assert "elapsed_seconds" in s


def test_refresh_empty_input_writes_nothing(spark):
    root = scratch_path(spark, "test-empty")
    s = jobs.refresh(spark, golden.markets(spark), golden.fills(spark).where("false"), root,
                     intermediaries=golden.INTERMEDIARIES, now=T0)
    assert (s["users_processed"], s["users_stored"]) == (0, 0)
    assert "total_users_in_db" not in s
    assert sinks.current_version(spark, root) is None


def test_rows_as_dicts_is_bounded(spark, scores):
    top = scorecard.top(scores, 2)
    rows = rows_as_dicts(top, 10)
    assert [r["wallet_address"] for r in rows] == ["W1", "W3"]
    with pytest.raises(ValueError):
        rows_as_dicts(scores, 2)


def test_stamps_are_session_wall_clock(spark, scores):
    """A naive ``now`` is wall-clock time in the session zone, whatever the
    driver process's zone; an aware one keeps its instant."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = sinks.upsert(sinks.empty_target(spark), sinks.coerce_scorecard(scores), now=T1)
        assert out.select(F.col("updated_at").cast("timestamp_ntz").alias("u")).first().u == T1
        aware = dt.datetime(2024, 2, 1, 5, 0, tzinfo=dt.timezone.utc)
        out = sinks.upsert(sinks.empty_target(spark), sinks.coerce_scorecard(scores), now=aware)
        assert out.select(F.col("updated_at").cast("timestamp_ntz").alias("u")).first().u == T1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_job_entry_point(spark):
    root = scratch_path(spark, "test-cli")
    golden.markets(spark).write.parquet(f"{root}/markets")
    golden.fills(spark).write.parquet(f"{root}/fills")
    s = jobs.main(["--markets", f"{root}/markets", "--fills", f"{root}/fills",
                   "--target", f"{root}/target", "--limit", "2", "--intermediary", "EX"])
    assert (s["users_processed"], s["total_users_in_db"]) == (2, 2)
    assert sinks.current_version(spark, f"{root}/target") == 1


@pytest.mark.parametrize("step", ["write", "rename", "expire"])
def test_a_crash_at_any_step_leaves_the_target_writable(spark, scores, monkeypatch, step):
    root = scratch_path(spark, "test-crash")
    b = sinks.coerce_scorecard(scores)
    t = sinks.upsert(sinks.empty_target(spark), b, now=T0)
    assert sinks.write_snapshot(t, root) == 1

    def dead(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step == "write":  # some files of the version are there
            t.limit(1).write.parquet(f"{root}/_next")
        else:
            m.setattr(sinks, "_renamed" if step == "rename" else "_expired", dead)
            with pytest.raises(KeyboardInterrupt):
                sinks.write_snapshot(sinks.upsert(t, b, now=T1), root, run="r2")
    published = step == "expire"
    assert sinks.current_version(spark, root) == 1 + published
    stamps = {r.updated_at for r in sinks.read_snapshot(spark, root).collect()}
    assert stamps == {T1 if published else T0}
    assert sinks.write_snapshot(sinks.upsert(t, b, now=T1), root, run="r2") == 2
    assert sinks.snapshot_count(sinks.read_snapshot(spark, root)) == 3
    fs, p = sinks._fs(spark, root)
    assert sorted(x.getPath().getName() for x in fs.listStatus(p)) == [
        "version=000001-" + sinks.versions(spark, root)[1], "version=000002-r2"]


@pytest.mark.parametrize("step", ["upsert", "_renamed", "snapshot_count"])
def test_a_retried_run_is_one_version(spark, monkeypatch, step):
    root = scratch_path(spark, "test-retry")
    args = (spark, golden.markets(spark), golden.fills(spark), root)
    kw = dict(intermediaries=golden.INTERMEDIARIES, limit=3, now=T0)
    jobs.refresh(*args, **kw, run="first")

    def dead(*a, **k):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(sinks, step, dead)
        with pytest.raises(KeyboardInterrupt):
            jobs.refresh(*args, **(kw | {"now": T1}), run="second")
    s = jobs.refresh(*args, **(kw | {"now": T1}), run="second")
    assert (s["users_stored"], s["total_users_in_db"]) == (3, 3)
    assert sinks.versions(spark, root) == {1: "first", 2: "second"}
    rows = sinks.read_snapshot(spark, root).collect()
    assert sorted(r.id for r in rows) == [1, 2, 3] and {r.updated_at for r in rows} == {T1}
    with pytest.raises(ValueError):
        sinks.write_snapshot(sinks.empty_target(spark), root, run="a/b")


def test_a_published_run_is_not_scored_again(spark, monkeypatch):
    """The retry reports what its version stored, not a batch that is not stored."""
    root = scratch_path(spark, "test-published")
    kw = dict(intermediaries=golden.INTERMEDIARIES, now=T0, run="daily")
    args = (spark, golden.markets(spark), golden.fills(spark), root)
    assert jobs.refresh(*args, **kw, limit=3)["users_stored"] == 3
    s = jobs.refresh(*args, **kw, limit=1)
    assert (s["users_processed"], s["users_stored"], s["total_users_in_db"]) == (3, 3, 3)


def test_success_markers_do_not_matter(spark, scores):
    root = scratch_path(spark, "test-nosuccess")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        b = sinks.coerce_scorecard(scores)
        sinks.write_snapshot(sinks.upsert(sinks.empty_target(spark), b, now=T0), root)
        one = sinks.coerce_scorecard(scores.where("wallet_address = 'W1'"))
        merged = sinks.upsert(sinks.read_snapshot(spark, root), one, now=T1)
        sinks.write_snapshot(merged, root)
        rows = {r.wallet_address: r for r in sinks.read_snapshot(spark, root).collect()}
        assert len(rows) == 3 and rows["W1"].created_at == T0 and rows["W1"].updated_at == T1
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_old_versions_expire(spark, scores):
    root = scratch_path(spark, "test-expire")
    t = sinks.upsert(sinks.empty_target(spark), sinks.coerce_scorecard(scores), now=T0)
    for _ in range(5):
        sinks.write_snapshot(t, root, keep=2)
    assert sorted(sinks.versions(spark, root)) == [4, 5]


def test_ids_have_no_gaps(spark):
    def batch(low, high):
        return sinks.coerce_scorecard(spark.range(low, high).repartition(7).select(
            F.concat(F.lit("w"), "id").alias("wallet_address"), F.lit(1.0).alias("profit_usdc")))

    t = sinks.upsert(sinks.empty_target(spark), batch(0, 1000), now=T0)
    assert sorted(r.id for r in t.collect()) == list(range(1, 1001))
    t2 = sinks.upsert(t, batch(500, 1300), now=T1)
    assert sorted(r.id for r in t2.collect()) == list(range(1, 1301))


def test_the_job_file_starts_from_anywhere(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path
    job = Path(jobs.__file__).resolve()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = lambda *a: subprocess.run([sys.executable, str(job), *a], cwd=tmp_path, env=env,
                                    capture_output=True, text=True, timeout=120)
    assert run("--help").returncode == 0
    missing = run("--markets", "m", "--fills", "f", "--target", "t")
    assert missing.returncode == 2 and "--intermediary" in missing.stderr


def test_limit_zero_is_no_preset(spark):
    root = scratch_path(spark, "test-zero")
    golden.markets(spark).write.parquet(f"{root}/markets")
    golden.fills(spark).write.parquet(f"{root}/fills")
    s = jobs.main(["--markets", f"{root}/markets", "--fills", f"{root}/fills", "--target",
                   f"{root}/target", "--limit", "0", "--intermediary", "EX"])
    assert s["users_processed"] == 0 and sinks.current_version(spark, f"{root}/target") is None


def test_a_cluster_needs_a_checkpoint_folder(monkeypatch):
    from types import SimpleNamespace

    from marksman.plans import sizing
    for master, ok in (("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False),
                       ("yarn", False)):
        made = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None,
                             setCheckpointDir=made.append)
        session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
        if ok:
            assert sizing.checkpoint_dir(session) == made[0]
        else:
            with pytest.raises(RuntimeError):
                sizing.checkpoint_dir(session)
