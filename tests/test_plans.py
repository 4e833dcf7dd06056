"""Physical plan checks: no Python UDFs, pushdown, size-checked broadcast."""

import pytest

from marksman.operators import ledger
from marksman.plans import scoring
from marksman.sources import fixtures, read_fills, read_markets
from marksman.plans.sizing import scratch_path
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    root = scratch_path(spark, "plan-inputs")
    fixtures.markets(spark, SF_SMALL).write.parquet(f"{root}/markets")
    fixtures.fills(spark, SF_SMALL).write.parquet(f"{root}/fills")
    return read_markets(spark, f"{root}/markets"), read_fills(spark, f"{root}/fills")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_and_pushdown(inputs):
    m, f = inputs
    p = plan(scoring.top_traders(m, f, fixtures.INTERMEDIARIES, limit=100))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "TakeOrderedAndProject" in p
    assert "PushedFilters: [IsNotNull(is_deleted), EqualTo(is_deleted,0)" in p
    assert "Or(EqualTo(maker_asset_id,0),EqualTo(taker_asset_id,0))" in p


def test_scan_reads_only_needed_columns(inputs):
    m, f = inputs
    p = plan(scoring.score_traders(m, f, fixtures.INTERMEDIARIES))
    # end_date_iso and the outcome labels are never read by the scorecard
    assert "end_date_iso" not in p
    assert "ReadSchema: struct<condition_id:string,tokens:array<struct<token_id:string>>>" in p


def test_listing_join_broadcast_under_bound(inputs):
    m, f = inputs
    p = plan(scoring.fused_pnl(m, f, fixtures.INTERMEDIARIES))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_listing_join_shuffles_over_bound(inputs, spark):
    m, f = inputs
    spark.catalog.clearCache()  # positions held by other tests
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = scoring.fused_pnl(m, f, fixtures.INTERMEDIARIES, broadcast_max_rows=10)
        p = plan(df)
        assert "BroadcastExchange" not in p
        small = scoring.fused_pnl(m, f, fixtures.INTERMEDIARIES)
        assert sorted(df.collect()) == sorted(small.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_expansion_is_a_generator_not_a_union(inputs):
    _, f = inputs
    p = plan(ledger.two_sided(f))
    assert "Generate explode([1,2])" in p and "Union" not in p
    assert p.count("FileScan") == 1


def test_every_aggregate_has_a_partial_step(inputs):
    m, f = inputs
    p = plan(scoring.score_traders(m, f, fixtures.INTERMEDIARIES))
    assert "partial_max(struct(priority" in p          # dedupe combines map-side
    assert "partial_sum" in p and "partial_count" in p  # positions and rollup
    assert "Window" not in p                           # no whole-group operator


def shuffled(spark, df) -> list[str]:
    """The exchanges of the plan as it ran, with joins by shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df.collect()
        lines = plan(df).split("Initial Plan")[0].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return [line.strip(" +-:") for line in lines if "Exchange" in line]


def test_positions_and_prices_read_one_shuffle(inputs, spark):
    """No shuffle carries the ledger's two rows a fill; the operations on a token are
    shuffled once, for positions, prices and values alike."""
    m, f = inputs
    ran = shuffled(spark, scoring.score_traders(m, f, fixtures.INTERMEDIARIES,
                                                broadcast_max_rows=10))
    assert not any("hashpartitioning(user_id" in x and "id_#" in x for x in ran)
    dealt = [x for x in ran if "REPARTITION_BY_COL" in x and "hashpartitioning(token_id" in x]
    assert len(dealt) == 2 and sum("ReusedExchange" in x for x in dealt) == 1
    wallets = [x for x in ran if "hashpartitioning(user_id" in x]
    assert len(wallets) == 2  # positions by wallet and share, then their sums


def test_literal_plan_shuffles_fills_once(inputs, spark):
    m, f = inputs
    ran = shuffled(spark, scoring.literal_pnl(m, f, fixtures.INTERMEDIARIES,
                                              broadcast_max_rows=10))
    dealt = [x for x in ran if "hashpartitioning(id_" in x]
    assert sum("ReusedExchange" not in x for x in dealt) == 1


def test_upsert_inputs_score_once(spark):
    import __spark_entry__ as e
    target, batch = e._upsert_inputs(spark, SF_SMALL)
    assert "FileScan" not in plan(batch) and "FileScan" not in plan(target)


@pytest.fixture(scope="module")
def filed(spark):
    """Rows of known size: what is made from Python objects counts as endless."""
    from tests import golden
    root = scratch_path(spark, "golden-inputs")
    golden.markets(spark).write.parquet(f"{root}/markets")
    golden.fills(spark).write.parquet(f"{root}/fills")
    return read_markets(spark, f"{root}/markets"), read_fills(spark, f"{root}/fills")


def few_columns(inputs, **kw):
    """The ad hoc scorecard as its sample reads it: no prices."""
    from marksman.operators import scorecard
    pnl = scoring.fused_pnl(*inputs, ["EX"], with_units=True, **kw)
    return scorecard.adhoc(pnl).select("user_id", "tokens_traded", "total_spent_", "day_exit")


def test_refused_listings_are_not_broadcast_by_estimate(filed):
    """Spark's own estimate puts these rows far below its threshold."""
    small = few_columns(filed)
    assert "BroadcastExchange" in plan(small)
    refused = few_columns(filed, broadcast_max_rows=1)
    assert "BroadcastExchange" not in plan(refused)
    assert sorted(refused.collect()) == sorted(small.collect())


def test_listings_beyond_the_drivers_heap_are_not_broadcast(filed, monkeypatch):
    want = sorted(few_columns(filed).collect())
    monkeypatch.setattr(scoring, "DRIVER_SHARE", 1 << 40)  # a share of under a byte
    refused = few_columns(filed)
    assert "BroadcastExchange" not in plan(refused)
    assert sorted(refused.collect()) == want


def test_drivers_heap_bounds_a_hash_table(spark):
    from marksman.plans.sizing import HASHED_ROW_BYTES, fits_driver
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    rows = heap // HASHED_ROW_BYTES
    assert fits_driver(spark, rows, 0, share=1) and not fits_driver(spark, rows + 1, 0, share=1)
    assert not fits_driver(spark, 0, heap, share=1) and not fits_driver(spark, rows, 0, share=2)
