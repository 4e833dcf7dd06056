"""One assertion per semantic rule (empty lists, duplicates, NaN, ...)."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marksman import functions as mf
from marksman.operators import ledger, scorecard, valuation
from marksman.plans import scoring
from tests import golden


def _one(spark, expr, schema="x double"):
    return spark.range(1).select(expr.alias("v")).first().v


def test_truncating_decimal(spark):
    df = spark.createDataFrame([(0.129,), (0.29,), (-0.129,), (0.999,)], "x double")
    got = [r.v for r in df.select(mf.trunc_decimal("x").alias("v")).collect()]
    # truncation toward zero; 0.29 * 100 is 28.999... in binary floating point
    assert got == [Decimal("0.12"), Decimal("0.28"), Decimal("-0.12"), Decimal("0.99")]


@pytest.mark.parametrize("x,days,expected", [
    (0.5, 0, 0.0), (1.0, 0, 1.0), (-1.0, 0, 1.0), (2.0, 0, math.inf), (-2.0, 0, math.inf),
    (1.1, 365, 1.1), (4.0, 730, 2.0),
])
def test_annualise(spark, x, days, expected):
    v = _one(spark, mf.annualise(F.lit(x), F.lit(days)))
    assert v == pytest.approx(expected)


def test_annualise_negative_fraction_is_nan(spark):
    assert math.isnan(_one(spark, mf.annualise(F.lit(-0.5), F.lit(2))))
    assert math.isnan(_one(spark, mf.annualise(F.lit(float("nan")), F.lit(0))))


def test_day_diff_counts_calendar_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(mf.day_diff("a", "b").alias("d")).first().d == 1


def test_ratio_or_zero_and_sum_if(spark):
    df = spark.createDataFrame([(1, 0), (3, 4)], "n long, d long")
    got = [r.v for r in df.select(mf.ratio_or_zero("n", "d").alias("v")).collect()]
    assert got == [0.0, 0.75]
    agg = df.agg(mf.sum_if(F.col("n") > 100, F.col("n")).alias("s")).first().s
    assert agg == 0


def test_transaction_id_prefix(spark):
    rows = [("abc", dt.datetime(2024, 1, 1), "A", "B", "0", "T1", 1, 1, 0),
            ("", dt.datetime(2024, 1, 1), "A", "B", "0", "T1", 1, 1, 0),
            ("p_q_r", dt.datetime(2024, 1, 1), "A", "B", "0", "T1", 1, 1, 0)]
    ids = sorted({r.id_ for r in ledger.two_sided(golden.fills(spark, rows)).collect()})
    assert ids == ["", "abc", "p"]


def test_empty_and_null_token_lists_drop(spark):
    rows = [("M1", "c1", [], "", "d"), ("M2", "c2", None, "", "d"),
            ("M3", "c3", [{"token_id": "T", "outcome": "Y"}], "", "d")]
    from marksman.schemas import MARKETS
    out = ledger.market_outcomes(spark.createDataFrame(rows, MARKETS)).collect()
    assert [(r.token_id, r.market_id) for r in out] == [("T", "M3")]


def test_duplicate_listing_fans_out_and_is_valued_per_listing(spark):
    from marksman.schemas import MARKETS
    mk = spark.createDataFrame([
        ("M1", "c1", [{"token_id": "T1", "outcome": "Y"}], "", "d"),
        ("M2", "c2", [{"token_id": "T1", "outcome": "Y"}], "", "d"),
    ], MARKETS)
    fl = golden.fills(spark, [
        ("a_1", dt.datetime(2024, 1, 1), "W1", "W2", "0", "T1", 500000, 1000000, 0)])
    ops = ledger.operations(ledger.two_sided(fl), ledger.market_outcomes(mk))
    assert ops.count() == 4  # two sides x two listings
    for fused in (False, True):
        build = scoring.fused_pnl if fused else scoring.literal_pnl
        rows = {r.user_id: r for r in build(mk, fl, []).collect()}
        # price 0.50 counted once per listing: 2 x 0.50 x 1000000
        assert rows["W1"].unrealized_usdc == Decimal("1000000.00")
        assert rows["W1"].market_id == "M2"


def test_both_sides_cash_is_dropped_by_the_listing_join(spark):
    fl = golden.fills(spark, [
        ("z_1", dt.datetime(2024, 1, 1), "W1", "W2", "0", "0", 5, 5, 0)])
    led = ledger.two_sided(fl).collect()
    assert {r.token_id for r in led} == {"0"}
    assert ledger.operations(ledger.two_sided(fl), ledger.market_outcomes(golden.markets(spark))
                             ).count() == 0


def test_zero_token_trade_sets_no_price(spark):
    fl = golden.fills(spark, [
        ("a_1", dt.datetime(2024, 1, 1), "W1", "W2", "0", "T1", 500000, 1000000, 0),
        ("b_1", dt.datetime(2024, 1, 2), "W1", "W2", "0", "T1", 500000, 0, 0),
        ("c_1", dt.datetime(2024, 1, 1), "W3", "W4", "0", "T3", 5, 0, 0),
    ])
    ops = ledger.operations(ledger.two_sided(fl), ledger.market_outcomes(golden.markets(spark)))
    prices = {r.token_id: r.last_price for r in valuation.last_price(ops).collect()}
    assert prices == {"T1": Decimal("0.50"), "T3": None}
    rows = {(r.user_id, r.token_id): r for r in
            scoring.fused_pnl(golden.markets(spark), fl, []).collect()}
    assert rows[("W3", "T3")].unrealized_usdc == Decimal("0.00")


def test_null_winner_counts_as_open(spark):
    from marksman.schemas import MARKETS
    mk = spark.createDataFrame([
        ("M1", "c1", [{"token_id": "T1", "outcome": "Y"}], None, "d")], MARKETS)
    fl = golden.fills(spark, [
        ("a_1", dt.datetime(2024, 1, 1), "W1", "W2", "0", "T1", 250000, 1000000, 0)])
    rows = {r.user_id: r for r in scoring.literal_pnl(mk, fl, []).collect()}
    assert rows["W1"].unrealized_usdc == Decimal("250000.00")


def test_sold_only_and_negative_balance(spark):
    rows = {(r.user_id, r.token_id): r for r in
            scoring.fused_pnl(golden.markets(spark), golden.fills(spark),
                              golden.INTERMEDIARIES).collect()}
    w2 = rows[("W2", "T1")]
    assert w2.total_spent == 0 and w2.relative_profit == 0.0
    assert w2.unrealized_usdc < 0


def test_nan_sorts_after_numbers(spark):
    df = spark.createDataFrame(
        [("a", float("nan")), ("b", 1.0), ("c", 5.0), ("d", None)], "wallet_address string, profit_usdc double")
    assert [r.wallet_address for r in scorecard.top(df, 4).collect()] == ["c", "b", "a", "d"]


def test_top_breaks_ties_by_wallet(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)],
                               "wallet_address string, profit_usdc double")
    assert [r.wallet_address for r in scorecard.top(df, 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("rows,n", [(5000, 50), (200_000, 100)])
def test_top_by_groups_matches_top(spark, rows, n):
    # many ties (1000 distinct profits): the threshold keeps every tied row
    df = spark.range(0, rows).select(
        F.concat(F.lit("w"), F.col("id").cast("string")).alias("wallet_address"),
        ((F.col("id") * 7919) % 1000).cast("double").alias("profit_usdc"))
    exact = [r.wallet_address for r in scorecard.top(df, n).collect()]
    got = [r.wallet_address for r in scorecard.top_by_groups(df, n).collect()]
    assert got == exact


def test_long_intermediary_list_as_anti_join(spark):
    ops = ledger.operations(ledger.two_sided(golden.fills(spark)),
                            ledger.market_outcomes(golden.markets(spark)))
    by_list = ledger.exclude_intermediaries(ops, ["EX", "W2"])
    by_df = ledger.exclude_intermediaries(
        ops, spark.createDataFrame([("EX",), ("W2",)], "user_id string"))
    assert sorted(by_list.collect()) == sorted(by_df.select(*by_list.columns).collect())


def test_long_ids_take_the_same_plan(spark):
    """77-digit token ids: the same rows and as many jobs to build the plan."""
    from marksman.schemas import FILLS, MARKETS
    long_id = {t: str(10**76 + i) for i, t in enumerate(["T1", "T2", "T3", "T4", "T5"])}
    mk = [(q, c, [{"token_id": long_id[t["token_id"]], "outcome": t["outcome"]} for t in toks],
           long_id.get(w, w), e) for q, c, toks, w, e in golden.MARKET_ROWS]
    fl = [(i, ts, mk_, tk, long_id.get(a, a), long_id.get(b, b), x, y, d)
          for i, ts, mk_, tk, a, b, x, y, d in golden.FILL_ROWS]
    m, f = spark.createDataFrame(mk, MARKETS), spark.createDataFrame(fl, FILLS)
    status = spark.sparkContext.statusTracker()

    def built(group, markets, fills):
        spark.sparkContext.setJobGroup(group, group)
        try:
            return scoring.fused_pnl(markets, fills, golden.INTERMEDIARIES)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    long, short = built("long-ids", m, f), built("short-ids", golden.markets(spark),
                                                 golden.fills(spark))
    assert len(status.getJobIdsForGroup("long-ids")) == len(status.getJobIdsForGroup("short-ids"))
    back = {v: k for k, v in long_id.items()}
    assert sorted((r.user_id, back[r.token_id], r.absolute_profit) for r in long.collect()) == \
        sorted((r.user_id, r.token_id, r.absolute_profit) for r in short.collect())


def _ranked(spark, kind, rows):
    i = F.col("id")
    value = ((i * 7919) % 997).cast("double")
    share = {"none": 0, "most": 75, "nearly": 90, "all": 100, "null": 100}[kind]
    gap = F.lit(None).cast("double") if kind == "null" else F.when(
        i % 2 == 0, F.lit(float("nan")))
    return spark.range(0, rows).select(
        F.concat(F.lit("w"), i.cast("string")).alias("wallet_address"),
        F.when((i * 31) % 100 < share, gap if kind != "all" else F.lit(float("nan")))
        .otherwise(value).alias("profit_usdc"))


@pytest.mark.parametrize("kind", ["none", "most", "nearly", "all", "null"])
@pytest.mark.parametrize("n", [1, 50, 700])
def test_top_by_groups_with_nan_and_null(spark, kind, n):
    df = _ranked(spark, kind, 6000).repartition(8).cache()
    exact = [r.wallet_address for r in scorecard.top(df, n).collect()]
    assert [r.wallet_address for r in scorecard.top_by_groups(df, n).collect()] == exact
    df.unpersist()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_amounts_fail_and_never_wrap(spark, ansi):
    fl = golden.fills(spark, [
        ("a_1", dt.datetime(2024, 1, 1), "W1", "W2", "0", "T1", 10**12, 2 * 10**17, 0)])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for build in (scoring.fused_pnl, scoring.literal_pnl):
            with pytest.raises(Exception, match="amount exceeds 64 bits"):
                build(golden.markets(spark), fl, []).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_money_types(spark):
    types = dict(scoring.fused_pnl(golden.markets(spark), golden.fills(spark), []).dtypes)
    for c in ("absolute_profit", "total_gained", "unrealized_usdc"):
        assert types[c] == "decimal(38,4)"


def test_intermediaries_as_a_dataframe(spark):
    m, f = golden.markets(spark), golden.fills(spark)
    listed = spark.createDataFrame([(x,) for x in [*golden.INTERMEDIARIES, None, "no one"]],
                                   "user_id string")
    for fused in (True, False):
        a = scoring.score_traders(m, f, golden.INTERMEDIARIES, fused=fused)
        b = scoring.score_traders(m, f, listed, fused=fused)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_trade_sides_are_the_two_sided_ledger(spark):
    """Narrow trades give the same signed rows, odd fills included."""
    from marksman.schemas import FILLS
    t = dt.datetime(2024, 1, 1)
    assets = [("0", "t1"), ("t1", "0"), ("0", "0"), ("0", None), (None, "0"), ("t1", "t2")]
    fills = spark.createDataFrame(
        [(f"x{i}_1", t, "w1" if i else None, "w2", a, b, 3, 5, 0) for i, (a, b) in
         enumerate(assets)], FILLS)
    cols = ["id_", "user_id", "agent", "timestamp", "operation_type", "token_balance_change",
            "usdc_balance_change", "token_id"]
    was = ledger.signed(ledger.two_sided(fills)).select(*cols)
    now = ledger.trade_sides(ledger.trades(fills)).select(*cols)
    assert was.count() == 10
    assert sorted(map(str, now.collect())) == sorted(map(str, was.collect()))


def test_money_of_a_wallet_beyond_64_bits(spark):
    """Sums of amounts that each fit 64 bits do not wrap."""
    rows = [("w", f"t{i}", f"m{i % 3}", x, x) for i, x in enumerate(
        [2**62, 2**62, 2**62, -5, -(2**33)])]
    pnl = spark.createDataFrame(
        rows, "user_id string, token_id string, market_id string, profit_units bigint, "
        "gained_units bigint").select(
        "*", F.lit(1).cast("bigint").alias("operations_count"),
        F.lit(0.5).alias("relative_profit"), F.lit(7).cast("bigint").alias("total_spent"),
        F.lit(dt.datetime(2024, 1, 1)).alias("day_enter"),
        F.lit(dt.datetime(2024, 1, 2)).alias("day_exit"))
    r = scorecard.rollup(pnl).first()
    assert r.profit_usdc == float(3 * 2**62 - 5 - 2**33) / 1e8
    assert (r.positions_count, r.markets_count, r.avg_roi) == (5, 3, 50.0)
