"""Stage row counts and top wallets published in FIXTURES.md §3 for the
survey's prototype mapping (40 markets, tokens folded by l_partkey % 40),
reproduced with the Spark stages. The mapping below is that prototype's,
used only here to compare against its published numbers."""

import pytest
from pyspark.sql import functions as F

from marksman.operators import ledger, positions, scorecard, valuation
from marksman.plans import scoring
from marksman.schemas import FILLS, MARKETS
from tests.conftest import SF_SMALL

IMS = ["0xexa", "0xexb"]


SF_MID = "/root/testdata/sf0.01"

# FIXTURES.md §3: fills, ledger, operations, multi-row groups, deduped,
# positions, positions with > 1 operation, with nothing spent, traders,
# (annual avg NaN, inf, annual portfolio NaN, inf, first day = last day),
# top three (wallet, profit)
EXPECTED = {
    SF_SMALL: (6000, 11324, 10726, 2021, 4723, 1997, 769, 721, 150, (1, 0, 13, 0, 0),
               [("w6", 368.155), ("w9", 291.067), ("w7", 276.082)]),
    SF_MID: (60000, 113090, 107412, 16316, 52125, 19960, 7844, 6688, 1500, (32, 1, 159, 1, 2),
             [("w0", 808.168), ("w14", 713.703), ("w49", 645.521)]),
}


def prototype_markets(spark, sf=SF_SMALL):
    part = spark.read.parquet(f"{sf}/part.parquet").where("p_partkey < 40")
    k = F.col("p_partkey").cast("string")
    a, b = F.concat(F.lit("t"), k, F.lit("a")), F.concat(F.lit("t"), k, F.lit("b"))
    size = F.col("p_size") % 3
    cols = {
        "question_id": F.concat(F.lit("m"), k),
        "condition_id": F.when(F.col("p_partkey") % 20 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("c"), k)),
        "tokens": F.array(F.struct(a.alias("token_id"), F.lit("Yes").alias("outcome")),
                          F.struct(b.alias("token_id"), F.lit("No").alias("outcome"))),
        "winner": F.when(size == 1, a).when(size == 2, b).otherwise(F.lit("")),
        "end_date_iso": F.lit("2001-12-31"),
    }
    return part.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in MARKETS])


def prototype_fills(spark, sf=SF_SMALL):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    od = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(od, "l_orderkey")
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    q = F.col("l_quantity").cast("bigint")
    swap, mbuy, ret = q % 17 == 0, F.col("l_linestatus") == "O", F.col("l_returnflag") == "R"
    stem = F.concat(F.lit("t"), (pk % 40).cast("string"))
    tok = F.concat(stem, F.when(ret, F.lit("b")).otherwise(F.lit("a")))
    tok2 = F.concat(stem, F.when(ret, F.lit("a")).otherwise(F.lit("b")))
    tamt, uamt = q * 1000000, q * 1000 * (1 + (ok * 31 + pk * 17 + ln) % 998)
    gives_token = swap | ~mbuy
    cols = {
        "id": F.concat(F.lit("x"), ok.cast("string"), F.lit("_"), ln.cast("string")),
        "timestamp": F.col("l_shipdate"),
        "maker": F.concat(F.lit("w"), F.col("o_custkey").cast("string")),
        "taker": F.when(ln == 7, F.lit("0xexa")).when(ln == 1, F.lit("0xexb"))
        .otherwise(F.concat(F.lit("w"), F.col("l_suppkey").cast("string"))),
        "maker_asset_id": F.when(gives_token, tok).otherwise(F.lit("0")),
        "taker_asset_id": F.when(swap, tok2).when(mbuy, tok).otherwise(F.lit("0")),
        "maker_amount_filled": F.when(gives_token, tamt).otherwise(uamt),
        "taker_amount_filled": F.when(swap | mbuy, tamt).otherwise(uamt),
        "is_deleted": F.when(ok % 50 == 0, F.lit(1)).otherwise(F.lit(0)),
    }
    return j.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in FILLS])


@pytest.fixture(scope="module")
def proto(spark):
    return prototype_markets(spark), prototype_fills(spark)


def test_stage_counts(proto):
    m, f = proto
    assert (m.count(), f.count()) == (40, 6000)
    outcomes = ledger.market_outcomes(m)
    assert outcomes.count() == 76
    led = ledger.two_sided(f)
    assert led.count() == 11324
    ops = ledger.operations(led, outcomes)
    assert ops.count() == 10726
    multi = ops.groupBy("user_id", "id_").count().where("count > 1").count()
    assert multi == 2021
    d = ledger.dedupe_by_priority(ledger.exclude_intermediaries(ops, IMS), IMS)
    assert d.count() == 4723
    pos = positions.positions(d)
    assert pos.count() == 1997
    assert pos.where("operations_count > 1").count() == 769
    assert pos.where("total_spent = 0").count() == 721
    assert valuation.last_price(d).count() == 76


def test_traders_and_top_three(proto):
    m, f = proto
    s = scoring.score_traders(m, f, IMS)
    assert s.count() == 150
    nan = lambda c: F.sum(F.isnan(c).cast("int"))
    inf = lambda c: F.sum((F.col(c) == float("inf")).cast("int"))
    r = s.agg(nan("annual_avg_roi").alias("a"), inf("annual_avg_roi").alias("b"),
              nan("annual_portfolio_roi").alias("c"), inf("annual_portfolio_roi").alias("d"),
              F.sum((F.to_date("first_trade_at") == F.to_date("last_trade_at")).cast("int"))
              .alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (1, 0, 13, 0, 0)
    top = scorecard.top(s, 3).collect()
    got = [(t.wallet_address, t.positions_count, t.markets_count, round(t.profit_usdc, 3),
            round(t.portfolio_roi, 6)) for t in top]
    assert got == [("w6", 75, 38, 368.155, 116.058454), ("w9", 75, 38, 291.067, 114.031044),
                   ("w7", 73, 38, 276.082, 112.608822)]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_published_counts(spark, sf):
    m, f = prototype_markets(spark, sf), prototype_fills(spark, sf)
    (n_fills, n_ledger, n_ops, n_multi, n_dedup, n_pos, n_pos_multi, n_unspent, n_traders,
     special, top3) = EXPECTED[sf]
    outcomes = ledger.market_outcomes(m)
    ops = ledger.operations(ledger.two_sided(f), outcomes)
    d = ledger.dedupe_by_priority(ledger.exclude_intermediaries(ops, IMS), IMS)
    pos = positions.positions(d)
    got = (f.count(), ledger.two_sided(f).count(), ops.count(),
           ops.groupBy("user_id", "id_").count().where("count > 1").count(), d.count(),
           pos.count(), pos.where("operations_count > 1").count(),
           pos.where("total_spent = 0").count())
    assert got == (n_fills, n_ledger, n_ops, n_multi, n_dedup, n_pos, n_pos_multi, n_unspent)
    s = scoring.score_traders(m, f, IMS)
    nan = lambda c: F.sum(F.isnan(c).cast("int"))
    inf = lambda c: F.sum((F.col(c) == float("inf")).cast("int"))
    r = s.agg(F.count(F.lit(1)).alias("n"),
              nan("annual_avg_roi").alias("a"), inf("annual_avg_roi").alias("b"),
              nan("annual_portfolio_roi").alias("c"), inf("annual_portfolio_roi").alias("d"),
              F.sum((F.to_date("first_trade_at") == F.to_date("last_trade_at")).cast("int"))
              .alias("e")).first()
    assert r.n == n_traders
    assert (r.a, r.b, r.c, r.d, r.e) == special
    top = [(t.wallet_address, round(t.profit_usdc, 3)) for t in scorecard.top(s, 3).collect()]
    assert top == top3
