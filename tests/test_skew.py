"""A third of all fills on one wallet and one token: same results, whatever
the join strategy, and every aggregate combines the hot key map-side."""

import pytest
from pyspark.sql import functions as F

from marksman.plans import scoring
from marksman.sources import fixtures
from tests.conftest import SF_SMALL

IMS = fixtures.INTERMEDIARIES


@pytest.fixture(scope="module")
def skewed(spark):
    f = fixtures.fills(spark, SF_SMALL)
    hot = F.xxhash64("id") % 3 == 0
    # a third of all fills: the maker becomes one wallet, the token one token
    f = f.withColumns({
        "maker": F.when(hot, F.lit("whot")).otherwise(F.col("maker")),
        "maker_asset_id": F.when(hot & (F.col("maker_asset_id") != "0"), F.lit("t1a"))
        .otherwise(F.col("maker_asset_id")),
        "taker_asset_id": F.when(hot & (F.col("taker_asset_id") != "0"), F.lit("t1a"))
        .otherwise(F.col("taker_asset_id")),
    })
    return fixtures.markets(spark, SF_SMALL), f


def test_hot_wallet_and_token_results_agree(spark, skewed):
    m, f = skewed
    n_hot = f.where("maker = 'whot'").count()
    assert n_hot * 4 > f.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        shuffled = scoring.score_traders(m, f, IMS, broadcast_max_rows=0)
        literal = scoring.score_traders(m, f, IMS, fused=False)
        cols = [c for c in shuffled.columns if c != "avg_roi" and not c.startswith("annual")]
        a = sorted(shuffled.select(*cols).collect())
        b = sorted(literal.select(*cols).collect())
        assert a == b
        hot = shuffled.where("wallet_address = 'whot'").first()
        assert hot.positions_count > 0
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(k)
