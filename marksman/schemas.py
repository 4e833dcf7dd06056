"""Declared schemas of the two inputs and the scorecard target.

The inputs have no DDL of their own; the types are read off the scoring query
(string ids, base-unit integer amounts, naive timestamps).
"""

from __future__ import annotations

from pyspark.sql import types as T

OUTCOME = T.StructType(
    [
        T.StructField("token_id", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)

# One row per market; `tokens` lists its outcome tokens.
MARKETS = T.StructType(
    [
        T.StructField("question_id", T.StringType()),
        T.StructField("condition_id", T.StringType()),
        T.StructField("tokens", T.ArrayType(OUTCOME)),
        T.StructField("winner", T.StringType()),
        T.StructField("end_date_iso", T.StringType()),
    ]
)

# One row per exchange fill. Asset id "0" is cash; amounts are base units
# (six decimals for both cash and outcome tokens).
FILLS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("maker", T.StringType()),
        T.StructField("taker", T.StringType()),
        T.StructField("maker_asset_id", T.StringType()),
        T.StructField("taker_asset_id", T.StringType()),
        T.StructField("maker_amount_filled", T.LongType()),
        T.StructField("taker_amount_filled", T.LongType()),
        T.StructField("is_deleted", T.IntegerType()),
    ]
)

# Measures written per wallet by the refresh job, in target column order.
SCORE_MEASURES = [
    "positions_count",
    "markets_count",
    "avg_trades_per_position",
    "profit_usdc",
    "avg_roi",
    "total_returned_usdc",
    "total_invested_usdc",
    "portfolio_roi",
    "first_trade_at",
    "last_trade_at",
    "annual_avg_roi",
    "annual_portfolio_roi",
]

# The keyed scorecard snapshot (target table).
SCORECARD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("wallet_address", T.StringType(), nullable=False),
        T.StructField("positions_count", T.IntegerType()),
        T.StructField("markets_count", T.IntegerType()),
        T.StructField("avg_trades_per_position", T.DoubleType()),
        T.StructField("profit_usdc", T.DoubleType()),
        T.StructField("avg_roi", T.DoubleType()),
        T.StructField("total_returned_usdc", T.DoubleType()),
        T.StructField("total_invested_usdc", T.DoubleType()),
        T.StructField("portfolio_roi", T.DoubleType()),
        T.StructField("first_trade_at", T.TimestampNTZType()),
        T.StructField("last_trade_at", T.TimestampNTZType()),
        T.StructField("annual_avg_roi", T.DoubleType()),
        T.StructField("annual_portfolio_roi", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Column defaults of the target (NULL where the target has none).
SCORECARD_DEFAULTS = {
    "positions_count": 0,
    "markets_count": 0,
    "avg_trades_per_position": 0.0,
    "profit_usdc": 0.0,
    "avg_roi": 0.0,
    "total_returned_usdc": 0.0,
    "total_invested_usdc": 0.0,
    "portfolio_roi": 0.0,
    "annual_avg_roi": 0.0,
    "annual_portfolio_roi": 0.0,
}

SCORECARD_KEY = "wallet_address"
SCORECARD_KEY_MAX_LEN = 128
