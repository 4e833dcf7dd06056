"""Valuation: last trade price per token and mark to market per position.

Money is carried as integer counts of 10**-scale base units (cents of a base
unit for scale 2), so sums are exact and the engines agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marksman.functions import (checked_product, money, safe_ratio, trunc_scaled,
                                units_to_decimal)


def price_units(scale: int = 2) -> Column:
    """Trade price ``-cash / tokens`` truncated to ``scale`` decimals, as an
    integer count of 10**-scale. NULL when the token amount is 0: such a
    trade sets no price (the division would be inf or NaN)."""
    return trunc_scaled(
        safe_ratio(-F.col("usdc_balance_change"), F.col("token_balance_change")), scale)


def payout_units(scale: int = 2) -> Column:
    """Value of one token of a listing: 1 if its market resolved to it, 0 if
    it resolved to another token, else the last price (0 when unknown).
    A NULL winner counts as unresolved."""
    one = F.lit(10**scale).cast("bigint")
    resolved = F.col("winner") != ""
    return (
        F.when(resolved, F.when(F.col("winner") == F.col("token_id"), one)
               .otherwise(F.lit(0).cast("bigint")))
        .otherwise(F.coalesce(F.col("price_units"), F.lit(0).cast("bigint")))
    )


def _latest_priced(scale: int) -> Column:
    """Aggregate: the latest priced trade by (timestamp, id_, user_id), a
    total order on deduped rows; trades without a price are skipped."""
    p = price_units(scale)
    return F.max(F.when(p.isNotNull(), F.struct("timestamp", "id_", "user_id", "operation_type",
                                                 p.alias("price_units"))))


def last_price(ops: DataFrame, *, scale: int = 2) -> DataFrame:
    """Price of the latest priced trade of each token, as DECIMAL(18, scale),
    with the token's greatest market id. NULL when no trade of the token has
    a price.

    One aggregate with a partial step before the shuffle, so a hot token is
    combined map-side and only token-sized data is exchanged.
    """
    out = ops.groupBy("token_id").agg(_latest_priced(scale).alias("lt"),
                                      F.max("market_id").alias("market_id"))
    return out.select(
        "token_id",
        units_to_decimal(F.col("lt.price_units"), scale, precision=18).alias("last_price"),
        "market_id",
    )


def last_price_units(ops: DataFrame, *, scale: int = 2, shares: str | None = None) -> DataFrame:
    """``last_price`` as an integer count of 10**-scale: (token_id, price_units).
    Reads only the columns it needs. With ``shares``, a column by which the rows of
    a token are dealt, each share keeps its latest trade first."""
    if shares is None:
        latest = ops.groupBy("token_id").agg(_latest_priced(scale).alias("lt"))
    else:
        latest = (ops.groupBy("token_id", shares).agg(_latest_priced(scale).alias("lt"))
                  .groupBy("token_id").agg(F.max("lt").alias("lt")))
    return latest.select("token_id", F.col("lt.price_units").alias("price_units"))


def mark_to_market(balances: DataFrame, outcomes: DataFrame, prices: DataFrame, *,
                   scale: int = 2) -> DataFrame:
    """Unrealised value per position, stage by stage.

    Balances left-joined to every listing of their token (for the winner)
    and to the last price, then summed per position: a token listed by k
    markets is valued once per listing.
    """
    unit = F.lit(10**scale)
    price = prices.select(
        "token_id", (F.col("last_price") * unit).cast("bigint").alias("price_units"))
    listing = outcomes.select("token_id", "winner")
    j = balances.join(listing, "token_id", "left").join(price, "token_id", "left")
    value = checked_product(payout_units(scale), "token_balance").cast("decimal(20,0)")
    return j.groupBy("user_id", "token_id").agg(
        F.max("market_id").alias("market_id"),
        money(F.sum(value), scale).alias("unrealized_usdc"),
        F.max("token_balance").alias("token_balance"),
    )


def token_values(outcomes: DataFrame, prices: DataFrame, *, scale: int = 2) -> DataFrame:
    """Per token: the greatest listing market and the unit value summed over
    its listings, (token_id, market_id, unit_units). Token-sized."""
    j = outcomes.select("token_id", "market_id", "winner").join(
        prices.select("token_id", "price_units"), "token_id", "left")
    return j.groupBy("token_id").agg(
        F.max("market_id").alias("market_id"),
        F.sum(payout_units(scale)).alias("unit_units"),
    )


__all__ = [
    "last_price",
    "last_price_units",
    "mark_to_market",
    "payout_units",
    "price_units",
    "token_values",
]
