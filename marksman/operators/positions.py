"""Position stages, keyed by (user_id, token_id).

``positions`` is the one-pass form: cash flow and balance come out of ONE aggregate
on fixed-width buffers. ``cashflow`` and ``balance`` are the single stages, kept for
testing the fused form against them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marksman.functions import (checked_bigint, checked_product, checked_sum, money,
                                ratio_or_zero, sum_if)

KEYS = ["user_id", "token_id"]


def _cashflow_aggs() -> list:
    op = F.col("operation_type")
    return [
        sum_if(op == "SELL", F.col("usdc_balance_change")).alias("realized_usdc"),
        sum_if(op == "BUY", -F.col("usdc_balance_change")).alias("total_spent"),
        F.count(F.lit(1)).alias("operations_count"),
        F.min("timestamp").alias("day_enter"),
        F.max("timestamp").alias("day_exit"),
    ]


def cashflow(ops: DataFrame) -> DataFrame:
    """Realised cash (sells), cash spent (buys), operation count, first and
    last trade per position; ``market_id`` is the greatest of its rows."""
    return ops.groupBy(*KEYS).agg(F.max("market_id").alias("market_id"), *_cashflow_aggs())


def balance(ops: DataFrame) -> DataFrame:
    """Net token balance per position."""
    return ops.groupBy(*KEYS).agg(
        F.max("market_id").alias("market_id"),
        F.sum("token_balance_change").alias("token_balance"),
    )


def positions(ops: DataFrame, *, also: Sequence[str] = ()) -> DataFrame:
    """Cash flow and balance per position in one pass (plus the greatest
    ``market_id`` when the rows carry one). ``also`` lists columns that follow from
    the keys and are grouped by too.

    Operations with and without an ``id_`` are counted apart and added, so that
    this aggregate reads the columns that the prices read: both share one shuffle."""
    aggs = _cashflow_aggs() + [F.sum("token_balance_change").alias("token_balance")]
    if "market_id" in ops.columns:
        aggs.insert(0, F.max("market_id").alias("market_id"))
    if "id_" in ops.columns:
        aggs += [F.count("id_").alias("_named"),
                 F.count_if(F.col("id_").isNull()).alias("_unnamed")]
    out = ops.groupBy(*KEYS, *also).agg(*aggs)
    if "id_" in ops.columns:
        out = out.withColumn("operations_count", F.col("_named") + F.col("_unnamed")).drop(
            "_named", "_unnamed")
    return out


def with_pnl(df: DataFrame, before: list[str], after: list[str], *, scale: int = 2,
             with_units: bool = False) -> DataFrame:
    """``before``, the profit columns of a position and ``after``, from the integer
    columns ``realized_usdc``, ``total_spent`` (base units) and ``unrealized_units``
    (10**-scale base units), exact up to the final ratio. ``with_units`` adds the
    integer ``profit_units`` and ``gained_units`` that the wallet rollup sums (so it
    needs no 38-digit decimal arithmetic).

    Amounts are computed step by step in projections of their own, so that no
    step repeats the one before it inside its overflow check."""
    unit = F.lit(10**scale).cast("bigint")
    rows = df.select(*before, *after, "realized_usdc", "total_spent", "unrealized_units")
    rows = rows.withColumns({"_gross_units": checked_product("realized_usdc", unit),
                             "_spent_units": checked_product("total_spent", unit)})
    rows = rows.withColumn("gained_units", checked_sum("_gross_units", "unrealized_units"))
    rows = rows.withColumn("_lost_units", -F.col("_spent_units"))
    rows = rows.withColumn("profit_units", checked_sum("gained_units", "_lost_units"))
    return rows.select(
        *before, *(["profit_units", "gained_units"] if with_units else []),
        money(F.col("profit_units"), scale).alias("absolute_profit"),
        ratio_or_zero("gained_units", "_spent_units").alias("relative_profit"),
        "total_spent",
        money(F.col("gained_units"), scale).alias("total_gained"),
        "realized_usdc",
        money(F.col("unrealized_units"), scale).alias("unrealized_usdc"),
        *after)


def pnl(cashflow_df: DataFrame, valuation_df: DataFrame, *, scale: int = 2,
        with_units: bool = False) -> DataFrame:
    """Profit per position: realised + unrealised - spent, and the gross
    multiple (realised + unrealised) / spent, 0 when nothing was spent.

    Left join on (user_id, token_id); an unmatched valuation counts as 0.
    """
    v = valuation_df.select(*KEYS, "unrealized_usdc")
    j = cashflow_df.join(v, KEYS, "left").withColumn("unrealized_units", F.coalesce(
        checked_bigint(F.col("unrealized_usdc") * F.lit(10**scale)), F.lit(0).cast("bigint")))
    return with_pnl(j, [*KEYS, "market_id", "operations_count"], ["day_enter", "day_exit"],
                    scale=scale, with_units=with_units)


__all__ = ["KEYS", "balance", "cashflow", "pnl", "positions", "with_pnl"]
