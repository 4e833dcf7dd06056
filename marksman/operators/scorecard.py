"""Per-wallet scorecard: rollup of positions, ratios, annualisation, top N.

"ROI" here is a gross multiple in percent: 100 means break-even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marksman.functions import annualise, day_diff
from marksman.schemas import SCORE_MEASURES, SCORECARD_KEY

# Groups whose own top n meet in one task.
TOP_GROUPS = 128
# Tasks over which the positions of one wallet are dealt, by market; a power of two.
WALLET_SHARES = 4
SHARE = "_wallet_share"
# Output columns of the two variants; fixed values, the results carry them.
SCORE_COLUMNS = [SCORECARD_KEY, *SCORE_MEASURES]
ADHOC_COLUMNS = [
    "user_id", "tokens_traded", "markets_traded", "avg_operations_count", "absolut_profit",
    "AP", "total_gained_", "total_spent_", "WAP", "day_enter", "day_exit", "annual_ap",
    "annual_wap", "active",
]


def dealt(rows: DataFrame) -> DataFrame:
    """Positions dealt by wallet and share of its markets: every market of a wallet
    is whole in one task, and no wallet is."""
    share = F.xxhash64("market_id").bitwiseAND(F.lit(WALLET_SHARES - 1).cast("bigint"))
    return rows.withColumn(SHARE, share).repartition("user_id", SHARE)


def _sums(pnl: DataFrame, scale: int) -> DataFrame:
    """One row per wallet over its positions, money summed exactly as integer
    10**-scale units.

    The positions are shuffled once (``dealt``, here unless they are already); the
    markets of a wallet are counted there, and at most ``WALLET_SHARES`` rows a
    wallet move again."""
    unit = F.lit(10**scale)
    low = F.lit((1 << 32) - 1).cast("bigint")

    def parts(c: str, units: str, decimal_col: str) -> list[Column]:
        # integer hundredths straight from the plan, summed as two halves that do not
        # wrap; else from the decimal, summed as a decimal
        if units not in pnl.columns:
            return [F.sum((F.col(decimal_col) * unit).cast("decimal(20,0)")).alias(c)]
        return [F.sum(F.shiftright(units, 32)).alias(f"{c}_high"),
                F.sum(F.col(units).bitwiseAND(low)).alias(f"{c}_low")]

    def whole(c: str, units: str) -> Column:
        if units not in pnl.columns:
            return F.sum(c)
        return (F.sum(f"{c}_high").cast("decimal(19,0)") * F.lit(1 << 32)
                + F.sum(f"{c}_low").cast("decimal(19,0)"))

    rows = pnl if SHARE in pnl.columns else dealt(pnl)
    per_market = rows.groupBy("user_id", SHARE, "market_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("operations_count").alias("ops"),
        F.count("operations_count").alias("n_ops"),
        *parts("profit", "profit_units", "absolute_profit"),
        F.sum("relative_profit").alias("rel"),
        F.count("relative_profit").alias("n_rel"),
        *parts("gained", "gained_units", "total_gained"),
        F.sum("total_spent").alias("spent"),
        F.min("day_enter").alias("first_at"),
        F.max("day_exit").alias("last_at"),
    )
    return per_market.groupBy("user_id").agg(
        F.sum("n").alias("n_positions"),
        F.count("market_id").alias("n_markets"),
        F.try_divide(F.sum("ops").cast("double"), F.sum("n_ops").cast("double")).alias("avg_ops"),
        whole("profit", "profit_units").alias("profit_units"),
        F.try_divide(F.sum("rel"), F.sum("n_rel").cast("double")).alias("avg_rel"),
        whole("gained", "gained_units").alias("gained_units"),
        F.sum("spent").alias("spent"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


def rollup(pnl: DataFrame, *, unit: float = 1e6, year_days: int = 365,
           scale: int = 2) -> DataFrame:
    """Scorecard per wallet (percent ratios, money in whole currency units)."""
    s = _sums(pnl, scale)
    money = float(unit) * 10**scale
    profit = F.col("profit_units").cast("double") / F.lit(money)
    returned = F.col("gained_units").cast("double") / F.lit(money)
    invested = F.col("spent").cast("double") / F.lit(float(unit))
    s = s.select(
        F.col("user_id").alias("wallet_address"),
        F.col("n_positions").alias("positions_count"),
        F.col("n_markets").alias("markets_count"),
        F.col("avg_ops").alias("avg_trades_per_position"),
        profit.alias("profit_usdc"),
        (F.col("avg_rel") * 100).alias("avg_roi"),
        returned.alias("total_returned_usdc"),
        invested.alias("total_invested_usdc"),
        F.col("first_at").alias("first_trade_at"),
        F.col("last_at").alias("last_trade_at"),
    )
    s = s.withColumn(
        "portfolio_roi",
        F.when(F.col("total_invested_usdc") == 0, F.lit(0.0)).otherwise(
            F.col("total_returned_usdc") / F.col("total_invested_usdc") * 100),
    )
    days = day_diff("first_trade_at", "last_trade_at")
    s = s.withColumns({
        "annual_avg_roi": annualise(F.col("avg_roi") / 100, days, year_days) * 100,
        "annual_portfolio_roi": annualise(F.col("portfolio_roi") / 100, days, year_days) * 100,
    })
    return s.select(*SCORE_COLUMNS)


def adhoc(pnl: DataFrame, *, unit: float = 1e6, year_days: int = 365, scale: int = 2,
          active_since: str | None = None) -> DataFrame:
    """The ad hoc variant: same sums, other names, ratios as plain multiples,
    and an ``active`` flag (1 for all, or last trade on/after
    ``active_since`` when given)."""
    s = _sums(pnl, scale)
    money = float(unit) * 10**scale
    out = s.select(
        "user_id",
        F.col("n_positions").alias("tokens_traded"),
        F.col("n_markets").alias("markets_traded"),
        F.col("avg_ops").alias("avg_operations_count"),
        (F.col("profit_units").cast("double") / F.lit(money)).alias("absolut_profit"),
        F.col("avg_rel").alias("AP"),
        (F.col("gained_units").cast("double") / F.lit(money)).alias("total_gained_"),
        (F.col("spent").cast("double") / F.lit(float(unit))).alias("total_spent_"),
        F.col("first_at").alias("day_enter"),
        F.col("last_at").alias("day_exit"),
    ).withColumn(
        "WAP",
        F.when(F.col("total_spent_") == 0, F.lit(0.0))
        .otherwise(F.col("total_gained_") / F.col("total_spent_")),
    )
    days = day_diff("day_enter", "day_exit")
    active = (F.lit(1) if active_since is None
              else (F.col("day_exit") >= F.lit(active_since).cast("timestamp_ntz")).cast("int"))
    out = out.withColumns({
        "annual_ap": annualise("AP", days, year_days),
        "annual_wap": annualise("WAP", days, year_days),
        "active": active,
    })
    return out.select(*ADHOC_COLUMNS)


def rank_key(c: str) -> Column:
    """Descending sort key with NaN and NULL after every number."""
    x = F.col(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x).desc_nulls_last()


def top(scores: DataFrame, n: int, *, by: str = "profit_usdc",
        tie: str = "wallet_address") -> DataFrame:
    """Top ``n`` by ``by`` descending, ``tie`` ascending as the tie-break; NaN
    and NULL rank after every number.

    Plans as TakeOrderedAndProject: every partition keeps its own top n, and
    one task merges partitions * n rows. Right while that product is small;
    for large scorecards use ``top_by_groups``, which gives the same rows.
    """
    return scores.orderBy(rank_key(by), F.col(tie).asc()).limit(n)


def top_by_groups(scores: DataFrame, n: int, *, by: str = "profit_usdc",
                  tie: str = "wallet_address", groups: int = TOP_GROUPS) -> DataFrame:
    """``top`` as one lazy plan in which no task merges partitions * n rows: the
    rows are dealt into ``groups`` salted groups, each keeps its own top n, and
    at most ``groups`` * n rows meet at the end, whatever the number of partitions."""
    order = [rank_key(by), F.col(tie).asc()]
    salt = F.pmod(F.xxhash64(tie), F.lit(groups))
    ranked = scores.withColumn("_rank", F.row_number().over(
        Window.partitionBy(salt).orderBy(*order)))
    return top(ranked.where(F.col("_rank") <= n).drop("_rank"), n, by=by, tie=tie)


__all__ = ["ADHOC_COLUMNS", "SCORE_COLUMNS", "SHARE", "adhoc", "dealt", "rank_key", "rollup", "top",
           "top_by_groups"]
