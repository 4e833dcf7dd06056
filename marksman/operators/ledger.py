"""Ledger stages: outcome listings, the two-sided signed ledger, the
intermediary filter and the dedupe by priority.

The ledger itself is narrow (scan, filter, generator, broadcast join). Only
``dedupe_by_priority`` shuffles the ledger (one hash exchange on (user_id,
id_), after a map-side partial aggregate); ``trade_sides`` of trades dealt by
id_ needs none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marksman.functions import latest
from marksman.plans.sizing import DRIVER_SHARE, broadcast_if_small

CASH = "0"

# Output columns of the operations stage; fixed values, the results carry them.
OPERATION_COLUMNS = ["id_", "user_id", "agent", "market_id", "timestamp", "asset_in",
                     "asset_out", "operation_type", "token_balance_change",
                     "usdc_balance_change", "token_id"]

# Total order used to pick one row per (user_id, id_), greatest first. The
# payload columns follow priority so that ties never depend on row order.
PRIORITY_ORDER = ["priority", "timestamp", "token_id", "operation_type",
                  "usdc_balance_change", "token_balance_change", "market_id", "agent"]


def market_outcomes(markets: DataFrame) -> DataFrame:
    """One row per outcome token of every market with a condition id.

    ``explode`` (not ``explode_outer``): a market with an empty or NULL token
    list yields no row. A token listed by two markets yields two rows.
    """
    return (
        markets.where(F.col("condition_id") != "")
        .select(
            F.col("question_id").alias("market_id"),
            F.explode("tokens").alias("t"),
            "winner",
            F.col("end_date_iso").alias("end_date"),
        )
        .select(
            F.col("t.token_id").alias("token_id"),
            "market_id",
            F.col("t.outcome").alias("outcome_desc"),
            "winner",
            "end_date",
        )
    )


def live_fills(fills: DataFrame, *, cash_asset: str = CASH) -> DataFrame:
    """Fills that are not soft-deleted and trade tokens against cash on at
    least one side (token-for-token swaps drop out)."""
    return fills.where(
        (F.col("is_deleted") == 0)
        & ((F.col("maker_asset_id") == cash_asset) | (F.col("taker_asset_id") == cash_asset))
    )


def two_sided(fills: DataFrame, *, cash_asset: str = CASH) -> DataFrame:
    """Each live fill seen once from the maker's side and once from the
    taker's: ``user_id`` trades with ``agent``, gives away ``asset_in`` and
    receives ``asset_out``.

    Per side, first what the wallet gives and receives (asset and amount),
    then the cash amount is whichever of the two is cash and the token amount
    the other one; ``token_id`` is the non-cash asset. The expansion is an
    ``explode`` of the literal array [1, 2]: a narrow generator inside the
    scan stage, not a union of two scans.
    """
    maker_side = F.col("side") == 1

    def pick(for_maker: str, for_taker: str):
        return F.when(maker_side, F.col(for_maker)).otherwise(F.col(for_taker))

    sides = live_fills(fills, cash_asset=cash_asset).select(
        "*", F.explode(F.array(F.lit(1), F.lit(2))).alias("side"))
    sides = sides.select(
        # text before the first "_" (all of it when there is none), without
        # building the array that split_part would
        F.substring_index(F.col("id"), "_", 1).alias("id_"),
        "timestamp",
        pick("maker", "taker").alias("user_id"),
        pick("taker", "maker").alias("agent"),
        pick("maker_asset_id", "taker_asset_id").alias("asset_in"),
        pick("taker_asset_id", "maker_asset_id").alias("asset_out"),
        pick("maker_amount_filled", "taker_amount_filled").alias("given"),
        pick("taker_amount_filled", "maker_amount_filled").alias("received"),
    )
    pays_cash = F.col("asset_in") == cash_asset
    return sides.select(
        "id_", "timestamp", "user_id", "agent",
        F.when(pays_cash, F.col("given")).otherwise(F.col("received")).alias("usdc_amount"),
        F.when(pays_cash, F.col("received")).otherwise(F.col("given")).alias("token_amount"),
        "asset_in", "asset_out",
        F.when(pays_cash, F.col("asset_out")).otherwise(F.col("asset_in")).alias("token_id"),
    )


def trades(fills: DataFrame, *, cash_asset: str = CASH) -> DataFrame:
    """One narrow row per live fill, before it is seen from its two sides: what
    joins and shuffles carry, at half the rows of the ledger. Both sides trade the
    same ``token_id``: the taker's asset if the maker pays cash, else the maker's."""
    maker_pays = F.coalesce(F.col("maker_asset_id") == cash_asset, F.lit(False))
    taker_pays = F.coalesce(F.col("taker_asset_id") == cash_asset, F.lit(False))
    return live_fills(fills, cash_asset=cash_asset).select(
        F.substring_index(F.col("id"), "_", 1).alias("id_"),
        "timestamp", "maker", "taker",
        maker_pays.alias("maker_pays"), taker_pays.alias("taker_pays"),
        "maker_amount_filled", "taker_amount_filled",
        F.when(maker_pays, F.col("taker_asset_id")).otherwise(F.col("maker_asset_id"))
        .alias("token_id"),
    )


def trade_sides(trades: DataFrame) -> DataFrame:
    """``trades`` as signed ledger rows, one per side: the rows of ``signed`` of
    ``two_sided`` without the asset columns; other columns are kept."""
    given = {"id_", "timestamp", "maker", "taker", "maker_pays", "taker_pays",
             "maker_amount_filled", "taker_amount_filled", "token_id"}
    more = [c for c in trades.columns if c not in given]
    maker_side = F.col("side") == 1

    def pick(for_maker: str, for_taker: str):
        return F.when(maker_side, F.col(for_maker)).otherwise(F.col(for_taker))

    sides = trades.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("side")).select(
        "id_", "timestamp", "token_id", *more,
        pick("maker", "taker").alias("user_id"),
        pick("taker", "maker").alias("agent"),
        pick("maker_pays", "taker_pays").alias("buy"),
        pick("maker_amount_filled", "taker_amount_filled").alias("given"),
        pick("taker_amount_filled", "maker_amount_filled").alias("received"))
    return sides.select(
        "id_", "user_id", "agent", *more, "timestamp",
        F.when(F.col("buy"), F.lit("BUY")).otherwise(F.lit("SELL")).alias("operation_type"),
        F.when(F.col("buy"), F.col("received")).otherwise(-F.col("given"))
        .alias("token_balance_change"),
        F.when(F.col("buy"), -F.col("given")).otherwise(F.col("received"))
        .alias("usdc_balance_change"),
        "token_id")


def signed(ledger: DataFrame, *, cash_asset: str = CASH) -> DataFrame:
    """Label each ledger row BUY (gives cash) or SELL and sign the balance
    changes: tokens + on a buy, cash - on a buy, the reverse on a sell."""
    buy = F.col("asset_in") == cash_asset
    return ledger.select(
        "*",
        F.when(buy, F.lit("BUY")).otherwise(F.lit("SELL")).alias("operation_type"),
        F.when(buy, F.col("token_amount")).otherwise(-F.col("token_amount"))
        .alias("token_balance_change"),
        F.when(buy, -F.col("usdc_amount")).otherwise(F.col("usdc_amount"))
        .alias("usdc_balance_change"),
    )


def operations(ledger: DataFrame, outcomes: DataFrame, *, cash_asset: str = CASH) -> DataFrame:
    """Signed operations on listed tokens, tagged with their market.

    Inner join on ``token_id``: trades on unlisted tokens drop out, a token
    listed by k markets yields k rows. Pass ``outcomes`` through
    ``plans.sizing.broadcast_if_small`` to broadcast it behind a size check.
    """
    listings = outcomes.select("token_id", "market_id")
    return signed(ledger.join(listings, "token_id"), cash_asset=cash_asset).select(
        *OPERATION_COLUMNS)


def exclude_intermediaries(ops: DataFrame, intermediaries: Sequence[str] | DataFrame) -> DataFrame:
    """Drop rows whose own wallet is an intermediary (``user_id NOT IN``).

    A short list is an ``isin`` predicate; a long list given as a one-column
    DataFrame (``user_id``) becomes a left anti join, broadcast if it measures small.
    NULL wallets drop out either way, as with SQL ``NOT IN``.
    """
    if isinstance(intermediaries, DataFrame):
        listed, _ = broadcast_if_small(intermediaries.select("user_id").distinct(),
                                       driver_share=DRIVER_SHARE)
        return ops.where(F.col("user_id").isNotNull()).join(listed, "user_id", "left_anti")
    # said outright, so that every branch of a plan reads the same rows
    return ops.where(F.col("user_id").isNotNull() & ~F.col("user_id").isin(list(intermediaries)))


def with_priority(ops: DataFrame, intermediaries: Sequence[str] | DataFrame) -> DataFrame:
    """Priority 2 for rows traded against an intermediary, else 1. A long list
    comes as a one-column DataFrame (``user_id``), joined on ``agent``."""
    if isinstance(intermediaries, DataFrame):
        listed = intermediaries.select(F.col("user_id").alias("agent")).where(
            F.col("agent").isNotNull()).distinct().withColumn("_listed", F.lit(True))
        listed, _ = broadcast_if_small(listed, driver_share=DRIVER_SHARE)
        return ops.join(listed, "agent", "left").select(
            *ops.columns, F.when(F.col("_listed"), F.lit(2)).otherwise(F.lit(1)).alias("priority"))
    return ops.withColumn(
        "priority",
        F.when(F.col("agent").isin(list(intermediaries)), F.lit(2)).otherwise(F.lit(1)),
    )


def dedupe_by_priority(ops: DataFrame, intermediaries: Sequence[str] | DataFrame, *,
                       keep: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per (user_id, id_): the greatest by ``PRIORITY_ORDER``.

    All kept columns come from that one row. One aggregate (partial before
    the shuffle, final after) instead of a window over the whole ledger, so
    a hot (user_id, id_) group is combined map-side. ``keep`` lists the
    columns to carry (default: every column of ``ops``); carry only what
    later stages read, since fields packed in the struct are not pruned.
    """
    order = [c for c in PRIORITY_ORDER if c == "priority" or c in ops.columns]
    keys = ["id_", "user_id"]  # ids differ sooner than wallets do: cheaper to sort by
    cols = [c for c in (keep if keep is not None else ops.columns) if c not in keys]
    payload = [c for c in cols if c not in order]
    while not payload and order[-1] not in cols and order[-1] != "priority":
        order.pop()  # rows alike in all columns before it give the same result
    pri = with_priority(ops, intermediaries)
    picked = pri.groupBy(*keys).agg(latest(order, payload).alias("row"))
    return picked.select("id_", "user_id", *[F.col(f"row.{c}").alias(c) for c in cols])


__all__ = [
    "CASH",
    "OPERATION_COLUMNS",
    "PRIORITY_ORDER",
    "dedupe_by_priority",
    "exclude_intermediaries",
    "live_fills",
    "market_outcomes",
    "operations",
    "signed",
    "trade_sides",
    "trades",
    "two_sided",
    "with_priority",
]
