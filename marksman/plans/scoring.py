"""The scoring query as one lazy plan.

``literal_pnl`` follows the stages one by one (each stage function on its
own). ``fused_pnl`` is the plan to run at scale; it computes the same rows
with fewer exchanges:

* the listing join only filters (left semi join), and filters fills, not the two
  ledger rows of each: a token's market is attached once per token at the end;
* fills are dealt by transaction, one narrow row each, and seen from their two
  sides after it: the dedupe needs no exchange of its own;
* the deduped operations are dealt once by (token, share of its wallets). Positions
  (cash flow and balance in ONE aggregate), prices and the join with the token
  values all read that one exchange;
* prices fold with the payouts into a token-sized table (token_id, market_id, unit
  value), broadcast when its measured rows and bytes are under the bounds and its
  hash table fits the driver, else joined where the positions are;
* positions are dealt once by (wallet, share of its markets) for the rollup.

Exchanges of the fused plan over the bounds: (token_id) for the listing filter,
(id_), (token_id, share), (wallet, share); the others are token- or wallet-sized.
The shares (4 each) keep a hot token or wallet from being one task's. Nothing is
persisted: the plan stays lazy, and no table outlives the query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marksman.functions import checked_product
from marksman.operators import ledger, positions, scorecard, valuation
from marksman.plans.sizing import (DEFAULT_BROADCAST_MAX_ROWS, DRIVER_SHARE,
                                    broadcast_if_small, measure_columns)

Intermediaries = Sequence[str] | DataFrame

# Tasks over which the operations on one token are dealt, by wallet; a power of two.
TOKEN_SHARES = 4
# Columns of the deduped ledger that the position stage reads.
_POSITION_INPUT = ["timestamp", "token_id", "operation_type", "token_balance_change",
                   "usdc_balance_change"]


def _deduped(trades: DataFrame, intermediaries: Intermediaries, keep: list[str]) -> DataFrame:
    """The deduped ledger of listed trades. The trades are dealt by transaction, one
    row per fill: both sides of all its fills meet, so the dedupe needs no shuffle of
    its own."""
    ops = ledger.exclude_intermediaries(ledger.trade_sides(trades.repartition("id_")),
                                        intermediaries)
    return ledger.dedupe_by_priority(ops, intermediaries, keep=keep)


def literal_pnl(markets: DataFrame, fills: DataFrame, intermediaries: Intermediaries, *,
                cash_asset: str = ledger.CASH, scale: int = 2,
                broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                with_units: bool = False) -> DataFrame:
    """Per-position profit, stage by stage. ``with_units`` as in ``fused_pnl``."""
    outcomes = ledger.market_outcomes(markets).select("token_id", "market_id", "winner")
    outcomes_b, _ = broadcast_if_small(outcomes, broadcast_max_rows, driver_share=DRIVER_SHARE)
    trades = ledger.trades(fills, cash_asset=cash_asset).join(
        outcomes_b.select("token_id", "market_id"), "token_id")
    ops = _deduped(trades, intermediaries, [*_POSITION_INPUT, "market_id"])
    flows = positions.cashflow(ops)
    mtm = valuation.mark_to_market(positions.balance(ops), outcomes_b,
                                   valuation.last_price(ops, scale=scale), scale=scale)
    return positions.pnl(flows, mtm, scale=scale, with_units=with_units)


def fused_pnl(markets: DataFrame, fills: DataFrame, intermediaries: Intermediaries, *,
              cash_asset: str = ledger.CASH, scale: int = 2,
              broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
              with_units: bool = False) -> DataFrame:
    """Per-position profit in the fused plan (same rows as ``literal_pnl``): one
    lazy plan for every input (one job sizes the listings). ``with_units`` adds
    the integer sums the rollup reads, and deals the rows for it."""
    outcomes = ledger.market_outcomes(markets)
    # one job sizes the listings; every broadcast side below is no larger
    n, width = measure_columns(outcomes.select("token_id", "market_id"))
    listed, _ = broadcast_if_small(outcomes.select("token_id"), broadcast_max_rows,
                                   measured=(n, width["token_id"]),
                                   driver_share=DRIVER_SHARE)
    trades = ledger.trades(fills, cash_asset=cash_asset).join(listed, "token_id", "left_semi")
    ops = _deduped(trades, intermediaries, _POSITION_INPUT)
    # never NULL, also for the optimizer: positions and prices read the same rows
    ops = ops.withColumn("_share", F.xxhash64("user_id").bitwiseAND(
        F.lit(TOKEN_SHARES - 1).cast("bigint")))
    ops = ops.repartition("token_id", "_share")
    pos = positions.positions(ops, also=["_share"])
    prices = valuation.last_price_units(ops, scale=scale, shares="_share")
    values, small = broadcast_if_small(
        valuation.token_values(outcomes, prices, scale=scale), broadcast_max_rows,
        measured=(n, width["token_id"] + width["market_id"] + 12 * n),
        driver_share=DRIVER_SHARE)
    on = ["token_id"]
    if not small:  # the positions stay where they are: each share has the token's value
        on.append("_share")
        values = values.withColumn("_share", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.lit(TOKEN_SHARES - 1).cast("bigint"))))
    worth = pos.join(values, on).withColumn(
        "unrealized_units", checked_product("token_balance", "unit_units"))
    after = ["day_enter", "day_exit"]
    if with_units:  # for the rollup: dealt by wallet before the ratios widen the rows
        worth = scorecard.dealt(worth)
        after.append(scorecard.SHARE)
    return positions.with_pnl(worth, ["user_id", "token_id", "market_id", "operations_count"],
                              after, scale=scale, with_units=with_units)


def score_traders(markets: DataFrame, fills: DataFrame, intermediaries: Intermediaries, *,
                  unit: float = 1e6, year_days: int = 365, scale: int = 2,
                  cash_asset: str = ledger.CASH,
                  broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                  fused: bool = True) -> DataFrame:
    """Scorecard of every wallet (not ranked)."""
    build = fused_pnl if fused else literal_pnl
    pnl = build(markets, fills, intermediaries, cash_asset=cash_asset, scale=scale,
                broadcast_max_rows=broadcast_max_rows, with_units=True)
    return scorecard.rollup(pnl, unit=unit, year_days=year_days, scale=scale)


def top_traders(markets: DataFrame, fills: DataFrame, intermediaries: Intermediaries, *,
                limit: int = 10_000, **kw) -> DataFrame:
    """The flagship query: scorecards of the ``limit`` most profitable wallets, as
    one lazy plan."""
    return scorecard.top_by_groups(score_traders(markets, fills, intermediaries, **kw), limit)


__all__ = ["fused_pnl", "literal_pnl", "score_traders", "top_traders"]
