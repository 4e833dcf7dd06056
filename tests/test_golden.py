import datetime as dt
import math
from decimal import Decimal

import pytest

from marksman.operators import ledger, positions, scorecard, valuation
from marksman.plans import scoring
from tests import golden


@pytest.fixture(scope="module")
def gm(spark):
    return golden.markets(spark)


@pytest.fixture(scope="module")
def gf(spark):
    return golden.fills(spark)


def _ops(gm, gf):
    outcomes = ledger.market_outcomes(gm)
    return ledger.operations(ledger.two_sided(gf), outcomes)


def test_stage_row_counts(gm, gf):
    outcomes = ledger.market_outcomes(gm)
    assert outcomes.count() == 4
    assert ledger.two_sided(gf).count() == 10
    ops = _ops(gm, gf)
    assert ops.count() == 8
    kept = ledger.exclude_intermediaries(ops, golden.INTERMEDIARIES)
    deduped = ledger.dedupe_by_priority(kept, golden.INTERMEDIARIES)
    assert deduped.count() == 5
    # W1's buy through the intermediary wins over its buy from W2 in tx "a".
    w1a = deduped.where("user_id = 'W1' AND id_ = 'a'").first()
    assert w1a.agent == golden.EX and w1a.operation_type == "BUY"


def test_last_prices(gm, gf):
    ops = ledger.dedupe_by_priority(
        ledger.exclude_intermediaries(_ops(gm, gf), golden.INTERMEDIARIES), golden.INTERMEDIARIES)
    prices = {r.token_id: r.last_price for r in valuation.last_price(ops).collect()}
    assert prices == {"T1": Decimal("0.60"), "T3": Decimal("0.33")}


EXPECTED_POSITIONS = {
    ("W1", "T1"): (240000, 500000, 2, Decimal("600000.00"), Decimal("340000.00"), 1.68),
    ("W2", "T1"): (500000, 0, 1, Decimal("-1000000.00"), Decimal("-500000.00"), 0.0),
    ("W3", "T1"): (0, 240000, 1, Decimal("400000.00"), Decimal("160000.00"), 400000 / 240000),
    ("W3", "T3"): (0, 333333, 1, Decimal("330000.00"), Decimal("-3333.00"), 330000 / 333333),
}


@pytest.mark.parametrize("fused", [False, True])
def test_positions(gm, gf, fused):
    build = scoring.fused_pnl if fused else scoring.literal_pnl
    rows = build(gm, gf, golden.INTERMEDIARIES).collect()
    got = {(r.user_id, r.token_id): (r.realized_usdc, r.total_spent, r.operations_count,
                                     r.unrealized_usdc, r.absolute_profit, r.relative_profit)
           for r in rows}
    assert got.keys() == EXPECTED_POSITIONS.keys()
    for k, exp in EXPECTED_POSITIONS.items():
        assert got[k][:5] == exp[:5], k
        assert got[k][5] == pytest.approx(exp[5], rel=1e-12), k


@pytest.mark.parametrize("fused", [False, True])
def test_traders(gm, gf, fused):
    scores = scoring.score_traders(gm, gf, golden.INTERMEDIARIES, fused=fused)
    top = scorecard.top(scores, 10).collect()
    assert [r.wallet_address for r in top] == ["W1", "W3", "W2"]
    w1, w3, w2 = top
    assert (w1.positions_count, w1.markets_count, w1.avg_trades_per_position) == (1, 1, 2.0)
    assert w1.profit_usdc == pytest.approx(0.34)
    assert w1.avg_roi == pytest.approx(168.0)
    assert w1.total_returned_usdc == pytest.approx(0.84)
    assert w1.total_invested_usdc == pytest.approx(0.5)
    assert w1.portfolio_roi == pytest.approx(168.0)
    assert w1.annual_avg_roi == pytest.approx(1.67412847377e10, rel=1e-9)
    assert w1.annual_portfolio_roi == pytest.approx(1.67412847377e10, rel=1e-9)
    assert (w3.positions_count, w3.markets_count) == (2, 2)
    assert w3.profit_usdc == pytest.approx(0.156667)
    assert w3.avg_roi == pytest.approx(132.833383, abs=1e-6)
    assert w3.total_returned_usdc == pytest.approx(0.73)
    assert w3.total_invested_usdc == pytest.approx(0.573333)
    assert w3.portfolio_roi == pytest.approx(127.325655, abs=1e-6)
    assert w3.annual_avg_roi == pytest.approx(3167480.8586, rel=1e-9)
    assert w3.annual_portfolio_roi == pytest.approx(675197.9199, rel=1e-9)
    assert w3.first_trade_at == dt.datetime(2024, 1, 11, 9)
    assert w3.last_trade_at == dt.datetime(2024, 1, 21, 8)
    # days = 0: pow(0, inf) = 0
    assert w2.profit_usdc == pytest.approx(-0.5)
    assert (w2.avg_roi, w2.portfolio_roi) == (0.0, 0.0)
    assert (w2.annual_avg_roi, w2.annual_portfolio_roi) == (0.0, 0.0)
    assert not math.isnan(w2.annual_avg_roi)


def test_adhoc_variant(gm, gf):
    pnl = scoring.fused_pnl(gm, gf, golden.INTERMEDIARIES)
    rows = {r.user_id: r for r in scorecard.adhoc(pnl).collect()}
    w1 = rows["W1"]
    assert w1.AP == pytest.approx(1.68) and w1.WAP == pytest.approx(1.68)
    assert w1.annual_ap == pytest.approx(1.67412847377e8, rel=1e-9)
    assert w1.active == 1
    assert rows["W2"].annual_wap == 0.0
    flagged = {r.user_id: r.active for r in
               scorecard.adhoc(pnl, active_since="2024-01-15").collect()}
    assert flagged == {"W1": 0, "W2": 0, "W3": 1}


def test_positions_match_single_stages(gm, gf):
    ops = ledger.dedupe_by_priority(
        ledger.exclude_intermediaries(_ops(gm, gf), golden.INTERMEDIARIES), golden.INTERMEDIARIES)
    one = {(r.user_id, r.token_id): (r.realized_usdc, r.total_spent, r.token_balance)
           for r in positions.positions(ops).collect()}
    flows = {(r.user_id, r.token_id): (r.realized_usdc, r.total_spent)
             for r in positions.cashflow(ops).collect()}
    bal = {(r.user_id, r.token_id): r.token_balance for r in positions.balance(ops).collect()}
    assert one == {k: (*flows[k], bal[k]) for k in flows}
