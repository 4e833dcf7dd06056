"""Random small ledgers: the Spark plans against a plain-Python brute force
written straight from the scoring rules (ties, zero amounts, swaps, deleted
fills, intermediaries, duplicate listings, NULL winners)."""

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marksman.plans import scoring
from marksman.schemas import FILLS, MARKETS

IMS = ["EX"]
WALLETS = ["A", "B", "C", "EX"]
TOKENS = ["T1", "T2", "T3", "T4"]


def brute_force(markets, fills):
    listings = []  # (token, market, winner)
    for qid, cond, tokens, winner, _ in markets:
        if cond is None or cond == "":
            continue
        for t in tokens or []:
            listings.append((t["token_id"], qid, winner))
    by_token = defaultdict(list)
    for tok, mkt, win in listings:
        by_token[tok].append((mkt, win))
    rows = []
    for fid, ts, maker, taker, ma, ta, mamt, tamt, deleted in fills:
        if deleted != 0 or not (ma == "0" or ta == "0"):
            continue
        for side in (1, 2):
            user, agent = (maker, taker) if side == 1 else (taker, maker)
            a_in, a_out = (ma, ta) if side == 1 else (ta, ma)
            if side == 1:
                usdc, tok_amt = (mamt, tamt) if ma == "0" else (tamt, mamt)
            else:
                usdc, tok_amt = (tamt, mamt) if ta == "0" else (mamt, tamt)
            token = a_out if a_in == "0" else a_in
            buy = a_in == "0"
            for mkt, _ in by_token.get(token, []):
                rows.append(dict(id_=fid.split("_")[0], user=user, agent=agent, market=mkt,
                                 ts=ts, token=token, op="BUY" if buy else "SELL",
                                 dt=tok_amt if buy else -tok_amt,
                                 du=-usdc if buy else usdc))
    rows = [r for r in rows if r["user"] not in IMS]
    groups = defaultdict(list)
    for r in rows:
        groups[(r["user"], r["id_"])].append(r)

    def key(r):
        return (2 if r["agent"] in IMS else 1, r["ts"], r["token"], r["op"], r["du"], r["dt"],
                r["market"], r["agent"])
    kept = [max(g, key=key) for g in groups.values()]

    price = {}
    for tok in {r["token"] for r in kept}:
        priced = [r for r in kept if r["token"] == tok and r["dt"] != 0]
        if priced:
            r = max(priced, key=lambda r: (r["ts"], r["id_"], r["user"]))
            price[tok] = int((-r["du"] / r["dt"]) * 100.0)
    pos = defaultdict(list)
    for r in kept:
        pos[(r["user"], r["token"])].append(r)
    out = {}
    for (user, tok), rs in pos.items():
        realized = sum(r["du"] for r in rs if r["op"] == "SELL")
        spent = sum(-r["du"] for r in rs if r["op"] == "BUY")
        bal = sum(r["dt"] for r in rs)
        unit = 0
        for _, win in by_token[tok]:
            if win is not None and win != "":
                unit += 100 if win == tok else 0
            else:
                unit += price.get(tok, 0)
        gained = realized * 100 + bal * unit
        rel = gained / (spent * 100) if spent != 0 else 0.0
        out[(user, tok)] = (max(r["market"] for r in rs), len(rs), realized, spent,
                            gained - spent * 100, rel)
    return out


@st.composite
def case(draw):
    def tokens():
        return [{"token_id": t, "outcome": "o"} for t in
                draw(st.lists(st.sampled_from(TOKENS), max_size=3))]
    markets = [(f"M{i}", draw(st.sampled_from(["c", ""])), tokens(),
                draw(st.sampled_from(["", None, "T1", "T2", "T3"])), "d") for i in range(3)]
    n = draw(st.integers(1, 14))
    fills = []
    for i in range(n):
        tok = draw(st.sampled_from(TOKENS + ["0"]))
        maker_gives_cash = draw(st.booleans())
        ma, ta = ("0", tok) if maker_gives_cash else (tok, "0")
        if draw(st.integers(0, 9)) == 0:
            ta = draw(st.sampled_from(TOKENS))  # swap or both cash
        fills.append((f"x{draw(st.integers(0, 4))}_{i}",
                      dt.datetime(2024, 1, 1 + draw(st.integers(0, 3))),
                      draw(st.sampled_from(WALLETS)), draw(st.sampled_from(WALLETS)), ma, ta,
                      draw(st.sampled_from([0, 1, 3, 7, 10])) * 100000,
                      draw(st.sampled_from([0, 2, 5, 10])) * 100000,
                      draw(st.sampled_from([0, 0, 0, 1]))))
    return markets, fills


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(case())
def test_plans_match_brute_force(spark, c):
    markets, fills = c
    m = spark.createDataFrame(markets, MARKETS)
    f = spark.createDataFrame(fills, FILLS)
    expected = brute_force(markets, fills)
    for variant in ("fused", "literal"):
        fused = variant == "fused"
        if fused:
            rows = scoring.fused_pnl(m, f, IMS).collect()
        else:
            rows = scoring.literal_pnl(m, f, IMS).collect()
        got = {}
        for r in rows:
            got[(r.user_id, r.token_id)] = (r.market_id, r.operations_count, r.realized_usdc,
                                            r.total_spent, int(r.absolute_profit * 100),
                                            r.relative_profit)
        assert got.keys() == expected.keys(), fused
        for k, v in expected.items():
            assert got[k][:5] == v[:5], (fused, k, got[k], v)
            assert math.isclose(got[k][5], v[5], rel_tol=1e-12), (fused, k)
