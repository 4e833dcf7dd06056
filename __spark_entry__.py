"""

Every registered query reads the whole test tables (markets derived from
``part``, fills from ``lineitem`` joined to ``orders``; see
``marksman.sources.fixtures``) and runs the real stage functions on them.

Comparable form (``comparable``, applied to every registered output; the
oracle does the same). Two kinds of double depend on evaluation order or on
the libm: averages of ratios (summation order) and ``pow`` in the annualised
ratios; they are carried as ``avg_roi`` rounded to 6 decimals (``AP`` to 8)
and the annualised ratios as text with 9 significant digits ('NaN' /
'Infinity' by name). Decimals are carried as their exact text, which shows
every digit and the scale (client libraries map the type itself unlike). All
other values are exact (integer sums, one final division) in both engines.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import warnings
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:  # loaded by file path: make the package importable
    sys.path.insert(0, _HERE)

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle_sql as _oracle
from marksman.operators import ledger, positions, scorecard, sinks, valuation
from marksman.plans import jobs, scoring
from marksman.plans.sizing import (DRIVER_SHARE, broadcast_if_small, checkpointed,
                                    scratch_path)
from marksman.sources import fixtures, rows_as_dicts, run_sql

try:  # the training-data operators are an optional part
    import corpus_pipeline as _pipeline
    from marksman.llm import queries as _llm
except ImportError as _e:
    _pipeline = _llm = None
    if _e.name not in ("corpus_pipeline", "marksman.llm"):  # it is there, but cannot run here
        warnings.warn(f"training-data operators left out: {_e}", stacklevel=2)

FLAGSHIP_SF = "/root/testdata/sf0.001"
INTERMEDIARIES = fixtures.INTERMEDIARIES
TARGET_STAMP = dt.datetime(2024, 1, 1)
BATCH_STAMP = dt.datetime(2024, 2, 1)
SEVERAL_MARKETS = 40
ACTIVE_SINCE = _oracle.ACTIVE_SINCE


# ---------------------------------------------------------------- helpers

def _sig(c: str, digits: int = 9) -> Column:
    x = F.col(c)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("NaN"))
            .when(x == float("inf"), F.lit("Infinity"))
            .when(x == float("-inf"), F.lit("-Infinity"))
            .otherwise(F.format_string(f"%.{digits - 1}e", x)))


_ROUNDED = {"avg_roi": 6, "AP": 8}
_TEXT = {"annual_avg_roi", "annual_portfolio_roi", "annual_ap", "annual_wap"}
_STAMPS = {"created_at", "updated_at"}


def comparable(df: DataFrame) -> DataFrame:
    """Order- and libm-sensitive doubles in comparable form; decimals as text
    with all their digits; audit stamps as naive timestamps. Idempotent."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for c in df.columns:
        t = types[c]
        if isinstance(t, T.DecimalType):
            cols.append(F.col(c).cast("string").alias(c))
        elif c in _ROUNDED and isinstance(t, T.DoubleType):
            cols.append(F.round(F.col(c), _ROUNDED[c]).alias(c))
        elif c in _TEXT and isinstance(t, T.DoubleType):
            cols.append(_sig(c).alias(c))
        elif c in _STAMPS and isinstance(t, T.TimestampType):
            cols.append(F.col(c).cast("timestamp_ntz").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return fixtures.markets(spark, sf), fixtures.fills(spark, sf)


def _outcomes(spark, sf):
    return ledger.market_outcomes(fixtures.markets(spark, sf))


def _operations(spark, sf):
    markets, fills = _inputs(spark, sf)
    outcomes, _ = broadcast_if_small(ledger.market_outcomes(markets), driver_share=DRIVER_SHARE)
    return ledger.operations(ledger.two_sided(fills), outcomes)


def _deduped(spark, sf):
    ops = ledger.exclude_intermediaries(_operations(spark, sf), INTERMEDIARIES)
    return ledger.dedupe_by_priority(ops, INTERMEDIARIES)


def _scores(spark, sf, fused=True):
    markets, fills = _inputs(spark, sf)
    return scoring.score_traders(markets, fills, INTERMEDIARIES, fused=fused)


def _pnl(spark, sf, fused=False):
    markets, fills = _inputs(spark, sf)
    build = scoring.fused_pnl if fused else scoring.literal_pnl
    return build(markets, fills, INTERMEDIARIES)


def _upsert_inputs(spark, sf):
    """Target: every wallet with several markets, profit 0, stamped 2024-01-01
    (an earlier run). Batch: every wallet with a profit, to be stamped
    2024-02-01. Both grow with the tables and come from one scoring, kept as a
    checkpoint of one row per wallet."""
    scores = checkpointed(_scores(spark, sf))
    earlier = scores.where(F.col("markets_count") > SEVERAL_MARKETS).withColumn(
        "profit_usdc", F.lit(0.0))
    target = sinks.upsert(sinks.empty_target(spark), sinks.coerce_scorecard(earlier),
                          now=TARGET_STAMP, next_id=1)
    batch = sinks.coerce_scorecard(scores.where("profit_usdc > 0"))
    return target, batch


# ---------------------------------------------------------------- queries

def q_market_outcomes(spark, sf):
    return _outcomes(spark, sf)


def q_fills_filtered(spark, sf):
    return ledger.live_fills(fixtures.fills(spark, sf))


def q_ledger_two_sided(spark, sf):
    return ledger.two_sided(fixtures.fills(spark, sf))


def q_operations_signed(spark, sf):
    return _operations(spark, sf)


def q_exclude_intermediaries(spark, sf):
    return ledger.exclude_intermediaries(_operations(spark, sf), INTERMEDIARIES)


def q_dedupe_by_priority(spark, sf):
    return _deduped(spark, sf)


def q_position_cashflow(spark, sf):
    return positions.cashflow(_deduped(spark, sf))


def q_last_price(spark, sf):
    return valuation.last_price(_deduped(spark, sf))


def q_position_balance(spark, sf):
    return positions.balance(_deduped(spark, sf))


def q_position_mark_to_market(spark, sf):
    ops = _deduped(spark, sf)
    outcomes, _ = broadcast_if_small(_outcomes(spark, sf), driver_share=DRIVER_SHARE)
    return valuation.mark_to_market(positions.balance(ops), outcomes, valuation.last_price(ops))


def q_position_pnl(spark, sf):
    return _pnl(spark, sf, fused=False)


def q_position_pnl_fused(spark, sf):
    return _pnl(spark, sf, fused=True)


def q_position_pnl_encoded(spark, sf):
    """The fused plan on token ids of production length: every id padded to 77
    characters by one that sorts before all others, so ties fall alike."""
    markets, fills = _inputs(spark, sf)

    def long(c):
        return F.when(c.isin("", ledger.CASH), c).otherwise(F.rpad(c, 77, "!"))

    markets = markets.withColumn("tokens", F.transform("tokens", lambda t: t.withField(
        "token_id", long(t["token_id"])))).withColumn("winner", long(F.col("winner")))
    fills = fills.withColumns({c: long(F.col(c)) for c in ("maker_asset_id", "taker_asset_id")})
    pnl = scoring.fused_pnl(markets, fills, INTERMEDIARIES)
    return pnl.withColumn("token_id", F.rtrim("token_id", F.lit("!")))


def q_trader_rollup(spark, sf):
    return _scores(spark, sf).drop("portfolio_roi", "annual_avg_roi", "annual_portfolio_roi")


def q_trader_ratios(spark, sf):
    return _scores(spark, sf).select("wallet_address", "avg_roi", "portfolio_roi")


def q_trader_annualised(spark, sf):
    from marksman.functions import day_diff
    s = _scores(spark, sf)
    return s.select(
        "wallet_address", day_diff("first_trade_at", "last_trade_at").alias("days"),
        "annual_avg_roi", "annual_portfolio_roi")


def q_traders_scorecard(spark, sf):
    return _scores(spark, sf)


def q_traders_scorecard_literal(spark, sf):
    return _scores(spark, sf, fused=False)


def q_traders_scorecard_listed(spark, sf):
    """Intermediaries given as a one-column DataFrame."""
    markets, fills = _inputs(spark, sf)
    listed = spark.createDataFrame([(a,) for a in INTERMEDIARIES], "user_id string")
    return scoring.score_traders(markets, fills, listed)


def q_top_traders(spark, sf):
    markets, fills = _inputs(spark, sf)
    return scoring.top_traders(markets, fills, INTERMEDIARIES, limit=10_000)


def q_top_traders_threshold(spark, sf):
    """The top 100: the limit binds in every group."""
    markets, fills = _inputs(spark, sf)
    return scoring.top_traders(markets, fills, INTERMEDIARIES, limit=100)


def q_fetched_rows(spark, sf):
    """A bounded result fetched as dicts and given back as rows."""
    top = scorecard.top(_scores(spark, sf), 25).select(
        "wallet_address", "positions_count", "profit_usdc")
    rows = rows_as_dicts(top, max_rows=25)
    return spark.createDataFrame([tuple(r[c] for c in top.columns) for r in rows], top.schema)


def q_top_traders_sql_args(spark, sf):
    df = run_sql(spark, "SELECT * FROM {scores} ORDER BY profit_usdc DESC, wallet_address ASC "
                 "LIMIT :n", args={"n": 25}, scores=_scores(spark, sf))
    return df


def _adhoc(spark, sf):
    markets, fills = _inputs(spark, sf)
    return scorecard.adhoc(scoring.fused_pnl(markets, fills, INTERMEDIARIES, with_units=True))


def q_traders_adhoc(spark, sf):
    return _adhoc(spark, sf)


def q_traders_adhoc_active(spark, sf):
    """The ad hoc variant with its activity test."""
    markets, fills = _inputs(spark, sf)
    pnl = scoring.fused_pnl(markets, fills, INTERMEDIARIES, with_units=True)
    return scorecard.adhoc(pnl, active_since=ACTIVE_SINCE)


def q_traders_adhoc_sample(spark, sf):
    """An unordered LIMIT 10, as what must hold of any: its rows, its distinct
    wallets, and how many of its rows the full result has."""
    full = _adhoc(spark, sf)
    sample = full.limit(10)
    found = F.struct(*[F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in
                       ("tokens_traded", "total_spent_", "day_enter", "day_exit")])
    both = sample.alias("s").join(full.alias("f"), F.col("s.user_id") == F.col("f.user_id"), "left")
    every = F.struct(*[F.lit(True)] * 4)
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_distinct("s.user_id").alias("n_wallets"),
                    F.count_if(found == every).alias("n_found"))


def q_coerced_rows(spark, sf):
    return sinks.coerce_scorecard(_scores(spark, sf))


def q_coerced_bytes(spark, sf):
    """Wallets that arrive as bytes with NULs at their end."""
    scores = _scores(spark, sf)
    padded = F.concat(F.encode("wallet_address", "UTF-8"), F.unhex(F.lit("0000")))
    return sinks.coerce_scorecard(scores.withColumn("wallet_address", padded))


def q_key_violations(spark, sf):
    return sinks.key_violations(fixtures.fills(spark, sf), key="id")


def q_upsert_first_run(spark, sf):
    _, batch = _upsert_inputs(spark, sf)
    return sinks.upsert(sinks.empty_target(spark), batch, now=BATCH_STAMP).drop("id")


def q_upsert_scorecard(spark, sf):
    target, batch = _upsert_inputs(spark, sf)
    return sinks.upsert(target, batch, now=BATCH_STAMP).drop("id")


def _snapshot(spark, sf):
    """The target and the upserted batch written as two snapshot versions; the
    current one read back."""
    root = scratch_path(spark, "snapshot-check")
    target, batch = _upsert_inputs(spark, sf)
    sinks.write_snapshot(target, root)
    merged = sinks.upsert(sinks.read_snapshot(spark, root), batch, now=BATCH_STAMP)
    sinks.write_snapshot(merged, root)
    return sinks.read_snapshot(spark, root)


def q_snapshot_rows(spark, sf):
    return _snapshot(spark, sf).drop("id")


def q_snapshot_count(spark, sf):
    return spark.createDataFrame([(sinks.snapshot_count(_snapshot(spark, sf)),)],
                                 "total_users bigint")


def q_empty_summary(spark, sf):
    """A refresh on the soft-deleted fills alone, which leave nothing to store:
    zeros, no total, no version written."""
    markets, fills = _inputs(spark, sf)
    gone = fills.where("is_deleted = 1")
    root = scratch_path(spark, "empty-check")
    s = jobs.refresh(spark, markets, gone, root, intermediaries=INTERMEDIARIES, now=BATCH_STAMP)
    assert "total_users_in_db" not in s
    versions = sinks.current_version(spark, root) or 0
    return gone.agg(F.lit(s["users_processed"]).cast("long").alias("users_processed"),
                    F.lit(s["users_stored"]).cast("long").alias("users_stored"),
                    F.lit(versions).cast("long").alias("versions"),
                    F.count(F.lit(1)).alias("fills_read"))


def q_run_summary(spark, sf):
    markets, fills = _inputs(spark, sf)
    root = scratch_path(spark, "refresh-check")
    s = jobs.refresh(spark, markets, fills, root, intermediaries=INTERMEDIARIES,
                     limit=jobs.PRESETS["top"], now=BATCH_STAMP)
    return spark.createDataFrame(
        [(s["users_processed"], s["users_stored"], s.get("total_users_in_db", 0))],
        "users_processed bigint, users_stored bigint, total_users_in_db bigint")


def q_run_stored_rows(spark, sf):
    """The rows that a refresh stored, after a retry under the same name."""
    markets, fills = _inputs(spark, sf)
    root = scratch_path(spark, "stored-check")
    for _ in range(2):
        jobs.refresh(spark, markets, fills, root, intermediaries=INTERMEDIARIES,
                     limit=jobs.PRESETS["top"], now=BATCH_STAMP, run="daily")
    return sinks.read_snapshot(spark, root).drop("id")


# ---------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the top 10 000 wallets by profit on /root/testdata/sf0.001."""
    markets, fills = _inputs(spark, FLAGSHIP_SF)
    return scoring.top_traders(markets, fills, INTERMEDIARIES, limit=10_000)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "market_outcomes": q_market_outcomes,
    "fills_filtered": q_fills_filtered,
    "ledger_two_sided": q_ledger_two_sided,
    "operations_signed": q_operations_signed,
    "exclude_intermediaries": q_exclude_intermediaries,
    "dedupe_by_priority": q_dedupe_by_priority,
    "position_cashflow": q_position_cashflow,
    "last_price": q_last_price,
    "position_balance": q_position_balance,
    "position_mark_to_market": q_position_mark_to_market,
    "position_pnl": q_position_pnl,
    "position_pnl_fused": q_position_pnl_fused,
    "position_pnl_encoded": q_position_pnl_encoded,
    "trader_rollup": q_trader_rollup,
    "trader_ratios": q_trader_ratios,
    "trader_annualised": q_trader_annualised,
    "traders_scorecard": q_traders_scorecard,
    "traders_scorecard_literal": q_traders_scorecard_literal,
    "traders_scorecard_listed": q_traders_scorecard_listed,
    "top_traders": q_top_traders,
    "top_traders_threshold": q_top_traders_threshold,
    "fetched_rows": q_fetched_rows,
    "top_traders_sql_args": q_top_traders_sql_args,
    "traders_adhoc": q_traders_adhoc,
    "traders_adhoc_active": q_traders_adhoc_active,
    "traders_adhoc_sample": q_traders_adhoc_sample,
    "coerced_rows": q_coerced_rows,
    "coerced_bytes": q_coerced_bytes,
    "key_violations": q_key_violations,
    "upsert_first_run": q_upsert_first_run,
    "upsert_scorecard": q_upsert_scorecard,
    "snapshot_rows": q_snapshot_rows,
    "snapshot_count": q_snapshot_count,
    "empty_summary": q_empty_summary,
    "run_summary": q_run_summary,
    "run_stored_rows": q_run_stored_rows,
}


def _compared(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _compared(v) for k, v in _QUERIES.items()}
    if _llm is not None:
        out |= _llm.QUERIES
        out["pipeline"] = _pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per key over the pre-registered test tables; none for what
    SQL cannot express (training-data operators)."""
    out = {k: v for k, v in _oracle.queries().items() if k in _QUERIES}
    if _llm is not None:
        out |= _llm.ORACLE_SQL
        if _pipeline.ORACLE_SQL:
            out["pipeline"] = _pipeline.ORACLE_SQL
    return out
