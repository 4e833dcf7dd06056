"""The refresh job: score, rank, upsert into the snapshot, summarise."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

if __package__ in (None, ""):  # started as a file: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession

from marksman.operators import sinks
from marksman.plans.scoring import Intermediaries, top_traders
from marksman.plans.sizing import checkpointed

# Result sizes of the two scheduled runs; fixed values.
PRESETS = {"top": 10_000, "full": 50_000}


def refresh(spark: SparkSession, markets: DataFrame, fills: DataFrame, target_root: str, *,
            intermediaries: Intermediaries, limit: int = PRESETS["top"],
            now: dt.datetime | None = None, run: str | None = None, **score_kw) -> dict:
    """Score every wallet, keep the ``limit`` most profitable, upsert them into
    the snapshot under ``target_root`` and report what happened.

    The ranked batch is checkpointed (empty check, upsert), then the merged target.
    Only the summary reaches the driver. With ``run``, a name for this refresh, a
    retry after a failure at any step gives the same version: if the failed attempt
    had published it, the retry publishes nothing, scores nothing and reports what
    that version stored.
    """
    started = time.monotonic()
    now = now or dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    stored = None if run is None else sinks.stored_by(spark, target_root, run)
    if stored is None:
        batch = checkpointed(sinks.coerce_scorecard(
            top_traders(markets, fills, intermediaries, limit=limit, **score_kw)))
        stored = batch.count()
        if stored == 0:
            return {"users_processed": 0, "users_stored": 0,
                    "elapsed_seconds": round(time.monotonic() - started, 3)}
        if run is None or run not in sinks.versions(spark, target_root).values():
            merged = sinks.upsert(sinks.read_snapshot(spark, target_root), batch, now=now)
            sinks.write_snapshot(merged, target_root, run=run, stored=stored)
    total = sinks.snapshot_count(sinks.read_snapshot(spark, target_root))
    return {
        "users_processed": stored,
        "users_stored": stored,
        "total_users_in_db": total,
        "elapsed_seconds": round(time.monotonic() - started, 3),
    }


def main(argv: list[str] | None = None) -> dict:
    """``spark-submit marksman/plans/jobs.py --markets P --fills P --target P
    --intermediary ADDR [--intermediary ADDR ...] [--preset top|full | --limit N] [--run NAME]``"""
    import argparse
    import json

    from marksman.sources import read_fills, read_markets

    ap = argparse.ArgumentParser(description="Refresh the trader scorecard snapshot.")
    ap.add_argument("--markets", required=True)
    ap.add_argument("--fills", required=True)
    ap.add_argument("--target", required=True)
    ap.add_argument("--preset", choices=sorted(PRESETS), default="top")
    ap.add_argument("--limit", type=int)
    ap.add_argument("--run", help="a name for this refresh; a retry under it publishes once")
    ap.add_argument("--intermediary", action="append", required=True,
                    help="an exchange-side address; repeatable")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("marksman-refresh").getOrCreate()
    summary = refresh(spark, read_markets(spark, args.markets), read_fills(spark, args.fills),
                      args.target, intermediaries=args.intermediary,
                      run=args.run,
                      limit=PRESETS[args.preset] if args.limit is None else args.limit)
    print(json.dumps(summary))
    return summary


__all__ = ["PRESETS", "main", "refresh"]


if __name__ == "__main__":
    main()
