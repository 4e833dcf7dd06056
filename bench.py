"""Benchmark the headline queries; prints ONE JSON line.

Inputs: markets and fills derived from the test tables at $BENCH_SF_DIR
(default /root/testdata/sf0.1), written once to Parquet under the session's
checkpoint directory (setup, reported apart) as 2 x cores files, the way a
large fills table arrives as many files, then every query reads them back
through the typed scans, as a production run would. Each query runs to
completion through the ``noop`` sink (or a bounded collect for top-N);
wall seconds, median of $BENCH_REPS (default 3) after one untimed warm-up
run of every query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from marksman.operators import scorecard  # noqa: E402
from marksman.plans import jobs, scoring  # noqa: E402
from marksman.plans.sizing import scratch_path  # noqa: E402
from marksman.session import local_session  # noqa: E402
from marksman.sources import fixtures, read_fills, read_markets  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))
ONLY = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]


def _sf(path: str) -> float | str:
    name = os.path.basename(path.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def long_ids(markets, fills, path: str) -> None:
    """The same inputs with token ids of production length (77 digits)."""
    def long(c):
        digits = F.conv(F.substring(F.md5(c), 1, 15), 16, 10)
        return F.when(c.isin("", "0"), c).otherwise(F.rpad(digits, 77, "7"))

    markets.withColumn("tokens", F.transform("tokens", lambda t: t.withField(
        "token_id", long(t["token_id"])))).withColumn("winner", long(F.col("winner"))
                                                      ).write.parquet(f"{path}/markets")
    fills.withColumns({c: long(F.col(c)) for c in ("maker_asset_id", "taker_asset_id")}
                      ).write.parquet(f"{path}/fills")


def main() -> None:
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * int(CPUS))))
    spark = local_session(cores=CPUS, shuffle_partitions=parts, app="marksman-bench")
    spark.sparkContext.setLogLevel("ERROR")
    data = scratch_path(spark, "bench-inputs")
    t0 = time.time()
    fixtures.markets(spark, SF_DIR).write.parquet(f"{data}/markets")
    fixtures.fills(spark, SF_DIR).repartition(2 * int(CPUS)).write.parquet(f"{data}/fills")
    long_ids(read_markets(spark, f"{data}/markets"),
             read_fills(spark, f"{data}/fills"), f"{data}/long")
    setup_s = time.time() - t0

    def inputs():
        return read_markets(spark, f"{data}/markets"), read_fills(spark, f"{data}/fills")

    ims = fixtures.INTERMEDIARIES

    def run_noop(df):
        df.write.format("noop").mode("overwrite").save()

    def q_top_traders():
        m, f = inputs()
        scoring.top_traders(m, f, ims, limit=10_000).collect()

    def q_top_traders_literal():
        m, f = inputs()
        scorecard.top(scoring.score_traders(m, f, ims, fused=False), 10_000).collect()

    def q_scorecard_all():
        m, f = inputs()
        run_noop(scoring.score_traders(m, f, ims))

    def q_traders_adhoc():
        m, f = inputs()
        run_noop(scorecard.adhoc(scoring.fused_pnl(m, f, ims, with_units=True)))

    def q_top_traders_long_ids():
        m, f = (read_markets(spark, f"{data}/long/markets"),
                read_fills(spark, f"{data}/long/fills"))
        scoring.top_traders(m, f, ims, limit=10_000).collect()

    def q_refresh_job():
        m, f = inputs()
        jobs.refresh(spark, m, f, scratch_path(spark, "bench-target"), intermediaries=ims,
                     limit=jobs.PRESETS["top"])

    queries = {
        "top_traders": q_top_traders,
        "top_traders_literal": q_top_traders_literal,
        "scorecard_all": q_scorecard_all,
        "traders_adhoc": q_traders_adhoc,
        "refresh_job": q_refresh_job,
        "top_traders_long_ids": q_top_traders_long_ids,
    }
    if ONLY:
        queries = {k: v for k, v in queries.items() if k in ONLY}

    for fn in queries.values():  # warm-up, untimed: JIT, file listing, codegen caches
        fn()
    times = {}
    for name, fn in queries.items():
        runs = []
        for _ in range(REPS):
            spark.catalog.clearCache()  # tables held by the run before
            t = time.time()
            fn()
            runs.append(time.time() - t)
        times[name] = round(statistics.median(runs), 3)

    print(json.dumps({
        "metric": "top_traders_wall_s",
        "value": times.get("top_traders", next(iter(times.values()))),
        "unit": "sec",
        "queries": times,
        "sf": _sf(SF_DIR),
        "cpus": int(CPUS),
        "setup_s": round(setup_s, 3),
    }))


if __name__ == "__main__":
    main()
