"""Data-scaling probe: the fused scorecard on k copies of the fills derived
from one test scale (each copy with its own transaction ids, so positions get
k times the trades while wallets and tokens stay the same).

    python -m tools.scale_probe /root/testdata/sf0.1 1 4 8
"""

from __future__ import annotations

import json
import statistics
import sys
import time


def main() -> None:
    sys.path.insert(0, ".")
    from pyspark.sql import functions as F

    from marksman.plans import scoring
    from marksman.plans.sizing import scratch_path
    from marksman.session import local_session
    from marksman.sources import fixtures, read_fills, read_markets

    sf = sys.argv[1]
    copies = [int(k) for k in sys.argv[2:]] or [1, 4]
    spark = local_session(shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "scale-probe")
    fixtures.markets(spark, sf).write.parquet(f"{root}/markets")
    base = fixtures.fills(spark, sf)
    out = {}
    for k in copies:
        copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy")
        fills = (base.select("*", copy)
                 .withColumn("id", F.concat(F.substring_index("id", "_", 1), F.lit("c"),
                                            F.col("copy").cast("string"), F.lit("_"),
                                            F.substring_index("id", "_", -1)))
                 .drop("copy"))
        fills.repartition(16 * k).write.parquet(f"{root}/fills{k}")
        m, f = read_markets(spark, f"{root}/markets"), read_fills(spark, f"{root}/fills{k}")
        n = f.count()
        runs = []
        for _ in range(4):
            spark.catalog.clearCache()  # positions held by the run before
            t = time.time()
            scoring.score_traders(m, f, fixtures.INTERMEDIARIES).write.format("noop") \
                .mode("overwrite").save()
            runs.append(time.time() - t)
        out[k] = {"fills": n, "wall_s": round(statistics.median(runs[1:]), 2)}
        print(json.dumps({k: out[k]}), flush=True)


if __name__ == "__main__":
    main()
