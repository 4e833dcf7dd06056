"""Write the formatted physical plan of the flagship query (fused and
literal) after execution, with exchange and aggregate counts.

    python -m tools.plan_report /root/testdata/sf0.1 > docs/PLAN.md
"""

from __future__ import annotations

import re
import sys


def main() -> None:
    sys.path.insert(0, ".")
    from marksman.operators import scorecard
    from marksman.plans import scoring
    from marksman.plans.sizing import scratch_path
    from marksman.session import local_session
    from marksman.sources import fixtures, read_fills, read_markets

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    root = scratch_path(spark, "plan-report")
    fixtures.markets(spark, sf).write.parquet(f"{root}/markets")
    fixtures.fills(spark, sf).repartition(16).write.parquet(f"{root}/fills")
    m, f = read_markets(spark, f"{root}/markets"), read_fills(spark, f"{root}/fills")
    print("# Physical plans of `top_traders` (after execution, AQE final plan)\n")
    print(f"Inputs: markets and fills derived from `{sf}`, 16 Parquet files; local[8], "
          "16 shuffle partitions. Generated by `tools/plan_report.py`.\n")
    for fused in (True, False):
        df = scorecard.top(scoring.score_traders(m, f, fixtures.INTERMEDIARIES, fused=fused),
                           10_000)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        final = final.split("+- == Initial Plan ==")[0]
        counts = {
            "shuffle exchanges": len(re.findall(r"Exchange hashpartitioning", final)),
            "reused exchanges": final.count("ReusedExchange"),
            "broadcast exchanges": final.count("BroadcastExchange"),
            "hash aggregates": final.count("HashAggregate("),
            "sort aggregates": final.count("SortAggregate("),
            "python UDF nodes": final.count("EvalPython"),
        }
        print(f"## {'Fused plan (default)' if fused else 'Literal stages'}\n")
        print("| " + " | ".join(counts) + " |")
        print("|" + "---|" * len(counts))
        print("| " + " | ".join(str(v) for v in counts.values()) + " |\n")
        print("```")
        print(final.rstrip())
        print("```\n")


if __name__ == "__main__":
    main()
