"""marksman: score traders on outcome markets with Spark DataFrames.

Pipeline (every step is a lazy DataFrame -> DataFrame function):

    markets, fills
      -> operators.ledger      outcome listings, two-sided signed ledger,
                               intermediary filter, dedupe by priority
      -> operators.positions   per (wallet, token) cash flow and balance
      -> operators.valuation   last trade price, mark to market
      -> operators.scorecard   per wallet rollup, ratios, annualisation, top N
      -> operators.sinks       keyed upsert into a versioned snapshot

``plans.scoring`` wires the stages into one plan (fused where the stages share
keys), ``plans.jobs`` is the refresh job with its run summary.
"""

from marksman.schemas import FILLS, MARKETS, SCORECARD  # noqa: F401

__all__ = ["FILLS", "MARKETS", "SCORECARD"]
