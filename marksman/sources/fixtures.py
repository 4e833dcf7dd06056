"""Markets and fills derived from the TPC-H style test tables.

Integer arithmetic only, so an independent SQL engine computes the same rows.
Every part is a market with two outcome tokens; every line item joined to its
order is one fill. Edge cases come from fixed rules on the keys.

Fixed values of the mapping:
  market      question_id 'm'||p_partkey, condition_id 'c'||p_partkey,
              condition_id '' (market ignored) when p_partkey % 20 = 0
  tokens      ('t'||p_partkey||'a', 'Yes'), ('t'||p_partkey||'b', 'No');
              empty list when p_partkey % 20 = 10;
              a third listing ('t'||(p_partkey-1)||'a', 'Also') when
              p_partkey % 25 = 3 (one token listed in two markets)
  winner      by p_size % 3: 0 -> '' (open), 1 -> token a, 2 -> token b
  end date    '2001-12-31'
  fill id     'x'||l_orderkey||'_'||l_linenumber (repeats in the data)
  maker       'w'||o_custkey
  taker       '0xexa' for line 7, '0xexb' for line 1, else 'w'||l_suppkey
  side        maker buys when l_linestatus = 'O'; token b when
              l_returnflag = 'R', else token a
  swap        token for token when bigint(l_quantity) % 17 = 0
  amounts     tokens q * 1000000 (0 when (l_orderkey*7 + l_linenumber) % 997
              = 0), cash q * 1000 * (1 + (l_orderkey*31 + l_partkey*17 +
              l_linenumber) % 998)
  deleted     l_orderkey % 50 = 0
  intermediaries '0xexa', '0xexb'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marksman.schemas import FILLS, MARKETS

INTERMEDIARIES = ["0xexa", "0xexb"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def markets_from_parts(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    tok_a = F.concat(F.lit("t"), k.cast("string"), F.lit("a"))
    tok_b = F.concat(F.lit("t"), k.cast("string"), F.lit("b"))
    tok_prev = F.concat(F.lit("t"), (k - 1).cast("string"), F.lit("a"))

    def outcome(token, label):
        return F.struct(token.alias("token_id"), F.lit(label).alias("outcome"))

    pair = F.array(outcome(tok_a, "Yes"), outcome(tok_b, "No"))
    tokens = (
        F.when(k % 20 == 10, F.slice(pair, 1, 0))
        .when(k % 25 == 3, F.array(outcome(tok_a, "Yes"), outcome(tok_b, "No"),
                                   outcome(tok_prev, "Also")))
        .otherwise(pair)
    )
    size_class = F.col("p_size") % 3
    winner = (
        F.when(size_class == 1, tok_a).when(size_class == 2, tok_b).otherwise(F.lit(""))
    )
    cols = {
        "question_id": F.concat(F.lit("m"), k.cast("string")),
        "condition_id": F.when(k % 20 == 0, F.lit("")).otherwise(
            F.concat(F.lit("c"), k.cast("string"))),
        "tokens": tokens,
        "winner": winner,
        "end_date_iso": F.lit("2001-12-31"),
    }
    return part.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in MARKETS])


def fills_from_lineitems(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(od, "l_orderkey")

    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    q = F.col("l_quantity").cast("bigint")
    swap = q % 17 == 0
    maker_buys = F.col("l_linestatus") == "O"
    ret = F.col("l_returnflag") == "R"
    stem = F.concat(F.lit("t"), pk.cast("string"))
    tok = F.concat(stem, F.when(ret, F.lit("b")).otherwise(F.lit("a")))
    tok2 = F.concat(stem, F.when(ret, F.lit("a")).otherwise(F.lit("b")))
    tamt = F.when((ok * 7 + ln) % 997 == 0, F.lit(0).cast("bigint")).otherwise(q * 1000000)
    uamt = q * 1000 * (1 + (ok * 31 + pk * 17 + ln) % 998)
    maker_gives_token = swap | ~maker_buys

    cols = {
        "id": F.concat(F.lit("x"), ok.cast("string"), F.lit("_"), ln.cast("string")),
        "timestamp": F.col("l_shipdate"),
        "maker": F.concat(F.lit("w"), F.col("o_custkey").cast("string")),
        "taker": F.when(ln == 7, F.lit("0xexa")).when(ln == 1, F.lit("0xexb"))
        .otherwise(F.concat(F.lit("w"), F.col("l_suppkey").cast("string"))),
        "maker_asset_id": F.when(maker_gives_token, tok).otherwise(F.lit("0")),
        "taker_asset_id": F.when(swap, tok2).when(maker_buys, tok).otherwise(F.lit("0")),
        "maker_amount_filled": F.when(maker_gives_token, tamt).otherwise(uamt),
        "taker_amount_filled": F.when(swap | maker_buys, tamt).otherwise(uamt),
        "is_deleted": F.when(ok % 50 == 0, F.lit(1)).otherwise(F.lit(0)),
    }
    return j.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in FILLS])


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets_from_parts(_table(spark, sf_dir, "part"))


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fills_from_lineitems(_table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders"))


__all__ = ["INTERMEDIARIES", "fills", "fills_from_lineitems", "markets", "markets_from_parts"]
