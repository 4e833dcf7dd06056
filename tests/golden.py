"""The golden case: seven fills on four markets, values worked out by hand."""

import datetime as dt

from marksman.schemas import FILLS, MARKETS

EX = "EX"
INTERMEDIARIES = [EX]


def _o(token, outcome):
    return {"token_id": token, "outcome": outcome}


MARKET_ROWS = [
    ("M1", "c1", [_o("T1", "Yes"), _o("T2", "No")], "T1", "2024-02-01"),
    ("M2", "c2", [_o("T3", "Yes"), _o("T4", "No")], "", "2024-02-01"),
    ("M3", "", [_o("T5", "Yes")], "", "2024-02-01"),
    ("M4", "c4", [], "", "2024-02-01"),
]


def ts(day, hour):
    return dt.datetime(2024, 1, day, hour, 0)


FILL_ROWS = [
    ("a_1", ts(1, 10), "W1", EX, "0", "T1", 500000, 1000000, 0),
    ("a_2", ts(1, 10), "W2", "W1", "T1", "0", 1000000, 500000, 0),
    ("b_1", ts(11, 9), "W1", "W3", "T1", "0", 400000, 240000, 0),
    ("c_1", ts(21, 8), "W3", EX, "0", "T3", 333333, 1000000, 0),
    ("d_1", ts(22, 8), "W1", "W2", "T1", "T3", 10, 10, 0),
    ("e_1", ts(23, 8), "W1", "W2", "0", "T1", 10, 10, 1),
    ("f_1", ts(24, 8), "W1", "W2", "0", "T5", 10, 10, 0),
]


def markets(spark):
    return spark.createDataFrame(MARKET_ROWS, MARKETS)


def fills(spark, rows=None):
    return spark.createDataFrame(rows or FILL_ROWS, FILLS)
