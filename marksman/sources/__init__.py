"""Sources: typed scans of the two inputs and bounded result fetches."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from marksman.schemas import FILLS, MARKETS


def read_markets(spark: SparkSession, path: str) -> DataFrame:
    """Scan the nested markets table with its declared schema."""
    return spark.read.schema(MARKETS).parquet(path)


def read_fills(spark: SparkSession, path: str) -> DataFrame:
    """Scan the flat fills table; filters and projections applied later are
    pushed into the Parquet scan by Catalyst."""
    return spark.read.schema(FILLS).parquet(path)


def run_sql(spark: SparkSession, sql: str, args: dict[str, Any] | None = None,
            **frames: DataFrame) -> DataFrame:
    """Run a SQL string with named parameters (``:name`` markers bound from
    ``args``) and DataFrames referenced as ``{name}``."""
    return spark.sql(sql, args=args or {}, **frames)


def rows_as_dicts(df: DataFrame, max_rows: int) -> list[dict[str, Any]]:
    """Rows of a *bounded* result as dicts keyed by column name.

    Refuses results over ``max_rows`` instead of pulling an unbounded table
    onto the driver.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; fetch a bounded result")
    return [r.asDict(recursive=True) for r in rows]


__all__ = ["read_fills", "read_markets", "rows_as_dicts", "run_sql"]
