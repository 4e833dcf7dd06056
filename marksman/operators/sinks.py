"""Sinks: the keyed scorecard snapshot.

The target is a folder of versions, ``<root>/version=<number>-<run>`` (Parquet).
Spark writes a version to ``<root>/_next``, which readers do not list, and a
complete one is renamed to its name: the rename is the commit. A write that dies
leaves the current version and, at most, a ``_next`` that the next write overwrites.
A run that is repeated under its name finds its version and writes none. One refresh
of a target runs at a time; that is the job scheduler's part.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marksman.plans.sizing import checkpointed
from marksman.schemas import (SCORE_MEASURES, SCORECARD, SCORECARD_DEFAULTS, SCORECARD_KEY,
                              SCORECARD_KEY_MAX_LEN)

_COUNTS = ["positions_count", "markets_count"]
_ANNUAL = ["annual_avg_roi", "annual_portfolio_roi"]
_TIMES = ["first_trade_at", "last_trade_at"]


def empty_target(spark: SparkSession) -> DataFrame:
    """The target on its first run: no rows, the declared schema."""
    return spark.createDataFrame([], SCORECARD)


def _required(c: str, dtype: str) -> Column:
    return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL value in column {c}"))) \
        .otherwise(F.col(c).cast(dtype))


def coerce_scorecard(df: DataFrame) -> DataFrame:
    """Shape a scorecard batch for the target.

    The wallet may arrive as zero-padded bytes: decode UTF-8 and drop trailing
    NUL characters. Counts become INT and measures DOUBLE; a missing column
    takes its default; a NULL fails the write, except in the two annualised
    columns, where it becomes 0. Trade times pass through.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    wallet = F.col(SCORECARD_KEY)
    if isinstance(fields.get(SCORECARD_KEY), T.BinaryType):
        wallet = F.expr(f"trim(TRAILING '\\0' FROM decode({SCORECARD_KEY}, 'UTF-8'))")
    cols = [wallet.alias(SCORECARD_KEY)]
    for c in SCORE_MEASURES:
        if c not in fields:
            default = SCORECARD_DEFAULTS.get(c)
            target_type = SCORECARD[c].dataType
            cols.append(F.lit(default).cast(target_type).alias(c))
        elif c in _TIMES:
            cols.append(F.col(c).cast("timestamp_ntz").alias(c))
        elif c in _ANNUAL:
            cols.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c))
        elif c in _COUNTS:
            cols.append(_required(c, "int").alias(c))
        else:
            cols.append(_required(c, "double").alias(c))
    return df.select(*cols)


def key_violations(df: DataFrame, key: str = SCORECARD_KEY,
                   max_len: int = SCORECARD_KEY_MAX_LEN) -> DataFrame:
    """Keys that break NOT NULL, UNIQUE or the length bound: (key, n)."""
    k = F.col(key)
    return (df.groupBy(k).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) | k.isNull() | (F.length(k) > max_len)))


def upsert(target: DataFrame, batch: DataFrame, *, now: dt.datetime,
           key: str = SCORECARD_KEY, next_id: int | None = None,
           max_len: int = SCORECARD_KEY_MAX_LEN) -> DataFrame:
    """Insert new keys, overwrite the measures of existing ones.

    One grouped pass over target and batch, tagged by origin: for a key in the
    batch every measure comes from the batch, NULLs included (not ``coalesce``),
    and ``updated_at`` is ``now``; ``created_at`` and ``id`` stay. Keys absent from
    the batch are untouched; nothing is deleted. A key that is NULL, too long or
    more than once in the target or in the batch fails the pass. The result is
    checkpointed; new keys, and only they, then take the ids from ``next_id`` on
    (default: the target's greatest id + 1), without gaps: in each partition they
    come first, and one count a partition reaches the driver. ``now`` is one literal
    for the whole batch.
    """
    spark = target.sparkSession
    # from text: a naive ``now`` is wall-clock time in the session time zone,
    # an aware one keeps its instant (a Python literal would use the driver
    # process's zone instead)
    now_lit = F.lit(now.isoformat(sep=" ")).cast("timestamp")
    old = target.select(*[f.name for f in SCORECARD], F.lit(False).alias("_in_batch"))
    fresh = batch.select(
        *[F.col(f.name).cast(f.dataType) if f.name == key or f.name in SCORE_MEASURES
          else F.lit(None).cast(f.dataType).alias(f.name) for f in SCORECARD],
        F.lit(True).alias("_in_batch"))
    new, had = F.col("_in_batch"), ~F.col("_in_batch")
    # a key has one row of each origin, so a maximum is that row's value
    picked = old.unionByName(fresh).groupBy(key).agg(
        F.count_if(new).alias("_new"), F.count_if(had).alias("_old"),
        *[F.max(F.when(had, F.col(c))).alias(f"_{c}") for c in ("id", "created_at", "updated_at")],
        *[F.max(F.when(new, F.col(c))).alias(f"_new_{c}") for c in SCORE_MEASURES],
        *[F.max(F.when(had, F.col(c))).alias(f"_old_{c}") for c in SCORE_MEASURES])
    k, in_batch = F.col(key), F.col("_new") > 0
    broken = k.isNull() | (F.length(k) > max_len) | (F.col("_new") > 1) | (F.col("_old") > 1)
    checked = F.when(broken, F.raise_error(F.concat(
        F.lit("key constraint broken (NULL, duplicate or too long): "),
        F.coalesce(k, F.lit("NULL"))))).otherwise(k)
    merged = picked.select(
        checked.alias(key), F.col("_id").alias("id"),
        *[F.when(in_batch, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c)
          for c in SCORE_MEASURES],
        F.coalesce("_created_at", now_lit).alias("created_at"),
        F.when(in_batch, now_lit).otherwise(F.col("_updated_at")).alias("updated_at"))
    # new keys first in their partition: their numbers in it are 0, 1, ...
    rows = checkpointed(merged.sortWithinPartitions(F.col("id").isNotNull()).withColumn(
        "_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(
        F.count_if(F.col("id").isNull()).alias("n"), F.max("id").alias("top")).collect()
    if next_id is None:
        next_id = 1 + max((r.top for r in sizes if r.top is not None), default=0)
    offsets, running = [], next_id
    for r in sorted(sizes):
        offsets.append((r[0], running))
        running += r.n
    before = spark.createDataFrame(offsets or [(0, next_id)], "_part bigint, _first bigint")
    given = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = rows.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(
        "id", F.coalesce("id", given))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORECARD])


_VERSION = re.compile(r"/version=(\d+)-([^/]+)/[^/]+$")
_RUN = re.compile(r"[A-Za-z0-9._]+")
_STORED = "stored"


def versions(spark: SparkSession, root: str) -> dict[int, str]:
    """Number and run of every version under ``root``, from Spark's own listing."""
    try:
        files = (spark.read.schema(SCORECARD).option("recursiveFileLookup", "true")
                 .parquet(root).inputFiles())
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    found = (_VERSION.search(f) for f in files)
    return {int(m[1]): m[2] for m in found if m}


def current_version(spark: SparkSession, root: str) -> int | None:
    """Greatest version under ``root`` (None before the first)."""
    return max(versions(spark, root), default=None)


def _folder(root: str, number: int, run: str) -> str:
    return f"{root}/version={number:06d}-{run}"


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The current snapshot, or an empty target before the first write."""
    found = versions(spark, root)
    if not found:
        return empty_target(spark)
    last = max(found)
    return (spark.read.schema(SCORECARD).parquet(_folder(root, last, found[last]))
            .select(*[f.name for f in SCORECARD]))


def _fs(spark: SparkSession, path: str):
    """The path's Hadoop file system, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _renamed(spark: SparkSession, source: str, to: str) -> None:
    fs, a = _fs(spark, source)
    if not fs.rename(a, _fs(spark, to)[1]):
        raise RuntimeError(f"{source} could not be renamed to {to}")


def _expired(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the last ``keep`` versions (at least two: one may be read)."""
    found = versions(spark, root)
    for number in sorted(found)[:-max(2, keep)]:
        fs, p = _fs(spark, _folder(root, number, found[number]))
        fs.delete(p, True)


def stored_by(spark: SparkSession, root: str, run: str) -> int | None:
    """The ``stored`` that ``run`` published its version with, from the files' schema;
    None if it has published none or no such number."""
    number = next((n for n, r in versions(spark, root).items() if r == run), None)
    if number is None:
        return None
    schema = spark.read.parquet(_folder(root, number, run)).schema
    return schema[SCORECARD_KEY].metadata.get(_STORED)


def write_snapshot(df: DataFrame, root: str, *, run: str | None = None, keep: int = 3,
                   stored: int | None = None) -> int:
    """Write ``df`` as the next version and return its number. If ``run`` has a
    version already, that one stands and nothing is written. ``stored``, the rows of
    the batch, goes into the version's files as metadata of the key."""
    spark = df.sparkSession
    run = run or uuid.uuid4().hex[:12]
    if not _RUN.fullmatch(run):
        raise ValueError("a run's name is made of letters, digits, dots and underscores")
    found = versions(spark, root)
    number = next((n for n, r in found.items() if r == run), None)
    if number is None:
        number = max(found, default=0) + 1
        if stored is not None:
            df = df.withMetadata(SCORECARD_KEY, {_STORED: stored})
        df.write.mode("overwrite").parquet(f"{root}/_next")
        _renamed(spark, f"{root}/_next", _folder(root, number, run))
    _expired(spark, root, keep)
    return number


def snapshot_count(df: DataFrame) -> int:
    """Row count of a snapshot; 0, and a log entry, when it cannot be counted."""
    try:
        return df.count()
    except Exception:  # noqa: BLE001 - the surveyed behaviour: a failed count reports 0
        logging.getLogger(__name__).exception("the snapshot could not be counted")
        return 0


__all__ = [
    "coerce_scorecard",
    "current_version",
    "empty_target",
    "key_violations",
    "read_snapshot",
    "snapshot_count",
    "stored_by",
    "upsert",
    "versions",
    "write_snapshot",
]
