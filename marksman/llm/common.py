"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marksman.plans.sizing import broadcast_if_small, checkpointed, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by Spark's own reader (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda variable is the only binding a column expression has; without it
    a column that a lambda refers to is evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), 0)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package (once per application): its
    sources go out as a zip file by ``SparkContext.addPyFile``."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="marksman-code-")) / "marksman_code.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, Path(package.name) / source.relative_to(package))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


# Rows and bytes of an Arrow batch: texts are long, and of each core's batches
# several copies are alive (written, sent, read). A longer text is a batch alone.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", str(BATCH_ROWS)),
          "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", str(BATCH_BYTES))}


def _give_back() -> None:
    """Return freed memory to the system: workers stay between their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


# What a worker keeps between the tasks of one operator, and that operator's module.
_KEPT: dict[str, object] = {}
_OWNER: list[str] = []


def kept(name: str, make: Callable[[], object]) -> object:
    """``make()``, kept for the later tasks of this worker until it works for
    another operator."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def _begin(owner: str) -> None:
    """Drop what the tasks of another operator have left in this worker."""
    if _OWNER != [owner]:
        _KEPT.clear()
        _OWNER[:] = [owner]
        gc.collect()
        _give_back()


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package known to the workers, in
    batches of ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes unless the session has
    set these bounds (they are read when the rows are, so they stay set)."""
    spark = df.sparkSession
    ship(spark)
    for name, (default, value) in _BATCH.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, value)

    owner = run.__module__

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(owner)
        try:
            yield from run(batches)
        finally:
            _give_back()

    return df.mapInArrow(tidy, schema)


def arrow_rows(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that Python objects exist for few rows at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read
    again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a ``written`` table once all that reads it is written."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# A key is hot from so many rows on, and never more than so many keys are.
HOT, HOT_KEYS = 2_000, 100_000


def hot_keys(sizes: DataFrame, keys: list[str], n: str = "n") -> DataFrame | None:
    """The keys with by far the most rows, of a (written) table with a row for each
    key and its number of rows: those of over ``HOT`` rows, and of over a
    1/``HOT_KEYS`` of all. There cannot be more than ``HOT_KEYS``, so they may be
    broadcast whatever the size of the data. None if there are none."""
    total, top = sizes.agg(F.sum(n), F.max(n)).first()
    bar = max(HOT, (total or 0) // HOT_KEYS)
    return sizes.filter(F.col(n) > bar).select(*keys) if top and top > bar else None


def joined(rows: DataFrame, table: DataFrame, keys: list[str],
           hot: DataFrame | None) -> DataFrame:
    """``rows`` inner joined with ``table``, which has one row a key. Rows of hot
    keys stay where they are and meet a broadcast part of the table, so none of
    these keys meets in one task; the others are shuffled."""
    if hot is None:
        return rows.join(table, keys)
    hot = F.broadcast(hot)
    often = rows.join(F.broadcast(table.join(hot, keys, "left_semi")), keys)
    return often.unionByName(rows.join(hot, keys, "left_anti").join(table, keys))


def joined_by_size(rows: DataFrame, table: DataFrame, keys: list[str], n: str = "n",
                   max_rows: int = 200_000) -> DataFrame:
    """``joined`` with a written table that has each key's number of rows in ``n``;
    a small one is broadcast as a whole."""
    whole, fits = broadcast_if_small(table, max_rows)
    return rows.join(whole, keys) if fits else joined(rows, table, keys, hot_keys(table, keys, n))


__all__ = ["arrow_rows", "checkpointed", "discard", "hot_keys", "joined", "joined_by_size", "kept", "let", "map_arrow", "read_table", "scratch_path", "ship",
           "text_or_empty", "written"]
