"""Size-checked broadcast and reliable materialisation.

A side is broadcast only after counting it against a row bound (and, where asked
for, the driver's heap); past the bound the join stays a shuffle join (AQE splits
skewed partitions), whatever Spark's own estimate. Lineage
is cut by ``DataFrame.checkpoint`` into the cluster's shared checkpoint
directory, never a machine-local folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds for a broadcast side: rows (hash-table entries) and payload bytes.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Bytes of a row in a broadcast hash table beside its values, which stand there twice
# (key and row): up to 130 a row of 9-byte keys measured. Of the driver's heap such a
# table may take one part in so many: it stands there again serialized while it is
# sent, and the plans build two at once.
HASHED_ROW_BYTES = 128
DRIVER_SHARE = 8


# Bytes of a value of the fixed-size types; others are measured as JSON text.
_FIXED = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4, "long": 8,
          "double": 8, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}


def _width(f: T.StructField):
    c = F.col(f"`{f.name}`")
    fixed = _FIXED.get(f.dataType.typeName())
    if fixed is not None:
        return F.lit(fixed).cast("bigint")
    if not isinstance(f.dataType, (T.StringType, T.BinaryType)):
        c = F.to_json(F.struct(c))
    return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint")


def measure_columns(df: DataFrame) -> tuple[int, dict[str, int]]:
    """(rows, payload bytes per column) of ``df`` in one aggregation job:
    strings and binaries by their byte length, nested columns by that of their
    JSON form, other columns by their fixed size."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.coalesce(F.sum(_width(f)), F.lit(0)).alias(f"_b{i}")
             for i, f in enumerate(df.schema.fields)]
    row = df.agg(*aggs).first()
    return row["_n"], {f.name: row[f"_b{i}"] for i, f in enumerate(df.schema.fields)}


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, payload bytes) of ``df`` in one aggregation job."""
    n, by_col = measure_columns(df)
    return n, sum(by_col.values())


def fits_broadcast(rows: int, size: int, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    return rows <= max_rows and size <= max_bytes


def fits_driver(spark: SparkSession, rows: int, size: int, share: int = DRIVER_SHARE) -> bool:
    """Whether the hash table of a broadcast takes at most 1/``share`` of the driver's heap."""
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return (HASHED_ROW_BYTES * rows + 2 * size) * share <= heap


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, *,
                       measured: tuple[int, int] | None = None,
                       driver_share: int | None = None) -> tuple[DataFrame, bool]:
    """``(F.broadcast(df), True)`` when ``df`` is within both bounds, else
    ``df`` hinted to be merged and ``False``: the join is a shuffle join, also where
    Spark's estimate from compressed files would have it broadcast. ``measured``
    passes a known (rows, bytes) of ``df`` or of a superset of it; with
    ``driver_share`` its hash table must also pass ``fits_driver``."""
    n, b = measure(df) if measured is None else measured
    if fits_broadcast(n, b, max_rows, max_bytes) and (
            driver_share is None or fits_driver(df.sparkSession, n, b, driver_share)):
        return F.broadcast(df), True
    return df.hint("merge"), False


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory of the session.

    Read from ``spark.checkpoint.dir``. Only a session in this one process
    (``local``, ``local[n]``) without one gets a folder of its own; any cluster
    session without one, ``local-cluster`` included, is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="marksman-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage (eager checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


__all__ = [
    "DEFAULT_BROADCAST_MAX_BYTES",
    "DEFAULT_BROADCAST_MAX_ROWS",
    "DRIVER_SHARE",
    "broadcast_if_small",
    "fits_broadcast",
    "fits_driver",
    "measure",
    "measure_columns",
    "checkpoint_dir",
    "checkpointed",
    "scratch_path",
]
