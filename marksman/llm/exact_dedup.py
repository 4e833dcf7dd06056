"""Exact deduplication as a stateful stream.

Documents arrive as rows (digest, doc_id, locator): the SHA-256 of the text, the
stable identifier, and where the content lies (file, row). They are appended to
an arrival log; a Structured Streaming query reads what is new there and keeps,
per digest, the largest identifier with its locator and the number of arrivals.
The state is on disk (RocksDB, checkpointed to the shared folder), has no
watermark and never expires, so a later call with the same ``root`` goes on
where the last one ended. The result is read from the state itself.

A digest that occurred more than once is a *hit*: the full bytes of all its
texts are compared (fetched by locator for earlier arrivals). Should texts
differ, that digest's documents are grouped by the texts themselves.

Only DataFrame functions run. A digest that holds a large share of the rows is
counted in each task before the shuffle, and the join back to the arrivals is
one that AQE splits; hits are broadcast only when they measure small.

Edge cases: null text is the empty text; of rows that share text and id, one
stays (the last by locator); a null id is smaller than any other; an empty
table gives no row; other columns are ignored by ``decisions`` and kept by
``deduplicated``, whatever their names; texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marksman.llm.common import scratch_path, text_or_empty, written
from marksman.plans.sizing import broadcast_if_small

_LOCATOR = ["__file", "__row"]
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # one bound for all stores of an executor; a store closes with its task
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the file and row of each document. Rows that do not come
    straight from files that know their rows (Parquet) are written first."""
    def with_locator(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        return df.select("*", meta.getField("file_path").alias("__file"),
                         meta.getField("row_index").alias("__row"))
    try:
        return with_locator(docs)
    except AnalysisException:
        return with_locator(written(docs, "landing"))


def _advanced(spark: SparkSession, log: str, schema, state: str) -> DataFrame:
    """Feed what is new in the arrival log to the state; all of the state as
    (digest, keep, n)."""
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        seen = (spark.readStream.schema(schema).parquet(log).groupBy("digest")
                .agg(F.max(F.struct("doc_id", *_LOCATOR)).alias("keep"),
                     F.count(F.lit(1)).alias("n")))
        query = (seen.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", state).trigger(availableNow=True).start())
        query.awaitTermination()
        rows = spark.read.format("statestore").load(state)
        return written(rows.select(
            F.col("key.digest").alias("digest"), F.col("value.max").alias("keep"),
            F.col("value.count").alias("n")), "exact-state")
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def decisions(docs: DataFrame, root: str | None = None, text: str = "text",
              digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(digest, doc_id, __file, __row, keep_id, group_size, kept) of every
    document that has arrived at ``root``, the given ones included. Without
    ``root`` a fresh folder is used. ``doc_id`` is any orderable column."""
    spark = docs.sparkSession
    root = root or scratch_path(spark, "exact-dedup")
    log, state = f"{root}/arrivals", f"{root}/state"
    if not set(_LOCATOR) <= set(docs.columns):
        docs = located(docs)
    rows = docs.select(digest(text_or_empty(text)).alias("digest"), "doc_id", *_LOCATOR)
    rows.write.mode("append").parquet(log)
    arrivals = spark.read.schema(rows.schema).parquet(log)
    if arrivals.isEmpty():  # a stream without rows keeps no state
        return arrivals.select("*", F.col("doc_id").alias("keep_id"),
                               F.lit(0).cast("long").alias("group_size"),
                               F.lit(True).alias("kept"))
    seen = _advanced(spark, log, rows.schema, state)
    differing = _differing(docs, arrivals, seen, text, digest)
    here = [F.col("doc_id"), *map(F.col, _LOCATOR)]
    result = [*arrivals.columns, F.col("keep.doc_id").alias("keep_id"),
              F.col("n").alias("group_size"),
              F.struct(*here).eqNullSafe(F.col("keep")).alias("kept")]
    if differing is None:
        return arrivals.join(seen, "digest").select(*result)
    # texts that differ under one digest: told apart by their bytes
    hits, texts = differing
    groups = (texts.groupBy("digest", "__text")
              .agg(F.max(F.struct("doc_id", *_LOCATOR)).alias("keep"),
                   F.count(F.lit(1)).alias("n")))
    apart = texts.join(groups, ["digest", "__text"]).select(*result)
    alike = arrivals.join(hits, "digest", "left_anti").join(seen, "digest").select(*result)
    return alike.unionByName(apart)


def _differing(docs: DataFrame, arrivals: DataFrame, seen: DataFrame, text: str,
               digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame] | None:
    """Compare the bytes of all texts of each hit. None when those of every
    digest are equal; else the digests whose texts differ, and their texts."""
    spark = docs.sparkSession
    hits, _ = broadcast_if_small(seen.filter("n > 1").select("digest"))

    def contents(df: DataFrame) -> DataFrame:
        return df.select(digest(text_or_empty(text)).alias("digest"), "doc_id", *_LOCATOR,
                         text_or_empty(text).alias("__text"))

    texts = contents(docs).join(hits, "digest", "left_semi")
    # earlier arrivals: read their files again, for the rows that are hits
    earlier = (arrivals.join(hits, "digest", "left_semi")
               .join(docs.select("__file").distinct(), "__file", "left_anti"))
    files = [r["__file"] for r in earlier.select("__file").distinct().collect()]
    if files:
        old = contents(located(spark.read.parquet(*files)))
        texts = texts.unionByName(old.join(earlier.select(*_LOCATOR), _LOCATOR, "left_semi"))
    # min and max are taken in each task first, so a hot digest moves few texts
    differ = (texts.groupBy("digest")
              .agg(F.min("__text").alias("a"), F.max("__text").alias("b"))
              .filter("a <> b").select("digest"))
    if differ.isEmpty():
        return None
    differ = written(differ, "differing-digests")
    return differ, texts.join(differ, "digest", "left_semi")


def deduplicated(docs: DataFrame, root: str | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged (``__file`` and
    ``__row`` are the only names it reserves)."""
    columns = docs.columns
    docs = located(docs)
    gone = written(decisions(docs, root, text).filter("not kept").select(*_LOCATOR), "gone")
    gone, _ = broadcast_if_small(gone)
    return docs.join(gone, _LOCATOR, "left_anti").select(*[F.col(f"`{c}`") for c in columns])


__all__ = ["decisions", "deduplicated", "located", "sha256"]
