"""A training corpus from raw documents, stage by stage.

Each stage is one operator of ``marksman.llm`` on all the documents that its
predecessor kept, and all but the last return the documents' columns. ``run``
writes each stage's rows as Parquet to the shared checkpoint folder and reads
them again, so a stage starts from files and no lineage crosses stages.

1. language ID: documents without an identified language go;
2. exact dedup: of equal texts the one with the largest doc_id stays;
3. near dedup: of each group of near duplicates the smallest doc_id stays;
4. suffix-array dedup: bytes covered by a ``PASSAGE``-byte string (about 50 words)
   that a document with a smaller doc_id has, too, are cut out of the texts;
   characters cut in two go with them; the first document keeps the passage, and
   what a document repeats in itself stays; every document stays, with an empty
   text if nothing is left; ``n_chars`` is counted anew;
5. packing: the documents' ids in full sequences of 1024.

Empty tables give empty results; the operators' notes say how nulls, repeated
rows and clashing column names are handled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marksman.llm import bag_minhash, exact_dedup, language_id, packing, suffix_dedup
from marksman.llm.common import read_table, written


# Bytes of a string that counts as a passage: 50 words of few letters.
PASSAGE = 280


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language was identified."""
    return language_id.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return bag_minhash.deduplicated(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long strings that earlier ones have."""
    rows = suffix_dedup.without_repeats(docs, PASSAGE, first=True)
    whole = suffix_dedup.kept_text(F.col("__bytes"), F.col("__spans"))
    cut = F.size("__spans") > 0
    out = rows.withColumn("text", F.when(cut, whole).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in full sequences of 1024 ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("suffix_dedup", repeats),
    ("packing", packed),
]

#: Language ID, signatures and packing are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
