"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marksman.llm import (bag_minhash, exact_dedup, fingerprints, html_main, language_id, max_sketch,
                          oracle, packing, piece_bpe, prefix_trie, rans, suffix_dedup, toxicity,
                          word_windows)
from marksman.llm.common import read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equal texts that stays."""
    rows = exact_dedup.decisions(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from its text, declaration and host, and of
    every page from its text, markup, suffix, host and domain."""
    out = []
    for table, key, records_of in (("documents", "doc_id", language_id.document_records),
                                   ("pages", "page_id", language_id.page_records)):
        rows = exact_dedup.located(read_table(spark, sf_dir, table))
        records = records_of(rows)
        found = language_id.identify(records, language_id.train(records))
        ids = rows.select(F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"), key,
                          F.lit(table).alias("table"))
        out.append(ids.join(found, ["fid", "row"]).drop("fid", "row"))
    return out[0].unionByName(out[1], allowMissingColumns=True)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in interleaved range-coded files, read back."""
    return rans.token_files(read_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near duplicates."""
    docs = exact_dedup.located(read_table(spark, sf_dir, "documents"))
    return bag_minhash.decisions(docs).drop("fid", "row")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 1024 ids by minimum bin slack."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned from the labels of those
    that are not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    lexicon, fitted = toxicity.learn(docs, labels.filter(~held_out))
    rows = toxicity.score(docs, lexicon, fitted)
    return rows.select("doc_id", held_out.alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document by backtracking, and what they decode to."""
    return piece_bpe.encode_decode(read_table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that occur elsewhere."""
    rows = suffix_dedup.without_repeats(read_table(spark, sf_dir, "documents"))
    size, left = F.octet_length("__bytes").cast("long"), F.octet_length("__kept").cast("long")
    return rows.select("doc_id", size.alias("n_bytes"), (size - left).alias("n_removed"),
                       F.size("__spans").cast("long").alias("n_spans"),
                       F.sha2("__kept", 256).alias("kept_sha256"),
                       F.when(F.size("__spans") > 0, suffix_dedup.kept_text(
                           F.col("__bytes"), F.col("__spans"))).otherwise(
                           F.coalesce("text", F.lit(""))).alias("text"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    rows = html_main.main_texts(read_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", F.col("__text").alias("text"),
                       F.length("__text").cast("long").alias("n_chars"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed one-permutation fingerprints of every text and its edited text."""
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return max_sketch.search(read_table(spark, sf_dir, "documents"),
                             read_table(spark, sf_dir, "benchmark"), 10)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of 20 words that start earlier, too."""
    rows = word_windows.without_repeats(read_table(spark, sf_dir, "documents"), 20)
    return rows.select("doc_id", F.col("__n_words").alias("n_words"),
                       F.col("__n_removed").alias("n_removed"),
                       F.sha2("__kept", 256).alias("kept_sha256"), F.col("__kept").alias("text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    own = prefix_trie.turns(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_nodes(prefix_trie.rebuilt(own))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_token_files": op3_token_files,
    "op4_near_dedup": op4_near_dedup,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_piece_bpe": op7_piece_bpe,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_main_text": op9_main_text,
    "op10_fingerprints": op10_fingerprints,
    "op11_ranked_search": op11_ranked_search,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": oracle.EXACT_DEDUP,
    "op11_ranked_search": oracle.RANKED_SEARCH,
    "op12_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op13_prefix_trie": oracle.PREFIX_TRIE,
}
