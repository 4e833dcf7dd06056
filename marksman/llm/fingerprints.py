"""Document fingerprints: one-permutation MinHash with optimal densification.

The shingles of a text (five words; a shorter text is one shingle) are hashed
once. The top bits of a hash choose one of ``BINS`` bins, each bin keeps its
least hash. An empty bin takes the value of the first non-empty bin on its own
pseudo-random probing order, so equal sets densify equally and unequal ones
independently. Of every value the lowest ``BITS`` bits are stored, packed into
64-bit words; a fingerprint is their hexadecimal form, one digit a bin.

Two values agree by chance with probability c = 2^-BITS, so the likeness is
(share of agreeing bins - c) / (1 - c), at least 0.

All of it are column expressions. ``edited`` pairs every document with the one
of the next smaller id: ids are ranked in range partitions (no global window
over rows), and one shuffle of the texts by id serves both sides of the join.

Edge cases: null or empty text has no shingles and the fingerprint ''; two such
have likeness 1, one with any other 0. Equal texts have equal fingerprints. The
document after the last id is the first again; a single document follows
itself. Null counts as the least 64-bit id. Rows that share an id share the next
document, which of several rows is the one with the least hash. An empty table gives no
row; other columns are ignored; texts may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marksman.llm.common import let, text_or_empty, written

SHINGLE = 5
BINS = 256
BITS = 4
_PER_WORD = 64 // BITS
_FIRST_PROBES = 8


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """64-bit hashes of the runs of ``size`` words (all words if fewer)."""
    words = F.array_remove(F.split(text, r"\s+"), "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        n = F.size(h)
        at = F.sequence(F.lit(0), n - size)
        long = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return (F.when(n >= size, long).when(n > 0, F.array(F.xxhash64(h)))
                .otherwise(F.array().cast("array<bigint>")))

    return let(hashed, runs)


def _least_by_bin(hashes: Column, bins: int) -> Column:
    """The least hash of every bin, null for an empty one. Each bin also gets
    its greatest possible value, so it has a first one in the sorted hashes
    (bins come in signed order, the same for every text)."""
    shift = 64 - (bins.bit_length() - 1)
    last = (1 << shift) - 1
    ends = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.shiftleft(
        i.cast("bigint"), shift).bitwiseOR(F.lit(last)))

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (
            F.shiftrightunsigned(x, shift) != F.shiftrightunsigned(F.get(s, i - 1), shift)))

    found = let(F.sort_array(F.concat(hashes, ends)), firsts)
    return F.transform(found, lambda x: F.when(x.bitwiseAND(F.lit(last)) != last, x))


def signature(text: Column, bins: int = BINS) -> Column:
    """``bins`` values of ``BITS`` bits as packed longs; null without words.

    Bin i looks for a non-empty bin at (start_i + t * step_i) mod ``bins``, t =
    0, 1, ...: an odd step visits every bin. What is stored of a value is taken
    from its hash with the bin, so a value copied to many bins differs from
    another one in each of them independently.
    """
    def fill(values: Column) -> Column:
        def found(i: Column, tries: int) -> Column:
            def probe(draw: Column) -> Column:
                step = F.shiftrightunsigned(draw, 32).bitwiseOR(F.lit(1))
                places = F.transform(F.sequence(F.lit(0), F.lit(tries - 1)),
                                     lambda t: F.pmod(draw + t * step, F.lit(bins)).cast("int"))
                return F.get(F.filter(places, lambda b: F.get(values, b).isNotNull()), 0)
            # 31 bits each, so that the sums stay in range
            return let(F.xxhash64(i).bitwiseAND(F.lit(0x7FFFFFFF_7FFFFFFF)), probe)

        def value(v: Column, i: Column) -> Column:
            some = F.coalesce(v, F.get(values, F.coalesce(found(i, _FIRST_PROBES),
                                                          found(i, bins))))
            return F.xxhash64(some, i).bitwiseAND(F.lit((1 << BITS) - 1))

        return F.transform(values, value)

    def packed(values: Column) -> Column:
        words = F.array(*[F.lit(w * _PER_WORD + 1) for w in range(bins // _PER_WORD)])
        return F.transform(words, lambda at: F.aggregate(
            F.slice(values, at, _PER_WORD), F.lit(0).cast("bigint"),
            lambda acc, v: F.shiftleft(acc, BITS).bitwiseOR(v)))

    def whole(hashes: Column) -> Column:
        return F.when(F.size(hashes) > 0,
                      let(let(_least_by_bin(hashes, bins), fill), packed))

    return let(shingle_hashes(text), whole)


def fingerprint(sig: Column) -> Column:
    """The hexadecimal form of a signature; '' without words."""
    return F.coalesce(F.concat_ws("", F.transform(sig, lambda w: F.lpad(F.hex(w), 16, "0"))),
                      F.lit(""))


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Estimated Jaccard similarity from two signatures."""
    ones = F.lit(sum(1 << (BITS * i) for i in range(_PER_WORD)))

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for k in (1, 2):  # any of a value's bits, gathered in its lowest one
            d = d.bitwiseOR(F.shiftrightunsigned(d, k))
        return F.bit_count(d.bitwiseAND(ones))

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    close = F.greatest(F.lit(0.0), (1 - apart / F.lit(float(bins)) - chance) / (1 - chance))
    return (F.when(a.isNull() & b.isNull(), F.lit(1.0))
            .when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(close))


def next_ids(keys: DataFrame) -> DataFrame:
    """(key, next_key, need) per distinct key of (key, n_chars): the next
    smaller key, after the least the greatest, and a third of the longest text."""
    ids = keys.groupBy("key").agg(F.max("n_chars").alias("n_chars"))
    ids = written(ids.repartitionByRange(F.desc("key")).withColumn("part", F.spark_partition_id()),
                  "ordered-ids")
    heads = ids.groupBy("part").agg(F.max("key").alias("head"))
    # a row for each range partition: these windows see no more
    parts = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(parts),
                                            F.first("head").over(parts.rowsBetween(
                                                Window.unboundedPreceding, 0))).alias("after"))
    within = Window.partitionBy("part").orderBy(F.desc("key"))
    return (ids.withColumn("inner_next", F.lead("key").over(within)).join(heads, "part")
            .select("key", F.coalesce("inner_next", "after").alias("next_key"),
                    F.floor(F.col("n_chars") / 3).cast("int").alias("need")))


def edited(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text, sig, n_chars, edited, next_sig): each document with its
    last third replaced by the beginning of the next document's text."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(-2**63)).alias("key"),
                       text_or_empty(text).alias("text"))
    rows = rows.withColumn("n_chars", F.length("text"))
    links = written(next_ids(rows.select("key", "n_chars")), "next-ids")
    # this one shuffle of the texts serves both sides of the join
    rows = rows.withColumn("sig", signature(F.col("text"))).repartition("key")
    one = Window.partitionBy("key").orderBy(F.xxhash64("text"), F.desc("n_chars"),
                                            F.col("doc_id"))
    giving = rows.withColumn("rank", F.row_number().over(one)).filter("rank = 1").drop("rank")
    to = links.select(F.col("next_key").alias("key"), F.col("key").alias("to_key"), "need")
    given = giving.join(to, "key").select(
        F.col("to_key").alias("key"), F.expr("left(text, need)").alias("prefix"),
        F.col("sig").alias("next_sig")).repartition("key")
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    new = F.concat(F.expr("left(text, n_chars - int(floor(n_chars / 3)))"),
                   F.substring(F.col("prefix"), F.lit(1), cut))
    return rows.join(given, "key").select("doc_id", "text", "sig", "n_chars",
                                          new.alias("edited"), "next_sig")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of all texts and edited texts, with their likenesses."""
    rows = edited(docs, text)
    rows = rows.withColumn("edited_sig", signature(F.col("edited")))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("sig")).alias("fingerprint"),
        fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))


__all__ = ["edited", "fingerprint", "fingerprints", "likeness", "next_ids", "shingle_hashes",
           "signature"]
