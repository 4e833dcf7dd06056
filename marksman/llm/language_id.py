"""Language identification by fusing evidence with Bayes' rule.

For every record (text, declared language, address) the posterior over the
languages is proportional to the product of

* the *text* likelihood: byte trigrams under one multinomial model per language
  and one background model ("und": no language), tempered because the trigrams
  of a long text are not independent;
* P(declared | language): how often texts of a language carry this declaration;
* P(suffix | language): the same for the last label of the host;
* the *host prior*: language shares of the host's records, smoothed towards
  those of its domain (the last two labels), these towards the corpus.

Counts behind the last three are soft (a record adds its text posterior) and
come from grouped aggregations over all records, so a host with a third of them
is summed in each task first. A record's own share is taken out of its host's
counts. Declarations are counted over all records, and every one that at least
``LEAST_RECORDS`` of them carry is a language, however large the table is. Its
trigram model is trained on its records, of more than ``SAMPLE`` on about so many
(those of least hash), then once more on all these records with the languages
their texts were found to have, so wrong declarations do little harm; a language
that no text is found to have is left out.

A record is rejected if it has no letters or the background explains it best by
a margin that a few unusual words do not reach.

Edge cases: null, empty and letterless texts are 'und' and rejected; a null
declaration, suffix or host is no evidence; without any declaration all is
'und', nothing is known to reject and texts with letters are kept; an empty
table gives no row; repeated rows are records of their own; other columns stay
in ``identified``, whatever their names (``__`` names are reserved); texts are
read whole. Ties go to the language that comes first in the alphabet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marksman.llm.common import arrow_rows, let, map_arrow, text_or_empty, written
from marksman.llm.exact_dedup import located
from marksman.plans.sizing import broadcast_if_small

UNKNOWN = "und"
SAMPLE = 4_000  # records of one declaration to train on
LEAST_RECORDS = 10  # declarations that fewer records carry are no language
BUCKETS = 1 << 16
TEMPER = 200.0  # a text counts as at most so many independent trigrams
MARGIN = 3.0  # log odds by which the background must win
SMOOTHING = 20.0  # records a parent's shares weigh as
_LETTER = re.compile(r"[^\W\d_]")


# ------------------------------------------------------------ text models

def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every byte trigram, text it belongs to) of folded texts; runs
    of anything but letters are one space."""
    folded = [f" {' '.join(_words(t))} ".encode() for t in texts]
    sizes = np.array([len(x) for x in folded], np.int64)
    data = np.frombuffer(b"".join(folded), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = (data[:-2] * 0x9E3779B1 + data[1:-1] * 0x85EBCA77 + data[2:] * 0xC2B2AE3D).astype(np.uint32)
    bucket = ((h ^ (h >> 15)) * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)
    inside = of[:-2] == of[2:]
    return bucket[inside], of[:-2][inside]


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _words(text: str) -> list[str]:
    return _NOT_LETTERS.sub(" ", text.lower()).split()


class TextModel:
    """Log probabilities of trigram buckets for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        # few trigrams are smoothed by less than they are, so that texts in no
        # language stay below the background
        smooth = counts + np.minimum(counts.sum(axis=1, keepdims=True) / BUCKETS, 0.5)
        logs = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        flat = np.full((1, BUCKETS), -np.log(BUCKETS))
        self.logs = np.ascontiguousarray(np.concatenate([logs, flat]).T, np.float32)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages and the background) tempered log likelihoods, and
        the number of trigrams."""
        bucket, of = trigrams(texts)
        k = self.logs.shape[1]
        n = np.bincount(of, minlength=len(texts))
        total = np.stack([np.bincount(of, self.logs[bucket, j], len(texts)) for j in range(k)], 1)
        return total / (1 + n / TEMPER)[:, None], n


def _posterior(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _counts(sample: DataFrame, languages: list[str], model: TextModel | None) -> np.ndarray:
    """Trigram counts by language: the declared one, or the one ``model`` finds.
    Summed in each task, then by Spark; only counts other than 0 are sent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS))
        index = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            for part in arrow_rows(batch, 256):
                texts = part.column(0).to_pylist()
                if model is None:
                    which = np.array([index.get(x, -1) for x in part.column(1).to_pylist()])
                else:
                    which = model.scores(texts)[0].argmax(axis=1)
                    which[which == len(model.languages)] = -1
                bucket, of = trigrams(texts)
                lang = which[of]
                known = lang >= 0
                at, n = np.unique(lang[known] * BUCKETS + bucket[known], return_counts=True)
                total.reshape(-1)[at] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(total.reshape(-1)[at], pa.float64())], ["at", "n"])

    rows = map_arrow(sample.coalesce(max(4, len(languages))), run, "at long, n double")
    found = rows.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(languages) * BUCKETS)
    total[found["at"].to_numpy()] = found["n"].to_numpy()
    return total.reshape(len(languages), BUCKETS)


def _fitted(languages: list[str], counts: np.ndarray) -> TextModel | None:
    """The model of the languages that have trigrams; None without any."""
    some = np.flatnonzero(counts.sum(axis=1))
    return TextModel([languages[i] for i in some], counts[some]) if len(some) else None


def train(records: DataFrame, sample: int = SAMPLE) -> TextModel | None:
    """The text models of the declared languages; None without any. ``records``
    has (fid, row, text, declared); of each declaration about ``sample`` are read."""
    seen = written(records.filter(F.col("declared").isNotNull()).groupBy("declared").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_RECORDS), "language-declarations")
    languages = sorted(r["declared"] for r in seen.collect())
    if not languages:
        return None
    # a hash is uniform: the least sample / n of a declaration's are about sample
    place = F.xxhash64("fid", "row") / F.lit(2.0**64) + 0.5
    rows = written(records.select("fid", "row", "text", "declared").join(
        F.broadcast(seen), "declared").filter(place * F.col("n") <= sample)
        .select("text", "declared"), "language-sample")
    first = _fitted(languages, _counts(rows, languages, None))
    if first is None:
        return None
    return _fitted(first.languages, _counts(rows, first.languages, first))


# ---------------------------------------------------------------- evidence

def document_records(docs: DataFrame) -> DataFrame:
    """(fid, row, text, declared, host, suffix) of located documents: ``lang``
    is their declaration, ``source`` their host (it has no suffix)."""
    return docs.select(
        F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"),
        text_or_empty().alias("text"), _clean("lang").alias("declared"),
        F.nullif(F.lower(F.trim("source")), F.lit("")).alias("host"),
        F.lit(None).cast("string").alias("suffix"))


def page_records(pages: DataFrame) -> DataFrame:
    """The same of located pages: the markup's language, the url's host and its
    last label; the text is what is outside of tags."""
    html = text_or_empty("html")
    host = F.nullif(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")),
                                             r"^[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)),
                    F.lit(""))
    visible = F.regexp_replace(F.regexp_replace(
        html, r"(?is)<(script|style)\b.*?(</\1\s*>|$)|<!--.*?(-->|$)", " "), r"(?s)<[^>]*>", " ")
    declared = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    rows = pages.select(F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"),
                        visible.alias("text"), declared.alias("declared"), host.alias("host"))
    return rows.select("fid", "row", "text", _clean("declared").alias("declared"), "host",
                       F.when(F.col("host").contains("."),
                              F.element_at(F.split("host", r"\."), -1)).alias("suffix"))


def _clean(declared: str) -> Column:
    """The primary part of a language tag in lower case, null if there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(F.col(declared))), "^[a-z]{2,8}", 0), F.lit(""))


def _text_evidence(records: DataFrame, model: TextModel) -> DataFrame:
    """(fid, row, declared, host, suffix, letters, scores, share): log
    likelihoods, and the text's own posterior over the languages alone."""
    schema = ("fid long, row long, declared string, host string, suffix string, "
              "letters boolean, scores array<double>, share array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_rows(batch, 256):
                texts = part.column(2).to_pylist()
                scores, n = model.scores(texts)
                share = _posterior(scores[:, :-1])
                share[scores[:, -1] >= scores[:, :-1].max(axis=1) + MARGIN] = 0
                letters = [bool(_LETTER.search(t)) for t in texts]
                share[~np.array(letters, bool)] = 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *part.columns[3:6], pa.array(letters),
                     pa.array(scores.tolist(), pa.list_(pa.float64())),
                     pa.array(share.tolist(), pa.list_(pa.float64()))],
                    ["fid", "row", "declared", "host", "suffix", "letters", "scores", "share"])

    return map_arrow(records.select("fid", "row", "text", "declared", "host", "suffix"), run, schema)


def _summed(rows: DataFrame, key: Column, name: str, k: int) -> DataFrame:
    """(key, name): the sum of ``share`` in each group, as an array."""
    sums = rows.filter(key.isNotNull()).groupBy(key.alias("__key")).agg(
        *[F.sum(F.col("share")[i]).alias(f"s{i}") for i in range(k)])
    return sums.select("__key", F.array(*[f"s{i}" for i in range(k)]).alias(name))


def _domain(host: str) -> Column:
    return F.array_join(F.slice(F.split(F.col(host), r"\."), F.greatest(
        F.size(F.split(F.col(host), r"\.")) - 1, F.lit(1)), 2), ".")


def identify(records: DataFrame, model: TextModel | None) -> DataFrame:
    """(fid, row, language, confidence, kept) of every record."""
    if model is None:
        letters = F.col("text").rlike(r"\p{L}")
        return records.select("fid", "row", F.lit(UNKNOWN).alias("language"),
                              F.lit(0.0).alias("confidence"), letters.alias("kept"))
    k = len(model.languages)
    rows = written(_text_evidence(records, model).withColumn("domain", _domain("host")),
                   "language-evidence")
    total = rows.agg(*[F.coalesce(F.sum(F.col("share")[i]), F.lit(0.0)).alias(f"s{i}")
                       for i in range(k)]).first()
    corpus = np.array([total[i] for i in range(k)])
    shares = [float(x) for x in (corpus + 1) / (corpus.sum() + k)]
    joined = rows
    for column, name in (("host", "by_host"), ("domain", "by_domain"), ("declared", "by_declared"),
                         ("suffix", "by_suffix")):
        table, _ = broadcast_if_small(_summed(rows, F.col(column), name, k), 100_000, 32 << 20)
        joined = joined.join(table, F.col(column) == F.col("__key"), "left").drop("__key")
    prior = F.array(*map(F.lit, shares))
    amounts = F.array(*[F.lit(float(x)) for x in corpus])

    def smoothed(counts: Column, parent: Column, own: Column) -> Column:
        """Shares of a group without the record's own, pulled to its parent's."""
        def mixed(c: Column) -> Column:
            n = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
            return let(n, lambda m: F.zip_with(
                c, parent, lambda x, p: (x + SMOOTHING * p) / (m + SMOOTHING)))
        rest = F.zip_with(counts, own, lambda x, o: F.greatest(x - o, F.lit(0.0)))
        return F.when(counts.isNull(), parent).otherwise(let(rest, mixed))

    def likelihood(counts: Column, own: Column) -> Column:
        """Log of P(value | language) up to a constant: the value's records
        among those of the language, half of SMOOTHING spread evenly."""
        return F.when(counts.isNull(), F.array_repeat(F.lit(0.0), k)).otherwise(F.zip_with(
            F.zip_with(counts, own, lambda x, o: F.greatest(x - o, F.lit(0.0)) + SMOOTHING / 2),
            amounts, lambda x, n: F.log(x / (n + SMOOTHING))))

    own = F.col("share")
    domain = smoothed(F.col("by_domain"), prior, own)
    fused = joined.withColumn("domain_prior", domain)
    fused = fused.withColumn("host_prior", smoothed(F.col("by_host"), F.col("domain_prior"), own))
    fused = fused.withColumn("declared_log", likelihood(F.col("by_declared"), own)).withColumn(
        "suffix_log", likelihood(F.col("by_suffix"), own))
    # the background has no declaration, suffix or host of its own
    logs = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (
        F.get("scores", i) + F.log(F.get("host_prior", i)) + F.get("declared_log", i)
        + F.get("suffix_log", i)))
    fused = fused.withColumn("logs", logs)
    fused = fused.withColumn("best", F.array_max("logs")).withColumn("und", F.col("scores")[k])
    weight = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    name = F.get(F.array(*map(F.lit, model.languages)),
                 F.array_position("logs", F.col("best")).cast("int") - 1)
    # against the background only the text speaks
    unknown = ~F.col("letters") | (
        F.col("und") >= F.array_max(F.slice("scores", 1, k)) + MARGIN)
    return fused.select(
        "fid", "row", F.when(unknown, UNKNOWN).otherwise(name).alias("language"),
        F.when(unknown, 0.0).otherwise(F.round(1 / weight, 6)).alias("confidence"),
        (~unknown).alias("kept"))


def identified(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` (with text, lang and source) and ``__language``,
    ``__confidence``, ``__kept``."""
    columns = docs.columns
    docs = located(docs)
    records = document_records(docs)
    found = identify(records, train(records)).select(
        F.col("fid").alias("__fid"), F.col("row").alias("__row"),
        F.col("language").alias("__language"), F.col("confidence").alias("__confidence"),
        F.col("kept").alias("__kept"))
    return (docs.withColumn("__fid", F.xxhash64("__file")).join(found, ["__fid", "__row"])
            .select(*[F.col(f"`{c}`") for c in columns], "__language", "__confidence", "__kept"))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language was identified, columns unchanged."""
    columns = docs.columns
    docs = located(docs)
    records = document_records(docs)
    out = written(identify(records, train(records)).filter("not kept").select(
        F.col("fid").alias("__fid"), F.col("row").alias("__row")), "language-rejected")
    out, _ = broadcast_if_small(out)
    return (docs.withColumn("__fid", F.xxhash64("__file"))
            .join(out, ["__fid", "__row"], "left_anti")
            .select(*[F.col(f"`{c}`") for c in columns]))


__all__ = ["TextModel", "accepted", "document_records", "identified", "identify", "page_records",
           "train", "trigrams"]
