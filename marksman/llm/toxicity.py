"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatibility forms, lower case, accents off, letters
of other scripts that look Latin to Latin ones, digits and signs that stand for
letters inside a word to these letters; then words are joined by single spaces.

The lexicon is learned from labelled texts: terms are words and word beginnings
of ``PREFIXES`` letters; a term's weight is its smoothed log odds between toxic
and clean texts. It is kept if it leans to toxic texts by more than chance would
make any of the counted terms lean (the divergence from the base rate, times its
texts, above the logarithm of the number of terms). A distinct word of a text
counts once, with its heaviest term, squared: chance terms weigh little.

Exception phrases are learned as well: a lexicon word with the word before or
after it, if the pair leans to clean texts. A match inside one does not count.

The score is a logistic function of the sum and of the sum per word, fitted on
the same texts. ``SAMPLE`` bounds the labelled rows used for
learning (those of least hash of the identifier); everything is scored.

Edge cases: null or empty text has no match and gets the score of one; without
labels of both kinds every score is 0; several labels of a document count as
toxic if one does, null labels do not count; an empty table gives no row; rows
that share an id are scored one by one; other columns are ignored; texts are
matched whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marksman.llm.common import arrow_rows, map_arrow, text_or_empty, written

SAMPLE = 20_000
PREFIXES = range(3, 9)
MAX_TERMS = 20_000
SCHEMA = "doc_id long, score double"

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "e", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "һ": "h", "ԁ": "d",
    "ԛ": "q", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o",
    "đ": "d", "ɑ": "a", "ɡ": "g",
}
# What digits and signs stand for inside a word.
_SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
                "@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}

_SIMILAR = str.maketrans(_LOOKALIKES)
_INSIDE = re.compile(r"(?<=[^\W\d_])[0-9@$!|+]+(?=[^\W_])|(?<![\w@$!|+])[0-9@$!|+]+(?=[^\W\d_])")
_HAS_SIGNS = re.compile(r"[0-9@$!|+][^\W\d_]")
_NOT_WORD = re.compile(r"[\W_]+")
_MARKS = re.compile("[̀-ͯ​-‏⁠﻿­]+")
_SUBSTITUTE = str.maketrans(_SUBSTITUTES)


def fold(text: str) -> str:
    """The folded words of a text, a space before, between and after them."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower().translate(_SIMILAR)
    else:
        text = text.lower()
    if _HAS_SIGNS.search(text):
        text = _INSIDE.sub(lambda m: m.group().translate(_SUBSTITUTE), text)
    return f" {_NOT_WORD.sub(' ', text).strip()} "


def terms_of(word: str) -> Iterator[str]:
    """Terms a word is counted under; a whole word ends with a space."""
    yield f" {word} "
    for n in PREFIXES:
        if len(word) > n:
            yield " " + word[:n]


def leaning(toxic: float, clean: float, base: float) -> float:
    """The term's texts times the divergence of its toxic share from ``base``,
    negative where it leans to clean texts."""
    n = toxic + clean
    r = toxic / n
    d = sum(x * math.log(x / y) for x, y in ((r, base), (1 - r, 1 - base)) if x > 0)
    return n * d if r > base else -n * d


class Lexicon:
    """Term weights and exception phrases, ready to match folded texts."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]):
        self.weights, self.exceptions = weights, exceptions
        self.automaton = ahocorasick.Automaton()
        for term, w in weights.items():
            self.automaton.add_word(term, (len(term), w))
        for phrase in exceptions:
            if phrase not in weights:
                self.automaton.add_word(phrase, (len(phrase), None))
        self.empty = not weights
        if not self.empty:
            self.automaton.make_automaton()

    def matches(self, folded: str) -> dict[int, float]:
        """Start of every matched word (of the space before it) and its weight."""
        found: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        if self.empty:
            return found
        for end, (n, w) in self.automaton.iter(folded):
            start = end - n + 1
            if w is None:
                excepted.append((start, end))
            elif w > found.get(start, 0.0):
                found[start] = w
        for start, end in excepted:
            for at in [s for s in found if start <= s < end]:
                del found[at]
        return found

    def features(self, text: str) -> tuple[float, float]:
        """Log of one plus the summed squared weights of the distinct words that
        match, and that sum per 100 words."""
        folded = fold(text)
        by_word = {folded[at:folded.index(" ", at + 1)]: w
                   for at, w in self.matches(folded).items()}
        total = sum(w * w for w in by_word.values())
        if not total:
            return 0.0, 0.0
        return math.log1p(total), 100.0 * total / (folded.count(" ") - 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the constant first) by Newton's method with a ridge penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic): at most ``sample`` labelled rows; their labels, no more
    than that bound, are broadcast."""
    each = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def _counted(sample: DataFrame, of_text, name: str) -> DataFrame:
    """(term, toxic, clean): in how many texts of either kind each term is;
    ``of_text`` gives a text's distinct terms. Counted in every task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()),
                 pa.array([counts[0][t] for t in terms], pa.int64())], ["term", "toxic", "clean"])

        for batch in batches:
            for part in arrow_rows(batch):
                counts = (Counter(), Counter())
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                       strict=True):
                    counts[1 if toxic else 0].update(of_text(text))
                yield rows(counts)

    rows = map_arrow(sample, run, "term string, toxic long, clean long")
    return written(rows.groupBy("term").agg(F.sum("toxic").alias("toxic"),
                                            F.sum("clean").alias("clean")), name)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          max_terms: int = MAX_TERMS) -> tuple[Lexicon, np.ndarray]:
    """The lexicon and the logistic weights."""
    rows = written(labelled_sample(docs, labels, sample), "toxicity-sample")
    kinds = {bool(r["toxic"]): r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        return Lexicon({}, []), np.array([-30.0, 0.0, 0.0])
    base = kinds[True] / (kinds[True] + kinds[False])

    def terms(text: str) -> set[str]:
        return {t for w in set(fold(text).split()) for t in terms_of(w)}

    counted = _counted(rows, terms, "toxicity-terms")
    chance = math.log(max(counted.count(), 2))
    # only what could pass: the strongest of them, a bounded number
    odds = F.log((F.col("toxic") + 0.5) / (kinds[True] + 1.0)) - F.log(
        (F.col("clean") + 2.0) / (kinds[False] + 4.0))
    best = (counted.filter(F.col("toxic") * (-math.log(base)) > chance)
            .withColumn("weight", odds).filter("weight > 1.5")
            .orderBy(F.desc(F.col("weight") * F.col("toxic")), "term").limit(max_terms).collect())
    weights = {r["term"]: r["weight"] for r in best
               if leaning(r["toxic"], r["clean"], base) > chance}
    plain = Lexicon(weights, [])

    def phrases(text: str) -> set[str]:
        folded = fold(text)
        out = set()
        for at in plain.matches(folded):
            end = folded.index(" ", at + 1)
            if at > 0:
                out.add(folded[folded.rindex(" ", 0, at):end + 1])
            if end + 1 < len(folded):
                out.add(folded[at:folded.index(" ", end + 1) + 1])
        return out

    exceptions = [r["term"] for r in _counted(rows, phrases, "toxicity-phrases")
                  .filter("clean >= 3 and clean > toxic").orderBy(F.desc("clean"), "term")
                  .limit(max_terms).collect() if leaning(r["toxic"], r["clean"], base) < -0.1]
    lexicon = Lexicon(weights, exceptions)
    return lexicon, _fit(rows, lexicon)


def _fit(rows: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Logistic weights; two numbers a sampled row reach the driver."""
    weights, exceptions = lexicon.weights, lexicon.exceptions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(weights, exceptions)
        for batch in batches:
            for part in arrow_rows(batch):
                f = [own.features(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in f], pa.float64()),
                     pa.array([b for _, b in f], pa.float64()), part.column(1)],
                    ["total", "density", "toxic"])

    got = map_arrow(rows, run, "total double, density double, toxic int").collect()
    x = np.array([(r["total"], r["density"]) for r in got])
    y = np.array([float(r["toxic"] > 0) for r in got])
    order = np.lexsort((y, x[:, 1], x[:, 0]))  # the same sums whatever the order
    w = _logistic(x[order], y[order])
    return np.array([w[0], max(w[1], 0.0), max(w[2], 0.0)])


def score(docs: DataFrame, lexicon: Lexicon, fitted: np.ndarray) -> DataFrame:
    """``SCHEMA``: every document's score, 0 to 1."""
    weights, exceptions = lexicon.weights, lexicon.exceptions
    w0, w1, w2 = map(float, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(weights, exceptions)
        for batch in batches:
            for part in arrow_rows(batch):
                out = []
                for text in part.column(1).to_pylist():
                    a, b = own.features(text)
                    z = min(max(w0 + w1 * a + w2 * b, -30.0), 30.0)
                    out.append(1 / (1 + math.exp(-z)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(out, pa.float64())],
                    ["doc_id", "score"])

    return map_arrow(docs.select("doc_id", text_or_empty().alias("text")), run, SCHEMA)


__all__ = ["Lexicon", "SAMPLE", "fold", "labelled_sample", "learn", "score"]
