"""The lexicon and its scores."""

import random
from collections import Counter

from pyspark.sql import functions as F

from marksman.llm import toxicity
from marksman.llm.queries import op6_toxicity
from tests.llm.data import COLUMNS, documents, hard_cases, prose


def test_folding():
    assert toxicity.fold("You 1D10T! l0ser $tupid") == " you idiot loser stupid "
    assert toxicity.fold("іdіоt Élève ﬁn") == " idiot eleve fin "
    assert toxicity.fold("idiot$$$ 2020 $5 a@b") == " idiot 2020 5 aab "
    assert toxicity.fold("") == "  " and toxicity.fold(" \n") == "  "


def test_exceptions_and_distinct_words():
    lexicon = toxicity.Lexicon({" bad": 2.0, " badly ": 3.0, " ass ": 4.0}, [" ass and "])
    assert lexicon.matches(toxicity.fold("badly bad ass")) == {0: 3.0, 6: 2.0, 10: 4.0}
    assert lexicon.matches(toxicity.fold("an ass and cart")) == {}
    assert lexicon.features("bad") == lexicon.features("BAD!!")
    assert lexicon.features("bad bad x x")[0] == lexicon.features("bad x x x")[0]
    assert lexicon.features("")[0] == 0 and toxicity.Lexicon({}, []).features("bad") == (0.0, 0.0)


def labelled(n):
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = prose(draw.randint(5, 60), i).split()
        toxic = i % 6 == 0
        for _ in range(draw.randint(1, 4) if toxic else 0):
            word = draw.choice(["grobble", "zurk" + draw.choice(["a", "ino", "ex"]), "Fl0mp"])
            words.insert(draw.randrange(len(words)), word)
        if not toxic and i % 21 == 0:
            words.append("grobble fish")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learned_scores(spark, tmp_path):
    rows, labels = labelled(1200)
    docs = documents(spark, tmp_path, rows + hard_cases()[5:7])
    table = spark.createDataFrame(labels + [(3, 1, None), (None, 1, 1), (7, 0, 0)],
                                  "doc_id long, quality int, toxic int")
    train = table.filter("doc_id is null or doc_id % 4 <> 0")
    lexicon, fitted = toxicity.learn(docs, train)
    assert {" zurk", " flomp "} <= lexicon.weights.keys()
    assert any(p.startswith(" grobble fish") for p in lexicon.exceptions)
    got = {r.doc_id: r.score for r in toxicity.score(docs, lexicon, fitted).collect()}
    held = [i for i, _, _ in labels if i % 4 == 0]
    right = sum((got[i] >= 0.5) == (i % 6 == 0) for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in got.values()) and got[7] < 0.5


def test_without_labels(spark, tmp_path):
    docs = documents(spark, tmp_path)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lexicon, fitted = toxicity.learn(docs, labels)
    got = toxicity.score(docs, lexicon, fitted).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in hard_cases())
    assert all(r.score < 1e-6 for r in got)
    assert toxicity.score(spark.createDataFrame([], COLUMNS), lexicon, fitted).collect() == []


def test_the_sample_is_bounded(spark, tmp_path):
    rows, labels = labelled(60)
    docs = documents(spark, tmp_path, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity.labelled_sample(docs, table, 7).count() == 7


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op6_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    held = rows.filter("held_out").select("score", "predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    ordered = sorted(held, key=lambda r: r.score)
    toxic = sum(r.toxic for r in held)
    above = sum(i for i, r in enumerate(ordered) if r.toxic) - toxic * (toxic - 1) / 2
    assert above / (toxic * (len(held) - toxic)) >= 0.93


def test_labels_of_held_out_rows_are_not_read(spark, tmp_path):
    rows, labels = labelled(400)
    for flip in (0, 1):
        folder = tmp_path / str(flip)
        documents(spark, folder, rows, "documents.parquet")
        df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
        df = df.withColumn("toxic", F.when(held & (F.lit(flip) == 1), 1 - F.col("toxic"))
                           .otherwise(F.col("toxic")))
        df.write.parquet(str(folder / "labels.parquet"))
    a, b = ({r.doc_id: r.score for r in op6_toxicity(spark, str(tmp_path / str(f))).collect()}
            for f in (0, 1))
    assert a == b


def test_a_long_word_is_matched_whole():
    word = "abcdefghij" * 7
    term = next(toxicity.terms_of(word))
    lexicon = toxicity.Lexicon({term: 2.0}, [])
    assert lexicon.matches(toxicity.fold(f"so {word.upper()}, there")) == {3: 2.0}
    assert not lexicon.matches(toxicity.fold(word + "k"))
