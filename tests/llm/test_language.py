"""Language ID."""

import random
from collections import Counter

from pyspark.sql import functions as F

from marksman.llm import language_id
from marksman.llm.queries import op2_language_id
from marksman.llm.exact_dedup import located
from tests.llm.data import COLUMNS, WORDS, documents, hard_cases


def found(records):
    return language_id.identify(records, language_id.train(records))


def test_documents_agree_with_their_languages(spark):
    docs = located(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = found(language_id.document_records(docs)).join(
        language_id.document_records(docs), ["fid", "row"]).collect()
    assert len(rows) == docs.count()
    assert sum(r.language == r.declared for r in rows) >= 0.99 * len(rows)
    assert all(r.kept for r in rows)


def test_wrong_declarations_and_hosts_are_overruled(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wrong = F.when(F.col("doc_id") % 10 == 0, "xx").when(F.col("doc_id") % 10 == 1, "en")
    docs.select("*", F.col("lang").alias("truth")).withColumn(
        "lang", F.coalesce(wrong, F.col("lang"))).withColumn("source", F.lit("one")).write.parquet(
        str(tmp_path / "d"))
    docs = located(spark.read.parquet(str(tmp_path / "d")))
    got = found(language_id.document_records(docs))
    keyed = docs.select(F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"), "truth",
                        F.length("text").alias("n"))
    rows = got.join(keyed, ["fid", "row"]).filter("n > 60").collect()
    assert sum(r.language == r.truth for r in rows) >= 0.98 * len(rows)


def test_short_texts_lean_on_evidence(spark, tmp_path):
    rows = [(f"{'the of and that with' if h == 'a' else 'der die und nicht mit'} " * 9,
             "en" if h == "a" else "de", f"{h}.example.{'com' if h == 'a' else 'de'}")
            for h in "ab" for _ in range(60)]
    rows += [("qq", None, "a.example.com"), ("qq", None, "b.example.de"), ("xj", "de", None),
             ("kv", "en", None)]
    path = str(tmp_path / "r")
    (spark.createDataFrame([(1, i, t, d, h, h and h.rsplit(".", 1)[1])
                            for i, (t, d, h) in enumerate(rows)],
                           "fid long, row long, text string, declared string, host string, "
                           "suffix string").write.parquet(path))
    got = {r.row: r.language for r in found(spark.read.parquet(path)).collect()}
    assert [got[i] for i in range(120, 124)] == ["en", "de", "de", "en"]


def test_pages(spark, tmp_path):
    pages = [(1, "HTTPS://u@WWW.Shop.example.de:80/x", "<html dir=x lang='de-AT'><p>a<script>b</script>c"),
             (2, "nonsense", "<p lang=fr>x"), (3, None, None)]
    path = str(tmp_path / "p")
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(path)
    rows = language_id.page_records(located(spark.read.parquet(path))).orderBy("row").collect()
    assert [(r.declared, r.host, r.suffix) for r in rows] == [
        ("de", "www.shop.example.de", "de"), (None, None, None), (None, None, None)]
    assert rows[0].text.split() == ["a", "c"]
    docs = located(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    records = language_id.page_records(docs)
    got = found(records).join(records, ["fid", "row"]).collect()
    assert sum(r.language == r.declared for r in got) >= 0.98 * len(got)


def test_hard_cases(spark, tmp_path):
    docs = documents(spark, tmp_path)
    out = language_id.identified(docs)
    assert out.columns == [*docs.columns, "__language", "__confidence", "__kept"]
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in hard_cases())
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert letters or not r["__kept"]
        assert 0 <= r["__confidence"] <= 1
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["__kept"] for r in rows)


def test_empty_and_undeclared(spark, tmp_path):
    empty = spark.createDataFrame([], COLUMNS)
    assert language_id.identified(empty).collect() == []
    docs = documents(spark, tmp_path).withColumn("lang", F.lit(None).cast("string"))
    rows = language_id.identified(docs).collect()
    assert {r["__language"] for r in rows} == {"und"} and any(r["__kept"] for r in rows)


def test_rare_languages_have_models_at_every_size(spark, tmp_path):
    """12 of 1 500 records are Greek, far fewer than a sample of the table holds;
    a rare declaration without texts must not keep the junk."""
    draw = random.Random(5)
    def text(words):
        return " ".join(draw.choice(words) for _ in range(60))
    def junk():
        return " ".join("".join(draw.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(60))
    greek = "και το της που για από ένα στην είναι δεν θα με σε τους μας όταν ημέρα".split()
    rows = [(text(WORDS), "en") for _ in range(1460)]
    rows += [(text(greek), "el") for _ in range(12)]
    rows += [("1 2 3", "zz")] * 12 + [(junk(), None) for _ in range(8)] + [(text(greek), None)] * 8
    path = str(tmp_path / "rare")
    (spark.createDataFrame([(1, i, t, d, None, None) for i, (t, d) in enumerate(rows)],
                           "fid long, row long, text string, declared string, host string, "
                           "suffix string").write.parquet(path))
    records = spark.read.parquet(path)
    model = language_id.train(records, sample=100)
    assert model.languages == ["el", "en"]
    got = {r.row: (r.language, r.kept) for r in language_id.identify(records, model).collect()}
    assert {got[i] for i in range(1460)} == {("en", True)}
    assert {got[i] for i in [*range(1460, 1472), *range(1492, 1500)]} == {("el", True)}
    assert {got[i] for i in range(1472, 1492)} == {("und", False)}


def test_query_identifies_documents_and_pages(spark):
    folder = "/root/testdata/sf0.01"
    rows = op2_language_id(spark, folder).collect()
    for table, key in (("documents", "doc_id"), ("pages", "page_id")):
        ids = [r[key] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()]
        assert Counter(r[key] for r in rows if r.table == table) == Counter(ids)
    located_pages = located(spark.read.parquet(f"{folder}/pages.parquet"))
    declared = {r.page_id: r.declared for r in language_id.page_records(located_pages).join(
        located_pages.select(F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"),
                             "page_id"), ["fid", "row"]).collect()}
    pages = [r for r in rows if r.table == "pages"]
    assert all(r.doc_id is None for r in pages)
    assert sum(r.language == declared[r.page_id] for r in pages) >= 0.95 * len(pages)
