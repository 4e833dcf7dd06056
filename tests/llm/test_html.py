"""Main texts of pages."""

import html as entities
import re
from collections import Counter

from marksman.llm import html_main
from marksman.llm.html_main import ARTICLE, FURNITURE, OPEN, blocks

COLUMNS = "page_id long, url string, html string, text string, fid long, kinds string"


def texts(spark, tmp_path, pages):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(i, u, h, "t", i, "k") for i, u, h in pages], COLUMNS).write.parquet(path)
    df = html_main.main_texts(spark.read.parquet(path))
    assert df.columns == ["page_id", "url", "text", "fid", "kinds", "__text"]
    return Counter((r.page_id, r.url, r["__text"]) for r in df.collect())


def test_blocks():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
            "<header>top</header><nav><ul><li>one<li>two</ul></nav><div class='cookie-notice'>ok</div>"
            "<main><h1>Head&shy;ing</h1><p>a <b>b</b>c&amp;d<br>e\n\n f<p>second<script>x='</p>'</script>"
            "<aside>side</aside><div id=comments><p>first!</p></div><form>q<input></form></main>"
            "<p>loose</p><footer>&copy; x</footer><!-- gone --></body></html>")
    assert blocks(page) == [
        (FURNITURE, "top"), (FURNITURE, "one"), (FURNITURE, "two"), (FURNITURE, "ok"),
        (ARTICLE, "Head­ing"), (ARTICLE, "a bc&d e f"), (ARTICLE, "second"),
        (FURNITURE, "side"), (FURNITURE, "first!"), (FURNITURE, "q"), (OPEN, "loose"),
        (FURNITURE, "© x")]


def test_broken_markup():
    assert blocks("") == [] and blocks("plain  text") == [(OPEN, "plain text")]
    assert blocks("<article><p><b>one<br><p>two</article><footer>x") == [
        (ARTICLE, "one"), (ARTICLE, "two"), (FURNITURE, "x")]
    assert blocks("<article>a < b & c</b></i> <p") [0] == (ARTICLE, "a < b & c")
    assert blocks("<div hidden>h</div><article><div class='related posts'>r</div>x</article>") == [
        (FURNITURE, "h"), (FURNITURE, "r"), (ARTICLE, "x")]


def test_articles_open_their_own_scope():
    one = [(ARTICLE, "one")]
    for page in ("<div class='layout has-sidebar'><article>one</article></div>",
                 "<form id=aspnetForm><main>one</main></form>",
                 "<div class='page modal'><article>one</article></div>",
                 "<body class='search'><article>one</article>",
                 "<article><p class='share-price'>one</p></article>",
                 "<article><section id=search-trees>one</section></article>"):
        assert blocks(page) == one, page
    gone = [(FURNITURE, "one")]
    for page in ("<section class=comments><article>one</article></section>",
                 "<article class='comment'>one</article>", "<aside><article>one</article></aside>",
                 "<div id='siteNav'>one</div>", "<div class='cookie-notice'>one</div>",
                 "<article><div class='ad-slot'>one</div></article>",
                 "<article><form>one</form></article>", "<div class=sidebar><main>one</main></div>"):
        assert blocks(page) == gone, page


def test_head_without_end_tag():
    head = "<html><head><meta charset=utf-8><title>T</title><style>p{}</style><script>x</script>"
    for body in ("<body><article><p>one</article>", "<article><p>one</article>",
                 "<link rel=x><br><main>one</main>", "<body class=x><main><b>one</b></main></head>"):
        assert blocks(head + body) == [(ARTICLE, "one")]
    assert blocks(head + " one") == [(OPEN, "one")]
    assert blocks(head + "</head> <body>one") == [(OPEN, "one")]


def test_small_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        body = r.html[r.html.index("<article>"):]
        body = re.split("</article>|<footer>", body)[0]
        body = re.sub("<[^>]*>", " ", re.sub("</?b>", "", body))
        want[r.page_id] = " ".join(entities.unescape(body).split())
    got = {r.page_id: r["__text"] for r in html_main.main_texts(pages).collect()}
    assert got == want


def test_repeated_runs_of_a_host_go(spark, tmp_path):
    menu = "Home About Contact Imprint Privacy Terms Help Jobs Press Blog"
    page = "<body><div>" + menu + "</div><div>{}</div><div>Copyright by the same people in all years</div>"
    own = [" ".join(f"w{i}x{k}" for k in range(12)) for i in range(4)]
    pages = [(i, f"http://A.example.com/{i}", page.format(own[i])) for i in range(3)]
    pages += [(3, "https://b.example.com/", page.format(own[3]))]  # alone on its host
    pages += [(4, None, None), (5, "", ""), (6, "http://[bad", "<nav>x</nav>")]
    got = texts(spark, tmp_path, pages)
    want = [(i, p[1], own[i]) for i, p in enumerate(pages[:3])]
    want += [(3, "https://b.example.com/", f"{menu} {own[3]} Copyright by the same people in all years")]
    want += [(4, None, ""), (5, "", ""), (6, "http://[bad", "")]
    assert got == Counter(want)


def test_article_text_stays_though_repeated(spark, tmp_path):
    text = "this paragraph stands in two articles of one and the same host"
    pages = [(i, "http://h.com/x", f"<article><p>{text}</p></article>") for i in (1, 1, 2)]
    assert texts(spark, tmp_path, pages) == Counter([(p[0], p[1], text) for p in pages])


def test_empty(spark):
    assert html_main.main_texts(spark.createDataFrame([], COLUMNS)).collect() == []
