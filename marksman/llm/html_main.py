"""Main text of web pages.

A page becomes a stream of blocks in page order: text between block-level tags,
inline markup dropped, character references decoded, white space folded. Each
block knows which elements enclose it. Three kinds follow from the markup:
furniture (navigation, header, footer, aside, form, script and the like, and
elements with a class, id or role that names menu, sidebar, advert, notice, comment,
...: a whole name such as ``sidebar`` or ``site-nav``, not one that only has the
word in it, such as ``has-sidebar`` or ``share-price``), the article proper (inside
``article`` or ``main``), and *open* blocks, about which the markup says nothing. An
article opens a scope of its own, also in a marked wrapper or a form, but not in
navigation, header, footer, aside, comments, adverts and the like.

Boilerplate among open blocks is found per host. The hosts' open blocks are
concatenated into token streams, a suffix array is built for each shard of a
host, and a run of at least ``MIN_TOKENS`` tokens that occurs on another page of
the host is repeated; blocks of which repeated runs cover at least half are
removed and unique runs stay. Shards are chosen by content: every place of a
stream belongs to the shard of the least token hash in the run that begins
there, so equal runs meet in one shard wherever their pages are, and a host that
holds a third of all pages spreads over all shards.

Applied to article blocks as well, the method would remove the article
paragraphs that two pages of a host share; the contract keeps them, so there it
does not decide. Pages without ``article`` or ``main`` depend on it wholly.

Edge cases: null or empty html and pages of furniture only give the empty text;
an empty table gives no row; repeated pages (same id) are pages of their own,
but the runs they share with one another do count as repeated; a null url is a
host of its own; other columns are ignored; pages may be of any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marksman.llm.common import arrow_rows, map_arrow, text_or_empty, written
from marksman.llm.exact_dedup import located
from marksman.llm.suffix_dedup import repeated_spans
from marksman.plans.sizing import broadcast_if_small

MIN_TOKENS = 8
COVERED = 0.5
_CODE = 8  # bytes of a token's code

ARTICLE, OPEN, FURNITURE = 0, 1, 2
_WRAPPER = 3  # furniture in which an article may stand

_MAIN = {"article", "main"}
_SKIP = {"head", "script", "style", "template", "noscript", "svg", "math", "iframe", "object",
         "canvas", "audio", "video", "select", "option", "textarea", "button"}
_ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
           "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span",
           "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp",
           "img"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
# What stands in a head; anything else ends one that is still open.
_HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript",
         "script", "style", "template", "title"}
# An element that one of these begins closes an open one of the listed kinds.
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
           "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
_CLOSES |= {t: {"p"} for t in ("article", "aside", "blockquote", "div", "dl", "footer", "form",
                               "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav",
                               "ol", "pre", "section", "table", "ul")}
# Words of class, id and role that mark furniture.
_MARKS = {"ad", "ads", "advert", "advertisement", "advertising", "banner", "breadcrumb",
          "breadcrumbs", "comment", "comments", "consent", "contentinfo", "cookie", "cookies",
          "dialog", "disqus", "footer", "gdpr", "header", "menu", "menubar", "modal", "nav",
          "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "popup", "promo",
          "promoted", "related", "replies", "respond", "search", "share", "sharing", "sidebar",
          "sidenav", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
# Of them, those whose articles are furniture as well (comments, teasers, adverts).
_CLOSED = {"ad", "ads", "advert", "advertisement", "advertising", "comment", "comments", "disqus",
           "promo", "promoted", "related", "replies", "respond", "sidebar", "sponsor", "sponsored"}
# Words that may stand beside one of them in a name.
_NEUTRAL = {"area", "bar", "block", "box", "container", "global", "inner", "list", "links", "main",
            "outer", "page", "panel", "primary", "section", "secondary", "site", "slot", "top",
            "unit", "wrap", "wrapper"}
_WORD = re.compile(r"[a-z]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*$")  # a page that ends inside a tag


def _marks(attrs: list[tuple[str, str | None]]) -> set[str]:
    """The marks that class, id and role name: names all of whose words are marks
    or neutral."""
    out: set[str] = set()
    for k, v in attrs:
        if v and k in ("class", "id", "role"):
            for name in v.split():
                words = _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
                found = _MARKS.intersection(words)
                if found and _NEUTRAL.issuperset(found.symmetric_difference(words)):
                    out |= found
    return out


class _Blocks(HTMLParser):
    """Collects (kind, text) blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str]] = []
        self.stack: list[tuple[str, int, bool]] = []  # tag, kind inside, skipped inside
        self.kind, self.skipped = OPEN, False
        self.parts: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.blocks.append((FURNITURE if self.kind == _WRAPPER else self.kind, text))

    def _pop(self, depth: int) -> None:
        del self.stack[depth:]
        self.kind, self.skipped = self.stack[-1][1:] if self.stack else (OPEN, False)

    def _end_head(self, anywhere: bool = False) -> None:
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == "head":
                self._pop(depth)
                return
            if not anywhere:
                return

    def handle_starttag(self, tag, attrs):
        if tag not in _HEAD:
            self._end_head(tag == "body")
        if tag in _VOID:
            if tag not in _INLINE:
                self.parts.append(" ")
                if tag == "hr":
                    self._flush()
            return
        if tag not in _INLINE:
            self._flush()
            closes = _CLOSES.get(tag)
            if closes:
                for depth in range(len(self.stack) - 1, -1, -1):
                    name = self.stack[depth][0]
                    if name in closes:
                        self._pop(depth)
                        break
                    if name not in _INLINE:  # not beyond the enclosing block
                        break
        kind, skipped = self.kind, self.skipped or tag in _SKIP
        marks = _marks(attrs)
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        whole = tag in ("html", "body")
        if kind == FURNITURE:
            pass
        elif hidden or (tag in _ASIDE and tag not in ("form", "dialog")) or (
                marks & _CLOSED and not whole):
            kind = FURNITURE
        elif tag in _MAIN or kind == OPEN and any(
                k == "role" and v == "main" or k in ("class", "id") and v and "main" in v.split()
                for k, v in attrs):
            kind = ARTICLE
        elif tag in _ASIDE or (marks and not whole):
            kind = _WRAPPER
        if kind != self.kind:
            self._flush()
        self.stack.append((tag, kind, skipped))
        self.kind, self.skipped = kind, skipped

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        if tag not in _INLINE:
            self._flush()
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name == tag:
                if self.parts and (self.stack[depth - 1][1] if depth else OPEN) != self.kind:
                    self._flush()
                self._pop(depth)
                return
            if tag in _INLINE and name not in _INLINE:
                return  # a stray inline end does not leave its block

    def handle_data(self, data):
        if self.skipped and data.strip():
            self._end_head()
        if not self.skipped:
            self.parts.append(data)


def blocks(html: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in page order."""
    parser = _Blocks()
    parser.feed(_CUT_TAG.sub("", html))
    parser.close()
    parser._flush()
    return parser.blocks


def host(url: str | None) -> str:
    """The url's host in lower case; '' where there is none."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _codes(tokens: list[str], salt: str) -> bytes:
    """A code for every token; hosts share none."""
    return b"".join(xxhash.xxh64_digest(f"{salt} {t}") for t in tokens)


def token_streams(pages: DataFrame) -> DataFrame:
    """(fid, row, data) of (fid, row, url, html): the codes of a page's tokens
    outside the article, in page order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_rows(batch, 256):
                data = [_codes([t for kind, text in blocks(html) if kind != ARTICLE
                                for t in text.split()], host(url))
                        for url, html in zip(part.column(2).to_pylist(), part.column(3).to_pylist(),
                                             strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(data, pa.binary())],
                    ["fid", "row", "data"])

    return map_arrow(pages.select("fid", "row", "url", "html"), run,
                     "fid long, row long, data binary")


def kept_texts(found: list[tuple[int, str]], spans: list[dict] | None) -> list[str]:
    """The blocks that stay: the article's, and open ones that the host's
    repeated runs cover by less than ``COVERED``."""
    tokens = [0 if kind == ARTICLE else len(text.split()) for kind, text in found]
    covered = np.zeros(sum(tokens) + 1, np.int64)
    for s in spans or []:
        covered[s["start"] // _CODE:s["end"] // _CODE] = 1
    total = np.concatenate([[0], np.cumsum(covered)])
    out, at = [], 0
    for (kind, text), n in zip(found, tokens, strict=True):
        own = int(total[at + n] - total[at])
        at += n
        if kind == ARTICLE or (kind == OPEN and own < COVERED * n):
            out.append(text)
    return out


def main_texts(pages: DataFrame) -> DataFrame:
    """The pages' columns but ``html``, and ``__text``. Pages are parsed twice,
    for their token streams and for the result: cheaper than to keep and move
    the blocks of all pages. Only the spans are joined to the pages."""
    columns = pages.columns
    pages = located(pages)
    named = pages.select(F.xxhash64("__file").alias("fid"), F.col("__row").alias("row"),
                         *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)])
    url, html = (f"__c{columns.index(c)}" for c in ("url", "html"))
    named = named.withColumn(html, text_or_empty(html))
    spans = written(repeated_spans(
        written(token_streams(named.select("fid", "row", F.col(url).alias("url"),
                                           F.col(html).alias("html"))), "page-streams"),
        MIN_TOKENS * _CODE, _CODE, True), "page-spans")
    spans, _ = broadcast_if_small(spans, 200_000, 64 << 20)
    rows = named.join(spans, ["fid", "row"], "left").drop("fid", "row")
    kept = [c for c in rows.columns if c not in (html, "spans")]
    rows = rows.select(*kept, html, "spans")
    n = len(kept)
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField("__text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_rows(batch, 256):
                texts = [" ".join(kept_texts(blocks(h), s)) for h, s in zip(
                    part.column(n).to_pylist(), part.column(n + 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(texts, pa.string())],
                                                 [*kept, "__text"])

    out = map_arrow(rows, run, schema)
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns) if c != "html"],
                      "__text")


__all__ = ["blocks", "host", "kept_texts", "main_texts", "token_streams"]
