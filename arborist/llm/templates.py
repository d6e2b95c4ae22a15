"""Main text of web pages by site template removal.

Every page is parsed once, whole, in Arrow tasks: elements become a tree,
each subtree gets a hash of its tags and texts, and the texts of the
article region are written with the hashes of the subtrees around them.
Spark then counts, per host, on how many different pages a subtree stands;
subtrees that recur on many pages of their host are template, and the
texts inside them are deleted by joining the host's template hashes back.

What is no article whatever its frequency (scripts, styles, forms, menus,
headers, footers, sidebars, notices, adverts, comments) is known by its
tag, role, class or id and never enters the region.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, salted_join, written

MIN_PAGES = 5  # different pages of a host that hold a template subtree, at least
SHARE = 0.2  # of the host's different pages
ARTICLE_SHARE = 0.5  # the same inside a marked article

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
# Starting one of these ends an open element of the named kinds, up to the nearest boundary.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"),
    "tfoot": ("tbody", "thead", "tfoot", "tr", "td", "th"), "body": ("head",),
}
_BOUNDARY = {
    "li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "option": ("select", "datalist"),
    "optgroup": ("select",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",),
    "tfoot": ("table",), "body": (),
}
_ENDS_P = BLOCK - {"br", "body", "html", "option", "optgroup", "legend", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}

# Never part of an article.
DROPPED_TAGS = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video nav menu aside footer form button "
    "select datalist textarea input dialog search noembed noframes title".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos "
    "promotion banner banners cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay "
    "newsletter subscribe subscription signup signin login sidebar sidebars widget widgets nav navbar navigation menu menus "
    "breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar comment comments commentlist disqus respond replies "
    "share sharing social related recommended recommendations teaser search skip".split())
_NOT_WORDS = frozenset(("with", "no", "has", "without", "is"))

_TAG = re.compile(
    r"<(?:(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>"
    r"|!--(?:.*?--!?>|.*+)|[!?/][^>]*+>)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_OPEN_END = re.compile(r"<[a-zA-Z/!?][^>]*\Z")

# Characters of pages that a task hands on together, about.
_CHARS = 1 << 20

NONE, HARD, SOFT = 0, 1, 2  # how an element is dropped: not, by what it is, by its class or id


def _dropped(tag: str, attrs: str, in_article: bool) -> int:
    if tag in DROPPED_TAGS:
        return HARD
    if tag == "header" and not in_article:
        return HARD
    if not attrs or tag in ("html", "body"):
        return NONE
    for name, a, b, c in _ATTR.findall(attrs):
        name = name.lower()
        if name == "hidden":
            return HARD
        value = a or b or c
        if name == "role" and value.strip().lower() in DROPPED_ROLES:
            return HARD
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return HARD
        if name in ("class", "id"):
            for token in value.split():
                found = {w.lower() for w in _WORDS.findall(token)}
                if found & _NOT_WORDS:
                    continue
                if found & DROPPED_WORDS or ("header" in found and not in_article and tag not in ("article", "main", "h1")):
                    return SOFT
    return NONE


def _plain(raw: str) -> str:
    """Decoded text, white space as single spaces, kept at the ends."""
    text = html.unescape(raw) if "&" in raw else raw
    inner = " ".join(text.split())
    if not inner:
        return " " if text else ""
    return (" " if text[0].isspace() else "") + inner + (" " if text[-1].isspace() else "")


class _Page:
    """Elements of one page in document order, and the texts between tags."""

    def __init__(self):
        self.parent, self.tag, self.drop, self.mark = [-1], ["#page"], [NONE], [0]
        self.parts: list[list[bytes]] = [[]]
        self.hash = [0]
        self.stack = [0]
        self.texts: list[tuple[int, str]] = []
        self.marked = 0  # open articles and main parts
        self.open_p = 0

    def open(self, tag: str, attrs: str) -> None:
        if self.open_p and tag in _ENDS_P:
            self._end_open(("p",), ("article", "section", "div", "td", "li", "blockquote", "body", "table", "main"))
        if tag in _CLOSES:
            self._end_open(_CLOSES[tag], _BOUNDARY[tag])
        drop = _dropped(tag, attrs, self.marked > 0)
        mark = 2 if tag == "article" else 1 if tag == "main" or (attrs and re.search(r"\brole\s*=\s*[\"']?main\b", attrs)) else 0
        i = len(self.tag)
        self.parent.append(self.stack[-1])
        self.tag.append(tag)
        self.drop.append(drop)
        self.mark.append(mark)
        self.parts.append([])
        self.hash.append(0)
        if tag in BLOCK:
            self.texts.append((self.stack[-1], " "))
        if tag not in VOID:
            self.stack.append(i)
            self.marked += mark > 0
            self.open_p += tag == "p"

    def _end_open(self, names: tuple, boundary: tuple) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[at]]
            if tag in names:
                while len(self.stack) > at:
                    self._pop()
                if names == ("p",):
                    return
                self._end_open(names, boundary)
                return
            if tag in boundary:
                return

    def close(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[at]] == tag:
                while len(self.stack) > at:
                    self._pop()
                return

    def _pop(self) -> None:
        i = self.stack.pop()
        self.marked -= self.mark[i] > 0
        self.open_p -= self.tag[i] == "p"
        if self.parts[i]:
            digest = xxhash.xxh64_intdigest(self.tag[i].encode() + b"\0" + b"\0".join(self.parts[i]))
            self.hash[i] = digest - (1 << 64) if digest >> 63 else digest
            if self.drop[i] == NONE:
                self.parts[self.parent[i]].append(b"\1" + digest.to_bytes(8, "little"))
        self.parts[i] = []
        if self.tag[i] in BLOCK:
            self.texts.append((self.stack[-1], " "))

    def text(self, raw: str) -> None:
        plain = _plain(raw)
        if plain:
            self.texts.append((self.stack[-1], plain))
            if plain != " ":
                self.parts[self.stack[-1]].append(b"\2" + plain.strip().encode("utf-8", "surrogatepass"))

    def end(self) -> None:
        while len(self.stack) > 1:
            self._pop()


def parse(source: str) -> _Page:
    """Tree of a whole page; broken markup is read as far as it goes."""
    page, at = _Page(), 0
    lower = None
    while at < len(source):
        m = _TAG.search(source, at)
        if m is None:
            page.text(_OPEN_END.sub("", source[at:]))
            break
        if m.start() > at:
            page.text(source[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        tag = name.lower()
        if m["close"]:
            if tag == "p" and not page.open_p:
                page.texts.append((page.stack[-1], " "))
            page.close(tag)
            continue
        attrs = m["attrs"]
        page.open(tag, attrs)
        if tag in RAW and not attrs.endswith("/"):
            if lower is None:
                lower = source.translate(_LOWER)
            end = lower.find(f"</{tag}", at)
            at = len(source) if end < 0 else end
            if end < 0:
                break
        elif attrs.endswith("/") and tag not in VOID and tag in ("svg", "math"):
            page.close(tag)
    page.end()
    return page


def region(page: _Page) -> tuple[list[tuple[str, list[int]]], bool]:
    """Texts of the article region with the hashes of the subtrees around them,
    outermost first, and whether the region is a marked article."""
    n = len(page.tag)
    hard, soft = [False] * n, [False] * n
    for i in range(1, n):
        p = page.parent[i]
        hard[i] = hard[p] or page.drop[i] == HARD
        soft[i] = soft[p] or page.drop[i] == SOFT
    held = [False] * n
    for i, text in page.texts:
        if text != " " and not held[i]:
            while i > 0 and not held[i]:
                held[i] = True
                i = page.parent[i]
    roots: list[int] = []
    # Articles, else mains; those inside elements dropped for their class only if there are no others.
    for wanted, loose in ((2, False), (1, False), (2, True), (1, True)):
        inside = [False] * n
        roots = []
        for i in range(1, n):
            p = page.parent[i]
            inside[i] = inside[p] or (page.mark[i] >= wanted if wanted == 2 else page.mark[i] == 1)
            own = page.drop[i] != NONE
            if inside[i] and not inside[p] and held[i] and not hard[i] and not own and (loose or not soft[i]):
                roots.append(i)
        if roots:
            break
    marked = bool(roots)
    above: list[list[int] | None] = [None] * n
    if marked:
        for r in roots:
            above[r] = []
        rootset = set(roots)
    else:
        above[0], rootset = [], {0}
    for i in range(1, n):
        if i in rootset:
            continue
        p = above[page.parent[i]]
        if p is not None and page.drop[i] == NONE:
            above[i] = [*p, page.hash[i]] if page.hash[i] and page.tag[i] not in ("html", "body") else p
    out: list[tuple[str, list[int]]] = []
    for i, text in page.texts:
        path = above[i]
        if path is None:
            text, path = " ", out[-1][1] if out else []
        if out and out[-1][1] == path:
            out[-1] = (out[-1][0] + text, path)
        elif text != " " or out:
            out.append((text, path))
    return [(re.sub("  +", " ", t) if "  " in t else t, path) for t, path in out], marked


_NEW = "pieces array<struct<text:string,above:array<bigint>>>, marked boolean, page bigint"


def parsed_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without its HTML, plus ``pieces`` (texts of the region with the
    hashes around them), ``marked`` and ``page`` (a hash of the region)."""
    others = [c for c in pages.columns if c != html_col]
    schema = pages.select(*others).schema
    at = pages.columns.index(html_col)
    piece = pa.struct([pa.field("text", pa.string()), pa.field("above", pa.list_(pa.int64()))])

    def rows(batch, lo, found):
        """One batch of the rows from ``lo`` on, as far as they were parsed."""
        rest = [c.slice(lo, len(found)) for i, c in enumerate(batch.columns) if i != at]
        pieces = [[{"text": t, "above": a} for t, a in texts] for texts, _ in found]
        whole = [xxhash.xxh64_intdigest("".join(t for t, _ in texts).encode("utf-8", "surrogatepass")) for texts, _ in found]
        new = [pa.array(pieces, pa.list_(piece)), pa.array([m for _, m in found]), pa.array(np.array(whole, np.uint64).view(np.int64))]
        return pa.RecordBatch.from_arrays([*rest, *new], [*others, "pieces", "marked", "page"])

    def run(batches):
        for batch in batches:
            lo, found, held = 0, [], 0
            for row in range(batch.num_rows):
                source = batch.column(at)[row].as_py() or ""
                found.append(region(parse(source)))
                held += len(source)
                if held >= _CHARS:  # pages may be long
                    yield rows(batch, lo, found)
                    lo, found, held = row + 1, [], 0
            if found:
                yield rows(batch, lo, found)

    return pages.mapInArrow(run, T.StructType([*schema.fields, *T.StructType.fromDDL(_NEW).fields]))


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; else empty."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def template_subtrees(parsed: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE,
                      article_share: float = ARTICLE_SHARE) -> DataFrame:
    """``(host, marked, subtree)`` of the subtrees that stand on at least
    ``min_pages`` different pages of their host and kind (with a marked
    article or not) and ``share`` or ``article_share`` of those.  Pages of
    a host whose region reads the same count once: copies of an article
    are no template."""
    kind = ["host", "marked"]
    hashes = F.array_distinct(F.flatten(F.transform("pieces", lambda p: p["above"])))
    single = written(parsed.select(*kind, "page", hashes.alias("subtrees")).dropDuplicates([*kind, "page"]))
    pages = single.groupBy(*kind).agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    counts = single.select(*kind, F.explode("subtrees").alias("subtree")).groupBy(*kind, "subtree")
    counts = counts.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    least = F.when(F.col("marked"), F.lit(article_share)).otherwise(F.lit(share))
    return counts.join(pages, kind).where(F.col("n") >= least * F.col("pages")).select(*kind, "subtree")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, share: float = SHARE, article_share: float = ARTICLE_SHARE) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars, n_deleted``.

    ``text`` is the article's text: character references decoded, white space
    as single spaces, blocks joined by one; empty if there is none.
    ``n_deleted`` counts the texts that template removal took out.  Where a
    page marks an article (or main part) only that is read, and a subtree in
    it is template from ``article_share`` of the host's pages with one on;
    on the other pages from ``share`` of those on.  Null and empty HTML has an empty text; pages without a
    host are one host of their own; rows that repeat an id or a page have
    rows of their own; hosts with fewer than ``min_pages`` different pages
    keep all texts; an empty table gives an empty result; other columns are
    not read.
    """
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = written(parsed_pages(slim).withColumn("host", host_of(F.col("url"))))
    # A host has at most (subtrees of a page) / share of them: an array of a page's size.
    found = template_subtrees(parsed, min_pages, share, article_share)
    found = written(found.groupBy("host", "marked").agg(F.collect_list("subtree").alias("subtrees")))
    hosts, letters, hashes = found.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("host")), F.lit(0)), F.coalesce(F.sum(F.size("subtrees")), F.lit(0))
    ).first()
    side = bounded(found, hosts, letters + 16 * hashes + 64 * hosts)
    if side is not found:
        joined = parsed.join(side, ["host", "marked"], "left")
    else:
        joined = salted_join(parsed, found, ["host", "marked"], F.xxhash64("page", "page_id"), "left")
    template = F.coalesce("subtrees", F.array().cast("array<bigint>"))
    gone = lambda p: F.arrays_overlap(p["above"], template)
    kept = F.transform("pieces", lambda p: F.when(gone(p), F.lit(" ")).otherwise(p["text"]))
    text = F.trim(F.regexp_replace(F.array_join(kept, ""), " +", " "))
    out = joined.select(
        "page_id", "url", text.alias("text"), F.size(F.filter("pieces", lambda p: gone(p) & (F.trim(p["text"]) != ""))).alias("n_deleted")
    )
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_deleted")
