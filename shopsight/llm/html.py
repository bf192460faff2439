"""Main text of web pages, without a site's recurring parts.

A page is read as a stream of tags and text. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts and reader comments go by their element, role
or class. What else a site repeats is found from its pages: every element
subtree is hashed, Spark counts the different main texts of the host that have
it beside them, and subtrees of many are deleted. Copies of a page are one main
text, so they make nothing a template. A subtree that holds most of a page's
text stays on it; inside an article only containers can be deleted, never
headings and paragraphs, and none if all of them together are most of its text.
Each page meets its own templates only, so a host may have any number of them.

Defined results: null or empty html gives an empty text; a null url is a host of
its own; unclosed and stray tags are tolerated, a text is never cut off; equal
rows are pages of their own; an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm.common import col, cut, fresh, map_rows, small_side


@dataclass(frozen=True)
class Templates:
    """A subtree is a template on pages of ``min_pages`` different main texts of
    its host or more, if it is on that share of the host's different main texts:
    surely so, by the lower end of a confidence interval, so that a page's text
    doesn't depend on how many pages of its host there are. Inside an article
    only its first and last subtrees can be templates, and on most pages."""

    min_pages: int = 8
    min_share: float = 0.02
    min_share_inside: float = 0.5
    deviations: float = 1.96


def surely(n: F.Column, of: F.Column, z: float) -> F.Column:
    """The lower end of the Wilson interval of the share ``n / of``."""
    share = n / of
    spread = z * F.sqrt(share * (1 - share) / of + z * z / (4 * of * of))
    return (share + z * z / (2 * of) - spread) / (1 + z * z / of)


# Elements and class words.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "object", "math", "title")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong "
                   "strike sub sup time tt u var wbr img ruby rt rp".split())
DROPPED = frozenset("nav footer aside form button input dialog menu head".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar "
    "sidenav widget menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments "
    "commentlist disqus reply replies respond cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations toolbar pagination "
    "pager hidden paywall".split())
KEPT_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROOTS = ("article", "main")
CONTAINERS = frozenset("div section ul ol dl table figure details fieldset center blockquote".split())
#: End tags that close what lies open inside, but never reach out of these.
BARRIERS = frozenset("article main body html td th nav aside footer header form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)>|<[!?][^>]*>|</?[a-zA-Z!][^>]*\Z",
    re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-zA-Z]+")


class _Open:
    __slots__ = ("dropped", "first", "inside", "name")

    def __init__(self, name: str, dropped: bool, first: int, inside: bool) -> None:
        self.name, self.dropped, self.first, self.inside = name, dropped, first, inside


def _unwanted(name: str, attrs: str, inside: bool) -> bool:
    """Whether an element goes as a whole; ``inside`` an article."""
    if name in DROPPED:
        return True
    if name == "header":
        return not inside
    if not attrs or name in ("html", "body", *ROOTS):
        return False
    found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
    if found.get("role", "").lower() in DROPPED_ROLES or found.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", found.get("style", "")) or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attrs):
        return True
    words = {w.lower() for w in _WORD.findall(found.get("class", "") + " " + found.get("id", ""))}
    if inside and (name in KEPT_HEADINGS or words & DROPPED_WORDS <= {"header"}):
        return False
    return bool(words & DROPPED_WORDS)


class Page:
    """The text pieces of a page and its element subtrees.

    ``pieces``: (text, depth of articles, depth of main); ``subtrees``: (first piece, end, inside an
    article, name) of the elements whose pieces are kept.
    """

    def __init__(self, source: str) -> None:
        self.pieces: list[tuple[str, bool, bool]] = []
        self.subtrees: list[tuple[int, int, bool, str]] = []
        self.stack: list[_Open] = []
        self.dropped = 0
        self.depth = dict.fromkeys(ROOTS, 0)
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if name := m["name"]:
                name = name.lower()
                self._end(name) if m["end"] else self._start(name, m["attrs"])
            elif m["raw"]:
                self._text(" ")
        if at < len(source):
            self._text(source[at:])
        while self.stack:
            self._close()

    def _text(self, text: str) -> None:
        if not self.dropped:
            self.pieces.append((entities.unescape(text), self.depth["article"] > 0, self.depth["main"] > 0))

    def _start(self, name: str, attrs: str) -> None:
        if name not in INLINE:
            if not self.dropped:
                self._text(" ")
            if name in ("p", "div", "ul", "ol", "table", "section", "article", *KEPT_HEADINGS):
                self._shut("p")
        if name in ("li", "tr", "td", "th", "option", "dt", "dd"):
            self._shut(name)
        if name in VOID:
            return
        inside = self.depth["article"] > 0
        gone = _unwanted(name, attrs, inside)
        self.stack.append(_Open(name, gone, len(self.pieces), inside))
        self.dropped += gone
        if name in self.depth and not self.dropped:
            self.depth[name] += 1

    def _shut(self, name: str) -> None:
        """An open element of this name ends, if it is the innermost block."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].name == name:
                while len(self.stack) > i:
                    self._close()
                return
            if self.stack[i].name not in INLINE:
                return

    def _end(self, name: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].name == name:
                while len(self.stack) > i:
                    self._close()
                break
            if self.stack[i].name in BARRIERS and name not in BARRIERS:
                break
        if name not in INLINE:
            self._text(" ")

    def _close(self) -> None:
        e = self.stack.pop()
        if e.name in self.depth and not self.dropped:
            self.depth[e.name] -= 1
        self.dropped -= e.dropped
        if not self.dropped and not e.dropped and e.name not in INLINE and len(self.pieces) > e.first:
            self.subtrees.append((e.first, len(self.pieces), e.inside, e.name))

    def hashes(self) -> list[tuple[int, int, int, bool]]:
        """(first piece, end, hash, inside an article) of the subtrees that may be
        templates; inside an article they begin or end its text."""
        out = []
        body = [i for i, p in enumerate(self.pieces) if p[1] and p[0].strip()]
        for first, end, inside, name in self.subtrees:
            if name in ("html", "body", *ROOTS) or (inside and (
                    name not in CONTAINERS or not body or (first > body[0] and end <= body[-1]))):
                continue
            text = " ".join("".join(p[0] for p in self.pieces[first:end]).split())
            if text:
                digest = blake2b(f"{name}\0{inside}\0{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
                out.append((first, end, int.from_bytes(digest, "little", signed=True), inside))
        return out

    def text(self, templates: frozenset[int] = frozenset()) -> str:
        root = 1 if any(p[1] for p in self.pieces) else 2 if any(p[2] for p in self.pieces) else 0
        gone = bytearray(len(self.pieces))
        if templates:
            lengths = [sum(map(len, p[0].split())) if not root or p[root] else 0 for p in self.pieces]
            upto = [0, *accumulate(lengths)]
            for first, end, h, _ in self.hashes():
                if h in templates and 2 * (upto[end] - upto[first]) <= upto[-1]:
                    gone[first:end] = b"\1" * (end - first)
            if root == 1 and 2 * sum(n for n, g in zip(lengths, gone, strict=True) if g) > upto[-1]:
                gone = bytearray(len(self.pieces))
        parts = [(p[0] if not gone[i] else " ") for i, p in enumerate(self.pieces) if not root or p[root]]
        return " ".join("".join(parts).split())


_HOST = r"(?i)^[^:/?#]*://([^/?#]*)"


def _host(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(col(url).cast("string"), F.lit("")), _HOST, 1))


def _page(url: str, html: str) -> F.Column:
    """What equal pages of a host share."""
    return F.xxhash64(_host(url), F.coalesce(col(html).cast("string"), F.lit("")))


def page_templates(pages: DataFrame, url: str = "url", html: str = "html", rule: Templates = Templates()) -> DataFrame:
    """(page, templates): hashes of the subtrees that recur on the host's pages,
    for the pages that have some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for host, key, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                page = Page(source.as_py() or "")
                digest = blake2b(page.text().encode("utf-8", "surrogatepass"), digest_size=8).digest()
                main = int.from_bytes(digest, "little", signed=True)
                own = {(h, inside) for _, _, h, inside in page.hashes()}
                # a page without subtrees counts as a page of its host
                rows += [(host, key, main, h, inside) for h, inside in sorted(own)] or [(host, key, main, None, None)]
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["host", "page", "main", "h", "inside"])

    plain = pages.select(F.xxhash64(_host(url)).alias("host"), _page(url, html).alias("page"), col(html).cast("string").alias("html"))
    found = cut(plain.mapInArrow(run, "host long, page long, main long, h long, inside boolean").distinct())
    often = found.where("h is not null").groupBy("host", "h", "inside").agg(F.count_distinct("main").alias("n")).where(
        F.col("n") >= rule.min_pages)
    sizes = found.groupBy("host").agg(F.count_distinct("main").alias("pages"))
    least = F.when(F.col("inside"), rule.min_share_inside).otherwise(rule.min_share)
    often = often.join(sizes, "host").where(surely(F.col("n"), F.col("pages"), rule.deviations) >= least)
    often = cut(often.select("host", "h"))
    return found.join(small_side(often), ["host", "h"], "left_semi").groupBy("page").agg(
        F.sort_array(F.collect_set("h")).alias("templates"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", rule: Templates = Templates(),
            out: str = "text") -> DataFrame:
    """``pages`` and its main text in column ``out`` (replaced if it exists)."""
    key, known = fresh(pages, "__page"), fresh(pages, "__templates")
    per_page = page_templates(pages, url, html, rule).select(F.col("page").alias(key), F.col("templates").alias(known))
    rows = pages.drop(out).withColumn(key, _page(url, html)).join(per_page, key, "left")
    names = [c for c in rows.columns if c not in (key, known)]
    rows = rows.select(*(col(c) for c in names), known)
    at = names.index(html)

    def arrays(b: pa.RecordBatch) -> list[pa.Array]:
        texts = []
        for source, templates in zip(b.column(at), b.column(len(names)).to_pylist(), strict=True):
            texts.append(Page(source.as_py() or "").text(frozenset(templates or ())))
        return [pa.array(texts, pa.string())]

    return map_rows(rows, arrays, [T.StructField(out, T.StringType())], dropped=1)
