"""Main text of pages by differencing each with its nearest URL.

Pages are sorted by host and path, so a page's neighbours have the nearest URLs of its
host. A page's blocks are aligned with those of the nearer neighbour by longest
common subsequence, and shared blocks go, as templates repeat them. Blocks inside the
page's own ``article`` or ``main`` are its text and never go: passages and copies are
shared by rightful articles too. Before that, elements go that are menus, forms, adverts,
comments and the like by their tag, or by a class, id or role; the less a name says, the smaller
an element must be to go, and none goes that holds the article. Where what is left outside of ``article`` and
``main`` after differencing is longer than they are, or a page has neither, it is
text too; else they are the text alone.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

PAGES = "page_id long, url string, text string"

# Elements by their meaning in HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "object", "canvas", "svg"}
DROPPED = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "fieldset", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "listing", "main",
    "menu", "nav", "ol", "optgroup", "option", "p", "plaintext", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title",
    "tr", "ul", "xmp",
}
# Words of class, id and role names that mark what is not the article.
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus",
    "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "related", "share", "sharing",
    "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
PLAIN, HINTED, NAMED, MEANT = range(4)  # no mark, a mark within a longer name, a mark as whole name, a tag of DROPPED
MOST_NAMED, MOST_HINTED = 1 / 2, 1 / 4  # of the text around it that a marked element may hold and go

TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


def _mark(attributes: str) -> int:
    """How surely the class, id or role of an element says that it is not the article."""
    found = PLAIN
    for m in ATTRIBUTE.finditer(attributes.lower()):
        if m[1] in ("class", "id", "role") and m[2]:
            for name in m[2].strip("\"'").split():
                words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
                if name in MARKS:
                    return NAMED
                if words and (words[0] in MARKS or words[-1] in MARKS):
                    found = HINTED
    return found


class Page:
    """Elements of a page with their parents, marks and sizes, and its text in pieces."""

    def __init__(self, page: str):
        self.names, self.parents, self.marks, self.sizes = [""], [-1], [PLAIN], [0]
        self.pieces: list[tuple[int, str] | None] = []  # element and text; None where a block ends
        self._read(page)
        for e in range(len(self.names) - 1, 0, -1):  # children come after their parents
            self.sizes[self.parents[e]] += self.sizes[e]

    def _read(self, page: str) -> None:
        names, pieces, at, n, here = self.names, self.pieces, 0, len(page), 0
        while at < n:
            m = TAG.search(page, at)
            text = page[at : m.start() if m else n]
            if text:
                pieces.append((here, text))
                self.sizes[here] += len(text) - text.count(" ") - text.count("\n")
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if name in BLOCK:
                pieces.append(None)
            if name == "br":
                pieces.append((here, " "))
            if m[1]:
                here = self._closed(here, name)
            elif name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            elif name not in VOID and not m[3].endswith("/"):
                if name in BLOCK:
                    here = self._implied(here, name)
                names.append(name)
                self.parents.append(here)
                self.marks.append(MEANT if name in DROPPED else _mark(m[3]) if m[3] and name not in ("body", "html") else PLAIN)
                self.sizes.append(0)
                here = len(names) - 1

    def _closed(self, here: int, name: str) -> int:
        """Where an end tag leads to; one that was never opened changes nothing."""
        e = here
        while e > 0 and self.names[e] != name:
            e = self.parents[e]
        if e <= 0:
            return here
        if any(n in BLOCK for n in self._up(here, e)):
            self.pieces.append(None)
        return self.parents[e]

    def _up(self, here: int, to: int) -> Iterator[str]:
        while here != to:
            yield self.names[here]
            here = self.parents[here]

    def _implied(self, here: int, name: str) -> int:
        """A block ends an open paragraph, and a list item the one before it."""
        e = here
        while e > 0 and self.names[e] not in BLOCK:
            e = self.parents[e]
        if self.names[e] == "p" or (name == "li" and self.names[e] == "li"):
            return self.parents[e]
        return here

    def _kept(self) -> tuple[list[bool], list[bool]]:
        """Of each element, whether it stays, and whether it lies in an article."""
        n = len(self.names)
        anchor = [self.names[e] in ("article", "main") and self.marks[e] != NAMED for e in range(n)]
        shadowed = [False] * n  # in an element that would go whatever it holds
        for e in range(1, n):
            shadowed[e] = shadowed[self.parents[e]] or (self.marks[e] >= NAMED and not anchor[e])
        if any(a and not s for a, s in zip(anchor, shadowed, strict=True)):
            anchor = [a and not s for a, s in zip(anchor, shadowed, strict=True)]
        holds = anchor[:]
        for e in range(n - 1, 0, -1):
            holds[self.parents[e]] |= holds[e]
        kept, inside, around = [True] * n, [False] * n, [self.sizes[0]] * n
        for e in range(1, n):
            up, mark = self.parents[e], self.marks[e]
            inside[e] = inside[up] or anchor[e]
            around[e] = self.sizes[e] if anchor[e] else around[up]
            share = self.sizes[e] / max(around[up], 1)
            if holds[e]:
                goes = False
            elif self.names[e] == "header" and not inside[e]:
                goes = True
            elif mark == MEANT:  # a form may be the whole of a page without article
                goes = self.names[e] != "form" or holds[0] or share <= MOST_NAMED
            elif mark == NAMED:
                goes = (holds[0] and not inside[e]) or share <= MOST_NAMED
            else:
                goes = mark == HINTED and not inside[e] and share <= MOST_HINTED
            kept[e] = kept[up] and not goes
        return kept, inside

    def blocks(self) -> list[tuple[str, bool]]:
        kept, inside = self._kept()
        found: list[tuple[str, bool]] = []
        text: list[str] = []
        article = False
        for piece in [*self.pieces, None]:
            if piece is None:
                line = " ".join(references.unescape("".join(text)).split())
                text.clear()
                if line:
                    found.append((line, article))
                article = False
            elif kept[piece[0]]:
                text.append(piece[1])
                article |= inside[piece[0]]
        return found


def blocks(page: str) -> list[tuple[str, bool]]:
    """The blocks of a page in order, and whether each lies in an article; what is not the article by its elements left out."""
    return Page(page).blocks()


def _lengths(a: list, b: list) -> list[int]:
    """Longest common subsequence of ``a`` with every prefix of ``b``, by bits."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    out = [0]
    for bit in reversed(bin(row | 1 << len(b))[3:]):
        out.append(out[-1] + (bit == "0"))
    return out


def shared(a: list, b: list, start: int = 0) -> set[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``; memory grows with the lengths' sum."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {start + i for i in range(head)} | {start + len(a) - 1 - i for i in range(tail)}
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    start += head
    if not a or not b:
        return found
    if len(a) == 1:
        return found | ({start} if a[0] in b else set())
    half = len(a) // 2
    first, second = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])
    cut = max(range(len(b) + 1), key=lambda k: first[k] + second[len(b) - k])
    return found | shared(a[:half], b[:cut], start) | shared(a[half:], b[cut:], start + half)


def main_text(page: list[tuple[str, bool]], neighbour: list[tuple[str, bool]] | None) -> str:
    """The text of a page; what lies outside of its articles counts only if it was set against a neighbour."""
    lines = [line for line, _ in page]
    common = shared(lines, [line for line, _ in neighbour]) if neighbour else set()
    own = [line for i, (line, inside) in enumerate(page) if inside or i not in common]
    articles = [line for line, inside in page if inside]
    rest = [line for i, (line, inside) in enumerate(page) if not inside and i not in common]
    if not articles:
        return "\n".join(own or lines)  # a copy of its neighbour: nothing tells text from template
    # a teaser beside the text: what is left outside is longer than the article
    return "\n".join(own if neighbour and sum(map(len, rest)) > sum(map(len, articles)) else articles)


def _alike(a: str, b: str) -> int:
    """The length of the common start of two paths."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _ordered(key: tuple) -> tuple:
    """A key as Spark orders it, nulls first."""
    return tuple((v is not None, v) for v in key)


def _places(keys: DataFrame, parts: int) -> tuple[Column, Column]:
    """The range that a ``key`` belongs to, and an array of those beside it that need a copy of its page; the array may have nulls.

    Ranges are at most ``parts``, of about as many keys each, and none is empty.
    """
    ranged = keys.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    edges = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("first").select(F.to_json("first"), F.to_json("last"), "first.host", "last.host", F.col("first").alias("begin")).collect()
    kind = f"array<{keys.schema['key'].dataType.simpleString()}>"

    def literal(found: list[str]) -> Column:
        return F.from_json(F.lit(f"[{','.join(found)}]"), kind)

    starts = [_ordered(e["begin"]) for e in edges[1:]]

    @F.arrow_udf("int")
    def part(host: pa.Array, path: pa.Array, page_id: pa.Array, tie: pa.Array) -> pa.Array:
        return pa.array([bisect_right(starts, _ordered(key)) for key in zip(*(c.to_pylist() for c in (host, path, page_id, tie)), strict=True)], pa.int32())

    cut = [bool(a[3]) and a[3] == b[2] for a, b in zip(edges, edges[1:], strict=False)]  # through a host

    def beside(side: int, crossed: list[bool], step: int) -> Column:
        there = F.get(literal([e[side] if c else "null" for e, c in zip(edges, crossed, strict=True)]), F.col("own"))
        return F.when(there.eqNullSafe(F.col("key")), F.col("own") + step)

    return part(*(F.col(f"key.{c}") for c in ("host", "path", "page_id", "tie"))), F.array(beside(0, [False, *cut][: len(edges)], -1), beside(1, [*cut, False][: len(edges)], 1))


def extract(pages: DataFrame) -> DataFrame:
    """:data:`PAGES` of every row of ``pages`` (page_id, url, html).

    Rows are sorted by host, path and id in tasks of a range each, so a host of any
    size spreads over tasks. A first pass over the keys finds the ranges and their
    edges (two keys a range reach the driver); the page at either side of a cut is
    copied over it, so the texts don't depend on where the cuts lie. A null or empty
    html has the empty text; a null url has no host and no neighbour; of two neighbours whose paths
    begin alike over the same length the earlier one counts; pages whose html
    is the same, and repeated rows, keep their text. A page of any length is read whole, in memory of some
    times its size. An empty table gives no row.
    Other columns may have any name.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    address = F.regexp_replace(F.lower("url"), r"^[a-z][a-z0-9+.-]*://", "")
    host, path = F.regexp_extract(address, r"^([^/?#]*)", 1), F.regexp_extract("url", r"^(?:[^:/?#]+://)?[^/?#]*([^?#]*)", 1)
    pages = pages.withColumn("key", F.struct(host.alias("host"), path.alias("path"), "page_id", F.xxhash64("url", "html").alias("tie")))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, copied = _places(pages.select("key"), parts)
    pages = pages.withColumn("own", part).withColumn("part", F.explode(F.array_compact(F.concat(F.array("own"), copied))))
    pages = pages.repartitionById(parts, "part").sortWithinPartitions("key")
    pages = pages.select("page_id", "url", "html", "key.host", "key.path", (F.col("own") == F.col("part")).alias("own"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = current = None  # page_id, url, host, path, blocks, own

        def answer(after: tuple | None) -> tuple:
            near = [p for p in (before, after) if p and p[2] and p[2] == current[2]]
            best = max(near, key=lambda p: _alike(p[3], current[3]), default=None)
            return current[0], current[1], main_text(current[4], best and best[4])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)], ["page_id", "url", "text"])

        for batch in text_chunks(batches, "html"):
            rows = []
            for page_id, url, page, host, path, own in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "host", "path", "own")), strict=True):
                following = (page_id, url, host, path, blocks(page or ""), own)
                if current and current[5]:
                    rows.append(answer(following))
                before, current = current, following
            if rows:
                yield batch_of(rows)
        if current and current[5]:
            yield batch_of([answer(None)])

    return pages.mapInArrow(work, PAGES)
