"""Main text of web pages by differencing with the page of the nearest URL.

A page is read as lines: the text of each block element, character references decoded, white space turned into one space.
Pages are sorted by host and path.  Copies of an article differ in little but the site around it and would delete each other,
so neighbours whose longest article line is the same (without an article: whose lines are all the same) form a run, and a run is
compared with the last page before and the first page after it on its host.  The one whose path begins alike for longer is the
nearest (ties: the one before).  The lines of both are aligned by a longest common subsequence, and lines that both have
are the site's, not the page's: they are deleted, inside an article too.  A page that would lose more than half of its article that
way is a copy all the same, and the other one is taken.  Equal pages of a run get equal texts.

What markup states outright is checked after that.  Lines in navigation, headers, footers, sidebars, notices, adverts, forms
and reader comments, told by element or by the words of class, id and role, go in any case; scripts, styles, markup and comments
are no lines at all.  A header inside an article is part of it.  Only where there is no page to compare with, an ``article`` or
``main`` element says that there is no text of the page outside of it.

Null and empty pages have an empty text.  Pages without a host are neighbours of each other.  Repeated rows get equal texts.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenpath.llm.url_filter import host, path
from lumenpath.llm.words import slices
from lumenpath.sources.staging import Stage

# A tag ends at its ``>``; an unquoted ``<`` before it says that it is none, and stands as text.  A start is thus left behind within the
# next few tags, for quotes only swap "outside" with "inside", and no more than two starts can be inside at the same place.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|object)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][^\s/<>\"']*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*)>",
    re.I | re.S,
)
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CONTENT = {"article", "main"}
_SITE = set("head nav header footer aside form menu button select dialog fieldset".split())
_SITE_WORDS = set(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs header masthead topbar footer cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe "
    "subscription signup login comment comments reply replies respond disqus share sharing social related recommended widget toolbar pagination "
    "pager search copyright contentinfo complementary".split()
)
_ASIDE_WORDS = set("ad advert comment comments reply replies sponsored promo teaser related".split())  # of an article that is not the page's
_WORD = re.compile(r"[a-z]+")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

PAGE, SITE, OPEN = 0, 1, 2  # a line in the page's article, in a part of the site, or neither


def _is_site(name: str, attributes: str, in_content: bool) -> bool:
    if name in _SITE and not (name == "header" and in_content):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    words = {w for value in _NAMED.findall(attributes) for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())}
    if name == "article":
        return bool(words & _ASIDE_WORDS)
    return bool(words & _SITE_WORDS) and not (in_content and words & {"header"} == words & _SITE_WORDS)


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """The lines of a page, each with where it stands."""
    lines: list[tuple[str, int]] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, of the site, content
    site = content = 0
    begun = False  # an article has been opened
    pieces: list[str] = []
    at = 0

    def end_line() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                lines.append((text, SITE if site else PAGE if content else OPEN))
            pieces.clear()

    def close(depth: int) -> None:
        nonlocal site, content
        for _, of_site, of_content in stack[depth:]:
            site -= of_site
            content -= of_content
        del stack[depth:]

    for found in _MARKUP.finditer(page or ""):
        if found.start() > at:
            pieces.append(page[at : found.start()])
        at = found.end()
        name = (found.group(3) or "").lower()
        if not name:
            if found.group(1):
                pieces.append(" ")
            continue
        if name in _INLINE:
            if name == "br":
                pieces.append(" ")
            elif not found.group(2) and found.group(4) and _is_site(name, found.group(4), content > 0):
                end_line()
                stack.append((name, True, False))
                site += 1
            elif found.group(2):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        end_line()
                        close(depth)
                        break
                    if stack[depth][0] not in _INLINE:
                        break
            continue
        end_line()
        if found.group(2):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
            continue
        for depth in range(len(stack) - 1, -1, -1):  # elements that this one ends without saying so
            if stack[depth][0] == "p" or stack[depth][0] in _CLOSES.get(name, ()):
                close(depth)
                break
            if stack[depth][0] not in _INLINE:
                break
        if name in _VOID:
            continue
        of_site = _is_site(name, found.group(4), content > 0)
        of_content = name in _CONTENT and not of_site
        if of_content and not begun:  # the article does not stand in a part of the site: that was left open
            begun = True
            for depth, (_, was_site, _) in enumerate(stack):
                if was_site:
                    close(depth)
                    break
        stack.append((name, of_site, of_content))
        site += of_site
        content += of_content
    if page and at < len(page):
        pieces.append(page[at:])
    end_line()
    return lines


def common(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Hirschberg's division, with rows of the table as bits of one integer: time len(a) * len(b) / 64, memory linear.
    """
    out: set[int] = set()
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.add(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            out.add(a1 - 1)
            a1, b1 = a1 - 1, b1 - 1
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            if a[a0] in b[b0:b1]:
                out.add(a0)
            continue
        middle = (a0 + a1) // 2
        front = _lengths(a[a0:middle], b[b0:b1])
        back = _lengths(a[middle:a1][::-1], b[b0:b1][::-1])
        cut = b0 + int(np.argmax(front + back[::-1]))
        work += [(a0, middle, b0, cut), (middle, a1, cut, b1)]
    return out


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """For every k, the length of a longest common subsequence of ``a`` and the first k of ``b``."""
    places: dict[int, int] = {}
    for k, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << k
    whole = (1 << len(b)) - 1
    row = whole
    for x in a:
        hit = places.get(x, 0) & row
        row = ((row + hit) | (row - hit)) & whole
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)]
    return np.append(0, np.cumsum(1 - bits.astype(np.int64)))


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


@dataclass
class Page:
    host: str
    path: str
    key: int
    lines: list[int]
    own: list[int] | None = None  # characters of each line that stands in the article, 0 for the others
    run: int | None = None

    def shared(self, before: Page | None, after: Page | None, last: str | None = None) -> list[int] | None:
        """Numbers of the lines that the nearest neighbour has too; None if there is none to compare with.

        ``last`` is the path of the last of several equal pages.
        """
        paths = (before, self.path), (after, self.path if last is None else last)
        near = [(_alike(p.path, path), p) for p, path in paths if p is not None and p.host == self.host and p.lines != self.lines]
        for _, page in sorted(near, key=lambda x: -x[0]):
            found = sorted(common(self.lines, page.lines))
            if not self.own or 2 * sum(self.own[k] for k in found) <= sum(self.own):
                return found
        return None


def main_text(lines: list[tuple[str, int]], shared: set[int] | None) -> str:
    """The lines that are the page's own, after those shared with the neighbour are known; None: there is no neighbour."""
    if shared is None:
        wanted = PAGE if any(place == PAGE for _, place in lines) else OPEN
        return "\n".join(line for line, place in lines if place == wanted)
    return "\n".join(line for k, (line, place) in enumerate(lines) if place != SITE and k not in shared)


_PAGE = "host string, path string, key bigint, lines array<bigint>, own array<int>, run bigint"
_PAGE_NAMES = ["host", "path", "key", "lines", "own", "run"]
_PAIRED = "key bigint, shared array<int>, edge int, host string, path string, lines array<bigint>, own array<int>, run bigint"
_NAMES = ["key", "shared", "edge", "host", "path", "lines", "own", "run"]
_KINDS = [pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()]


def _digest(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _numbers(lines: list[tuple[str, int]]) -> tuple[list[int], list[int], int]:
    """Digests of a page's lines, the characters of those in the article, and what tells the run."""
    digests = [_digest(line.encode()) for line, _ in lines]
    own = [len(line) if place == PAGE else 0 for line, place in lines]
    return digests, own, digests[own.index(max(own))] if any(own) else _digest(np.array(digests, np.int64).tobytes())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Page, int]]:
    """Pages in order, each key once, and their ``edge`` if they have one."""
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["host"], row["path"], row["key"]) != last:
                last = row["host"], row["path"], row["key"]
                yield Page(*(row[c] for c in _PAGE_NAMES)), row.get("edge") or 0


def _runs(pages: Iterator[tuple[Page, int]]) -> Iterator[list[tuple[Page, int]]]:
    """Neighbours of one host and run; equal pages hold the same lists."""
    run: list[tuple[Page, int]] = []
    for page, edge in pages:
        if run and (run[0][0].host, run[0][0].run) != (page.host, page.run):
            yield run
            run = []
        if run and (run[-1][0].lines, run[-1][0].own) == (page.lines, page.own):
            page.lines, page.own = run[-1][0].lines, run[-1][0].own
        run.append((page, edge))
    if run:
        yield run


def _compared(run: list[tuple[Page, int]], before: Page | None, after: Page | None) -> Iterator[tuple[int, list[int] | None]]:
    """The key and the shared lines of each page of a run; equal pages are compared once."""
    equal: dict[tuple, list[Page]] = {}
    for page, _ in run:
        equal.setdefault((tuple(page.lines), tuple(page.own)), []).append(page)
    for pages in equal.values():
        found = pages[0].shared(before, after, pages[-1].path)
        for page in pages:
            yield page.key, found


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared lines of the pages of each run whose two neighbours are here; the first and the last run as they are.

    ``edge`` is 1 for the pages of the first and the last run, which may go on elsewhere, and 2 for the page beside them.
    """
    out: list[tuple] = []

    def full(least: int) -> Iterator[pa.RecordBatch]:
        while len(out) >= least:
            some = out[:2000]
            del out[:2000]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), _KINDS)], names=_NAMES)

    edge = lambda page, kind: (page.key, None, kind, page.host, page.path, page.lines, page.own, page.run)
    before = run = None
    count = 0
    for after in _runs(_rows(batches)):
        count += 1
        if count == 2:
            out.append(edge(after[0][0], 2))
        if run is None:
            out += [edge(page, 1) for page, _ in after]
        elif before is not None:
            out += [(key, found, 0, None, None, None, None, None) for key, found in _compared(run, before, after[0][0])]
        before, run = run and run[-1][0], after
        yield from full(2000)
    if count > 1:
        out.append(edge(before, 2))
        out += [edge(page, 1) for page, _ in run]
    yield from full(1)


def _pair_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared lines of the pages with edge 1; all pages of edge 1 and 2 are here, in order."""
    before = run = None
    for after in chain(_runs(_rows(batches)), [None]):
        if run is not None and any(kind == 1 for _, kind in run):
            keys, found = zip(*_compared([x for x in run if x[1] == 1], before, after and after[0][0]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["key", "shared"])
        before, run = run and run[-1][0], after


def _shared_lines(pages: DataFrame) -> DataFrame:
    """``key`` and the numbers of the lines shared with the nearest page, if there is one, from ``key``, ``host``, ``path``, ``html``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = zip(*(_numbers(page_lines(page)) for page in part.column("html").to_pylist()))
                kinds = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("host", "path", "key")), *(pa.array(c, t) for c, t in zip(found, kinds))], names=_PAGE_NAMES
                )

    lines = pages.select("host", "path", "key", "html").mapInArrow(read, _PAGE)
    order = ["host", "path", "key"]
    paired = lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pair, _PAIRED)
    paired = Stage(pages.sparkSession, "page_text").keep("paired", lambda: paired)
    edges = paired.where("edge > 0").select("edge", *_PAGE_NAMES)
    # A page next to two partitions' ends may come twice; the one that lacks a neighbour counts.
    edges = edges.coalesce(1).sortWithinPartitions(*order, "edge").mapInArrow(_pair_edges, "key bigint, shared array<int>")
    return paired.where("edge = 0").select("key", "shared").union(edges).where("shared is not null").dropDuplicates(["key"])


def extract(pages: DataFrame) -> DataFrame:
    """The rows of pages, which have ``url`` and ``html``, with ``text`` in the place of ``html``; a ``text`` they bring is replaced."""
    others = [c for c in pages.columns if c not in ("html", "text")]
    named = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        F.xxhash64("url", "html").alias("key"), "html",
    )
    shared = _shared_lines(named)
    schema = T.StructType([named.schema["row"], named.schema["key"], T.StructField("size", T.LongType()), T.StructField("lines", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                cells = ["\n".join(f"{place}{line}" for line, place in page_lines(page)).encode() for page in part.column("html").to_pylist()]
                packed = [pa.compress(cell, "zstd", asbytes=True) for cell in cells]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("key"), pa.array([len(c) for c in cells], pa.int64()), pa.array(packed, pa.binary())], names=schema.fieldNames()
                )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = []
                for cell, size, found in zip(*(part.column(c).to_pylist() for c in ("lines", "size", "shared"))):
                    lines = pa.decompress(cell, size, "zstd", asbytes=True).decode().split("\n") if size else []
                    texts.append(main_text([(line[1:], int(line[0])) for line in lines], None if found is None else set(found)))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    lines = named.select("row", "key", "html").mapInArrow(read, schema)
    chosen = lines.join(shared, "key", "left").select("row", "size", "lines", "shared")
    texts = chosen.mapInArrow(choose, T.StructType([named.schema["row"], T.StructField("text", T.StringType())]))
    return texts.select(*[F.col(f"row.`{c}`").alias(c) for c in others], "text")
