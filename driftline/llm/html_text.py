"""Main text of web pages by the text-to-tag ratio of their lines.

One streaming pass of the standard library's parser turns a page into lines: the text
between two block boundaries, with its characters and the tags met since the line before.
Text that never is content leaves no line: scripts, styles, menus, page headers and
footers, sidebars, notices, adverts, forms and reader comments, known by element, ARIA
role, ``hidden`` or the words of ``class`` and ``id``.

A line's ratio is its characters outside links over its tags. The ratios in page order are
smoothed by a Gaussian and cut at their standard deviation; runs of lines above the cut are
clusters. The cluster with the most text (four times as much if it is in an ``article`` or
``main``) names the content region: the innermost container around it, widened to the
``article`` or ``main`` that holds it, or else as long as half of the parent's text is
above the cut. All lines of the region are content, short ones too. Outside of it, other
articles with a cluster count as well, and without any such element every cluster does.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from html.parser import HTMLParser
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reach of the smoothing in lines on either side, and its standard deviation.
RADIUS, SIGMA = 2, 1.0
#: How far up an inline end tag looks for its start.
INLINE_DEPTH = 64

# Element names of HTML by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split())
_DROPPED = frozenset(
    "script style noscript noframes template title nav aside footer form search button select textarea label datalist "
    "fieldset svg canvas iframe object audio video map dialog menu".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_REGIONS = frozenset(["article", "main"])
_CONTAINERS = _REGIONS | frozenset("div section body html center table td blockquote".split())
_BARRIERS = _CONTAINERS | _DROPPED
_CLOSES = {"li": {"ul", "ol", "dir"} | _DROPPED, "dd": {"dl"} | _DROPPED, "dt": {"dl"} | _DROPPED,
           "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                   "toolbar".split())
# Words of class and id that name what is not the article.
_NOT_CONTENT = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar aside nav "
    "navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "recommendations widget pagination pager copyright toolbar comment comments disqus replies respond".split())
_COMMENTS = frozenset("comment comments disqus replies respond".split())
_WRAPPERS = frozenset("has with no without content main page wrapper container layout body article post entry".split())
_WORD = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

_OPEN, _HEADINGS_ONLY, _FORM, _CLOSED = range(4)


class _Lines(HTMLParser):
    """The lines of a page and the tree of its block elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.plain: list[int] = []       # characters outside links
        self.tags: list[int] = []        # tags since the line before
        self.heading: list[bool] = []
        self.of: list[int] = []          # innermost block element
        self.parent, self.name, self.first, self.end = [-1], ["html"], [0], [-1]
        self._stack: list[tuple[str, int, int]] = [("", 0, _OPEN)]   # (tag, element, state)
        self._open: dict[str, int] = {}
        self._parts: list[str] = []
        self._linked = self._seen = 0

    def flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.texts.append(text)
            self.plain.append(max(0, len(text) - self._linked))
            self.tags.append(max(1, self._seen))
            self.of.append(self._stack[-1][1])
            self.heading.append(any(tag in _HEADINGS for tag, *_ in self._stack[-3:]))
            self._seen = 0
        self._parts.clear()
        self._linked = 0

    def _push(self, tag: str, state: int) -> None:
        element = self._stack[-1][1]
        if tag in _BLOCK:
            self.parent.append(element)
            self.name.append(tag)
            self.first.append(len(self.texts))
            self.end.append(-1)
            element = len(self.name) - 1
        self._stack.append((tag, element, state))
        self._open[tag] = self._open.get(tag, 0) + 1

    def _pop(self, depth: int) -> None:
        while len(self._stack) > depth:
            tag, element, _ = self._stack.pop()
            self._open[tag] -= 1
            if tag in _BLOCK:
                self.end[element] = len(self.texts)

    def _find(self, tag: str, barriers: Collection[str]) -> int | None:
        """Depth of the innermost open ``tag`` above the nearest barrier."""
        if self._open.get(tag):
            for depth in range(len(self._stack) - 1, 0, -1):
                if self._stack[depth][0] == tag:
                    return depth
                if self._stack[depth][0] in barriers:
                    return None
        return None

    def _state(self, tag: str, attrs: list) -> int:
        state = self._stack[-1][2]
        if state == _FORM and tag in _REGIONS:
            state = _OPEN
        if state in (_CLOSED, _FORM):
            return state
        if state == _HEADINGS_ONLY and tag in _HEADINGS:
            return _OPEN
        if tag == "form":
            return _FORM
        if tag in _DROPPED:
            return _CLOSED
        if tag == "header":
            return _HEADINGS_ONLY if any(self._open.get(t) for t in _REGIONS) else _CLOSED
        if tag in ("html", "body", "main"):
            return state
        for key, value in attrs:
            if key == "hidden" or key == "aria-hidden" and value == "true" \
                    or key == "style" and value and "display:none" in value.replace(" ", "").lower() \
                    or key == "role" and value and value.strip().lower() in _ROLES:
                return _CLOSED
            if key in ("class", "id") and value:
                for name in value.split():
                    words = set(_WORD.findall(_CAMEL.sub(" ", name).lower()))
                    if words & (_COMMENTS if tag == "article" else _NOT_CONTENT) and not words & _WRAPPERS:
                        return _CLOSED
        return state

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._seen += 1
        if tag in _BLOCK:
            self.flush()
            if tag == "body":
                self._pop(1)
            at = self._find("p", _BARRIERS)
            if at is None and tag in _CLOSES:
                at = self._find(tag, _CLOSES[tag])
            if at is not None:
                self._pop(at)
        elif tag == "br":
            self._parts.append(" ")
        if tag not in _VOID:
            self._push(tag, self._state(tag, attrs))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)   # "/>" closes nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        self._seen += 1
        if tag in _BLOCK:
            self.flush()
            at = self._find(tag, ()) if tag in _CONTAINERS or tag in _DROPPED else self._find(tag, _BARRIERS)
        elif tag in _DROPPED:
            at = self._find(tag, ())
        else:
            at = None
            if self._open.get(tag):
                for depth in range(len(self._stack) - 1, max(0, len(self._stack) - 1 - INLINE_DEPTH), -1):
                    if self._stack[depth][0] == tag or self._stack[depth][0] in _BLOCK:
                        at = depth if self._stack[depth][0] == tag else None
                        break
        if at is not None:
            self._pop(at)

    def handle_data(self, data: str) -> None:
        if self._stack[-1][2] == _OPEN:
            self._parts.append(data)
            if self._open.get("a"):
                self._linked += len(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)   # "<![...": a comment, as browsers read it

    def finish(self) -> _Lines:
        self.close()
        self.flush()
        self._pop(1)
        self.end[0] = len(self.texts)
        return self


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    kernel = np.exp(-np.arange(-RADIUS, RADIUS + 1) ** 2 / (2 * SIGMA ** 2))
    return np.convolve(np.pad(ratios, RADIUS, mode="edge"), kernel / kernel.sum(), mode="valid")


def _runs(chosen: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], chosen.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _content(page: _Lines) -> np.ndarray:
    """Which lines are content."""
    plain = np.array(page.plain, dtype=np.float64)
    smooth = _smoothed(plain / np.array(page.tags))
    cut = min(smooth.std(), smooth.max())
    above, dense = smooth >= cut, plain / np.array(page.tags) >= cut
    total, held = np.concatenate(([0.0], plain.cumsum())), np.concatenate(([0.0], (plain * above).cumsum()))

    region = [0] * len(page.name)   # the nearest article or main of each element, itself included
    for e in range(1, len(page.name)):
        region[e] = e if page.name[e] in _REGIONS else region[page.parent[e]]

    # A cluster lies within one region and does not begin or end with a line that only its
    # neighbours lift above the cut.
    clusters = []
    inside = np.array([region[e] for e in page.of])
    for a, b in _runs(above):
        ends = [a, *(a + 1 + np.flatnonzero(np.diff(inside[a:b]))).tolist(), b]
        for x, y in pairwise(ends):
            own = np.flatnonzero(dense[x:y]).tolist()
            clusters.append((x + own[0], x + own[-1] + 1) if own else (x, y))

    def weight(run: tuple[int, int]) -> float:
        return (total[run[1]] - total[run[0]]) * (4 if region[page.of[run[0]]] else 1)

    best = max(clusters, key=weight)
    box = page.of[best[0]]
    while box and (page.name[box] not in _CONTAINERS or page.end[box] < best[1]):
        box = page.parent[box]
    box = region[box] or box
    while box and not region[box]:
        up = page.parent[box]
        a, b = page.first[up], page.end[up]
        if page.name[up] in ("body", "html") or 2 * (held[b] - held[a]) < total[b] - total[a]:
            break
        box = up
    kept = np.zeros(len(plain), dtype=bool)
    if box and page.name[box] not in ("body", "html"):
        kept[page.first[box]:page.end[box]] = True
        if region[box]:
            for a, _ in clusters:
                other = region[page.of[a]]
                if other and page.name[other] == "article":
                    kept[page.first[other]:page.end[other]] = True
            return kept
    for a, b in clusters:
        kept[a:b] = True
    for a, b in _runs(~kept):   # short gaps between clusters, headings before one
        if b < len(kept) and (a > 0 and b - a <= RADIUS and (plain[a:b] > 0).all() or page.heading[b - 1]):
            kept[a if b - a <= RADIUS and a > 0 and (plain[a:b] > 0).all() else b - 1:b] = True
    return kept


def main_text(html: str) -> str:
    """The content blocks of a page, one to a line; empty if there are none."""
    page = _Lines()
    page.feed(html)
    page.finish()
    if not page.texts:
        return ""
    return "\n".join(t for t, k in zip(page.texts, _content(page), strict=True) if k)


def extract(html: Column) -> Column:
    """Main text of an HTML column; null, empty and textless pages: the empty text."""

    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "") for p in pages], type=pa.string())

    return texts(html)


def extract_pages(df: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``df`` with the main text of its pages in ``out_col`` (replaced if it exists).

    Each page is read whole and alone, wherever it lies: no shuffle, and repeated rows give
    repeated rows. Null, empty and textless pages have an empty text; broken markup is read
    as far as it goes (unclosed elements end with their parent, stray end tags count for
    nothing). All other columns stay as they are, whatever their names.
    """
    return df.withColumn(out_col, extract(F.col(html_col)))
