"""Main text of web pages by smoothed text-to-tag ratios.

The standard library's parser streams a page's events.  Block-level tags cut
the page into lines; a line has its text and the number of tags met in it, and
its text-to-tag ratio is characters per tag.  Lines inside menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and comment
sections (by element, role, or words of class and id) have ratio 0.  A word of
class or id does not exclude an element that holds most of the page's remaining
text outside links (a wrapper such as ``layout-with-sidebar``; the text inside
``article`` / ``main`` if there is any, and adverts, comments and notices are
never wrappers); where such words leave nothing, elements and roles alone exclude.  The ratios are smoothed
over the page with a Gaussian, and two-means clustering of the smoothed values
gives the threshold above which lines are content.

The clustered lines select the region: the outermost ``article`` / ``main`` around
the deepest container that holds at least four fifths of their text.  All lines of it
outside the excluded parts are the main text, so a short paragraph or a heading
between long ones is kept.

Without ``article`` / ``main`` the clusters alone say where the text begins and ends:
at the first and the last line within the Gaussian's reach of a cluster whose own ratio
is above the threshold and which is neither mostly links nor page furniture by its
wording (copyright, telephone, greeting).  All between is kept.  Outside of it stay,
unless they are links or furniture: what stands between the first heading and the text,
or without a heading the lines before it in the same containers; lines after it in the
same containers; headings right before; ``section`` elements beside one that holds some of it;
and what shares a wrapper named as content with it, if the text is at least four
fifths of that.  Other unmarked headers, footers and teasers go.

The work grows in proportion to a page, however deep its elements are nested.

Cases: null or empty html, or a page without text, gives an empty text; broken
markup is taken as the parser reports it (an end tag without a start is
ignored, an element left open ends with its parent); repeated or null ids give
one row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read_table, small_batches

SIGMA = 1.0
#: Lines to each side that the Gaussian covers.
REACH = int(np.ceil(3 * SIGMA))
#: Share of the clustered text that an article must hold, and of a named wrapper's text that must be the region's.
HELD = 0.8
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Wording of short lines around a text that are the site's, not the article's.
FURNITURE = re.compile(r"^\W*(?:copyright|©|\(c\)|welcome to|subscribe|follow us|contact us|call us|sign (?:in|up)|log ?in|tel(?:ephone)?\b|phone|skip to)|all rights reserved|privacy policy|terms of (?:use|service)", re.I)

BLOCKS = set("""address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td
 textarea tfoot th thead title tr ul""".split())
CONTAINERS = {"article", "main", "section", "div", "td", "body", "center", "blockquote"}
SKIPPED = {"head", "title", "script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "math", "audio", "video",
           "nav", "menu", "footer", "aside", "form", "button", "select", "option", "textarea", "label", "fieldset", "dialog", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
#: Words of class and id values that mark what is not main text.
MARKS = set("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie
 cookies copyright dialog disqus footer gdpr header legal login masthead menu menubar modal nav navbar navigation newsletter
 notice notices notification overlay pager pagination paywall popup promo promoted promotion recommend recommended related
 replies reply search share sharing sidebar sidenav signin signup skip social sponsor sponsored subscribe subscription toolbar
 topbar widget widgets""".split())
#: Those that exclude even most of a page's text: there may be more adverts, comments or notices than article.
SURE = set("""ad ads adv advert adverts advertisement advertising comment comments consent cookie cookies dialog disqus gdpr modal
 newsletter notice notices overlay paywall popup promo promoted promotion recommend recommended related replies reply sponsor
 sponsored subscribe subscription""".split())
#: Words beside which a marker only says what a wrapper has or has not.
MODIFIERS = {"no", "not", "with", "without", "has", "have", "hide", "show", "open", "closed", "enabled", "disabled", "on", "off"}
#: Words that mark a part of the article itself, where a header holds its title.
OWN = {"article", "entry", "post", "content", "story"}
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


KEPT, LIKELY, MARKED, OUT = range(4)  # not excluded, by a word unless it is a wrapper, by a word, by element or role


def _excluded(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    if tag in SKIPPED or (tag == "header" and not in_article):
        return OUT
    if tag in ("html", "body", "main") or not attrs:
        return KEPT
    marked, wraps, sure = False, False, False
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return OUT
        if name == "role" and value and value.lower() in ROLES:
            return OUT
        if name == "style" and value and re.search(r"display\s*:\s*none", value):
            return OUT
        if name in ("class", "id") and value:
            words = {w.lower() for w in _TOKENS.findall(value)}
            marks = words & MARKS
            marked |= bool(marks) and not (marks == {"header"} and (in_article or words & OWN))
            for token in value.split():
                own = {w.lower() for w in _TOKENS.findall(token)}
                wraps |= bool(own & OWN) and not own & MARKS
                sure |= bool(own & SURE) and not own & MODIFIERS
    return KEPT if not marked else MARKED if sure and not wraps else LIKELY


class Box(NamedTuple):
    """A container: its element, the container around it, whether it is in an ``article`` / ``main``, has a content name, its class."""

    tag: str
    up: int
    inside: bool
    own: bool
    cls: str


class Line(NamedTuple):
    """A line: text, tags met in it, what excludes it, its container, characters in links (without white space), whether it is a heading."""

    text: str
    tags: int
    out: int
    box: int
    linked: int
    heading: bool

    @property
    def links(self) -> bool:
        return 2 * self.linked >= sum(map(len, self.text.split()))


class Lines(HTMLParser):
    """Collects a page's lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = []  # element, what excludes it or an element around it, container
        self.places: dict[str, list[int]] = {}  # element -> its places in ``open``
        self.outs: list[tuple[int, int]] = [(KEPT, -1)]  # what excludes -> how, the next one around it
        self.boxes: list[Box] = [Box("html", -1, False, False, "")]
        self.lines: list[Line] = []
        self.words: list[str] = []
        self.tags = 0
        self.linked = 0
        self.link: int | None = None  # open elements around the link that is open

    def _end_line(self) -> None:
        if self.words:
            text = " ".join("".join(self.words).split())
            if text:
                tag, out, box = self.open[-1] if self.open else ("html", 0, 0)
                self.lines.append(Line(text, self.tags, out, box, self.linked, tag in HEADINGS))
                self.tags = 0
            self.words, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.words.append(" ")
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.link = len(self.open)
        _, out, box = self.open[-1] if self.open else ("", 0, 0)
        inside = self.boxes[box].inside
        if self.outs[out][0] != OUT and (how := _excluded(tag, attrs, inside)):
            self._end_line()  # an excluded inline part does not share a line with what is around it
            self.outs.append((how, out))
            out = len(self.outs) - 1
        if tag in CONTAINERS:
            names = [value for name, value in attrs if name in ("class", "id") and value]
            own = any(w.lower() in OWN for value in names for w in _TOKENS.findall(value))
            self.boxes.append(Box(tag, box, inside or tag in ("article", "main"), own, next((v or "" for n, v in attrs if n == "class"), "")))
            box = len(self.boxes) - 1
        if tag in BLOCKS or tag in CONTAINERS or out:
            if tag == "p" and self.open and self.open[-1][0] == "p":
                self._close(len(self.open) - 1)
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append((tag, out, box))

    def _close(self, place: int) -> None:
        """Close the open elements from ``place`` on."""
        while len(self.open) > place:
            self.places[self.open.pop()[0]].pop()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag == "a":
            self.link = None
        if self.places.get(tag):
            place = self.places[tag][-1]
            if self.open[place][1]:
                self._end_line()
            self._close(place)
        if self.link is not None and len(self.open) < self.link:  # a link left open ends with what is around it
            self.link = None

    def handle_data(self, data: str) -> None:
        self.words.append(data)
        if self.link is not None:
            self.linked += sum(map(len, data.split()))

    def done(self) -> list[Line]:
        self.close()
        self._end_line()
        return self.lines


def ratios(lines: list[Line], gone: list[bool]) -> np.ndarray:
    """Characters per tag of each line; 0 for what is excluded."""
    return np.array([0.0 if gone[line.out] else len(line.text) / max(line.tags, 1) for line in lines])


def smoothed(ratio: np.ndarray) -> np.ndarray:
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    return np.convolve(ratio, kernel / kernel.sum())[REACH: REACH + len(ratio)]


def threshold(values: np.ndarray) -> float:
    """Two-means on a line: the middle of the two centres (0 if all values are equal)."""
    low, high = float(values.min()), float(values.max())
    if high <= low:
        return 0.0
    for _ in range(50):
        cut = (low + high) / 2
        above = values > cut
        new = float(values[~above].mean()), float(values[above].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def exclusions(page: Lines) -> list[bool]:
    """For each of ``page.outs`` whether it, or one around it, excludes its lines."""
    outs = page.outs
    sure = [False] * len(outs)
    for k, (how, up) in enumerate(outs):  # one's number is larger than that of those around it
        sure[k] = how >= MARKED or k > 0 and sure[up]
    plain = [(line.out, sum(map(len, line.text.split())) - line.linked, page.boxes[line.box].inside) for line in page.lines if not sure[line.out]]
    article = any(n and inside for _, n, inside in plain)
    held = [0] * len(outs)
    for k, n, inside in plain:
        if inside or not article:
            held[k] += n
    for k in range(len(outs) - 1, 0, -1):
        held[outs[k][1]] += held[k]
    gone = [False] * len(outs)
    for k, (how, up) in enumerate(outs):
        gone[k] = k > 0 and (gone[up] or how >= MARKED or 2 * held[k] <= held[0])
    return gone


def _held(boxes: list[Box], lines: list[Line], chosen: Iterator[bool] | np.ndarray | list[bool]) -> list[int]:
    """Characters of the chosen lines in each container; a container's number is larger than its parent's."""
    held = [0] * len(boxes)
    for line, yes in zip(lines, chosen):
        if yes:
            held[line.box] += len(line.text)
    for k in range(len(boxes) - 1, 0, -1):
        held[boxes[k].up] += held[k]
    return held


def _deepest(boxes: list[Box], held: list[int], need: float) -> int:
    return max(k for k, h in enumerate(held) if h >= need and (k == 0 or held[boxes[k].up] >= need))


def _around(boxes: list[Box], box: int) -> Iterator[int]:
    while box >= 0:
        yield box
        box = boxes[box].up


def _within(boxes: list[Box], region: int) -> list[bool]:
    """For each container whether it is the region or in it."""
    inside = [False] * len(boxes)
    for k, box in enumerate(boxes):
        inside[k] = k == region or (k > 0 and inside[box.up])
    return inside


def _clustered_part(boxes: list[Box], lines: list[Line], usable: list[bool], edges: list[int]) -> list[bool]:
    """Without ``article`` / ``main``: which usable lines belong to the text whose certain lines are ``edges``."""
    first, last = edges[0], edges[-1]
    certain = [False] * len(lines)
    for k in edges:
        certain[k] = True
    held = _held(boxes, lines, certain)
    region = _deepest(boxes, held, held[0])
    text = _held(boxes, lines, usable)
    named = [k for k in _around(boxes, region) if boxes[k].own and held[k] >= HELD * text[k]]
    wrapped = _within(boxes, named[-1]) if named else [False] * len(boxes)
    inner = _within(boxes, region)
    before, after = ({k for k in _around(boxes, lines[edge].box) if inner[k]} for edge in (first, last))
    sections = {(boxes[k].up, boxes[k].cls) for k in range(len(boxes)) if held[k] and boxes[k].tag == "section"}
    beside = [False] * len(boxes)
    for k, box in enumerate(boxes):
        beside[k] = (box.tag == "section" and (box.up, box.cls) in sections) or (k > 0 and beside[box.up])
    usual = [yes and not line.links and not FURNITURE.search(line.text) for line, yes in zip(lines, usable)]
    title = next((k for k in range(first) if usual[k] and lines[k].heading and lines[k].box in before), None)

    def kept(k: int) -> bool:
        box = lines[k].box
        if not usable[k] or first <= k <= last or wrapped[box]:
            return usable[k]
        lead = k < first and (box in before if title is None else inner[box] and k >= title)
        return usual[k] and (beside[box] or lead or (k > last and box in after))

    keep = [kept(k) for k in range(len(lines))]
    top = keep.index(True)
    if not lines[top].heading:
        for k in range(top - 1, -1, -1):
            if not (usual[k] and lines[k].heading):
                break
            keep[k] = True
    return keep


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    lines, boxes = page.done(), page.boxes
    if not lines:
        return ""
    gone = exclusions(page)
    if all(gone[line.out] for line in lines):
        gone = [how == OUT for how, _ in page.outs]
    usable = [not gone[line.out] for line in lines]
    ratio = ratios(lines, gone)
    if not ratio.any():
        return ""
    smooth = smoothed(ratio)
    cut = threshold(smooth) if smooth.max() > smooth.min() else 0.0
    content = (smooth > cut) & (ratio > 0)
    held = _held(boxes, lines, content)
    article = [k for k in _around(boxes, _deepest(boxes, held, HELD * held[0])) if boxes[k].tag in ("article", "main")]
    if article:
        inside = _within(boxes, article[-1])
        keep = [yes and inside[line.box] for line, yes in zip(lines, usable)]
    else:
        near = np.convolve(content, np.ones(2 * REACH + 1), "same")[:len(lines)] > 0 if len(lines) > 2 * REACH else np.ones(len(lines), bool)
        edges = [int(k) for k in np.flatnonzero(near & (ratio > cut))]
        edges = [k for k in edges if not lines[k].links and not FURNITURE.search(lines[k].text)] or edges
        keep = _clustered_part(boxes, lines, usable, edges)
    return "\n".join(line.text for line, yes in zip(lines, keep) if yes)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars``, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            text = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()), pa.array(text, pa.string()),
                                              pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_text_tag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
