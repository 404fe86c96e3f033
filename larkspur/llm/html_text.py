"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing and clustering.

The standard library's parser streams events; block elements cut the page into lines.  Each line has
the ratio of its text to its tags.  The ratios are smoothed with a Gaussian and set against the
page's mean, which gives each line a density of 0 to 1.  Element and class names add to it or take away
from it, and links take away from it.  A frame element or a name of its kind takes more away than a
density can give, so such lines are left out whatever their text, unless every line of the page is one; among
all other lines the densities decide.  Lines at or above the threshold form the content clusters: the element whose lines gain most over the threshold, by length, is the content
region.  Its lines are the text, but for those that names and density together put below the
threshold (menus, forms, notices, adverts, comments and the like).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("head script style noscript template title iframe svg canvas object audio video math".split())
ASIDE = frozenset("nav footer aside form button select option textarea menu dialog input label fieldset".split())
REGION = frozenset("article main section div td body blockquote center table".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
_SCOPES = REGION | {"ul", "ol", "dl"}
_CLOSES = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
#: Words of class and id attributes that speak against a line.
MARKS = frozenset(
    "ad ads adbox adslot advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup sidebar sidebars widget widgets menu nav navbar navigation breadcrumb breadcrumbs "
    "share sharing social related recommended comment comments reply replies respond discussion disqus footer masthead toolbar pagination pager login search".split()
)
#: Words that name a place in the layout: a name made of marks and these is a mark as a whole.
LAYOUT = frozenset(
    "area bar block body bottom box btn button buttons card col column container content count entry feed field form global group header holder icon icons "
    "inner input item items js layer left link links list main outer page panel pane post posts primary right row secondary section site slot stories "
    "tab text thread title toggle top ul unit view wrap wrapper message dialog".split()
)
#: A name like has-sidebar or comments-open tells a state of what holds the article.
_STATES = frozenset("with has no without is not enabled disabled on off open closed free".split())
#: What evidence adds to a line's density: a mark or an element of the page's frame, a name of which only
#: a part is a mark, an article, its outside, and a line of links alone.
FRAME, PARTLY, ARTICLE, OUTSIDE, LINKS = -1.0, -0.1, 0.6, -0.6, -0.6
#: Lines count as content from this density on, with what the evidence adds: half the page's mean ratio.
THRESHOLD = 1 / 3
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[^a-z0-9]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Line:
    """A line's text, its tags and its characters in links; evidence, innermost region, whether in an article."""

    text: str
    tags: int
    linked: int
    evidence: float
    region: int
    inside: bool


@dataclass
class _Open:
    """An open element: what holds for the text directly in it."""

    tag: str
    evidence: float = 0.0
    region: int = 0
    hidden: bool = False
    inside: bool = False
    linked: bool = False


def name_evidence(tag: str, attrs: dict[str, str | None]) -> float:
    """What an element's class, id, role and visibility say about the text in it."""
    if not attrs or tag in ("html", "body", "main"):
        return 0.0
    style = (attrs.get("style") or "").replace(" ", "").lower()
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
    if hidden or (attrs.get("role") or "").lower() in ROLES:
        return FRAME
    found = 0.0
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        parts = [w for w in _WORDS.split(_HUMP.sub("-", name).lower()) if w]
        if not parts or parts[0] in _STATES or parts[-1] in _STATES:
            continue
        marks = sum(w in MARKS for w in parts)
        if marks and all(w in MARKS or w in LAYOUT or w.isdigit() for w in parts):
            return FRAME
        if marks:
            found = PARTLY
    return found


class _Lines(HTMLParser):
    """Collects the page's lines and regions; all work per event is constant, however deep the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Open("")]
        self.lines: list[Line] = []
        self.kinds, self.parents, self.depth = [""], [0], [0.0]  # of regions: tag, parent, evidence
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.scopes: list[dict[str, int]] = [{}]  # open elements since the last region or list
        self.articles: list[dict[str, int]] = [{}]  # open elements since the last article, main or body
        self.open: dict[str, int] = {}  # open elements

    def cut(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            top = self.stack[-1]
            self.lines.append(Line(text, self.tags, self.linked, top.evidence, top.region, top.inside))
            self.tags = 0
        self.text.clear()
        self.linked = 0

    def _push(self, own: _Open) -> None:
        for counts in (self.open, self.scopes[-1], self.articles[-1]):
            counts[own.tag] = counts.get(own.tag, 0) + 1
        if own.tag in _SCOPES:
            self.scopes.append({})
        if own.tag in ("article", "main", "body"):
            self.articles.append({})
        self.stack.append(own)

    def _pop(self) -> str:
        own = self.stack.pop()
        if own.tag in ("article", "main", "body"):
            self.articles.pop()
        if own.tag in _SCOPES:
            self.scopes.pop()
        for counts in (self.open, self.scopes[-1], self.articles[-1]):
            counts[own.tag] -= 1
        return own.tag

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.cut()
        self.tags += 1
        if tag in VOID:
            return
        if tag == "body":  # an unclosed head ends here
            while len(self.stack) > 1 and self.stack[-1].tag != "html":
                self._pop()
        elif closes := _CLOSES.get(tag):
            if any(self.scopes[-1].get(t) for t in closes):
                while self._pop() not in closes:
                    pass
        self._push(self._opened(tag, dict(attrs)))

    def _opened(self, tag: str, attrs: dict[str, str | None]) -> _Open:
        top = self.stack[-1]
        own = name_evidence(tag, attrs)
        if tag in ASIDE or tag == "header" and not top.inside:
            own = FRAME
        inside = top.inside
        if tag in ("article", "main") and own > FRAME:
            inside, evidence = True, max(own + ARTICLE + min(top.evidence, 0.0) / 4, top.evidence)
        elif own == FRAME:
            evidence = own + min(top.evidence, max(top.evidence, 0.0) / 4)
        else:
            evidence = top.evidence + own
        region = top.region
        if tag in REGION:
            region = len(self.kinds)
            self.kinds.append(tag)
            self.parents.append(top.region)
            self.depth.append(evidence)
        return _Open(tag, max(evidence, 2 * FRAME), region, top.hidden or tag in HIDDEN, inside, top.linked or tag == "a")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.cut()
        self.tags += 1
        ends_all = tag in ("html", "body", "main", "article")  # these end whatever is open in them
        counts = self.open if ends_all else self.articles[-1]
        if not counts.get(tag):
            return
        while self._pop() != tag:
            pass

    def handle_data(self, data):
        top = self.stack[-1]
        if not top.hidden:
            self.text.append(data)
            if top.linked:
                self.linked += len(data)


def smoothed(values: list[float], sigma: float = 1.0) -> list[float]:
    reach = max(1, round(2 * sigma))
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        part = [(weights[k + reach], values[i + k]) for k in range(-reach, reach + 1) if 0 <= i + k < len(values)]
        out.append(sum(w * v for w, v in part) / sum(w for w, _ in part))
    return out


def ratio(line: Line) -> float:
    """Characters of a line's text for each of its tags."""
    return len(line.text) / max(1, line.tags)


def densities(lines: list[Line]) -> list[float]:
    """0 to 1: the smoothed ratio of each line against the mean of the lines that no name speaks against."""
    ratios = smoothed([ratio(x) for x in lines])
    plain = [r for r, x in zip(ratios, lines) if x.evidence > FRAME / 2] or ratios
    mean = max(sum(plain) / max(1, len(plain)), 1e-9)
    return [r / (r + mean) for r in ratios]


def left_out(line: Line, score: float) -> bool:
    return score < THRESHOLD and line.evidence <= FRAME / 2


def content_region(lines: list[Line], scores: list[float], kinds: list[str], parents: list[int]) -> list[bool]:
    """Whether each region is the content region or in it.

    The region is the one with the largest gain over the threshold, then its ancestors as long as they
    add no line that anything speaks against.
    """
    articles = any(x.inside for x in lines)
    gain, against, kept = [0.0] * len(kinds), [0] * len(kinds), [0] * len(kinds)
    for x, score in zip(lines, scores):
        if not left_out(x, score):  # what is left out anyway does not count
            kept[x.region] += 1
            links = LINKS * min(1.0, x.linked / len(x.text))
            gain[x.region] += len(x.text) * (score + links + (OUTSIDE if articles and not x.inside else 0.0) - THRESHOLD)
        against[x.region] += x.evidence < 0 or 2 * x.linked > len(x.text)
    for r in range(len(kinds) - 1, 0, -1):  # a region comes after what holds it
        gain[parents[r]] += gain[r]
        against[parents[r]] += against[r]
        kept[parents[r]] += kept[r]
    best = max(range(len(kinds)), key=lambda r: (kept[r] > 0, gain[r], r))
    while best and kinds[best] not in ("article", "main") and against[parents[best]] == against[best]:
        best = parents[best]
    held = [False] * len(kinds)
    for r in range(len(kinds)):
        held[r] = r == best or r > 0 and held[parents[r]]
    return held


def main_text(html: str | None) -> str:
    """The article's lines joined by newlines; empty for null, empty and text-free pages."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.cut()
    scores = [d + x.evidence for d, x in zip(densities(page.lines), page.lines)]
    held = content_region(page.lines, scores, page.kinds, page.parents)
    kept = [x.text for x, score in zip(page.lines, scores) if held[x.region] and not left_out(x, score)]
    return "\n".join(kept or by_density(page.lines))


def by_density(lines: list[Line]) -> list[str]:
    """The text of a page on which names speak against every line, so that they tell nothing apart: the lines at
    or above the threshold by density alone that are not mostly links, if they hold most of the page's text."""
    dense = [x.text for x, d in zip(lines, densities(lines)) if d >= THRESHOLD and 2 * x.linked <= len(x.text)]
    return dense if 2 * sum(map(len, dense)) > sum(len(x.text) for x in lines) else []


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The kept columns, text and n_chars of each page; a null or empty page gives an empty text.

    A page that the parser cannot read to the end gives the text read so far.  Pages are
    independent: repeated rows and null ids stay.
    """
    kept = [c for c in keep if c not in ("text", "n_chars")]
    rows = pages.select(*kept, F.col(html_col).alias("__html"))
    schema = StructType([f for f in rows.schema.fields if f.name != "__html"]).add("text", StringType()).add("n_chars", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)
