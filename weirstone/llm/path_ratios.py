"""Main text of html pages by ratios of their tag paths."""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Batches, slices, tidy

# Elements that end a block of text, that have no content, whose content is no page text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul br option".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg object math select button".split())
# Elements that never hold an article, that mostly hold none, and words in class, id or role that say so.
NEVER = frozenset("head title".split())
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright discussion disqus footer form login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification pagination popup promo promoted recommended related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget alert complementary contentinfo "
    "dialog".split()
)
# Words that say so also as a part of a name (comment-list, CommentThread), inside the article too.
STRONG = frozenset(
    "advert advertisement breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer login "
    "masthead menu nav navbar navigation newsletter pagination popup promo recommended related replies reply respond "
    "responses share sharing sidebar signup sponsor sponsored subscribe".split()
)
# An element that holds more of the page's text than this is no aside, whatever it is called.
MOST = 0.8
# A header is the page's, unless it stands in the article.
HEADERS = frozenset(("header",))
MAIN = frozenset(("article", "main"))
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>?|([^<]+)|<", re.S
)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TAG = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SIGNS = re.compile(r"[.,;:!?…。、，！？；：]")


class _Element:
    """An open or closed element: the number of its path, its parents, how its tag and names speak against it.

    ``own`` is 3 for no page text, 2 for a tag or a name of the lists, 1 for a
    name with a part of the lists that may mean something else; ``aside`` and
    ``doubted`` follow from it when the page is known. ``block`` is the
    innermost block it is in, itself included.
    """

    __slots__ = ("tag", "path", "parent", "depth", "own", "aside", "doubted", "main", "chars", "block")

    def __init__(self, tag: str, parent: _Element | None, attributes: str, paths: dict[tuple[int, str], int]) -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.main = tag in MAIN or (parent is not None and parent.main)
        self.aside = self.doubted = False
        self.chars = 0
        self.block = self if parent is None or tag in BLOCKS else parent.block
        names: set[str] = set()
        if attributes:
            for values in _ATTRIBUTE.findall(attributes):
                names.update("".join(values).split())
        words = {w.lower() for name in names for w in _WORD.findall(name)}
        hints = HINTS if self.main else HINTS | HEADERS
        self.own = 0
        if tag in NEVER or tag in RAW:
            self.own = 3
        elif tag in ASIDE or (tag in HEADERS and not self.main):
            self.own = 2
        elif words and tag not in MAIN and tag not in ("html", "body"):
            if not STRONG.isdisjoint(words) or not hints.isdisjoint(n.lower() for n in names):
                self.own = 2
            elif not hints.isdisjoint(words):
                self.own = 1
        label = ".".join((tag, *sorted(words))) if words else tag
        self.path = paths.setdefault((parent.path if parent else -1, label), len(paths))


def _judge(texts: list[tuple[_Element, str]], elements: list[_Element]) -> None:
    """Which elements are aside or doubted, from parents to children.

    None is that is around the longest article or main element, nor one that
    holds over MOST of the page's text, unless an article or main stands elsewhere.
    """
    for element, text in texts:
        element.chars += len(text.strip())
    never: set[int] = set()
    for element in elements:
        if element.own == 3 or id(element.parent) in never:
            never.add(id(element))
            element.chars = 0
    for element in reversed(elements[1:]):
        element.parent.chars += element.chars
    total = elements[0].chars
    longest = max((e for e in elements if e.tag in MAIN and e.chars), key=lambda e: e.chars, default=None)
    around: set[int] = set()
    seek = longest
    while seek:
        around.add(id(seek))
        seek = seek.parent
    for element in elements[1:]:
        most = element.chars > MOST * total and (longest is None or element.main)
        spared = element.own < 3 and (id(element) in around or most)
        element.aside = element.parent.aside or (element.own >= 2 and not spared)
        element.doubted = element.parent.doubted or (element.own == 1 and not spared)


def _texts(page: str) -> tuple[list[tuple[_Element, str]], list[_Element]]:
    """Runs of text with their innermost element, judged, and all elements, parents first.

    A text of a line end alone marks the edge of a block. Every element is
    opened and closed once and every path is a number, so time and memory grow
    with the page only, however deep it is.
    """
    paths: dict[tuple[int, str], int] = {}
    root = here = _Element("", None, "", paths)
    elements = [root]
    open_tags: Counter = Counter()
    out: list[tuple[_Element, str]] = []
    at, raw = 0, None
    while at < len(page):
        if raw:  # up to the end tag, whatever looks like one of another kind
            end = re.compile(rf"</{raw}\s*>?", re.I).search(page, at)
            open_tags[here.tag] -= 1
            at, raw, here = (end.end() if end else len(page)), None, here.parent
            continue
        token = _TOKEN.match(page, at)
        at = token.end()
        closing, tag, attributes, text = token.groups()
        if text is None and tag is None:
            if token.group() == "<":  # an open quote may hide a tag's end, or a page breaks off in a tag
                end = page.find(">", at)
                name = _TAG.match(page, at)
                if name and end < 0:
                    break
                if name:
                    tag, attributes, at, closing = name.group(), "", end + 1, ""
                else:
                    text = "<"
            if text is None and tag is None:
                continue
        if text is not None:
            out.append((here, text))
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            out.append((here, "\n"))
        if closing:
            if open_tags[tag]:  # else it closes nothing
                while here.tag != tag:
                    open_tags[here.tag] -= 1
                    here = here.parent
                open_tags[tag] -= 1
                here = here.parent
            continue
        if tag in EMPTY:
            continue
        if tag in BLOCKS:  # a block ends an open paragraph, an item the item before it
            seek = here.block
            if seek is not root and (seek.tag == "p" or (seek.tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"))):
                while here is not seek.parent:
                    open_tags[here.tag] -= 1
                    here = here.parent
        if attributes.endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        here = _Element(tag, here, attributes, paths)
        open_tags[tag] += 1
        elements.append(here)
        if tag in RAW:
            raw = tag
    _judge(out, elements)
    return out, elements


def _content_paths(nodes: list[tuple[_Element, str]]) -> set[int]:
    """Paths whose smoothed ratio of text and punctuation to nodes stands out on the page."""
    order: dict[int, int] = {}
    for element, _ in nodes:
        order.setdefault(element.path, len(order))
    count, chars, signs = (np.zeros(len(order)) for _ in range(3))
    for element, text in nodes:
        n = order[element.path]
        count[n] += 1
        chars[n] += len(text)
        signs[n] += len(_SIGNS.findall(text))

    def smooth(values: np.ndarray) -> np.ndarray:
        padded = np.r_[values[:1], values, values[-1:]]
        return 0.25 * padded[:-2] + 0.5 * padded[1:-1] + 0.25 * padded[2:]

    fused = smooth(chars / count) * (1 + smooth(signs / count))
    least = min(fused.std(), fused.max() / 2)
    return {path for path, n in order.items() if fused[n] >= least}


def main_text(page: str | None) -> str:
    """The article of a page: blocks joined by a space, white space inside as one space.

    Texts of menus, forms and the like are left out by their elements, but not
    where these hold the article or most of the text. Of the rest, tag paths
    are scored by how much text and punctuation they hold for each node; the
    content is what stands below the innermost element that holds all nodes
    of the chosen paths, or below the article around it. In elements whose
    names have only a part of the lists (``right-sidebar``) just the nodes of
    chosen paths stay.
    """
    if not page:
        return ""
    texts, elements = _texts(page)
    nodes = [(e, t) for e, t in texts if not e.aside and t.strip()]
    if not nodes:
        return ""
    chosen = _content_paths(nodes)
    sure = any(e.path in chosen and not e.doubted for e, _ in nodes)
    holds = Counter(id(e) for e, _ in nodes if e.path in chosen and not (sure and e.doubted))
    total = sum(holds.values())
    for element in reversed(elements[1:]):
        holds[id(element.parent)] += holds[id(element)]
    top = max((e for e in elements if holds[id(e)] == total), key=lambda e: e.depth)
    while top.parent and (top.tag in LEAVES or top.tag not in BLOCKS):
        top = top.parent
    around = top
    while around.parent and around.tag not in MAIN:
        around = around.parent
    if around.tag in MAIN:
        top = around
    inside: set[int] = set()
    for element in elements:
        if element is top or id(element.parent) in inside:
            inside.add(id(element))
    kept = "".join(t for e, t in texts if t == "\n" or (not e.aside and (not e.doubted or e.path in chosen) and id(e) in inside))
    return " ".join(html.unescape(kept).split())


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (empty if none), n_chars.

    Only page_id, url and html are read. Null, empty and broken pages give
    what text they have; long pages are read whole; repeated rows give
    repeated results; an empty table gives an empty result.
    """

    @tidy
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, 2, 256, 1 << 22):
                texts = [main_text(h.as_py()) for h in part.column(2)]
                lengths = pa.array([len(t) for t in texts], pa.int64())
                arrays = [part.column(0), part.column(1), pa.array(texts, pa.string()), lengths]
                yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
