"""Main text of web pages by tag-path ratios.

A page is read once from left to right into blocks: stretches of text that no block
element interrupts, each under the path of block elements from the root. Furniture that
the markup itself names (menus, page headers, footers, sidebars, notices, adverts, forms,
reader comments, scripts) is left out. Of what remains, every tag path gets two ratios:
characters outside links, and punctuation marks, each per block of the path. Both, laid
along the blocks in page order, are smoothed with a Gaussian kernel and fused; a path
whose blocks score at least the standard deviation of all is a content path. Its blocks
are content nodes. They decide which element holds the article: a declared one (article,
main) that holds content nodes, else the innermost container with most of their
text. From that element come all blocks if it was declared; otherwise its content nodes
with what stands between them (headings, short paragraphs, lists) and the headings
right before.

Character references are decoded; white space in a block (a line break too) becomes one
space; blocks are joined by line feeds in page order. Markup may be broken: end tags may
be missing, wrong or out of order, comments and quotes unclosed, the page cut off.

NULL and empty pages, and pages without text, give an empty text. Repeated rows give
repeated rows, an empty table none. Of equally rich elements the first in the page is taken.
A page is worked on by itself and whole, in time and memory in proportion to its length,
however deep its elements are nested. Columns other than `keep` and the text play no part.
"""

from __future__ import annotations

import re
from html import unescape
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts

# Elements of HTML by what they do to the text around them.
VOID = set("area base basefont bgsound br col command embed frame hr img input keygen link meta param source track wbr".split())
# Their content is no markup.
RAW = set("script style title textarea iframe xmp noembed noframes plaintext".split())
# Their content is no text of the page, whatever stands in it.
SILENT = set("noscript template object canvas audio video svg select datalist button map applet".split()) | RAW
INLINE = set(
    "a abbr acronym b bdi bdo big blink cite code data del dfn em font i img ins kbd label mark math nobr output picture q rb rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# An open paragraph ends where one of these begins.
ENDS_PARAGRAPH = HEADINGS | set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form header hgroup "
    "hr li main menu nav ol p pre section summary table ul".split()
)
# An open element of the first kind ends where one of the second begins, up to a boundary.
ENDS_ITS_LIKE = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
TABLE = set("table caption tbody thead tfoot tr td th".split())
# End tags don't close elements beyond these.
SCOPES = set("table td th caption".split())

# Regions that hold the main text: an article stands before the region around it.
DECLARED = {"article": 1, "main": 2}

# Names by which pages mark what is not their article.
FURNITURE = {"nav", "aside", "footer", "form", "fieldset", "dialog", "menu"}
FURNITURE_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tooltip".split()
)
FURNITURE_WORDS = set(
    "ad ads adsense adslot advert adverts advertisement advertisements advertising alert aside banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies copyright discussion disqus footer form gdpr header login masthead menu menubar modal "
    "nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion "
    "recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar trending widget widgets".split()
)
# Words that begin so mean the same, with these exceptions: "commentlist", "cookiebar".
FURNITURE_BEGINNINGS = ("advert", "adsby", "breadcrumb", "comment", "cookie", "footer", "masthead", "navbar", "newsletter", "sidebar", "sponsor")
NO_FURNITURE = {"commentary", "commentaries", "commentator", "commentators"}
# Inside an article a header is the article's own.
HEADERS = {"header", "masthead"}
# Before such a word in a name, furniture is talked of, not meant.
ABOUT = {"has", "with", "no", "without", "is", "not"}
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？．｡‚„؟،؛।]")

_MARKUP = re.compile(
    r"""<(?:
      !--(?:-?>|.*?(?:--!?>|\Z))
    | [!?][^>]*+(?:>|\Z)
    | /(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)
    | /[^a-zA-Z][^>]*+(?:>|\Z)
    | (?P<start>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)(?:>|\Z)
    )""",
    re.S | re.X,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_TELLING = re.compile(r"class|id|role|style|itemprop|hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def marked_as_furniture(names: str, in_article: bool = False) -> bool:
    """Whether class names or an id call an element furniture: "site-menu", "topNav"."""

    def tells(word: str) -> bool:
        if in_article and word in HEADERS or word in NO_FURNITURE:
            return False
        return word in FURNITURE_WORDS or word.startswith(FURNITURE_BEGINNINGS)

    for name in names.split():
        words = [w.lower() for w in _WORD.findall(name)]
        if any(tells(w) and (i == 0 or words[i - 1] not in ABOUT) for i, w in enumerate(words)):
            return True
    return False


def _is_block(name: str) -> bool:
    return name == "hr" or not (name in INLINE or name in VOID or name in SILENT or "-" in name)


class _Page:
    """The blocks of a page and the tree of its block elements."""

    def __init__(self, html: str):
        # Of block elements, by number: the root is 0.
        self.tag, self.parent, self.path = ["#"], [0], [0]
        self.declared, self.furniture = [0], [False]
        self.spared = set()  # elements that a headline proves to be no furniture
        # Of blocks: their text, element, characters outside links, marks, characters.
        self.texts: list[str] = []
        self.elements: list[int] = []
        self.plain: list[int] = []
        self.marks: list[int] = []
        self._paths: dict[tuple[int, str], int] = {}
        # Open elements (name, number of the block element, silent, link); None: closed already.
        self._open: list = []
        self._where: dict[str, list[int]] = {}
        self._scopes: list[int] = []
        self._element, self._silent, self._links = 0, 0, 0
        self._pieces: list[str] = []
        self._linked: list[str] = []
        self._read(html)
        self._end_block()

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            mark = _MARKUP.search(html, at)
            if mark is None:
                self._text(html[at:])
                return
            if mark.start() > at:
                self._text(html[at : mark.start()])
            at = mark.end()
            if mark["start"]:
                name = mark["start"].lower()
                self._start(name, mark["more"])
                if name in RAW:
                    end = _RAW_END[name].search(html, at)
                    at = n if end is None else end.start()
            elif mark["end"]:
                self._end(mark["end"].lower())

    def _text(self, text: str) -> None:
        if not self._silent:
            text = unescape(text) if "&" in text else text
            (self._linked if self._links else self._pieces).append(text)
            if self._links:
                self._pieces.append(text)

    def _end_block(self) -> None:
        if not self._pieces:
            return
        text = " ".join("".join(self._pieces).split())
        if text:
            linked = "".join("".join(self._linked).split())
            plain = len(text) - text.count(" ") - len(linked)
            self.texts.append(text)
            self.elements.append(self._element)
            self.plain.append(max(plain, 0))
            self.marks.append(len(PUNCTUATION.findall(text)) if plain > 0 else 0)
        self._pieces, self._linked = [], []

    def _start(self, name: str, more: str) -> None:
        if name == "br":
            self._pieces.append(" ")
        if name in ENDS_PARAGRAPH:
            self._close_open({"p"}, SCOPES)
            if name in HEADINGS:
                self._close_open(HEADINGS, None)
        if name in ENDS_ITS_LIKE:
            self._close_open(*ENDS_ITS_LIKE[name])
        if name == "a" and self._where.get("a"):
            self._end("a")
        block = _is_block(name)
        if block:
            self._end_block()
        if name in VOID or (more.endswith("/") and self._where.get("svg")):
            return
        in_article = bool(self._where.get("article") or self._where.get("main"))
        silent, furniture = name in SILENT, name in FURNITURE or (name == "header" and not in_article)
        declared = DECLARED.get(name, 0)
        if more and name not in ("html", "body") and _TELLING.search(more):
            for key, value in _ATTRIBUTE.findall(more):
                key, value = key.lower(), unescape(value.strip("\"'"))
                if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _UNSEEN.search(value)):
                    silent = True
                elif key == "role":
                    furniture |= value.lower() in FURNITURE_ROLES
                    declared = declared or DECLARED.get(value.lower(), 0)
                elif key == "itemprop" and value == "articleBody":
                    declared = DECLARED["article"]
                elif key in ("class", "id") and name != "main":
                    furniture |= marked_as_furniture(value, in_article)
        if not block and furniture:
            silent = True
        before = self._element
        if block:
            if name == "h1":
                self._spare(before)
            path = self._paths.setdefault((self.path[before], name), len(self._paths) + 1)
            self._element = len(self.tag)
            self.tag.append(name)
            self.parent.append(before)
            self.path.append(path)
            self.declared.append(declared)
            self.furniture.append(furniture)
        link = name == "a"
        self._silent += silent
        self._links += link
        self._where.setdefault(name, []).append(len(self._open))
        if name in SCOPES:
            self._scopes.append(len(self._open))
        self._open.append((name, before, block, silent, link))

    def _spare(self, element: int) -> None:
        """A form or a named box around the headline isn't furniture."""
        while element and element not in self.spared:
            self.spared.add(element)
            element = self.parent[element]

    def _close_open(self, names: set[str], boundary: set[str] | None) -> None:
        """Ends the outermost open element of these names that no boundary shields."""
        places = [self._where[n][-1] for n in names if self._where.get(n)]
        if not places:
            return
        if boundary is None:
            if max(places) == len(self._open) - 1:
                self._close_to(max(places))
            return
        shield = max((self._where[n][-1] for n in boundary if self._where.get(n)), default=-1)
        inside = [p for p in places if p > shield]
        if inside:
            self._close_to(min(inside))

    def _end(self, name: str) -> None:
        places = self._where.get(name)
        if not places:
            if name == "p":
                self._end_block()
            elif name == "br":
                self._pieces.append(" ")
            return
        place = places[-1]
        if name not in TABLE and self._scopes and place < self._scopes[-1]:
            return
        if not _is_block(name):
            # Blocks that were opened inside stay open.
            self._close(place, False)
            while self._open and self._open[-1] is None:
                self._open.pop()
        else:
            self._close_to(place)

    def _close_to(self, place: int) -> None:
        self._end_block()
        while len(self._open) > place:
            if self._open[-1] is not None:
                self._close(len(self._open) - 1, True)
            self._open.pop()

    def _close(self, place: int, last: bool) -> None:
        name, before, block, silent, link = self._open[place]
        self._where[name].pop()
        if self._scopes and self._scopes[-1] == place:
            self._scopes.pop()
        self._silent -= silent
        self._links -= link
        if block:
            self._element = before
        if not last:
            self._open[place] = None


def path_scores(paths: np.ndarray, plain: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, float]:
    """The fused score of each block's path, and the threshold that content paths reach."""
    _, path, blocks = np.unique(paths, return_inverse=True, return_counts=True)
    characters = (np.bincount(path, plain) / blocks)[path]
    punctuation = (np.bincount(path, marks) / blocks)[path]
    fused = smooth(characters) * (1 + smooth(punctuation))
    by_path = (np.bincount(path, fused) / blocks)[path]
    return by_path, float(min(fused.std(), by_path.max()))


def smooth(series: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over two neighbours on each side; the ends are weighed anew."""
    kernel = np.exp(-np.arange(-2, 3) ** 2 / 2.0)
    return np.convolve(series, kernel)[2:-2] / np.convolve(np.ones(len(series)), kernel)[2:-2]


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    if not html:
        return ""
    page = _Page(html)
    furniture = np.array(page.furniture)
    for element in page.spared:
        if page.tag[element] not in ("nav", "aside", "footer", "header"):
            furniture[element] = False
    # Parents have lower numbers than their children. Each element's innermost declared
    # region, and the outermost article around it.
    outside, home, article = furniture.tolist(), [0] * len(furniture), [0] * len(furniture)
    for element in range(1, len(outside)):
        above, kind = page.parent[element], page.declared[element]
        outside[element] |= outside[above]
        home[element] = element if kind and not outside[element] else home[above]
        article[element] = article[above] or (element if kind == 1 and not outside[element] else 0)
    seen = [not outside[e] and page.tag[e] != "head" for e in page.elements]
    texts = list(compress(page.texts, seen))
    if not texts:
        return ""
    elements = np.array(list(compress(page.elements, seen)))
    plain = np.array(list(compress(page.plain, seen)), float)
    marks = np.array(list(compress(page.marks, seen)), float)
    score, least = path_scores(np.array(page.path)[elements], plain, marks)
    content = (score >= least) & (score > 0) & (plain > 0)
    weight = np.where(content, plain, 0.0)
    articles, homes = np.array(article)[elements], np.array(home)[elements]
    regions = articles if articles.any() else homes
    if regions.any():
        return "\n".join(compress(texts, _declared(regions, weight, plain)))
    if not content.any():
        return ""
    return "\n".join(compress(texts, _enclosed(page, elements, content, weight, plain, texts)))


def _declared(regions: np.ndarray, weight: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """The blocks of the declared regions that hold most of the content. A region that is
    far poorer than the richest is a teaser."""
    total = np.bincount(regions, weight if weight[regions > 0].any() else plain)
    return (regions > 0) & (total[regions] >= total[1:].max() / 5)


def _enclosed(page, elements, content, weight, plain, texts) -> np.ndarray:
    """Content nodes of the richest container, what they enclose, and headings before."""
    n = len(page.tag)
    mass = np.bincount(elements, weight, n).tolist()
    holds, inner = [False] * n, [False] * n  # text itself; block elements with text
    for element in elements.tolist():
        holds[element] = True
    for element in range(n - 1, 0, -1):
        above = page.parent[element]
        mass[above] += mass[element]
        inner[above] |= holds[element] or inner[element]
    # Down the elements that hold four fifths of the text, to the last one that is more
    # than a paragraph.
    container = 0
    for element in range(1, n):
        if page.parent[element] == container and inner[element] and mass[element] >= 0.8 * mass[0]:
            container = element
    within = [False] * n
    for element in range(n):
        within[element] = element == container or (element > 0 and within[page.parent[element]])
    inside = np.array(within)[elements]
    first, last = np.flatnonzero(inside & content)[[0, -1]].tolist()
    letters = np.array([len(t) - t.count(" ") for t in texts])
    chosen = inside & (content | (2 * plain >= letters))
    chosen[:first] = False
    chosen[last + 1 :] = False
    while first and page.tag[elements[first - 1]] in HEADINGS:
        first -= 1
        chosen[first] = True
    return chosen


def extract(pages: DataFrame, keep: list[str], html: str = "html", text: str = "text") -> DataFrame:
    """The columns named in `keep`, and the main text of each page."""

    def make():
        return lambda texts: {text: [main_text(t) for t in texts]}

    return map_texts(pages, keep, html, make, f"`{text}` string")
