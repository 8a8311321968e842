"""Main text of web pages: flat text blocks, their neighbours, and a decision tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidehaul.llm.common import ready_for_python

# Elements and names of HTML pages.
DROPPED = "script style noscript template title textarea select button iframe object svg canvas"
CONTAINERS = set(
    "html body div section article main nav header footer aside form menu dialog ul ol dl table tbody thead tfoot tr "
    "figure blockquote fieldset details center".split()
)
BLOCKS = CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption pre address hr head legend summary option".split())
BREAKS = {"br", "wbr", "img", "input"}
MAIN_TAGS = {"article", "main"}
# Their classes say what kind of page it is, not what stands around its text.
WHOLE_TAGS = MAIN_TAGS | {"html", "body"}
BOILER_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog"}
MAIN_WORDS = set("article main content post entry story body".split())
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead widget related "
    "recommended recommendations share sharing social subscribe newsletter signup login popup modal overlay toolbar "
    "pagination pager skip contentinfo complementary search dialog copyright legal disclaimer teaser".split()
)
COMMENT_WORDS = set("comment comments commentlist respond replies reply disqus".split())
# These are comments beside the main text, and parts of it inside.
COMMENT_WORDS_OUTSIDE = {"discussion", "reader", "readers"}

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile("[>\"']")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in DROPPED.split()}
_HINTS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A run of text between block-level tags. ``state``: 1 in main content, -1 in what surrounds it, 0 unknown."""

    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    state: int = 0
    heading: bool = False

    def finish(self) -> None:
        self.text = " ".join(html.unescape("".join(self.parts)).split())
        self.words = self.text.count(" ") + 1 if self.text else 0
        self.link_density = len(html.unescape(" ".join(self.linked)).split()) / max(1, self.words)


def _hint(name: str, attrs: str, in_main: bool) -> int:
    """2 for reader comments, -1 for what surrounds the main text, 1 for main text, 0 for nothing known."""
    if name in WHOLE_TAGS:
        return int(name in MAIN_TAGS)
    said: set[str] = set()
    if attrs and "=" in attrs:
        for m in _HINTS.finditer(attrs):
            said.update(_PART.findall((m[1] or m[2] or m[3] or "").lower()))
    if said & COMMENT_WORDS or not in_main and said & COMMENT_WORDS_OUTSIDE:
        return 2
    if said & BOILER_WORDS or name in BOILER_TAGS:
        return -1
    if not in_main and (name == "header" or "header" in said):
        return -1
    return int(bool(said & MAIN_WORDS) and name in CONTAINERS)


class _Ends:
    """Where tags end: at the first ``>`` outside of quotes. Looks at no place of a page more than a few times.

    A tag without an end is known by the quotes that its search ran into, so
    that the searches of later tags stop there.
    """

    def __init__(self, page: str):
        self.page, self.dead = page, set()
        self.low = self.stop = -1

    def _next_stop(self, at: int) -> int:
        if not self.low <= at <= self.stop:
            found = _STOP.search(self.page, at)
            self.low, self.stop = at, found.start() if found else len(self.page)
        return self.stop

    def after(self, at: int) -> int:
        """The place after the end of the tag whose attributes begin at ``at``, -1 if it has none."""
        page, path = self.page, []
        while True:
            stop = self._next_stop(at)
            if stop < len(page) and stop not in self.dead:
                if page[stop] == ">":
                    return stop + 1
                path.append(stop)
                close = page.find(page[stop], stop + 1)
                if close >= 0:
                    at = close + 1
                    continue
            self.dead.update(path)
            return -1


def tags_of(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, is_end, attributes) of what is no text, in order. The name is empty where nothing but the place counts."""
    ends, at = _Ends(page), 0
    last_open, last_close = page.rfind("<"), page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        if page.startswith("!--", at):
            close = page.find("-->", at + 3)
            at = len(page) if close < 0 else close + 3
            yield start, at, "", False, ""
        elif page[at : at + 1] in ("!", "?"):
            close = page.find(">", at)
            at = len(page) if close < 0 else close + 1
            yield start, at, "", False, ""
        elif found := _NAME.match(page, at):
            end = ends.after(found.end())
            if end < 0:
                if start == last_open > last_close:
                    # The page breaks off inside of a tag.
                    yield start, len(page), "", False, ""
                    return
                continue
            name, attrs = found[2].lower(), page[found.end() : end - 1]
            at = end
            if name in _RAW_END:
                if not found[1] and not attrs.endswith("/"):
                    close = _RAW_END[name].search(page, end)
                    at = close.end() if close else len(page)
                yield start, at, "", False, ""
            else:
                yield start, at, name, bool(found[1]), attrs


def blocks_of(page: str) -> list[Block]:
    """Flat text blocks of a page in order, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open containers, each with the state inside it
    now, in_link = Block(), 0

    def begin(state: int, heading: bool = False) -> None:
        nonlocal now
        if now.parts:
            out.append(now)
        now = Block(state=state, heading=heading)

    def text(piece: str) -> None:
        if piece:
            now.parts.append(piece)
            if in_link:
                now.linked.append(piece)

    at, open_names = 0, Counter()
    for start, end, name, is_end, attrs in tags_of(page):
        text(page[at:start])
        at = end
        if name == "a":
            in_link = 0 if is_end else 1
        elif name in BREAKS:
            now.parts.append(" ")
        elif name in BLOCKS:
            inside = stack[-1][1] if stack else 0
            if is_end:
                if open_names[name]:
                    closed = ""
                    while closed != name:
                        closed = stack.pop()[0]
                        open_names[closed] -= 1
                begin(stack[-1][1] if stack else 0)
                continue
            hint = _hint(name, attrs, inside == 1)
            # Comments stay comments whatever is inside them; else the innermost that says something decides.
            state = 2 if inside == 2 or hint == 2 else hint or inside
            if name in CONTAINERS:
                stack.append((name, state))
                open_names[name] += 1
                begin(state)
            else:
                begin(state, len(name) == 2 and name[0] == "h" and name[1].isdigit())
    text(page[at:])
    begin(0)
    for b in out:
        b.finish()
        b.state = -1 if b.state == 2 else b.state
    return [b for b in out if b.text]


# ``region``: -1 in what surrounds a text; on pages that mark their main content 0 outside and 2 inside of it; 1 on others.
FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "region", "heading",
]


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` for each block."""
    n = len(blocks)
    x = np.zeros((n, len(FEATURES)))
    if n:
        words = np.array([b.words for b in blocks], float)
        density = np.array([b.link_density for b in blocks], float)
        x[:, 0], x[:, 1] = words, density
        x[1:, 2], x[1:, 3] = words[:-1], density[:-1]
        x[:-1, 4], x[:-1, 5] = words[1:], density[1:]
        state = np.array([b.state for b in blocks], float)
        x[:, 6] = np.where(state == 1, 2, np.where(state == 0, float(not (state == 1).any()), -1))
        x[:, 7] = [b.heading for b in blocks]
    return x


# The labelled table: fragments of pages and whether they belong to the main text. "w12" stands for twelve words.
LABELLED = [
    [
        (0, "<nav><ul><li><a href=/>w1</a></li><li><a href=/>w2</a></li><li><a href=/>w1</a></li></ul></nav>"),
        (0, "<div class=ad>w9</div>"),
        (1, "<article><h1>w7</h1><p>w40</p><p>w3</p><p><b>w8</b><br></p><p>w120</p>"),
        (0, "<aside>w25</aside>"),
        (1, "<p>w2</p><p>w60 <a href=/>w2</a> w9</p><ul><li>w4</li><li>w11</li></ul></article>"),
        (0, "<footer>w12</footer>"),
    ],
    [
        (0, "<header><h1>w2</h1><p>w8</p></header><div class=cookie-notice><p>w30</p></div>"),
        (1, "<main><h2>w5</h2><p>w1</p><p><a href=/>w14</a></p><p>w33</p></main>"),
        (0, "<div id=sidebar><h3>w2</h3><p>w18</p><ul><li><a href=/>w4</a></li></ul></div>"),
        (0, "<section class=comments><article><p>w45</p></article><p>w6</p></section>"),
        (0, "<form><p>w9</p></form><footer><p>w22</p></footer>"),
    ],
    [
        (0, "<div><a href=/>w1</a> <a href=/>w1</a> <a href=/>w2</a></div><p><a href=/>w3</a></p>"),
        (1, "<div><h1>w6</h1><p>w50</p><p>w24</p><p>w80 <a href=/>w3</a></p><p>w15</p><p>w38</p></div>"),
        (0, "<div>w3</div><div><a href=/>w2</a> <a href=/>w3</a></div><div>w4</div>"),
    ],
    [
        (0, "<div>w2</div><ul><li><a href=/>w2</a></li><li><a href=/>w3</a></li></ul>"),
        (1, "<h2>w4</h2><p>w90</p><p>w11</p><p>w70</p><p>w28</p>"),
        (0, "<p><a href=/>w6</a></p><p><a href=/>w2</a> w1</p><div>w5</div>"),
    ],
    [
        (0, "<div class=menu>w6</div>"),
        (1, "<div><p>w21</p></div>"),
        (0, "<div class='promo banner'><p>w35</p></div><div>w3</div>"),
    ],
    [
        (0, "<p>w5</p><p><a href=/>w9</a></p>"),
        (1, "<article><p>w5</p></article>"),
        (0, "<p>w40</p><p>w4</p>"),
    ],
    # What surrounds a text can be as long as the text.
    [
        (0, "<div class=cookie-notice><p>w76</p></div><div class=ad>w90</div>"),
        (1, "<article><p>w30</p></article>"),
        (0, "<section class=comments><p>w76</p><p>w130</p></section>"),
    ],
    [
        (1, "<article><p>w30</p><p>w64</p></article>"),
        (0, "<aside class=sidebar><p>w76</p></aside><p>w80</p><footer>w76</footer>"),
    ],
    [
        (0, "<div class=banner>w70</div>"),
        (1, "<main><p>w12</p><ul><li><a href=/>w6</a></li><li><a href=/>w9</a></li></ul></main>"),
        (0, "<div class=related>w140</div><div class=newsletter>w66</div>"),
    ],
    # Inside of an article short blocks and lists of links count as well.
    [
        (0, "<nav><a href=/>w1</a></nav>"),
        (1, "<article><h1>w3</h1><p>w60</p><p>w1</p><p><a href=/>w2</a></p><p>w2</p></article>"),
        (0, "<footer>w4</footer>"),
    ],
    [
        (0, "<div class=menu><a href=/>w1</a> <a href=/>w2</a></div><p><a href=/>w2</a></p><p>w2</p>"),
        (1, "<main><h1>w2</h1><p>w4</p><p>w46</p><p><a href=/>w20</a></p><p>w5</p></main>"),
        (0, "<p>w3</p><p>w16</p><p><a href=/>w4</a></p>"),
    ],
    [
        (0, "<nav><a href=/>w2</a></nav><p>w5</p>"),
        (
            1,
            "<article><h1>w1</h1><p>w2</p><p>w1</p><p>w3</p><ul><li><a href=/>w3</a></li><li><a href=/>w1</a></li>"
            "<li><a href=/>w2</a></li><li><a href=/>w12</a></li></ul><p>w2</p><p>w9</p><p><a href=/>w4</a></p>"
            "<p>w1</p><p>w5</p><p><a href=/>w30</a></p><p><a href=/>w7</a></p><p>w3</p></article>",
        ),
        (0, "<p>w2</p><p>w4</p>"),
    ],
    [
        (0, "<p>w8</p>"),
        (
            1,
            "<main><p>w1</p><p>w2</p><table><tr><td>w1</td><td><a href=/>w1</a></td></tr><tr><td>w2</td><td><a href=/>w2</a>"
            "</td></tr><tr><td>w3</td><td><a href=/>w5</a></td></tr></table><p><a href=/>w17</a></p><p>w4</p>"
            "<p><a href=/>w9</a></p><p><a href=/>w3</a></p></main>",
        ),
        (0, "<div>w6</div>"),
    ],
    # Without article or main, links and neighbours tell.
    [(1, "<p>w46</p>")],
    [(0, "<div>w3</div>"), (1, "<div><h1>w3</h1><p>w40</p><h2>w2</h2><p>w25</p></div>"), (0, "<div>w2</div>")],
    [(0, "<div><a href=/>w2</a></div>"), (1, "<div><h1>w3</h1><p>w44</p></div>"), (0, "<div><a href=/>w3</a></div>")],
    [(0, "<ul><li><a href=/>w2</a></li></ul>"), (1, "<h1>w1</h1><p>w30</p>"), (0, "<div><a href=/>w1</a></div>")],
    [(0, "<p>w2</p>"), (1, "<h1>w2</h1><p>w60</p><h3>w1</h3><p>w18</p>"), (0, "<div>w3</div>")],
    [(1, "<table><tr><td>w46</td></tr></table>")],
    [(1, "<p>w14</p>")],
    [(1, "<div><p>w46</p><p>w1</p><p>w46</p></div>")],
    [
        (0, "<p><a href=/>w30</a></p>"),
        (1, "<p>w30</p><p>w2</p><p>w52 <a href=/>w8</a></p><p>w5</p><p>w33</p>"),
        (0, "<p><a href=/>w46</a></p><p><a href=/>w20</a> w2</p><div><a href=/>w60</a></div>"),
    ],
    [
        (0, "<div><a href=/>w12</a></div><div>w3</div>"),
        (1, "<div>w46</div><div>w20</div><div>w9</div><div>w25</div>"),
        (0, "<div><a href=/>w70</a></div><div>w4</div>"),
    ],
    [
        (0, "<div class=comments><p>w50</p></div>"),
        (1, "<div><p>w46</p><p>w18</p></div>"),
        (0, "<footer><p>w90</p><p>w4</p></footer>"),
    ],
    [
        (0, "<ul><li><a href=/>w9</a></li><li><a href=/>w11</a></li><li><a href=/>w25</a></li></ul>"),
        (1, "<p>w22 <a href=/>w10</a> w4</p><p>w3</p><p>w19 <a href=/>w9</a></p>"),
        (0, "<p><a href=/>w5</a> <a href=/>w5</a> w1</p>"),
    ],
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of ``LABELLED``."""
    x, y = [], []
    for page in LABELLED:
        marked = "".join(re.sub(r"w(\d+)", lambda m, k=kind: " ".join([f"x{k}"] * int(m[1])), part) for kind, part in page)
        blocks = blocks_of(marked)
        x.append(features_of(blocks))
        y += [int(b.text.startswith("x1")) for b in blocks]
    return np.concatenate(x), np.array(y)


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple:
    """A decision tree by least Gini impurity: ``(share,)`` or ``(feature, threshold, low, high)``."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] < t
            p, q = y[low].mean(), y[~low].mean()
            impurity = low.mean() * p * (1 - p) + (~low).mean() * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(t))
    if best is None or best[0] >= share * (1 - share) - 1e-12:
        return (share,)
    _, f, t = best
    low = x[:, f] < t
    return (f, t, grow_tree(x[low], y[low], depth - 1), grow_tree(x[~low], y[~low], depth - 1))


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x))
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(node) == 1:
            out[rows] = node[0]
        else:
            low = x[rows, node[0]] < node[1]
            todo += [(node[2], rows[low]), (node[3], rows[~low])]
    return out >= 0.5


def main_text(page: str | None, tree: tuple) -> str:
    blocks = blocks_of(page or "")
    keep = classify(tree, features_of(blocks))
    return " ".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``op7``: page_id, url, text and n_chars for each row of ``pages``.

    The page is cut into flat blocks at block-level tags; scripts, styles,
    comments in the markup and form controls are dropped, references decoded,
    and white space is made one space. A decision tree grown from ``LABELLED``
    decides on each block from its words and link density, those of the blocks
    before and after it, and the container it stands in. What it keeps is
    joined by one space. NULL, empty or text-free pages give an empty text.
    Repeated rows each give a row, other columns are ignored. A page is done
    by itself, so nothing is shuffled.
    """
    ready_for_python(pages.sparkSession)
    tree = grow_tree(*labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.selectExpr("cast(page_id as bigint) as page_id", "cast(url as string) as url", "cast(html as string) as html")
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
