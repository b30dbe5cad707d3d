"""Main text of web pages by tag-path ratios.

A page becomes a sequence of blocks, each with its path of tags and classes from the root.
For every path the text length and the punctuation of its blocks are
summed and divided by their number; both ratios are smoothed over the blocks in
page order with a Gaussian kernel and multiplied. Text in links takes the score down, and
so do elements whose tag, class, id or role is that of boilerplate: this is a
factor and no verdict. Paths at or above the threshold (a share of the root of the mean
square) are content.

Content chooses a node of the page: from the root down, as long as one container holds nearly all
content, and up again to a heading before it. Everything in that node is main text,
also short paragraphs, lists, tables and verses, but for blocks without a content path that are
mostly links, or have boilerplate elements or an article without content around them inside the node.
Boilerplate names around the node itself don't count. Navigation, footers, asides,
dialogs and headers outside articles are never main text.

Edge cases: null or empty html gives an empty text; unclosed and cut-off tags,
comments and character references are read as browsers do, a quote that is not closed
ends with its tag, a broken last tag is dropped; rows that repeat are extracted alike;
very long pages are read whole, in time proportional to their length;
an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without content, with raw text, and those that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text, not parts of a page: the main text is never one of them alone.
TEXT_LEVEL = HEADINGS | frozenset(
    "address blockquote caption dd details dl dt figcaption figure li ol p pre summary table tbody td tfoot th thead tr ul".split()
)
#: An open element that the start of another one closes.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Elements that are never main text; ``header`` joins them outside articles.
NEVER = frozenset("nav footer aside menu dialog head select button".split())
#: Words of class, id or role that boilerplate has, and those that text has as well.
STRONG_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr masthead menu nav navbar navigation newsletter popup promo promoted "
    "promotion replies respond sidebar signup sponsor sponsored subscribe".split()
)
WEAK_WORDS = frozenset(
    "contentinfo header login modal notice notices related search share sharing social toolbar widget widgets".split()
)
#: What an element with such a word, or a form, leaves of the scores inside it.
STRONG, WEAK = 0.01, 0.3
THRESHOLD = 0.2
#: The share of content that a container must hold to be the place of it, and the most that a heading may bring along.
HOLDS, BROUGHT = 0.98, 0.3
MOSTLY_LINKS = 0.5
_KERNEL = np.array([0.25, 0.5, 0.25])

# A quoted value ends before a space, a slash or the end of the tag; else its quote is a stray one and the tag ends at the next >.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>\"']|\"[^\"]*\"(?=[\s/>])|'[^']*'(?=[\s/>]))*+(?=>|\Z)|[^>]*)(?:>|\Z)",
    re.S,
)
_MARK = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")


def _factor(tag: str, attributes: str) -> float:
    """What the names of an element leave of the scores inside it."""
    factor = STRONG if tag == "form" else 1.0
    if tag in ("html", "body", "main", "article") or not attributes:
        return factor
    for match in _MARK.finditer(attributes):
        for name in (match[1] or match[2] or match[3] or "").lower().split():
            parts = {name, *re.split(r"[-_]+", name)}
            factor = min(factor, STRONG if parts & STRONG_WORDS else WEAK if parts & WEAK_WORDS else 1.0)
    return factor


_CLASS = re.compile(r"(?:^|\s)class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class Page:
    """The blocks of a page in order, and the tree of the elements around them; node 0 is the root."""

    def __init__(self, page: str) -> None:
        self.tags, self.parents, self.factors, self.paths = ["html"], [0], [1.0], [0]
        self.texts: list[str] = []
        self.nodes: list[int] = []  # of each block
        self.links: list[float] = []  # the share of its text that is in links
        self._names: dict[tuple[int, str], int] = {}
        self._read(page)
        self.first, self.last = self._spans()

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        match = _CLASS.search(attributes) if attributes else None
        name = f"{tag}.{(match[1] or match[2] or match[3] or '').lower()}" if match else tag
        self.tags.append(tag)
        self.parents.append(parent)
        self.factors.append(_factor(tag, attributes))
        self.paths.append(self._names.setdefault((self.paths[parent], name), len(self._names) + 1))
        return len(self.tags) - 1

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int, bool, bool]] = []  # tag, node, whether never main text, whether in an article
        text: list[str] = []
        linked: list[int] = []  # numbers of pieces of text in links
        open_links = 0

        def flush() -> None:
            nonlocal text, linked
            words = html.unescape("".join(text)).split() if text else []
            if words:
                joined = " ".join(words)
                in_links = sum(len("".join(html.unescape(text[i]).split())) for i in linked)
                self.texts.append(joined)
                self.nodes.append(stack[-1][1] if stack else 0)
                self.links.append(min(1.0, in_links / max(1, len("".join(words)))))
            text, linked = [], []

        def add(piece: str) -> None:
            if piece and not (stack and stack[-1][2]):
                if open_links:
                    linked.append(len(text))
                text.append(piece)

        def close(i: int) -> None:
            nonlocal open_links
            open_links -= sum(1 for x in stack[i:] if x[0] == "a")
            del stack[i:]

        at = 0
        while True:
            match = _TAG.search(page, at)
            if match is None:
                add(page[at:])
                break
            add(page[at : match.start()])
            at = match.end()
            tag = (match[2] or "").lower()
            if not tag:
                continue
            if match[1]:
                if tag in BLOCK:
                    flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if stack[i][0] in ("article", "body", "html") and tag not in BLOCK:
                        break
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
                if tag not in ("noscript",):
                    add(" ")
                continue
            if tag == "br":
                add(" ")
            if tag in BLOCK:
                flush()
                closed = CLOSES.get(tag, {"p"} if tag != "option" else set())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in closed:
                        close(i)
                        break
                    if stack[i][0] in BLOCK and stack[i][0] != "p":
                        break
            if tag in VOID:
                continue
            _, node, never, inside = stack[-1] if stack else ("", 0, False, False)
            if tag in BLOCK:
                node = self._open(tag, match[3] or "", node)
            open_links += tag == "a"
            never = never or tag in NEVER or (tag == "header" and not inside)
            stack.append((tag, node, never, inside or tag in ("article", "main")))
        flush()

    def _spans(self) -> tuple[list[int], list[int]]:
        """The first block of each node and the one after its last; blocks of a node follow one another."""
        first, last = [len(self.nodes)] * len(self.tags), [0] * len(self.tags)
        for i, node in enumerate(self.nodes):
            first[node], last[node] = min(first[node], i), i + 1
        for node in range(len(self.tags) - 1, 0, -1):
            up = self.parents[node]
            first[up], last[up] = min(first[up], first[node]), max(last[up], last[node])
        return first, last


def _smooth(values: np.ndarray) -> np.ndarray:
    padded = np.concatenate([values[:1], values, values[-1:]])
    return np.convolve(padded, _KERNEL, "valid")


def path_scores(page: Page) -> np.ndarray:
    """The fused, smoothed ratio of each block's path."""
    path = np.unique(np.array([page.paths[n] for n in page.nodes]), return_inverse=True)[1]
    per_path = np.bincount(path)
    factors = list(page.factors)  # the least of the element and those around it
    for node in range(1, len(factors)):
        factors[node] = min(factors[node], factors[page.parents[node]])
    chars = np.array([len(t) for t in page.texts], float)
    length = (np.bincount(path, chars) / per_path)[path]
    marks = (1 + np.bincount(path, [len(_PUNCTUATION.findall(t)) for t in page.texts]) / per_path)[path]
    links = (np.bincount(path, chars * page.links) / np.bincount(path, chars))[path]
    fused = np.maximum(length * marks, _smooth(length) * _smooth(marks))
    fused *= (1 - links) ** 2 * np.array([factors[n] for n in page.nodes])
    return (np.bincount(path, fused) / per_path)[path]


def content_node(page: Page, scores: np.ndarray, content: np.ndarray) -> int:
    """The node that the content paths choose, by the scores and lengths of their blocks."""
    held = [0.0] * len(page.tags)
    for i in np.flatnonzero(content):
        held[page.nodes[i]] += len(page.texts[i]) * scores[i]
    for node in range(len(held) - 1, 0, -1):
        held[page.parents[node]] += held[node]
    richest: dict[int, int] = {}  # of each node, the container in it with the most content
    for node in range(1, len(held)):
        rival = richest.get(page.parents[node])
        if page.tags[node] not in TEXT_LEVEL and held[node] > (0 if rival is None else held[rival]):
            richest[page.parents[node]] = node
    chosen = 0
    while chosen in richest and held[richest[chosen]] >= HOLDS * held[0]:
        chosen = richest[chosen]
    size = np.append(0, np.cumsum([len(t) for t in page.texts]))
    while chosen and page.tags[up := page.parents[chosen]] not in ("html", "body") and up:
        inside = size[page.last[chosen]] - size[page.first[chosen]]
        before = range(page.first[up], page.first[chosen])
        if not any(page.tags[page.nodes[i]] in HEADINGS for i in before):
            break
        if size[page.last[up]] - size[page.first[up]] - inside > BROUGHT * inside:
            break
        chosen = up
    return chosen


def main_text(page: str | None) -> str:
    """The main text: its blocks joined by two line breaks."""
    found = Page(page or "")
    if not found.texts:
        return ""
    scores = path_scores(found)
    content = (scores > 0) & (scores >= THRESHOLD * np.sqrt((scores**2).mean()))
    chosen = content_node(found, scores, content)
    doubtful = [False] * len(found.tags)  # by an element around the block, inside the chosen one
    total = np.append(0, np.cumsum(content))
    for node in range(chosen + 1, len(found.tags)):
        own = found.factors[node] < 1 or (
            found.tags[node] == "article" and total[max(found.last[node], found.first[node])] == total[found.first[node]]
        )
        doubtful[node] = own or doubtful[found.parents[node]]
    return "\n\n".join(
        found.texts[i]
        for i in range(found.first[chosen], found.last[chosen])
        if content[i] or not (doubtful[found.nodes[i]] or found.links[i] > MOSTLY_LINKS)
    )


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row ``page_id``, ``url``, ``text`` and ``n_chars``, its code points."""
    page_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], ["page_id", "url", "text", "n_chars"])

    chosen = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return chosen.mapInArrow(run, f"page_id {page_type}, url string, text string, n_chars long")
