"""Main text of web pages by a tree-structured graphical model over the page's elements.

Every block element is a node that is content or not. What an element is like (tag, words of class, id and role, length,
share of link text) gives its unary potential, and parent and child are joined by a pairwise potential. Sum-product
messages, once up and once down the tree, yield the exact marginal of each node; blocks of text under nodes that are
content with a probability of a half or more make the main text. Weights are the maximum of the exact likelihood of
labelled pages (``train``): hand-labelled layouts (``page_seeds``) and a bounded sample of the pages at hand whose own
markup tells where the article is.

Defined cases: null and empty html, and pages without content, give the empty text; unclosed tags end where html says
or at the end of the page, stray end tags are ignored, comments and scripts that don't end reach to the page's end;
repeated pages are extracted alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.page_seeds import SEEDS

TRAINING_PAGES = 200
_FEATURES = 1 << 12

#: Fixed values of html: elements without content, with raw text, and those that break a line of text.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul button label".split()
)
_HIDDEN = set("head script style noscript template title svg math iframe object textarea select option canvas audio video".split())
#: An open element of the key's kind ends before a tag of these (within the nearest of the third kind).
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
_IN_PARAGRAPH = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())

#: A quote that nothing closes before a blank, a slash or the tag's end counts as a character; a tag ends at the next tag at the latest.
_PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(script|style|noscript|template|textarea|title|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])|[\"'])*+)(?:>|(?=<)|\Z)|[^<]+|<", re.S | re.I)
_NAMED = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")


class Page:
    """Nodes in page order (parents first): tag, attribute words, parent, and the text blocks with their node."""

    def __init__(self, html: str):
        self.tags, self.words, self.parents, self.hidden, self.attributes = ["#page"], [()], [-1], [False], [""]
        self.links = [0]  # characters of link text, and of all text, in a node's own blocks
        self.sizes = [0]
        self.blocks: list[tuple[int, str]] = []
        self._open = [("#page", 0)]
        self._text: list[str] = []
        self._in_link = 0
        for part in _PART.finditer(html):
            if part[3]:
                self._end(part[3].lower()) if part[2] else self._start(part[3].lower(), part[4])
            elif part[1] or part[0][:2] in ("<!", "<?"):
                if part[0][:9].upper() == "<![CDATA[":
                    self._add(part[0][9:].removesuffix("]]>"))
            else:
                self._add(entities.unescape(part[0]) if "&" in part[0] else part[0])
        self._flush()

    def _add(self, text: str) -> None:
        self._text.append(text)
        if self._in_link:
            self.links[self._open[-1][1]] += len(text)

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text.clear()
        node = self._open[-1][1]
        if text and not self.hidden[node]:
            self.blocks.append((node, text))
            self.sizes[node] += len(text)

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text.append(" ")
        if tag in _VOID:
            if tag == "hr":
                self._flush()
            return
        if tag in _ENDS:
            self._close(_ENDS[tag], _SCOPE[tag])
        if tag == "p" or tag in _BLOCK and tag not in ("label", "button", "option", "select"):
            self._close(("p",), ("button", "td", "th", "table", "caption", "object"))
        if tag in _BLOCK or tag in _HIDDEN:
            self._flush()
            parent = self._open[-1][1]
            words: tuple[str, ...] = ()
            unseen = tag in _HIDDEN or self.hidden[parent]
            if attributes and "=" in attributes or "hidden" in attributes:
                found = [(n.lower(), (a or b or c or "").lower()) for n, a, b, c in _NAMED.findall(attributes)]
                words = tuple(w for n, v in found if n in ("class", "id", "role", "itemprop") for w in _WORD.findall(v))
                unseen = unseen or any(n == "hidden" or n == "aria-hidden" and v == "true" for n, v in found)
            self.tags.append(tag)
            self.words.append(words)
            self.parents.append(parent)
            self.hidden.append(unseen)
            self.attributes.append(attributes)
            self.links.append(0)
            self.sizes.append(0)
            self._open.append((tag, len(self.tags) - 1))
        else:
            self._in_link += tag == "a"
            self._open.append((tag, self._open[-1][1]))

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._text.append(" ")
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == tag:
                self._pop(i)
                return
            if tag in _IN_PARAGRAPH and self._open[i][0] in _BLOCK:
                return  # the end of an inline element doesn't end a block

    def _close(self, tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] in tags:
                self._pop(i)
                return
            if self._open[i][0] in scope:
                return

    def _pop(self, depth: int) -> None:
        if any(tag in _BLOCK or tag in _HIDDEN for tag, _ in self._open[depth:]):
            self._flush()
        self._in_link -= sum(tag == "a" for tag, _ in self._open[depth:])
        del self._open[depth:]


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % _FEATURES


def features(page: Page) -> list[list[int]]:
    """Numbers of the features that each node has."""
    out, known = [], {}
    for tag, words, size, links in zip(page.tags, page.words, page.sizes, page.links, strict=True):
        names = ["tag " + tag, *["word " + w for w in words]]
        names.append(f"size {min(len(bin(size)) - 2, 10) if size else 0}")
        if size:
            names.append(f"links {min(int(4 * links / size), 3)}")
        for name in names:
            if name not in known:
                known[name] = _feature(name)
        out.append([known[n] for n in names])
    return out


def marginals(parents: list[int], unary: list[float], pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each node, and of each edge (parent to node) the four joint probabilities, by sum-product.

    ``unary`` are log-odds of content; ``pair`` (parent state, own state) log-potentials. Parents come before children.
    """
    (a, b), (c, d) = np.exp(pair - pair.max()).tolist()
    n = len(parents)
    own = [min(max(x, -30.0), 30.0) for x in unary]
    up0, up1 = [1.0] * n, np.exp(own).tolist()  # a node's belief from itself and below
    to0, to1 = [1.0] * n, [1.0] * n  # message to the parent
    for i in range(n - 1, 0, -1):
        s = up0[i] + up1[i]
        up0[i], up1[i] = up0[i] / s, up1[i] / s
        m0, m1 = a * up0[i] + b * up1[i], c * up0[i] + d * up1[i]
        s = m0 + m1
        to0[i], to1[i] = m0 / s, m1 / s
        p = parents[i]
        up0[p] *= to0[i]
        up1[p] *= to1[i]
        s = up0[p] + up1[p]
        up0[p], up1[p] = up0[p] / s, up1[p] / s
    s = up0[0] + up1[0]
    full0, full1 = [up0[0] / s] * n, [up1[0] / s] * n  # beliefs with the message from above
    joint = np.zeros((n, 4))
    for i in range(1, n):
        p = parents[i]
        r0, r1 = full0[p] / max(to0[i], 1e-300), full1[p] / max(to1[i], 1e-300)  # the parent without this child
        j = r0 * a * up0[i], r0 * b * up1[i], r1 * c * up0[i], r1 * d * up1[i]
        s = sum(j)
        joint[i] = [x / s for x in j]
        full0[i], full1[i] = (j[0] + j[2]) / s, (j[1] + j[3]) / s
    return np.array(full1), joint


def truth(page: Page) -> list[bool] | None:
    """Labels from a page's own markup: within article or main, but not in what is set apart there. None if it has none."""
    if not any(t in ("article", "main") for t in page.tags):
        return None
    inside = [False]
    for i in range(1, len(page.tags)):
        tag, above = page.tags[i], inside[page.parents[i]]
        apart = tag in ("nav", "aside", "footer", "form", "button", "fieldset", "dialog", "menu") or page.hidden[i]
        inside.append((above or tag in ("article", "main")) and not apart)
    return inside


def seed_pages() -> list[tuple[Page, list[bool]]]:
    """The hand-labelled layouts: an element marked data-main starts content, one marked data-apart ends it."""
    out = []
    for source in SEEDS:
        page = Page(source)
        inside = [False]
        for i in range(1, len(page.tags)):
            mark = page.attributes[i]
            inside.append("data-main" in mark or inside[page.parents[i]] and "data-apart" not in mark)
        out.append((page, inside))
    return out


def train(labelled: list[tuple[Page, list[bool]]], rounds: int = 150, rate: float = 0.2, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Unary weights and pairwise potentials of the greatest likelihood, less a ridge; each page weighs the same."""
    weights, pair = np.zeros(_FEATURES), np.zeros((2, 2))
    speed, fast = np.zeros(_FEATURES), np.zeros((2, 2))
    seen = [(p.parents, features(p), np.array(y, dtype=float)) for p, y in labelled]
    for _ in range(rounds):
        gain, joint_gain = -ridge * len(seen) * weights, -ridge * len(seen) * pair
        for parents, found, y in seen:
            unary = [sum(weights[f] for f in x) for x in found]
            p, joint = marginals(parents, unary, pair)
            for x, d in zip(found, (y - p) / np.sqrt(len(y)), strict=True):
                for f in x:
                    gain[f] += d
            above = y[np.maximum(parents, 0)]
            states = (2 * above + y).astype(int)[1:]
            joint_gain += (np.bincount(states, minlength=4) - joint[1:].sum(axis=0)).reshape(2, 2) / np.sqrt(len(y))
        speed += gain**2
        fast += joint_gain**2
        weights += rate * gain / np.sqrt(speed + 1e-9)
        pair += rate * joint_gain / np.sqrt(fast + 1e-9)
    return weights, pair


def extract(html: str | None, weights: np.ndarray, pair: np.ndarray) -> str:
    if not html:
        return ""
    page = Page(html)
    known = weights.tolist() if isinstance(weights, np.ndarray) else weights
    unary = [sum([known[f] for f in x]) for x in features(page)]
    p, _ = marginals(page.parents, unary, pair)
    return "\n".join([text for node, text in page.blocks if p[node] >= 0.5])


def train_on(pages: DataFrame, n_pages: int = TRAINING_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """A model from the seeds and about ``n_pages`` of ``pages`` (page_id, html) that label themselves."""
    total = pages.count()
    chosen = F.pmod(F.xxhash64("page_id", F.octet_length("html")), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, n_pages / max(total, 1))))
    found = [r["html"] for r in pages.where("html is not null").where(chosen).select("page_id", "html").sort("page_id", "html").collect()]
    own = [(p, y) for p in map(Page, found) if (y := truth(p)) is not None]
    return train(seed_pages() * max(1, len(own) // len(SEEDS)) + own)


def main_texts(pages: DataFrame, model: tuple[np.ndarray, np.ndarray], *keep: Column | str) -> DataFrame:
    """The columns ``keep`` of ``pages`` with text, from the column ``html`` alone."""
    shared = pages.sparkSession.sparkContext.broadcast((model[0].tolist(), model[1]))
    rows = pages.select(F.struct(*keep).alias("kept"), "html")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [extract(x.as_py(), *shared.value) for x in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("kept"), pa.array(texts, pa.string())], ["kept", "text"])

    return rows.mapInArrow(run, f"kept {rows.schema['kept'].dataType.simpleString()}, text string").select("kept.*", "text")
