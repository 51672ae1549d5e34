"""HTML extraction: a tree-structured graphical model over the DOM.

Every block element, and any other with a class, id or role, is a variable with three states: boilerplate, content, and a
container of both. Unary potentials come from the element's tag, its class, id and role words, its text, its share of link
text, and the prose of its neighbours before and after; a parent-child potential couples an element with what it holds.
Sum-product messages go up from the leaves and down from the root, exact on a tree, and text is kept where the marginal of
content is above that of boilerplate. All pages of a batch are passed at once, level by level.

The model is trained from labelled pages: a bounded sample of the pages whose mark-up states what is what (an article,
navigation, a footer, ...), each also in variants where the article is a plain division with one of the usual names and
further boilerplate of known kind (side bar, notice, comments, form, share bar) is put around and into it. The potentials
are fitted to the labels by the likelihood of whole pages. The trained model is some kilobytes and goes to every task.

Labels come from ``<article>`` and from templates of class names, so accuracy elsewhere is what these teach. On the 2,500
pages of a table of 0.1 of the unit scale with ``<article>`` renamed, the whole text is extracted without fault from all of
them for ``main``, divisions of a usual name and sections, and from 99 % for a division without any name.

A header is boilerplate wherever it stands, also an article's own with its title and author; a title outside one is text.
Paragraphs, items and cells that are links alone are text where they stand between prose of the article.

Extraction: character references are decoded, white space inside a block becomes one space, blocks are joined in page
order by one line feed. Scripts, styles, titles, text fields, frames, drawings and templates are skipped; formulas and
the fallback of objects are text.

Cases: a null or empty page has the empty text, as does one without content. Unclosed, misnested and cut-off mark-up is
read as browsers do: by implied ends, else up to the end of the page. Repeated rows are extracted alike; an empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import hash_sample, whole_texts

BOILERPLATE, CONTENT, MIXED = 0, 1, 2
#: Potential of pairs of parent and child that labels rule out.
NEVER = -30.0
#: Steps of the fit, their length, and the penalty on squared weights.
ROUNDS, RATE, PENALTY = 100, 0.12, 0.2
#: Pages in the training sample: those of the smallest hash of their html.
SAMPLE_PAGES = 200
#: Deeper pages are left out of the sample: one page of thousands of nested elements would outweigh all others.
SAMPLE_DEPTH = 60
#: Pages whose trees are passed at once.
BATCH_PAGES = 500

# Element names of the HTML standard by what they mean for parsing.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("head iframe noscript script style svg template textarea title".split())
RAW = {"iframe", "noscript", "script", "style", "textarea", "title"}
# Elements of HTML that end an open drawing, unless they are in one of the drawing's elements that hold HTML.
BREAKOUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span"
    " strike strong sub sup table tt u ul var".split()
)
HTML_IN_SVG = {"foreignobject", "desc", "title"}
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/a-zA-Z][^>]*(?:>|\Z)|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
END = {name: re.compile(rf"(?ai)</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)") for name in SKIPPED}
VALUE_SLASH = re.compile(r"""=\s*[^\s"'>]*/$""")  # the slash at the end belongs to an unquoted value
#: The attribute by which training pages state labels; its sign is taken out of pages that come in.
SIGN = "\ue000"
INLINE_NODE = re.compile(rf"(?i)\b(?:class|id|role|hidden|aria-hidden|style)\b|{SIGN}")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def closes_itself(attributes: str) -> bool:
    return attributes.endswith("/") and not VALUE_SLASH.search(attributes)


def end_of_skipped(source: str, name: str, at: int) -> int:
    """Where the page goes on after a skipped element whose content starts at ``at``; the page's end if nothing ends it.

    Drawings and templates nest. A drawing is also ended, as in browsers, by HTML that cannot be in it.
    """
    if name in RAW:
        return m.end() if (m := END[name].search(source, at)) else len(source)
    depth, html_depth = 1, 0
    while at < len(source) and (m := TOKEN.match(source, at)):
        start, at = m.span()
        if m[2] is None:
            continue
        inner, ends = m[2].lower(), bool(m[1])
        if inner == name:
            if ends or name != "svg" or not closes_itself(m[3]):
                depth += -1 if ends else 1
            if not depth:
                return at
        elif name == "template":
            if inner in RAW and not ends:
                at = end_of_skipped(source, inner, at)
        elif inner in HTML_IN_SVG:
            if ends or not closes_itself(m[3]):
                html_depth = max(0, html_depth + (-1 if ends else 1))
        elif not html_depth and (inner in BLOCK if ends else inner in BREAKOUT):
            return start
    return len(source)


class Tree:
    """Elements of a page as parallel lists, and its texts as (element, text, ends a block)."""

    def __init__(self, source: str):
        self.tag, self.attrs, self.parent, self.depth = ["#page"], [""], [-1], [0]
        self.texts: list[tuple[int, str]] = []  # element -1: a block ends here
        self.linked: dict[int, int] = {}  # length of an element's own text that is in links
        self.stack = [0]  # open elements, and their places in the stack by name, and those of blocks
        self.open: dict[str, list[int]] = {}
        self.open_blocks: list[int] = []
        self.link_from: int | None = None
        self._build(source)

    def _end_link(self) -> None:
        if self.link_from is not None:
            for i, text in self.texts[self.link_from :]:
                if i >= 0:
                    self.linked[i] = self.linked.get(i, 0) + len(text)
            self.link_from = None

    def _push(self, i: int) -> None:
        place, name = len(self.stack), self.tag[i]
        self.stack.append(i)
        self.open.setdefault(name, []).append(place)
        if name in BLOCK:
            self.open_blocks.append(place)

    def _cut(self, place: int) -> None:
        """Close the open element at this place and all within it; every element is closed once."""
        while len(self.stack) > place:
            name = self.tag[self.stack.pop()]
            self.open[name].pop()
            if name in BLOCK:
                self.open_blocks.pop()

    def _innermost(self, names: set[str]) -> int:
        """The place of the innermost open element of these names, or 0."""
        return max([places[-1] for n in names if (places := self.open.get(n))], default=0)

    def _close(self, names: set[str], stop: set[str]) -> None:
        """Close the innermost open element of these names, unless it is around one of ``stop``."""
        place = self._innermost(names)
        if place > self._innermost(stop):
            self._cut(place)
            self.texts.append((-1, ""))

    def _build(self, source: str) -> None:
        stack, at, size = self.stack, 0, len(source)
        match = TOKEN.match
        while at < size and (m := match(source, at)):
            at = m.end()
            name = m[2]
            if name is None:
                piece = m[0]
                if piece[0] != "<" or piece == "<":
                    self.texts.append((stack[-1], piece))
                continue
            name = name.lower()
            if m[1]:
                if name in BLOCK:
                    self.texts.append((-1, ""))
                if name == "a":
                    self._end_link()
                place = self._innermost({name})
                if place and (name in BLOCK or not self.open_blocks or place > self.open_blocks[-1]):
                    self._cut(place)
                continue
            if name in SKIPPED:
                if name != "head" and not (name == "svg" and closes_itself(m[3])):
                    at = end_of_skipped(source, name, at)
                continue  # a head needs no element: what it holds is skipped by itself
            if name == "br":
                self.texts.append((stack[-1], " "))
                continue
            if name in BLOCK:
                self.texts.append((-1, ""))
                self._close({"p"}, {"button", "td", "th", "table"})
                if name in IMPLIED_END:
                    self._close(IMPLIED_END[name], SCOPES[name])
            if name in VOID:
                continue
            if name not in BLOCK and not INLINE_NODE.search(m[3]):  # its text is its block's
                if name == "a":
                    self._end_link()
                    self.link_from = len(self.texts)
                continue
            self.tag.append(name)
            self.attrs.append(m[3])
            self.parent.append(stack[-1])
            self.depth.append(self.depth[stack[-1]] + 1)
            if not m[3].endswith("/") or name in BLOCK:
                self._push(len(self.tag) - 1)

    def features(self) -> list[tuple[str, ...]]:
        """What the unary potentials see of each element."""
        n = len(self.tag)
        own, linked = [0] * n, [self.linked.get(i, 0) for i in range(n)]
        stops = [0] * n
        for i, text in self.texts:
            if i >= 0:
                own[i] += len(text)
                stops[i] += text.count(". ") + text.count(",")
        total, stop_total = own[:], stops[:]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            total[p] += total[i]
            stop_total[p] += stop_total[i]
            linked[p] += total[i] if self.tag[i] == "a" else linked[i]
        beside = self._beside(total, linked)
        out, inside = [], [""] * n  # the element that means boilerplate around this one: a heading in a header is not one of the text
        for i in range(n):
            size, p = total[i], self.parent[i]
            if i:
                inside[i] = f" in {self.tag[p]}" if self.tag[p] in IS_BOILERPLATE else inside[p]
            got = [f"is {self.tag[i]}{inside[i]}", f"tag {self.tag[i]}{inside[i]} {10 * min(linked[i], size) // size // 3 if size else '-'}"]
            if self.attrs[i]:
                got += named(self.attrs[i])
            got.append(f"beside {beside[i]} {'linked' if 2 * linked[i] > size else 'text'}")
            got.append(f"size {min(size // 40, 4) if size < 200 else 5 + min(size // 400, 4)}")
            if size:
                got.append(f"stops {min(4, 200 * stop_total[i] // size)}")
            out.append(tuple(got))
        return out

    def _beside(self, total: list[int], linked: list[int]) -> list[str]:
        """For each element the prose (text without links) of the nearest siblings before and after that have any text:

        none, little or much. An element alone in its parent stands where its parent does.
        """
        n = len(self.tag)
        grade = [min(2, (total[i] - min(linked[i], total[i]) + 39) // 40) for i in range(n)]
        before, after, last = ["-"] * n, ["-"] * n, {}
        for i in range(1, n):
            p = self.parent[i]
            before[i] = last.get(p, before[p] if p else "-")
            if total[i]:
                last[p] = str(grade[i])
        last = {}
        for i in sorted(range(1, n), key=lambda i: (self.depth[i], -i)):
            p = self.parent[i]
            after[i] = last.get(p, after[p] if p else "-")
            if total[i]:
                last[p] = str(grade[i])
        return [b + a for b, a in zip(before, after, strict=True)]

    def text(self, kept: list[bool]) -> str:
        blocks, block = [], []
        for i, piece in [*self.texts, (-1, "")]:
            if i >= 0:
                if kept[i]:
                    block.append(html.unescape(piece) if "&" in piece else piece)
            elif block:
                if line := " ".join("".join(block).split()):
                    blocks.append(line)
                block = []
        return "\n".join(blocks)


def named(attributes: str) -> list[str]:
    """Feature words of an element's class, id and role, and whether it is hidden."""
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id", "role"):
            out += {"name " + w.lower() for w in NAME_WORDS.findall(value)}
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            out.append("hidden")
    return out


def levels_of(parent: np.ndarray) -> list[np.ndarray]:
    """The elements of each depth; an element stands behind its parent, which is -1 for a page."""
    depth = [0] * len(parent)
    for i, p in enumerate(parent.tolist()):
        depth[i] = depth[p] + 1 if p >= 0 else 0
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1])


def sum_product(own: np.ndarray, pair: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each element's states, and those of (parent, child) states summed over all pairs."""
    up, belief, pairs = np.zeros_like(own), own.copy(), np.zeros((3, 3))
    for level in levels[:0:-1]:
        message = np.logaddexp.reduce(pair[None] + belief[level][:, None, :], axis=2)
        up[level] = message
        np.add.at(belief, parent[level], message)
    for level in levels[1:]:
        above = belief[parent[level]] - up[level]
        both = pair[None] + above[:, :, None] + belief[level][:, None, :]
        both -= np.logaddexp.reduce(both.reshape(len(level), -1), axis=1)[:, None, None]
        pairs += np.exp(both).sum(axis=0)
        belief[level] += np.logaddexp.reduce(pair[None] + above[:, :, None], axis=1)
    belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True)
    return np.exp(belief), pairs


class Model:
    """Unary weights of features by state and potentials of parent and child.

    They are fitted together, to make the labels of whole pages likely (by the gradient of the exact likelihood, which
    sum-product gives, with a quadratic penalty). So features that say the same share their weight, which counting each on
    its own would give to all of them. What labels rule out (anything but boilerplate below boilerplate) has a fixed
    potential.
    """

    def __init__(self, examples: list[tuple[Tree, list[int]]], rounds: int = ROUNDS, penalty: float = PENALTY):
        known: dict[str, int] = {}
        at, feature, parent, label, base = [], [], [], [], 0
        for tree, labels in examples:
            for i, seen in enumerate(tree.features()):
                at += [base + i] * len(seen)
                feature += [known.setdefault(f, len(known)) for f in seen]
                parent.append(base + tree.parent[i] if i else -1)
            label += labels
            base += len(labels)
        at, feature, parent, y = (np.array(x, dtype=np.int64) for x in (at, feature, parent, label))
        n, below = len(y), np.flatnonzero(parent >= 0)
        truth = np.eye(3)[y]
        levels = levels_of(parent)
        weight, bias, pair = np.zeros((len(known), 3)), np.zeros(3), np.zeros((3, 3))
        ruled_out = np.zeros((3, 3), dtype=bool)
        ruled_out[BOILERPLATE, [CONTENT, MIXED]] = True
        counted = np.zeros((3, 3))
        np.add.at(counted, (y[parent[below]], y[below]), 1)
        steps = [np.zeros_like(w) for w in (weight, bias, pair) for _ in range(2)]
        for r in range(1, rounds + 1):
            pair[ruled_out] = NEVER
            own = np.tile(bias, (n, 1))
            for k in range(3):
                own[:, k] += np.bincount(at, weight[feature, k], n)
            belief, pairs = sum_product(own, pair, parent, levels)
            off = belief - truth
            slopes = [np.stack([np.bincount(feature, off[at, k], len(known)) for k in range(3)], axis=1) + penalty * weight, off.sum(axis=0), pairs - counted + penalty * pair]
            slopes[2][ruled_out] = 0
            for j, (w, slope) in enumerate(zip((weight, bias, pair), slopes, strict=True)):  # steps scaled by each slope's mean and spread
                steps[2 * j] = 0.9 * steps[2 * j] + 0.1 * slope
                steps[2 * j + 1] = 0.99 * steps[2 * j + 1] + 0.01 * slope**2
                w -= RATE * (steps[2 * j] / (1 - 0.9**r)) / (np.sqrt(steps[2 * j + 1] / (1 - 0.99**r)) + 1e-9)
        pair[ruled_out] = NEVER
        self.prior, self.pair = bias, pair
        self.weight = {f: weight[i] for f, i in known.items()}
        self.seen: dict[tuple[str, ...], np.ndarray] = {}

    def unary(self, seen: tuple[str, ...]) -> np.ndarray:
        if (hit := self.seen.get(seen)) is None:
            hit = self.prior + sum((self.weight[f] for f in seen if f in self.weight), np.zeros(3))
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[seen] = hit
        return hit

    def marginals(self, trees: list[Tree]) -> list[np.ndarray]:
        """Sum-product over all trees at once; marginals of the states for each element."""
        starts = np.cumsum([0, *(len(t.tag) for t in trees)])
        parent = np.concatenate([np.where(np.array(t.parent) < 0, -1, np.array(t.parent) + s) for t, s in zip(trees, starts, strict=False)])
        own = np.array([self.unary(f) for t in trees for f in t.features()])
        return np.split(sum_product(own, self.pair, parent, levels_of(parent))[0], starts[1:-1])

    def extract(self, sources: list[str | None]) -> list[str]:
        trees = [Tree(s or "") for s in sources]
        if not trees:
            return []
        return [t.text((m[:, CONTENT] > m[:, BOILERPLATE]).tolist()) for t, m in zip(trees, self.marginals(trees), strict=True)]


# Labelled pages.
IS_CONTENT = {"article"}
IS_BOILERPLATE = set("aside button dialog fieldset footer form header input label menu nav search select".split())
AD_NAMES = {"name ad", "name ads", "name advert", "name sponsored", "name banner"}
Y = re.compile(rf'{SIGN}="([01])"')

# Boilerplate of known kind, put before, into or after the article of training pages; {} is text of another page, and
# data-y states the label.
EXTRA = [
    '<header data-y="0"><h2>{}</h2></header>',
    '<header data-y="0"><h1>{}</h1></header>',
    '<header data-y="0"><h2>{}</h2><p>{}</p></header>',
    '<header data-y="0"><h1><a href="/">{}</a></h1><p>{}</p></header>',
    '<header data-y="0"><div><strong>{}</strong></div><p>{}</p></header>',
    '<header data-y="0" class="site-header"><a href="/">{}</a></header>',
    '<aside data-y="0" class="sidebar widget-area"><h3>{}</h3><ul><li><a href="/x">{}</a></li></ul><p>{}</p></aside>',
    '<div data-y="0" id="sidebar"><h4>{}</h4><p>{}</p><p><a href="/y">{}</a></p></div>',
    '<div data-y="0" class="cookie-notice consent" role="dialog"><p>{} {}</p><button>{}</button></div>',
    '<div data-y="0" class="notice alert newsletter subscribe popup modal"><p>{} {} {}</p></div>',
    '<section data-y="0" id="comments" class="comments comment-list discussion"><h3>{}</h3><div class="comment"><p>{} {} {}</p></div><div class="comment reply"><p>{} {}</p></div></section>',
    '<ol data-y="0" class="comment-list responses"><li class="comment"><p>{} {} {} {}</p></li></ol>',
    '<section data-y="0" class="comments"><ul><li><p>{}</p></li><li><p>{} {}</p></li></ul></section>',
    '<div data-y="0" class="comments-area" id="comments"><h2>{}</h2><ul><li><p>{} {}</p></li><li><p>{}</p></li></ul></div>',
    '<div data-y="0" class="comments replies responses discussion"><ul><li><p>{}</p></li><li><p>{} {}</p></li></ul></div>',
    '<ol data-y="0" class="comments comment-list"><li><p>{}</p></li><li><p>{} {} {}</p></li></ol>',
    '<section data-y="0"><h2>3 Comments</h2><p>{}</p><p>{}</p></section>',
    '<h2 data-y="0">Related</h2><ul data-y="0"><li><a href="/u">{}</a></li><li><a href="/v">{} {}</a></li></ul>',
    '<h3 data-y="0">{}</h3><ul data-y="0" class="links"><li><a href="/u">{}</a></li></ul>',
    '<div data-y="0"><h2>Related</h2><ul><li><a href="/u">{}</a></li><li><a href="/v">{}</a></li></ul></div>',
    '<form data-y="0" action="/s" class="search login"><label>{}</label><input name="q"><button>{}</button></form>',
    '<div data-y="0" class="share social related more recommended promo sponsored"><a href="/z">{}</a> <a href="/w">{}</a></div>',
    '<div data-y="0" class="breadcrumb breadcrumbs menu navigation navbar topbar" role="navigation"><a href="/">{}</a> &gt; <a href="/k">{}</a></div>',
    '<div data-y="0" class="footer copyright legal bottom" id="footer" role="contentinfo"><p>&copy; {}</p></div>',
    '<div data-y="0" class="ads advert advertisement banner sponsor"><p>{} {}</p></div>',
    '<div data-y="0" class="header masthead banner top" id="header" role="banner"><p>{}</p></div>',
]
# Mark-up of article text that the sample's articles may lack.
INNER = [
    "<h2>{}</h2><ul><li>{} {}</li><li>{}</li></ul><p>{} {} {} {}</p>",
    '<ul><li>{} {}</li><li>{} {} {}</li></ul><blockquote><p>{} {} {}</p></blockquote><p>{} {} <a href="/r">{}</a> {} {}</p>',
    "<h3>{}</h3><table><tr><th>{}</th><td>{}</td></tr><tr><td>{}</td><td>{}</td></tr></table><p>{}</p>",
    '<div class="section"><p>{} {}</p><ol><li>{} {} {}</li><li>{} {}</li></ol></div><p><em>{}</em> {} <strong>{}</strong></p>',
    '<figure><img src="i"><figcaption>{}</figcaption></figure><pre><code>{} {}</code></pre><p>{} <a href="/q">{}</a> {} <i>{}</i></p>',
    "<section><h2>{}</h2><p>{}</p><ul><li>{}</li><li>{} {}</li></ul><p>{}</p></section><dl><dt>{}</dt><dd>{} {}</dd></dl>",
    '<p><a href="/l">{}</a> <a href="/m">{}</a></p><p>{} {} {} {}</p><ul><li><a href="/n">{}</a></li><li><a href="/o">{}</a></li></ul><p>{} {} {}</p>',
    '<table><tr><td><a href="/l">{}</a></td><td><a href="/m">{}</a></td></tr></table><p>{} {} {}</p><ol><li><a href="/n">{}</a></li></ol><p>{} {}</p>',
    '<details><summary>{}</summary><p>{} {}</p></details><p>{} <span class="related note">{}</span> {} {}</p><blockquote><p><a href="/b">{}</a></p></blockquote><p>{} {}</p>',
]
WRAPPERS = ["", '<div class="wrap container">', '<div class="container main wrap"><div class="row inner">', '<div id="page" class="layout row">', '<div class="site wrapper"><div class="col columns">']
BODIES = [
    ("article", ""), ("main", ""), ("main", ' role="main" id="main"'), ("div", ' class="post-content entry-content"'), ("div", ' id="content" class="article-body story text"'),
    ("section", ' class="post entry"'), ("section", ""), ("section", ' class="entry text"'), ("div", ' class="content main-content page-content"'), ("div", ' itemprop="articleBody" class="body"'),
]


def labels_of(tree: Tree) -> list[int]:
    """States of a labelled page's elements: those that the mark-up states, what they hold, and containers of both."""
    n = len(tree.tag)
    label: list[int | None] = [None] * n
    for i in range(1, n):
        above = label[tree.parent[i]]
        if m := Y.search(tree.attrs[i]):
            label[i] = int(m[1])
        elif above == BOILERPLATE or tree.tag[i] in IS_BOILERPLATE or (tree.attrs[i] and AD_NAMES & set(named(tree.attrs[i]))):
            label[i] = BOILERPLATE
        else:
            label[i] = CONTENT if above == CONTENT or tree.tag[i] in IS_CONTENT else None
    has = [set() if x is None else {x} for x in label]
    for i in range(n - 1, 0, -1):
        if label[i] is None:
            label[i] = MIXED if len(has[i]) != 1 else next(iter(has[i]))
        has[tree.parent[i]] |= has[i]
    return [MIXED, *label[1:]]


def one_name(template: str, k: int) -> str:
    """The template, or (for two of three ``k``) with one name in place of all in its first class, so that each is learnt

    alone: the first one, which is the most usual, in every other of these.
    """

    def chosen(m: re.Match) -> str:
        names = m[1].split()
        return f'class="{names[(k % 3 - 1) * (k // 3) % len(names)]}"' if k % 3 else m[0]

    return re.sub(r'class="([^"]*)"', chosen, template, count=1)


def variants(sources: list[str]) -> Iterator[str]:
    """The sample's pages, and each with another body element and further boilerplate around and in it."""
    sources = [s.replace(SIGN, "") for s in sources]
    texts = [t for s in sources for t in re.findall(r">([^<>]{15,80})<", s)] or ["text"]
    for k, source in enumerate(sources):
        yield source
        fill = lambda t, k=k: re.sub(r"\{\}", lambda m, c=[k * 7]: (c.__setitem__(0, c[0] + 1), texts[c[0] % len(texts)])[1], t.replace("data-y", SIGN))  # noqa: E731, B006
        for shift in (29, 0):
            tag, attrs = BODIES[(k + shift) % len(BODIES)]
            attrs = one_name(attrs, k // len(BODIES) + shift)
            extra = [fill(one_name(EXTRA[((k + shift) * 7 + j * 4) % len(EXTRA)], (k + shift) // 7 + j)) for j in range(6)]
            wrap, inner = one_name(WRAPPERS[(k + shift) % len(WRAPPERS)], k // len(WRAPPERS) + shift), fill(INNER[(k + shift) % len(INNER)])
            unwrap = "</div>" * wrap.count("<div")
            changed = re.sub(r"<article\b[^>]*>", lambda m: f'{extra[0]}{wrap}<{tag}{attrs} {SIGN}="1">', source)  # noqa: B023
            changed = re.sub(r"</article>", lambda m: f"{inner}{extra[1]}</{tag}>{extra[2]}{unwrap}{extra[3]}", changed)  # noqa: B023
            begin = max(0, changed.find(f'<{tag}{attrs} {SIGN}="1">'))
            head, *rest = re.split(r"(?<=</p>)", changed[begin:])
            yield changed[:begin] + head + extra[4] + "".join(rest[:2]) + extra[5] + "".join(rest[2:])
        # the same with little else around it
        start, end = changed.find(f'<{tag}{attrs} {SIGN}="1">'), changed.rfind(f"</{tag}>")
        short = re.sub(r"(?s)(<p\b.*?</p>).*?(?=<p\b)", r"\1", changed[start:end], count=3)
        yield f"<html><body>{extra[2]}{wrap}{short}</{tag}>{extra[3]}{unwrap}</body></html>"
        # a small article of its own
        small = fill(f"<h2>{{}}</h2><p>{' '.join(['{}'] * (2 + k % 7))}</p>{['', '<ul><li>{}</li></ul>', '<p>{} {}</p>'][k % 3]}")
        yield f"<html><body>{extra[0]}{wrap}<{tag}{attrs} {SIGN}=\"1\">{small}</{tag}>{extra[2]}{unwrap}{extra[3]}</body></html>"
        # and with no element around the article's own
        bare = re.sub(rf"<(p|h1|h2|h3|ul|ol|table|blockquote|pre|figure)\b(?! {SIGN})", rf'<\1 {SIGN}="1"', short[short.find(">") + 1 :])
        yield f"{extra[3] if k % 2 else ''}{bare}{extra[0] if k % 3 else ''}"


#: Labelled pages that stand in for the sample where no page states what is what.
STAND_IN = [
    f"<html><body><nav><ul><li><a href='/'>To the first page of all</a></li></ul></nav><article><h1>What is told of number {i}</h1>"
    + "".join(f"<p>Here follows a paragraph of some length, with commas, and with stops. It is number {j} of {i}, and goes on for a while.</p>" for j in range(i))
    + "</article><footer>&copy; those who wrote all of it</footer></body></html>"
    for i in range(2, 8)
]


def train(pages: DataFrame, html_col: str = "html", n: int = SAMPLE_PAGES) -> Model:
    """A model from the labelled sample; at most ``n`` pages come to the driver."""
    fit = pages.where(F.col(html_col).contains("<article") & (F.length(html_col) < 100_000)).select(html_col)
    trees = [Tree(s) for s in variants([r[0] for r in hash_sample(fit, html_col, n).collect()] or STAND_IN)]
    return Model([(t, labels_of(t)) for t in trees if max(t.depth) <= SAMPLE_DEPTH])


def extract_text(pages: DataFrame, model: Model, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every page and its main ``text``."""
    keep = keep or ["page_id", "url"]
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH_PAGES):
                part = batch.iloc[at : at + BATCH_PAGES]
                yield part.drop(columns="__html").assign(text=shared.value.extract(part["__html"].tolist()))

    plain = pages.select(*keep, F.col(html_col).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != "__html")
    return whole_texts(plain).mapInPandas(run, f"{schema}, text string")
