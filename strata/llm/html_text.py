"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded from the root down.

A page is read into a tree of block elements; inline markup only adds to the text of its block. Scripts, styles,
comments and controls are markup and never text; the text of math, object, audio and video is text. Each node has features: kind of element, meaning of its class, id
and role words, the same for its ancestors, depth, text and link density of its subtree, and how it compares with
its siblings and the page. Boosted trees give the probability that a node holds main text. The
decoder picks the most likely labelling in which a node is kept only if its parent is kept, by one
pass over the tree, so no kept block hangs in a dropped one.

Training pages are made of the table's own pages: at most ``PAGES`` of them (smallest hash of their id) give article
blocks, menu, advert and footer texts, and these are set into many layouts, with telling names, plain ones and
none, in which every node's label is known. The fit is small and runs on the driver; pages are extracted
where they are read, and nothing is shuffled.

Nulls and odd rows: a null or empty page, and one without text, gives an empty string. Broken and unclosed
markup is closed where the next block requires it; only a script or style left open runs to the end of the page. Repeated rows get a row each. An empty table gives no rows.
Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that the fit may see, and layouts made of each.
PAGES = 160
LAYOUTS = 4

# Elements by what they are.
_GROUPS = {
    "p": "p", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "item": "li dd dt", "list": "ul ol dl menu", "div": "div center",
    "section": "section", "article": "article main", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
    "form": "form fieldset label legend", "table": "table tbody thead tfoot tr td th caption", "quote": "blockquote pre figure figcaption address details summary",
    "root": "body html",
}
_TAG_GROUP = {tag: group for group, tags in _GROUPS.items() for tag in tags.split()}
_GROUP_INDEX = {group: i for i, group in enumerate(_GROUPS)}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script style noscript template title textarea select button iframe svg canvas"
_SELF_CLOSED = {"svg", "iframe"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Words in class, id and role that tell what an element is for.
_MEANINGS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pagination pager toc skip",
    "advert": "ad ads advert advertisement adsense banner promo promotion sponsor sponsored commercial dfp partner",
    "foot": "footer foot colophon copyright legal imprint bottom",
    "head": "header head masthead logo branding brand top",
    "side": "sidebar side aside widget widgets rail complementary related recommended recommendations more popular trending tags",
    "notice": "notice cookie cookies consent gdpr banner alert popup modal overlay message warning disclaimer paywall",
    "form": "form search login signin signup subscribe subscription newsletter register contact",
    "comment": "comment comments commentlist reply replies respond discussion disqus thread feedback reviews",
    "share": "share sharing social follow tweet facebook buttons actions meta byline",
    "main": "article content main post entry story body text page single hentry prose maincontent articlebody",
}
_WORD_MEANING: dict[str, int] = {}
for _i, (_, _words) in enumerate(_MEANINGS.items()):
    for _w in _words.split():
        _WORD_MEANING[_w] = _WORD_MEANING.get(_w, 0) | 1 << _i
_N_GROUPS, _N_MEANINGS = len(_GROUPS), len(_MEANINGS)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(_RAW.split()) + r")(?=[\s/>])[^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>",
    re.S | re.I,
)
# Where a raw element ends; a second button or select says that the first was left open.
_RAW_ENDS = {
    t: re.compile(rf"</{t}\s*>" + (rf"|<{t}(?=[\s/>])" if t in ("button", "select") else ""), re.I) for t in _RAW.split()
}
_BLOCK_TAG = re.compile(r"</?(?:" + "|".join(_TAG_GROUP) + r")(?=[\s/>])", re.I)
_ATTR = re.compile(r"\b(class|id|role|data-keep)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_INLINE_BREAK = {"br", "hr", "img", "wbr", "input"}


@dataclass
class Node:
    tag: str
    parent: Node | None
    depth: int
    meaning: int = 0
    keep: str | None = None
    #: Texts and child nodes in page order.
    parts: list = field(default_factory=list)
    links: int = 0
    n_links: int = 0

    def blocks(self, kept: set[int] | None = None) -> Iterator[str]:
        """The texts of the blocks below, in page order, white space collapsed."""
        run: list[str] = []
        waiting = [iter(self.parts)]
        while waiting:
            for part in waiting[-1]:
                if isinstance(part, str):
                    run.append(part)
                    continue
                yield from _block("".join(run))
                run = []
                if kept is None or id(part) in kept:
                    waiting.append(iter(part.parts))
                    break
            else:
                waiting.pop()
                yield from _block("".join(run))
                run = []


def _block(text: str) -> Iterator[str]:
    words = text.split()
    if words:
        yield " ".join(words)


def _meaning(attrs: str) -> tuple[int, str | None]:
    found, keep = 0, None
    for name, a, b, c in _ATTR.findall(attrs):
        value = a or b or c
        if name.lower() == "data-keep":
            keep = value
            continue
        for word in _NAME_WORDS.findall(value):
            found |= _WORD_MEANING.get(word.lower(), 0)
    return found, keep


def _raw_end(source: str, at: int, tag: str, missing: set[str]) -> int:
    """Where the raw element ends whose content starts at ``at``; ``missing`` collects the tags without a further end."""
    if tag not in missing:
        end = _RAW_ENDS[tag].search(source, at)
        if end and end[0][1] == "/":
            return end.end()
        if not end:
            missing.add(tag)
    if tag in ("script", "style"):
        return len(source)  # tags in it are code
    block = _BLOCK_TAG.search(source, at)
    return block.start() if block else len(source)


def parse(source: str) -> tuple[Node, list[Node]]:
    """The root and all nodes in page order, the root first. Markup of any quality gives a tree."""
    root = node = Node("body", None, 0)
    nodes, at, anchors = [root], 0, 0
    missing: set[str] = set()

    def say(raw: str) -> None:
        nonlocal node
        text = html.unescape(raw) if "&" in raw else raw
        node.parts.append(text)
        if anchors:
            node.links += len(text.strip())

    # Behind the last ">" no tag can end, and there is none to look for.
    stop = source.rfind(">") + 1
    while token := _TOKEN.search(source, at, stop):
        if token.start() > at:
            say(source[at : token.start()])
        at = token.end()
        if at == stop and token[0].startswith("<!--") and not token[0].endswith("-->"):
            at = len(source)
        if token["raw"]:
            raw = token["raw"].lower()
            if raw not in _SELF_CLOSED or not token[0].endswith("/>"):
                at = _raw_end(source, at, raw, missing)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in _TAG_GROUP:
            if tag == "a":
                anchors = 0 if token["end"] else 1
                node.n_links += anchors
            elif tag in _INLINE_BREAK:
                node.parts.append(" ")
            continue
        if tag in ("html", "body"):
            continue
        anchors = 0
        if token["end"]:
            open_node = node
            while open_node is not root and open_node.tag != tag:
                open_node = open_node.parent
            if open_node is not root:
                node = open_node.parent
            continue
        if node.tag == "p" or node.tag[0] == "h" and tag[0] == "h" and _TAG_GROUP[node.tag] == _TAG_GROUP[tag] == "heading":
            node = node.parent
        if tag in _CLOSES:
            while node.tag in _CLOSES[tag] and node.parent:
                node = node.parent
        meaning, keep = _meaning(token["attrs"]) if token["attrs"].strip() else (0, None)
        child = Node(tag, node, node.depth + 1, meaning, keep)
        node.parts.append(child)
        nodes.append(child)
        node = child
    rest = source[at:].split("<!--", 1)[0]
    if rest:
        say(rest)
    return root, nodes


FEATURES = 2 * _N_GROUPS + 2 * _N_MEANINGS + 18


def features(nodes: list[Node]) -> np.ndarray:
    """One row of features per node, the root included."""
    n = len(nodes)
    place = {id(x): i for i, x in enumerate(nodes)}
    parent = np.array([place[id(x.parent)] if x.parent else 0 for x in nodes])
    own = np.zeros((n, 5))  # characters, words, link characters, links, stops
    for i, x in enumerate(nodes):
        text = "".join(p for p in x.parts if isinstance(p, str)).strip() if x.parts else ""
        if text:
            own[i, 0], own[i, 1] = len(text), text.count(" ") + 1
            own[i, 4] = text.count(".") + text.count(",") + text.count("!") + text.count("?")
        own[i, 2], own[i, 3] = x.links, x.n_links
    total, size, paragraphs = own.copy(), np.ones(n), np.zeros(n)
    group = np.array([_GROUP_INDEX[_TAG_GROUP[x.tag]] for x in nodes])
    meaning = np.array([x.meaning for x in nodes])
    paragraphs[group == _GROUP_INDEX["p"]] = 1
    for i in range(n - 1, 0, -1):  # children stand behind their parents
        up = parent[i]
        total[up] += total[i]
        size[up] += size[i]
        paragraphs[up] += paragraphs[i]
    group_bits, above_groups, above_meaning = 1 << group, np.zeros(n, int), np.zeros(n, int)
    before, order, n_children = np.zeros(n), np.zeros(n), np.zeros(n)
    last_text, last_child, next_text = np.zeros(n), np.full(n, -1), np.zeros(n)
    passed = 0.0
    for i in range(n):
        up = parent[i]
        before[i] = passed
        passed += own[i, 0]
        if i:
            above_groups[i] = above_groups[up] | group_bits[up]
            above_meaning[i] = above_meaning[up] | meaning[up]
            order[i] = n_children[up]
            n_children[up] += 1
            if last_child[up] >= 0:
                last_text[i] = total[last_child[up], 0]
                next_text[last_child[up]] = total[i, 0]
            last_child[up] = i
    page = max(total[0, 0], 1.0)
    chars = total[:, 0]
    sibling_mean = (total[parent, 0] - own[parent, 0]) / np.maximum(n_children[parent], 1)
    bits = lambda flags, k: (flags[:, None] >> np.arange(k) & 1).astype(float)
    numbers = np.stack(
        [
            np.log1p(chars), np.log1p(total[:, 1]), total[:, 2] / np.maximum(chars, 1), np.log1p(total[:, 3]),
            total[:, 4] / np.maximum(total[:, 1], 1), chars / size, chars / page, np.minimum([x.depth for x in nodes], 30),
            n_children, order, order / np.maximum(n_children[parent] - 1, 1), paragraphs, np.log1p(last_text), np.log1p(next_text),
            np.log1p(sibling_mean), total[parent, 2] / np.maximum(total[parent, 0], 1), before / page, own[:, 0] / np.maximum(chars, 1),
        ],
        axis=1,
    )
    return np.hstack([bits(group_bits, _N_GROUPS), bits(above_groups, _N_GROUPS), bits(meaning, _N_MEANINGS), bits(above_meaning, _N_MEANINGS), numbers])


@dataclass
class Boosted:
    """Complete trees of one depth: a feature and a limit per inner node, a value per leaf."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            at = np.zeros(len(x), int)
            while at.size and at[0] < len(feature):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            score += value[at - len(feature)]
        return score


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 2.0) -> Boosted:
    """Gradient boosting of the logistic loss with histograms of quantile bins."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    n, width = codes.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score, inner = np.full(n, base), 2**depth - 1
    feature, limit, value = np.zeros((trees, inner), int), np.zeros((trees, inner)), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, curve = p - y, p * (1 - p) + 1e-6
        at = np.zeros(n, int)
        for level in range(depth):
            first, cells = 2**level - 1, 2**level
            slot = (at - first) * bins
            best = np.full(cells, -1.0)
            for f in range(width):
                key = slot + codes[:, f]
                g = np.bincount(key, grad, cells * bins).reshape(cells, bins).cumsum(axis=1)
                h = np.bincount(key, curve, cells * bins).reshape(cells, bins).cumsum(axis=1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + l2) + (whole_g - g) ** 2 / (whole_h - h + l2) - whole_g**2 / (whole_h + l2)
                gain[:, len(edges[f]) :] = -1.0
                cut = gain.argmax(axis=1)
                gained = gain[np.arange(cells), cut]
                better = gained > best + 1e-9
                best[better] = gained[better]
                for c in np.flatnonzero(better):
                    feature[t, first + c], limit[t, first + c] = f, edges[f][cut[c]] if len(edges[f]) else np.inf
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > limit[t, at])
        leaf = at - inner
        value[t] = -rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, curve, inner + 1) + l2)
        score += value[t, leaf]
    return Boosted(base, feature, limit, value)


def decode(nodes: list[Node], logits: np.ndarray) -> set[int]:
    """Ids of the kept nodes in the likeliest labelling in which every kept node's parent is kept."""
    place = {id(x): i for i, x in enumerate(nodes)}
    yes, no = -np.logaddexp(0, -logits), -np.logaddexp(0, logits)
    for i in range(len(nodes) - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        yes[up] += max(yes[i], no[i])
        no[up] += no[i]
    kept = {id(nodes[0])}
    for i, x in enumerate(nodes[1:], 1):
        if id(x.parent) in kept and yes[i] >= no[i]:
            kept.add(id(x))
    return kept


# --- training pages -----------------------------------------------------------------------------------------------


def _pools(pages: list[str]) -> tuple[list[list[str]], list[str], list[str]]:
    """Articles as lists of blocks, short boilerplate texts and longer ones, from what the pages mark up."""
    articles, short, long = [], [], []
    for source in pages:
        _, nodes = parse(source)
        marked = [x for x in nodes if x.tag in ("article", "main")]
        if marked:
            articles.append(list(max(marked, key=lambda x: sum(map(len, x.blocks()))).blocks()))
        else:
            articles.append([b for x in nodes if x.tag == "p" and not x.links for b in x.blocks()])
        for x in nodes:
            if x.tag in ("nav", "aside", "footer", "header", "form") or x.meaning and not x.meaning >> _N_MEANINGS - 1 & 1:
                for text in x.blocks():
                    (short if len(text) < 25 else long).append(text)
    return [a for a in articles if a], short or ["Home", "About"], long or ["All rights reserved."]


def _marked(nodes: list[Node]) -> set[int]:
    """Ids of the nodes in or around the page's only article or main element; empty if there is none."""
    marked = [x for x in nodes if x.tag in ("article", "main")]
    if len(marked) != 1:
        return set()
    inside = {id(marked[0])}
    for x in nodes:
        plain = x.tag not in ("nav", "header", "footer", "aside", "form") and not x.meaning & ~(1 << _N_MEANINGS - 1)
        if x.parent and id(x.parent) in inside and plain:
            inside.add(id(x))
    above = marked[0].parent
    while above:
        inside.add(id(above))
        above = above.parent
    return inside


class _Layouts:
    """Random pages around given blocks; ``data-keep`` on every element says what belongs to the article."""

    def __init__(self, pools: tuple[list[list[str]], list[str], list[str]], seed: int) -> None:
        self.articles, self.short, self.long = pools
        self.rng = np.random.default_rng(seed)

    def pick(self, options: list):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def name(self, meaning: str) -> str:
        """An attribute that tells, one that does not, or none."""
        if self.chance(0.12):
            return ""
        if self.chance(self.blank):
            return f' class="{self.pick(["x", "c", "box", "row", "wrap", "col", "inner", "block"])}{int(self.rng.integers(99))}"'
        word = self.pick(_MEANINGS[meaning].split())
        word = self.pick([word, f"site-{word}", f"{word}-box", f"{word}s", f"{word} wide", f"the_{word}"])
        return f' {self.pick(["class", "class", "id", "role"])}="{word}"'

    def element(self, tag: str, attrs: str, inside: str, keep: int) -> str:
        return f'<{tag}{attrs} data-keep="{keep}">{inside}</{tag}>'

    def text(self, long: bool) -> str:
        return html.escape(self.pick(self.long if long else self.short))

    def paragraphs(self, most: int) -> str:
        """Paragraphs of other articles, as a reader's comments or teasers would be."""
        blocks = self.pick(self.articles)
        start = int(self.rng.integers(len(blocks)))
        return "".join(self.element("p", "", html.escape(b), 0) for b in blocks[start : start + int(self.rng.integers(1, most + 1))])

    def links(self) -> str:
        items = [f'<a href="/x">{self.text(self.chance(0.1))}</a>' for _ in range(int(self.rng.integers(2, 9)))]
        if self.chance(0.7):
            return self.element("ul", "", "".join(self.element("li", "", i, 0) for i in items), 0)
        return " ".join(items)

    def part(self, meaning: str) -> str:
        tags = {"menu": ["nav"], "foot": ["footer"], "head": ["header"], "side": ["aside"], "form": ["form"], "comment": ["section"], "notice": ["aside", "section"]}
        tag = self.pick(tags.get(meaning, ["div"])) if self.chance(0.5) else "div"
        line = lambda: self.pick([self.text(True), self.element("p", "", self.text(True), 0)])
        if meaning in ("menu",):
            inside = self.links()
        elif meaning == "foot":
            inside = "&copy; " + line() + (self.links() if self.chance(0.4) else "") + (line() if self.chance(0.4) else "")
        elif meaning == "head":
            inside = (self.element("div", self.name("head"), self.text(False), 0) if self.chance(0.6) else "") + line() + (self.part("menu") if self.chance(0.5) else "")
        elif meaning == "side":
            inside = self.element(self.pick(["h2", "h3", "div"]), "", self.text(False), 0) + self.links() + (self.paragraphs(2) if self.chance(0.4) else "")
        elif meaning == "form":
            inside = self.element("label", "", self.text(False), 0) + "<input name=q>" + (line() if self.chance(0.6) else "") + "<button>ok</button>"
        elif meaning == "comment":
            one = lambda: self.element(self.pick(["div", "li", "article"]), self.name("comment"), (self.text(False) if self.chance(0.5) else "") + self.paragraphs(2), 0)
            inside = (self.element("h3", "", self.text(False), 0) if self.chance(0.6) else "") + "".join(one() for _ in range(int(self.rng.integers(1, 6))))
        else:
            inside = line() + (self.links() if self.chance(0.2) else "")
        return self.element(tag, self.name(meaning), inside, 0)

    def page(self, blocks: list[str]) -> str:
        self.blank = self.pick([0.0, 0.05, 0.3])
        body = []
        if self.chance(0.3):  # the title is often the first line again
            blocks = blocks[:1] + blocks
        noise = self.pick(["!!", "***", "...", " |", "&"]) if self.chance(0.15) else ""
        for i, block in enumerate(blocks):
            if self.chance(0.08):  # a stray line of a few words
                block = " ".join(block.split()[: int(self.rng.integers(1, 5))])
            if noise and self.chance(0.8):
                block = " ".join(word + noise for word in block.split())
            safe = html.escape(block.upper() if noise and self.chance(0.3) else block)
            if i == 0 and self.chance(0.8):
                body.append(self.element(self.pick(["h1", "h1", "h2"]), "", safe, 1))
            elif self.chance(0.06):
                body.append(self.element("ul", "", self.element("li", "", safe, 1), 1))
            elif self.chance(0.04):
                body.append(self.element("blockquote", "", safe, 1))
            else:
                body.append(self.element("p", "", f"<b>{safe}<br>" if self.chance(0.1) else safe, 1))
            if self.chance(0.06):
                body.append(self.part(self.pick(["advert", "side", "share", "notice", "form"])))
        article = self.element(self.pick(["article", "article", "main", "div", "section"]), self.name("main") if self.chance(0.7) else "", "".join(body), 1)
        top = [self.part(m) for m in ("notice", "head", "menu", "advert", "menu") if self.chance(0.45)]
        low = [self.part(m) for m in ("share", "side", "comment", "form", "advert", "notice") if self.chance(0.4)]
        middle = article
        for _ in range(int(self.rng.integers(0, 3))):
            around = [self.part("side")] if self.chance(0.4) else []
            if self.chance(0.3) and low:
                around.append(low.pop())
            if self.chance(0.3) and top:
                middle = top.pop() + middle
            tag, attrs = self.pick(["div", "div", "section", "main"]), self.name("main") if self.chance(0.6) else ""
            middle = self.element(tag, attrs, middle + "".join(around), 1)
        foot = self.part("foot") if self.chance(0.85) else ""
        return "<body>" + "".join(top) + middle + "".join(low) + foot


def fit(pages: list[str], layouts: int = LAYOUTS, seed: int = 0) -> Boosted:
    pools = _pools(pages)
    rows, labels = [], []
    if pools[0]:
        maker = _Layouts(pools, seed)
        for blocks in pools[0]:
            for _ in range(layouts):
                most = maker.pick([3, len(blocks), len(blocks)])
                part = blocks[: int(maker.rng.integers(1, most + 1))] if maker.chance(0.6) else blocks
                _, nodes = parse(maker.page(part))
                rows.append(features(nodes)[1:])
                labels.append(np.array([x.keep == "1" for x in nodes[1:]], float))
        for source in pages:  # as they are, where they mark their article
            _, nodes = parse(source)
            inside = _marked(nodes)
            if inside:
                rows.append(features(nodes)[1:])
                labels.append(np.array([id(x) in inside for x in nodes[1:]], float))
    if not rows:
        return Boosted(0.0, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)))
    return boost(np.concatenate(rows), np.concatenate(labels))


def main_texts(pages: list[str | None], model: Boosted) -> list[str]:
    trees = [parse(p or "")[1] for p in pages]
    if not trees:
        return []
    rows = [features(nodes) for nodes in trees]
    logits = np.split(model.logit(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
    return ["\n".join(nodes[0].blocks(decode(nodes, own))) for nodes, own in zip(trees, logits)]


def _sample(rows: DataFrame, sample: int) -> list[str]:
    """Whole pages, as many as asked for, chosen by their ids: only the chosen ones leave their tasks."""
    marked = rows.where(F.length("html") > 0).withColumn("mark", F.xxhash64("html"))
    chosen = marked.select("page_id", "url", "mark").orderBy(F.xxhash64("page_id"), "page_id", "url", "mark").limit(sample).collect()
    if not chosen:
        return []
    place = {tuple(r): i for i, r in enumerate(chosen)}
    names = rows.sparkSession.createDataFrame(list(place), "page_id long, url string, mark long").toDF("i", "u", "m")
    same = F.col("page_id").eqNullSafe(F.col("i")) & F.col("url").eqNullSafe(F.col("u")) & (F.col("mark") == F.col("m"))
    found = marked.join(F.broadcast(names), same, "left_semi").dropDuplicates(["page_id", "url", "mark"]).collect()
    return [r.html for r in sorted(found, key=lambda r: place[r.page_id, r.url, r.mark])]


def extract(pages: DataFrame, sample: int = PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    model = fit(_sample(rows, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                texts = main_texts(part.column("html").to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
