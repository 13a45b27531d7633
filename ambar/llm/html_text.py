"""Main text of web pages by a graphical model over the document tree.

1. A page is read into a tree: block elements, and under them the stretches of text between block boundaries. Inline
   elements belong to their stretch. Scripts, styles, other raw elements, comments and markup never become text.
2. Each node is content or not. A node has evidence (its tag, hints in its class, id and role, how much of its text is in
   links, how long it is), and each parent-child edge a potential by the kind of the child, all of which are learned.
3. The sum-product algorithm passes messages from the leaves up and from the root down. That is exact on a tree and gives
   every node's marginal probability. All pages of a batch are passed level by level together, so deep pages don't recurse.
4. Stretches with a marginal of 0.5 or more are the text, a line each, in page order.

Weights maximise the conditional likelihood of labelled pages, whose gradient is the labels less the marginals. Labelled
pages are (a) up to ``FIT_PAGES`` pages of the table that mark up exactly one ``article`` or ``main`` element: what is in
it is content, except the kinds of blocks that never are; in every second one that element is renamed to ``div``, so that
the model learns to do without; (b) ``PRACTICE_PAGES`` pages composed here from the usual blocks with every part labelled.

Defined results: a missing, empty or text-free page has an empty text; broken markup is read the way browsers mostly do
(open paragraphs, items and cells are closed by the next one, unknown end tags are ignored, an open comment or script
reaches to the end); repeated pages get equal texts; very long pages are read whole; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import functools
import html
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.llm.common import map_batches, table

FIT_PAGES = 300
PRACTICE_PAGES = 400
STEPS, RIDGE = 250, 0.02

# The names of HTML's elements by how they are read.
RAW = "script style template noscript iframe textarea title noembed noframes xmp select object"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark output q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var svg math canvas audio video picture map meter progress slot nobr center".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "body": frozenset(["head"]),
}
SCOPES = frozenset("ul ol dl table html body div section article main aside nav header footer form".split())
# Kinds of tags, and words in class, id and role that hint at what a block is.
TAGS = {name: kind for kind, names in {
    "html": "html body", "article": "article main", "section": "section", "div": "div", "p": "p blockquote pre figcaption", "h1": "h1",
    "heading": "h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu", "item": "li dt dd", "table": "table tr td th thead tbody tfoot caption",
    "nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form fieldset legend dialog", "figure": "figure details summary address",
    "head": "head",
}.items() for name in names.split()}
HINTS = {word: kind for kind, words in {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs sitemap skip",
    "header": "header masthead topbar banner branding logo",
    "footer": "footer copyright legal colophon imprint contentinfo",
    "sidebar": "sidebar side aside rail related recommended recommendations widget popular trending more complementary",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall toast dialog",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promoted promotion banner-ad adsense dfp",
    "form": "form search login signin register contact",
    "comment": "comment comments commentary reply replies respond response discussion disqus thread feedback review reviews",
    "share": "share sharing social follow like tweet tags",
    "content": "article content main post entry story body text prose",
}.items() for word in words.split()}
NEVER = frozenset(["nav", "aside", "form", "footer"])

TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*)"
    rf"|<({RAW.replace(' ', '|')})(?=[\s/>])[^>]*>(?:.*?</\1(?=[\s/>])[^>]*>|.*)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

TAG_KINDS = [*dict.fromkeys(TAGS.values()), "#text", "other"]
HINT_KINDS = [*dict.fromkeys(HINTS.values())]
FACTS = ["linked", "half_linked", "short", "long", "very_long", "most_text", "sentence", "has_h1", "first_third", "only_child", "bias"]
FEATURES = [*[f"tag_{t}" for t in TAG_KINDS], *[f"hint_{h}" for h in HINT_KINDS], *FACTS]
PLACE = {name: i for i, name in enumerate(FEATURES)}
# Kinds of edges, by the child.
EDGES = ["text", "plain", "boundary", "content"]
LIMIT = 0.5


@functools.lru_cache(maxsize=100_000)
def hints_of(attributes: str) -> frozenset[str]:
    """Kinds of hints in the attributes of a start tag."""
    found = set()
    for _, value in ATTRIBUTE.findall(attributes):
        for word in WORDS.findall(value):
            kind = HINTS.get(word.lower())
            if kind:
                found.add(kind)
    return frozenset(found)


class Tree:
    """Nodes in page order: parent, kind of tag, hints; stretches of text with their length and the part in links."""

    def __init__(self, page: str | None):
        self.parent, self.tag, self.hints, self.text, self.linked, self.name = [-1], ["html"], [frozenset()], [""], [0], ["html"]
        if page:
            self.read(page)

    def add(self, parent: int, tag: str, name: str, hints=frozenset(), text: str = "", linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.name.append(name)
        self.hints.append(hints)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1

    def read(self, page: str) -> None:
        open_nodes, counts = [0], {"html": 1}  # the open blocks, and how many of them have each name
        parts, links, in_link, at = [], 0, False, 0

        def flush():
            nonlocal parts, links
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.add(open_nodes[-1], "#text", "#text", text=text, linked=min(links, len(text)))
                parts, links = [], 0

        def close(times: int):
            for _ in range(times):
                name = self.name[open_nodes.pop()]
                counts[name] -= 1

        def words(raw: str):
            nonlocal links
            if raw:
                raw = html.unescape(raw) if "&" in raw else raw
                parts.append(raw)
                if in_link:
                    links += len(raw.strip())

        for m in TOKEN.finditer(page):
            words(page[at : m.start()])
            at, name = m.end(), m[3]
            if name is None:
                continue
            name, end = name.lower(), bool(m[2])
            if name == "a":
                in_link = not end
            if name in INLINE:
                continue
            if name in VOID:
                if name in ("br", "img", "input", "wbr"):
                    parts.append(" " if name != "wbr" else "")
                elif name == "hr":
                    flush()
                continue
            flush()
            in_link = False
            if end:
                if counts.get(name):
                    depth = 1
                    while self.name[open_nodes[-depth]] != name:
                        depth += 1
                    if depth < len(open_nodes):  # the root stays
                        close(depth)
                continue
            if name == "html":
                continue
            # What an open paragraph, item or cell is closed by.
            if counts.get("p") and self.name[open_nodes[-1]] == "p":
                close(1)
            ends = CLOSED_BY.get(name)
            if ends:
                depth = 1
                while depth < len(open_nodes) and self.name[open_nodes[-depth]] not in ends and self.name[open_nodes[-depth]] not in SCOPES:
                    depth += 1
                if depth < len(open_nodes) and self.name[open_nodes[-depth]] in ends:
                    close(depth)
                    while len(open_nodes) > 1 and name == "tr" and self.name[open_nodes[-1]] in ends:
                        close(1)
            open_nodes.append(self.add(open_nodes[-1], TAGS.get(name, "other"), name, hints_of(m[4])))
            counts[name] = counts.get(name, 0) + 1
        words(page[at:])
        flush()


def level_order(parent: np.ndarray) -> list[np.ndarray]:
    """Nodes by depth; a node stands behind its parent."""
    depth = np.zeros(len(parent), np.int64)
    ahead = parent.tolist()
    out = depth.tolist()
    for i, p in enumerate(ahead):
        if p >= 0:
            out[i] = out[p] + 1
    depth = np.array(out, np.int64)
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(parent) else []


class Forest:
    """The trees of many pages as arrays: parents, edge kinds and a feature matrix."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        starts = np.cumsum([0, *sizes])[:-1]
        n = sum(sizes)
        self.page = np.repeat(np.arange(len(trees)), sizes)
        self.parent = np.array([p + s if p >= 0 else -1 for t, s in zip(trees, starts.tolist()) for p in t.parent], np.int64)
        self.text = [x for t in trees for x in t.text]
        names = [x for t in trees for x in t.tag]
        hints = [x for t in trees for x in t.hints]
        x = np.zeros((n, len(FEATURES)), np.float32)
        x[np.arange(n), [PLACE[f"tag_{k}"] for k in names]] = 1
        hinted = [(i, PLACE[f"hint_{h}"]) for i, own in enumerate(hints) if own for h in own]
        if hinted:
            x[tuple(np.array(hinted).T)] = 1
        length = np.array([len(s) for s in self.text], np.int64)
        linked = np.array([k for t in trees for k in t.linked], np.int64)
        sentence = np.array([bool(s) and s[-1] in ".!?…:;\"'”" for s in self.text], np.int64)
        h1 = np.array([k == "h1" for k in names], np.int64)
        children = np.zeros(n, np.int64)
        self.levels = level_order(self.parent)
        total = np.stack([length, linked, sentence, h1])
        for nodes in reversed(self.levels[1:]):
            np.add.at(total, (slice(None), self.parent[nodes]), total[:, nodes])
            np.add.at(children, self.parent[nodes], 1)
        length, linked, sentence, h1 = total
        whole = np.maximum(1, length[starts][self.page]) if n else np.ones(0)
        share = linked / np.maximum(1, length)
        before = np.cumsum([len(s) for s in self.text]) - np.array([len(s) for s in self.text], np.int64) if n else np.zeros(0)
        before = before - before[starts][self.page] if n else before
        facts = [share > 0.7, (share > 0.3) & (share <= 0.7), length < 40, length >= 150, length >= 800, length >= 0.5 * whole, sentence > 0, h1 > 0, before < whole / 3,
                 children == 1, np.ones(n, bool)]
        x[:, len(FEATURES) - len(FACTS) :] = np.stack(facts, 1) if n else x[:, len(FEATURES) - len(FACTS) :]
        self.x = x
        self.leaf = np.array([k == "#text" for k in names], bool)
        apart = {"nav", "header", "footer", "aside", "form", "article", "head"}
        kind = [0 if k == "#text" else 3 if k == "article" or h == {"content"} else 2 if k in apart or h else 1 for k, h in zip(names, hints)]
        self.edge = np.array(kind, np.int64)


@dataclass
class Weights:
    own: np.ndarray  # per feature, for content
    edge: np.ndarray  # kinds x parent's class x child's class

    @classmethod
    def zeros(cls) -> Weights:
        return cls(np.zeros(len(FEATURES)), np.zeros((len(EDGES), 2, 2)))


def pass_messages(forest: Forest, w: Weights) -> tuple[np.ndarray, np.ndarray, float]:
    """The marginal probabilities of each node's classes, of each edge's class pairs, and the sum of the pages' log partition functions."""
    n, parent = len(forest.parent), forest.parent
    belief = np.zeros((n, 2))  # log evidence of a node and all that is below it
    belief[:, 1] = forest.x @ w.own
    up = np.zeros((n, 2))
    for nodes in reversed(forest.levels[1:]):
        joint = w.edge[forest.edge[nodes]] + belief[nodes][:, None, :]
        up[nodes] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        np.add.at(belief, parent[nodes], up[nodes])
    edges = np.zeros((n, 2, 2))
    roots = forest.levels[0] if forest.levels else np.zeros(0, np.int64)
    partition = float(np.logaddexp(belief[roots, 0], belief[roots, 1]).sum())
    for nodes in forest.levels[1:]:
        outside = belief[parent[nodes]] - up[nodes]  # what the parent knows without this child
        joint = outside[:, :, None] + w.edge[forest.edge[nodes]] + belief[nodes][:, None, :]
        joint -= joint.max((1, 2), keepdims=True)
        joint = np.exp(joint)
        joint /= joint.sum((1, 2), keepdims=True)
        edges[nodes] = joint
        belief[nodes] += np.logaddexp(outside[:, None, 0] + w.edge[forest.edge[nodes]][:, 0], outside[:, None, 1] + w.edge[forest.edge[nodes]][:, 1])
    if n:
        belief -= belief.max(1, keepdims=True)
    node = np.exp(belief)
    node /= node.sum(1, keepdims=True)
    return node, edges, partition


def fit(trees: list[Tree], labels: list[np.ndarray], steps: int = STEPS, ridge: float = RIDGE) -> Weights:
    """Weights of the greatest conditional likelihood of ``labels`` (a class for each node), less a ridge, by Adam."""
    forest, w = Forest(trees), Weights.zeros()
    if not trees:
        return w
    y = np.concatenate(labels).astype(np.int64)
    inner = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((len(EDGES), 2, 2))
    np.add.at(seen, (forest.edge[inner], y[forest.parent[inner]], y[inner]), 1)
    own = forest.x.T @ y.astype(float)
    flat = np.zeros(w.own.size + w.edge.size)
    m, s = np.zeros_like(flat), np.zeros_like(flat)
    for t in range(1, steps + 1):
        w = Weights(flat[: w.own.size], flat[w.own.size :].reshape(w.edge.shape))
        node, edges, _ = pass_messages(forest, w)
        met = np.zeros_like(seen)
        np.add.at(met, forest.edge[inner], edges[inner])
        gradient = np.concatenate([own - forest.x.T @ node[:, 1], (seen - met).ravel()]) / len(trees) - ridge * flat
        m, s = 0.9 * m + 0.1 * gradient, 0.99 * s + 0.01 * gradient**2
        flat = flat + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return Weights(flat[: w.own.size].copy(), flat[w.own.size :].reshape(w.edge.shape).copy())


def content_of(trees: list[Tree], w: Weights) -> list[str]:
    """The text of each tree."""
    forest = Forest(trees)
    node, _, _ = pass_messages(forest, w)
    out = [[] for _ in trees]
    for i in np.flatnonzero(forest.leaf & (node[:, 1] >= LIMIT)).tolist():
        out[forest.page[i]].append(forest.text[i])
    return ["\n".join(lines) for lines in out]


def labels_by_markup(tree: Tree) -> np.ndarray | None:
    """Labels of a page that marks up exactly one article (or, without one, one main element), else None."""
    marked = [i for i, name in enumerate(tree.name) if name == "article"] or [i for i, name in enumerate(tree.name) if name == "main"]
    if len(marked) != 1:
        return None
    y = np.zeros(len(tree.parent), np.int64)
    y[marked[0]] = 1
    against = set(HINT_KINDS) - {"content", "header"}
    for i in range(marked[0] + 1, len(y)):
        if y[tree.parent[i]]:
            y[i] = not (tree.tag[i] in NEVER or tree.hints[i] & against)
    return y


def renamed(tree: Tree) -> Tree:
    """The same page with a ``div`` for its article or main element, and without its hints."""
    for i, tag in enumerate(tree.tag):
        if tag == "article":
            tree.tag[i], tree.name[i], tree.hints[i] = "div", "div", frozenset()
    return tree


# Blocks of practice pages: (content or not, places, start tags). W stands for a few words, S for sentences, L for links.
PRACTICE = [
    (0, "top", ["<nav>L</nav>", "<nav class='menu'><ul>L</ul></nav>", "<div id='nav-menu'><ul>L</ul></div>", "<ul class='breadcrumb'>L</ul>", "<div role='navigation'>L</div>"]),
    (0, "top", ["<header><div class='logo'>W</div>L</header>", "<div class='site-header'><p>W</p>L</div>", "<header><h2>W</h2><p>W</p></header>", "<div class='masthead'>W</div>", "<div role='banner'><p>S</p></div>"]),
    (0, "any", ["<aside>S</aside>", "<aside><h3>W</h3><ul>L</ul></aside>", "<div class='sidebar'><h3>W</h3><p>S</p></div>", "<div id='related'><h4>W</h4>L</div>", "<section class='widget'><p>S</p></section>"]),
    (0, "any", ["<div class='cookie-notice'><p>S</p></div>", "<div id='consent'>S</div>", "<div class='alert notice'>S</div>", "<div class='newsletter-popup'><p>S</p><p>W</p></div>", "<div role='dialog'>S</div>"]),
    (0, "any", ["<div class='ad'>S</div>", "<div class='ads'><p>S</p></div>", "<div class='sponsored'>S</div>", "<section id='promo'><h3>W</h3><p>S</p></section>", "<div class='advertisement'>W</div>"]),
    (0, "any", ["<form>W<p>S</p></form>", "<form class='search'>W</form>", "<div class='login-form'><p>W</p></div>", "<form><label>W</label><p>W</p></form>", "<form id='subscribe'><h3>W</h3><p>S</p></form>"]),
    (0, "end", ["<div class='comments'><h3>W</h3><div class='comment'><p>S</p></div><div class='comment'><p>S</p></div></div>", "<section id='comments'><p>S</p><p>S</p></section>",
                "<ul class='comment-list'><li><p>S</p></li><li><p>S</p></li></ul>", "<div class='replies'><p>S</p><p>S</p></div>", "<ol id='discussion'><li>S</li><li>S</li></ol>"]),
    (0, "end", ["<div class='share'>L</div>", "<ul class='social'>L</ul>", "<div class='tags'>L</div>"]),
    (0, "last", ["<footer>S L</footer>", "<footer><p>S</p></footer>", "<div class='footer'><p>S</p>L</div>", "<div id='copyright'>S</div>", "<footer>W</footer>"]),
]
BODY = ["<p>S</p>", "<p>S</p>", "<p>S</p>", "<p>S<br>S<p>S</p>", "<p>W</p>", "<h2>W</h2>", "<h3>W</h3>", "<ul><li>S</li><li>S</li></ul>", "<blockquote><p>S</p></blockquote>", "<figure><figcaption>W</figcaption></figure>",
        "<div>S</div>", "<section><h2>W</h2><p>S</p></section>", "<table><tr><td>W</td><td>W</td></tr></table>", "<pre>S</pre>", "<p>S <a href='/x'>W</a> S</p>", "<ol><li>W</li><li>W</li></ol>"]
SHELLS = ["<article>B</article>", "<article>B</article>", "<main>B</main>", "<main><article>B</article></main>", "<div class='content'>B</div>", "<div class='post-body'><div>B</div></div>", "<div id='story'>B</div>", "<section class='entry'>B</section>", "<div>B</div>", "<div><div>B</div></div>"]
HEADS = ["<h1>W</h1>", "<header><h1>W</h1></header>", "<h1>W</h1><h2>W</h2>", "<div><h1>W</h1></div>"]


def practice_page(number: int) -> tuple[Tree, np.ndarray]:
    """A page of blocks drawn by ``number``, with the class of every node. Content is marked while the page is composed."""
    draw = random.Random(number)
    word = lambda: "".join(draw.choices("abcdefghilmnoprstu", k=draw.randint(2, 9)))
    some = lambda low, high: " ".join(word() for _ in range(draw.randint(low, high))).capitalize()
    fill = {"W": lambda: some(1, 6), "S": lambda: " ".join(some(2, 22) + "." for _ in range(draw.randint(1, 4))),
            "L": lambda: " ".join(f"<li><a href='/{word()}'>{some(1, 3)}</a></li>" for _ in range(draw.randint(2, 7)))}
    filled = lambda block: re.sub(r"\b[WSL]\b", lambda m: fill[m[0]](), block)
    marked = lambda block: f"<x-begin></x-begin>{filled(block)}<x-end></x-end>"
    blocks = {place: [filled(draw.choice(forms)) for _, where, forms in PRACTICE if where == place and draw.random() < 0.6] for place in ("top", "any", "end", "last")}
    body = [draw.choice(HEADS)] * (draw.random() < 0.9) + draw.choices(BODY, k=draw.randint(1, 12))
    parts = [marked(b) for b in body]
    for own in blocks["any"][:1] * (draw.random() < 0.5) + blocks["end"] * (draw.random() < 0.4):
        parts.insert(draw.randint(1, len(parts)), own)
    shell = draw.choice(SHELLS).replace("B", "x-body", 1)
    page = "".join(blocks["top"]) + "".join(blocks["any"]) + shell.replace("x-body", "<x-shell></x-shell>" + "".join(parts)) + "".join(blocks["end"]) + "".join(blocks["last"])
    tree = Tree(f"<html><body>{page}</body></html>")
    # Nodes between the marks are content, and so is the element that holds the shell's mark with what wraps it.
    y, inside, keep = np.zeros(len(tree.parent), np.int64), False, []
    for i, name in enumerate(tree.name):
        if name == "x-shell":
            up = tree.parent[i]
            while up > 0 and tree.name[up] not in ("html", "body"):
                y[up], up = 1, tree.parent[up]
        inside = (inside or name == "x-begin") and name != "x-end"
        if not name.startswith("x-"):
            y[i] = max(y[i], inside)
            keep.append(i)
    return without(tree, keep), y[keep]


def without(tree: Tree, keep: list[int]) -> Tree:
    """The tree of the kept nodes; those that go have no children."""
    place, out = {k: i for i, k in enumerate(keep)}, Tree(None)
    out.parent = [place[tree.parent[k]] if tree.parent[k] >= 0 else -1 for k in keep]
    for field in ("tag", "name", "hints", "text", "linked"):
        setattr(out, field, [getattr(tree, field)[k] for k in keep])
    return out


def learn(pages: list[str]) -> Weights:
    """Weights from labelled pages among ``pages`` and the practice pages."""
    trees, labels = [], []
    for number, page in enumerate(pages):
        tree = Tree(page)
        y = labels_by_markup(tree)
        if y is not None:
            trees.append(renamed(tree) if number % 2 else tree)
            labels.append(y)
    for number in range(PRACTICE_PAGES):
        tree, y = practice_page(number)
        trees.append(tree)
        labels.append(y)
    return fit(trees, labels)


def sampled_pages(pages: DataFrame, keys: tuple[str, ...], rows: int) -> list[str]:
    """``rows`` pages at most, those of the least hashes of their keys and text: the same for any partitioning.

    Only hashes low enough for some twice as many pages are sorted, so that what tasks send doesn't grow with their number.
    """
    short = pages.select("html", F.pmod(F.xxhash64(*keys, "html"), F.lit(1 << 40)).alias("h")).where(F.length("html") < 100_000)
    total = short.count()
    least = short.where(F.col("h") < F.lit(int((1 << 40) * min(1.0, (2 * rows + 50) / max(1, total)))))
    return [r["html"] for r in least.orderBy("h", "html").limit(rows).collect()]


def _extract(w: Weights, keys: list[str]):
    def run(batches):
        for batch in batches:
            texts, group, size = [], [], 0
            for page in batch.column("html").to_pylist():
                group.append(Tree(page))
                size += len(group[-1].parent)
                if size > 20_000:
                    texts += content_of(group, w)
                    group, size = [], 0
            texts += content_of(group, w)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keys, "text", "n_chars"])

    return run


def main_text(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), fit_pages: int = FIT_PAGES) -> DataFrame:
    """``keys``, ``text`` and ``n_chars`` of every row of ``pages`` (with a column ``html``)."""
    w = learn(sampled_pages(pages, keys, fit_pages))
    fields = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return map_batches(pages.select(*keys, "html"), _extract(w, list(keys)), f"{fields}, text string, n_chars long")


def op12_html_text(spark, sf_dir):
    """The main text of every page."""
    return main_text(table(spark, sf_dir, "pages"))
