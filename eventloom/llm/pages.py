"""HTML extraction by a tree-structured graphical model (operator 8).

A page becomes a tree of block elements with its text blocks as leaves. Every node is content
or not; weights on its features (tag, class words, text length, share of link text) and
parent-child potentials for each kind of child give the tree's distribution. Sum-product
messages, once upward and once downward, yield the exact marginal of each node, and the text
blocks that are more likely content than not are the page's main text.

Weights and potentials are trained together by gradient ascent on the likelihood of labelled
pages (empirical minus expected counts, the latter by the same messages). The labelled pages
are made here from a fixed seed, LABELLED_PAGES of them in several layouts; training is on
the driver and bounded by that number.

Defined results: a null, empty or textless page has the empty text and 0 characters; repeated
rows give repeated result rows; an empty table gives an empty result; columns other than id,
url and html are ignored. Pages are read whole, in time linear in their length however their
tags are nested or left open: open elements are found by name, and a tag without an end is not
scanned for one twice. Character references are decoded piece by piece, between two tags.
"""

from __future__ import annotations

import html as entities
import random
import re
from bisect import bisect_left
from functools import lru_cache
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

LABELLED_PAGES = 300
ROUNDS = 80
SEED = 11

TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
NAME_END = re.compile(r"[\s/>]")
OPENING = re.compile(r"</?[a-zA-Z]")
NAMED = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

# Element names by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript template select svg".split())
BLOCKS = frozenset(
    "html head body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form fieldset table thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary menu center hgroup dialog caption".split()
)
CLOSES_P = BLOCKS - frozenset("html head body li dt dd thead tbody tfoot tr td th caption summary figcaption".split())
#: An opening element ends an open element of these names, up to the container that bounds them.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

# Fixed word lists: words of class, id and role attributes.
WORDS = {
    "main": "content article post entry story main text body news maincontent",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs topbar links sitemap toc pagination pager",
    "ad": "ad ads adv advert advertisement adverts sponsor sponsored promo promotion banner adsense commercial",
    "comment": "comment comments commentlist reply replies discussion respond disqus reader readers",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay warning message disclaimer privacy",
    "share": "share sharing social related recommended recommend more tags byline",
    "form": "form subscribe newsletter signup login search register contact",
    "side": "sidebar side aside widget complementary rail",
    "foot": "footer foot copyright contentinfo colophon legal",
    "head": "header head masthead logo brand",
}
WORD_GROUP = {w: group for group, words in WORDS.items() for w in words.split()}

#: Kinds of children, each with its own parent-child potentials.
TEXT, FLOW, CONTAINER, REGION, ARTICLE = range(5)
KIND = {
    **dict.fromkeys(("article", "main"), ARTICLE),
    **dict.fromkeys(("nav", "header", "footer", "aside", "form", "dialog", "menu", "fieldset"), REGION),
    **dict.fromkeys(("div", "section", "table", "tbody", "body", "html", "head", "td", "center", "details"), CONTAINER),
}


class Tree:
    """Nodes in page order, parents before children; leaves carry text."""

    __slots__ = ("features", "kind", "links", "parent", "size", "tag", "text", "words")

    def __init__(self):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.kind: list[int] = []
        self.words: list[tuple[str, ...]] = []
        self.text: list[str | None] = []
        self.size: list[int] = []
        self.links: list[int] = []
        self.features: list[list[str]] = []

    def add(self, parent: int, tag: str, kind: int, words=(), text=None, links=0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.kind.append(kind)
        self.words.append(words)
        self.text.append(text)
        self.size.append(len(text) if text else 0)
        self.links.append(links)
        return len(self.parent) - 1


def attribute_words(attributes: str) -> tuple[str, ...]:
    """Groups of the words of class, id and role; `hidden` for elements that are not shown."""
    found = set()
    for match in NAMED.finditer(attributes):
        name, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if name in ("hidden", "aria-hidden"):
            if value != "false":
                found.add("hidden")
        elif name == "style":
            if "display:none" in value.replace(" ", ""):
                found.add("hidden")
        else:
            found.update(WORD_GROUP[w] for w in re.split(r"[^a-z]+", value) if w in WORD_GROUP)
    return tuple(sorted(found))


class TagEnds:
    """Where tags of a page end that no plain expression closes, in time linear in all tags together.

    A scan walks from one quote or `>` outside quotes to the next. Scans that reach the same place
    go on alike, so the places on the way of a scan that found no end are never walked again.
    """

    def __init__(self, page: str):
        self.page = page
        self.at = [m.start() for m in re.finditer("[>\"']", page)]
        self.again = [-1] * len(self.at)  # the next place with the same character
        last: dict[str, int] = {}
        for i in range(len(self.at) - 1, -1, -1):
            mark = page[self.at[i]]
            self.again[i] = last.get(mark, -1)
            last[mark] = i
        self.dead = bytearray(len(self.at) + 1)
        self.dead[-1] = 1
        self.name_end = -1

    def after_name(self, at: int) -> int:
        """Where a name that begins at `at` ends; starts come in order."""
        if self.name_end < at:
            end = NAME_END.search(self.page, at)
            self.name_end = end.start() if end else len(self.page)
        return self.name_end

    def find(self, at: int) -> int | None:
        """The `>` that ends the attributes which begin at `at`."""
        i, way = bisect_left(self.at, at), []
        while not self.dead[i]:
            if self.page[self.at[i]] == ">":
                return self.at[i]
            way.append(i)
            i = self.again[i] + 1 or len(self.at)
        for k in way:
            self.dead[k] = 1
        return None


class Tags:
    """The tags of a page, from any place on; places must not go back."""

    def __init__(self, page: str):
        self.page = page
        self.ends: TagEnds | None = None  # made at the first tag without an end
        self.no_declaration = len(page)  # from here on no `>` follows

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, closing, name, attributes) of the next tag; comments and declarations have no name."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            first = page[at : at + 1]
            if page.startswith("!--", at):
                close = page.find("-->", at + 3)
                return start, close + 3 if close >= 0 else len(page), "", "", ""
            if first in ("!", "?"):
                close = page.find(">", at) if at < self.no_declaration else -1
                if close >= 0:
                    return start, close + 1, "", "", ""
                self.no_declaration = min(self.no_declaration, at)
                continue
            begin = at + (first == "/")
            if not OPENING.match(page, start):
                continue
            if self.ends is None:
                if match := TAG.match(page, at):
                    return start, match.end(), match[1], match[2].lower(), match[3]
                self.ends = TagEnds(page)
            name_end = self.ends.after_name(begin)
            close = self.ends.find(name_end)
            if close is not None:
                return start, close + 1, page[at:begin], page[begin:name_end].lower(), page[name_end:close]
        return None


class Open:
    """The stack of open elements, which knows where each name stands."""

    def __init__(self, root: int):
        self.names, self.nodes = ["html"], [root]
        self.places: dict[str, list[int]] = {"html": [0]}

    def __contains__(self, name: str) -> bool:
        return bool(self.places.get(name))

    def push(self, name: str, node: int) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.nodes.append(node)

    def pop_to(self, name: str) -> None:
        """End elements up to and with the innermost of the name."""
        while True:
            last = self.names.pop()
            self.nodes.pop()
            self.places[last].pop()
            if last == name:
                return

    def innermost(self, names: tuple[str, ...]) -> tuple[int, str]:
        """Place and name of the innermost open element of these names; -1 if there is none."""
        return max((self.places[n][-1], n) if self.places.get(n) else (-1, n) for n in names)


RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}


def parse(page: str) -> Tree:
    tree = Tree()
    stack = Open(tree.add(-1, "html", CONTAINER))
    buffer: list[str] = []
    link_depth, linked = 0, 0

    def end_block():
        nonlocal linked
        if buffer:
            shown = " ".join("".join(buffer).split())
            buffer.clear()
            if shown and "head" not in stack:
                tree.add(stack.nodes[-1], stack.names[-1], TEXT, text=shown, links=min(linked, len(shown)))
        linked = 0

    def add_text(piece: str):
        """A reference lies within one piece: markup between two pieces ends it."""
        nonlocal linked
        if piece:
            piece = entities.unescape(piece)
            buffer.append(piece)
            if link_depth:
                linked += len(piece)

    at, found = 0, Tags(page)
    while tag := found.after(at):
        start, end, closing, name, attributes = tag
        add_text(page[at:start])
        at = end
        if not name:
            continue
        if name in RAW:
            if not closing and not (name == "svg" and attributes.endswith("/")):
                ended = RAW_ENDS[name].search(page, at)
                at = ended.end() if ended else len(page)
            continue
        if name == "br" or name == "hr":
            end_block()
        elif name in VOID:
            continue
        elif name not in BLOCKS:
            if name in ("a", "button"):
                link_depth = 0 if closing else 1
        elif closing:
            end_block()
            link_depth = 0
            if name in stack and name != "html":
                stack.pop_to(name)
            elif name in HEADINGS and stack.names[-1] in HEADINGS:
                stack.pop_to(stack.names[-1])
        else:
            end_block()
            link_depth = 0
            if name in ("html", "head", "body") and (name in stack or (name == "body" and "head" not in stack and len(stack.names) > 1)):
                continue
            if "head" in stack and name != "head":
                stack.pop_to("head")
            if name in CLOSES_P and "p" in stack:
                stack.pop_to("p")
            if name in HEADINGS and stack.names[-1] in HEADINGS:
                stack.pop_to(stack.names[-1])
            if name in ENDS:
                ended, bounds = ENDS[name]
                place, open_name = stack.innermost(ended)
                if place > stack.innermost(bounds)[0]:
                    stack.pop_to(open_name)
            stack.push(name, tree.add(stack.nodes[-1], name, KIND.get(name, FLOW), attribute_words(attributes) if attributes.strip() else ()))
    rest = page[at:]
    broken = OPENING.search(rest)  # a tag that the page's end cuts off is no text
    add_text(rest[: broken.start()] if broken else rest)
    end_block()
    describe(tree)
    return tree


def describe(tree: Tree) -> None:
    """Features of each node, from sizes summed upwards."""
    n = len(tree.parent)
    blocks = [int(t is not None) for t in tree.text]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        tree.size[p] += tree.size[i]
        tree.links[p] += tree.links[i]
        blocks[p] += blocks[i]
    whole = max(1, tree.size[0])
    for i in range(n):
        size = tree.size[i]
        share = size / whole
        length = "0" if size == 0 else "a" if size < 25 else "b" if size < 80 else "c" if size < 250 else "d" if size < 1000 else "e"
        link = tree.links[i] / size if size else 0.0
        linked = "0" if link < 0.1 else "a" if link < 0.5 else "b"
        if tree.text[i] is not None:
            text = tree.text[i]
            own = [f"text:{tree.tag[i]}", f"text.length:{length}", f"text.link:{linked}", "text.stop" if text[-1] in ".!?…\"”»" else "text.open"]
        else:
            part = "0" if share < 0.1 else "a" if share < 0.4 else "b"
            own = [f"tag:{tree.tag[i]}", f"length:{length}", f"link:{linked}", f"share:{part}", *(f"word:{w}" for w in tree.words[i])]
        tree.features.append(own)


class Model:
    """Feature weights, and log potentials [kind of child][parent][child]."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.pair = [[[0.0, 0.0], [0.0, 0.0]] for _ in range(5)]

    def messages(self, tree: Tree, want_pairs: bool = False):
        """Marginal chance of content of each node, and of each (parent, child) state if wanted."""
        n = len(tree.parent)
        weights = self.weights
        potential = [[[exp(x) for x in row] for row in table_] for table_ in self.pair]
        up0, up1 = [1.0] * n, [1.0] * n  # own potential times messages of children, scaled
        for i in range(n):
            score = 0.0
            for f in tree.features[i]:
                score += weights.get(f, 0.0)
            up1[i] = 1 / (1 + exp(-max(-30.0, min(30.0, score))))
            up0[i] = 1 - up1[i]
        sent: list[tuple[float, float]] = [(0.5, 0.5)] * n
        for i in range(n - 1, 0, -1):
            a, b = up0[i], up1[i]
            psi, p = potential[tree.kind[i]], tree.parent[i]
            m0, m1 = psi[0][0] * a + psi[0][1] * b, psi[1][0] * a + psi[1][1] * b
            total = m0 + m1
            sent[i] = (m0 / total, m1 / total)
            x, y = up0[p] * m0, up1[p] * m1
            up0[p], up1[p] = x / (x + y), y / (x + y)
        belief = [0.0] * n
        belief[0] = up1[0] / (up0[0] + up1[0])
        joint = []
        for i in range(1, n):
            p, psi = tree.parent[i], potential[tree.kind[i]]
            # What the parent knows without this child.
            o0, o1 = (1 - belief[p]) / sent[i][0], belief[p] / sent[i][1]
            j00, j01 = o0 * psi[0][0] * up0[i], o0 * psi[0][1] * up1[i]
            j10, j11 = o1 * psi[1][0] * up0[i], o1 * psi[1][1] * up1[i]
            total = j00 + j01 + j10 + j11
            belief[i] = (j01 + j11) / total
            if want_pairs:
                joint.append((j00 / total, j01 / total, j10 / total, j11 / total))
        return belief, joint

    def extract(self, page: str | None) -> str:
        if not page:
            return ""
        tree = parse(page)
        belief, _ = self.messages(tree)
        return " ".join(t for t, b in zip(tree.text, belief, strict=True) if t is not None and b > 0.5)


def train(pages: list[tuple[Tree, list[int]]], rounds: int = ROUNDS) -> Model:
    """Gradient ascent with step sizes by each weight's own gradients, and a quadratic penalty."""
    model = Model()
    names = sorted({f for tree, _ in pages for own in tree.features for f in own})
    number = {f: k for k, f in enumerate(names)}
    size = len(names) + 20
    theta, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    seen = np.zeros(size)
    for tree, labels in pages:
        for i, own in enumerate(tree.features):
            for f in own:
                seen[number[f]] += labels[i]
            if i:
                seen[len(names) + 4 * tree.kind[i] + 2 * labels[tree.parent[i]] + labels[i]] += 1
    for step in range(1, rounds + 1):
        expected = np.zeros(size)
        for tree, _ in pages:
            belief, joint = model.messages(tree, True)
            for i, own in enumerate(tree.features):
                for f in own:
                    expected[number[f]] += belief[i]
                if i:
                    at = len(names) + 4 * tree.kind[i]
                    expected[at : at + 4] += joint[i - 1]
        gradient = (seen - expected) / len(pages) - 0.003 * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta += 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        model.weights = dict(zip(names, theta.tolist(), strict=False))
        model.pair = theta[len(names) :].reshape(5, 2, 2).tolist()
    return model


def prose(rng: random.Random, least: int, most: int) -> str:
    parts = ("ta", "ren", "ing", "mo", "sel", "ver", "an", "der", "li", "que", "ado", "en")
    shown = " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(least, most)))
    return shown.capitalize() + rng.choice([".", ".", ".", ".", "", "!", "?"])


def labelled_page(rng: random.Random) -> str:
    """A page whose content texts begin with the mark `@@`."""

    def own(least=3, most=80):
        return "@@" + prose(rng, least, most)

    def name(options: str) -> str:
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(options.split())}"' if rng.random() < 0.85 else ""

    def links(n):
        return "".join(f'<li><a href="/x">{prose(rng, 1, 3)}</a></li>' for _ in range(n))

    def wrap(tag, options, body):
        return f"<{tag}{name(options)}>{body}</{tag}>"

    def paragraphs():
        out = []
        style = rng.random()
        if style < 0.15:  # many short paragraphs, some the same
            few = [own(1, 3) for _ in range(rng.randint(1, 4))]
            return "".join(rng.choice(["<p>{}</p>", "<p><b>{}<br>"]).format(rng.choice(few)) for _ in range(rng.randint(5, 40)))
        if style < 0.25:
            return f"<p>{own(100, 300)}</p>" + "".join(f"<p>{own(1, 3)}</p>" for _ in range(rng.randint(0, 20)))
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.66:
                body = own() if rng.random() < 0.8 else f"{own(3, 20)} <a href='#'>{prose(rng, 1, 3)}</a> {prose(rng, 3, 20)}"
                out.append(rng.choice([f"<p>{body}</p>", f"<p>{body}", f"<p><b>{body}<br>", f"<p><b>{body}</b></p>"]))
            elif kind < 0.74:
                out.append(f"<h2>{own(1, 6)}</h2>")
            elif kind < 0.82:
                out.append("<ul>" + "".join(f"<li>{own(1, 15)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif kind < 0.88:
                out.append(f"<blockquote><p>{own(5, 30)}</p></blockquote>")
            elif kind < 0.92:
                out.append(f"<table><tr><td>{own(1, 4)}</td><td>{own(1, 4)}</td></tr></table>")
            elif kind < 0.95:
                out.append(wrap("div", "ad ads promo sponsored", prose(rng, 2, 25)))
            elif kind < 0.97:
                out.append(wrap("aside", "related sidebar pullquote", prose(rng, 2, 12)))
            else:
                out.append(f"<pre>{own(3, 20)}</pre>")
        return "".join(out)

    title = f"<h1>{own(1, 12)}</h1>" if rng.random() < 0.8 else f"<h1>{own(8, 30).rstrip('.!?')}</h1>"
    inner = (title if rng.random() < 0.85 else "") + paragraphs()
    if rng.random() < 0.3:
        inner += wrap("div", "share social tags related byline", "<ul>" + links(3) + "</ul>")
    if rng.random() < 0.15:
        inner += f"<footer>{prose(rng, 2, 10)}</footer>"
    layout = rng.random()
    if layout < 0.5:
        article = f"<article>{inner}</article>"
    elif layout < 0.7:
        article = f"<main>{rng.choice([inner, wrap('div', 'content post entry', inner), f'<article>{inner}</article>'])}</main>"
    else:
        article = f'<div class="{rng.choice(["content", "post", "entry-content", "article-body", "story", "main-text"])}">{inner}</div>'
    notice = lambda: wrap("div", "cookie-notice notice consent-banner alert gdpr", f"<p>{prose(rng, 3, 30)}</p><button>{prose(rng, 1, 1)}</button>")
    advert = lambda: wrap("div", "ad ads advert banner sponsored", prose(rng, 2, 40))
    comments = lambda: rng.choice(
        [
            wrap("section", "comments discussion", f"<h2>{prose(rng, 1, 2)}</h2>" + "".join(wrap("div", "comment reply", f"<p>{prose(rng, 3, 50)}</p>") for _ in range(rng.randint(1, 5)))),
            wrap("div", "comments reader-comments", "<ol>" + "".join(f"<li><p>{prose(rng, 3, 50)}</p></li>" for _ in range(rng.randint(1, 4))) + "</ol>"),
        ]
    )
    form = lambda: wrap("form", "newsletter search login", f"<label>{prose(rng, 1, 4)}</label><input><p>{prose(rng, 2, 12)}</p>")
    side = lambda: wrap(rng.choice(["aside", "div"]), "sidebar widget side", f"<h3>{prose(rng, 1, 3)}</h3><ul>{links(4)}</ul><p>{prose(rng, 3, 40)}</p>")
    nav = rng.choice(["<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', "<header><nav><ul>{}</ul></nav></header>", '<ul class="nav">{}</ul>']).format(links(rng.randint(2, 9)))
    head = rng.choice(["", f"<header>{prose(rng, 1, 8)}</header>", wrap("div", "header masthead", prose(rng, 1, 8))])
    foot = rng.choice([f"<footer>{prose(rng, 2, 25)}</footer>", f'<div class="footer"><p>{prose(rng, 2, 25)}</p></div>'])
    before = [x for x, p in ((notice, 0.3), (advert, 0.5), (form, 0.15), (side, 0.15)) if rng.random() < p]
    after = [x for x, p in ((comments, 0.4), (advert, 0.3), (side, 0.3), (form, 0.2), (notice, 0.2)) if rng.random() < p]
    body = head + nav + "".join(x() for x in before) + article + "".join(x() for x in after) + foot
    if rng.random() < 0.3:
        body = wrap("div", "wrapper page container site", body)
    return f"<!DOCTYPE html><html><head><title>{prose(rng, 1, 9)}</title></head><body>{body}</body></html>"


def labelled(page: str) -> tuple[Tree, list[int]]:
    """Tree and labels of a made page: marked texts are content, and so are the elements that hold
    more of it than of anything else, up to but not including the page's body."""
    tree = parse(page)
    n = len(tree.parent)
    good = [0] * n
    for i, text in enumerate(tree.text):
        if text is not None and text.startswith("@@"):
            good[i] = tree.size[i]
    for i in range(n - 1, 0, -1):
        if tree.text[i] is None:
            continue
        p = tree.parent[i]
        while p >= 0:
            good[p] += good[i]
            p = tree.parent[p]
    labels = [int(tree.size[i] > 0 and good[i] * 2 > tree.size[i] and tree.tag[i] not in ("body", "html") or tree.text[i] is not None and good[i] > 0) for i in range(n)]
    for i in range(1, n):  # outside the article nothing is content
        if tree.text[i] is None and not labels[tree.parent[i]] and tree.kind[tree.parent[i]] == REGION:
            labels[i] = 0
    tree.text = [t.removeprefix("@@") if t else t for t in tree.text]
    return tree, labels


@lru_cache(maxsize=2)
def trained(pages: int = LABELLED_PAGES, seed: int = SEED) -> Model:
    rng = random.Random(seed)
    return train([labelled(labelled_page(rng)) for _ in range(pages)])


def main_text(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and text of each page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())

    def run(batches):
        fitted = shared.value
        for batch in (part for whole in batches for part in slices(whole, 2)):
            texts = [fitted.extract(page.as_py()) for page in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
