"""Main text of web pages by a tree-structured graphical model.

The nodes are a page's block elements and its text blocks, each content (1) or not (0).  A node has a
unary potential from its tag, the words of its class and id, its role, links and length; an edge has a
potential for the labels of parent and child, by kind of child.  Sum-product messages go up and down the
tree once and give every block's marginal; blocks that are likelier content than not are the text.  The
potentials are fitted by maximum likelihood on labelled pages (`labelled_pages`).
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Elements of HTML by how they break text, and words that name parts of pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style head title template noscript svg annotation annotation-xml iframe object select option textarea button canvas audio video datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
# Formulas are read as part of the line they stand in.
MATH = frozenset("""math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub
    msubsup msup mtable mtd mtext mtr munder munderover none semantics""".split())
INLINE |= MATH
# Start tags that end an open svg, unless one of its parts that hold HTML is open.
BREAKOUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s
    small span strong strike sub sup table tt u ul var""".split())
HTML_PARTS = frozenset("foreignobject desc title".split())
#: Unread elements that the end tag of a block around them closes too.
LEAKY = frozenset("svg button canvas audio video datalist option noscript".split())
CLOSES_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "p": ()}
FURNITURE = frozenset("""ad ads adv advert advertisement banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs
    footer foot header masthead sidebar side aside widget related recommended share sharing social comment comments reply replies respond
    discussion disqus cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login
    search form pagination pager copyright legal toolbar skip topbar bottom links tags""".split())
BODY_WORDS = frozenset("article content main post entry body text story page story".split())
ROLES = frozenset("navigation banner contentinfo complementary search main article dialog alert alertdialog form menu menubar".split())
SECTIONS = frozenset("article main nav aside header footer form section figure table".split())

EDGES = ("text", "plain", "section", "furniture", "body")
EPOCHS, RATE, RIDGE, SEED = 100, 0.3, 0.002, 3


#: A comment, a tag (with quoted values, else up to the next >), or a declaration.
MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Elements whose text is not markup.
RAW = frozenset("script style textarea title iframe".split())
#: Attributes that end with an unquoted value, which a slash at their end belongs to.
UNQUOTED = re.compile(r"""=\s*[^\s"'>][^\s"'>]*\Z""")


class Page:
    """A page as a tree in page order: parent[i] < i, features[i], edge[i]; block[i] is the text of a text node, else None."""

    def __init__(self, html: str):
        self.parent, self.features, self.edge, self.block, self.mark = [-1], [["tag:root"]], ["plain"], [None], [None]
        self.open: list[tuple[str, int | None]] = []  # tag and node, which inline elements don't have
        self.nodes = [0]
        self.unread: list[str] = []  # the outermost unread element and what is open in it
        self.links = 0
        self.held: list[str] = []
        self.linked = 0
        self.read(html)
        self.flush()

    # ---- tags and text

    def read(self, html: str) -> None:
        """Pass on the page's tags and text in order; a cut tag at the end is dropped."""
        at, end = 0, len(html)
        while at < end:
            m = MARKUP.search(html, at)
            if m is None:
                cut = html.rfind("<", at)
                tail = html[at:cut] if cut >= 0 and html[cut + 1: cut + 2].isalpha() else html[at:]
                self.characters(tail)
                return
            if m.start() > at:
                self.characters(html[at: m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self.end(tag)
                continue
            if self.start(tag, m[3] or m[6] or "") and tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                at = stop.start() if stop else end

    def start(self, tag: str, attrs: str) -> bool:
        """Take a start tag; False if the element is closed by a slash, which counts in svg and math only."""
        closed = attrs[-1:] == "/" and not UNQUOTED.search(attrs)
        if self.unread and self.stays_unread(tag, closed):
            return not (closed and "svg" in self.unread)
        if closed and (tag == "svg" or tag in MATH):
            return False
        if tag in UNREAD:
            if tag != "head":  # whose end tag may be left out; what it holds is unread by itself
                self.unread = [tag]
            return True
        self.open_read(tag, attrs)
        return True

    def stays_unread(self, tag: str, closed: bool) -> bool:
        """Take a start tag inside an unread element; False if it ends that element and is to be read itself."""
        held = self.unread
        if tag in ("option", "optgroup") and held[-1] == "option":
            held.pop()
            if not held and tag == "optgroup":
                return True
        if "select" in held and tag in ("select", "input", "textarea"):
            self.close_unread("select")
            if held or tag == "select":  # a select inside a select only ends it
                return True
            return False
        if "svg" in held and tag in BREAKOUT and not HTML_PARTS.intersection(held[self.last("svg"):]):
            self.close_unread("svg")
            return bool(held) and self.stays_unread(tag, closed)
        if tag not in VOID and not (closed and "svg" in held):
            held.append(tag)
        return True

    def last(self, tag: str) -> int:
        return len(self.unread) - 1 - self.unread[::-1].index(tag)

    def close_unread(self, tag: str) -> None:
        del self.unread[self.last(tag):]

    def open_read(self, tag: str, attrs: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            else:
                self.held.append(" ")
            return
        if tag in INLINE:
            self.links += tag == "a"
            self.open.append((tag, None))
            return
        self.flush()
        self.imply_ends(tag)
        self.open.append((tag, self.add(tag, attrs)))
        self.nodes.append(self.open[-1][1])

    def end(self, tag: str) -> None:
        if self.unread:
            if tag in self.unread:
                self.close_unread(tag)
                return
            if tag == "p" or tag in INLINE or self.unread[0] not in LEAKY or all(name != tag for name, _ in self.open):
                return
            self.unread = []
        if tag in VOID or tag in UNREAD:
            return
        for i in range(len(self.open) - 1, -1, -1):
            name, node = self.open[i]
            if name == tag:
                self.pop_to(i)
                return
            if tag in INLINE and node is not None:
                return  # an inline end tag doesn't close blocks

    def characters(self, data: str) -> None:
        if not self.unread:
            data = unescape(data) if "&" in data else data
            self.held.append(data)
            if self.links:
                self.linked += len(data)

    # ---- the tree

    def pop_to(self, i: int) -> None:
        if any(node is not None for _, node in self.open[i:]):
            self.flush()
        for name, node in self.open[i:]:
            self.links -= name == "a"
            if node is not None:
                self.nodes.pop()
        del self.open[i:]

    def imply_ends(self, tag: str) -> None:
        """A block ends an open paragraph; list items, cells and the like end their own kind."""
        for i in range(len(self.open) - 1, -1, -1):
            name, node = self.open[i]
            if name == "p" or name == tag and tag in CLOSES_SAME or tag in ("dt", "dd") and name in ("dt", "dd") or tag in ("td", "th") and name in ("td", "th"):
                self.pop_to(i)
                return
            if node is not None and (name in CLOSES_SAME.get(tag, ()) or name not in ("td", "th", "tbody", "thead", "tfoot") or tag != "tr"):
                return

    def add(self, tag: str, written: str) -> int:
        if not written:
            return self.node([f"tag:{tag}"], "section" if tag in SECTIONS else "plain", None, None)
        attrs = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(written)}
        words = re.findall(r"[a-z]+", f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower())
        role = (attrs.get("role") or "").strip().lower()
        furniture = any(w in FURNITURE for w in words) or attrs.get("aria-hidden") == "true" or "hidden" in attrs
        body = any(w in BODY_WORDS for w in words)
        found = [f"tag:{tag}"]
        found += ["furniture"] if furniture else ["body"] if body else []
        found += [f"role:{role}"] if role in ROLES else []
        kind = "furniture" if furniture else "body" if body else "section" if tag in SECTIONS or role in ROLES else "plain"
        return self.node(found, kind, None, attrs.get("data-label"))

    def node(self, features: list[str], kind: str, block: str | None, mark: str | None) -> int:
        self.parent.append(self.nodes[-1])
        self.features.append(features)
        self.edge.append(kind)
        self.block.append(block)
        self.mark.append(mark)
        return len(self.parent) - 1

    def flush(self) -> None:
        """End the block of text that is held, if it has any."""
        text = " ".join("".join(self.held).split())
        if text:
            n = len(text)
            found = [f"long:{min(5, int(math.log2(1 + n / 10)))}", f"links:{min(2, 3 * self.linked // max(1, n))}", f"stops:{min(2, sum(map(text.count, '.!?')))}"]
            if text[0] in "©®" or text.lower().startswith(("copyright", "all rights")):
                found.append("rights")
            self.node(found, "text", text, None)
        self.held, self.linked = [], 0


# ---- potentials, messages and their fit ------------------------------------------------------------------------

class TreeModel:
    """unary[feature]: log-odds for content; pair[kind][parent][child]: log potential of an edge."""

    def __init__(self):
        self.unary: dict[str, float] = {}
        self.pair = {k: [[0.5, -0.5], [-0.5, 0.5]] for k in EDGES}

    def marginals(self, page: Page, pairs: bool = False):
        """P(content) of every node by one upward and one downward pass; with `pairs` also each edge's 2 x 2 table.

        Messages are log-odds.  Children come after parents, so both passes are plain loops, at any depth.
        """
        unary, parent, edge = self.unary, page.parent, page.edge
        n = len(parent)
        belief = [sum(unary.get(f, 0.0) for f in fs) for fs in page.features]
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            (a, b), (c, d) = self.pair[edge[i]]
            up[i] = logadd(c, d + belief[i]) - logadd(a, b + belief[i])
            belief[parent[i]] += up[i]
        tables = [None] * n
        inner = belief[:]
        for i in range(1, n):
            (a, b), (c, d) = self.pair[edge[i]]
            rest = belief[parent[i]] - up[i]
            if pairs:
                cells = (a, b + inner[i], c + rest, d + rest + inner[i])
                top = max(cells)
                e = [math.exp(x - top) for x in cells]
                tables[i] = [x / sum(e) for x in e]
            belief[i] += logadd(b, d + rest) - logadd(a, c + rest)
        p = [1 / (1 + math.exp(-max(-60.0, min(60.0, x)))) for x in belief]
        return (p, tables) if pairs else p

    def fit(self, pages: list[tuple[Page, list[int]]], epochs: int = EPOCHS) -> TreeModel:
        """Maximum likelihood with a ridge: the gradient is observed minus expected counts (AdaGrad steps)."""
        past: dict = {}
        for _ in range(epochs):
            slope: dict = {}
            for page, labels in pages:
                p, tables = self.marginals(page, pairs=True)
                for i, fs in enumerate(page.features):
                    for f in fs:
                        slope[f] = slope.get(f, 0.0) + labels[i] - p[i]
                    if i:
                        for x in range(4):
                            key = page.edge[i], x >> 1, x & 1
                            slope[key] = slope.get(key, 0.0) + (2 * labels[page.parent[i]] + labels[i] == x) - tables[i][x]
            for key, g in slope.items():
                here = self.unary.get(key, 0.0) if isinstance(key, str) else self.pair[key[0]][key[1]][key[2]]
                g = g / len(pages) - RIDGE * here
                past[key] = past.get(key, 1e-6) + g * g
                moved = here + RATE * g / math.sqrt(past[key])
                if isinstance(key, str):
                    self.unary[key] = moved
                else:
                    self.pair[key[0]][key[1]][key[2]] = moved
        return self


def logadd(x: float, y: float) -> float:
    return (x + math.log1p(math.exp(y - x))) if x >= y else (y + math.log1p(math.exp(x - y)))


# ---- labelled pages -------------------------------------------------------------------------------------------------

def labelled_pages(count: int = 140, seed: int = SEED) -> list[str]:
    """Pages whose elements say in data-label whether their text is content (1) or not (0).

    They are put together from common layouts in a fixed random order; their number is the bound of the
    training sample.  Texts are made-up words, so that only structure can be learned.
    """
    r = random.Random(seed)

    def words(n: int) -> str:
        return " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 8))) for _ in range(n))

    def sentences(most: int) -> str:
        return " ".join(words(r.randint(1, 14)).capitalize() + r.choice(("." * 9) + "!?,") for _ in range(r.randint(1, most)))

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{words(1)}">{words(r.randint(1, 3))}</a></{tag}>' for _ in range(n))

    def furniture(inside: bool) -> str:
        name = lambda *own: r.choice(own)
        kinds = [
            lambda: f'<div class="{name("ad", "ads", "advert", "ad-slot banner", "promo", "sponsored")}" data-label="0">{sentences(2)}</div>',
            lambda: f'<aside data-label="0"><h3>{words(2)}</h3><ul>{links(r.randint(2, 5))}</ul></aside>',
            lambda: f'<div class="{name("sidebar", "widget", "related", "share social")}" data-label="0"><p>{words(4)}</p><ul>{links(3)}</ul></div>',
            lambda: f'<form action="/s" data-label="0"><p>{words(3)}</p><label>{words(1)}</label><input name="q"></form>',
            lambda: f'<div class="{name("newsletter", "subscribe", "signup")}" data-label="0"><p>{sentences(2)}</p></div>',
            lambda: f'<{name("section", "div")} {name("id", "class")}="{name("comments", "comment-list", "discussion", "respond")}" data-label="0"><h2>{words(2)}</h2>'
                    + "".join(f'<div class="comment"><p>{sentences(3)}</p></div>' for _ in range(r.randint(1, 4))) + "</SAME>",
            lambda: f'<nav data-label="0"><ul>{links(r.randint(2, 7))}</ul></nav>',
        ]
        outer = [
            lambda: f'<header data-label="0"><h2>{words(2)}</h2><p>{words(5)}</p></header>',
            lambda: f'<div class="{name("header", "masthead", "topbar")}" data-label="0"><p>{words(3)}</p></div>',
            lambda: f'<div class="{name("cookie", "cookie-notice", "notice", "gdpr consent", "popup modal")}" data-label="0"><p>{sentences(2)}</p></div>',
            lambda: f'<div role="{name("navigation", "banner", "search", "dialog", "complementary")}" data-label="0"><p>{words(5)}</p></div>',
            lambda: f'<div class="{name("menu", "nav", "breadcrumb", "navbar")}" data-label="0">{links(4, "span")}</div>',
        ]
        made = r.choice(kinds if inside else kinds + outer)()
        return made.replace("</SAME>", "</section>" if made.startswith("<section") else "</div>")

    def paragraph() -> str:
        kind = r.random()
        if kind < 0.08:
            return f"<ul>{''.join(f'<li>{sentences(1)}</li>' for _ in range(r.randint(2, 5)))}</ul>"
        if kind < 0.14:
            return f"<blockquote><p>{sentences(2)}</p></blockquote>"
        if kind < 0.2:
            return f"<h2>{words(r.randint(1, 5))}</h2>"
        if kind < 0.23:
            return f"<table><tr><th>{words(1)}</th><td>{words(2)}</td></tr></table>"
        if kind < 0.3:
            return f'<p>{sentences(3)} <a href="/x">{words(3)}</a> {sentences(1)}</p>'
        if kind < 0.36:
            return f'<p><a href="/{words(1)}">{words(3)}</a></p>'
        if kind < 0.42:
            return f"<div>{sentences(4)}</div>"
        return f"<p>{words(r.randint(1, 3)) if kind > 0.9 else sentences(r.choice((1, 1, 3, 8)))}</p>"

    def page() -> str:
        body = [f"<h1>{words(r.randint(1, 7))}</h1>"] * (r.random() < 0.75)
        for _ in range(r.choice((1, 1, 2, 4, 8, 14))):
            body.append(furniture(True) if r.random() < 0.07 else paragraph())
        tag, attrs = r.choice((("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="content"'), ("div", ' id="main-content"'),
                               ("div", ' class="entry-content"'), ("section", ' class="article-body"'), ("div", ""), ("section", "")))
        core = f'<{tag}{attrs} data-label="1">{"".join(body)}</{tag}>'
        if r.random() < 0.3:
            core = f'<{r.choice(("main", "div", "section"))}>{core}</main></div></section>'
        before = [f'<nav data-label="0"><ul>{links(r.randint(3, 8))}</ul></nav>'] * (r.random() < 0.7) + [furniture(False) for _ in range(r.randint(0, 3))]
        after = [furniture(False) for _ in range(r.randint(0, 3))]
        after += [f'<footer data-label="0">{r.choice(("&copy; ", "Copyright ", ""))}{words(2)} &middot; {sentences(2)}</footer>'] * (r.random() < 0.9)
        if r.random() < 0.12:  # a fragment
            return "".join(before[:1]) + core
        return f'<!DOCTYPE html><html><head><title>{words(4)}</title></head><body>{"".join(before)}{core}{"".join(after)}</body></html>'

    return [page() for _ in range(count)]


def labels_of(page: Page) -> list[int]:
    """Labels of a labelled page's nodes: the nearest data-label above (0 if there is none)."""
    found: list[int] = []
    for i, mark in enumerate(page.mark):
        found.append(int(mark) if mark is not None else found[page.parent[i]] if i else 0)
    return found


def train(count: int = 140) -> TreeModel:
    pages = [Page(h) for h in labelled_pages(count)]
    return TreeModel().fit([(p, labels_of(p)) for p in pages])


# ---- use ---------------------------------------------------------------------------------------------------------------

def main_blocks(html: str | None, model: TreeModel) -> list[str]:
    """The content blocks of a whole page, in page order."""
    page = Page(html or "")
    return [b for b, p in zip(page.block, model.marginals(page)) if b is not None and p >= 0.5]


def extract_text(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of pages(page_id, url, html).

    The main text's blocks are joined by a blank line.  NULL and empty pages, and pages without content,
    give an empty text; broken markup is read as a browser would roughly do, to its end.  Repeated rows
    give repeated results; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(main_blocks(h.as_py(), shared.value)) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
