"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements by how they are parsed and laid out.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup"
    " option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("br caption tbody td tfoot th thead tr option optgroup body head html legend".split())
#: An opening tag ends an open element of these kinds, if no element of the second kinds stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that never hold main text, controls of forms among them.
DROPPED = frozenset(
    "script style noscript template svg math canvas iframe object embed audio video map textarea title head"
    " button select input label legend datalist output meter progress noembed noframes".split()
)
#: Elements that mark what stands around the main text, unless a page stands in one.
AROUND = frozenset("nav aside footer form dialog menu".split())
#: Of these and of the marks, those that no wrapper of a page bears: menus, reader comments, requests for consent.
CERTAIN = frozenset(
    "nav menu dialog navbar navigation menubar breadcrumb breadcrumbs pagination pager comment comments commentlist disqus respond"
    " reply replies cookie cookies consent gdpr popup modal".split()
)
#: Words of class, id or role that do the same.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay"
    " cookie cookies consent gdpr notice notices alert disclaimer paywall subscribe subscription newsletter signup login"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer"
    " sidebar aside widget complementary contentinfo related recommended recommendations share sharing social follow"
    " comment comments commentlist disqus respond responses reply replies discussion search skip privacy copyright".split()
)
#: With one of these in the same name, a mark tells of the layout ("no-sidebar") or of a part of the article ("entry-header").
UNMARKS = frozenset("has with no without layout".split())
ARTICLE_PARTS = frozenset("article entry post story content title".split())
#: Marks that name a section; on a paragraph or heading they tell what it is about.
SECTION_MARKS = frozenset("comments commentlist respond responses replies discussion search privacy sidebar".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: A block with so many words outside links reads like main text.
READABLE = 20
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SLICE = 64


class Node:
    """An element: its children are nodes and texts in page order.

    `dropped`: it and all below it are no main text; `marks`: names that make it so, unless `settle` finds that the page stands in it.
    """

    __slots__ = (
        "name", "children", "dropped", "marks", "plain", "long", "reads", "chars", "tags", "link_chars", "link_tags", "density", "total", "best", "blocks", "lines",
    )

    def __init__(self, name: str, dropped: bool = False, marks: frozenset[str] = frozenset()):
        self.name, self.dropped, self.marks, self.children = name, dropped, marks, []
        self.plain, self.long, self.reads = 0, 0, False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.best, self.blocks, self.lines = self, False, True


def _marks(name: str, attributes: str, inside_article: bool) -> tuple[bool, frozenset[str]]:
    """Whether an element never holds main text, and what marks it as standing around it."""
    if name in DROPPED:
        return True, frozenset()
    marks = {name} if name in AROUND or name == "header" and not inside_article else set()
    if name in ("html", "body") or not attributes:
        return False, frozenset(marks)
    for key, value in _ATTR.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
            return True, frozenset()
        if key in ("class", "id", "role"):
            for words in value.split():
                marks |= _marks_in(words, name, inside_article)
    return False, frozenset(marks)


def _marks_in(value: str, name: str, inside_article: bool) -> set[str]:
    words = {w.lower() for w in _WORDS.findall(value)}
    found = words & MARKS
    if "header" in found and (inside_article or words & ARTICLE_PARTS):
        found = found - {"header"}
    if name in PARAGRAPHS and inside_article:
        found = found - SECTION_MARKS
    return set() if words & UNMARKS else found


def parse(page: str) -> Node:
    """The element tree of a page, whatever is missing or wrongly nested in it."""
    root = Node("#root")
    stack, articles, at, end = [root], 0, 0, len(page)
    open_ = Counter()  # names on the stack, so that a search for one that isn't there ends at once

    def text(raw: str) -> None:
        if raw:
            stack[-1].children.append(html.unescape(raw))

    def pop_to(depth: int) -> None:
        nonlocal articles
        articles -= sum(n.name in ("article", "main") for n in stack[depth:])
        open_.subtract(n.name for n in stack[depth:])
        del stack[depth:]

    def close(names: set[str] | frozenset[str], barriers: set[str] | frozenset[str]) -> None:
        for depth in range(len(stack) - 1 if any(open_[n] for n in names) else 0, 0, -1):
            if stack[depth].name in names:
                return pop_to(depth)
            if stack[depth].name in barriers:
                return None
        return None

    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            text(page[at:])
            break
        text(page[at : tag.start()])
        at = tag.end()
        closing, name, attributes = tag.group(1), tag.group(2), tag.group(3)
        if name is None:
            if tag.group().startswith("<![CDATA["):
                stack[-1].children.append(tag.group()[9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if closing:
            if name == "p" and not open_["p"]:
                stack[-1].children.append(Node("p"))
            elif name == "br":
                stack[-1].children.append(Node("br"))
            else:
                close({name}, {"table"} if name not in BLOCK else {"td", "th"} if name == "p" else frozenset())
            continue
        if name in CLOSES_P:
            close({"p"}, {"td", "th", "table", "button"})
        if name in ENDS:
            close(*ENDS[name])
        if name in ("html", "body") and open_[name]:
            continue
        if name == "body":
            close({"head"}, frozenset())
        node = Node(name, *_marks(name, attributes, articles > 0))
        stack[-1].children.append(node)
        if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            found = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            inner = page[at : found.start() if found else end]
            node.children.append(html.unescape(inner) if name in ("title", "textarea") else inner)
            at = found.end() if found else end
            continue
        stack.append(node)
        open_[name] += 1
        articles += name in ("article", "main")
    return root


def _kept(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node) and not c.dropped]


def _in_order(root: Node) -> list[Node]:
    """All kept nodes, each before those below it; no recursion, as pages may nest deeply."""
    order, todo = [], [root]
    while todo:
        order.append(node := todo.pop())
        todo.extend(reversed(_kept(node)))
    return order


def settle(root: Node) -> Node:
    """Drop the marked elements of a page, but for those that the page stands in.

    Marks are names, and names mislead: a form or a "sidebar-right" may wrap a page, an article may be "comments-open". So one that holds more
    than half of the page's characters outside links stays if it is an article or a main, or has an unmarked one in it. A form, or
    an element with no `CERTAIN` mark, stays also if it has two blocks that read like main text (`READABLE` words outside links),
    a form whatever stands beside it, others if no unmarked block outside reads so. Long comments beside a
    short article go, therefore. What is marked within an element that stays is judged by the same rule.
    """
    order = _in_order(root)
    articles: set[int] = set()
    own: dict[int, int] = {}  # words outside links and outside the blocks in a node
    for node in reversed(order):
        below, texts = _kept(node), [c for c in node.children if isinstance(c, str)]
        if node.name == "a":
            own[id(node)] = 0
        else:
            own[id(node)] = sum(len(c.split()) for c in texts) + sum(own[id(c)] for c in below if c.name not in BLOCK)
            node.plain = sum(len("".join(c.split())) for c in texts) + sum(c.plain for c in below)
        readable = node.name in BLOCK and own[id(node)] >= READABLE
        node.long = readable + sum(c.long for c in below)
        node.reads = not node.marks and (readable or any(c.reads for c in below))
        if not node.marks and (node.name in ("article", "main") or any(id(c) in articles for c in below)):
            articles.add(id(node))
    around, reads = root, False
    while inner := next((c for c in _kept(around) if 2 * c.plain > root.plain), None):
        reads = reads or own[id(around)] >= READABLE or any(c.reads for c in _kept(around) if c is not inner)
        if inner.marks:
            article = inner.name in ("article", "main") or any(id(c) in articles for c in _kept(inner))
            wraps = inner.long >= 2 and (inner.name == "form" or not reads) and not inner.marks & CERTAIN
            if not article and not wraps:
                break
            inner.marks = frozenset()
        around = inner
    for node in order:
        node.dropped = node.dropped or bool(node.marks)
    return root


def weigh(root: Node) -> list[Node]:
    """Fill in characters, tags, links, composite text density and the sum of child densities of every node."""
    order = _in_order(root)
    for node in reversed(order):
        below = _kept(node)
        node.chars = sum(len("".join(c.split())) for c in node.children if isinstance(c, str)) + sum(c.chars for c in below)
        node.tags = sum(c.tags + 1 for c in below)
        is_link = node.name == "a"
        node.link_chars = node.chars if is_link else sum(c.link_chars for c in below)
        node.link_tags = sum(c.link_tags + (c.name == "a") for c in below)
    body = next((n for n in order if n.name == "body"), root)
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node in order:
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
    for node in reversed(order):
        _add_up(node, ratio)
    return order


def _add_up(node: Node, ratio: float) -> None:
    """The sum of child densities of `node`, and the node with the greatest sum below it; children come first.

    Children are blocks, and runs of text and inline elements between them. An inline element with blocks
    in it stands for these; inline elements are no content of their own. A block of nothing but lines counts for no less than its lines do, so
    that one paragraph with line breaks does not outweigh the text it is part of. Of equal sums, an article or main comes first.
    """
    total, chars, tags = 0.0, 0, 0
    for child in [*node.children, None]:
        if isinstance(child, str):
            chars += len("".join(child.split()))
        elif child is None or not child.dropped and (child.name in BLOCK or child.blocks):
            total += _density(chars, tags, 0, 0, ratio)
            chars = tags = 0
            if child is not None:
                total += child.total if child.name not in BLOCK else max(child.density, child.total) if child.lines else child.density
                node.blocks = True
                node.lines = node.lines and child.lines and (child.name == "br" or child.name not in BLOCK)
        elif not child.dropped:
            chars += child.chars - child.link_chars
            tags += 1 + child.tags - child.link_tags - (child.name == "a")
    inline = node.name not in BLOCK and node.name != "#root"
    node.total = 0.0 if inline and not node.blocks else total
    found = [c.best for c in _kept(node)]
    node.best = max(found if inline and found else [node, *found], key=lambda n: (n.total, n.name in ("article", "main")))


def _density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """Characters per tag, less where links hold them; `ratio` is the share of characters in links on the page."""
    if not chars:
        return 0.0
    tags = max(1, tags)
    base = math.log(chars / max(1, chars - link_chars) * link_chars + ratio * chars + math.e)
    plain = chars / max(1, link_chars) * tags / max(1, link_tags)
    return chars / tags * (math.log(max(1.0, plain), base) if base > 1 else 1.0)


def main_nodes(root: Node) -> list[Node]:
    """The content subtrees: the one with the greatest density sum, and others that reach the least density on its path to the body.

    Of each node that reaches it, the subtree with the greatest density sum is taken, and then those of its children, as far as
    they do not stand in a chosen subtree. Nodes below the threshold are left, with all in them. A tie-break: where what is
    chosen holds half the characters outside links of the closest article or main around it, or more, that element is
    taken whole, so that its headings and short blocks stay. An article that nothing chosen stands in is not taken for being one.
    """
    order = weigh(root)
    parents = {id(c): n for n in order for c in _kept(n)}
    body = next((n for n in order if n.name == "body"), root)
    threshold, node = body.best.density, body.best
    while node is not body:
        node = parents[id(node)]
        threshold = min(threshold, node.density)
    chosen: dict[int, Node] = {}
    around: dict[int, tuple[Node, list[Node]]] = {}
    todo = [body]
    while todo:
        node = todo.pop()
        if id(node) in chosen or not node.chars or node.density < threshold:
            continue
        best = node.best if node.best.total else node
        chosen[id(best)] = best
        if best is not node:
            todo.extend(_kept(node))
    below = _under(order, parents, set(chosen))
    for node in [n for i, n in chosen.items() if i not in below]:
        held = node
        while node is not body and node.name not in ("article", "main"):
            node = parents[id(node)]
        if node.name in ("article", "main"):
            around.setdefault(id(node), (node, []))[1].append(held)
    for node, inner in around.values():
        if 2 * sum(n.chars - n.link_chars for n in inner) >= node.chars - node.link_chars:
            chosen[id(node)] = node
    below = _under(order, parents, set(chosen))
    return [n for i, n in chosen.items() if i not in below]


def _under(order: list[Node], parents: dict[int, Node], ids: set[int]) -> set[int]:
    """Nodes that stand below one of `ids`; `order` has parents first."""
    found: set[int] = set()
    for node in order:
        above = parents.get(id(node))
        if above is not None and (id(above) in ids or id(above) in found):
            found.add(id(node))
    return found


def text_of(node: Node) -> str:
    """Texts of the blocks of a subtree, each with white space as single spaces, joined by a space."""
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif not item.dropped:
            edge = [" "] if item.name in BLOCK else []
            todo.extend(edge + item.children[::-1] + edge)
    return " ".join("".join(out).split())


def extract(page: str | None) -> str:
    """Main text of a page; empty for null, for an empty page and for one without text."""
    if not page:
        return ""
    root = settle(parse(page))
    nodes = main_nodes(root)
    place = {id(n): i for i, n in enumerate(_in_order(root))}
    return " ".join(t for n in sorted(nodes, key=lambda n: place[id(n)]) if (t := text_of(n)))


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            some = batch.slice(at, _SLICE)
            texts = [extract(page) for page in some["html"].to_pylist()]
            yield pa.record_batch([some["page_id"], some["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_text(df: DataFrame) -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` (code points) per row of `df` (`page_id`, `url`, `html`).

    Each page is read whole, in one task with no shuffle. Null and empty pages, and pages of nothing
    but menus and the like, give an empty text; repeated rows are extracted each; other columns are not
    read; an empty table gives no rows.
    """
    kind = dict(df.dtypes)["page_id"]
    pages = df.select("page_id", "url", "html").mapInArrow(_extractor, f"page_id {kind}, url string, text string")
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
