"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query

# Kinds of HTML elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody td tfoot th thead tr ul""".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_NEVER = frozenset("""head script style noscript template iframe object embed svg canvas math map audio video button
select textarea input nav footer aside menu dialog title noembed noframes""".split())
_ENDS_P = _BLOCK - {"body", "html"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select", "optgroup"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: Words in class, id or role that mark what is no part of an article; "has-menu" and the like say where one is,
#: "menu-closed" and the like in what state.
_MARKED = re.compile(r"""(?:^|\s)sidebar\w*|(?:^|[\s_-])(?<!no-)(?<!has-)(?<!with-)(?:ads?|advert\w*|sponsor\w*|banner|promo\w*|menu\w*|nav\w*|
    breadcrumbs?|footer|masthead|toolbar|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscri\w*|
    signup|login|search|share|sharing|social|comments?|disqus|respond|reply|replies|related|recommend\w*|widget|
    complementary|contentinfo|navigation|skip|pagination|pager)(?:$|[\s_-])
    (?!(?<=[_-])(?:open|opened|closed?|enabled|disabled|on|off|active|inactive|visible|collapsed|expanded)(?:$|\s))""", re.X | re.I)
#: A marked subtree stays if it holds that many times the text that is marked nowhere.
_MOST = 10
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_TAG_END = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?(?=[\s/>]|$)""", re.I)


class Node:
    """An element: its own direct text pieces and children in order, and subtree counts."""

    __slots__ = ("tag", "parent", "parts", "drop", "marked", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, drop: bool, marked: bool = False):
        self.tag, self.parent, self.drop, self.marked = tag, parent, drop, marked
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _dropped(tag: str, within: bool) -> bool:
    """``within``: an article or main element is open."""
    return tag in _NEVER or (tag == "header" and not within)


def _marked(tag: str, attributes: str) -> bool:
    """Forms, what is hidden, and what a class, id or role names as something else than an article."""
    if tag == "form":
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and _HIDDEN.search(value) or name in ("class", "id", "role") and _MARKED.search(value):
            return True
    return False


def _nodes(root: Node) -> list[Node]:
    """All nodes in page order, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return order


def prune(root: Node) -> Node:
    """Cuts marked subtrees, but for those that hold the article.

    Those are subtrees with an article or main element inside, and those with far more text
    of their own (outside links and further marked subtrees), or of such a one inside, than the
    page has unmarked.
    """
    order = _nodes(root)
    own, most, holds, links = {}, {}, {}, {id(root): False}
    for node in order[1:]:
        links[id(node)] = links[id(node.parent)] or node.tag == "a"
    for node in reversed(order):
        text = 0 if links[id(node)] else sum(len(p) - p.count(" ") - p.count("\n") for p in node.parts if isinstance(p, str))
        inner = [p for p in node.parts if isinstance(p, Node)]
        own[id(node)] = text + sum(own[id(p)] for p in inner if not p.marked)
        most[id(node)] = max([own[id(node)], *(most[id(p)] for p in inner)])
        holds[id(node)] = node.tag in ("article", "main") or any(holds[id(p)] for p in inner)
    free = own[id(root)]  # what is kept in any case

    def stays(node: Node) -> bool:
        nonlocal free
        if not node.marked:
            return True
        if holds[id(node)] or most[id(node)] > _MOST * free:
            free += own[id(node)]
            return True
        return False

    for node in order:
        node.parts = [p for p in node.parts if isinstance(p, str) or stays(p)]
    return root


def parse(page: str) -> Node:
    """The element tree of a page in one pass; unclosed elements end where HTML lets them."""
    root = Node("html", None, False)
    stack, at, size, quotes = [root], 0, len(page), True
    places: dict[str, list[int]] = {}  # of the open elements of each tag in the stack

    def text(piece: str) -> None:
        if piece and not stack[-1].drop:
            stack[-1].parts.append(html.unescape(piece))

    def close(tags: frozenset | set, scope: frozenset | set) -> None:
        last = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if last and all(last >= places[t][-1] for t in scope if places.get(t)):
            while len(stack) > last:
                places[stack.pop().tag].pop()

    while at < size:
        found = _OPEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at:found.start()])
        comment, other, slash, tag = found.groups()
        if comment:
            end = page.find("-->", found.end())
            at = size if end < 0 else end + 3
            continue
        end = _TAG_END.match(page, found.end()) if quotes and not other else None
        if end:
            stop = end.end()
        else:  # a declaration, or a quote that is never closed: the tag ends at the next bracket
            quotes = quotes and bool(other)
            stop = page.find(">", found.end()) + 1
            if not stop:
                break  # the page ends inside a tag
        at = stop
        if other:
            continue
        tag = tag.lower()
        if slash:
            if tag == "br":
                text("\n")
            elif tag not in _VOID and tag not in ("html", "body"):
                close({tag}, {"table"} if tag in ("p", "li", "dd", "dt") else set())
            continue
        attributes = page[found.end():stop - 1]
        if tag in ("html", "body"):
            continue
        if tag in _ENDS_P:
            close({"p"}, {"table", "td", "th", "div", "section", "article", "li", "blockquote", "button"})
        if tag in _ENDS:
            while True:
                before = len(stack)
                close(*_ENDS[tag])
                if len(stack) == before:
                    break
        parent = stack[-1]
        drop = parent.drop or _dropped(tag, bool(places.get("article") or places.get("main")))
        node = Node(tag, parent, drop, not drop and _marked(tag, attributes))
        if not node.drop:
            parent.parts.append(node)
        if tag in _RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = size if end is None else end.start()
            if end:
                at = page.find(">", at) + 1 or size
        elif tag not in _VOID:
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    return root


def _measure(root: Node) -> list[Node]:
    """Subtree counts and densities; nodes in page order, parents first."""
    order = _nodes(root)
    for node in reversed(order):
        node.chars += sum(len(p) - p.count(" ") - p.count("\n") for p in node.parts if isinstance(p, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        parent = node.parent
        if parent is not None:
            parent.chars += node.chars
            parent.tags += node.tags + 1
            parent.link_chars += node.link_chars
            parent.link_tags += node.link_tags
    ratio = root.link_chars / max(1, root.chars)
    for node in order:
        node.density = _density(node, ratio)
    for node in order:
        if node.parent is not None:
            node.parent.total += node.density
    return order


def _density(node: Node, ratio: float) -> float:
    """Characters per tag, weighed down as the share of links in characters and tags grows.

    ``ratio`` is the share of link characters in the whole page.
    """
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
    plain = max(1, node.chars - node.link_chars)
    base = math.log(node.chars / plain * node.link_chars + ratio * node.chars + math.e)
    weight = node.chars / links * tags / link_tags
    return node.chars / tags * math.log(max(1.0, weight), max(base, 1.0 + 1e-9))


def _containers(order: list[Node]) -> list[Node]:
    """Elements that hold blocks; paragraphs and what is inside them are what densities are summed over."""
    return [n for n in order if n.parent is None or n.tag in _BLOCK and any(
        isinstance(p, Node) and p.tag in _BLOCK for p in n.parts)]


def select(order: list[Node]) -> list[Node]:
    """The subtrees that hold the article, in page order.

    The container with the largest sum of its children's densities is the core. The least
    density on its path to the body is the threshold; among subtrees beside that path,
    those as dense are kept as well.
    """
    root = order[0]
    core = max(_containers(order), key=lambda n: n.total)
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    if len(path) == 1:
        return [root]
    on_path, kept = set(map(id, path)), []

    todo: list[Node] = [root]
    while todo:
        node = todo.pop()
        if node is core:
            kept.append(node)
        elif id(node) in on_path:
            todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
        elif node.density >= threshold and node.chars:
            kept.append(node)
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks in page order, white space made single spaces."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    for top in nodes:
        todo: list[tuple[Node | str, bool]] = [(top, False)]
        while todo:
            item, leaving = todo.pop()
            if isinstance(item, str):
                line.append(item)
            elif item.tag == "br":
                line.append("\n")
            elif leaving:
                flush()
            else:
                if item.tag in _BLOCK:
                    flush()
                    todo.append((item, True))
                todo.extend((p, False) for p in reversed(item.parts))
        flush()
    return out


def main_text(page: str) -> str:
    """The article of a page: its blocks, two line feeds between them; empty if there is none."""
    order = _measure(prune(parse(page)))
    return "\n\n".join(blocks(select(order)))


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars): the article of each page, one row per row, in one narrow pass.

    Menus, headers, footers, controls and scripts are cut from the tree by element; forms,
    what is hidden, and what role, class or id name as sidebars, notices, adverts or comments
    are cut unless they hold the article, as a form around the whole page does; then composite
    text density chooses among what is left. A page is read once from start to end, so time and
    memory grow with its length alone. Null html counts as empty and gives an empty text;
    so does a page without text. Ids and urls may repeat or be null. Other columns are not
    read; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    kind = rows.schema.fields[0].dataType.simpleString()
    out = rows.mapInArrow(_text_batches, f"page_id {kind}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_col, "url": url_col})


@query()
def op4_text_density(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{folder}/pages.parquet"))
