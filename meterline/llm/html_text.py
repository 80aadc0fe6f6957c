"""The main text of web pages by tree scoring.

A page becomes a tree. Parts that are no article by their element, role or class
(menus, headers, footers, sidebars, notices, adverts, forms, reader comments) are
cut off, unless their text says otherwise: a form or a named division with most of the
page's text and its title is a frame around the page, and a name like ``share-holders``
does not outweigh prose. Paragraphs pass points for their length and commas to their
ancestors; a container's points are discounted by the share of its text that is links.

The best container is kept, and at every level above it up to the body the bare text and
all siblings that are not mostly links. Where the page itself marks its text, the main
element around the best container is kept whole, or else all articles beside the one
around it, and the headings before that. The text comes out in blocks.

Pages are independent of each other: no shuffle, and one page at a time in memory.

Defined results: a null or empty page, and one without text, give an empty text.
Pages cut off in a tag or a character reference are read as far as they go. Pages of
any length and depth are read whole. Of containers with equal scores the first on the
page is the best. Repeated rows give the same text. An empty table gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import text_or_empty

# Element names as HTML classes them, and words that name page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "applet aside audio button canvas dialog embed footer form head iframe input map menu nav noscript object "
    "option script select style svg template textarea title video".split()
)
ENDS_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: An open element of the first kind is ended by a new one of these, up to one of the others.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
OTHER_PARTS = frozenset(
    "ad adbox ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies discussion disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification notifications pager pagination popup promo promotion related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar widget widgets".split()
)
#: Of these the ones that are parts of other names too, beside words not listed here.
MILD = frozenset("alert header menu search share sharing skip social toolbar widget widgets".split())
PLAIN = frozenset("area bar block bottom box button buttons container inner item items left link links list right top wrap wrapper".split())
BODY_PARTS = frozenset("article body content entry main post story text".split())
COMMENTS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl div section table".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CUT_TAG = re.compile(r"<[/!?]?[a-zA-Z][^<>]*\Z")

MIN_PARAGRAPH = 25
#: A list or division with a greater share of link text, in two links or more, is no part of the text.
LINKED = 0.6
#: Points of paragraphs that outweigh what a division's name says.
PROSE = 2.0
#: How sure it is that a part is no article: its text may tell, only most of the page's text may, nothing may.
MAYBE, LIKELY, SURE = 1, 2, 3


class Node:
    __slots__ = ("tag", "parent", "items", "chars", "linked", "links", "commas", "points", "titled", "doubt", "score")

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent, self.items = tag, parent, []
        self.doubt = 0
        self.clear()

    def clear(self) -> None:
        self.chars = self.linked = self.links = self.commas = 0
        self.points = self.score = 0.0
        self.titled = self.tag in ("h1", "article", "main")

    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


def other_part(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """How sure it is that an element is no part of an article, by what it says of itself."""
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return SURE
    if tag in DROPPED:
        return LIKELY if tag == "form" else SURE
    if tag in ("html", "body", "article", "main"):
        return SURE if tag == "article" and "comment" in words_of(attrs)[0] else 0
    if tag == "header":
        return 0 if in_article else SURE
    if attrs.get("role", "").lower() in ROLES or HIDDEN.search(attrs.get("style", "")):
        return SURE
    words, mixed = words_of(attrs)
    said = words & OTHER_PARTS
    if not said or tag in HEADINGS:
        return 0
    if said & COMMENTS:
        return SURE
    return MAYBE if mixed and said <= MILD else LIKELY


def words_of(attrs: dict[str, str]) -> tuple[set[str], bool]:
    """The words of classes and id, and whether a name of a part has other words too.

    A name that also says it is the body says nothing.
    """
    found: set[str] = set()
    mixed = False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [word.lower() for word in WORD.findall(name)]
        if not words or words[0] in ("has", "no", "with", "without", "is"):
            continue
        if BODY_PARTS.isdisjoint(words) or not {"comment", "comments"}.isdisjoint(words):
            found.update(words)
            mixed = mixed or not OTHER_PARTS.isdisjoint(words) and not OTHER_PARTS | PLAIN >= set(words)
    return found, mixed


class Tree(HTMLParser):
    """Builds the tree of a page without the parts that are no article; nodes are in page order."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.at = Node("", None)
        self.nodes = [self.at]
        self.open: dict[str, int] = {}
        self.dropped: Node | None = None
        self.feed(CUT_TAG.sub("", page))
        self.close()

    def leave(self) -> None:
        self.open[self.at.tag] -= 1
        if self.at is self.dropped:
            self.dropped = None
        self.at = self.at.parent

    def end(self, tags: set[str], stops: set[str]) -> None:
        """Ends the innermost open element of ``tags`` unless one of ``stops`` lies between."""
        if not any(self.open.get(tag) for tag in tags):
            return
        node = self.at
        while node.parent is not None and node.tag not in tags:
            if node.tag in stops:
                return
            node = node.parent
        if node.parent is None:
            return
        while self.at is not node:
            self.leave()
        self.leave()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self.end({"p"}, {"table", "td", "th", "button", "object"})
        if tag in ENDED_BY:
            self.end(*ENDED_BY[tag])
        if tag in VOID:
            if self.dropped is None:
                self.at.items.append(None if tag in BLOCKS else " ")
            return
        node = Node(tag, self.at)
        if self.dropped is None:
            in_article = bool(self.open.get("article") or self.open.get("main"))
            node.doubt = other_part(tag, {k: v or "" for k, v in attrs}, in_article)
            if node.doubt == SURE:
                self.dropped = node
                if tag in BLOCKS:
                    self.at.items.append(None)
            else:
                self.at.items.append(node)
                self.nodes.append(node)
        self.at = node
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br" and self.dropped is None:
            self.at.items.append(" ")
        elif self.open.get(tag):
            self.end({tag}, set() if tag in BLOCKS or tag in DROPPED else BLOCKS)

    def handle_data(self, data: str) -> None:
        if self.dropped is None:
            self.at.items.append(data)


def measure(nodes: list[Node]) -> None:
    """Sums of text, link text, commas and the points of paragraphs, from the leaves up."""
    for node in nodes:
        node.clear()
    for node in reversed(nodes):
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(item.strip())
                node.commas += item.count(",") + item.count("،") + item.count("、") + item.count("，")
        if node.tag == "a":
            node.linked, node.links = node.chars, node.links + 1
        own = paragraph_points(node)
        node.points = max(node.points, own)
        if node.parent is not None:
            above = node.parent
            above.chars += node.chars
            above.linked += node.linked
            above.links += node.links
            above.commas += node.commas
            above.points += node.points
            above.titled = above.titled or node.titled


def is_paragraph(node: Node) -> bool:
    if node.tag in PARAGRAPHS:
        return True
    return node.tag in ("div", "section") and not any(isinstance(x, Node) and x.tag in BLOCKS for x in node.items)


def paragraph_points(node: Node) -> float:
    if node.chars < MIN_PARAGRAPH or not is_paragraph(node):
        return 0.0
    return (1 + node.commas + min(node.chars / 100, 3)) * (1 - node.density())


def is_clean(node: Node) -> bool:
    return bool(node.chars) and node.density() <= LINKED


def outweighed(node: Node, page: Node) -> bool:
    """Whether the text of a doubtful part shows that it belongs to the article, or holds it."""
    if node.points < PROSE or not is_clean(node):
        return False
    if node.doubt == MAYBE:
        return True
    alone = node.tag == "form" and page.chars - node.chars < MIN_PARAGRAPH
    return 2 * node.chars > page.chars and (node.titled or alone)


def settled(nodes: list[Node]) -> list[Node]:
    """The nodes, measured, without the doubtful parts that their text does not save."""
    measure(nodes)
    cut: set[Node] = set()
    for node in nodes:
        if node.parent in cut or node.doubt and not outweighed(node, nodes[0]):
            cut.add(node)
    if not cut:
        return nodes
    for above in {node.parent for node in cut} - cut:
        items = (None if x in cut and x.tag in BLOCKS else x for x in above.items)
        above.items = [x for x in items if x not in cut]
    left = [node for node in nodes if node not in cut]
    measure(left)
    return left


def best_container(nodes: list[Node]) -> Node:
    scored: dict[Node, int] = {}
    for node in nodes:
        points = paragraph_points(node)
        above, share = node.parent, 1.0
        for depth in range(3):
            if above is None or not points:
                break
            above.score += points * share
            scored[above] = 0
            above, share = above.parent, (1 / 2, 1 / 6)[min(depth, 1)]
    if scored:
        ordered = [node for node in nodes if node in scored]
        return max(ordered, key=lambda node: node.score * (1 - node.density()))
    return next((node for tag in ("article", "main", "body") for node in nodes if node.tag == tag and node.chars), nodes[0])


def path_up(node: Node) -> list[Node]:
    """The node and those around it, outwards."""
    path = [node]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def marked_parts(nodes: list[Node], path: list[Node]) -> list[Node | str | None]:
    """What the page itself marks as its text, around the node whose path this is; empty if it marks none."""
    for tag in ("main", "article"):
        around = [node for node in path if node.tag == tag]
        if around:
            break
    else:
        return []
    if tag == "main":
        return [around[-1]]
    above, parts, inside, before = set(path) - {around[-1]}, [], set(), True
    above -= set(path[: path.index(around[-1])])
    for node in nodes:
        if node.parent in inside:
            inside.add(node)
        elif node.tag == "article":
            inside.add(node)
            if node is around[-1] or is_clean(node):
                parts.append(node)
            before = before and node is not around[-1]
        elif before and node.tag in HEADINGS and node.parent in above:
            parts.append(node)
    return parts


def clean_parts(items: list[Node | str | None]) -> list[Node | str | None]:
    """Neighbours of the text without what is empty or mostly links; menus and the like are gone before."""
    parts: list[Node | str | None] = []
    run: list[Node | str] = []

    def close() -> None:
        chars = sum(len(item.strip()) if isinstance(item, str) else item.chars for item in run)
        linked = sum(item.linked for item in run if isinstance(item, Node))
        if linked <= LINKED * chars:
            parts.extend(run)
        run.clear()

    for item in items:
        if item is not None and (isinstance(item, str) or item.tag not in BLOCKS):
            run.append(item)
            continue
        close()
        if item is None or item.tag in HEADINGS or is_clean(item):
            parts.append(item)
    close()
    return parts


def best_parts(nodes: list[Node]) -> list[Node | str | None]:
    """The parts of the page, in its order, that hold the text; ``nodes`` are measured."""
    best = best_container(nodes)
    path = path_up(best)
    marked = marked_parts(nodes, path)
    if marked:
        return marked
    before: list[list[Node | str | None]] = []
    after: list[Node | str | None] = []
    for node, above in zip(path, path[1:]):
        if node.tag == "body":
            break
        edge = [None] if above.tag in BLOCKS else []
        at = next(i for i, item in enumerate(above.items) if item is node)
        before.append([*edge, *clean_parts(above.items[:at])])
        after += [*clean_parts(above.items[at + 1 :]), *edge]
    return [*(item for level in reversed(before) for item in level), best, *after]


def is_menu(node: Node, heading: str | None) -> bool:
    """Whether a list is mostly links, and none of the article's own: short ones, not numbered, under no heading."""
    if node.tag not in LISTS or node.links < 2 or node.density() <= LINKED:
        return False
    if node.tag not in ("ul", "ol", "dl"):
        return True
    own = heading is not None and OTHER_PARTS.isdisjoint(word.lower() for word in WORD.findall(heading))
    return not (own or node.tag == "ol" or node.linked >= MIN_PARAGRAPH * node.links)


def blocks_of(parts: list[Node | str | None]) -> list[str]:
    """The text of each block, white space turned into single spaces."""
    found, text = [], []
    tops = {id(part) for part in parts}
    heading: str | None = None

    def finish() -> None:
        nonlocal heading
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            found.append(block)
            heading = None

    todo: list[Node | str | None | tuple[str]] = list(reversed(parts))
    while todo:
        item = todo.pop()
        if item is None:
            finish()
        elif isinstance(item, str):
            text.append(item)
        elif isinstance(item, tuple):
            finish()
            heading = found[-1] if found else None
        elif item.tag in LISTS and id(item) not in tops:
            finish()
            if not is_menu(item, heading):
                todo.extend([None, *reversed(item.items)])
        else:
            edge = [None] if item.tag in BLOCKS else []
            end = [("heading",)] if item.tag in HEADINGS else edge
            todo.extend([*end, *reversed(item.items), *edge])
    finish()
    return found


def main_text(page: str) -> str:
    return "\n\n".join(blocks_of(best_parts(settled(Tree(page).nodes))))


def extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page", "url", "text", "n_chars"],
        )


def extract_article(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """A row per page: id, url, text of the article, and its length in code points."""
    narrow = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))
    id_type, url_type = (narrow.schema[name].dataType.simpleString() for name in ("page", "url"))
    out = narrow.mapInArrow(extract_rows, f"page {id_type}, url {url_type}, text string, n_chars long")
    return out.withColumnsRenamed({"page": id_col, "url": url_col})
