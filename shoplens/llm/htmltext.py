"""Main text of web pages by composite text density.

A page is read into a tree, character by character once, by HTML's rules for tags, attributes, comments and raw text. What is
never main text by its tag, role or class (menus, forms, reader comments, ...) is cut off. Every node has a density, its
characters per tag, turned down the more of its characters and tags are links; inside an article or main element it weighs
more. The node whose children's densities have the largest sum is the centre of the main text. The smallest density on the
way from the body to it is the threshold: what is beside the way, of whatever tag, belongs to the text if it reaches the
threshold, or leads to the centre as a heading; beyond the article or main element of the centre it must reach twice that.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import text_or_empty

# Fixed values of HTML: elements without content, with raw content, that break a block, and that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot
th thead tr ul caption""".split())
# Open elements that a start tag ends, up to the nearest of the elements that bound the search.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select", "datalist"})}
HEAD = frozenset("title meta link style script base noscript template".split())
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
# Elements that form words, not parts of a page: no tags to the density, and never a centre.
FORM_WORDS = frozenset("b i em strong u s strike small big sub sup mark br wbr code abbr cite q time font kbd var ins del span".split())
# Never main text, by tag, role or class.
CUT_TAGS = frozenset("nav header footer aside form button select dialog menu head object canvas audio video".split()) | RAW
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CUT_NAMES = re.compile(
    r"(?:ad|ads|advert\w*|adbox|banner\w*|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|topbar|toolbar|header|masthead|"
    r"footer|side-?bar|aside|widget\w*|notice\w*|cookies?\w*|consent|gdpr|alert\w*|popup\w*|modal|overlay|newsletter|subscribe|"
    r"signup|login|share|sharing|social|related|recommended|comments?|commentlist|disqus|repl(?:y|ies)|respond|discussion|"
    r"pagination|pager|form|search)(?:[-_]\w[\w-]*)?|(?:[\w-]+[-_])(?:nav|menu|footer|ads?|advert|comments?|sidebar|form)", re.ASCII | re.I)
COMMENT_NAMES = re.compile(r"(?:comment|repl(?:y|ies))s?(?:[-_]\w[\w-]*)?", re.ASCII | re.I)
KEPT_TAGS = frozenset({"html", "body", "main"})

# What the densities of nodes in an article or main element count, and how many thresholds what lies outside of it must reach.
MARKED, OUTSIDE = 1.5, 2.0
# Names that cut an element only outside of an article, and the deepest nesting; deeper elements are put beside each other.
PAGE_NAMES = re.compile(r"(?:header|masthead|banner\w*)(?:[-_]\w[\w-]*)?", re.ASCII | re.I)
DEEPEST = 512
MARKS = {"main": 1, "article": 2}

TAG_NAME, BEFORE_NAME, NAME = re.compile(r"[a-zA-Z][^\s/>]*"), re.compile(r"[\s/]*"), re.compile(r"=?[^\s/>=]*")
EQUALS, UNQUOTED = re.compile(r"\s*=\s*"), re.compile(r"[^\s>]*")


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "marked")

    def __init__(self, tag: str, parent: Node | None, attributes: dict[str, str] | None = None):
        self.tag, self.parent, self.attributes = tag, parent, attributes or {}
        self.children: list[Node | str] = []


def attributes_at(page: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of a tag from behind its name, and the place behind its end; -1 if the page ends within it."""
    found: dict[str, str] = {}
    while True:
        at = BEFORE_NAME.match(page, at).end()
        if at >= len(page):
            return found, -1
        if page[at] == ">":
            return found, at + 1
        name = NAME.match(page, at)
        at = name.end()
        value = ""
        if (equals := EQUALS.match(page, at)) is not None:
            at = equals.end()
            if at < len(page) and page[at] in "\"'":
                end = page.find(page[at], at + 1)
                if end < 0:
                    return found, -1
                value, at = page[at + 1:end], end + 1
            else:
                plain = UNQUOTED.match(page, at)
                value, at = plain[0], plain.end()
        found.setdefault(name[0].lower(), value)


def parse(page: str) -> Node:
    """The tree of a page; forgiving about missing and superfluous end tags. A tag that the page ends in is left out."""
    root = Node("html", None)
    stack, at, text = [root], 0, 0
    opened = Counter()
    while True:
        begin = page.find("<", at)
        if begin < 0 or begin + 1 >= len(page):
            _text(stack[-1], page[text:])
            return root
        after = page[begin + 1]
        closes = after == "/"
        name = TAG_NAME.match(page, begin + 1 + closes)
        if name is None:
            if after not in "!?/":
                at = begin + 1  # a mere sign
                continue
            _text(stack[-1], page[text:begin])
            end = page.find("-->", begin + 4) + 2 if page.startswith("<!--", begin) else page.find(">", begin)
            if end < (begin + 4 if page.startswith("<!--", begin) else 0):
                return root
            at = text = end + 1
            continue
        attributes, at = attributes_at(page, name.end())
        _text(stack[-1], page[text:begin])
        if at < 0:
            return root
        text = at
        tag = name[0].lower()
        if closes:
            if opened[tag] > 0:
                _close(stack, tag, opened)
            continue
        _make_room(stack, tag, opened)
        if tag in ("html", "body") and (tag == "html" or opened[tag]):
            continue
        node = Node(tag, stack[-1], attributes)
        stack[-1].children.append(node)
        if tag in RAW and not (tag in ("svg", "math") and page[at - 2] == "/"):
            end = raw_end(tag).search(page, at)
            at = text = end.end() if end else len(page)
        elif tag not in VOID and len(stack) < DEEPEST:
            stack.append(node)
            opened[tag] += 1


@lru_cache(maxsize=None)
def raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I)


def _drop(stack: list[Node], k: int, opened: Counter) -> None:
    """Close the open elements from place k on."""
    for node in stack[k:]:
        opened[node.tag] -= 1
    del stack[k:]


def _text(node: Node, text: str) -> None:
    if text:
        node.children.append(html.unescape(text))


def _make_room(stack: list[Node], tag: str, opened: Counter) -> None:
    if len(stack) > 1 and stack[1].tag == "head" and tag not in HEAD or tag == "body" and not opened["body"]:
        _drop(stack, 1, opened)
    if tag in ENDS:
        ended, bounds = ENDS[tag]
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in bounds:
                break
            if stack[k].tag in ended:
                _drop(stack, k, opened)
                break
    if tag in BLOCK and opened["p"]:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                _drop(stack, k, opened)
                break
            if stack[k].tag in BLOCK:
                break


def _close(stack: list[Node], tag: str, opened: Counter) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            # An inline end tag doesn't end the blocks that were opened in it.
            if tag in BLOCK or not any(n.tag in BLOCK for n in stack[k + 1:]):
                _drop(stack, k, opened)
            else:
                opened[tag] -= 1
                del stack[k]
            return
        if stack[k].tag in ("td", "th", "article", "main", "body") and tag not in ("table", "tr", "tbody", "article", "main", "body", "html", "section", "div"):
            return


def boilerplate(node: Node, marked: bool) -> bool:
    """Is the element never main text? `marked`: it lies in an article, where a header is the article's."""
    if node.tag in KEPT_TAGS:
        return False
    if node.tag in CUT_TAGS:
        return not (marked and node.tag == "header")
    found = node.attributes
    if not found:
        return False
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    if node.tag == "article":
        return any(COMMENT_NAMES.fullmatch(n) for n in names)
    cut = any(CUT_NAMES.fullmatch(n) and not (marked and PAGE_NAMES.fullmatch(n)) for n in names)
    return cut or "hidden" in found or found.get("role", "").lower() in CUT_ROLES


def prune(root: Node) -> list[Node]:
    """Cut boilerplate off; the rest in page order, parents first."""
    order, todo = [], [root]
    root.marked = MARKS.get(root.tag, 0)
    while todo:
        node = todo.pop()
        order.append(node)
        kept = []
        for c in node.children:
            if not isinstance(c, str):
                if boilerplate(c, node.marked == MARKS["article"]):
                    continue
                c.marked = max(node.marked, MARKS.get(c.tag, 0))
            kept.append(c)
        node.children = kept
        todo += [c for c in reversed(kept) if isinstance(c, Node)]
    return order


def measure(order: list[Node], body: Node) -> None:
    """Counts of each node from the leaves upwards, then densities and the sums of the children's densities."""
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, Node)]
        node.chars = sum(len("".join(c.split())) for c in node.children if isinstance(c, str)) + sum(c.chars for c in inner)
        node.tags = sum(c.tags + (c.tag not in FORM_WORDS) for c in inner)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        else:
            node.link_chars, node.link_tags = sum(c.link_chars for c in inner), sum(c.link_tags for c in inner)
    share = body.link_chars / max(1, body.chars)
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, share) * (MARKED if node.marked else 1.0)
    for node in order:
        node.total = 0.0 if node.tag in FORM_WORDS else sum(c.density for c in node.children if isinstance(c, Node) and c.tag not in FORM_WORDS)


def density(chars: int, tags: int, link_chars: int, link_tags: int, body_share: float) -> float:
    if not chars:
        return 0.0
    tags, links, link_tags, plain = max(1, tags), max(1, link_chars), max(1, link_tags), max(1, chars - link_chars)
    base = math.log(chars / plain * links + body_share * chars + math.e)
    return chars / tags * max(0.0, math.log(chars / links * tags / link_tags) / math.log(base)) if base > 1 else float(chars / tags)


def blocks(nodes: list[Node | str]) -> list[str]:
    """Texts of the blocks in page order, white space made single blanks; empty ones left out."""
    out, run = [], []
    todo: list = list(reversed(nodes))
    breaker = object()
    while todo:
        item = todo.pop()
        if item is breaker:
            out.append(" ".join("".join(run).split()))
            run = []
        elif isinstance(item, str):
            run.append(item)
        elif item.tag in BLOCK:
            todo += [breaker, *reversed(item.children), breaker]
        else:
            if item.tag == "br":
                run.append(" ")
            todo += reversed(item.children)
    out.append(" ".join("".join(run).split()))
    return [t for t in out if t]


def main_text(page: str) -> str:
    root = parse(page)
    body = next((n for n in prune(root) if n.tag == "body"), root)
    inside = prune(body)
    measure(inside, body)
    # The innermost of equals is taken.
    centre = max(reversed(inside), key=lambda n: n.total)
    if not centre.total:
        return "\n\n".join(blocks([body]))
    path, node = [], centre
    while node is not None:
        path.append(node)
        if node is body:
            break
        node = node.parent
    threshold = min((n.density for n in path if n.chars), default=0.0)
    parts: list[Node | str] = [centre]
    for below, above in zip(path, path[1:]):
        at = next(k for k, c in enumerate(above.children) if c is below)
        # The way has left the article or main element of the centre.
        least = threshold * (OUTSIDE if centre.marked and not above.marked else 1.0)
        inner = bool(centre.marked) == bool(above.marked)
        parts = [c for c in above.children[:at] if _belongs(c, least, inner)] + parts + \
            [c for c in above.children[at + 1:] if _belongs(c, least, inner)]
    return "\n\n".join(blocks(parts))


def _belongs(item: Node | str, least: float, heading: bool) -> bool:
    if isinstance(item, str):
        chars = len("".join(item.split()))
        return chars > 0 and density(chars, 1, 0, 0, 0.0) >= least
    return heading and (item.tag in HEADINGS or item.tag == "header" and item.chars > 0) or item.density > 0 and item.density >= least


def main_texts(page: str | Column = "html") -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(text_or_empty(page))


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text and n_chars (code points). Null html is an empty text; null ids and urls stay null.

    Repeated rows give repeated results, an empty table none; other columns are not looked at.
    """
    return pages.select("page_id", "url", main_texts("html").alias("text")) \
        .withColumn("n_chars", F.char_length("text").cast("long"))
