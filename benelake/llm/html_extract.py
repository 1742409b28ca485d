"""Main text of web pages by tree scoring.

A page is read once into a tree of its block elements; the inline text between
two block boundaries is a paragraph. Each paragraph passes points for its
length and commas to its parent element, half of them to the grandparent, a
third to the next, both less the share of linked text; a container's score is
discounted by its link density again. The
best container is kept with all that stands next to it and isn't links (under a
name of clutter: that scores well too); inside ``article`` or ``main`` the whole of
that element is the container, an ``article`` with the articles next to it.

Left out wherever they stand: scripts, styles, forms, embedded objects, menus,
page headers and footers, asides, hidden elements, and elements whose role names
clutter. A class or id that names it (adverts, sidebars, comments, ...) is weighed
against what the element holds: see ``_is_cut``.

Edge cases: null or empty html, or a page without text, gives the empty text;
end tags without a start are ignored, missing end tags are implied by what
follows; a page may stop anywhere; rows that repeat are read each for itself;
other columns are kept.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
_LISTS = frozenset("ul ol dl menu body div article section main".split())
_TABLES = frozenset(["table"])

# What clutter is called.
_CLUTTER_TAGS = frozenset("script style noscript template textarea title head form button select option input iframe object embed svg canvas audio video map nav menu footer aside dialog".split())
_CLUTTER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar tablist form".split())
_CLUTTER_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidenav rail widget widgets footer masthead comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations newsletter subscribe subscription signup login popup modal overlay toolbar pagination pager skip hidden outbrain taboola topbar".split())
_COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
_HEADER_NAMES = frozenset("header topnav siteheader".split())
_MODIFIERS = frozenset("no non not has have with without free".split())  # has-sidebar, ad-free: about another element
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LOWERED = 0.25  # share of the points that text under a name of clutter passes on


class _Node:
    __slots__ = ("tag", "parent", "order", "score", "chars", "linked", "named", "inside", "holds", "prose", "flag")

    def __init__(self, tag: str, parent, order: int):
        self.tag, self.parent, self.order = tag, parent, order
        self.score, self.chars, self.linked = 0.0, 0, 0
        self.named, self.inside, self.holds, self.prose, self.flag = 0, False, False, False, False


def _is_clutter(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _CLUTTER_TAGS:
        return True
    if tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in _CLUTTER_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _named(tag: str, attributes: str, in_article: bool) -> int:
    """3 if a class or an id names reader comments, 2 if other clutter, 1 if
    one has such a name as a part."""
    if not attributes or tag in ("html", "body") or tag in _HEADINGS:
        return 0
    names, found = _CLUTTER_NAMES if in_article else _CLUTTER_NAMES | _HEADER_NAMES, 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for word in next((v for v in values if v), "").split():
                parts = {p.lower() for p in _PART.findall(word)}
                if parts & names and not parts & _MODIFIERS:
                    whole = (parts <= names or word.lower() in names) and parts != {"social"}  # which may be its subject
                    found = max(found, 1 if not whole else 3 if parts & _COMMENT_NAMES else 2)
    return found


def _is_cut(node: _Node, unlinked: int) -> bool:
    """Whether an element goes for its name; ``unlinked``: text of the page
    outside links. None goes that holds the article, and reader comments go
    however long they are. Of the others none goes that holds most of that text;
    one of which the name is only a part goes if it is links, or, outside of the
    article, without running text."""
    if not node.named or not node.inside and (node.holds or node.tag in ("article", "main")):
        return False
    if node.named == 3:
        return True
    if 2 * (node.chars - node.linked) > unlinked:
        return False
    if node.named == 2 or node.linked * 4 >= node.chars:
        return True
    return not node.inside and not (node.prose and node.chars - node.linked > 80)


def _up(node: _Node | None):
    while node is not None:
        yield node
        node = node.parent


def _weigh(nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> None:
    """Characters of text and of linked text under each element, and whether
    there is running text: from the leaves up, once. ``nodes`` are in the order
    of their start tags."""
    for at in nodes:
        at.chars, at.linked, at.prose = 0, 0, False
    for own, text, linked in blocks:
        own.chars += len(text)
        own.linked += min(linked, len(text))
        own.prose |= linked * 4 < len(text) and (len(text) > 80 or re.search(r"\.( |$)", text) is not None)
    for at in reversed(nodes[1:]):
        at.parent.chars += at.chars
        at.parent.linked += at.linked
        at.parent.prose |= at.prose


def _mark(nodes: list[_Node], test) -> None:
    """Flag the elements that pass ``test`` and all below them."""
    for at in nodes:
        at.flag = test(at) or at.parent is not None and at.parent.flag


def _uncluttered(nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> list[tuple[_Node, str, int]]:
    """The blocks outside of elements that go for their names; all if none is left."""
    if not any(n.named for n in nodes):
        return blocks
    _weigh(nodes, blocks)
    unlinked = sum(len(t) - min(n, len(t)) for _, t, n in blocks)
    _mark(nodes, lambda n: _is_cut(n, unlinked))
    return [b for b in blocks if not b[0].flag] or blocks


def main_text(page: str | None) -> str:
    """The main text of one page, its blocks joined by an empty line."""
    if not page:
        return ""
    root = _Node("#", None, 0)
    stack: list[tuple[str, _Node | None]] = []  # open elements; inline ones without a node
    node, blocks, skipped = root, [], 0  # skipped: depth of the stack at which clutter began
    nodes, standing = [root], []  # all elements with a node; places in the stack of the open ones
    pieces: list[str] = []
    linked, in_link, articles, order = 0, 0, 0, 0

    def finish():
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append((node, text, linked))
            pieces.clear()
        linked = 0

    def pop_to(depth: int):
        nonlocal node, skipped, in_link, articles
        while len(stack) > depth:
            tag, own = stack.pop()
            if own is not None:
                standing.pop()
                finish()
                node = own.parent
                articles -= tag in ("article", "main")
            elif tag == "a":
                in_link -= 1
        if skipped and len(stack) < skipped:
            skipped = 0

    def opened(*names: str, within: frozenset = frozenset()) -> int:
        for i in reversed(standing) if names[0] in _BLOCK else range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in within:
                return -1
        return -1

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at and not skipped:
            pieces.append(page[at:lt])
            if in_link:
                linked += lt - at
        if lt == end:
            break
        token = _TOKEN.match(page, lt) or _LOOSE.match(page, lt)
        if token is None:  # a bare < is text
            cut = page.find("<", lt + 1)
            if re.match(r"</?[A-Za-z!]", page[lt : lt + 3]) and page.find(">", lt) < 0:
                break  # the page ends inside a tag
            if not skipped:
                pieces.append("&lt;" + page[lt + 1 : cut if cut > 0 else end])
            at = cut if cut > 0 else end
            continue
        at = token.end()
        if not token[2]:  # a comment or declaration
            continue
        closing, tag, attributes = token[1], token[2].lower(), token[3]
        if closing:
            if tag == "p" and opened("p") < 0:
                finish()
            elif (i := opened(tag)) >= 0 and (tag in _BLOCK or all(t not in _BLOCK for t, _ in stack[i:])):
                pop_to(i)
            continue
        if tag in _RAW and not attributes.rstrip().endswith("/"):
            close = re.compile(f"</{tag}[\\s>/]", re.I).search(page, at)
            at = page.find(">", close.start()) + 1 if close else end
            at = at or end
            continue
        if tag in _VOID:
            if not skipped:
                finish() if tag == "hr" else pieces.append(" ") if tag == "br" else None
            continue
        if tag in _BLOCK:
            i = opened("p", within=_BLOCK - {"p"})
            if i >= 0:
                pop_to(i)
            if tag in _IMPLIED:
                within = _LISTS if tag in ("li", "dt", "dd") else _TABLES
                while (i := opened(*_IMPLIED[tag], within=within)) >= 0:
                    pop_to(i)
            finish()
            order += 1
            node = _Node(tag, node, order)
            nodes.append(node)
            standing.append(len(stack))
            stack.append((tag, node))
            if not skipped:
                node.named, node.inside = _named(tag, attributes, articles > 0), articles > 0
                if tag in ("article", "main"):
                    for above in _up(node.parent):
                        above.holds = True
            articles += tag in ("article", "main")
        else:
            stack.append((tag, None))
            in_link += tag == "a"
        named = tag not in _BLOCK and "-" not in tag and _named(tag, attributes, articles > 0) > 1  # a block is weighed at the end
        if not skipped and (named or _is_clutter(tag, attributes, articles > 0)):
            skipped = len(stack)
    pop_to(0)
    finish()
    return _best(nodes, _uncluttered(nodes, blocks))


def _best(nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> str:
    """Score the containers of the blocks and keep the best one's."""
    scored: dict[int, _Node] = {}
    _weigh(nodes, blocks)
    _mark(nodes, lambda n: n.named and not n.inside)
    for own, text, linked in blocks:
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(linked / len(text), 1))
        if own.flag:
            points *= _LOWERED
        at = own if own.tag in ("div", "section", "article", "main", "body", "#") else own.parent
        for share in (1, 2, 3):
            if at is None or at.tag == "#":
                break
            at.score += points / share
            scored[at.order] = at
            at = at.parent
    value = lambda n: n.score * (1 - n.linked / max(n.chars, 1))
    best = max(scored.values(), key=lambda n: (value(n), -n.order), default=None)
    if best is None or best.tag in ("html", "#"):
        return "\n\n".join(t for _, t, _ in blocks)
    whole, at = None, best
    while at is not None:
        if at.tag in ("article", "main"):
            whole = at
        at = at.parent

    def outer(at: _Node) -> _Node:
        """The outermost element that holds no more text than ``at``."""
        while at.parent is not None and at.parent.tag not in ("html", "#") and at.parent.chars == at.chars:
            at = at.parent
        return at

    above = {id(x) for x in _up(best)}
    own_name = lambda n: n.named and n.parent is not None and id(n) not in above
    top = outer(whole or best)
    kept = {id(whole or best)}
    if whole is not None and whole.tag == "article":  # and the articles next to it
        _mark(nodes, own_name)
        for at in nodes:
            if at.tag == "article" and not at.inside and at.chars and outer(at).parent is top.parent and at.linked * 2 < at.chars and not at.flag:
                kept.add(id(at))
    _mark(nodes, lambda n: id(n) in kept)
    # next to the best container stands the part of the page that each element belongs to
    beside: dict[int, tuple[_Node | None, bool]] = {id(top.parent): (None, False)}
    for at in nodes:
        if at.parent is not None and id(at.parent) in beside:
            part, named = beside[id(at.parent)]
            beside.setdefault(id(at), (part or at, named or bool(own_name(at))))
    out = []
    for own, text, linked in blocks:
        if own.flag:
            out.append(text)
        elif whole is None and id(own) in beside:
            # all that isn't links; under a name of clutter only what scores well too
            part, named = beside[id(own)]
            plain = linked * 4 < len(text) and (part is None or part.linked * 4 < part.chars)
            sentence = own.tag == "p" and own is part and len(text) - linked > 3 and text[-1] in ".!?"
            if (plain or sentence) and (not named or value(part) >= 0.2 * value(best)):
                out.append(text)
    return "\n\n".join(out)


def extract_text(pages: DataFrame, column: str = "html", name: str = "text", count: str = "n_chars") -> DataFrame:
    """All rows of ``pages``, the html replaced by the main text and its number
    of code points."""
    carried = [f for f in pages.schema.fields if f.name.lower() not in (column.lower(), name.lower(), count.lower())]
    schema = T.StructType([*carried, T.StructField(name, T.StringType()), T.StructField(count, T.LongType())])

    def run(stream):
        for batch in stream:
            texts = [main_text(x.as_py()) for x in batch.column(batch.schema.get_field_index(column))]
            out = [batch.column(batch.schema.get_field_index(f.name)) for f in carried]
            yield pa.RecordBatch.from_arrays([*out, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return pages.select(*[F.col(f"`{f.name}`") for f in carried], F.col(f"`{column}`")).mapInArrow(run, schema)
