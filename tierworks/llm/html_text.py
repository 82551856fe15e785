"""Main text of web pages by tree scoring.

A page becomes a light tree of its block elements. Elements that are never main text (scripts, menus, forms, footers,
side bars, adverts, notices, comments; by tag, role, or a whole class or id) are cut out, unless they wrap an article or
most of the text. Every text block then passes points for its
length and its commas to its container, half of them to the next and shares to the four above. A container's points are
discounted by the share of its text that lies in links. From the best container the main text is taken in whole: the
article or main around it, else the lowest node with four fifths of the page's unlinked text, with all of its siblings
but those that are mostly links. Lists of links inside an article stay.

Behaviour: null or empty html, or a page without text, gives an empty text; broken markup (unclosed or stray tags,
pages cut off anywhere) is read as browsers do, roughly; repeated rows and null ids pass through row by row; an empty
table gives an empty one; of extra columns only those asked for are kept.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

# What HTML's elements are, and the usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img picture source track object canvas svg "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder "
    "mover munderover mmultiscripts mprescripts none mtable mtr mtd mlabeledtr semantics annotation annotation-xml".split()
)
DROPPED = frozenset(
    "nav header footer aside form button dialog menu fieldset datalist audio video map select applet embed frameset".split()
)
UNSEEN = frozenset("svg annotation annotation-xml".split())  # drawings, and sources of formulas
IN_SELECT = frozenset("option optgroup hr".split())
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul dd dt tr td th tbody thead tfoot".split()
)
BREAKS = PARAGRAPH_ENDS | DROPPED | {"html", "body"}  # end a drawing that was left open
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
SCOPES = frozenset("ul ol dl table tr tbody thead tfoot div article section body html td th main blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-social comment "
    "comments commentlist respond replies disqus consent cookie cookies gdpr footer footnav header masthead menu nav "
    "navbar navigation newsletter notice notices notification alert popup modal overlay promo promotion promoted "
    "related recommended recommendations share sharing sidebar aside social sponsor sponsored subscribe subscription "
    "signup login toolbar widget widgets pagination pager skip toc sitemap disclaimer outbrain taboola".split()
)
CONTENT = frozenset("article content main post entry story body text page hentry blog prose".split())
#: Parts before a furniture word that say where it stands ("site-footer").
PLACES = frozenset(
    "site page post entry article main global top bottom left right primary secondary blog content story body single "
    "inner user reader mobile desktop social block box section area news c l js wp".split()
)
#: Parts that tell of the page around an element ("has-sidebar", "comments-open"), not of the element.
STATES = frozenset(
    "has no not with without is hide show layout open opened closed enabled disabled active none free fixed sticky".split()
)
COMMENTS = frozenset("comment comments commentlist respond replies disqus".split())
#: Words of boxes, which content words beside them do not change ("post-comments"); boxes may hold articles of their own.
BOXES = COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense consent cookie cookies gdpr footer footnav menu nav "
    "navbar navigation breadcrumb breadcrumbs related recommended recommendations share sharing sidebar aside pagination "
    "pager skip outbrain taboola".split()
)
WEAK_TAGS = frozenset("form fieldset header".split())
WEAK, BOX, HIDDEN = 1, 2, 3  # why an element is cut out: a weak tag, role or name; one of a box; as it is not shown

_RAW = "script|style|textarea|iframe|title"  # text up to the end tag, or the end of the page
_INERT = "noscript|template"  # not shown if closed before the next one starts
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<inert>{_INERT})(?=[\s/>])[^>]*>(?:[^<]|<(?!/?(?P=inert)[\s/>]))*+</(?P=inert)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""([a-zA-Z:_][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[^a-z0-9]+")
RUNNING = 80  # characters of running text


class _Node:
    __slots__ = ("tag", "parent", "items", "points", "length", "linked", "cut")

    def __init__(self, tag: str, parent: _Node | None, cut: int) -> None:
        self.tag, self.parent, self.cut = tag, parent, cut
        self.items: list = []  # nodes and blocks in page order
        self.points, self.length, self.linked = 0.0, 0, 0


def _named(token: str, words: frozenset[str]) -> bool:
    """Whether a class or id is one of the words, or starts with one, perhaps behind words for its place."""
    if token in words:
        return True
    parts = [x for x in _WORD.split(token) if x]
    if not parts or not STATES.isdisjoint(parts):
        return False
    return parts[0] in words or next((x for x in parts if x not in PLACES), "") in words


def _furniture(tag: str, attrs: str) -> int:
    """0, ``WEAK``, ``BOX`` or ``HIDDEN``."""
    own = 0 if tag not in DROPPED else WEAK if tag in WEAK_TAGS else BOX
    if not attrs or tag in ("html", "body"):
        return own
    found = {k.lower(): unescape(v.strip("\"'")).lower() for k, v in _ATTR.findall(attrs)}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return HIDDEN
    if own or found.get("role") in ROLES:
        return own or BOX
    if tag == "main":
        return 0
    names = f"{found.get('class', '')} {found.get('id', '')}"
    tokens = names.split()
    if any(_named(x, COMMENTS if tag == "article" else BOXES) for x in tokens):
        return BOX
    if tag == "article" or not CONTENT.isdisjoint(_WORD.split(names)):
        return 0
    return WEAK if any(_named(x, FURNITURE) for x in tokens) else 0


def _prune(root: _Node, kind: int) -> None:
    """Cuts furniture of a kind out of a whole tree, in time linear in its nodes.

    An element that holds an article or main is a wrapper whatever its name, and stays, unless it is a box (teasers,
    comments) and a longer article or main lies outside of it. Of boxes without one all go while running text is left
    outside of every box; where none is, nor an article, the longest that is a box by name only is taken for a wrapper. Weak names stay on elements with most of the
    page's unlinked text, and go nowhere if most of the text would go with them; forms and headers if no running text would be
    left. What is in a wrapper is looked at by itself.
    """
    order = _in_order(root)
    at = {n: k for k, n in enumerate(order)}
    end, plain, inside = {}, {}, {}  # the place behind the nodes below, their unlinked text, the longest article among them
    for node in reversed(order):
        below = [x for x in node.items if isinstance(x, _Node)]
        end[node] = max((end[x] for x in below), default=at[node] + 1)
        plain[node] = sum(plain[x] for x in below) + sum(max(len(x[0]) - x[1], 0) for x in node.items if isinstance(x, tuple))
        inside[node] = max((max(inside[x], plain[x] if _is_article(x) else 0) for x in below), default=0)
    articles = [n for n in order if _is_article(n) and plain[n]]
    ends, starts = sorted((end[n], plain[n]) for n in articles), [(at[n], plain[n]) for n in articles]
    before, behind = list(accumulate((p for _, p in ends), max)), list(accumulate((p for _, p in reversed(starts)), max))[::-1]
    around: dict[_Node, int] = {root: 0}  # the longest article above
    for node in order:
        own = max(around[node], plain[node] if _is_article(node) else 0)
        for x in node.items:
            if isinstance(x, _Node):
                around[x] = own

    def outside(node: _Node) -> int:
        """The longest article that is not below a node; of those above, what is not in the node."""
        k = bisect.bisect_right(ends, (at[node], math.inf))
        j = bisect.bisect_left(starts, (end[node], 0))
        return max(before[k - 1] if k else 0, behind[j] if j < len(behind) else 0, around[node] - plain[node])

    def wrapper(node: _Node, last: _Node | None) -> bool:
        if inside[node]:
            return kind == WEAK or inside[node] >= outside(node)
        if kind == BOX:
            return node is last and not outside(node)
        return 2 * plain[node] > plain[root] and (node.tag not in WEAK_TAGS or plain[root] - plain[node] < RUNNING)

    gone, stack = set(), [(root, None)]
    while stack:
        node, last = stack.pop()
        if kind == BOX and (node is root or node.cut == kind):  # the boxes that are not in another one
            boxes, free, some = [], plain[node], [node]
            while some:
                for x in some.pop().items:
                    if isinstance(x, _Node):
                        (boxes if x.cut == kind and plain[x] else some).append(x)
            free -= sum(plain[x] for x in boxes)
            named = [x for x in boxes if x.tag not in DROPPED]
            last = max(named, key=plain.get) if named and free < RUNNING else None
        for x in node.items:
            if isinstance(x, _Node):
                if x.cut == kind and not (plain[x] and wrapper(x, last)):
                    gone.add(x)
                else:
                    stack.append((x, last))
    if kind == WEAK:
        named = {x for x in gone if x.tag not in WEAK_TAGS}
        if 2 * sum(plain[x] for x in named) > plain[root]:
            gone -= named
        if plain[root] - sum(plain[x] for x in gone) < min(RUNNING, plain[root]):
            return
    for node in {x.parent for x in gone}:
        node.items = [x for x in node.items if x not in gone]


def _is_article(node: _Node) -> bool:
    return node.tag in ("article", "main") and not node.cut


def parse(html: str, furniture: bool = False) -> _Node:
    """The tree of block elements; items that are tuples are blocks: text, characters in links.

    ``furniture`` keeps menus, footers and the like as well.
    """
    root, most, start = _parsed(html, furniture)
    if not furniture:
        if most > sum(max(len(x[0]) - x[1], 0) for n in _in_order(root) for x in n.items if isinstance(x, tuple)):
            root = _parsed(html, furniture, start)[0]
        _prune(root, BOX)
        _prune(root, WEAK)
    return root


def _in_order(root: _Node) -> list[_Node]:
    """All nodes, each before those below it."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in node.items if isinstance(x, _Node))
    return order


def _parsed(
    html: str, furniture: bool, wrapper: int = -1, links: list[str] | None = None
) -> tuple[_Node, int, int]:
    """The tree with marks of what is furniture; unlinked characters and start of the longest inline element that was left
    out by its name. The one that starts at ``wrapper`` is kept. ``links`` takes the attributes of all links."""
    root = node = _Node("#root", None, 0)
    texts: list[str] = []
    linked, in_link, breaks, hidden = 0, 0, 0, 0
    skip: list[str] = []  # open inline elements that are furniture
    why, began, passed, most, longest = 0, 0, 0, 0, 0  # the outermost of them, and the longest so far

    def flush():
        nonlocal linked, breaks
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                node.items.append((text, linked))
            texts.clear()
        linked = breaks = 0

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at and not hidden:
            piece = html[at : m.start()]
            if "&" in piece:
                piece = unescape(piece)
            texts.append(piece)
            if breaks and not piece.isspace():
                breaks = 0
            if in_link:
                linked += len(piece.strip())
        elif hidden and why != HIDDEN and not in_link:
            passed += len(html[at : m.start()].strip())
            if passed > most:
                most, longest = passed, began
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m["end"])
        if tag == "br":
            breaks += 1
            texts.append(" ")
            if breaks > 1:
                flush()
            continue
        if tag in INLINE:
            if closing:
                if skip and tag in (skip if skip[-1] in UNSEEN else skip[-1:]):
                    while skip.pop() != tag:
                        pass
                    hidden = len(skip)
                if tag == "a":
                    in_link = 0
            else:
                if tag == "a":
                    in_link = 1
                    if links is not None:
                        links.append(m["attrs"])
                if tag not in VOID and not m["attrs"].endswith("/"):
                    if not skip:
                        why = HIDDEN if tag in UNSEEN else _furniture(tag, m["attrs"]) if m["attrs"] and not furniture else 0
                        began, passed = m.start(), 0
                    if tag in UNSEEN or skip and tag == skip[-1] or (not skip and why and began != wrapper):
                        skip.append(tag)
                        hidden = len(skip)
            continue
        if skip and skip[-1] in UNSEEN and tag not in BREAKS:
            continue
        flush()
        skip.clear()
        in_link, hidden = 0, 0
        if closing:
            up = node
            while up.parent is not None and up.tag != tag:
                up = up.parent
            if up.parent is not None and tag not in ("html", "body"):
                node = up.parent
            continue
        if tag in VOID:
            continue
        ends = SAME_ENDS.get(tag)
        if ends:
            up = node
            while up.parent is not None and up.tag not in ends and up.tag not in SCOPES:
                up = up.parent
            if up.tag in ends:
                node = up.parent
        if node.tag in ("select", "option", "optgroup") and tag not in IN_SELECT:  # left open
            up = node
            while up.parent is not None and up.tag != "select" and up.tag not in SCOPES:
                up = up.parent
            if up.tag == "select":
                node = up.parent
        if tag in PARAGRAPH_ENDS:
            up = node
            while up.parent is not None and up.tag != "p" and up.tag not in SCOPES:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        child = _Node(tag, node, 0 if furniture else _furniture(tag, m["attrs"]))
        if child.cut != HIDDEN:
            node.items.append(child)
        node = child
    if at < len(html) and not hidden:
        texts.append(unescape(html[at:]))
    flush()
    return root, most, longest


PROSE = frozenset("article section p pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl table figure hgroup details".split())
_CONTAINED = frozenset("p pre h1 h2 h3 h4 h5 h6 li dd dt td th tr figcaption summary address tbody thead tfoot caption".split())


def _score(root: _Node) -> list[_Node]:
    """All nodes with their points, lengths and characters in links filled in."""
    order = _in_order(root)
    for node in reversed(order):
        for item in node.items:
            if isinstance(item, _Node):
                node.length += item.length
                node.linked += item.linked
                continue
            text, linked = item
            node.length += len(text)
            node.linked += min(linked, len(text))
            points = min(len(text) / 25, 1) * (1 + text.count(",") + min(len(text) / 100, 3))
            points *= 1 - min(linked / len(text), 1)
            up = node
            while up.tag in _CONTAINED and up.parent is not None:
                up = up.parent
            share = 1.0
            for level in range(6):
                up.points += points * share
                if up.parent is None:
                    break
                up = up.parent
                share = 0.5 if level == 0 else 1 / (3 * (level + 1))
    return order


def _density(node: _Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _links(node: _Node) -> bool:
    """Whether a node is a list of links."""
    return node.tag in ("ul", "ol", "div", "section", "table") and node.length > 0 and _density(node) > 0.8


def _blocks(node: _Node) -> list[str]:
    """Texts below a node in page order; lists of links go, but for those that an article has of its own."""
    found, stack = [], [(node, _within(node, "article"))]
    while stack:
        item, own = stack.pop()
        if isinstance(item, tuple):
            found.append(item[0])
        elif item is node or own or not _links(item):
            own = own or item.tag == "article"
            stack.extend((x, own) for x in reversed(item.items))
    return found


def _within(node: _Node | None, tag: str) -> bool:
    while node is not None and node.tag != tag:
        node = node.parent
    return node is not None


def _plain(node: _Node) -> int:
    return node.length - node.linked


def _container(best: _Node, root: _Node) -> _Node:
    """From the best scored node up to all of the article around it.

    That is the article or main it stands in (an outer one, if the inner has less than half of its unlinked text), or the
    lowest node that holds four fifths of the page's unlinked text.
    """
    home, up = None, best
    while up is not None:
        if up.tag in ("article", "main") and (home is None or 2 * _plain(home) < _plain(up)):
            home = up
        up = up.parent
    if home is not None:
        return home
    while best.parent is not None and 5 * _plain(best) < 4 * _plain(root):
        best = best.parent
    return best


def main_blocks(html: str | None) -> list[str]:
    """The text blocks of the page's main text."""
    if not html:
        return []
    nodes = _score(parse(html))
    able = [n for n in nodes if n.points > 0 and n.tag not in _CONTAINED]
    if not able:
        return []
    best = _container(max(able, key=lambda n: n.points * (1 - _density(n))), nodes[0])
    if best.parent is None or best.tag in ("article", "main", "body"):
        return _blocks(best)
    items = best.parent.items
    akin = [item is best or _akin(item, best) for item in items]
    first, last = akin.index(True), len(akin) - 1 - akin[::-1].index(True)
    found = []
    for k in range(first, last + 1):
        item = items[k]
        if isinstance(item, tuple):
            found.append(item[0])
        elif akin[k] or not _links(item):
            found += _blocks(item)
    return found


def _akin(item: _Node | tuple, best: _Node) -> bool:
    """Whether a sibling of the best container is text as well: by its links, of which its like and prose may have more."""
    if isinstance(item, tuple):
        return item[1] < 0.25 * len(item[0])
    like = item.tag == best.tag or item.tag in PROSE
    return item.length > 0 and _density(item) < (0.5 if like else 0.25)


def attributes(attrs: str) -> dict[str, str]:
    """Attributes of a start tag by their names in small letters; of equal names the first counts."""
    return {k.lower(): unescape(v.strip("\"'")) for k, v in reversed(_ATTR.findall(attrs))}


def all_blocks(html: str | None, links: list[str] | None = None) -> list[str]:
    """All visible text blocks of a page, whatever they are; ``links`` takes the addresses that the page links to."""
    if not html:
        return []
    tags = None if links is None else []
    found, stack = [], [_parsed(html, True, links=tags)[0]]
    if links is not None:
        links += [held["href"] for held in map(attributes, tags) if held.get("href")]
    while stack:
        item = stack.pop()
        if isinstance(item, tuple):
            found.append(item[0])
        else:
            stack.extend(reversed(item.items))
    return found


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, ``text`` (blocks joined by an empty line) and ``n_chars`` of each page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = ["\n\n".join(main_blocks(h.as_py())) for h in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(keep))), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=[*keep, "text", "n_chars"],
                )

    schema = "".join(f"`{k}` {kinds[k]}, " for k in keep) + "text string, n_chars bigint"
    return pages.select(*keep, html_col).mapInArrow(run, schema)
