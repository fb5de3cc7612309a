"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.words import spread

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
#: What ends a tag, or begins a quoted value in it.
_EDGE = re.compile(r">|=\s*([\"'])")
#: A name and its value. It begins with the name, so that a run of white space before the next one is passed over once.
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*))?|=""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select option object audio video canvas".split())
BOILERPLATE = frozenset("head nav footer aside button dialog menu".split())
BLOCKS = frozenset(
    "html body main article section header div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address hr details summary fieldset center".split()
)
BLOCKS |= BOILERPLATE | {"form"}
PARAGRAPHS = frozenset("p td th pre blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the key is closed by a start tag of these.
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, **{h: HEADINGS for h in HEADINGS}}

ROWS = frozenset("tr tbody thead tfoot".split())
#: Items of lists and tables, and which open ones a new one ends; and elements that such an end does not reach beyond.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = frozenset("ul ol dl table article section nav div body".split())

#: Words in classes and ids of reader comments; of what is hardly ever main text; and of what has other senses, too.
COMMENTS = frozenset("comment comments commentlist commentform commentarea disqus respond replies".split())
TALK = frozenset("discussion discussions thread threads reactions".split())
ALIEN = frozenset(
    "ad ads advert adverts advertisement advertisements advertising advertorial adsense breadcrumb breadcrumbs cookie cookies consent gdpr newsletter subscribe sidebar sponsor sponsored sponsors pagination pager outbrain taboola".split()
)
WEAK = frozenset("banner notice footer masthead menu nav navbar navigation navmenu navlist popup modal promo promos promotion promotions promotional share sharing toolbar signup login".split())
_FIRM = frozenset("comment comments sidebar ad ads footer nav".split())
#: Parts of a page that hold others; a paragraph with such a word alone is the article's own.
_HOLDERS = frozenset("div ul ol section table dl".split())
#: Words of what is main text only within its container, and there unless it is mostly links.
_DOUBTFUL = re.compile(r"\b(?:alert|foot|header|overlay|related|recommend\w*|side|social|widget|skip|reply|tags?|legal|copyright|disclaimer)\b", re.IGNORECASE)
_LIKELY = re.compile(r"\b(?:article|body|content|entry|main|post|story|text|page|hentry|blog)\b", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())

#: Siblings of the best container with this share of its score are kept, too.
SIBLING = 0.2
#: A form with this share of the page's text, and an article or a paragraph of so many characters in it, is around the page and no part of it.
FORM_SHARE, FORM_PROSE = 0.5, 80


@dataclass(eq=False)
class Node:
    tag: str
    parent: "Node | None" = None
    weight: float = 0.0
    skip: bool = False
    doubt: bool = False
    #: Named as a discussion: reader comments if it is a row of like parts.
    talk: bool = False
    #: In an article or main element, or one itself.
    inside: bool = False
    #: Open items of the list or table that the node is in, by tag.
    items: dict = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and texts
    score: float = 0.0
    #: Characters below the node, and those of them in links.
    chars: int = 0
    linked: int = 0
    #: Of the text that is in no block below the node: characters, those in links, and commas.
    own: int = 0
    own_linked: int = 0
    commas: int = 0


def _marks(attributes: str) -> tuple[list[str], str, str, bool]:
    """The words of class and id, style, role, hidden."""
    names, style, role, hidden = [], "", "", False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = (m[1] or "").lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id"):
            names.append(value)
        elif name == "style":
            style = value
        elif name == "role":
            role = value.lower()
        elif name in ("hidden", "aria-hidden"):
            hidden |= value.lower() != "false"
    return " ".join(names).lower().split(), style, role, hidden


def _judge(node: Node, words: list[str], likely: bool) -> None:
    """Whether a part of a page is none of the article, by the words of its class and id.

    Outside articles any part of a word counts (`main-nav`). Within one, comments and what is hardly ever main text do; words that have other
    senses only if they are the whole word and the part is no paragraph (`modal`, not `modal-verbs`). What they leave in doubt goes if it is mostly links.
    """
    tag, split = node.tag, [w.replace("_", "-").strip("-").split("-") for w in words]
    parts, firm = {p for w in split for p in w}, not (likely and node.tag in ("div", "section"))
    if not node.parent.inside:
        node.talk = bool(parts & TALK)
        node.skip |= node.talk and firm or bool(parts & (COMMENTS | ALIEN | WEAK)) and (firm or bool(parts & _FIRM))
        node.doubt |= firm and bool(_DOUBTFUL.search(" ".join(parts)))
        return
    whole, ends = {w[0] for w in split if len(w) == 1}, {p for w in split for p in (w[0], w[-1])}
    node.talk = bool(parts & TALK)
    node.skip |= bool(parts & COMMENTS) or firm and bool(whole & ALIEN or whole & WEAK and tag not in PARAGRAPHS and tag != "section") or tag in _HOLDERS and bool(ends & ALIEN)
    node.doubt |= node.talk or bool(parts & (ALIEN | WEAK)) or firm and bool(_DOUBTFUL.search(" ".join(parts)))


def _element(tag: str, attributes: str, parent: Node) -> Node:
    node = Node(tag, parent, skip=parent.skip or tag in BOILERPLATE, doubt=parent.doubt, inside=parent.inside or tag in ("article", "main"))
    if tag in SCOPES:
        node.items = {}
    elif tag in ENDS:
        node.items = {**parent.items, tag: node}
    else:
        node.items = parent.items
    if tag in ("article", "main"):
        node.weight = 25
    elif tag in ("section", "div"):
        node.weight = 5
    elif tag in ("ul", "ol", "dl", "table", "header", *HEADINGS):
        node.weight = -3
    if attributes and not attributes.isspace():
        names, style, role, hidden = _marks(attributes)
        if hidden or style and _HIDDEN.search(style) or role in _ROLES:
            node.skip = True
        if role in ("main", "article"):
            node.weight += 25
        if names:
            likely = bool(_LIKELY.search(re.sub("[-_]+", " ", " ".join(names))))
            if tag not in ("body", "html", "article", "main"):
                _judge(node, names, likely)
            elif parent.inside and any(p in COMMENTS for w in names for p in re.split("[-_]+", w)):
                node.skip = True
            node.weight += 25 if likely else 0
    if tag == "header" and not node.inside:
        node.skip = True
    return node


def _up(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


class Tokens:
    """Tags of a page with the texts between them, in time linear in the page.

    A quoted value may hold what ends a tag elsewhere. Once a quote has no partner, quotes are plain characters.
    """

    def __init__(self, page: str):
        self.page, self.quotes, self.endless = page, True, set()

    def _end(self, at: int) -> int:
        """Where the tag ends whose name ends at a place; -1 if nothing ends it."""
        place = at
        while self.quotes:
            m = _EDGE.search(self.page, place)
            if m and not m[1]:
                return m.start()
            place = self.page.find(m[1], m.end()) + 1 if m else 0
            self.quotes = place > 0
        return self.page.find(">", at)

    def __iter__(self):
        """(text before, name or "", attributes); a name of an end tag begins with a slash."""
        page, at, text = self.page, 0, 0
        while True:
            at = page.find("<", at)
            if at < 0:
                break
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                yield page[text:at], "", ""
                at = text = end + 3 if end >= 0 else len(page)
                continue
            m = _NAME.match(page, at + 1)
            if not m and page[at + 1 : at + 2] not in ("!", "?"):
                at += 1
                continue
            end = self._end(m.end()) if m else page.find(">", at)
            if end < 0:
                break
            name = m[0].lower() if m else ""
            yield page[text:at], name, page[m.end() : end] if m else ""
            at = text = end + 1
            if name in RAW and not (name in ("svg", "math") and page[end - 1] == "/"):
                close = None if name in self.endless else re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
                if close:
                    at = text = close.end()
                else:
                    self.endless.add(name)
                    if name in ("script", "style", "textarea", "title"):
                        at = text = len(page)
        yield page[text:], "", ""


def parse(page: str) -> Node:
    """The tree of block elements, links and what is hidden in lines. Other elements leave only their text; end tags may be missing."""
    root = here = Node("root")
    opened: Counter[str] = Counter()  # open blocks by tag
    lines: list[Counter[str]] = [Counter()]  # for each open block: what is open in its lines

    def leave(until: Node | None) -> None:
        """Closes what is open up to a node, which stays."""
        nonlocal here
        while here is not until and here is not root:
            if here.tag in BLOCKS:
                opened[here.tag] -= 1
                lines.pop()
            else:
                lines[-1][here.tag] -= 1
            here = here.parent

    def enter(node: Node) -> None:
        nonlocal here
        here.children.append(node)
        here = node
        if node.tag in BLOCKS:
            opened[node.tag] += 1
            lines.append(Counter())
        else:
            lines[-1][node.tag] += 1

    for text, tag, attributes in Tokens(page):
        if text:
            here.children.append(text)
        if not tag or tag in RAW:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if (opened if tag in BLOCKS else lines[-1])[tag] > 0:
                node = here
                while node.tag != tag:
                    node = node.parent
                leave(node.parent)
        elif tag == "br":
            here.children.append(" ")
        elif tag in VOID and tag != "hr":
            continue
        elif tag in BLOCKS:
            while here is not root and (here.tag not in BLOCKS or tag in CLOSED_BY.get(here.tag, ())):
                leave(here.parent)
            for item in ENDS.get(tag, ()):
                if item in here.items:
                    leave(here.items[item].parent)
            enter(_element(tag, attributes, here))
            if tag == "hr":
                leave(here.parent)
        elif tag == "a":
            enter(_element(tag, attributes, here))
        elif here.tag == tag or attributes and not attributes.isspace():  # inline: only what is left out needs a node
            node = _element(tag, attributes, here)
            if node.skip:
                enter(node)
    return root


def _around(root: Node) -> None:
    """Forms are left out, but for those that are around the page."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [c for c in n.children if isinstance(c, Node) and not c.skip]
    forms = [n for n in order if n.tag == "form"]
    if not forms:
        return
    size, prose = {}, {}
    for n in reversed(order):
        below = [c for c in n.children if isinstance(c, Node) and not c.skip]
        own = sum(len(c.strip()) for c in n.children if isinstance(c, str)) + sum(size[id(c)] for c in below if c.tag not in BLOCKS)
        size[id(n)] = own + sum(size[id(c)] for c in below if c.tag in BLOCKS)
        prose[id(n)] = n.tag in ("article", "main") or n.tag in PARAGRAPHS and own >= FORM_PROSE or any(prose[id(c)] for c in below)
    for n in forms:
        n.skip = not prose[id(n)] or size[id(n)] < FORM_SHARE * size[id(root)]


def measure(root: Node) -> None:
    """Characters, links and commas of each node, from the leaves up and each text once; doubtful parts of mostly links go, and discussions of like parts."""
    _around(root)
    order, stack = [], [(root, False)]
    while stack:
        n, linked = stack.pop()
        linked = linked or n.tag == "a"
        order.append((n, linked))
        stack += [(c, linked) for c in n.children if isinstance(c, Node) and not c.skip]
    for n, linked in reversed(order):
        texts = [c for c in n.children if isinstance(c, str)]
        own = sum(len(c.strip()) for c in texts)
        n.own += own
        n.own_linked += own if linked else 0
        n.commas += sum(c.count(",") for c in texts)
        n.chars += own
        n.linked += own if linked else 0
        up = n.parent
        likes = Counter(c.tag for c in n.children if isinstance(c, Node) and c.tag in ("li", "div", "article", "section", "dl") and not c.skip) if n.talk else {}
        if n.doubt and not (up and up.doubt) and 2 * n.linked >= n.chars or max(likes.values(), default=0) > 1:
            n.skip = True
        elif up is not None:
            up.chars += n.chars
            up.linked += n.linked
            if n.tag not in BLOCKS:
                up.own += n.own
                up.own_linked += n.own_linked
                up.commas += n.commas


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _nodes(root: Node):
    stack = [root]
    while stack:
        n = stack.pop()
        if not n.skip:
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]


def choose(root: Node) -> list[Node]:
    """The best container and those of its siblings that count, in page order.

    A block with text of its own gives 1 point, 1 for each comma and up to 3 for the text's length, less the share of it
    that is in links: to its parent if it is a paragraph, else to itself; half as many to the next ancestor, and a third to
    the one after. A container's points, with those for what it is, are discounted by the share of its text that is in
    links. Doubtful parts give no points and are no siblings, but stay where they are within a container. Of an article's siblings
    other articles count, by their points without those for what they are.
    """
    measure(root)
    scored: dict[int, Node] = {}
    for n in _nodes(root):
        if not n.own or n.doubt or n.tag not in BLOCKS and n is not root:
            continue
        points = (1 + n.commas + min(n.own / 100, 3)) * (1 - n.own_linked / n.own)
        for level, up in enumerate(_up(n.parent if n.tag in PARAGRAPHS else n)):
            if level == 3 or up.tag in ("html", "root") and level:
                break
            if id(up) not in scored:
                scored[id(up)] = up
                up.score = max(up.weight, -0.5)
            up.score += points / (level + 1)
    if not scored:
        return []
    final = {i: n.score * (1 - _density(n)) for i, n in scored.items()}
    best = max(scored.values(), key=lambda n: final[id(n)])  # the first in the page's order of points, if several are
    most = final[id(best)]
    while best.tag in ROWS and best.parent:  # a table is kept whole
        best = best.parent
    for up in _up(best):  # an article or main element around the best container is the container
        if up.tag in ("article", "main") and id(up) in scored:
            best = up
            break
    if best.tag == "article" and best.parent is not None:
        points = {id(n): (n.score - n.weight) * (1 - _density(n)) for n in best.parent.children if isinstance(n, Node) and n.tag == "article" and id(n) in scored}
        return [n for n in best.parent.children if n is best or not isinstance(n, str) and not n.skip and points.get(id(n), 0) >= max(3.0, SIBLING * points[id(best)])]
    if best.parent is None or best.tag in ("body", "main"):
        return [best]
    least, kept, before = max(3.0, SIBLING * most), [], True
    for n in best.parent.children:
        if not isinstance(n, Node) or n.skip or n.doubt and n is not best:
            continue
        before = before and n is not best
        near = n is best or final.get(id(n), 0) >= least or n.tag in HEADINGS and n.chars and before
        if near or n.tag == "p" and n.chars and _density(n) < 0.25:
            kept.append(n)
    return kept


def blocks(node: Node) -> list[str]:
    """Texts of a container's blocks in page order, each with single spaces, none of them empty."""
    out, parts, stack = [], [], [node]

    def close() -> None:
        if parts:
            line = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if line:
                out.append(line)

    while stack:
        n = stack.pop()
        if n is None:
            close()
        elif isinstance(n, str):
            parts.append(n)
        elif not n.skip:
            edge = n.tag in BLOCKS
            if edge:
                close()
                stack.append(None)
            stack += reversed(n.children)
    close()
    return out


def main_text(page: str | None) -> str:
    """The main text of a page; empty for a null or empty page and for one without text that counts."""
    if not page:
        return ""
    return "\n".join(line for n in choose(parse(page)) for line in blocks(n))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars long) for every row of pages, in one pass without a shuffle.

    A null or empty page has an empty text. Ids and addresses come back as they are, null and repeated ones too; other
    columns are not read. Broken markup is read as far as it goes, in time linear in the page: nothing is dropped for its
    length. Of containers with equal points the first to get points is the best.
    """
    kinds = [(name, pages.schema[column].dataType) for name, column in (("page_id", id_col), ("url", url_col))]
    schema = T.StructType([*(T.StructField(n, k) for n, k in kinds), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], dtype=np.int64))], names=["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return spread(own).mapInArrow(run, schema)
