"""Main text of web pages by tree scoring.

A tolerant parser builds the element tree. Paragraphs (and other elements with text of their own)
earn points for length and commas and pass them to their ancestors, halved at the grandparent and
thinned further up; a container's points are discounted by its link density. The best container
(widened to the article or main element that holds it) and, beside it and beside each element
that holds it, what scores near it or reads like text are kept. Boilerplate is left out at any depth: menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts, styles. Where only a class or id tells it, the element's text has a say too.

Text: character references decoded, white space inside a block as one space, trimmed, blocks joined in
page order by one space. Defined cases: null or empty html: empty text; broken markup: elements close
where the next one or the end implies it; repeated rows: each is a row; extra columns are ignored.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from factloom.llm.common import map_rows, pick

#: A comment, CDATA, another declaration, a tag (slash, name, attributes) or text. A quote counts only after an equals sign.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)|([^<]++|<)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp plaintext".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
DROPPED = frozenset("head script style noscript template svg math nav menu header footer aside form button input select option textarea label fieldset iframe object embed canvas audio video dialog title".split())
#: Dropped containers that may be a wrapper of the page: a form around all, or one that was never closed.
WRAPPERS = frozenset("form fieldset nav menu header footer aside".split())
CLOSES_P = BLOCK - {"br", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
P_SCOPE = ("table", "button", "object", "td", "th", "caption")
CELLS = ("td", "th", "caption")
TABLE = frozenset("table tbody thead tfoot tr td th caption".split())
#: What a start tag ends: by name, the elements that go, in order, up to the nearest of the second group.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("td", "th", "tr"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
#: Inline elements that a slash at the tag's end doesn't close.
INLINE = frozenset("a b i em strong span".split())
ROLES = frozenset("navigation banner complementary contentinfo search menu menubar dialog alert alertdialog form".split())
#: Words of class or id names that mark boilerplate, matched as whole name parts.
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer header masthead banner cookie cookies consent gdpr notice notices popup modal overlay comment comments commentlist disqus reply replies respond discussion share sharing social related recommended newsletter subscribe subscription signup login search toolbar pagination pager widget widgets skip copyright legal disclaimer".split())
#: Marks that say what an element is wherever it stands; the others may also name a layout or an article's subject.
SURE = frozenset("ad ads advert adverts advertisement advertising sponsored promo breadcrumb breadcrumbs cookie cookies consent gdpr popup modal overlay comment comments commentlist disqus reply replies respond share sharing recommended newsletter subscribe subscription signup login toolbar pagination pager skip".split())
#: Name parts that add nothing to a mark, and first parts that tell of a wrapper's state, not of its text.
SHAPE = frozenset("site page box block section wrapper wrap container area list links link bar left right top bottom inner outer item items form button buttons icon icons title posts articles".split())
STATE = frozenset("has with no without is not show".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PART = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")
GOOD = frozenset("article main content post entry story body text".split())


class Node:
    __slots__ = ("bad", "block", "closed", "depth", "good", "kids", "length", "links", "mark", "name", "names", "parent", "prose", "score", "words")

    def __init__(self, name: str, parent: Node | None, attributes: str = ""):
        self.name, self.parent, self.kids = name, parent, []
        self.score, self.length, self.links, self.prose = 0.0, 0, 0, 0
        self.depth = parent.depth + 1 if parent else 0
        #: block: depth of the nearest block that holds its content; closed: whether an end tag closed it.
        self.block, self.closed = self.depth if parent is None or name in BLOCK else parent.block, False
        self.words: set[str] = set()
        self.bad = name in DROPPED
        #: mark: how its names mark it ("", "loose": in a longer name, "plain", "sure"); good: a name of GOOD words only.
        self.mark, self.good, self.names = "", False, []
        if attributes and not attributes.isspace():
            for key, *values in ATTRIBUTE.findall(attributes):
                value = next(filter(None, values), "")
                key = key.lower()
                if key in ("class", "id"):
                    for one in value.split():
                        parts = [w for w in PART.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", one).lower()) if w]
                        self.words.update(parts)
                        self.names.append((key, parts))
                elif key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    self.bad = True
        if self.names and name not in ("html", "body"):
            self.judge_names()

    def judge_names(self) -> None:
        for _, parts in self.names:
            marks = MARKS.intersection(parts)
            if not marks:
                self.good = self.good or bool(parts) and GOOD.issuperset(parts)
            elif parts[0] not in STATE and self.name not in ("article", "main"):
                plain = (MARKS | SHAPE | GOOD).issuperset(parts)
                kind = "loose" if not plain else "sure" if marks & SURE else "plain"
                self.mark = max(self.mark, kind, key=("", "loose", "plain", "sure").index)


class Open:
    """The open elements: the innermost, and a stack for each name, so that no step walks the tree."""

    def __init__(self, root: Node):
        self.node = root
        self.by_name: dict[str, list[Node]] = {}

    def push(self, child: Node) -> None:
        self.node = child
        self.by_name.setdefault(child.name, []).append(child)

    def nearest(self, names) -> Node | None:
        found = [self.by_name[n][-1] for n in names if self.by_name.get(n)]
        return max(found, key=lambda x: x.depth, default=None)

    def pop(self, upto: Node) -> None:
        """End upto and all that is open in it."""
        while self.node.depth >= upto.depth:
            self.by_name[self.node.name].pop()
            self.node = self.node.parent

    def close(self, names, scope=()) -> None:
        """End the nearest open element of names unless one of scope holds it off."""
        x, stop = self.nearest(names), self.nearest(scope)
        if x is not None and (stop is None or x.depth > stop.depth):
            self.pop(x)

    def end(self, name: str) -> bool:
        """An end tag: it closes no block as an inline one, and nothing outside a table's cell but the table's own."""
        x = self.nearest((name,))
        if x is None or name not in BLOCK and x.depth <= self.node.block:
            return False
        cell = self.nearest(CELLS) if name not in TABLE else None
        if cell is not None and x.depth < cell.depth:
            return True
        x.closed = True
        self.pop(x)
        return True


def parse(page: str) -> Node:
    """The element tree; text nodes are strings. Time is linear in the page's length."""
    root = Node("#root", None)
    at, size, open_ = 0, len(page), Open(root)
    while at < size:
        m = TOKEN.match(page, at)
        at = m.end()
        if m[4] is not None:
            open_.node.kids.append(m[4])
        elif m[2] is not None:
            name = m[2].lower()
            if m[1]:
                if not open_.end(name) and name in ("p", "br"):
                    open_.node.kids.append(Node("br", open_.node))
                continue
            if name in CLOSES_P:
                open_.close(("p",), P_SCOPE)
            if name in IMPLIED:
                names, scope = IMPLIED[name]
                for one in names:
                    open_.close((one,), scope)
            if name in ("article", "main"):
                # no menu or form that is still open holds the article: its end tag is missing, or it wraps the page
                while (x := open_.nearest(WRAPPERS)) is not None and x.bad and ((up := open_.nearest(("article", "main"))) is None or up.depth < x.depth):
                    open_.pop(x)
            child = Node(name, open_.node, m[3])
            open_.node.kids.append(child)
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
                child.kids.append(page[at : end.start() if end else size])
                at = end.end() if end else size
            elif name not in VOID and (not m[3].rstrip().endswith("/") or name in BLOCK or name in INLINE):
                open_.push(child)
        elif m[0].startswith("<![CDATA["):
            open_.node.kids.append(m[0][9:].removesuffix("]]>"))
    return root


def own_text(node: Node) -> str:
    """Text of the node outside nested blocks."""
    out, todo = [], list(reversed(node.kids))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.bad and x.name not in BLOCK:
            todo += reversed(x.kids)
    return " ".join(html.unescape("".join(out)).split())


def walk(root: Node, through: frozenset[str] = frozenset()):
    """Elements outside boilerplate, parents first; dropped elements of the names in through count as well."""
    todo = [root]
    while todo:
        x = todo.pop()
        if not x.bad or x.name in through:
            yield x
            todo += [k for k in x.kids if not isinstance(k, str)]


def weigh_prose(every: list[Node]) -> None:
    """Set each element's prose: characters of its blocks that read like text, 25 or more, few of them in links."""
    own: dict[int, list[int]] = {}
    unit: dict[int, Node] = {}
    linked: set[int] = set()
    for x in every:
        up = x.parent
        unit[id(x)] = x if up is None or x.name in BLOCK else unit[id(up)]
        if x.name == "a" or x.name not in BLOCK and up is not None and id(up) in linked:
            linked.add(id(x))
        n = sum(len(" ".join(k.split())) for k in x.kids if isinstance(k, str))
        if n:
            count = own.setdefault(id(unit[id(x)]), [0, 0])
            count[0] += n
            count[1] += n * (id(x) in linked)
            x.length, x.links = x.length + n, x.links + n * (id(x) in linked)
    reads_ = lambda length, links: length if length >= 25 and links < 0.25 * length else 0
    for x in reversed(every):
        if unit[id(x)] is x:
            x.prose += reads_(*own.get(id(x), (0, 0)))
        if x.parent is not None:
            x.parent.prose += x.prose
            if x.name not in BLOCK:
                x.parent.length, x.parent.links = x.parent.length + x.length, x.parent.links + x.links
    for x in every:
        if unit[id(x)] is not x:
            x.prose = max(x.prose, reads_(x.length, x.links))
        x.length = x.links = 0


def free_wrappers(root: Node) -> None:
    """A dropped container that holds nearly all of the page's text, and that is a form or was never closed, is a wrapper."""
    found = [x for x in walk(root, through=WRAPPERS) if x.name in WRAPPERS and x.bad]
    if not found or any(x.name in ("article", "main") for x in walk(root)):
        return
    hidden = [x for x in found if x.name in ("form", "fieldset") or not x.closed]
    for x in hidden:
        x.bad = False
    every = list(walk(root))
    weigh_prose(every)
    total = root.prose
    for x in hidden:
        x.bad = 2 * x.prose <= total or x.prose <= 20 * (total - x.prose)


def drop_marked(root: Node) -> None:
    """Marked elements that are boilerplate become bad; a mark alone drops no text of the article.

    A mark in an element's name stands against what the element holds. Kept are: wrappers of the article;
    elements with another name of GOOD words; sections named after their subject (a mark in a longer name, or
    the words of their own heading); and what holds most of the page's text.
    """
    every = list(walk(root))
    if not any(x.mark for x in every):
        return
    outer: list[Node] = []
    inside: dict[int, bool] = {}
    under: set[int] = set()
    for x in every:
        up = x.parent
        inside[id(x)] = up is not None and (inside[id(up)] or up.name in ("article", "main") or up.good and not up.mark)
        if up is not None and (up.mark or id(up) in under):
            under.add(id(x))
        elif x.mark:
            outer.append(x)
    holds: set[int] = set()
    articles = [x for x in every if x.name in ("article", "main") and not any(SURE.intersection(parts) for _, parts in x.names)]
    free = any(id(x) not in under for x in articles)
    for x in articles:
        up = x.parent
        while up is not None and (x.name == "main" or not free) and id(up) not in holds:
            holds.add(id(up))
            up = up.parent
    for x in every:
        x.prose = 0
    weigh_prose(every)
    total = root.prose
    rest = total - sum(x.prose for x in outer)
    todo = [root]
    while todo:
        x = todo.pop()
        if x.mark and not x.bad and not (id(x) in holds or stays(x, inside[id(x)], total, rest)):
            x.bad = True
        if not x.bad:
            todo += [k for k in x.kids if not isinstance(k, str)]


def stays(x: Node, inside: bool, total: int, rest: int) -> bool:
    """Whether a marked element belongs to the text: inside, it lies in the article; rest is the page's unmarked prose."""
    if x.name in HEADINGS:
        said = set(PART.split(text_of([x]).lower()))
        return all(key == "id" and said.issuperset(parts) for key, parts in x.names if MARKS.intersection(parts))
    mine = x.prose
    if x.mark == "sure":
        return mine > 20 * rest and 2 * mine > total
    if x.name not in BLOCK:
        return x.mark == "loose" and x.name != "a" and not any(not isinstance(k, str) and k.name == "a" for k in x.kids)
    if 2 * mine >= total > 0 or x.good and mine:
        return True
    return mine >= (25 if x.mark == "loose" else 80) and (inside or x.mark == "loose" and x.name == "section")


def measure(root: Node) -> list[Node]:
    """Set each element's score, text length and link length; elements, parents first."""
    every = list(walk(root))
    for x in every:
        if x.name in BLOCK or x.parent is None:
            text = own_text(x)
            if text:
                # a paragraph's points: one, its commas, and one for each 100 characters, at most three
                points = 1 + len(re.findall("[,،、，]", text)) + min(len(text) // 100, 3) if len(text) >= 25 else len(text) / 50
                holder = x if x.name not in ("p", "pre", "blockquote", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dd", "dt", "td", "th") else x.parent
                level = 1.0
                depth = 0
                while holder is not None and depth < 6:
                    holder.score += points * level
                    depth += 1
                    level = 0.5 if depth == 1 else 1 / (3 * depth)
                    holder = holder.parent
    for x in reversed(every):
        mine = sum(len(k) for k in x.kids if isinstance(k, str) and not k.isspace())
        x.length += mine
        if x.name == "a":
            x.links = x.length
        if x.parent is not None:
            x.parent.length += x.length
            x.parent.links += x.links
        if x.words & GOOD or x.name in ("article", "main"):
            x.score += 5
        x.score *= 1 - min(1.0, x.links / x.length) if x.length else 0
    return every


def text_of(nodes: list[Node | str]) -> str:
    """Blocks of the nodes in page order, joined by one space."""
    out, run = [], []
    todo: list = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if x is None:
            out.append("".join(run))
            run = []
        elif isinstance(x, str):
            run.append(html.unescape(x) if "&" in x else x)
        elif not x.bad:
            if x.name in BLOCK:
                todo += [None, *reversed(x.kids), None]
            else:
                todo += reversed(x.kids)
    out.append("".join(run))
    return " ".join(" ".join(out).split())


#: Blocks whose own kind says that they are text, however short.
TEXTUAL = HEADINGS | frozenset("p pre blockquote ul ol dl table figure".split())


def beside(kids: list[Node | str], best: Node) -> list[Node | str]:
    """What belongs to the text among the nodes beside the best container or one that holds it."""
    kept, run = [], []
    for k in [*kids, None]:
        if k is not None and (isinstance(k, str) or k.name not in BLOCK):
            run.append(k)
            continue
        length = sum(len(r) if isinstance(r, str) and not r.isspace() else r.length for r in run if not isinstance(r, str) or not r.isspace())
        links = sum(r.links for r in run if not isinstance(r, str))
        if length > 80 and links < 0.25 * length:
            kept += run
        run = []
        if k is not None and not k.bad and k.length and (k.score >= max(10, 0.2 * best.score) or reads(k)):
            kept.append(k)
    return kept


def reads(x: Node) -> bool:
    """Whether a block reads like text: few links, and long, or a textual element or one that holds such."""
    if x.links >= 0.25 * x.length:
        return False
    if x.length > 80 or x.name in HEADINGS:
        return True
    return not x.links and any(k.name in TEXTUAL and k.length for k in walk(x))


def drop_menus(container: Node) -> None:
    """In the article, lists of nothing but short links are menus; so are, in a main element, its link-only blocks."""
    least = 2 if container.name == "main" else 3
    every = list(walk(container))
    count = dict.fromkeys(map(id, every), 0)
    for x in reversed(every):
        count[id(x)] += x.name == "a" and x.length > 0
        if x is not container:
            count[id(x.parent)] += count[id(x)]
    for x in every:
        n = count[id(x)]
        if x is not container and x.name in ("ul", "ol", "menu", "dir", "div", "p") and x.links >= 0.95 * x.length and n >= least and x.length <= 30 * n:
            x.bad = True


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    free_wrappers(root)
    drop_marked(root)
    every = measure(root)
    inside = [x for x in every if x.name not in ("#root", "html", "a", "p", "h1", "h2", "h3")]
    best = max(inside, key=lambda x: x.score, default=None)
    if best is None or best.score <= 0:
        body = next((x for x in every if x.name == "body"), root)
        return text_of([body])
    x = best
    while x is not None and x.name not in ("article", "main"):
        x = x.parent
    if x is not None:
        drop_menus(x)
        return text_of([x])
    if best.name in ("body", "#root", "html") or best.parent is None:
        return text_of([best])
    before, after, x = [], [], best
    while x.parent is not None and x.name not in ("body", "html"):
        at = x.parent.kids.index(x)
        before.append(beside(x.parent.kids[:at], best))
        after += beside(x.parent.kids[at + 1 :], best)
        x = x.parent
    return text_of([*(k for some in reversed(before) for k in some), best, *after])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per input row: page_id, url, text, n_chars (code points)."""
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    schema = T.StructType([T.StructField("page_id", rows.schema["page_id"].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(slices):
        for rows_ in slices:
            yield [(r["page_id"], r["url"], t := main_text(r["html"]), len(t)) for r in rows_]

    return map_rows(rows, run, schema)
