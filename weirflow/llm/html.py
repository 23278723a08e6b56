"""Main-text extraction by tree scoring (operator 3).

The page is parsed into a tree, without scripts, styles and other raw content.  Elements that are
boilerplate by their name or role are cut, and those that are by class or id unless they hold the page's text:
a class may also tell of the page around it ("nav-open", "layout-sidebar").  Every paragraph earns points for its
length and its commas and passes them to its ancestors, half with each level; what says that it is an article gets
all points of what it holds.  A container's sum is discounted by its share of text in links.  The best container is
kept with those siblings that score well or read like paragraphs, and with the headings right before them.

All sums go up the tree once, children before parents, so that the work is linear in the page, however deep it is.

Cases: null and empty pages give an empty text; a page without paragraphs gives what text is left after the
cuts; a page whose text is all in elements cut by class or id gives that; broken markup is read leniently, and a tag
or comment that never ends runs to the end of the page; equal rows give equal rows; null ids and urls are kept;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame, SparkSession

from . import common

# Fixed values of HTML: elements by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template svg math object audio video canvas select xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
CUT = frozenset("nav footer aside form button fieldset menu dialog head".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSED_BY = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSED_BY.items()}

_words = "ads? adverts? advertisement advertising adsense sponsor(?:ed)? promo(?:tion)?s? banners? nav navbar navigation menus? sidebars? side-?bar footer foot cookies? consent gdpr notices? alerts? popups? modals? overlay newsletter subscribe signup login comments? comment-?list disqus replies responses? respond share sharing social related recommended breadcrumbs? pagination pager widget toolbar skip-?link copyright legal disclaimer".split()
_head_words = "masthead topbar header site-?header page-?header".split()  # an article's own header holds its title


def _any(words: list[str]) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{'|'.join(words)})(?:$|[\s_-])")


_cut_words, _cut_in_article = _any(_words + _head_words), _any(_words)
_names = re.compile(rf"(?:^|\s)(?:{'|'.join(_words + _head_words)})(?:$|\s)")  # a whole name, which says what the element is
_state = re.compile(r"(?:^|(?<=\s))(?:(?:has|no|not|with|without)[_-]\S+|\S+[_-](?:open|opened|closed|enabled|disabled|required))(?=$|\s)")  # tells of what is around
_prose = _any("comments? comment-?list disqus replies responses? respond related recommended".split())  # paragraphs, but never the page's own
_body = re.compile(r"(?:^|\s)(?:article|post|entry|story|main|page)[_-]?(?:body|content|text)(?:$|\s)")  # whole names that say the opposite
#: Share of the page's (in an article, the article's) points from which an element of a whole name, or of a name in parts, stays.
NAMED, PARTLY = 0.9, 0.5
_cut_roles = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_token = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
_attr = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_hidden = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


PARAGRAPHS = frozenset("p li td th pre blockquote dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that are kept beside the best container if they read like prose.
SINGLE = frozenset("p ul ol dl pre blockquote table figure".split())
ARTICLES = frozenset(("article", "main"))


class Node:
    __slots__ = ("name", "parent", "children", "cut", "article", "least")

    def __init__(self, name: str, parent: Node | None, cut: bool = False, article: bool = False, least: float | None = None):
        self.name, self.parent, self.children, self.cut, self.article, self.least = name, parent, [], cut, article, least


def _is_cut(name: str, attrs: dict[str, str]) -> bool:
    if not attrs:
        return False
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_hidden.search(attrs.get("style", "").lower())) or attrs.get("role", "").lower() in _cut_roles


def _least(name: str, attrs: dict[str, str], in_article: bool) -> float | None:
    """The share of points with which an element stays that is boilerplate by class or id; None if it isn't."""
    if name in ("body", "html", "article", "main"):
        return None
    words, least = _cut_words if not in_article else _cut_in_article, None
    for k in ("class", "id"):
        value = attrs.get(k)
        if value and words.search(value := _state.sub("", value.lower())):
            least = max(least or 0.0, PARTLY if _body.search(value) else 2.0 if _prose.search(value) else NAMED if _names.search(value) else PARTLY)
    return least


def parse(page: str) -> Node:
    """The page's tree; texts are strings among the children."""
    root = Node("#root", None)
    at, here, n, named = 0, root, len(page), []
    open_: Counter[str] = Counter()  # open elements by name, so that what isn't open isn't sought

    def leave(node: Node) -> Node:
        """Closes all elements up to this one; what is open then."""
        inner = here
        while inner is not node:
            open_[inner.name] -= 1
            inner = inner.parent
        open_[node.name] -= 1
        return node.parent

    while at < n:
        m = _token.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            here.children.append(unescape(text))
        if not m:
            break
        at = m.end()
        if m[1] is not None:
            here.children.append(m[1])
            continue
        name, attributes = m[3] or m[7], (m[4] if m[3] else m[8]) or ""
        if not name:
            continue
        name = name.lower()
        if m[2] or m[6]:
            if open_[name]:
                node = here
                while node.name != name:
                    node = node.parent
                here = leave(node)
            elif name == "br":
                here.children.append(" ")
            continue
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            here.children.append(" ") if name in ("select", "noscript") else None
            continue
        if name in CLOSES_P and open_["p"]:
            node = here
            while node is not root and node.name != "p" and node.name in INLINE:
                node = node.parent
            if node.name == "p":
                here = leave(node)
        if name in CLOSED_BY and any(open_[c] for c in CLOSED_BY[name][0]):
            closed, within = CLOSED_BY[name]
            node = here
            while node is not root and node.name not in closed and node.name not in within:
                node = node.parent
            if node.name in closed:
                here = leave(node)
                while name == "tr" and here.name in closed:
                    here = leave(here)
        if name in VOID:
            if name in ("br", "wbr", "img", "input"):
                here.children.append(" " if name != "wbr" else "")
            elif name == "hr":
                here.children.append(Node(name, here))
            continue
        attrs = {}
        if attributes.strip():
            for a in _attr.finditer(attributes):
                attrs.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
        in_article = here.article or name in ("article", "main") or attrs.get("role") == "main" or attrs.get("itemprop") == "articleBody"
        cut = name in CUT or (name == "header" and not in_article) or _is_cut(name, attrs)
        node = Node(name, here, cut, in_article, _least(name, attrs, in_article) if attrs and not cut else None)
        if node.least is not None:
            named.append(node)
        here.children.append(node)
        if not attributes.rstrip().endswith("/") or name not in ("path", "g"):
            here = node
            open_[name] += 1
    if named:
        _cut_named(root, named)
    return root


def _points(text: str, linked: int) -> float:
    points = 1 + text.count(",") + text.count("،") + text.count("、") + min(len(text) / 100, 3)
    return points * (1 - min(1, linked / max(len(text), 1)))


def _cut_named(root: Node, named: list[Node]) -> None:
    """Cuts elements that are boilerplate by class or id, but not those that hold the text of the page or article.

    An element stays if it has its ``least`` share of the points, or if it has a name in parts only and holds an
    article; where an article stands outside of it, it needs more.  If no points would be left, all stay.
    """
    for node in named:
        node.cut = node.name in INLINE
    order = preorder(root)
    sums = dict.fromkeys(map(id, order), 0.0)  # by element: its points
    inside = dict(sums)  # by element: the points in articles
    for b in blocks(root):
        points = _points(b.text(), b.linked)
        sums[id(b.node)] += points
        inside[id(b.node)] += points if b.node.article else 0.0
    for node in reversed(order[1:]):
        sums[id(node.parent)] += sums[id(node)]
        inside[id(node.parent)] += inside[id(node)]
    around: dict[int, Node] = {}  # by element: the innermost article, or the outermost part of it that says so
    for node in order:
        top = node.name in ("article", "main") or node.parent is None or not node.parent.article
        around[id(node)] = node if top else around[id(node.parent)]
    cut = []
    for node in named:
        own, least, scope = sums[id(node)], node.least, root
        if node.article:
            scope = around[id(node.parent)]
        else:
            held = inside[id(node)]
            outside = inside[id(root)] - held
            if least == PARTLY and held:
                least = 0.0 if held >= outside else NAMED
            elif least == PARTLY and outside:
                least = NAMED
        if node.name not in INLINE and not (own and own >= least * sums[id(scope)]):
            cut.append(node)
    for node in cut:
        node.cut = True
    if sums[id(root)] and not any(_points(b.text(), b.linked) for b in blocks(root)):
        for node in cut:
            node.cut = False


def preorder(root: Node) -> list[Node]:
    """All elements, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


class Block:
    __slots__ = ("node", "parts", "linked")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked = node, [], 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def blocks(root: Node) -> list[Block]:
    """Runs of text between borders of block elements, in page order, with the block element each is in."""
    out: list[Block] = []
    now: list[Block | None] = [None]
    stack: list[tuple[Node, object, Node, bool]] = [(root, iter(root.children), root, False)]
    while stack:
        node, children, owner, link = stack[-1]
        for child in children:
            if isinstance(child, str):
                if now[0] is None:
                    if not child.strip():
                        continue
                    now[0] = Block(owner)
                    out.append(now[0])
                now[0].parts.append(child)
                if link:
                    now[0].linked += len(child)
                continue
            if child.cut:
                if child.name not in INLINE:
                    now[0] = None
                continue
            inline = child.name in INLINE
            if not inline:
                now[0] = None
            stack.append((child, iter(child.children), owner if inline else child, link or child.name == "a"))
            break
        else:
            stack.pop()
            if node.name not in INLINE:
                now[0] = None
    return [b for b in out if b.text()]


def weigh(root: Node, found: list[Block]) -> tuple[list[Node], dict, dict, dict, dict]:
    """All elements, and by element: its characters, those in links, its blocks, and its score less its share of links."""
    order = preorder(root)
    size, linked, held, score, total, worth = ({id(n): 0 for n in order} for _ in range(6))
    for b in found:
        text = b.text()
        size[id(b.node)] += len(text)
        linked[id(b.node)] += min(b.linked, len(text))
        held[id(b.node)] += 1
        # the paragraph's points go to what holds it
        holder = b.node.parent if b.node.name in PARAGRAPHS and b.node.parent else b.node
        total[id(holder)] += _points(text, b.linked)
    own = dict(total)
    for node in reversed(order):
        k, up = id(node), node.parent
        score[k] += own[k]
        if up is not None:
            score[id(up)] += score[k] / 2
            for sums in (size, linked, held, total):
                sums[id(up)] += sums[k]
        whole = total[k] if node.name in ARTICLES else score[k]
        worth[k] = whole * (1 - linked[k] / size[k]) if size[k] else 0.0
    return order, size, linked, held, worth


def extract(page: str | None) -> str:
    """The main text of a page: its blocks parted by an empty line."""
    if not page:
        return ""
    root = parse(page)
    found = blocks(root)
    if not found:
        return ""
    order, size, linked, held, worth = weigh(root, found)
    top = max(order, key=lambda n: (worth[id(n)], n.name in ARTICLES))  # the first of equals, which is the outermost
    kept = {id(top)}
    if top.parent is not None and top.name not in ARTICLES:
        after = False  # whether the element after this one is kept
        for sibling in reversed([c for c in top.parent.children if not isinstance(c, str)]):
            k = id(sibling)
            if sibling is not top and (sibling.cut or not size[k]):
                continue
            prose = sibling.name in SINGLE and (size[k] > 80 or _ending(sibling))
            good = linked[k] < 0.3 * size[k] and (worth[k] >= 0.2 * worth[id(top)] or prose)
            after = sibling is top or good or (after and sibling.name in HEADINGS and not linked[k])
            if after:
                kept.add(k)
    links = {id(n) for n in order if n.name in ("ul", "ol", "table") and held[id(n)] > 2 and linked[id(n)] > 0.9 * size[id(n)]}
    # within: a kept element around it, and whether a list of links only, which is a menu, is between
    within: dict[int, tuple[bool, bool]] = {}
    for node in order:
        inside, menu = within[id(node.parent)] if node.parent else (False, False)
        inside = inside or id(node) in kept
        within[id(node)] = inside, inside and (menu or id(node) in links)
    return "\n\n".join(b.text() for b in found if within[id(b.node)] == (True, False))


def _ending(node: Node) -> bool:
    """Whether an element's last text ends like a sentence."""
    while node.children:
        last = next((c for c in reversed(node.children) if not isinstance(c, str) or c.strip()), "")
        if isinstance(last, str):
            return last.strip()[-1:] in tuple(".!?")
        node = last
    return False


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [extract(p) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.arrow_rows(spark, 200)
    return main_text(common.table(spark, sf_dir, "pages"))
