"""Main text of web pages by tree scoring.

A page is read once into a tree of elements with its blocks of text as leaves. Each paragraph
block passes points for its length and commas to its ancestors, the nearer the more, and a
container's points are discounted by its link density. The best container leads to the article:
the ``article`` around it, else the ``main`` around it, else its highest ancestor with few links,
without what beside the best container's path is mostly links (headings stay). All other blocks
in it are kept, lists, tables, headings and short paragraphs too; siblings that score close to
it, or that are plain paragraphs without links, are kept with it.
Elements that by their tag, role or names are menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or reader comments are left out before scoring and again
inside the kept parts. A name counts as a whole (``sidebar``, ``site-footer``, not
``has-sidebar``), and not on what holds the article, most of the page's unlinked paragraph
text, or a section of the article about such a subject.

White space inside a block becomes one space; blocks are joined by an empty line. Character
references are decoded after tags are found, so ``&lt;p&gt;`` stays text. Unclosed tags end
where HTML ends them; stray end tags are ignored.

Null or empty html: empty text. A page without any container that scores gives the blocks that
are left of its body. Of containers with equal scores the first is taken. Very long pages are read
whole, and broken ones in linear time too: a tag without an end is text, from the first unclosed
quote on quotes are not minded, and elements nested deeper than ``DEEPEST`` stand side by side.
Repeated rows are read each, an empty table gives an empty result. Columns named as a result are
replaced, all others stay.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import extended, map_arrow, table

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")

RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "template", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr", "frame", "keygen"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog",
          "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
          "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "option", "select"}
#: Elements that hold no article text.
LEFT_OUT = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "input",
                  "label", "fieldset", "noscript", "object", "applet", "canvas", "audio", "video", "map",
                  "menu", "dialog", "template", "legend", "datalist"}
LEFT_OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog",
                  "alertdialog", "menu", "menubar", "toolbar", "status", "note"}
#: Class and id names that mark what is not the article, alone or as parts of a compound name.
_NAMES = re.compile(
    r"ads?|adverts?|advertisements?|advertising|adbox|adsense|sponsor(?:ed|s)?|promos?|promotion|banner|"
    r"nav|navbar|navigat\w*|menus?|breadcrumbs?|side-?bar|sidenav|aside|widgets?|footer|foot|header|"
    r"masthead|comments?|comment-?list|commentary|disqus|respond|replies|reply|discussion|cookies?|consent|gdpr|"
    r"notices?|notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|sign-?up|login|"
    r"social|share|sharing|sharebar|related|recommend\w*|(?:you-may-)?also-like|trending|toolbar|pagination|pager|tags|"
    r"copyright|legal|disclaimer|skip-?links?|search|forms?|hidden|outbrain|taboola", re.IGNORECASE)
#: Parts that say where or what such an element is (``site-footer``, ``share-buttons``).
_PLACES = re.compile(
    r"site|page|main|global|top|bottom|left|right|primary|secondary|mobile|desktop|user|posts?|articles?|entry|blog|fb|email|"
    r"bar|box|list|links?|buttons?|icons?|area|wrapper|wrap|container|sections?|block|items?|inner|content|body|panel|"
    r"row|group|text|stories|tools|media|results|reading|slots?|unit|label|this|by|for|you|visually|\d+(?:x\d+)?", re.IGNORECASE)
#: Last parts that say so after any other (``acme-footer``).
_LAST = re.compile(r"ads?|adsense|nav|navbar|sidebar|sidenav|footer|breadcrumbs?|comments|newsletter|pagination", re.IGNORECASE)
#: Parts that make a name one of the layout or state (``has-sidebar``, ``article-header``).
_STATES = {"has", "with", "without", "no", "not", "non", "is", "are", "show", "hide", "before", "after", "above", "below"}
_TITLED = {"article", "post", "entry", "section", "content", "chapter", "blog"}
#: Names that a section of an article may bear for its subject.
_TOPICS = re.compile(r"advertising|promotion|navigation|commentary|discussion|cookies?|consent|notices?|notification|"
                     r"alert|subscription|social|sharing|related|recommend\w*|trending|tags|copyright|legal|disclaimer|"
                     r"search|forms?|header", re.IGNORECASE)
_READERS = re.compile(r"comments?|comment-?list|disqus|respond|replies|reply", re.IGNORECASE)
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
           "th": {"table", "tr"}, "option": {"select"}}
DEEPEST = 256                # elements deeper than this stand beside the one that is so deep, as in browsers
FOREIGN = {"svg", "math"}    # raw elements that end with a slash in their start tag
CONTAINERS = {"article", "main", "section", "div", "td", "body", "blockquote", "center"}
BONUS = {"article": 25.0, "main": 20.0, "section": 5.0, "div": 0.0, "td": 0.0, "body": -5.0, "blockquote": 3.0}
SHORTEST_SCORED = 25        # code points of a paragraph that passes points
SIBLING_SHARE = 0.2         # of the best score that a sibling needs
FEW_LINKS = 0.25            # share of linked code points up to which an ancestor holds the article
MOSTLY_LINKS = 0.5          # and from which a part beside the article's path is a menu
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}


class Node:
    """An element: its parent, what it contains in order (nodes and (text, in link) pieces)."""

    __slots__ = ("tag", "parent", "children", "out", "score", "chars", "linked", "names")

    def __init__(self, tag, parent, out):
        self.tag, self.parent, self.out = tag, parent, out
        self.children: list = []
        self.score, self.chars, self.linked = 0.0, 0, 0
        self.names: list[tuple[str, str]] = []           # (attribute, name) that mark what is not the article


def _left_out(tag: str, attrs: str) -> bool:
    """Whether an element's tag, role or state leaves it out."""
    if tag in LEFT_OUT:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in LEFT_OUT_ROLES or name == "hidden" \
                or name == "aria-hidden" and value.lower() == "true" \
                or name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
    return False


def _marks(name: str) -> bool:
    """Whether a whole class or id name marks what is not the article."""
    if _NAMES.fullmatch(name):
        return True
    parts = [p for p in re.split(r"[-_]+", name.lower()) if p]
    if len(parts) < 2 or not _STATES.isdisjoint(parts) or "header" in parts and not _TITLED.isdisjoint(parts):
        return False
    if _LAST.fullmatch(parts[-1]):
        return True
    named = [_NAMES.fullmatch(p) is not None for p in parts]
    return any(named) and all(n or _PLACES.fullmatch(p) for n, p in zip(named, parts))


def _marking(tag: str, attrs: str) -> list[tuple[str, str]]:
    if not attrs or tag in ("html", "body", "article", "main"):
        return []
    return [(name.lower(), word) for name, value in _ATTR.findall(attrs) if name.lower() in ("class", "id")
            for word in value.strip("\"'").split() if _marks(word)]


def _settle(root: Node, marked: list[Node]) -> None:
    """Leave out the elements marked by name, but not what holds the article.

    One that holds the only article or main with paragraphs, or most of the unlinked paragraph
    text (inside the article, where there is one), stays; so does a section of the article that
    bears its subject's name. Reader comments stay out, unless nothing else has paragraphs.
    """
    total = clear = 0
    holds, articles, headed, inside = {id(n): [0, 0, 0] for n in marked}, set(), set(), set()
    for node, _, chars, linked in blocks(root):
        heading = node.tag in HEADINGS
        prose = chars - linked if chars >= SHORTEST_SCORED and not heading else 0
        above, article, readers = [], False, False
        while node is not None:
            if node.names:
                above.append(node)
                readers = readers or _by_readers(node)
                if article and prose:
                    articles.add(id(node))
            elif node.tag in ("article", "main"):
                article = True
                inside.update(id(n) for n in above)
            node = node.parent
        for n in above:
            h = holds[id(n)]
            h[0], h[1], h[2] = h[0] + prose, h[1] + chars, h[2] + linked
            if heading:
                headed.add(id(n))
        total += 0 if readers else prose
        clear += prose if article and not above else 0
    for n in marked:
        prose, chars, linked = holds[id(n)]
        held = id(n) in articles and not clear
        if _by_readers(n):
            n.out = not (held and not total)
        else:
            most = prose > total / 2 and (not clear or id(n) in inside)
            topic = prose and linked < MOSTLY_LINKS * chars and (id(n) in inside or not clear and id(n) in headed) and all(
                _TOPICS.fullmatch(word) and (kind == "id" or n.tag == "section") for kind, word in n.names)
            n.out = not (held or most or topic)


def _by_readers(node: Node) -> bool:
    return any(_READERS.fullmatch(p) for _, word in node.names for p in [word, *re.split(r"[-_]+", word)])


def markup(html: str):
    """(start, end, whether it closes, tag, attributes) of each piece of markup, in one pass.

    Comments and declarations have no tag; a CDATA section's text stands for the attributes. A tag
    without an end is text; one whose quotes have none ends at its first ``>``, and from there on
    quotes are not minded, so that broken pages are read in linear time too.
    """
    size, last, cdata, quotes = len(html), html.rfind(">"), True, True
    at = html.find("<")
    while at >= 0:
        end = -1
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = size if end < 0 else end + 3
            yield at, end, False, None, ""
        elif at <= last:
            if cdata and html.startswith("<![CDATA[", at):
                end = html.find("]]>", at + 9)
                cdata = end >= 0
                if cdata:
                    yield at, end + 3, False, None, html[at + 9:end]
                    end += 3
            if end < 0 and html[at + 1:at + 2] in ("!", "?"):
                end = html.find(">", at) + 1
                yield at, end, False, None, ""
            elif end < 0 and (m := _TAG.match(html, at)):
                end = _tag_end(html, m.end()) if quotes else html.find(">", m.end())
                if end < 0:
                    quotes, end = False, html.find(">", m.end())
                if end >= 0:
                    end += 1
                    yield at, end, bool(m[1]), m[2].lower(), html[m.end():end - 1]
        at = html.find("<", end if end > at else at + 1)


def _tag_end(html: str, at: int) -> int:
    """Place of the ``>`` that ends a tag, outside quotes; -1: none."""
    while m := _STOP.search(html, at):
        if m[0] == ">":
            return m.start()
        close = html.find(m[0], m.end())
        at = m.end() if close < 0 else close + 1
    return -1


_ENDS: dict[str, re.Pattern] = {}


def _raw_end(html: str, tag: str, at: int) -> int:
    """Place after the end tag of a raw element; -1: none."""
    if tag not in _ENDS:
        _ENDS[tag] = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE)
    m = _ENDS[tag].search(html, at)
    return m.end() if m else -1


def parse(html: str) -> Node:
    """The tree of a page."""
    root = here = Node("html", None, False)
    marked: list[Node] = []
    endless: set[str] = set()                  # raw elements without a further end tag
    flat: dict[str, int] = {}                  # open elements too deep to hold others, by tag
    links = depth = 0
    pos, end = 0, len(html)

    def text(piece: str):
        if piece:
            here.children.append((html_lib.unescape(piece) if "&" in piece else piece, links > 0))

    def leave():
        nonlocal here, links, depth
        links -= here.tag == "a"
        here, depth = here.parent, depth - 1

    for start, stop, closes_it, tag, attrs in markup(html):
        if start < pos:
            continue                           # inside a raw element
        text(html[pos:start])
        pos = stop
        if tag is None:
            if attrs:
                here.children.append((attrs, links > 0))
            continue
        if closes_it:
            if flat.get(tag):
                flat[tag] -= 1
                continue
            if tag == "p" and not _open(here, tag):
                here.children.append(Node("p", here, here.out))
                continue
            if tag == "br":
                here.children.append(Node("br", here, here.out))
                continue
            node = here
            while node is not root and node.tag != tag:
                # An inline end tag does not close blocks, nor any tag a table cell around it.
                if node.tag in BLOCKS and tag not in BLOCKS or node.tag in ("td", "th", "table") and tag not in (
                        "table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                    node = root
                    break
                node = node.parent
            if node is not root:
                while here is not node:
                    leave()
                leave()
            continue
        if tag in ("html", "body"):
            if tag == "body" and _open(here, "head"):
                here, depth = root, 0
            continue
        if tag in BLOCKS:
            # A block ends an open paragraph; an item ends the one before it.
            if _open(here, "p", until=("td", "th", "button", "table", "a") if tag != "p" else ("td", "th", "table")):
                while here.tag != "p":
                    leave()
                leave()
            closes = _CLOSES.get(tag)
            if closes and tag != "p":
                node = here
                while node is not root and node.tag not in closes and node.tag not in _SCOPES[tag]:
                    node = node.parent
                if node.tag in closes:
                    while here is not node:
                        leave()
                    leave()
        node = Node(tag, here, here.out or _left_out(tag, attrs))
        here.children.append(node)
        if not node.out:
            node.names = _marking(tag, attrs)
            if node.names:
                marked.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS | RAW - FOREIGN | {"a", "span", "b", "i", "em"}:
            continue
        if tag in RAW:
            close = -1 if tag in endless else _raw_end(html, tag, pos)
            if close < 0:
                endless.add(tag)
            pos = close if close >= 0 else end if tag in ("script", "style", "textarea", "xmp") else pos
            continue
        if depth >= DEEPEST:
            flat[tag] = flat.get(tag, 0) + 1
            continue
        links += tag == "a"
        here, depth = node, depth + 1
    text(html[pos:])
    if marked:
        _settle(root, marked)
    return root


def _open(node: Node, tag: str, until=()) -> bool:
    while node is not None and node.tag not in until:
        if node.tag == tag:
            return True
        node = node.parent
    return False


def blocks(root: Node) -> list[tuple[Node, str, int, int]]:
    """Blocks of text in page order: the element they stand in, text, code points, linked ones."""
    out: list[tuple[Node, str, int, int]] = []
    owner, parts = root, []

    def flush():
        nonlocal parts
        if parts:
            joined = _SPACE.sub(" ", "".join(t for t, _ in parts)).strip()
            if joined:
                linked = sum(len(_SPACE.sub(" ", t)) for t, k in parts if k)
                out.append((owner, joined, len(joined), min(linked, len(joined))))
            parts = []

    stack = [(root, iter(root.children), root)]
    while stack:
        node, children, block = stack[-1]
        for child in children:
            if isinstance(child, tuple):
                if owner is not block:
                    flush()
                    owner = block
                parts.append(child)
            elif child.tag == "br":
                parts.append((" ", False))
            elif not child.out:
                is_block = child.tag in BLOCKS
                if is_block:
                    flush()
                stack.append((child, iter(child.children), child if is_block else block))
                break
        else:
            stack.pop()
            if node.tag in BLOCKS:
                flush()
    flush()
    return out


def _containers(node: Node):
    while node is not None:
        if node.tag in CONTAINERS or node.parent is None:
            yield node
        node = node.parent


def _article(best: Node) -> Node:
    """What holds the whole article whose best container is ``best``."""
    around = list(_containers(best))
    for tag in ("article", "main"):
        outer = [c for c in around if c.tag == tag]
        if outer:
            return outer[-1]
    return next((c for c in reversed(around) if c.linked < FEW_LINKS * c.chars), best)


def _menus(found, best: Node, top: Node) -> set[int]:
    """Places in ``found`` of the blocks under ``top`` that stand beside the path to ``best``, mostly links."""
    path, node = {id(best)}, best
    while node is not top:
        node = node.parent
        path.add(id(node))
    parts: dict[int, list] = {}
    for i, (node, _, chars, linked) in enumerate(found):
        branch, key, heading = node, -1 - i, False            # text of the path's own: a part of its own
        while branch is not None and id(branch) not in path:
            key, heading, branch = id(branch), branch.tag in HEADINGS, branch.parent
        if branch is not None and branch is not best and not heading:
            part = parts.setdefault(key, [0, 0, []])
            part[0] += chars
            part[1] += linked
            part[2].append(i)
    return {i for chars, linked, places in parts.values() if linked >= MOSTLY_LINKS * chars for i in places}


def main_text(html: str) -> str:
    """The article of a page, blocks joined by an empty line."""
    if not html or html.isspace():
        return ""
    found = blocks(parse(html))
    scored: dict[int, Node] = {}
    for node, text, chars, linked in found:
        points = 0.0
        if chars >= SHORTEST_SCORED and node.tag not in ("h1", "h2", "h3", "h4", "h5", "h6"):
            points = (1 + text.count(",") + text.count("、") + min(3.0, chars / 100)) * (1 - linked / chars)
        for level, c in enumerate(_containers(node)):
            if id(c) not in scored:
                scored[id(c)] = c
                c.score = BONUS.get(c.tag, 0.0)
            c.chars += chars
            c.linked += linked
            if level < 4:
                c.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
    if not scored:
        return ""
    value = lambda n: n.score * (1 - n.linked / n.chars if n.chars else 1)
    best = max(scored.values(), key=value)
    top = _article(best)
    menus = set() if top.tag in ("article", "main") or top is best else _menus(found, best, top)
    parent, least = top.parent, max(10.0, SIBLING_SHARE * value(best))
    kept = {id(top)}
    if parent is not None:
        for s in parent.children:
            if isinstance(s, Node) and not s.out and id(s) in scored and value(s) >= least:
                kept.add(id(s))
    loose = {}
    if parent is not None:
        for node, text, chars, linked in found:
            if node.parent is parent and node.tag == "p":
                loose[id(node)] = chars > 80 and linked < 0.25 * chars or \
                    0 < chars <= 80 and not linked and text.endswith((".", "!", "?"))
    kept |= {k for k, good in loose.items() if good}

    def inside(node):
        while node is not None:
            if id(node) in kept:
                return True
            node = node.parent
        return False

    return "\n\n".join(text for i, (node, text, _, _) in enumerate(found) if i not in menus and inside(node))


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` instead of ``html``."""
    names = [c for c in pages.columns if c not in ("text", "n_chars")]
    source = pages.select(*names)
    kept = [c for c in names if c != html]

    def run(batches):
        for batch in batches:
            texts = [main_text(v.as_py() or "") for v in batch.column(batch.schema.get_field_index(html))]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))],
                [*kept, "text", "n_chars"])

    return map_arrow(source, run, extended(source.select(*kept).schema, text=T.StringType(), n_chars=T.LongType()))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
