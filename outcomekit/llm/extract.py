"""Main text of web pages by tree scoring.

Method
    A page becomes a tree of elements; an unclosed paragraph or list item ends where the next begins.
    Parts that are never the article go first: scripts, styles, menus, headers and footers of the page,
    asides and hidden elements. Forms and elements with a class, id or role that names an advert,
    notice, menu, sidebar or comments go too, unless they hold the article: an ``article`` or ``main``
    element not so named itself or, on a page without one elsewhere, more than half of the paragraphs'
    points. A name counts as a whole: ``sidebar``, or ``left-sidebar`` of parts that are all such words
    or their usual companions, but not ``has-sidebar``. Every paragraph passes points for its length and commas to its parent, half of them to
    its grandparent and less to those above. An element's points are discounted by its link density,
    the part of its text that lies in links. The element with most points is the container; siblings
    with a fair part of its points, and sibling paragraphs of plain text, are kept with it. A container
    inside an ``article`` element stands for the whole article. Lists and boxes in it that are mostly
    links are left out.

Result
    Text of the kept elements as blocks in page order, character references decoded, white space in a
    block turned into one space, blocks joined by an empty line.

Defined cases
    A null or empty page, or one without text outside the parts left out, has the text ''. A page
    without markup is one block. Equal points are decided by page order. Repeated pages are rows of
    their own. Markup that never ends reaches to the end of the page. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][-\w:]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in ("script", "style", "textarea", "title", "xmp")}
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template nav footer aside form button select textarea input iframe object svg canvas"
    " head title menu dialog audio video map".split()
) - {"form"}
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5"
    " h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose opening tag ends an open paragraph.
ENDS_P = BLOCKS | frozenset("aside dialog footer form menu nav".split())
#: Elements that an opening tag ends: the key's own kind, up to the nearest of the values.
ENDS_ITSELF = {
    "li": frozenset({"ul", "ol"}),
    "dt": frozenset({"dl"}),
    "dd": frozenset({"dl"}),
    "tr": frozenset({"table"}),
    "td": frozenset({"table", "tr"}),
    "th": frozenset({"table", "tr"}),
    "option": frozenset({"select"}),
}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
#: Words of a class or id that name something other than the article.
UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner sidebar rail"
    " nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar comment comments disqus"
    " respond replies cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social related recommended recommendations widget pagination pager"
    " skip hidden".split()
)
#: Words beside them in a name that leave its meaning.
COMPANIONS = frozenset(
    "site page global main primary secondary left right top bottom inner outer sticky fixed floating post article entry"
    " blog google wp js the box boxes container wrapper wrap area block blocks list item items section slot unit units"
    " link links bar bars button buttons form body header text message title content posts stories articles icons"
    " visually label policy".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
#: Elements that are the article, or hold it, whatever their names.
HOLDERS = frozenset({"article", "main"})
IN_HEAD = frozenset("title meta link style script base noscript template".split())
#: Points that elements above a paragraph get, nearest first, as parts of the paragraph's.
FALL = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12, 1 / 15)
SIBLING_SHARE = 0.2
SIBLING_LEAST = 10.0


class Element:
    __slots__ = ("tag", "parent", "children", "dropped", "unlikely", "points", "text_len", "link_len", "links", "in_link")

    def __init__(self, tag: str, parent: Element | None, dropped: bool, unlikely: bool = False) -> None:
        self.tag, self.parent, self.dropped, self.unlikely = tag, parent, dropped, unlikely
        self.children: list[Element | str] = []
        self.points = 0.0
        self.text_len = self.link_len = self.links = 0
        self.in_link = tag == "a" or (parent is not None and parent.in_link)


def names_other(name: str) -> bool:
    """Whether a class or id, as a whole, names something other than the article."""
    parts = re.findall(r"[a-z]+", name)
    return not UNLIKELY.isdisjoint(parts) and all(p in UNLIKELY or p in COMPANIONS for p in parts)


def judged(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is never the article, and whether it is unlikely to be, as its names say."""
    gone, unlikely = tag in DROPPED or tag == "header" and not in_article, tag == "form"
    if gone or not attrs or tag in ("html", "body"):
        return gone, unlikely
    for name, *values in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id"):
            unlikely = unlikely or any(map(names_other, value.split()))
        elif name == "role":
            unlikely = unlikely or value in ROLES
        elif tag in HOLDERS:
            continue
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            gone = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            gone = True
    return gone, unlikely


def parse(html: str) -> list[Element]:
    """Elements of a page in the order of their opening tags, the page itself first."""
    root = Element("", None, False)
    elements, stack, opened = [root], [root], Counter()

    def close(upto: int) -> None:
        while len(stack) > upto:
            opened[stack.pop().tag] -= 1

    at = 0
    while True:
        found = MARKUP.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text:
            stack[-1].children.append(unescape(text))
        if not found:
            return elements
        at = found.end()
        tag = found["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if found["end"]:
            if opened[tag]:
                at_depth = len(stack) - 1
                while stack[at_depth].tag != tag:
                    at_depth -= 1
                close(at_depth)
            continue
        if opened["head"] and tag not in IN_HEAD:
            depth = len(stack) - 1
            while stack[depth].tag != "head":
                depth -= 1
            close(depth)
        if tag in ENDS_P and opened["p"]:
            depth = len(stack) - 1
            while stack[depth].tag != "p":
                depth -= 1
            close(depth)
        if tag in ENDS_ITSELF:
            stops, kinds = ENDS_ITSELF[tag], SAME.get(tag, (tag,))
            depth = len(stack) - 1
            if any(opened[k] for k in kinds):
                while depth > 0 and stack[depth].tag not in kinds and stack[depth].tag not in stops:
                    depth -= 1
                if depth > 0 and stack[depth].tag in kinds:
                    close(depth)
        parent = stack[-1]
        in_article = bool(opened["article"])
        gone, unlikely = judged(tag, found["attrs"] or "", in_article)
        element = Element(tag, parent, parent.dropped or gone, unlikely)
        parent.children.append(element)
        elements.append(element)
        if tag in RAW:
            end = RAW[tag].search(html, at)
            at = end.end() if end else len(html)
        elif tag not in EMPTY:
            stack.append(element)
            opened[tag] += 1


def plain(text: str) -> str:
    return " ".join(text.split())


def own_text(element: Element) -> str:
    """Text of an element outside the blocks in it and the parts left out."""
    out, todo = [], list(reversed(element.children))
    while todo:
        child = todo.pop()
        if isinstance(child, str):
            out.append(child)
        elif not child.dropped:
            if child.tag == "br":
                out.append(" ")
            elif child.tag not in BLOCKS:
                todo.extend(reversed(child.children))
    return plain("".join(out))


def measure(elements: list[Element]) -> None:
    """Give lengths of text and links to all elements."""
    for element in elements:
        element.text_len = element.link_len = element.links = 0
        if element.dropped:
            continue
        if element.tag == "a":
            element.links += 1
        for child in element.children:
            if isinstance(child, str):
                n = len(plain(child))
                element.text_len += n
                element.link_len += n * element.in_link
    for element in reversed(elements[1:]):
        if not element.dropped:
            up = element.parent
            up.text_len += element.text_len
            up.link_len += element.link_len
            up.links += element.links


def own_points(element: Element) -> float:
    """Points of a block for its own text."""
    if element.dropped or element.tag not in BLOCKS and element.tag:
        return 0.0
    text = own_text(element)
    return (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - density(element)) if text else 0.0


def drop_unlikely(elements: list[Element]) -> None:
    """Leave out elements that are unlikely to be the article, but not those that hold it."""
    if not any(e.unlikely and not e.dropped and e.tag not in HOLDERS for e in elements):
        return
    measure(elements)
    points = {id(e): own_points(e) for e in elements}
    holders = {id(e): int(e.tag in HOLDERS and e.text_len > 0 and not e.dropped and not e.unlikely) for e in elements}
    above = {id(elements[0]): 0}
    for element in elements[1:]:
        above[id(element)] = above[id(element.parent)] + holders[id(element.parent)]
    for element in reversed(elements[1:]):
        points[id(element.parent)] += points[id(element)]
        holders[id(element.parent)] += holders[id(element)]
    page = id(elements[0])
    for element in elements[1:]:
        if element.parent.dropped:
            element.dropped = True
        elif element.unlikely and element.tag not in HOLDERS and not holders[id(element)]:
            elsewhere = holders[page] > above[id(element)]
            element.dropped = elsewhere or points[id(element)] <= points[page] / 2


def score(elements: list[Element]) -> Element | None:
    """Give points and lengths to all elements; the best container, or none without text."""
    measure(elements)
    for element in elements:
        points = own_points(element)
        if not points:
            continue
        above = element.parent if element.tag in PARAGRAPHS else element
        for part in FALL:
            if above is None:
                break
            above.points += points * part
            above = above.parent
    best = None
    for element in elements:
        if not element.dropped and element.text_len and (element.tag in BLOCKS or not element.tag):
            value = element.points * (1 - density(element))
            if best is None or value > best.points * (1 - density(best)):
                best = element
    return best


PARAGRAPHS = frozenset("p pre li dd dt h1 h2 h3 h4 h5 h6 blockquote figcaption td th address".split())


def density(element: Element) -> float:
    return element.link_len / element.text_len if element.text_len else 0.0


def kept_elements(best: Element) -> list[Element]:
    """The container and the siblings that belong to it, in page order."""
    above: Element | None = best
    while above is not None:
        if above.tag == "article":
            best = above
        above = above.parent
    if best.parent is None:
        return [best]
    least = max(SIBLING_LEAST, SIBLING_SHARE * best.points)
    kept = []
    for child in best.parent.children:
        if child is best:
            kept.append(child)
        elif isinstance(child, Element) and not child.dropped and child.text_len:
            linked = density(child)
            if child.points * (1 - linked) >= least:
                kept.append(child)
            elif child.tag == "p":
                text = own_text(child)
                if len(text) > 80 and linked < 0.25 or linked == 0 and text[-1:] in ".!?":
                    kept.append(child)
    return kept


def blocks(kept: list[Element]) -> list[str]:
    """Texts of the blocks below ``kept``."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = plain("".join(line))
        line.clear()
        if text:
            out.append(text)

    todo: list[Element | str | None] = list(reversed(kept))
    tops = set(map(id, kept))
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(item)
        elif item.dropped:
            continue
        elif item.tag == "br":
            line.append(" ")
        elif item.tag in BLOCKS or not item.tag or id(item) in tops:
            if id(item) not in tops and item.tag not in PARAGRAPHS and item.links > 1 and density(item) > 0.5:
                continue
            flush()
            todo.append(None)
            todo.extend(reversed(item.children))
        else:
            todo.extend(reversed(item.children))
    flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    elements = parse(html)
    drop_unlikely(elements)
    best = score(elements)
    return "\n\n".join(blocks(kept_elements(best))) if best is not None else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
