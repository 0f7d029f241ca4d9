"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by the path of tags from the root to them. Per path
the text length, the punctuation, the nodes and the linked text are summed. Two
ratios follow, text per node and punctuation per node, each weighed down by the share
of linked text. The ratios are smoothed over the places of the page by a Gaussian
window, fused as a geometric mean, and a threshold on the fused ratio, relative to
the page's deviation, marks content paths. The subtree around which content gathers
is the article: all its blocks are taken, in page order, except what its tags or
names mark as something else (menus, notices, adverts, comments and the like), and
lists of nothing but links. Names are not believed where an element holds nearly all
content of the page. Unmarked headings and blocks on content paths beside the article
are taken, too.

A page is worked on alone: no shuffle, time and memory in proportion to the page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Elements whose text is never content.
SKIPPED = frozenset(
    "script style noscript template head title iframe object svg canvas audio video select "
    "option textarea button form fieldset label input nav footer aside dialog menu".split()
)
#: Elements that may stand in a head; any other one, or text, ends it. Those of them whose
#: content may be any element.
IN_HEAD = frozenset(
    "html head title base link meta style script noscript template bgsound basefont".split()
)
HOLDS_ANY = frozenset("noscript template".split())
#: Elements without an end tag.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that break the text into blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open paragraph.
ENDS_P = BLOCKS - {"html", "body"}
#: Parts of a class or id that mark something else than the article.
BOILERPLATE = re.compile(
    r"(?<![a-z])(nav|navbar|navigation|menu|breadcrumbs?|header|masthead|banner|footer|foot|sidebar|"
    r"side|aside|related|recommend(?:ed|ations?)?|widget|cookies?|consent|gdpr|notice|notification|"
    r"popup|modal|overlay|newsletter|subscribe|signup|login|search|ads?|advert(?:s|isements?|ising)?|"
    r"sponsor(?:ed|s)?|promo(?:tion)?s?|social|share|sharing|comments?|discussion|disqus|replies|"
    r"reply|respond|copyright|legal|pagination|pager|skip|toolbar|teasers?|trending|popular|tags)"
    r"(?![a-z])"
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
    "form toolbar".split()
)
#: Classes that tell of something beside the element, or of an article's own header.
NOT_ITSELF = re.compile(
    r"(has|no|with|without|not|hide|show|js)[-_]|(entry|post|article|story|content)[-_]header$"
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text belongs to an article although all of it may be linked.
TEXT_BLOCKS = HEADINGS | {"p", "td", "th", "blockquote", "pre", "figcaption", "caption"}
PUNCTUATION = re.compile(r"[^\w\s]")
SPACE = re.compile(r"\s+")
#: Standard deviation of the smoothing window, in nodes.
SIGMA = 1.0
#: Content paths have at least this share of the page's deviation of fused ratios.
THRESHOLD = 0.5
#: Share of a page's content from which an element's names are not believed: if the
#: element holds the page's title, main or article, and if it holds none of them.
HOLDS_ARTICLE, HOLDS_ALL = 0.8, 0.95
#: Linked texts of one path from which blocks of nothing else are a menu.
MENU_LINKS = 3


class Node:
    """A text node: its block, the number of its path and of its element."""

    __slots__ = ("block", "path", "element", "linked", "heading", "prose", "text")

    def __init__(self, block, path, element, linked, heading, prose, text):
        self.block, self.path, self.element = block, path, element
        self.linked, self.heading, self.prose, self.text = linked, heading, prose, text


class Open:
    """An open element: what its text inherits from it."""

    __slots__ = ("tag", "number", "path", "linked", "heading", "prose", "skipped")

    def __init__(self, tag, number, path, linked, heading, prose, skipped):
        self.tag, self.number, self.path = tag, number, path
        self.linked, self.heading, self.prose, self.skipped = linked, heading, prose, skipped


class PageReader(HTMLParser):
    """Text nodes of a page in order, with their paths from the root.

    Missing end tags are supplied: a block ends an open paragraph, an end tag ends
    what is open inside its element. Text of elements that are never content is left out.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = []
        self.open = [Open("", 0, 0, False, False, False, False)]
        self.counts: dict[str, int] = {}  # open elements by tag
        self.tags: list[tuple[str, int]] = [("", -1)]  # tag and parent of each element
        self.paths: dict[tuple[int, str], int] = {}  # by the parent's path and the tag
        self.marked: list[int] = []  # elements that their names mark as no content
        self.block = 0

    def any_open(self, tags) -> bool:
        return any(self.counts.get(t) for t in tags)

    def end(self, at: int) -> None:
        """Close the open elements from that place on."""
        for element in self.open[at:]:
            self.counts[element.tag] -= 1
        del self.open[at:]

    def handle_starttag(self, tag, attributes):
        if tag not in IN_HEAD and not self.any_open(HOLDS_ANY):
            self.close("head")
        if tag in BLOCKS:
            self.block += 1
        if tag in ENDS_P:
            self.close("p")
        if tag == "br":
            self.handle_data(" ")
        elif tag == "li":
            self.close("li", stop=("ul", "ol", "menu"))
        elif tag in ("td", "th"):
            self.close("td", stop=("tr", "table"))
            self.close("th", stop=("tr", "table"))
        elif tag == "tr":
            self.close("tr", stop=("table",))
        elif tag in ("dd", "dt"):
            self.close("dd", stop=("dl",))
            self.close("dt", stop=("dl",))
        if tag in VOID:
            return
        given = dict(attributes)
        above = self.open[-1]
        skipped = (
            above.skipped
            or tag in SKIPPED
            or (given.get("role") or "").lower() in ROLES
            or "hidden" in given
            or (given.get("aria-hidden") or "").lower() == "true"
            or "display:none" in (given.get("style") or "").lower().replace(" ", "")
        )
        number = len(self.tags)
        self.tags.append((tag, above.number))
        if (tag == "header" and not self.any_open(("article", "main"))) or (
            tag not in ("html", "body", "main", "article")
            and self.named(f"{given.get('class') or ''} {given.get('id') or ''}")
        ):
            self.marked.append(number)
        path = self.paths.setdefault((above.path, tag), len(self.paths) + 1)
        self.counts[tag] = self.counts.get(tag, 0) + 1
        self.open.append(
            Open(
                tag,
                number,
                path,
                above.linked or tag == "a",
                above.heading or tag in HEADINGS,
                above.prose or tag in TEXT_BLOCKS,
                skipped,
            )
        )

    @staticmethod
    def named(names: str) -> bool:
        """Whether a class or an ID marks something else than the article."""
        return any(
            BOILERPLATE.search(name.replace("_", "-")) and not NOT_ITSELF.match(name)
            for name in names.lower().split()
        )

    def close(self, tag, stop=()):
        if not self.counts.get(tag):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.end(i)
                return
            if self.open[i].tag in stop or (tag == "p" and self.open[i].tag in BLOCKS):
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.block += 1
        if self.counts.get(tag):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == tag:
                    self.end(i)
                    return

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self.close("head")
        at = self.open[-1]
        if data and not at.skipped:
            self.nodes.append(
                Node(self.block, at.path, at.number, at.linked, at.heading, at.prose, data)
            )


def path_sums(nodes: list[Node]) -> dict[int, list[float]]:
    """Text length, punctuation, nodes and linked text of each path."""
    sums: dict[int, list[float]] = {}
    for node in nodes:
        s = sums.setdefault(node.path, [0.0, 0.0, 0.0, 0.0])
        length = len(node.text.strip())
        s[0] += length
        s[1] += len(PUNCTUATION.findall(node.text))
        s[2] += 1
        s[3] += length if node.linked else 0
    return sums


def fused_ratios(nodes: list[Node]) -> np.ndarray:
    """Fused tag-path ratio at each node, smoothed over the page."""
    sums = path_sums(nodes)
    text, punctuation = np.empty(len(nodes)), np.empty(len(nodes))
    for i, node in enumerate(nodes):
        chars, marks, n, linked = sums[node.path]
        unlinked = 1 - linked / chars if chars else 0.0
        text[i] = chars / n * unlinked
        punctuation[i] = marks / n * unlinked
    reach = int(3 * SIGMA)
    window = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(nodes)), window, "full")[reach : reach + len(nodes)]

    def smooth(values):
        return np.convolve(values, window, "full")[reach : reach + len(nodes)] / weight

    return np.sqrt(smooth(text) * smooth(1 + punctuation))


def content_of(nodes: list[Node]) -> np.ndarray:
    """Whether each node is on a content path."""
    ratios = fused_ratios(nodes)
    return ratios >= THRESHOLD * ratios.std()


def scores_of(nodes: list[Node], content: np.ndarray, tags: list[tuple[str, int]]) -> list[float]:
    """Text of content nodes in each element; parents come before their children."""
    score = [0.0] * len(tags)
    for node, good in zip(nodes, content, strict=True):
        if good:
            score[node.element] += len(node.text.strip())
    for number in range(len(tags) - 1, 0, -1):
        score[tags[number][1]] += score[number]
    return score


def within(roots: set[int], tags: list[tuple[str, int]]) -> list[bool]:
    """Whether each element is one of those, or inside one."""
    found = [False] * len(tags)
    for number, (_, parent) in enumerate(tags):
        found[number] = number in roots or (parent >= 0 and found[parent])
    return found


def other_than_article(
    nodes: list[Node], tags: list[tuple[str, int]], marked: list[int]
) -> list[bool]:
    """Whether each element is something else, or inside it, as its names say.

    A marked element that holds nearly all content, and the title, the main or the
    article of the page, or just all content, is the page's frame; what is marked
    inside a frame is measured against it.
    """
    score = scores_of(nodes, content_of(nodes), tags)
    total = score[0]
    names = set(marked)
    holds = [
        tag in ("h1", "main")
        or (tag == "article" and number not in names and score[number] >= total / 2)
        for number, (tag, _) in enumerate(tags)
    ]
    for number in range(len(tags) - 1, 0, -1):
        holds[tags[number][1]] |= holds[number]
    others = set()
    for number in marked:
        if total and score[number] >= (HOLDS_ARTICLE if holds[number] else HOLDS_ALL) * total:
            total = score[number]
        else:
            others.add(number)
    return within(others, tags)


def menus(nodes: list[Node]) -> set[int]:
    """Blocks of nothing but links, on paths of nothing but links, outside of prose."""
    sums = path_sums(nodes)
    rest = {
        n.block
        for n in nodes
        if n.prose or not n.linked or sums[n.path][2] < MENU_LINKS
    }
    return {n.block for n in nodes} - rest


def article_of(
    nodes: list[Node], content: np.ndarray, tags: list[tuple[str, int]]
) -> tuple[int, set[int]]:
    """Number of the element around which content paths gather, and blocks beside it.

    Scores of content nodes are their text. From the root, the search goes down to a
    child as long as it holds nearly all of its parent's score. What it left out on the
    way belongs to the page, too: the element is the outermost article that it passed, or
    else the outermost main, or else the last. Blocks beside it with unlinked text on
    content paths or in headings are taken within that main, or, where it passed neither,
    within the page.
    """
    score = scores_of(nodes, content, tags)
    best = [-1] * len(tags)  # the child with the highest score, the first of equal ones
    for number in range(1, len(tags)):
        parent = tags[number][1]
        if best[parent] < 0 or score[number] > score[best[parent]]:
            best[parent] = number
    at, passed = 0, [0]
    while (child := best[at]) >= 0:
        if tags[child][0] not in BLOCKS or tags[child][0] == "p":
            break
        if score[child] < 0.8 * score[at] or not score[child]:
            break
        at = child
        passed.append(at)
    article, main = (
        next((n for n in passed if tags[n][0] == name), None) for name in ("article", "main")
    )
    root = next((n for n in (article, main) if n is not None), at)
    bound = main if article is not None or main is not None else 0
    beside: set[int] = set()
    if bound is not None and bound < root:
        near = within({bound}, tags)
        beside = {
            n.block
            for n, good in zip(nodes, content, strict=True)
            if not n.linked and (good or n.heading) and near[n.element]
        }
    return root, beside


def main_text(html: str) -> str:
    """Main text of a page: blocks in page order, joined by an empty line."""
    reader = PageReader()
    try:
        reader.feed(html)
        HTMLParser.close(reader)
    except (AssertionError, ValueError):  # a broken declaration: keep what was read
        pass
    nodes, tags = reader.nodes, reader.tags
    seen = [n for n in nodes if n.text.strip()]
    if seen and reader.marked:
        other = other_than_article(seen, tags, reader.marked)
        nodes = [n for n in nodes if not other[n.element]]
        seen = [n for n in seen if not other[n.element]]
    if not seen:
        return ""
    links = menus(seen)
    root, beside = article_of(seen, content_of(seen), tags)
    article = within({root}, tags)
    blocks: dict[int, list[str]] = {}
    for node in nodes:
        if node.block in beside or (article[node.element] and node.block not in links):
            blocks.setdefault(node.block, []).append(node.text)
    texts = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of each page: ``page_id``, ``url``, ``text``, ``n_chars``.

    A null or empty page, or one without text, has the empty text. Pages are read one
    by one and whole, however long, so repeated rows give repeated results; other columns
    are ignored. An empty table gives an empty result.
    """
    schema = T.StructType(
        [
            pages.schema["page_id"],
            pages.schema["url"],
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
            columns = [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return pages.select("page_id", "url", "html").mapInArrow(rows, schema)
