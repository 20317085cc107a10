"""Main text of HTML pages by tag-path ratios.

Every text node lies on a path of tags from the root. Per path, text length and punctuation are summed and divided
by the nodes that have the path; both ratios are smoothed over the tree of paths, where a step halves the weight,
and fused; an article or main element weighs more. Paths near the best fused value are the seeds, on every page; the
container of a seed (its article or main element, else the element around its block) is content with everything in it
but menus, notices and other page furniture. A class, id or role names furniture while its element holds less than
half of the page's text; beyond that it weighs less. An article inside an article is a comment or a teaser while it
holds less than half of the outer one's text, and so are the headings beside it; a block whose text is nearly all link
text is a menu, unless it lies in an article or main element.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import prepare

# Element names of HTML, and words that name page furniture in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
               "th": ("tr", "table"), "option": ("select",)}
FURNITURE = frozenset("head nav header footer aside form script style noscript iframe template svg select button "
                      "textarea dialog menu object canvas title".split())
NAMED = frozenset("ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments "
                  "complementary contentinfo cookie cookies consent disclaimer discussion disqus footer form header "
                  "masthead menu nav navbar navigation newsletter notice notices notification pagination popup promo "
                  "promoted related replies search share sharing sidebar signup skip social sponsor sponsored "
                  "subscribe toolbar widget".split())
LANDMARK = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: With one of these beside it, the word header or footer in a name belongs to the text itself.
OF_THE_TEXT = frozenset("article body content entry post story".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")

#: Weight of one step between two paths, share of the best value that makes a seed, and weight of a landmark.
STEP_WEIGHT, SEED_SHARE, LANDMARK_WEIGHT = 0.5, 0.5, 4.0
#: Share of a page's text from which on a name doesn't make an element furniture.
NAMED_SHARE = 0.5
#: Share of link text from which on a block is a menu, and share of an article's text below which one inside it is aside.
LINK_SHARE, INNER_SHARE = 0.66, 0.5

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\s*(?:[^\s\"'>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"']))*)\s*"
    r"(?:>|\Z)", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
WORDS = re.compile(r"[^a-z0-9]+")


class Paths:
    """The tree of tag paths of one page: what a path's text nodes hold, and whether it lies in furniture."""

    def __init__(self):
        self.parent, self.known = [-1], {}
        self.furniture, self.named, self.landmark, self.block = [False], [False], [-1], [True]
        self.article, self.inner, self.link, self.heading = [-1], [False], [False], [False]
        self.chars, self.points, self.nodes = [0], [0], [0]

    def child(self, path: int, tag: str, named: bool) -> int:
        key = (path, tag, named)
        if key not in self.known:
            new = self.known[key] = len(self.parent)
            self.parent.append(path)
            self.furniture.append(self.furniture[path] or tag in FURNITURE)
            self.named.append(named)
            self.landmark.append(new if self.landmark[path] < 0 and tag in LANDMARK else self.landmark[path])
            self.block.append(tag not in INLINE)
            self.inner.append(tag == "article" and self.article[path] >= 0)
            self.article.append(new if tag == "article" and self.article[path] < 0 else self.article[path])
            self.link.append(tag == "a" or tag in INLINE and self.link[path])
            self.heading.append(tag in HEADINGS or tag in INLINE and self.heading[path])
            self.chars.append(0), self.points.append(0), self.nodes.append(0)
        return self.known[key]

    def add(self, path: int, text: str) -> None:
        self.chars[path] += len(text)
        self.points[path] += len(PUNCTUATION.findall(text))
        self.nodes[path] += 1

    def smoothed(self, values: list[float]) -> list[float]:
        """Sum over all paths, weighted by STEP_WEIGHT to the power of the distance: one pass up, one down."""
        up = list(values)
        for v in range(len(up) - 1, 0, -1):
            up[self.parent[v]] += STEP_WEIGHT * up[v]
        full = list(up)
        for v in range(1, len(full)):
            full[v] += STEP_WEIGHT * (full[self.parent[v]] - STEP_WEIGHT * up[v])
        return full

    def content(self) -> list[bool]:
        """For each path, whether its text is content."""
        held = [n * (not f) for n, f in zip(self.chars, self.furniture)]
        for v in range(len(held) - 1, 0, -1):
            held[self.parent[v]] += held[v]
        free = [not f for f in self.furniture]
        for v in self.menus() + self.asides(held):
            free[v] = False
        under_name = [False] * len(free)
        for v in range(1, len(free)):
            free[v] = free[v] and free[self.parent[v]] and not (self.named[v] and held[v] < NAMED_SHARE * held[0])
            under_name[v] = self.named[v] or under_name[self.parent[v]]
        nodes = self.smoothed([n * ok for n, ok in zip(self.nodes, free)])
        chars = self.smoothed([n * ok for n, ok in zip(self.chars, free)])
        points = self.smoothed([n * ok for n, ok in zip(self.points, free)])
        fused = [0.0] * len(free)
        for v, ok in enumerate(free):
            if ok and self.nodes[v]:
                fused[v] = chars[v] / nodes[v] * (1 + points[v] / nodes[v])
                if self.landmark[v] >= 0:
                    fused[v] *= LANDMARK_WEIGHT
                if under_name[v]:
                    fused[v] /= LANDMARK_WEIGHT
        best = max(fused)
        chosen = [False] * len(free)
        for v, value in enumerate(fused):
            if value > 0 and value >= SEED_SHARE * best:
                chosen[self.landmark[v] if self.landmark[v] >= 0 else self.container(v)] = True
        for v in range(1, len(free)):
            chosen[v] = free[v] and (chosen[v] or chosen[self.parent[v]])
        return chosen

    def asides(self, held: list[int]) -> list[int]:
        """Articles inside articles with less than a share of the outer one's text."""
        return [v for v, inner in enumerate(self.inner) if inner and held[v] < INNER_SHARE * held[self.article[v]]]

    def menus(self) -> list[int]:
        """Links in blocks outside landmarks whose text is nearly all link text."""
        blocks = [self.block_of(v) for v in range(len(self.parent))]
        all_chars, link_chars = [0] * len(blocks), [0] * len(blocks)
        for v, b in enumerate(blocks):
            all_chars[b] += self.chars[v]
            link_chars[b] += self.chars[v] * self.link[v]
        return [v for v, b in enumerate(blocks)
                if self.link[v] and self.landmark[v] < 0 and b and link_chars[b] >= LINK_SHARE * all_chars[b]]

    def block_of(self, v: int) -> int:
        """The nearest block element of a path."""
        while not self.block[v]:
            v = self.parent[v]
        return v

    def container(self, v: int) -> int:
        """The element around the block that holds the text of path v; text directly under the root is its own."""
        v = self.block_of(v)
        above = self.parent[v]
        return above if above > 0 and self.parent[above] > 0 else v


def _opened(attributes: str) -> bool:
    for _, *values in NAMES.findall(attributes):
        for name in "".join(values).lower().split():
            words = set(WORDS.split(name))
            if words & NAMED - ({"header", "footer"} if words & OF_THE_TEXT else set()):
                return True
    return False


def main_text(page: str | None) -> str:
    """The page's main text: blocks in page order joined by a space, white space inside them as one space."""
    if not page:
        return ""
    # Open elements: tag, path, number. What an element holds besides text, by its number: an article inside an article.
    paths, stack, found, block, at = Paths(), [("", 0, 0)], [], 0, 0
    elements, around_inner = 0, set()

    def text(raw: str) -> None:
        if raw:
            decoded = html.unescape(raw) if "&" in raw else raw
            path = stack[-1][1]
            if not decoded.isspace():
                paths.add(path, decoded.strip())
            # A heading stands for the element around it.
            beside = next((n for t, _, n in reversed(stack) if t not in INLINE and t not in HEADINGS), 0) if paths.heading[path] else -1
            found.append((path, block, decoded, beside))

    while (token := TOKEN.search(page, at)) is not None:
        text(page[at:token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        closing = bool(token[1])
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth and not (tag in INLINE and any(s[0] not in INLINE for s in stack[depth:])):
                del stack[depth:]
            if tag not in INLINE:
                block += 1
            continue
        if tag not in INLINE:
            block += 1
            if len(stack) > 1 and stack[-1][0] not in ("html", "body"):
                if tag in SAME_CLOSES:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in SAME_CLOSES[tag]:
                            break
                        if stack[i][0] == tag or {stack[i][0], tag} <= {"td", "th"} or {stack[i][0], tag} == {"dt", "dd"}:
                            del stack[i:]
                            break
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in CLOSED_BY_BLOCK:
                        del stack[i:]
                        break
                    if stack[i][0] not in INLINE:
                        break
            if tag == "body":
                while len(stack) > 1 and stack[-1][0] != "html":
                    stack.pop()
        elif tag == "br":
            found.append((stack[-1][1], block, " ", -1))
        if tag in VOID:
            continue
        named = tag not in ("html", "body") and bool(token[3]) and _opened(token[3])
        if tag in RAW_END:
            end = RAW_END[tag].search(page, at)
            at = end.start() if end else len(page)
        elements += 1
        path = paths.child(stack[-1][1], tag, named)
        if paths.inner[path]:
            around_inner.add((stack[-1][2], path, stack[-1][0] == "article"))
        stack.append((tag, path, elements))
    tail = page[at:]
    cut = re.search(r"<(?:[a-zA-Z/!?]|\Z)", tail)  # a tag that the end of the page cuts off is no text
    text(tail[:cut.start()] if cut else tail)

    chosen = paths.content()
    # Headings right beside inner articles that are left out go with them; those of the outer article itself stay.
    left_out = {element for element, path, article in around_inner if not chosen[path] and not article}
    blocks: dict[int, list[str]] = {}
    for path, number, piece, beside in found:
        if chosen[path] and beside not in left_out:
            blocks.setdefault(number, []).append(piece)
    return " ".join(t for t in (" ".join("".join(parts).split()) for parts in blocks.values()) if t)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every page.

    A null or empty page, and a page without main text, has the empty text. Null and repeated ids and urls pass
    through, one row for each input row; an empty table gives no rows; other columns are ignored. A page is read
    whole, and one that breaks off in the middle counts as far as it goes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()),
                 pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
