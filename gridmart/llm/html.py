"""Main text of web pages by consensus of the pages of a host.

Each page's containers are scored by the running text right below them. Spark adds the scores up by host and
generalised path (tags with their classes, digits taken out) and the best path of each host wins. Every page is
then extracted anew from all containers on the winning path, in page order, or from those on the path of its own best one where it
has no such path; so an article that lies in several containers of one kind is whole.

The text is made of blocks in page order, joined by line ends; white space inside a block is one space. Menus,
headers, footers, side bars, notices, adverts, forms, scripts, styles and comments do not count, told by tag,
role, class or id. A class or id is only a hint: it does not count for an article, nor for a part that holds over half of the
page's running text, or over a quarter with an article in it, on a page without another article, unless it is about readers'
comments. Controls inside a
paragraph are left out of it and do not end it. Character references are decoded, in each run of text by itself. A page cut off inside a tag
loses that tag only. A null or empty page has an empty text; a page whose address is null or has no host votes with
all others of that kind; repeated rows count and return each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.tables import in_tasks, written

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr img br nobr blink picture map meter progress".split()
)
DROPPED = frozenset(
    "head nav footer aside form menu dialog button select option input fieldset svg math canvas object audio video applet "
    "datalist legend".split()
)
#: Of these and of raw ones, those that can stand inside a line of text.
IN_LINE_DROPPED = frozenset(
    "button select option input svg math canvas object audio video applet datalist script style textarea noscript iframe template".split()
)
CONTAINERS = {"article": 5, "main": 4, "body": 2, "section": 2, "div": 2, "td": 2, "center": 2, "blockquote": 1, "li": 1, "dd": 1}
#: What class and id names tell; a name of the second kind next to one of the third says nothing.
NOISE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside notice notices cookie cookies consent gdpr banner "
    "alert ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion popup modal overlay "
    "newsletter subscribe subscription share sharing social related recommended recommendations comment comments disqus "
    "respond reply replies form login signup search pagination pager widget toolbar copyright legal skip tags".split()
)
WEAK_NOISE = frozenset(["header", "masthead", "head", "top", "side", "meta"])
READERS = frozenset("comment comments disqus respond reply replies".split())
CONTENT = frozenset("article post entry content main body story text".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
PART = 1000
#: What names say of a part: nothing, a hint, or for sure.
_NONE, _HINT, _SURE = range(3)


class Element:
    __slots__ = ("tag", "names", "parent", "noise", "hint", "within", "score", "first", "last", "linked")

    def __init__(self, tag: str, names: tuple, parent: Element | None, noise: bool, first: int):
        self.tag, self.names, self.parent, self.noise = tag, names, parent, noise
        self.first, self.last, self.score, self.linked = first, -1, 0.0, False
        self.hint: int | None = None  # the part above by whose name alone this is no main text
        self.within = tag in ("article", "main") or (parent is not None and parent.within)

    def path(self) -> str:
        steps, at = [], self
        while at is not None and at.tag:
            if at.tag not in INLINE:
                steps.append(".".join((at.tag, *at.names)))
            at = at.parent
        return "/".join(reversed(steps))


def _names(attributes: str) -> tuple[tuple, int]:
    """Generalised class names, and whether class, id or role say that this is no main text."""
    if not attributes or len(attributes) < 4:
        return (), _NONE
    classes, parts, noise = (), set(), False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            noise = True
        elif name == "role":
            noise |= value.strip().lower() in NOISE_ROLES
        elif name in ("class", "id"):
            parts.update(x.lower() for x in _TOKENS.findall(value))
            if name == "class":
                classes = tuple(sorted({re.sub(r"\d+", "", x) for x in value.split()} - {""}))
    if noise or parts & READERS:
        return classes, _SURE
    return classes, _HINT if parts & NOISE or (parts & WEAK_NOISE and not parts & CONTENT) else _NONE


class Page:
    """Blocks of text, each with the element that holds it, and the block elements of a page.

    ``hinted`` has the running text of the parts that a name alone keeps out; those in ``kept`` are not.
    """

    def __init__(self, html: str, kept: frozenset[int] = frozenset()):
        self.kept, self.hinted, self.with_article = kept, Counter(), set()
        self.running, self.in_article, opened = 0, 0, 0
        self.blocks: list[tuple[str, bool]] = []
        self.elements: list[Element] = []
        self.root = Element("", (), None, False, 0)
        self.pieces: list[str] = []
        self.letters, self.linked = 0, 0
        stack, at, n = [self.root], 0, len(html)
        open_tags: Counter = Counter()
        while at < n:
            m = _TOKEN.search(html, at)
            end = m.start() if m else n
            if end > at:
                self.text(html[at:end], stack[-1])
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag in INLINE:
                    if open_tags[tag] and stack[-1].tag == tag:
                        stack.pop()
                        open_tags[tag] -= 1
                elif open_tags[tag]:
                    if tag not in IN_LINE_DROPPED:
                        self.flush(stack[-1])
                    while True:
                        gone = stack.pop()
                        open_tags[gone.tag] -= 1
                        gone.last = len(self.blocks)
                        if gone.tag == tag:
                            break
                elif tag == "p":
                    self.flush(stack[-1])
                continue
            if tag == "br":
                self.pieces.append(" ")
                continue
            block = tag not in INLINE and tag not in IN_LINE_DROPPED
            if block and not (tag in VOID and tag != "hr"):
                self.flush(stack[-1])
                closes = {"li": "li", "dd": "dd", "dt": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}.get(tag, "p")
                if open_tags[closes]:
                    for back in range(len(stack) - 1, 0, -1):
                        if stack[back].tag == closes:
                            for gone in stack[back:]:
                                open_tags[gone.tag] -= 1
                                gone.last = len(self.blocks)
                            del stack[back:]
                            break
                        if stack[back].tag in ("ul", "ol", "dl", "table", "article", "section", "div", "td"):
                            break
            if tag in VOID:
                continue
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else n
                continue
            names, said = _names(m[3])
            above = stack[-1]
            opened += 1
            if tag in ("html", "body", "main"):
                said = _NONE
            sure = said == _SURE or (above.noise and above.hint is None) or tag in DROPPED
            if tag == "header" and not (sure or above.noise or said):
                sure = not open_tags["article"]
            element = Element(tag, names, above, sure or above.noise, len(self.blocks))
            if not sure:
                if above.noise:
                    element.hint = above.hint
                elif said == _HINT and tag != "article" and opened not in kept:
                    element.noise, element.hint = True, opened
                if element.hint is not None and tag in ("article", "main"):
                    self.with_article.add(element.hint)
            element.linked = above.linked or tag == "a"
            stack.append(element)
            open_tags[tag] += 1
            if block:
                self.elements.append(element)
        self.flush(stack[-1])
        for element in stack:
            element.last = len(self.blocks)

    def text(self, piece: str, holder: Element) -> None:
        if not holder.linked and (not holder.noise or holder.hint is not None):
            running = len(piece.strip())
            self.running += running
            if holder.noise:
                self.hinted[holder.hint] += running
            elif holder.within:
                self.in_article += running
        if holder.noise:
            return
        piece = unescape(piece) if "&" in piece else piece
        self.pieces.append(piece)
        self.letters += len(piece)
        if holder.linked:
            self.linked += len(piece)

    def flush(self, holder: Element) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((text, False))
                worth, at, steps = float(self.letters - 2 * self.linked), holder, 0
                while at is not None and steps < 4:
                    if at.tag in CONTAINERS:
                        at.score += worth / (1 << max(0, steps - 1))
                    if at.tag not in INLINE:
                        steps += 1
                    at = at.parent
            self.pieces, self.letters, self.linked = [], 0, 0

    def misjudged(self) -> frozenset[int]:
        """Parts that a name alone keeps out, though they hold so much of a page without another article that they are its text."""
        if self.in_article:
            return frozenset()
        return frozenset(i for i, n in self.hinted.items() if (4 if i in self.with_article else 2) * n > self.running)

    def best(self) -> list[tuple[float, Element]]:
        """The page's containers that have a score, the best one first."""
        found = [(x.score * CONTAINERS[x.tag], -i, x) for i, x in enumerate(self.elements) if x.score > 0 and not x.noise]
        return [(s, x) for s, _, x in sorted(found, key=lambda f: f[:2], reverse=True)]

    def on(self, path: str) -> list[Element]:
        """All containers on a path that have text, in page order; none lies in another."""
        found = [x for x in self.elements if not x.noise and x.last > x.first and path.endswith(".".join((x.tag, *x.names)))]
        return [x for x in found if x.path() == path]

    def text_of(self, elements: list[Element]) -> str:
        return "\n".join(x for element in elements for x, _ in self.blocks[element.first : element.last])


def page_of(html: str) -> Page:
    """A page, read again as long as some part proves to be misjudged; each time one part less can be."""
    page = Page(html)
    while wrong := page.misjudged():
        page = Page(html, page.kept | wrong)
    return page


def votes(html: str | None) -> list[tuple[str, int]]:
    """Generalised paths of a page's containers and their scores in thousandths of the best."""
    found = page_of(html or "").best()
    out: Counter = Counter()
    for score, element in found:
        path = element.path()
        out[path] = max(out[path], round(PART * score / found[0][0]))
    return list(out.items())


def extract(html: str | None, path: str | None) -> str:
    """The main text of a page, from all containers on ``path`` if the page has one, or else on the path of its best one."""
    if not html:
        return ""
    page = page_of(html)
    own = page.on(path) if path is not None else []
    if not own:
        found = page.best()
        own = page.on(found[0][1].path()) if found else [page.root]
    return page.text_of(own)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores: Counter = Counter()
        pages: Counter = Counter()
        for host, html in zip(batch.column(0), batch.column(1), strict=True):
            for path, score in votes(html.as_py()):
                scores[host.as_py(), path] += score
                pages[host.as_py(), path] += 1
        yield pa.RecordBatch.from_pydict(
            {"host": pa.array([k[0] for k in scores], pa.string()), "path": pa.array([k[1] for k in scores], pa.string()),
             "score": pa.array(scores.values(), pa.int64()), "pages": pa.array([pages[k] for k in scores], pa.int64())}
        )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            texts = [extract(html.as_py(), path.as_py()) for html, path in zip(part.column("html"), part.column("path"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                 part.column("path")],
                names=["page_id", "url", "text", "n_chars", "path"],
            )


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: the path with the highest sum of scores on each host."""
    by_host = pages.select(host_of(F.col("url")).alias("host"), "html")
    voted = in_tasks(by_host, _vote, "host string, path string, score long, pages long")
    totals = voted.groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum("pages").alias("pages"))
    return totals.groupBy("host").agg(F.max_by("path", F.struct("score", "pages", "path")).alias("path"))


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars, path)`` of each row of ``pages`` (page_id, url, html)."""
    # A written table has a known size: Spark broadcasts it if it is small and else splits a large host.
    paths = written(winning_paths(pages), "html-paths")
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", host_of(F.col("url")).alias("host"))
    joined = rows.join(paths, "host", "left").select("page_id", "url", "html", "path")
    return in_tasks(joined, _extracted, "page_id long, url string, text string, n_chars long, path string")
