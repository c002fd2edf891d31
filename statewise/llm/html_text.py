"""Main text of web pages.

Each page streams through the standard library's HTML parser, which yields one
line per block with its characters and tags. The lines' text-to-tag ratios are
smoothed with a Gaussian, and the lines above a threshold form the clusters of
content. The clusters choose the region: the smallest element that holds all of
them or, where ``article`` and ``main`` elements hold most of their text, those
elements. All of that region's blocks are the article, its short paragraphs
too, but for the parts that page furniture marks as its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import map_batches

SIGMA = 1.0  # of the Gaussian, in lines
RADIUS = 3
MOST_OF = 0.5  # share of the clusters' text from which article and main elements are the region

# Element names of HTML, and words that mark page furniture.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset(
    "aside button canvas datalist dialog footer form head iframe menu nav noframes noscript object "
    "script search select style svg template textarea title".split()
)
REGIONS = frozenset("article blockquote body div main section table tbody td tr".split())
CLOSED_BY = {
    "p": frozenset(), "li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}),
    "td": frozenset({"table"}), "th": frozenset({"table"}), "tr": frozenset({"table"}), "option": frozenset({"select"}),
}
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment "
    "commentlist comments consent cookie cookies copyright disclaimer disqus footer gdpr masthead menu menubar "
    "modal nav navbar navigation newsletter notice notices notification outbrain pagination pager "
    "popup promo promos promotion recommended related replies reply respond responses share sharing sidebar "
    "signup skip skyscraper social sponsor sponsored subscribe subscription taboola toolbar topbar "
    "widget".split()
)
COMMENTS = frozenset("comment commentlist comments disqus replies reply respond responses".split())
# Words that stand beside a mark in a name without making it the name of something else.
BESIDE = frozenset(
    "above amp area article articles author bar before after below block body bottom box btn button buttons card "
    "center col column container cont desktop dfp entry float fixed footer form global google gpt group head header "
    "holder horizontal icon icons id image inline inner item items js label large leaderboard left link links "
    "list log main media medium message middle mobile module mpu outer page panel placeholder policy popular "
    "post posts primary rectangle region right row save secondary section single site slot small sticky "
    "stories story template text thread title tools top unit vertical wide wp wrap wrapper".split()
)
OF_ARTICLE = frozenset("article articles author body card entry post posts section story stories text title".split())
# Marks of what is never the article, however long it is.
APART = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising adsense consent cookie cookies copyright gdpr newsletter "
    "outbrain promo promos recommended related sponsor sponsored taboola".split()
)
WRAPPERS = frozenset("aside footer form menu nav search".split())  # furniture that may stand around a page
ARTICLE = frozenset({"article", "main"})

_HEADER = frozenset({"header"})
_HEADING = re.compile("h[1-6]")
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNENDED = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")  # a tag that the page's end cuts off
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


_Piece = tuple[str, tuple[int, ...], int]  # text, the furniture around it, characters inside links


def _joined(pieces: list[_Piece]) -> str:
    return _SPACE.sub(" ", "".join(piece[0] for piece in pieces)).strip()


@dataclass
class Block:
    text: str
    tags: int
    linked: int  # characters inside links
    path: tuple[int, ...]  # the open regions, outermost first
    furniture: bool
    heading: bool
    pieces: list[_Piece]

    def leave_out(self, freed: set[int]) -> None:
        """Without the pieces in furniture that is not ``freed``."""
        kept = [piece for piece in self.pieces if freed.issuperset(piece[1])]
        if len(kept) == len(self.pieces):
            return
        text = _joined(kept)
        if text:
            self.text, self.linked = text, sum(piece[2] for piece in kept)
        else:
            self.furniture = True


@dataclass
class _Open:
    name: str
    number: int
    furniture: bool
    hard: bool
    soft: tuple[int, ...]  # the furniture around it that may turn out to hold the article
    cut: bool  # in an inline part that is taken out of its line


@dataclass
class _Line:
    pieces: list[_Piece] = field(default_factory=list)
    tags: int = 0


def _named(names: str | None, marks: frozenset[str], beside: frozenset[str] = BESIDE) -> set[str]:
    """The marks in class names or ids that say nothing but a mark and where it stands:
    ``post-comments``, not ``comments-open``, ``has-sidebar`` or ``related-work``."""
    found: set[str] = set()
    for name in (names or "").split():
        words = {word.lower() for word in _TOKEN.findall(name) if len(word) > 1}
        if words <= marks | beside:
            found |= words & marks
    return found


HARD, APART_KIND, WRAPPER, LOOSE = "hard", "apart", "wrapper", "loose"


def _furniture(name: str, attrs: dict[str, str | None], in_article: bool) -> str | None:
    """Kind of furniture that an element is, None for others.

    ``HARD`` is never read, of the others see ``_freed``.
    """
    if name in ("html", "body"):
        return None
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return HARD
    if _HIDDEN.search(attrs.get("style") or ""):
        return HARD
    classes, ids = attrs.get("class"), attrs.get("id")
    if name in ARTICLE:
        return APART_KIND if _named(classes, COMMENTS) or _named(ids, COMMENTS) else None
    if name in FURNITURE and name not in WRAPPERS:
        return HARD
    marks: set[str] = set()
    if (classes or ids) and not _HEADING.fullmatch(name):
        # ids in an article are often made of the words of a heading
        marks = _named(classes, MARKS) | _named(ids, MARKS, frozenset() if in_article else BESIDE)
    if marks & APART:
        return APART_KIND
    role = (attrs.get("role") or "").lower()
    if name in WRAPPERS - {"form"} or role in ROLES - {"form"}:
        return WRAPPER
    if name == "header" and not in_article:
        return WRAPPER
    if name == "form" or role == "form" or marks:
        return LOOSE
    if not in_article and (classes or ids) and not _HEADING.fullmatch(name):
        beside = BESIDE - OF_ARTICLE
        if _named(classes, _HEADER, beside) or _named(ids, _HEADER, beside):
            return LOOSE
    return None


class PageParser(HTMLParser):
    """Collects ``blocks`` in page order; open elements are a stack."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.names: dict[int, str] = {}
        self.kinds: dict[int, str] = {}  # of furniture that may turn out to hold the article
        self.around: dict[int, set[int]] = {}  # article elements around it
        self._open: list[_Open] = []
        self._count = 0
        self._links = 0
        self._line = _Line()

    def handle_starttag(self, name, attrs):
        if name in BLOCKS or name in ("a", "button"):
            self._close_inline(name)
        cut = self._cut()
        if not cut:
            if name in BLOCKS:
                self._end_line(name)
                self._close_implied(name)
            elif name == "br":
                self._add(" ")
            if name == "a":
                self._links += 1
            self._line.tags += 1
        if name in VOID:
            return
        given = dict(attrs)
        inside = bool(self._open) and self._open[-1].furniture
        in_article = any(item.name in ARTICLE for item in self._open)
        kind = _furniture(name, given, in_article)
        top = self._open[-1] if inside else None
        if inside and name in ARTICLE and kind is None and self._wraps_page():
            top = None  # a form or an unclosed menu around the whole page
        # elements of an open inline part's name are told apart from its own end
        if name in BLOCKS or kind or any(item.name == name for item in self._open):
            self._count += 1
            number = self._count
            self.names[number] = name
            soft = top.soft if top else ()
            if kind and kind != HARD:
                self.kinds[number] = kind
                self.around[number] = {item.number for item in self._open if item.name in ARTICLE}
                soft += (number,)
            hard = kind == HARD or bool(top and top.hard)
            self._open.append(
                _Open(name, number, hard or bool(soft), hard, soft, cut or (kind == HARD and name not in BLOCKS))
            )

    def handle_startendtag(self, name, attrs):
        if name in VOID:
            self.handle_starttag(name, attrs)
        else:
            self.handle_starttag(name, attrs)
            self.handle_endtag(name)

    def handle_endtag(self, name):
        cut = self._cut()
        if not cut:
            if name == "a":
                self._links = max(0, self._links - 1)
            self._line.tags += 1
        if name == "p" and not any(item.name == "p" for item in self._open):
            if not cut:
                self._end_line(name)
            return
        for at in range(len(self._open) - 1, -1, -1):
            if self._open[at].name == name:
                self._close_from(at)
                return
            if self._open[at].name in ("td", "th", "table") and name not in ("table", "tr", "body", "html"):
                return  # a stray end tag does not leave its cell

    def handle_data(self, data):
        if self._cut():
            return
        self._add(data)

    def close(self):
        super().close()
        self._end_line("")

    def _add(self, text: str) -> None:
        soft = self._open[-1].soft if self._open else ()
        self._line.pieces.append((text, soft, len(text.strip()) if self._links else 0))

    def _cut(self) -> bool:
        """Inside an element that is taken out of its line."""
        return bool(self._open) and self._open[-1].cut

    def _close_from(self, at: int) -> None:
        """Close the open elements from ``at`` on; an inline part ends no line."""
        if not self._open[at].cut:
            if self._cut():  # the line goes by the block around the part
                del self._open[next(i for i, item in enumerate(self._open) if item.cut) :]
            if any(item.name in BLOCKS for item in self._open[at:]):
                self._end_line(self._open[at].name)
        del self._open[at:]

    def _close_inline(self, name: str) -> None:
        """End tags that a page leaves out inside an inline part: a block ends the
        paragraph around a marked span, a link or button the one before."""
        if not self._open or self._open[-1].name in BLOCKS and not self._cut():
            return
        for at in range(len(self._open) - 1, -1, -1):
            found = self._open[at].name
            if found in ALIKE.get(name, (name,)) and (name in ("a", "button") or name in CLOSED_BY):
                self._close_from(at)
                return
            if found == "p" and name in BLOCKS:
                self._close_from(at)
                return
            if found in BLOCKS or found in FURNITURE:
                return

    def _wraps_page(self) -> bool:
        outer = [item.name for item in self._open if item.furniture]
        return all(name in ("form", "nav", "header", "menu") for name in outer) and not any(
            item.name in ARTICLE for item in self._open
        )

    def _close_implied(self, name: str) -> None:
        """End tags that HTML lets a page leave out."""
        if self._open and self._open[-1].name == "p":
            self._open.pop()
        if name in CLOSED_BY and name != "p":
            for at in range(len(self._open) - 1, -1, -1):
                if self._open[at].name in CLOSED_BY[name]:
                    break
                if self._open[at].name in ALIKE.get(name, (name,)):
                    del self._open[at:]
                    break
        if name == "body":
            self._open = [item for item in self._open if item.name != "head"]

    def _end_line(self, name: str) -> None:
        line, self._line = self._line, _Line()
        text = _joined(line.pieces)
        if text:
            top = next((item for item in reversed(self._open) if item.name in BLOCKS), None)
            linked = sum(piece[2] for piece in line.pieces)
            pieces = line.pieces
            if all(piece[1] == pieces[0][1] for piece in pieces):
                pieces = [(text, pieces[0][1], linked)]
            self.blocks.append(
                Block(
                    text=text,
                    tags=line.tags,
                    linked=linked,
                    path=tuple(item.number for item in self._open if item.name in REGIONS),
                    furniture=bool(top and top.hard),
                    heading=bool(top and _HEADING.fullmatch(top.name)),
                    pieces=pieces,
                )
            )
        if name in BLOCKS and name != "p":
            self._links = 0


def clusters(blocks: list[Block]) -> np.ndarray:
    """Mask of the lines whose smoothed text-to-tag ratio is above the threshold.

    The threshold is the standard deviation of the smoothed ratios, or half
    their largest where that is less (as on a page of equal lines).
    """
    ratio = np.array(
        [0.0 if b.furniture else max(0, len(b.text) - b.linked) / max(1, b.tags) for b in blocks]
    )
    steps = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(steps**2) / (2 * SIGMA**2))
    smooth = np.convolve(ratio, kernel / kernel.sum())[RADIUS : RADIUS + len(ratio)]
    threshold = min(smooth.std(), smooth.max() / 2)
    return (smooth >= threshold) & (ratio > 0)


def _freed(parser: PageParser) -> set[int]:
    """Marked elements that are no furniture, as the page has its article in them.

    Such an element holds more cluster text than there is outside furniture, and
    no ``article`` or ``main`` beside it has any. A form or a name of a class or
    id can stand around any article; menus, asides and the like are believed to
    hold one only where an ``article`` or ``main`` in them says so, and comments,
    adverts and the like only where there is no other text besides.
    """
    pieces = [
        (len(piece[0].strip()), piece[1], [n for n in block.path if parser.names[n] in ARTICLE])
        for block, inside in zip(parser.blocks, clusters(parser.blocks))
        if inside
        for piece in block.pieces
    ]
    holds: dict[int, int] = {}
    with_article: set[int] = set()
    for size, soft, articles in pieces:
        for n in soft:
            holds[n] = holds.get(n, 0) + size
            if any(a > n for a in articles) and not any(m > n and parser.kinds[m] == APART_KIND for m in soft):
                with_article.add(n)
    freed: set[int] = set()
    outside, beside = None, set()
    for number in sorted(holds):  # outer elements first
        if outside is None:
            free = [piece for piece in pieces if freed.issuperset(piece[1])]
            outside = sum(size for size, _, _ in free)
            beside = {a for _, _, articles in free for a in articles}
        kind = parser.kinds[number]
        if holds[number] <= outside or beside - parser.around[number] - {number}:
            continue
        if kind == LOOSE or number in with_article and (kind == WRAPPER or not outside):
            freed.add(number)
            outside = None
    return freed


def main_text(html: str) -> str:
    """The article's blocks, one per line; '' where a page has none."""
    parser = PageParser()
    parser.feed(_UNENDED.sub("", html))
    parser.close()
    blocks = parser.blocks
    if parser.kinds and not all(block.furniture for block in blocks):
        freed = _freed(parser)
        for block in blocks:
            block.leave_out(freed)
    if all(block.furniture for block in blocks):
        return ""
    chosen = [block for block, inside in zip(blocks, clusters(blocks)) if inside]
    total = sum(len(block.text) for block in chosen)
    marked = [block for block in chosen if any(parser.names[n] in ARTICLE for n in block.path)]
    if marked and sum(len(block.text) for block in marked) >= MOST_OF * total:
        chosen = marked  # the page says itself where its article is
    region = _common([block for block in chosen if not block.heading] or chosen)
    path = next((b.path for b in blocks if region in b.path), ())
    outer = [n for n in path[: path.index(region) + 1] if parser.names[n] in ARTICLE] if path else []
    if outer:
        region = outer[0] if parser.names[outer[0]] == "article" else outer[-1]
    regions = {region}
    if marked and chosen is marked and not outer:  # articles side by side
        regions = {next(n for n in block.path if parser.names[n] in ARTICLE) for block in marked}
    kept = []
    for at, block in enumerate(blocks):
        if block.furniture:
            continue
        if (
            regions == {0}
            or not regions.isdisjoint(block.path)
            or (block.heading and not outer and _leads(blocks, at, regions))
        ):
            kept.append(block.text)
    return "\n".join(kept)


def _common(blocks: list[Block]) -> int:
    """The smallest region that holds all of the blocks; 0 where none does."""
    region = 0
    for level in zip(*(block.path for block in blocks)):
        if len(set(level)) > 1:
            break
        region = level[0]
    return region


def _leads(blocks: list[Block], at: int, regions: set[int]) -> bool:
    """A heading that stands right before a region."""
    after = next((b for b in blocks[at + 1 :] if not b.furniture and not b.heading), None)
    return after is not None and not regions.isdisjoint(after.path)


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row ``page_id, url, text, n_chars`` (code points).

    NULL or empty html, and pages that are all furniture, give ''. Every row
    gives a row; other columns are not read. Text outside every element counts
    as body text.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py() or "") for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return map_batches(rows, extract, "page_id long, url string, text string, n_chars long")
