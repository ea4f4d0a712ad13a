"""Main text of web pages by differencing each page with the one nearest by URL.

The pages of a host lie in order of their URL path; a page's partner is the page before or after it,
whichever shares more of its path, as no page further away shares more (the page before, if both
share as much; the one there is, at the ends of a host or of a range). The text lines of both are aligned by longest common subsequence, and lines
that both have are the site's frame: they are deleted.

Two pages can also share lines of their articles (copies, quotes, common paragraphs), which are to
stay. So where a page itself marks an ``article`` or ``main``, the lines that are not shared tell which
of these elements are its own, and their lines stay, shared ones too; an element whose lines are
all shared, such as a teaser on every page, is frame. Where all marked lines are shared, the
page is a copy and all of them stay. Any other page gives its lines that are not shared. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments
are left out by their element, class, id or role in either case. Classes of ``html``, ``body``,
``main`` and ``article`` describe the page and leave nothing out, nor do classes that say what is
there or not (``has-sidebar``). A form that holds an article, or all there is, is not left out.

A line is a block of the page: character references are decoded, white space becomes one space and
``br`` counts as white space. Blocks are joined by an empty line.

Pages are range-partitioned by (host, path, id), so a host with a third of all pages is spread over
many tasks, and rows are streamed in order with one neighbour in memory. Null html gives an empty
text, a null URL is a host of its own. Equal pages give equal texts, but a page without a marked
article that has a copy right beside it loses what both share.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches

# Element names of the HTML standard by their use here, and usual names of frames.
LEFT_OUT = frozenset("head title script style noscript template svg nav footer aside form button select textarea iframe object dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FRAME_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer masthead menu modal nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor "
    "sponsored subscribe toolbar widget".split()
)
DESCRIBING = frozenset("has no not is with without".split())
HEAD = frozenset("title base link meta script style noscript template".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
_PARTS = re.compile(r"[a-z0-9]+")
OTHER, FORM, LEFT = 0, 1, 2  # kept, kept if a page has nothing else, left out


def frames(names: str, inside: bool) -> bool:
    """Does a class or id say that an element is part of the frame? ``inside`` of an article, by its last word only."""
    for name in names.split():
        parts = _PARTS.findall(name)
        if parts and parts[0] not in DESCRIBING and (parts[-1] in FRAME_NAMES or (not inside and parts[0] in FRAME_NAMES)):
            return True
    return False


class Lines(HTMLParser):
    """The blocks of a page in order, each with where it lies (0 elsewhere, 1 in main, 2 in an article, -1 in a form) and
    the number of the marked element: the outermost article it is in, else the main."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int, int]] = []  # element, how it is left out, place, marked element
        self.parts: list[str] = []
        self.place = self.element = self.elements = 0
        self.lines: list[tuple[str, int, int]] = []

    def _state(self) -> tuple[int, int, int]:
        return self.open[-1][1:] if self.open else (OTHER, 0, 0)

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.place, self.element))
        self.parts = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in HEAD and self.open and any(t == "head" for t, *_ in self.open[-4:]):
            # What cannot be in a head ends it, as its end tag may be absent.
            del self.open[next(i for i, (t, *_) in enumerate(self.open) if t == "head") :]
        if tag in BLOCKS:
            self._end_block()
            if self.open and any(t == "p" for t, *_ in self.open[-8:]):
                # A block ends an open paragraph, with whatever was left open in it.
                last = max(i for i, (t, *_) in enumerate(self.open) if t == "p")
                if all(t not in BLOCKS for t, *_ in self.open[last + 1 :]):
                    del self.open[last:]
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        left_out, place, element = self._state()
        values = {k: (v or "").lower() for k, v in attrs}
        names = values.get("class", "") + " " + values.get("id", "")
        if tag in ("html", "body", "main", "article"):
            if left_out == FORM and tag in ("main", "article"):
                left_out = OTHER
        elif (
            (tag in LEFT_OUT and tag != "form") or (tag == "header" and not place) or "hidden" in values
            or values.get("role") in FRAME_ROLES or frames(names, place == 2)
        ):
            left_out = LEFT
        elif tag == "form":
            left_out = LEFT if place else max(left_out, FORM)
        within = max(place, {"article": 2, "main": 1}.get(tag, 0))
        if within > place:
            self.elements += 1
            element = self.elements
        self.open.append((tag, left_out, within, element))

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_block()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        left_out, place, element = self._state()
        if left_out != LEFT:
            if not self.parts:
                self.place, self.element = -1 if left_out == FORM else place, element
            self.parts.append(data)


def lines_of(html: str) -> list[tuple[str, int, int]]:
    """Lines of a page outside of menus, forms and the like."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser._end_block()
    outside = [line for line in parser.lines if line[1] >= 0]
    return outside or [(text, 0, 0) for text, *_ in parser.lines]


def shared(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of both."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    found = set(range(first)) | set(range(len(a) - last, len(a)))
    places: dict[str, list[int]] = {}
    for j in range(len(b) - last - 1, first - 1, -1):
        places.setdefault(b[j], []).append(j)  # from the last to the first
    ends: list[int] = []  # the smallest end in b of a common subsequence of each length
    chains: list[tuple] = []
    for i in range(first, len(a) - last):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            elif j < ends[k]:
                ends[k], chains[k] = j, chain
    chain = chains[-1] if chains else None
    while chain:
        found.add(chain[0])
        chain = chain[1]
    return found


def main_text(lines: list[tuple[str, int, int]], partner: list[tuple[str, int, int]] | None) -> str:
    """The text of a page, given its own lines and its partner's."""
    frame = shared([t for t, *_ in lines], [t for t, *_ in partner]) if partner else set()
    own = [line for i, line in enumerate(lines) if i not in frame]
    if not any(place for _, place, _ in lines):
        return "\n\n".join(t for t, *_ in own)
    kept = {element for _, place, element in own if place}
    return "\n\n".join(t for t, place, element in lines if place and (element in kept or not kept))


def common_path(a: str | None, b: str | None) -> int:
    """How many steps of two paths are the same from the start."""
    n = 0
    for x, y in zip((a or "").split("/"), (b or "").split("/")):
        if x != y:
            break
        n += 1
    return n


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every page: ``key``, ``url``, ``text`` and ``n_chars``. Other columns are not read."""
    bounded_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    address = F.col(f"`{url}`").cast("string")
    pages = df.select(
        F.col(f"`{key}`").alias("key"),
        address.alias("url"),
        F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_replace(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), r"/+$", "").alias("path"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
    )
    ordered = pages.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = now = None  # the page before and the page at hand: key, url, host, path, lines

        def told(after: tuple | None) -> tuple:
            """Result of the page at hand, given the page after it."""
            k, u, host, path, lines = now
            around = [p for p in (before, after) if p and p[2] == host]
            partner = max(around, key=lambda p: common_path(path, p[3]), default=None)  # the first of equals
            return k, u, main_text(lines, partner and partner[4])

        def result(rows: list, kinds: tuple) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kinds[0]), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()), pa.array([len(t) for t in columns[2]], pa.int64())],
                ["key", "url", "text", "n_chars"],
            )

        kinds = None
        for batch in batches:
            kinds = (batch.schema.field("key").type,)
            rows = []
            for *place, page in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "host", "path", "html"))):
                after = (*place, lines_of(page))
                if now:
                    rows.append(told(after))
                before, now = now, after
            yield result(rows, kinds)
        if now:
            yield result([told(None)], kinds)

    found = ordered.select("key", "url", "host", "path", "html").mapInArrow(texts, f"key {kind}, url string, text string, n_chars long")
    return found.select(F.col("key").alias(key), "url", "text", "n_chars")
