"""Main text of web pages, without what the pages of a site repeat."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import rows_of, stored

#: A subtree belongs to a site's template if so many pages of the host have it,
#: and so large a share of them. The share bounds the templates of a host: a
#: page's elements divided by it.
TEMPLATE_PAGES, TEMPLATE_SHARE = 5, 0.01

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "dt", "dd", "li"} | {"li", "dd", "dt"}
#: What a new element of a name ends, and the elements it does not reach beyond.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: Never main text.
DROPPED = frozenset(
    "aside button canvas datalist dialog embed fieldset footer form head input label map menu meter nav object "
    "optgroup option output progress search select svg video audio".split()
) | RAW
#: Words in class, id or role that say the same.
NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies "
    "disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice overlay pager pagination "
    "paywall popup promo promoted promotion related replies reply search share sharing sidebar sidenav signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget widgets alert complementary contentinfo".split()
)
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)


class Element:
    """An element's name, what its attributes call it, and its subtree's hash."""

    __slots__ = ("name", "called", "hidden", "parts", "hash", "size", "holds")

    def __init__(self, name: str, attributes: str) -> None:
        self.name = name
        text = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)) if attributes else ""
        self.called = text.lower()
        self.hidden = bool(attributes) and HIDDEN.search(attributes) is not None
        self.parts: list[bytes] = []
        self.hash = 0
        self.size = 0
        self.holds = False

    def boilerplate(self, inside_article: bool) -> bool:
        if self.name in DROPPED or self.hidden:
            return True
        if self.name == "header":
            return not inside_article
        if not self.called or self.name in ("html", "body", "article", "main") and not inside_article:
            return False
        return not NAMES.isdisjoint(re.split(r"[^a-z0-9]+", self.called))


def parse(page: str) -> list[Element | str | None]:
    """A page as openings (the element), texts and closings (None), with hashes.

    Elements end as in browsers: a paragraph at the next block, an item at the
    next item, anything open where an element around it ends. No recursion, so
    depth is no limit.
    """
    events: list[Element | str | None] = []
    open_: list[Element] = []
    count: dict[str, int] = {}

    def close() -> None:
        element = open_.pop()
        count[element.name] -= 1
        element.hash = xxhash.xxh3_64_intdigest(b"\x00".join(element.parts), seed=len(element.parts))
        events.append(None)
        if open_:
            open_[-1].parts.append(b"<%s %s %d" % (element.name.encode("utf-8", "replace"), element.called.encode("utf-8", "replace"), element.hash))
            open_[-1].size += element.size
            if element.holds or element.name in ("article", "main") and not element.boilerplate(True):
                open_[-1].holds = True

    def close_to(at: int) -> None:
        while len(open_) > at:
            close()

    def say(text: str) -> None:
        if text:
            text = html.unescape(text)
            events.append(text)
            if open_ and (bare := " ".join(text.split())):
                open_[-1].parts.append(bare.encode("utf-8", "surrogatepass"))
                open_[-1].size += len(bare)

    def last(names: set[str], stops: set[str]) -> int:
        """The outermost of ``names`` that is open inside the innermost of ``stops``."""
        found = -1
        for at in range(len(open_) - 1, -1, -1):
            if open_[at].name in stops:
                break
            if open_[at].name in names:
                found = at
        return found

    place = 0
    while place < len(page):
        tag = TAG.search(page, place)
        if tag is None:
            say(page[place:])
            break
        say(page[place : tag.start()])
        place = max(tag.end(), tag.start() + 1)
        ending, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name or not tag[0].endswith(">"):
            # Comments, declarations, and a tag that the page's end cuts off.
            continue
        name = name.lower()
        if ending:
            if count.get(name):
                close_to(next(at for at in range(len(open_) - 1, -1, -1) if open_[at].name == name))
            continue
        if name in CLOSES_P and count.get("p"):
            at = last({"p"}, {"table", "button", "object"})
            if at >= 0:
                close_to(at)
        if name in CLOSES:
            names, stops = CLOSES[name]
            if any(count.get(n) for n in names):
                at = last(names, stops)
                if at >= 0:
                    close_to(at)
        element = Element(name, attributes)
        open_.append(element)
        count[name] = count.get(name, 0) + 1
        events.append(element)
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(page, place)
            place = end.start() if end else len(page)
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            close()
    close_to(0)
    return events


def subtrees(events: list) -> set[int]:
    """Hashes of a page's elements that have text, without the page's own frame."""
    return {e.hash for e in events if isinstance(e, Element) and e.size and e.name not in ("html", "body", "head")}


def main_text(events: list, templates: frozenset[int]) -> str:
    """Text of the article, or of the body where no article is marked.

    Template subtrees go, but for what holds half of the text or more: that is
    the article itself on pages that are copies of each other. Inside a marked
    article only boxes and lists can be template; its paragraphs, headings and
    what stands in them are its own even if other pages have them.
    """
    marked = any(isinstance(e, Element) and e.name in ("article", "main") and e.size and not e.boilerplate(True) for e in events)
    root = max((e.size for e in events if isinstance(e, Element) and (e.name in ("article", "main") if marked else True)), default=0)
    boxes = ("div", "section", "ul", "ol", "dl", "table", "figure", "details", "center")
    blocks: list[str] = []
    inline: list[str] = []
    kept: list[bool] = []
    articles = 0

    def end_block() -> None:
        if inline:
            text = " ".join("".join(inline).split())
            inline.clear()
            if text:
                blocks.append(text)

    names: list[str] = []
    for e in events:
        if e is None:
            name = names.pop()
            if kept.pop() and name in BLOCK:
                end_block()
            articles -= name in ("article", "main")
        elif isinstance(e, str):
            if (not kept or kept[-1]) and (articles or not marked):
                inline.append(e)
        else:
            keep = not kept or kept[-1]
            if keep:
                # What is around the article, or most of a page without one, is its frame.
                frame = e.name not in RAW and (e.holds or not marked and e.name not in ("nav", "header", "footer", "aside") and 2 * e.size >= root)
                keep = frame or not e.boilerplate(articles > 0)
                if keep and e.hash in templates and 2 * e.size < root:
                    keep = marked and articles > 0 and e.name not in boxes
                if e.name in BLOCK:
                    end_block()
            kept.append(keep)
            names.append(e.name)
            articles += e.name in ("article", "main")
    end_block()
    return " ".join(blocks)


def page_subtrees(pages: DataFrame) -> DataFrame:
    """``host, hash``: one row for each element of each page."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "html", 1 << 22):
            hosts, found = [], []
            for host, page in rows:
                own = subtrees(parse(page))
                hosts += [host] * len(own)
                found += [h - (1 << 63) for h in own]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.int64())], names=["host", "hash"])

    return pages.select("host", "html").mapInArrow(hashes, "host string, hash long")


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    First all element subtrees of all pages are hashed and counted by host,
    once a page, combined in each task; those in `TEMPLATE_PAGES` pages and
    `TEMPLATE_SHARE` of the host's pages or more are its template. Then each
    page is read again with its host's templates and gives its main text:
    without template subtrees, menus, headers, footers, sidebars, notices,
    adverts, forms, comments, scripts and styles. White space inside a block
    is one space, and blocks are joined by one in page order.

    A null url belongs to a host of its own name; a null or empty page, or one
    that is boilerplate alone, has an empty text. Rows with equal ids each get
    a row; an empty table gives none.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    pages = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    sizes = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counted = page_subtrees(pages).groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= TEMPLATE_PAGES)
    templates = (
        counted.join(sizes, "host").where(F.col("n") >= TEMPLATE_SHARE * F.col("pages"))
        .groupBy("host").agg(F.collect_list("hash").alias("templates"))
    )
    templates = stored(templates, "templates")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[list | None, frozenset[int]] = (None, frozenset())
        for rows in rows_of(batches, "html", 1 << 22):
            texts = []
            for _, _, own, page in rows:
                if own != known[0]:
                    known = (own, frozenset(h + (1 << 63) for h in own or ()))
                texts.append(main_text(parse(page), known[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    known = pages.join(templates, "host", "left").select(F.col("page_id").cast("long").alias("page_id"), "url", "templates", "html")
    return known.mapInArrow(extract, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
