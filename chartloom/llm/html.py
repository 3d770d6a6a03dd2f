"""Main text of web pages by consensus of each host's pages.

Every page scores its containers by the running text they hold. A container goes by its
generalised path: tags and classes from the root down, digits and ids left out. Pages vote
for their best path, votes are counted per host in Spark, and each page is extracted again
from the container its host agrees on, if that holds enough of the page's own text.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.tokens import slices
from chartloom.session import materialize, ship_package

# A host's path is right for a page if it holds this share of the running text of the page's own best.
ABOUT = 0.8
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_RAW = {"script", "style", "noscript", "textarea", "title", "template", "svg", "iframe", "select", "xmp", "noembed", "math"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements that stand in lines of text; all others begin and end a block.
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var output picture object audio video canvas map".split()
)
_TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption td th caption address center summary".split())
_CLOSES = {  # a start tag that ends these, if they are open nearer than the tags behind the bar
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_SCOPE = {"table", "td", "th", "object", "button", "body"}
_SKIP_TAGS = set("head nav footer aside button dialog menu".split())
_SKIP_ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar toolbar".split())
# Forms and what has one of these names go too, unless they hold nearly all running text.
_SOFT_TAGS = {"form", "fieldset"}
_SKIP_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar"
    " sidenav aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer foot masthead topbar"
    " share sharing social related recommended recommendations comment comments commentlist respond reply replies"
    " disqus discussion pager pagination toolbar skip copyright legal disclaimer tags toc".split()
)
# Words that say nothing beside such a name: "post-comments-list" is a name for comments,
# "no-sidebar", "comments-open" or "legal-analysis" are names for something else.
_NEUTRAL = set(
    "area article bar block blog body bottom box btn button buttons container content entry field fixed form global"
    " group header heading holder icon icons inner item items js left link links list main message mobile module"
    " news outer page panel placeholder popular post posts primary reader region right row secondary section site"
    " slot sticky text thread title top unit user view wrap wrapper zone".split()
)
# Names that mean the same whatever stands beside them.
_PLAIN_NAMES = set(
    "advert adverts advertisement advertising breadcrumb breadcrumbs commentlist consent disqus gdpr masthead navbar"
    " sidenav topbar".split()
)
_COMMENTS = set("comment comments commentlist respond reply replies disqus discussion".split())
# An element is not skipped for its name if it holds so many times the running text that is left
# otherwise, and more of it than a notice has; or if nothing else is left.
NEARLY_ALL = 3
NOTICE = 200
_NAME = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


def _layout_words(name: str) -> set[str]:
    """What of the layout a class or id names; nothing if it names something else as well."""
    out: set[str] = set()
    for words in ([w.lower() for w in _NAME.split(name)], _NAME.split(name.lower())):
        words = {w.strip("0123456789") for w in words} - {""}
        if words & _PLAIN_NAMES or words <= _SKIP_NAMES | _NEUTRAL:
            out |= words & _SKIP_NAMES
    return out


class _Page:
    """Elements and text blocks of one page, in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.skip = [-1], ["#"], [""], [False]
        self.soft: dict[int, bool] = {}  # elements to skip for a name or as a form; whether it names comments
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._read(source)
        self._settle()

    def _settle(self) -> None:
        """Decide which elements are skipped for what they are called."""
        # A name speaks of the layout, not of the content, where the article stands inside.
        for i, tag in enumerate(self.tag):
            if tag == "main" or tag == "article" and not self.skip[i] and i not in self.soft:
                up = self.parent[i]
                while up > 0:
                    self.soft.pop(up, None)
                    up = self.parent[up]
        if not self.soft:
            return
        # Running text in no skipped element, and in each element with a name, comments apart.
        left, inside = 0, dict.fromkeys(self.soft, 0)
        for element, block, links in self.blocks:
            named, comments, up = [], False, element
            while up > 0 and not self.skip[up]:
                if up in self.soft:
                    named.append(up)
                    comments = comments or self.soft[up]
                up = self.parent[up]
            weight = max(0, len(block) - 2 * links)
            if up <= 0 and not named:
                left += weight
            elif up <= 0 and not comments:
                for e in named:
                    inside[e] += weight
        for e in self.soft:
            self.skip[e] = self.skip[e] or inside[e] <= (max(NOTICE, NEARLY_ALL * left) if left else 0)

    def _element(self, parent: int, tag: str, attributes: str) -> int:
        names, skip = [], tag in _SKIP_TAGS
        soft, comments = tag in _SOFT_TAGS, False
        if attributes and not attributes.isspace():
            found = {}
            for key, *values in _ATTRIBUTE.findall(attributes):
                found.setdefault(key.lower(), next((v for v in values if v), ""))
            names = references.unescape(found.get("class", "")).split()
            words = set().union(*map(_layout_words, [*names, found.get("id", "")]))
            if tag not in ("html", "body", "main"):
                soft, comments = soft or bool(words), bool(words & _COMMENTS)
            role = found.get("role", "").lower()
            soft = soft or role == "form"
            style = found.get("style", "").replace(" ", "").lower()
            skip = (
                skip
                or role in _SKIP_ROLES
                or "hidden" in found
                or found.get("aria-hidden") == "true"
                or "display:none" in style
            )
        if tag == "header":  # of the page, not of an article
            up = parent
            while up > 0 and self.tag[up] not in ("article", "main"):
                up = self.parent[up]
            skip = skip or up <= 0
        general = sorted({_DIGITS.sub("", n) for n in names} - {""})
        self.parent.append(parent)
        self.tag.append(tag)
        self.path.append("/".join((self.path[parent], ".".join([tag, *general]))))
        self.skip.append(skip)
        if soft:
            self.soft[len(self.tag) - 1] = comments
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        open_, text, links = [0], [], 0
        inline: list[str] = []

        def flush() -> None:
            nonlocal links
            if text:
                block = " ".join(references.unescape("".join(text)).split())
                if block:
                    self.blocks.append((open_[-1], block, links))
                text.clear()
            links = 0

        def close(tags: set[str], stop: set[str]) -> None:
            for i in range(len(open_) - 1, 0, -1):
                name = self.tag[open_[i]]
                if name in tags:
                    flush()
                    del open_[i:]
                    inline.clear()
                    return
                if name in stop:
                    return

        at = 0
        while True:
            found = _TAG.search(source, at)
            piece = source[at : found.start()] if found else source[at:]
            if piece:
                text.append(piece)
                if "a" in inline:
                    links += len(piece)
            if not found:
                break
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if tag == "br":
                text.append(" ")
            elif tag in _VOID:
                if tag == "hr":
                    flush()
            elif tag in _RAW:
                if not found[1] and not found[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                    at = end.end() if end else len(source)
            elif tag in _INLINE:
                if found[1]:
                    if tag in inline:
                        del inline[len(inline) - 1 - inline[::-1].index(tag) :]
                elif not found[3].endswith("/"):
                    if tag == "a" and "a" in inline:
                        inline.remove("a")
                    inline.append(tag)
            elif found[1]:
                flush()
                close({tag}, _SCOPE - {tag})
            else:
                flush()
                close({"p"}, _SCOPE)
                if tag in _CLOSES:
                    close(*_CLOSES[tag])
                if tag != "html" or len(open_) == 1:
                    open_.append(self._element(open_[-1], tag, found[3]))
        flush()

    def container(self, element: int) -> int:
        """The nearest element around a block that is not itself a paragraph or the like."""
        while element > 0 and self.tag[element] in _TEXT_BLOCKS | {"ul", "ol", "dl", "tr", "tbody", "thead", "table"}:
            element = self.parent[element]
        return element

    def clear(self, element: int, top: int) -> bool:
        """Whether nothing from ``element`` up to below ``top`` is to be skipped."""
        while element != top and element >= 0:
            if self.skip[element]:
                return False
            element = self.parent[element]
        return True

    def best(self) -> str | None:
        """Path of the container with most running text; the article around it if there is one.

        Without an article it is lifted to what is around it, up to <main> or below the
        body, as long as what that adds is mostly unlinked text.
        """
        score: dict[int, float] = {}
        for element, block, links in self.blocks:
            if not self.clear(element, -1):
                continue
            weight = max(0, len(block) - 2 * links)
            inner = self.container(element)
            for share in (1.0, 0.5, 0.25):
                score[inner] = score.get(inner, 0.0) + share * weight
                if inner <= 0:
                    break
                inner = self.container(self.parent[inner])
        if not score or max(score.values()) <= 0:
            return None
        top = max(score, key=lambda e: (score[e], e))
        up = top
        article = False
        while up > 0:
            if self.tag[up] == "article":
                top, article = up, True
            up = self.parent[up]
        return self.path[top if article else self._lifted(top)]

    def _lifted(self, top: int) -> int:
        up, inside = top, self._within(top)
        while self.tag[up] != "main" and (up := self.parent[up]) > 0 and self.tag[up] not in ("body", "html"):
            around = self._within(up)
            added = [self.blocks[i] for i in sorted(around - inside)]
            if 2 * sum(links for *_, links in added) > sum(len(block) for _, block, _ in added):
                break
            if added:
                top, inside = up, around
        return top

    def _within(self, top: int) -> set[int]:
        """Numbers of the blocks in an element, without those to be skipped there."""
        return {i for i, (element, *_) in enumerate(self.blocks) if self._inside(element, top)}

    def _inside(self, element: int, top: int) -> bool:
        while element > top:
            if self.skip[element]:
                return False
            element = self.parent[element]
        return element == top

    def running(self, path: str) -> int:
        """Characters outside links that ``text`` has for a path."""
        own = {e for e, p in enumerate(self.path) if p == path}
        return sum(max(0, len(block) - links) for element, block, links in self.blocks if self._held(element, own))

    def _held(self, element: int, own: set[int]) -> bool:
        """Whether an element is in one of ``own`` and nothing below that is to be skipped."""
        while element >= 0 and element not in own:
            if self.skip[element]:
                return False
            element = self.parent[element]
        return element >= 0

    def text(self, path: str) -> str:
        """Blocks inside the elements of ``path``, without what is to be skipped there."""
        own = {e for e, p in enumerate(self.path) if p == path}
        return "\n".join(block for element, block, _ in self.blocks if self._held(element, own))


def page_path(source: str | None) -> str | None:
    """The path a page votes for; None if it has no running text."""
    return _Page(source or "").best()


def page_text(source: str | None, paths: list[str], settled: set[str] | None = None) -> str:
    """Text of a page by one of its host's paths, else by its own best path.

    It is the first path that holds about as much running text as the page's own best one.
    If that is not among ``settled`` (None: it is), most pages that have it prefer another
    one, and the first path that yields any text is taken.
    """
    page = _Page(source or "")
    present, own = set(page.path), page.best()
    least = ABOUT * page.running(own) if own is not None and (settled is None or own in settled) else 0
    for path in paths:
        if path in present and page.running(path) >= least and (text := page.text(path)):
            return text
    return page.text(own) if own is not None else ""


def page_votes(source: str | None) -> list[tuple[str, int]]:
    """(path, whether the page votes for it) of all elements round running text."""
    page = _Page(source or "")
    own = page.best()
    held: set[int] = set()
    for element, block, links in page.blocks:
        if len(block) > 2 * links and page.clear(element, -1):
            while element > 0 and element not in held:
                held.add(element)
                element = page.parent[element]
    paths = {page.path[e] for e in held} | ({own} if own is not None else set())
    return [(path, int(path == own)) for path in sorted(paths)]


def host(url: str = "url"):
    """Lower-case host of a URL column; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths, settled): what a host's pages voted for, most votes first (ties: the path).

    settled are the paths that at least half of the pages with running text there voted
    for. Votes are counted before they are shuffled, so a host with most of the pages costs
    a row per path and task.
    """
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1):
                found = [page_votes(s) for s in rows.column(1).to_pylist()]
                at = [i for i, own in enumerate(found) for _ in own]
                path, vote = [p for own in found for p, _ in own], [v for own in found for _, v in own]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(at, pa.int64())), pa.array(path, pa.string()), pa.array(vote, pa.int64())],
                    ["host", "path", "vote"],
                )

    votes = pages.select(host().alias("host"), "html").mapInArrow(run, "host string, path string, vote long")
    counted = votes.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.count("*").alias("had")).where("votes > 0")
    settled = (2 * F.col("votes") >= F.col("had")).alias("settled")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("order"), "path", settled)))
    return (
        counted.groupBy("host")
        .agg(listed.alias("listed"))
        .select(
            "host",
            F.transform("listed", lambda r: r["path"]).alias("paths"),
            F.transform(F.filter("listed", lambda r: r["settled"]), lambda r: r["path"]).alias("settled"),
        )
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html).

    A block is what stands between the starts and ends of other than inline elements; line
    breaks are white space. Pages without text have an empty one, null html is empty. A
    null or unreadable URL belongs to the host of that name. Repeated rows stay.
    """
    paths = materialize(host_paths(pages), "host-paths")
    # Spark knows the size of the stored table and joins by broadcast only if it is small.
    joined = pages.select("page_id", "url", "html", host().alias("host")).join(paths, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2):
                found = [
                    page_text(s, p or [], set(known or []))
                    for s, p, known in zip(*(rows.column(i).to_pylist() for i in (2, 3, 4)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"]
                )

    return joined.select(F.col("page_id").cast("long"), "url", "html", "paths", "settled").mapInArrow(
        run, "page_id long, url string, text string"
    )
