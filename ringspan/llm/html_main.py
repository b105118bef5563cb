"""Main text of web pages by paths that the pages of a host agree on.

Each page's containers are scored by the text they hold. Pages vote for the generalised path of their best
container (tags and classes from the body down, numbers and hashes generalised); votes are summed per host in
Spark. The winning paths of a host then select the text of all its pages, also of those whose own scores
mislead. A page on which no winning path has text, or without a host, falls back on its own best container.

A class, id or tag that names something besides the article (a menu, a sidebar, a form) is evidence and no verdict. It
is weighed against the text that the element holds: one with most of the page's text, or with all there is, stays,
whatever it is called, and what is marked inside it is judged for itself.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.common import small_batches
from ringspan.session import materialize

# A host's path needs this share of the host's votes, so a host has ten at most.
LEAST_SHARE = 0.1

# Tags that hold other blocks and make up paths.
_CONTAINERS = frozenset(
    "html body main article section div center table tbody tr td ul ol dl blockquote details figure".split()
)
# Tags that are never main text, whose content goes.
_DROPPED = frozenset(
    "head noscript template svg math iframe object video audio canvas select button label fieldset".split()
)
# Tags that mark what is not the article, as classes do.
_BESIDE = frozenset("nav header footer aside form menu dialog".split())
_RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
# Tags that begin and end a block of text besides the containers.
_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre br hr address figcaption caption thead tfoot th summary option".split()
)
_VOID = frozenset("br hr img input meta link source wbr col embed area base".split())
# Words of classes, ids and roles that mark what is not the article.
_MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner banners promo promotion sponsor sponsored menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer sidebar sidebars aside widget widgets comment comments "
    "disqus respond reply replies cookie cookies consent notice notices gdpr popup modal overlay subscribe newsletter "
    "signup login share sharing social related recommended recommendations pagination pager toolbar skip legal "
    "copyright alert complementary contentinfo search form".split()
)
# Trust put in a container's tag when its text is weighed.
_TRUST = {"article": 1.5, "main": 1.4, "body": 0.5, "html": 0.1}
# Marks of an element: none, one that needs most of the page's text against it, one that needs all of it.
_FREE, _DOUBTFUL, _SURE = 0, 1, 2
_MOST, _NOTHING = 0.5, 0.02
# What a character in a link counts beside one outside.
_LINKED = 0.01

# A path keeps its last steps, so that deep nesting costs no more than the page's length.
_STEPS = 16
# What a container's text counts for the container around it.
_INHERITED = 0.8

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^\"'>])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
# One attribute: its name, and its value in any quotes.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_MAY_HIDE = re.compile(r"hidden|display", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def _component(tag: str, attributes: str) -> str:
    """A container's step in a path: the tag and its classes, digits and hash-like words generalised."""
    found = _CLASS.search(attributes)
    if not found:
        return tag
    classes = sorted({re.sub(r"[0-9]+", "#", c) for c in "".join(filter(None, found.groups())).split()})
    return ".".join([tag, *("#" if c.count("#") > 2 else c for c in classes)])


def _mark(attributes: str) -> int:
    """Whether a class, id or role names something besides the article, and nothing else. ``has-sidebar`` doesn't."""
    mark = _FREE
    if attributes and not attributes.isspace():
        for found in _MARKS.finditer(attributes):
            for name in "".join(filter(None, found.groups())).split():
                words = [w.lower() for w in _WORDS.findall(name)]
                if not _MARKED.isdisjoint(words) and words[0] not in ("has", "no", "with", "without"):
                    mark = max(mark, _SURE if _MARKED.issuperset(words) else _DOUBTFUL)
    return mark


def _is_hidden(attributes: str) -> bool:
    """Whether the element is not shown: ``hidden``, ``aria-hidden`` that is true, or a style without display."""
    if not _MAY_HIDE.search(attributes):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).strip()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


class Page:
    """The containers of a page, and its blocks of text outside of dropped elements, in page order."""

    def __init__(self, source: str) -> None:
        self.parents = [-1]
        self.paths = [""]
        self.tags = [""]
        self.marks = [_FREE]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self.titled: set[int] = set()  # containers with a main title or a main part in them
        self._read(source)
        self._judge()

    def _read(self, source: str) -> None:
        # Open elements that matter, each with the container that it is or lies in.
        stack: list[tuple[str, int]] = [("", 0)]
        opened: Counter[str] = Counter()
        dropped = 0  # place in the stack of the outermost dropped element; 0 for none
        block: list[str] = []
        linked, in_link, at, end = 0, False, 0, len(source)

        def close_block() -> None:
            nonlocal linked
            if block:
                text = " ".join(references.unescape("".join(block)).split())
                if text:
                    self.blocks.append((stack[-1][1], text, linked))
                block.clear()
            linked = 0

        def close_from(place: int) -> None:
            nonlocal dropped, in_link
            opened.subtract(name for name, _ in stack[place:])
            del stack[place:]
            in_link = False
            if dropped >= len(stack):
                dropped = 0

        while at < end:
            tag = _TAG.search(source, at)
            upto = tag.start() if tag else end
            if upto > at and not dropped:
                block.append(source[at:upto])
                if in_link:
                    linked += upto - at
            if not tag:
                break
            at = tag.end()
            name = (tag[2] or "").lower()
            if not name:
                continue
            if tag[1]:
                if name in _BLOCKS:
                    close_block()
                if name == "a":
                    in_link = False
                elif opened[name] > 0:
                    place = next(n for n in range(len(stack) - 1, 0, -1) if stack[n][0] == name)
                    # Inside a dropped element only its own end, or that of something around it, counts.
                    if not dropped or place >= dropped or name in ("body", "html", "article", "main"):
                        if name != "span":
                            close_block()
                        close_from(place)
                continue
            if name in _RAW:
                closing = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                at = closing.end() if closing else end
                continue
            if name == "a":
                in_link = True
                continue
            block_level = name in _BLOCKS
            if not (block_level or name in _CONTAINERS or name in _DROPPED or name in _BESIDE or name == "span"):
                continue
            if name != "span":
                close_block()
                if dropped and stack[dropped][0] in ("p", "li") and stack[dropped][0] in (name, "p"):
                    close_from(dropped)  # a new block ends an open paragraph
            if name == "body":
                close_from(1)
            if name in _VOID or (tag[3].endswith("/") and name in ("svg", "iframe", "object")):
                continue
            whole = name in ("html", "body", "article", "main")
            drop = name in _DROPPED or (not whole and _is_hidden(tag[3]))
            mark = _FREE if drop or whole else _mark(tag[3])
            if block_level or name == "span":
                # Too small to hold the article; but a title is one, however it is called.
                drop = drop or (mark and name != "h1")
            elif name in _BESIDE and not (name == "header" and (opened["article"] > 0 or opened["main"] > 0)):
                mark = _SURE
            if name in ("h1", "main") and not dropped:
                self.titled.add(stack[-1][1])
            if (block_level or name == "span") and not drop:
                continue
            inside = stack[-1][1]
            if not drop and not dropped:
                step = _component(name, tag[3])
                self.parents.append(inside)
                above = self.paths[inside]
                if above.count("/") >= _STEPS - 1:
                    above = above.split("/", 1)[1]
                self.paths.append(f"{above}/{step}" if above else step)
                self.tags.append(name)
                self.marks.append(mark)
                inside = len(self.parents) - 1
            stack.append((name, inside))
            opened[name] += 1
            if drop and not dropped:
                dropped = len(stack) - 1
        close_block()

    def _judge(self) -> None:
        """Leave out the blocks of marked containers, but for those that hold the page's text."""
        if not any(self.marks):
            return
        size = len(self.parents)
        held, titled = [0.0] * size, [at in self.titled for at in range(size)]
        for container, text, linked in self.blocks:
            held[container] += max(0, len(text) - linked) + _LINKED * len(text)
        for at in range(size - 1, 0, -1):
            held[self.parents[at]] += held[at]
            titled[self.parents[at]] |= titled[at]
        # A title speaks against the surest mark.
        marks = [_DOUBTFUL if mark and title else mark for mark, title in zip(self.marks, titled)]

        below, most = [False] * size, held[0]
        for at in range(1, size):
            below[at] = below[self.parents[at]]
            if marks[at] == _SURE and not below[at]:
                below[at] = True
                most -= held[at]
        if most <= _NOTHING * held[0]:  # all that there is is surely beside it, so nothing is sure
            marks, most = [min(mark, _DOUBTFUL) for mark in marks], held[0]
        gone = [False] * size
        for at in range(1, size):
            doubtful = marks[at] == _DOUBTFUL and held[at] < _MOST * most
            gone[at] = gone[self.parents[at]] or marks[at] == _SURE or doubtful
        self.blocks = [block for block in self.blocks if not gone[block[0]]]

    def best(self) -> int:
        """The container with the most text of its own and, less and less, of the containers in it."""
        scores = [0.0] * len(self.parents)
        for container, text, linked in self.blocks:
            scores[container] += max(0, len(text) - 2 * linked)
        for at in range(len(scores) - 1, 0, -1):  # a container comes after the one around it
            scores[self.parents[at]] += _INHERITED * scores[at]
        weighed = [score * _TRUST.get(tag, 1.0) for score, tag in zip(scores, self.tags)]
        return max(range(len(weighed)), key=weighed.__getitem__)

    def text_of(self, chosen: set[int]) -> str:
        """The blocks inside the chosen containers, a line each."""
        inside = []
        for at, parent in enumerate(self.parents):
            inside.append(at in chosen or (parent >= 0 and inside[parent]))
        return "\n".join(text for container, text, _ in self.blocks if inside[container])

    def main_text(self, paths: Iterable[str]) -> str:
        """The text of the first of ``paths`` that has any, else of the best container."""
        for path in paths:
            chosen = {at for at, own in enumerate(self.paths) if own == path}
            if chosen and (text := self.text_of(chosen)):
                return text
        return self.text_of({self.best()}) if self.blocks else ""


def _votes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vote per page for its best container's path, added up per batch."""
    for batch in small_batches(batches):
        votes: Counter[tuple[str, str]] = Counter()
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = Page(source)
            if page.blocks and page.paths[best := page.best()]:
                votes[host, page.paths[best]] += 1
        hosts, paths = zip(*votes) if votes else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(votes.values(), pa.int64())],
            names=["host", "path", "votes"],
        )


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        texts = [
            Page(source).main_text(paths or ())
            for source, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def _pages_of(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url = F.col(f"`{url_col}`").cast("string")
    host = F.lower(F.regexp_extract(F.trim(url), _HOST, 1))
    return pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        url.alias("url"),
        F.when(host != "", host).alias("host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    )


def host_paths(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``host, paths``: each host's winning paths, most votes first (of equals the first by name).

    A host's votes are added up before and after the shuffle, so a host may hold any share of the pages.
    """
    counted = (
        _pages_of(pages, id_col, url_col, html_col)
        .where("host is not null")
        .select("host", "html")
        .mapInArrow(_votes, "host string, path string, votes long")
        .groupBy("host", "path")
        .agg(F.sum("votes").alias("votes"))
    )
    totals = counted.groupBy("host").agg(F.sum("votes").alias("total"))
    winners = counted.join(totals, "host").where(F.col("votes") >= least_share * F.col("total"))
    ranked = winners.groupBy("host").agg(F.array_sort(F.collect_list(F.struct(-F.col("votes"), "path"))).alias("won"))
    return ranked.select("host", F.col("won.path").alias("paths"))


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``page_id, url, text``, one row per page: the article's blocks in page order, a line each.

    A NULL or empty page has an empty text. Pages without a host in their URL keep to their own best
    container. Repeated rows are extracted one by one.
    """
    winners = materialize(host_paths(pages, id_col, url_col, html_col, least_share), "host-paths")
    rows = _pages_of(pages, id_col, url_col, html_col).join(winners, "host", "left")
    return rows.select("page_id", "url", "html", "paths").mapInArrow(
        _texts, "page_id long, url string, text string"
    )


def extraction_report(texts: DataFrame) -> DataFrame:
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
