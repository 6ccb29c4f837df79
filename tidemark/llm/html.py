"""Main text of web pages, with site templates found by counting element subtrees.

Each page is parsed once for its main text's blocks and the subtrees of its container elements (tag, class and
everything inside, hashed). Spark counts per host on how many distinct pages each subtree occurs. A subtree is
template, and deleted, if it recurs beside at least ``MIN_PAGES`` different main texts, on a host of any size.
Copies and near copies of an article are no evidence: a main text is told by what is beside the subtree and all subtrees that recur as often, by its longest blocks that make
up ``MOSTLY`` of it, and a page counts only where that is ``MIN_BESIDE`` of its text. Plain text
blocks (paragraphs, headings, list items, cells) are never template by themselves, so an article may
quote what another one says. A second parse leaves out template subtrees and elements whose tag, role,
class or id says that they are no part of the article: menus, page headers and footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments. No class, id, form or hiding style drops an
element around the article or the main element, and no class, id or form one around most of the text in paragraphs
(but for comments). A word that also names what an article is made of (``WEAK_WORDS``), and inside an article
any listed word beside words that say something else, is no proof: such an element goes only if it is a template, or
if half of its text is links or form fields.

The text is that of the page's articles, or of ``main`` or the body where there are none. Character
references are decoded, white space inside a block becomes one blank, blocks are trimmed and joined by
one line feed in page order; empty blocks are left out. Broken markup is read as browsers do in the
common cases: open elements end with their parent or the file, and paragraphs, items and cells end where
the next begins.

A NULL html gives an empty text; a NULL url belongs to the host without name; pages of any length are
read whole; repeated rows give repeated results; further columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, takewhile

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spark import bound_batches, stored

MIN_PAGES = 5
MOSTLY = 0.8
MIN_BESIDE = 0.2

_words = lambda text: frozenset(text.split())
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style textarea title xmp iframe noembed noframes noscript")
CONTAINERS = _words("div section ul ol dl table figure fieldset center details nav aside footer header")
BLOCKS = CONTAINERS | _words(
    "html head body article main p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption"
    " blockquote pre figcaption hr address summary form menu dialog legend option optgroup hgroup"
)
DROPPED_TAGS = RAW | _words(
    "head nav footer aside menu dialog button select datalist template svg canvas object audio video map"
)
DROPPED_ROLES = _words(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar"
)
#: Words in a class or id that mark an element as no part of the article.
DROPPED_WORDS = _words(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar"
    " navigation menu sidebar footer masthead cookie cookies consent notice notices gdpr newsletter subscribe"
    " subscription signup comment comments disqus respond reply replies discussion share sharing social related"
    " recommended breadcrumb breadcrumbs pagination pager popup modal overlay toolbar widget login paywall"
    " commentlist commentform topbar sidenav adslot adsense copyright popover alert alerts announcement disclaimer"
)
#: Of these, words of reader comments, which may be longer than the article.
COMMENT_WORDS = _words("comment comments disqus respond reply replies discussion commentlist commentform")
#: Listed words that name parts of articles as well: they drop only what is mostly links or fields.
WEAK_WORDS = _words("widget discussion")
#: Words that say nothing about what an element holds.
NEUTRAL_WORDS = _words(
    "box wrapper wrap container slot unit block inline inner outer top bottom left right site page post posts article"
    " articles story stories list form section area bar link links button buttons icon icons text label title item"
    " items wide small large mobile desktop in the content row col holder panel group"
)
#: Words in a class or id after which its other words say what an element goes with, or is without.
BESIDE_WORDS = _words("has with no")
ARTICLE_WORDS = _words("article post entry story content")
#: Elements that a start tag of another kind ends, up to the nearest of the given bounds.
ENDS = {
    "li": (_words("li"), _words("ul ol menu")),
    "dt": (_words("dt dd"), _words("dl")),
    "dd": (_words("dt dd"), _words("dl")),
    "tr": (_words("tr td th"), _words("table")),
    "td": (_words("td th"), _words("tr table")),
    "th": (_words("td th"), _words("tr table")),
    "option": (_words("option"), _words("select datalist")),
}
PARAGRAPH_BOUNDS = _words("table td th button object caption html")
ENDS_PARAGRAPH = BLOCKS - _words("td th tr thead tbody tfoot caption legend option optgroup html head body")
KEPT_ROOTS = _words("html body main article")
#: Elements that hold form fields or links.
FIELDS = _words("a label option legend")
#: Why an element is dropped: for its tag or role, for a word of its class or id, for one of comments, for a word
#: that is no proof, as a form, for being hidden.
KEPT, GONE, NAMED, COMMENTS, WEAK, FORM, HIDDEN = range(7)

# a quote opens a value only after an equals sign
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|=(?!\s*["'])|[^>=])*)(?:>|\Z)""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'][^\s=/]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s]+))?|["']""")
_TOLD = _words("class id role hidden aria-hidden style")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}


class Page:
    """A page as flat pieces of text (None: block border) and elements that cover ranges of them."""

    def __init__(self, source: str) -> None:
        self.pieces: list[str | None] = []
        self.dropped: list[tuple[int, int]] = []
        self.subtrees: list[tuple[int, int, int]] = []
        self.roots: dict[str, list[tuple[int, int]]] = {"article": [], "main": []}
        self._named: list[tuple[int, int, int]] = []
        self._paragraphs: list[tuple[int, int]] = []
        self._fields: list[tuple[int, int]] = []
        # open elements: tag, class, first piece, why dropped, digest parts, inside an article or main
        self._open: list[tuple[str, str, int, int, list[str], bool]] = []
        self._parse(source)
        while self._open:
            self._end()
        if self._named:
            self._spare()

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            mark = source.find("<", at)
            if mark < 0:
                return self._text(source[at:])
            if mark > at:
                self._text(source[at:mark])
            found = _TAG.match(source, mark) or _LOOSE.match(source, mark)
            if found is None:
                found = _OTHER.match(source, mark)
                if found is None:
                    self._text("<")
                at = found.end() if found else mark + 1
                continue
            at = found.end()
            if found[0][-1] != ">":
                return None
            tag = found[2].lower()
            if found[1]:
                self._close(tag)
                continue
            self._start(tag, found[3])
            if tag in VOID:
                if tag == "br":
                    self.pieces.append(" ")
            elif tag in RAW:
                close = _CLOSE[tag].search(source, at)
                self._end()
                at = close.end() if close else size
        return None

    def _text(self, raw: str) -> None:
        text = references.unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if self._open:
            self._open[-1][4].append(text)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ENDS_PARAGRAPH:
            self._end_within(_words("p"), PARAGRAPH_BOUNDS)
        if tag in ENDS:
            self._end_within(*ENDS[tag])
        if tag in BLOCKS:
            self.pieces.append(None)
        if tag in VOID:
            return
        inside = bool(self._open) and (self._open[-1][5] or self._open[-1][0] in ("article", "main"))
        named, drop = "", GONE if tag in DROPPED_TAGS or (tag == "header" and not inside) else KEPT
        if tag == "form":
            drop = FORM
        if attributes and drop in (KEPT, FORM):
            named, why = self._told(tag, attributes, inside)
            drop = why or drop
        self._open.append((tag, named, len(self.pieces), drop, [], inside))

    @staticmethod
    def _told(tag: str, attributes: str, inside: bool) -> tuple[str, int]:
        named, drop = "", KEPT
        for key, value in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key not in _TOLD:
                continue
            value = value.strip("\"'")
            if key in ("class", "id"):
                named += f" {value}" if key == "class" else ""
                why = Page._by_words(value, inside)
                # a word that proves something counts before one that does not
                if drop in (KEPT, WEAK) or (why == COMMENTS and drop == NAMED):
                    drop = why or drop
            elif key == "role" and value.lower() == "form":
                drop = drop if drop in (GONE, HIDDEN) else FORM
            elif key == "role" and value.lower() in DROPPED_ROLES:
                drop = GONE
            elif (
                key == "hidden"
                or (key == "aria-hidden" and value.lower() == "true")
                or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            ):
                drop = drop if drop == GONE else HIDDEN
        if tag in KEPT_ROOTS and not (tag == "article" and inside):
            drop = KEPT
        return named, drop

    @staticmethod
    def _by_words(value: str, inside: bool) -> int:
        """Why the names of a class or id drop an element."""
        found, all_words = KEPT, set()
        for name in value.split():
            parts = [w.lower() for w in _NAME_WORD.findall(name)]
            words = frozenset(takewhile(lambda w: w not in BESIDE_WORDS, parts))
            all_words |= words
            listed = words & DROPPED_WORDS
            if not listed:
                continue
            strange = words - DROPPED_WORDS - NEUTRAL_WORDS
            if listed <= WEAK_WORDS or (inside and strange):
                found = found or WEAK
            elif not COMMENT_WORDS.isdisjoint(listed - WEAK_WORDS):
                found = COMMENTS
            elif found != COMMENTS:
                found = NAMED
        header = "header" in all_words and not inside and all_words.isdisjoint(ARTICLE_WORDS)
        return NAMED if header and found in (KEPT, WEAK) else found

    def _spare(self) -> None:
        """Drop what a class, id, form or hiding style marks, unless it holds the article, the main element or most of the paragraphs.

        Of several articles those in the fewest marked elements count, and beside a main element that is in
        none only those in marked elements that hold half of the paragraphs. Comments count as marked
        however long they are, and what is hidden however much of the paragraphs it holds.
        """
        gone, sizes = self._gone(self.dropped), [0] * len(self.pieces)
        for first, last in self._paragraphs:
            for n in range(first, last):
                sizes[n] = 0 if gone[n] else len((self.pieces[n] or "").strip())
        upto = [0, *accumulate(sizes)]
        told = [0, *accumulate(0 if gone[n] else len((p or "").strip()) for n, p in enumerate(self.pieces))]
        fields = self._gone(self._fields)
        linked = [0, *accumulate(told[n + 1] - told[n] if fields[n] else 0 for n in range(len(self.pieces)))]
        weak = [
            (first, last, why)
            for first, last, why in self._named
            if why == WEAK and 2 * (linked[last] - linked[first]) < told[last] - told[first]
        ]
        self._named = [one for one in self._named if one not in weak]
        depths = [0] * (len(self.pieces) + 1)
        for first, last, _ in self._named:
            depths[first] += 1
            depths[last] -= 1
        depths = list(accumulate(depths))
        articles, mains = (
            [first for first, _ in found if not any(gone[first : first + 1])] for found in self.roots.values()
        )
        least = {tag: min((depths[n] for n in found), default=0) for tag, found in (("a", articles), ("m", mains))}
        whole = bool(mains) and not least["m"]
        articles = sorted(n for n in articles if depths[n] == least["a"])
        mains = sorted(n for n in mains if depths[n] == least["m"])
        for first, last, why in self._named:
            inner = upto[last] - upto[first]
            holds = lambda found: bisect_left(found, first) < bisect_left(found, last)  # noqa: B023, E731
            spared = holds(mains) or (holds(articles) and (not whole or 2 * inner >= upto[-1]))
            if not spared and not (why not in (COMMENTS, HIDDEN) and 2 * inner > upto[-1]):
                self.dropped.append((first, last))
        # an article or main that is gone is no root
        gone = self._gone(self.dropped)
        for tag, found in self.roots.items():
            self.roots[tag] = [r for r in found if r[0] == r[1] or not all(gone[r[0] : r[1]])]

    def _close(self, tag: str) -> None:
        for n in range(len(self._open) - 1, -1, -1):
            if self._open[n][0] == tag:
                while len(self._open) > n:
                    self._end()
                return
        if tag in BLOCKS:
            self.pieces.append(None)

    def _end_within(self, tags: frozenset, bounds: frozenset) -> None:
        for n in range(len(self._open) - 1, -1, -1):
            if self._open[n][0] in bounds:
                return
            if self._open[n][0] in tags:
                while len(self._open) > n:
                    self._end()
                return

    def _end(self) -> None:
        tag, named, first, drop, parts, inside = self._open.pop()
        last = len(self.pieces)
        if drop == GONE:
            self.dropped.append((first, last))
        elif drop:
            self._named.append((first, last, drop))
        if tag in FIELDS:
            self._fields.append((first, last))
        if tag == "p" and not drop:
            self._paragraphs.append((first, last))
        elif tag in self.roots and not drop:
            if not inside or not self.roots[tag]:
                self.roots[tag].append((first, last))
        digest = xxhash.xxh64_intdigest("\x1f".join((tag, named, *parts)))
        if tag in CONTAINERS and drop != GONE:
            self.subtrees.append((digest - (1 << 63), first, last))
        if self._open:
            self._open[-1][4].append(f"\x1e{digest}")
        if tag in BLOCKS:
            self.pieces.append(None)

    def candidates(self) -> list[tuple[int, int, int]]:
        """Subtrees that hold text and are not dropped for what they are: digest, first block, block after the last."""
        gone = self._gone(self.dropped)
        told = [0, *accumulate(bool(p and not gone[n] and not p.isspace()) for n, p in enumerate(self.pieces))]
        starts = [first for first, _ in self._blocks()]
        return sorted(
            (digest, bisect_left(starts, first), bisect_left(starts, last))
            for digest, first, last in self.subtrees
            if told[last] > told[first]
        )

    def blocks(self) -> list[str]:
        """The blocks of the main text, templates included."""
        return [block for _, block in self._blocks()]

    def _gone(self, ranges: list[tuple[int, int]]) -> bytearray:
        gone = bytearray(len(self.pieces))
        for first, last in ranges:
            gone[first:last] = b"\x01" * (last - first)
        return gone

    def text(self, template: frozenset[int] = frozenset()) -> str:
        """The main text, without the subtrees that have one of the given digests."""
        return "\n".join(block for _, block in self._blocks(template))

    def _blocks(self, template: frozenset[int] = frozenset()) -> list[tuple[int, str]]:
        """First piece and text of the blocks of the main text."""
        cut = [(a, b) for digest, a, b in self.subtrees if digest in template]
        gone = self._gone(self.dropped + cut)
        roots = self.roots["article"] or self.roots["main"] or [(0, len(self.pieces))]
        inside = bytearray(len(self.pieces))
        for first, last in roots:
            inside[first:last] = b"\x01" * (last - first)
        blocks, run, start = [], [], 0
        for n, piece in enumerate([*self.pieces, None]):
            if piece is None:
                if run and (block := " ".join("".join(run).split())):
                    blocks.append((start, block))
                run = []
            elif inside[n] and not gone[n]:
                start = start if run else n
                run.append(piece)
        return blocks


def beside(blocks: list[int], sizes: list[int], covered: bytearray) -> int | None:
    """What tells a main text by its blocks that are not covered; None where they are too little of it."""
    left = sorted({(-size, block) for block, size, c in zip(blocks, sizes, covered, strict=True) if not c})
    total = -sum(size for size, _ in left)
    if not total or total < MIN_BESIDE * sum(sizes):
        return None
    most, told = 0, []
    for size, block in left:
        if most >= MOSTLY * total:
            break
        most -= size
        told.append(block)
    return xxhash.xxh64_intdigest(repr(told)) - (1 << 63)


def with_host(pages: DataFrame) -> DataFrame:
    """page_id, url, html (NULL: empty), host and key; pages of one host and html share a key."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.coalesce(host, F.lit("")).alias("host"),
    ).withColumn("key", F.md5(F.concat_ws("\n", "host", "html").cast("binary")))


def subtrees(pages: DataFrame) -> DataFrame:
    """Of each distinct page: host, key, its subtrees, and its blocks by hash and length."""
    tree = pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("after", pa.int32())])
    schema = (
        "host string, key string, trees array<struct<hash: long, first: int, after: int>>,"
        " blocks array<long>, sizes array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, blocks, sizes = [], [], []
            for source in batch.column("html").to_pylist():
                page = Page(source)
                trees.append([dict(zip(("hash", "first", "after"), t, strict=True)) for t in page.candidates()])
                told = page.blocks() if trees[-1] else []
                blocks.append([xxhash.xxh64_intdigest(b) - (1 << 63) for b in told])
                sizes.append([len(b) for b in told])
            arrays = [pa.array(trees, pa.list_(tree)), pa.array(blocks, pa.list_(pa.int64()))]
            arrays += [pa.array(sizes, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("key"), *arrays],
                names=["host", "key", "trees", "blocks", "sizes"],
            )

    return pages.select("host", "key", "html").mapInArrow(run, schema).dropDuplicates(["key"])


def evidence(found: DataFrame, often: DataFrame) -> DataFrame:
    """host, hash, beside: the distinct main texts beside each subtree of ``often`` (host, hash, pages)."""
    owned = found.select("host", "key", F.explode(F.array_distinct("trees.hash")).alias("hash"))
    marks = owned.join(often.select("host", "hash", "pages"), ["host", "hash"]).groupBy("key")
    marked = found.join(marks.agg(F.collect_list(F.struct("pages", "hash")).alias("marks")), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                places: dict[int, list[tuple[int, int]]] = {}
                for tree in row["trees"]:
                    places.setdefault(tree["hash"], []).append((tree["first"], tree["after"]))
                times: dict[int, list[int]] = {}
                for mark in row["marks"]:
                    times.setdefault(mark["pages"], []).append(mark["hash"])
                covered = bytearray(len(row["blocks"]))
                for count in sorted(times, reverse=True):
                    for digest in times[count]:
                        for first, after in places[digest]:
                            covered[first:after] = b"\x01" * (after - first)
                    told = beside(row["blocks"], row["sizes"], covered)
                    if told is not None:
                        made += [(row["host"], digest, told) for digest in times[count]]
            columns = zip(*made, strict=True) if made else [[]] * 3
            kinds = (pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "hash", "beside"])

    chosen = marked.select("host", "trees", "blocks", "sizes", "marks")
    return chosen.mapInArrow(run, "host string, hash long, beside long").distinct()


def templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, hash of the subtrees that recur across the host."""
    each = found.select("host", F.explode(F.array_distinct("trees.hash")).alias("hash"))
    counted = each.groupBy("host", "hash").agg(F.count("*").alias("pages"))
    often = stored(counted.where(F.col("pages") >= min_pages), "often")
    texts = evidence(found, often).groupBy("host", "hash").agg(F.count("*").alias("texts"))
    return texts.where(F.col("texts") >= min_pages).select("host", "hash")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text: the main text of every page.

    What is to be deleted is written first, so the join with the pages knows its size: it is broadcast
    only below the session's threshold.
    """
    bound_batches(pages.sparkSession)
    pages = with_host(pages)
    found = stored(subtrees(pages), "subtrees")
    recurring = templates(found, min_pages)
    cut = stored(
        found.select("host", "key", F.explode("trees.hash").alias("hash"))
        .join(recurring, ["host", "hash"], "left_semi")
        .groupBy("key")
        .agg(F.collect_set("hash").alias("cut")),
        "templates",
    )
    schema = "page_id long, url string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, cuts = (batch.column(n).to_pylist() for n in ("html", "cut"))
            made = [Page(h).text(frozenset(c or ())) for h, c in zip(sources, cuts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(made, pa.string())],
                names=["page_id", "url", "text"],
            )

    marked = pages.join(cut, "key", "left").select("page_id", "url", "html", "cut")
    return marked.mapInArrow(run, schema)
