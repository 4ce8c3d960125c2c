"""Main text of HTML pages: boilerplate by meaning, and site templates found by counting subtrees per host.

1. Every page is read once: its blocks of text, and the hashes of all its containers (tags and texts), inside the article and outside.
2. Spark counts per host on how many pages each block and each container occurs; those on at least ``MIN_PAGES`` pages, however large
   the host is, recur.
3. A page vouches for a recurring container if at least half of its other main text does not recur. Copies of an article recur as a
   whole, so they vouch for none of its parts, whatever these are made of; pages of different content that print the same box do.
4. A container that ``MIN_PAGES`` pages of its host vouch for is part of the site's template. It is deleted from all pages of the host, and only
   then the article is chosen among what is left. Paragraphs and headings are no containers, so shared passages stay.

Counts and templates stay rows of ``(host, hash)`` and meet the pages in joins, salted by page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm.scratch import Scratch
from celltrace.llm.words import small

MIN_PAGES = 5
#: Parts of the containers of one template in the join with the pages.
SALTS = 8

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp svg template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split())
#: A start tag on the left ends an open element on the right, up to a container of the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
SCOPE = frozenset("td th table caption button object html article section main aside".split())

# What is not part of an article.
DROPPED = frozenset("head nav aside footer form button select datalist menu dialog object canvas audio video map progress meter".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads adv adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer disqus footer gdpr login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion promoted recommended related reply replies share sharing "
    "sidebar sidenav signup skip social sponsor sponsored subscribe subscription teaser toolbar widget alert".split()
)
#: Words that begin the names of comment parts (other words, such as commentary, are not meant).
DROPPED_NAMES |= frozenset("comment comments commentlist commentform commentbox commentarea commentsection commenting commenter commenters".split())
#: Parts that go whatever their size.
STRONG_NAMES = frozenset(
    "ad ads adv adsense advert adverts advertisement advertising sponsor sponsored menu nav navbar navigation sidenav breadcrumb breadcrumbs disqus reply replies "
    "comment comments commentlist commentform commentbox commentarea commentsection commenting commenter commenters".split()
)
COMMENT_NAMES = frozenset(n for n in STRONG_NAMES if n.startswith("comment")) | {"disqus", "reply", "replies"}
#: Names such as no-ads or has-sidebar describe the page around a part.
NEGATED = frozenset("has have no non not with without".split())
#: Inside an article their ids are slugs of their titles.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
HEADINGS = TITLED - {"section"}
CONTAINERS = frozenset("article div section ul ol dl table nav aside header footer form figure center fieldset menu".split())

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$|["'])""", re.IGNORECASE)


def is_boilerplate(name: str, attributes: str, inside_article: bool) -> bool:
    if name in DROPPED or (name == "header" and not inside_article):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key == "role" and value in DROPPED_ROLES:
            return True
    return False


def is_named(name: str, attributes: str, inside_article: bool) -> str:
    """Whether a class or an id names the element as boilerplate: "weak" (``Page`` decides by its content), "strong", "comments" or ""."""
    if not attributes or name in ("html", "body", "article", "main"):
        return ""
    best = ""
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key not in ("class", "id"):
            continue
        for word in value.split():
            parts = [p for p in re.split(r"[^a-z0-9]+", word) if p]
            if not parts or parts[0] in NEGATED:
                continue
            slug = key == "id" and inside_article  # of a title, unless all of it is a name
            if slug and name in TITLED and (name in HEADINGS or not all(p in STRONG_NAMES for p in parts)):
                continue
            matches = [p in DROPPED_NAMES or p == "header" and not inside_article for p in parts]
            if all(matches) if slug else any(matches):
                if any(p in COMMENT_NAMES for p in parts):
                    return "comments"
                best = "strong" if any(p in STRONG_NAMES for p in parts) else best or "weak"
    return best


class Element:
    __slots__ = ("name", "dropped", "muted", "named", "inside", "article", "main", "outer", "content", "parts", "first", "size")

    def __init__(self, name: str, parent: Element | None, dropped: bool, first: int, named: str = "", muted: bool = False):
        self.name, self.first, self.size, self.content, self.named = name, first, 0, False, named
        self.dropped = dropped or bool(parent and parent.dropped)
        self.muted = muted or bool(parent and parent.muted)  # its articles do not say where the page's text is
        holds = name in ("article", "main") and not self.dropped
        self.inside = holds or bool(parent and parent.inside)
        self.article = bool(parent and parent.article) or (name == "article" and holds and not self.muted)
        self.main = bool(parent and parent.main) or (name == "main" and holds and not self.muted)
        outer = parent.outer if parent else None
        self.outer: Element | None = self if holds and (outer is None or outer.name == "main" and name == "article") else outer
        self.parts: list[str] = []


class Page:
    """Blocks of text in page order, and the hashes of the containers that hold them.

    A page with elements that are boilerplate by name is read again, once their subtrees are known. Comments, menus and adverts go whatever their
    size; what has another such name goes if it holds at most half of the text of the page and of the article or main part around it. An element
    around an article that is not a list of comments stays, but its articles do not say where the page's text is. If the
    part that has the page's text would be left without any, the names inside it do not count.
    """

    def __init__(self, source: str):
        self._start(source, None)
        if self.named:
            named, place, chosen = self.named, self.place(), {at: self._verdict(element) for at, element in self.named.items()}
            self._start(source, chosen)
            if not self.blocks or place and not any(block[place] for block in self.blocks):
                inside = lambda element: not place or element.outer is not None
                self._start(source, {at: "plain" if inside(named[at]) else verdict for at, verdict in chosen.items()})

    def _verdict(self, element: Element) -> str:
        outer = element.outer
        if element.content and not (outer and outer.name == "article"):
            return "dropped" if element.named == "comments" else "muted" if 2 * element.size <= self.size else "plain"
        small = 2 * element.size <= self.size and (not outer or 2 * element.size <= outer.size)
        return "dropped" if element.named in ("strong", "comments") or small else "plain"

    def _start(self, source: str, verdicts: dict[int, str] | None) -> None:
        self.verdicts = verdicts
        self.named: dict[int, Element] = {}  # by place in the source
        self.size = 0
        self.blocks: list[list] = []  # [text, inside article, inside main]
        self.subtrees: list[tuple[int, int, int]] = []  # hash, first block, block after the last
        self.text: list[str] = []
        self.stack: list[Element] = []
        self.open: Counter[str] = Counter()
        self._read(source)

    def _flush(self) -> None:
        if not self.text:
            return
        text, self.text = " ".join("".join(self.text).split()), []
        if text and not (self.stack and self.stack[-1].dropped):
            top = self.stack[-1] if self.stack else None
            self.blocks.append([text, bool(top and top.article), bool(top and top.main)])
            self.size += len(text)
            if top:
                top.size += len(text)
                top.parts.append(text)

    def _add(self, text: str) -> None:
        if not (self.stack and self.stack[-1].dropped):
            self.text.append(entities.unescape(text) if "&" in text else text)

    def _pop(self) -> None:
        element = self.stack[-1]
        if element.name in BLOCK or element.dropped or element.named:
            self._flush()
        self.stack.pop()
        self.open[element.name] -= 1
        parent = self.stack[-1] if self.stack else None
        holds = element.content or element.name in ("article", "main")
        if element.name in BLOCK and not element.dropped:
            value = xxhash.xxh3_64_intdigest(f"{element.name}({'|'.join(element.parts)})") >> 1
            if element.name in CONTAINERS and element.size:
                self.subtrees.append((value, element.first, len(self.blocks)))
            if parent:
                parent.parts.append(str(value))
        if parent:
            parent.size += element.size
            parent.content |= holds

    def _close(self, names: set[str] | frozenset[str], barrier: set[str] | frozenset[str]) -> None:
        """End the nearest open element of these names, unless a barrier is nearer."""
        if not any(self.open[name] for name in names):
            return
        for place in range(len(self.stack) - 1, -1, -1):
            if self.stack[place].name in names:
                while len(self.stack) > place:
                    self._pop()
                return
            if self.stack[place].name in barrier:
                return

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            found = _TAG.search(source, at)
            if not found:
                self._add(source[at:])
                break
            if found.start() > at:
                self._add(source[at : found.start()])
            at = found.end()
            if found[1] is not None:
                self._add(found[1])
                continue
            name = found[3] or found[6]
            if not name:
                continue
            name, closing, attributes = name.lower(), found[2] or found[5], found[4] if found[3] else found[7]
            if closing:
                if name in VOID:
                    continue
                if name in BLOCK:
                    self._flush()
                self._close({name}, frozenset())
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = end.end() if end else size
                continue
            if name in BLOCK:
                self._flush()
                if name in CLOSES_P:
                    self._close({"p"}, SCOPE)
                if name in IMPLIED:
                    self._close(*IMPLIED[name])
            elif name == "br":
                self._add(" ")
            if name in VOID or attributes.endswith("/") and name not in BLOCK:
                continue
            parent = self.stack[-1] if self.stack else None
            inside = bool(parent and parent.inside)
            dropped = is_boilerplate(name, attributes, inside)
            if self.verdicts is None:
                named, verdict = "" if dropped or parent and parent.dropped else is_named(name, attributes, inside), None
            else:
                named, verdict = "", self.verdicts.get(found.start())
            dropped = dropped or verdict == "dropped"
            if (dropped or named) and not (parent and parent.dropped):
                self._flush()
            self.stack.append(Element(name, parent, dropped, len(self.blocks), named, verdict == "muted" or named == "comments"))
            if named:
                self.named[found.start()] = self.stack[-1]
            self.open[name] += 1
        while self.stack:
            self._pop()
        self._flush()

    def place(self) -> int:
        """Where the main text is: 1 the article, 2 the main part, 0 the whole page."""
        return next((p for p in (1, 2) if any(block[p] for block in self.blocks)), 0)

    def rows(self) -> tuple[list[str], list[int], list[int], list[tuple[int, int, int]]]:
        """Blocks, their hashes, their parts of the page (1 article, 2 main part, 3 both), and the containers over them."""
        texts = [block[0] for block in self.blocks]
        return texts, [xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], [bool(b[1]) + 2 * bool(b[2]) for b in self.blocks], self.subtrees


def chosen(places: list[int], gone: list[bool]) -> list[bool]:
    """Which blocks are the main text: those of the article, or else of the main part, or else all, of what is not gone."""
    for bit in (1, 2):
        if any(p & bit and not g for p, g in zip(places, gone)):
            return [bool(p & bit) and not g for p, g in zip(places, gone)]
    return [not g for g in gone]


def vouched(sizes: list[int], keys: list[int], places: list[int], containers: list[tuple[int, int, int]], recurring: frozenset[int]) -> set[int]:
    """Recurring containers beside which at least half of the page's main text does not recur."""
    main = np.array(chosen(places, [False] * len(sizes)), bool)
    length = np.array(sizes, np.int64) * main
    own = length * np.array([k not in recurring for k in keys], bool)
    every, mine = np.concatenate(([0], np.cumsum(length))), np.concatenate(([0], np.cumsum(own)))
    out = set()
    for value, first, last in containers:
        if value in recurring:
            rest, unique = every[-1] - every[last] + every[first], mine[-1] - mine[last] + mine[first]
            if rest and 2 * unique >= rest:
                out.add(value)
    return out


def without(blocks: list[str], places: list[int], containers: list[tuple[int, int, int]], templates: frozenset[int]) -> list[str]:
    """Blocks of the main text without those of templates, unless none would be left."""
    gone = [False] * len(blocks)
    for value, first, last in containers:
        if value in templates:
            gone[first:last] = [True] * (last - first)
    if all(gone):
        gone = [False] * len(blocks)
    return [block for block, keep in zip(blocks, chosen(places, gone)) if keep]


def main_text(source: str | None) -> str:
    """Main text of a page that belongs to no site."""
    texts, _, places, containers = Page(source or "").rows()
    return "\n".join(without(texts, places, containers, frozenset()))


def frequent(found: DataFrame, min_pages: int) -> DataFrame:
    """``(host, value)`` of hashes that occur on ``min_pages`` pages of a host. ``found(host, value)`` names a hash once per page."""
    return found.groupBy("host", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages).select("host", "value")


def listed(found: DataFrame, chosen_: DataFrame, name: str) -> DataFrame:
    """``(row, name)``: per page the values of ``found(row, host, value)`` that ``chosen_(host, value)`` has."""
    spread = chosen_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = found.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(spread, ["host", "value", "salt"])
    return hits.groupBy("row").agg(F.collect_list("value").alias(name))


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """``(id, url, text, n_chars)`` per row of ``pages``: blocks of the main text, one per line.

    Null and empty pages have an empty text; a page whose whole text is template keeps it. Pages without a readable host belong to no site and are judged by meaning alone;
    repeated rows count as pages of their host.
    """
    kind, scratch = pages.schema[id_column].dataType, Scratch(pages.sparkSession)
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    rows = rows.withColumn("host", F.lower(F.try_parse_url("url", F.lit("HOST"))))
    read = T.StructType(
        [
            T.StructField("id", kind), T.StructField("url", T.StringType()), T.StructField("host", T.StringType()), T.StructField("blocks", T.ArrayType(T.StringType())),
            T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("values", T.ArrayType(T.LongType())), T.StructField("firsts", T.ArrayType(T.IntegerType())), T.StructField("lasts", T.ArrayType(T.IntegerType())),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [Page(h.as_py() or "").rows() for h in batch.column(2)]
            parts = [part if host.is_valid else [] for (*_, part), host in zip(found, batch.column(3))]
            numbers = [pa.array([[x[k] for x in part] for part in parts], pa.list_(kind_)) for k, kind_ in enumerate((pa.int64(), pa.int32(), pa.int32()))]
            texts, keys, places = (pa.array([x[k] for x in found], pa.list_(kind_)) for k, kind_ in enumerate((pa.string(), pa.int64(), pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), texts, keys, places, *numbers], read.names)

    # written, so that a page is read once and the row numbers stand
    parsed = scratch.cut(rows.select("id", "url", "html", "host").mapInArrow(parse, read).withColumn("row", F.monotonically_increasing_id()), "parsed")
    sited = parsed.filter(F.col("host").isNotNull())
    found = sited.select("row", "host", F.explode(F.array_distinct(F.concat("keys", "values"))).alias("value"))
    recurring = scratch.cut(listed(found, frequent(found.select("host", "value"), min_pages), "recurring"), "recurring")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows_, values = [], []
            for row, (sizes, keys, places, names, firsts, lasts, known) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(1, 8)))):
                mine = vouched(sizes, keys, places, list(zip(names, firsts, lasts)), frozenset(known))
                rows_ += [row] * len(mine)
                values += mine
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows_, pa.int64())), pa.array(values, pa.int64())], ["host", "value"])

    sizes = F.transform("blocks", F.length)
    voters = sited.join(recurring, "row").select("host", sizes.alias("sizes"), "keys", "places", "values", "firsts", "lasts", "recurring")
    templates = scratch.cut(frequent(voters.mapInArrow(vote, "host string, value long"), min_pages), "templates")
    held = sited.select("row", "host", F.explode(F.array_distinct("values")).alias("value"))
    hits = scratch.cut(listed(held, templates, "templates"), "hits")
    joined = parsed.join(hits, "row", "left").select("id", "url", "blocks", "places", "values", "firsts", "lasts", "templates")
    schema = T.StructType([T.StructField(id_column, kind), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [
                "\n".join(without(blocks, places, list(zip(values, firsts, lasts)), frozenset(known or ())))
                for blocks, places, values, firsts, lasts, known in zip(*(batch.column(k).to_pylist() for k in range(2, 8)))
            ]
            sizes = np.array([len(t) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes)], schema.names)

    return joined.mapInArrow(run, schema)
