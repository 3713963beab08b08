"""Main text of web pages by nearest-URL page differencing.

Pages of one host share their template. Each page is parsed once into text lines (blocks) with what its markup says
about them; pages are ordered by host and path, and each is paired with the neighbour whose path is nearest (the
longest common beginning). The two pages' lines are aligned by longest common subsequence, and the shared lines
are deleted as template. Lines inside an ``article`` or ``main`` element take no part: their place is stated by the
page itself, and two pages may quote the same passage. What a page has outside of one stays if it is not shared. Lines that the markup marks as menu, header, footer, side
bar, notice, advert, form, script, style or reader comment are never main text. A class, id or role that only
contains such a word is doubtful, as layout wrappers are named so too: such an element is left out unless it holds an
``article`` or ``main`` (one named by the word itself: a ``main``), and it is read if a page has nothing else.

Only line hashes of a neighbour are sent to a page, and only pages with lines outside such an element are written down
and shuffled with their lines: the others' text no neighbour can change, so it goes from the source straight into the
result. The order is a range partitioning of (host, path, id), so
a host with a third of all pages is split; the pairs across partition borders are made from the first and last
row of each partition.

Defined cases: null html is an empty page; a page whose every line is shared with its neighbour (a mirror) keeps its
lines (or those of its article); a page with a null url, or alone in its host, has no neighbour; rows that repeat an id are paired by id and
each is extracted from its own html; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabwh.llm.common import plain, shuffle_partitions, table, written

# HTML elements by what they mean for text.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "noembed", "noframes", "title", "xmp"}
SKIPPED = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "svg", "object",
           "canvas", "audio", "video", "datalist", "map", "math"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "nobr", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "img"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HOLDERS = {"article", "main"}
# Elements that end an open element of the listed kinds, whose end tags may be left out.
IMPLIED_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
                "tr": {"tr", "td", "th"}, "option": {"option"}}
# Words of class, id and role names that mark a part as no main text.
_MARKED = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|notification|"
    r"alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|nav|navbar|navigation|menu|breadcrumbs?|pagination|"
    r"pager|sidebar|side-bar|side|rail|widget\w*|related|recommend\w*|share|sharing|social|comments?|commentlist|disqus|"
    r"respond|replies|reply|footer|header|masthead|topbar|toolbar|search|disclaimer|copyright|skip-?link|"
    r"contentinfo|complementary)(?![a-z])")
_LAYOUT = re.compile(r"(?:has|with|without|no|is|hide)-")
#: Doubtful elements whose articles are other people's text or other pages': these are not protected.
_OTHERS = re.compile(r"comment|disqus|respond|reply|replies|related|recommend")
# How sure it is that an element holds no main text.
_NAMED_IN_PART, _NAMED, _CERTAIN = 1, 2, 3
_TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
                  r"|[!?/][^>]*>)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?",
                        re.IGNORECASE)


def _dropped(name: str, rest: str) -> tuple[int, bool]:
    """How surely an element's own name and attributes say that it holds no main text (0: not), and if it is others'."""
    if name in SKIPPED:
        return _CERTAIN, False
    if not rest or name in ("html", "body", "main"):
        return 0, False
    sure, others = 0, False
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return _CERTAIN, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _CERTAIN, False
        if key in ("class", "id", "role"):
            for t in value.replace("_", "-").split():
                if _MARKED.search(t) and not _LAYOUT.match(t):
                    sure = max(sure, _NAMED if _MARKED.fullmatch(t) else _NAMED_IN_PART)
                    others = others or _OTHERS.search(t) is not None
    return sure, others


def lines_of(page: str) -> list[tuple[str, bool]]:
    """(text, inside an article or main element) of every block that the markup does not exclude, in page order."""
    lines: list[tuple[int, str, bool]] = []            # number, text, inside a holder
    number = 0
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []      # name; before it: excluded, inside a holder, open doubts
    doubts: list[list] = []                             # first line, first aside, how sure, others' text, holds main text
    aside: list[tuple[int, str]] = []                   # number and text of the lines of doubtful elements left out
    excluded = held = False
    at = 0

    def close_block() -> None:
        nonlocal number
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                lines.append((number, text, held))
                number += 1
            parts.clear()

    def leave(k: int) -> tuple[bool, bool]:
        """Close the elements from the k-th on; lines of doubtful ones that hold no main text go."""
        _, before, inside, n = stack[k]
        del stack[k:]
        settle(n)
        return before, inside

    def settle(n: int) -> None:
        while len(doubts) > n:
            first, mark, sure, _, holds = doubts.pop()
            if not holds:
                if sure == _NAMED_IN_PART:
                    aside.extend((k, t) for k, t, _ in lines[first:])
                else:
                    del aside[mark:]
                del lines[first:]

    while True:
        m = _TAG.search(page, at)
        begin = m.start() if m else len(page)
        if begin > at and not excluded:
            parts.append(page[at:begin])
        if m is None:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name, end, rest = name.lower(), m["end"], m["rest"]
        if not end and name in RAW:
            if not rest.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if name in VOID:
            if name in ("br", "hr"):
                close_block()
            continue
        if name in INLINE:
            if not end:
                stack.append((name, excluded, held, len(doubts)))
                excluded = excluded or _dropped(name, rest)[0] > 0
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        excluded, held = leave(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
            continue
        close_block()
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    excluded, held = leave(k)
                    break
            continue
        cut = len(stack)                                 # a block ends an open paragraph, an item the one before it
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == "p" or stack[k][0] in IMPLIED_ENDS.get(name, ()):
                cut = k
            elif stack[k][0] not in INLINE:
                break
        if cut < len(stack):
            excluded, held = leave(cut)
        stack.append((name, excluded, held, len(doubts)))
        sure, others = _dropped(name, rest) if not excluded else (0, False)
        # an article goes only for its whole name, but one named in part does not speak for the elements around it
        if sure == _CERTAIN or sure == _NAMED and name == "article":
            excluded = True
        elif sure and name != "article":
            doubts.append([len(lines), len(aside), sure, others, False])
        elif name in HOLDERS and not excluded and not sure:
            for doubt in doubts:
                doubt[4] = doubt[4] or name == "main" or doubt[2] == _NAMED_IN_PART
        if name in HOLDERS and not excluded and (name == "main" or not any(d[3] for d in doubts)):
            held = True
    close_block()
    settle(0)
    return [(t, inside) for _, t, inside in lines] or [(t, False) for _, t in sorted(aside)]


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (bit-parallel, one pass over ``b``)."""
    n = len(a)
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << n) - 1
    state, states = full, [full]
    for y in b:
        own = state & places.get(y, 0)
        state = ((state + own) | (state - own)) & full
        states.append(state)
    # zero bits of a state end the common subsequences; walk back through the passes
    out, i = set(), n - 1
    for j in range(len(b), 0, -1):
        while i >= 0 and states[j] >> i & 1:
            i -= 1
        if i < 0:
            break
        if states[j - 1] >> i & 1:                       # the bit fell in this pass: a[i] is matched with b[j - 1]
            out.add(i)
            i -= 1
    return out


_PARSED = "id {id}, url string, row bigint, host string, path string, lines array<string>, " \
          "held array<boolean>, hashes array<bigint>"


def _place(url: str | None) -> tuple[str | None, str]:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (m[1].lower(), m[2]) if m else (None, "")


def parse_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One row per page: host, path, the hashes of its lines outside an article, and if it has such, all its lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = lines_of(page or "")
                free = [xxhash.xxh64_intdigest(t) - (1 << 63) for t, held in lines if not held]
                own = free or not lines
                row = (number, *_place(url), [t for t, _ in lines] if own else None,
                       [inside for _, inside in lines] if own else None, free)
                number += 1
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)] + [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.bool_()),
                    pa.list_(pa.int64())), strict=True)], ["id", "url", "row", "host", "path", "lines", "held", "hashes"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return plain(pages, id=id_col, url=url_col, html=html_col).mapInArrow(run, _PARSED.format(id=id_type))


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def nearest_pages(parsed: DataFrame) -> DataFrame:
    """(row, neighbour): for each page the page before or after it in its host's path order that is nearer."""
    spark = parsed.sparkSession
    places = parsed.filter("host IS NOT NULL").select("host", "path", "row")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield batch.append_column("part", pa.array([part] * n, pa.int64())).append_column(
                "at", pa.array(range(at, at + n), pa.int64()))
            at += n

    ordered = written(places.repartitionByRange(shuffle_partitions(spark), "host", "path", "row")
                      .sortWithinPartitions("host", "path", "row").mapInArrow(
                          number, "host string, path string, row bigint, part bigint, at bigint"), "page-order")
    # neighbours inside a stretch of STRETCH pages, and the borders between stretches: no task gets a whole host
    stretch = F.struct("part", F.floor(F.col("at") / STRETCH).alias("s"))
    inside = ordered.withColumn("stretch", stretch)
    w = Window.partitionBy("stretch").orderBy("at")
    near = inside.select(
        "row", "stretch", "host", "path", "at",
        F.lag(F.struct("host", "path", "row")).over(w).alias("before"),
        F.lead(F.struct("host", "path", "row")).over(w).alias("after"))
    ends = inside.groupBy("stretch").agg(F.min_by(F.struct("host", "path", "row"), "at").alias("first"),
                                         F.max_by(F.struct("host", "path", "row"), "at").alias("last"))
    # one row per STRETCH pages; ordered in blocks of partitions' stretches
    border = written(ends, "page-borders")
    order = Window.orderBy("stretch")
    border = border.select("stretch", F.lag("last").over(order).alias("prior"), F.lead("first").over(order).alias("next"))
    near = near.join(border, "stretch").withColumn("before", F.coalesce("before", "prior")).withColumn(
        "after", F.coalesce("after", "next"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, chosen = [], []
            for r in batch.to_pylist():
                own = [(_common(r["path"], c["path"]), -k, c["row"]) for k, c in enumerate((r["before"], r["after"]))
                       if c and c["host"] == r["host"]]
                if own:
                    rows.append(r["row"])
                    chosen.append(max(own)[2])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(chosen, pa.int64())],
                                             ["row", "neighbour"])

    return near.select("row", "host", "path", "before", "after").mapInArrow(choose, "row bigint, neighbour bigint")


STRETCH = 10_000


def main_text(lines: list[str], held: list[bool], hashes: list[int], other: list[int] | None) -> str:
    """The page's text without the lines outside an article that it shares with its neighbour; if all go, all stay.

    ``hashes`` and ``other`` are those of lines outside an article, of the page and of its neighbour.
    """
    shared = shared_lines(hashes, other) if other else set()
    kept, free = [], 0
    for text, inside in zip(lines, held, strict=True):
        if inside or free not in shared:
            kept.append(text)
        free += not inside
    return " ".join(kept or lines)


def stated_texts(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, text) of the pages whose lines are all inside an ``article`` or ``main`` element."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts = [], []
            for i, page in enumerate(batch.column(2).to_pylist()):
                lines = lines_of(page or "")
                if lines and all(inside for _, inside in lines):
                    at.append(i)
                    texts.append(" ".join(t for t, _ in lines))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows),
                                              pa.array(texts, pa.string())], ["id", "url", "text"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return plain(pages, id=id_col, url=url_col, html=html_col).mapInArrow(run, f"id {id_type}, url string, text string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url and its main text."""
    parsed = written(parse_pages(pages, id_col, url_col, html_col), "page-lines")
    near = nearest_pages(parsed)
    hashes = parsed.select(F.col("row").alias("neighbour"), F.col("hashes").alias("other"))
    open_pages = parsed.filter("lines IS NOT NULL")
    paired = near.join(open_pages.select("row"), "row", "left_semi").join(hashes, "neighbour").select("row", "other")
    rows = open_pages.join(paired, "row", "left").select("id", "url", "lines", "held", "hashes", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(*v) for v in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["id", "url", "text"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, url string, text string").unionByName(
        stated_texts(pages, id_col, url_col, html_col))


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
