"""Main text of web pages: differences between pages with neighbouring URLs, and what pages say of their structure.

A page is cut into lines (blocks). Lines in menus, headers, footers, sidebars, notices, adverts, forms
and comments go by their elements and class names. Every page is then paired with the different page of its host whose URL path
is nearest, both are aligned by a longest common subsequence of lines, and the lines they share are deleted as the site's
template. That holds for every page; where one marks its article, the lines in it are its own and are given back, shared or not, and
the lines outside go, those too that no other page shares.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sealframe.llm.shared import kept, partitions
from sealframe.llm.url_filter import host_of, path_of

# Element and class names of the HTML standard and of common page templates.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
DROPPED = set("head nav footer aside form button select fieldset dialog menu object template noscript svg math canvas audio video "
              "datalist script style title textarea iframe noembed noframes xmp".split())
MAIN = {"article", "main"}
# Dropped elements that an article can stand in.
HOLDS = set("form nav footer aside fieldset dialog menu".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = re.compile(
    r"(?!(?:post|article)[-_]?header)"  # the head of an article belongs to it
    r"(?:(?:site|page|main|top|left|right|bottom|global|primary|secondary|sticky|user|reader|post|article)[-_]?)?"
    r"(?:nav|navbar|navigation|menu|sidebar|side|footer|header|masthead|banner|cookie|consent|gdpr|notice|notification|alert|ad|"
    r"advert|advertisement|advertising|sponsor|sponsored|promo|promotion|comment|disqus|respond|share|sharing|social|related|"
    r"recommended|breadcrumb|newsletter|subscribe|subscription|signup|popup|modal|overlay|login|search|widget|toolbar|pagination|"
    r"pager|skip|copyright)s?"
    r"(?:[-_]?(?:bar|box|area|list|wrap|wrapper|container|section|block|inner|banner|unit|slot|link|links|menu|content|form|thread|"
    r"top|bottom|left|right|\d+))*")
# Elements of which a new one ends an open one of the same group.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|</?[A-Za-z/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def _is_chrome(name: str, attributes: str, in_main: bool, forms: bool) -> bool:
    if (name in DROPPED and not (forms and name == "form")) or (name == "header" and not in_main):
        return True
    if name in ("html", "body") or not attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        # The id of a heading is made from its words.
        if m[1].lower() == "id" and name in HEADINGS:
            continue
        words = (m[2] or m[3] or m[4] or "").lower().split()
        if m[1].lower() == "role":
            if any(w in ROLES for w in words):
                return True
        elif any(NAMES.fullmatch(w) for w in words):
            # A page's one main element may be named after its place; its comments are elements of their own.
            return name != "main"
    return False


def page_blocks(page: str | None) -> tuple[list[str], list[bool], bool]:
    """The lines outside menus and the like, whether each is in a marked article, and whether there is one.

    Character references are decoded, white space is one space, empty lines are left out. Tags that
    are not closed end with the element around them; a tag or comment that the page's end cuts off is
    dropped; a null page has no lines. Where an article stands in a menu or the like, it counts if the
    page marks no other and it has more text than there is outside. A page with lines in forms only
    has those.
    """
    page = page or ""
    lines = _lines(page, False)
    if not lines and "<form" in page.lower():
        lines = _lines(page, True)
    size = [sum(len(line) for line, kind in lines if kind == k) for k in (OUTSIDE, INSIDE, HELD)]
    article = INSIDE if size[INSIDE] else HELD if size[HELD] > size[OUTSIDE] else None
    some = [(line, kind == article) for line, kind in lines if kind in (OUTSIDE, article)]
    return [line for line, _ in some], [own for _, own in some], article is not None


def page_lines(page: str | None) -> tuple[list[str], bool]:
    """The lines of the marked article, or all that ``page_blocks`` gives; and whether there is one."""
    lines, own, marked = page_blocks(page)
    return [line for line, mine in zip(lines, own) if mine or not marked], marked


# Lines outside articles, inside, and inside an article that stands in a menu or the like.
OUTSIDE, INSIDE, HELD = range(3)
# Dropped elements that may hold the page's article, and those that may not.
OPEN, SHUT = 1, 2


def _lines(page: str, forms: bool) -> list[tuple[str, int]]:
    lines: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int, int]] = []  # name, how it is dropped, in an article
    chrome, main = 0, OUTSIDE

    def judged(name: str, attributes: str) -> tuple[int, int]:
        inside = main
        if name in MAIN and not main and chrome != SHUT:
            inside = HELD if chrome and name == "article" else INSIDE
        elif chrome:
            return chrome, main
        if not _is_chrome(name, attributes, bool(main), forms):
            return 0, inside
        # What is dropped from an article has no article of the page.
        return SHUT if main or (name in DROPPED and name not in HOLDS) else OPEN, main

    def close() -> None:
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            if line:
                lines.append((line, main))
            text.clear()

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        if not chrome:
            text.append(page[at:found.start() if found else end])
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        inline = name in INLINE
        if not inline:
            close()
        if found[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            chrome, main = stack[-1][1:] if stack else (0, OUTSIDE)
            continue
        if name in VOID:
            continue
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = closing.end() if closing else end
            continue
        hidden, inside = judged(name, found[3] or "")
        if inline and not (hidden and not chrome):
            continue
        if not inline:
            while stack and stack[-1][0] in ENDS.get(name, {"p"}) | {"p"}:
                stack.pop()
            chrome, main = stack[-1][1:] if stack else (0, OUTSIDE)
            hidden, inside = judged(name, found[3] or "")
        stack.append((name, hidden, inside))
        chrome, main = stack[-1][1:]
    close()
    return lines


PARSED = "page_id bigint, url string, host string, path string, page binary, lines string, own array<boolean>, hashes array<bigint>, marked boolean"


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Of every row of ``pages`` (page_id, url, html) the lines, one text, which of them its article owns, whether it marks one, and
    the hashes of the lines, which are compared; ``page`` is the same for rows of a host with the same lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, hosts, paths, htmls = (batch.column(i) for i in range(5))
            # A few hundred pages at a time, so that their lines stay some MB.
            for first in range(0, batch.num_rows, 256):
                some = [c.slice(first, 256) for c in (ids, urls, hosts, paths)]
                found = [page_blocks(h.as_py()) for h in htmls.slice(first, 256)]
                names = [hashlib.md5("\n".join([h.as_py(), *lines]).encode()).digest() for h, (lines, _, _) in zip(some[2], found)]
                yield pa.RecordBatch.from_arrays(
                    [*some, pa.array(names, pa.binary()), pa.array(["\n".join(lines) for lines, _, _ in found], pa.string()),  # no line has a break
                     pa.array([owned for _, owned, _ in found], pa.list_(pa.bool_())),
                     pa.array([np.array([xxhash.xxh64_intdigest(x) for x in lines], np.uint64).view(np.int64) for lines, _, _ in found], pa.list_(pa.int64())),
                     pa.array([m for _, _, m in found], pa.bool_())], names=["page_id", "url", "host", "path", "page", "lines", "own", "hashes", "marked"])

    url = F.col("url")
    return pages.select(F.col("page_id").cast("bigint"), "url", host_of(url).alias("host"), path_of(url).alias("path"), "html").mapInArrow(run, PARSED)


def _row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and every prefix of ``b``."""
    best = np.zeros(len(b) + 1, np.int32)
    for x in a:
        step = np.where(b == x, best[:-1] + 1, best[1:])
        best[1:] = np.maximum.accumulate(np.maximum(step, best[1:]))
    return best


def shared_lines(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence in both, in memory linear in their lengths."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(np.argmin(same))
    same = a[len(a) - (n - head):][::-1] == b[len(b) - (n - head):][::-1]
    tail = n - head if same.all() else int(np.argmin(same))
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    middle: list[tuple[int, int]] = []
    if len(x) == 1 and len(y):
        at = np.flatnonzero(y == x[0])
        middle = [(0, int(at[0]))] if len(at) else []
    elif len(x) and len(y):
        half = len(x) // 2
        cut = int(np.argmax(_row(x[:half], y) + _row(x[half:][::-1], y[::-1])[::-1]))
        middle = shared_lines(x[:half], y[:cut]) + [(i + half, j + cut) for i, j in shared_lines(x[half:], y[cut:])]
    return [(i, i) for i in range(head)] + [(i + head, j + head) for i, j in middle] + \
        [(len(a) - tail + i, len(b) - tail + i) for i in range(tail)]


# Two pages that share more than this part of the lines that not ``COMMON`` pages of the host around them have are copies, which
# tells nothing about the template.
COPIES, COMMON = 0.8, 3
# Pages on either side that are tried, and pages of a chunk.
REACH, CHUNK = 8, 128
ORDERED = "part int, at bigint, host string, path string, page binary, lines array<bigint>"
SHARED = "page binary, shared array<int>"


def template_lines(parsed: DataFrame) -> DataFrame:
    """``shared``: the places of the lines that each different page shares with its nearest different page.

    Pages with the same lines are one, at the least of their paths. Pages are put in the order of host and path over all
    partitions. Of the REACH pages on either side that are on its host, the nearest of a page is that whose path agrees longest, then the one
    fewer places away, then the one before; near copies are passed over. Pages are compared in chunks of CHUNK that overlap
    by REACH, so neither a large host nor a partition's edge matters. A page with REACH copies and more on both sides has no
    nearest page and loses no line.
    """
    spark = parsed.sparkSession
    # The lines of one row of each; they are the same in all.
    pages = parsed.groupBy("page").agg(F.first("host").alias("host"), F.min("path").alias("path"), F.first("hashes").alias("lines")).select("host", "path", "page", "lines")
    ranged = pages.repartitionByRange(partitions(spark), "host", "path", "page").sortWithinPartitions("host", "path", "page")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), *batch.columns],
                                             names=["part", "at", "host", "path", "page", "lines"])
            at += n

    ordered = kept(ranged.mapInArrow(number, ORDERED))
    # One row per partition of the sort.
    before = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = ordered.join(F.broadcast(before), "part").withColumn("at", F.col("at") + F.col("before"))
    chunked = placed.withColumn("chunk", F.explode(F.sequence(F.floor((F.col("at") - REACH) / CHUNK), F.floor((F.col("at") + REACH) / CHUNK))))

    def compare(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("at").to_pylist(), table.column("host").to_pylist(), table.column("path").to_pylist(),
                          table.column("page").to_pylist(), table.column("lines").to_pylist()), key=lambda r: r[0])
        chunk = table.column("chunk")[0].as_py()
        pages = [np.array(r[4], np.int64) for r in rows]
        found: list[tuple[bytes, list[int]]] = []
        for i, (at, host, path, page, _) in enumerate(rows):
            if at // CHUNK != chunk or not len(pages[i]):
                continue
            near = [j for j in range(max(0, i - REACH), min(len(rows), i + REACH + 1)) if j != i and rows[j][1] == host]
            seen = Counter(x for j in (i, *near) for x in set(rows[j][4]))
            near.sort(key=lambda j: (-_common(path, rows[j][2]), abs(i - j), j))
            for j in near:
                if len(pages[j]) and not _copies(rows[i][4], rows[j][4], seen):
                    pairs = shared_lines(pages[i], pages[j])
                    if pairs:
                        found.append((page, [a for a, _ in pairs]))
                    break
        return pa.table([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.list_(pa.int32()))], names=["page", "shared"])

    return chunked.select("chunk", "at", "host", "path", "page", "lines").groupBy("chunk").applyInArrow(compare, SHARED)


def _copies(a: list[int], b: list[int], seen: Counter) -> bool:
    """Whether one page is the other, give or take some lines. Lines of the template tell nothing; where a page has no others, all lines
    are looked at."""
    own = [{x for x in lines if seen[x] < COMMON} for lines in (a, b)]
    sides = own if all(own) else [set(a), set(b)]
    return len(sides[0] & sides[1]) > COPIES * min(map(len, sides))


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    Lines are joined by a space; a page with none has an empty text. Rows that are repeated stay
    repeated. A null URL has an empty host and path. Pages whose neighbours on the host are all
    copies, or that are alone, lose no line to the comparison.
    """
    parsed = kept(parsed_pages(pages))
    # Every row meets the findings of its page. Texts travel packed, each alone; they are stored as they are, since a file's codec packs
    # many together, and smaller.
    texts = parsed.select("page_id", "url", "page", "lines", "own", "marked").mapInArrow(_packed, PACKED)
    met = texts.join(template_lines(parsed), "page", "left").select("page_id", "url", "lines", "own", "marked", "shared")
    rows = met.mapInArrow(_differing, "page_id bigint, url string, text string")
    return rows.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


PACKED = "page_id bigint, url string, page binary, lines binary, own array<boolean>, marked boolean"
LEVEL = 9


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        lines = pa.array([pack(x.as_py().encode()) for x in batch.column("lines")], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("lines"), "lines", lines)


def _differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that a page does not share, and those of its article; of a page that marks one, only the latter."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        # Some at a time: unpacked, a batch is several times as large.
        for first in range(0, batch.num_rows, 256):
            ids, urls, *packed = (batch.column(i).slice(first, 256) for i in range(batch.num_columns))
            texts = []
            for lines, own, marked, shared in zip(*(c.to_pylist() for c in packed)):
                gone = set(shared or ())
                left = [(line, mine) for i, (line, mine) in enumerate(zip(unpack(lines).decode().split("\n"), own)) if mine or i not in gone]
                texts.append(" ".join(line for line, mine in left if mine or not marked))
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string())], names=["page_id", "url", "text"])
