"""Main text of web pages: markup roles, and differencing against the nearest URL of the host.

A page becomes lines (one per block), each with its role: in the article, boilerplate by its
element (menus, headers, footers, sidebars, forms, scripts, adverts, notices, comments), or open. All lines outside
articles are compared with those of the page whose URL path is nearest on the same host: they are
aligned by longest common subsequence, and what both share is the site's, not the page's. Of these lines the open ones that the
neighbour does not share stay, in their places; lines in an article are kept. Boilerplate goes even where it is the page's own.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import partitions, staged
from lapse.llm.wordarrays import slices

# Element names and class words by role.
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|select"
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary
table tbody tfoot thead tr ul""".split())
SPACES = frozenset("br td th wbr img input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form menu dialog head button audio video canvas fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
DROPPED_WORDS = frozenset("""ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disqus footer gdpr hidden masthead menu modal nav navbar navigation newsletter notice
pager pagination paywall popup promo promoted promotion recommended related replies share sharing sidebar skip social
sponsor sponsored subscribe subscription toolbar tracking widget""".split())
#: Elements whose id may name a part of the page; an id of others, such as headings, names a place in the text.
CONTAINERS = frozenset("div section article ul ol dl table center details".split())
#: What the id of a section in an article says of its role; other words are the section's topic.
RESPONSES = frozenset("comment comments disqus replies".split())
CLOSES_P = BLOCKS - {"html", "body"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(" + RAW + r")\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ARTICLE, OPEN, BOILERPLATE = 0, 1, 2


def _marked_off(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element's name, role or class words say that it is not main text."""
    if name in DROPPED or name == "header" and not in_article:
        return True
    if not attributes or name in ("body", "html", "main"):
        return False
    found = [(key.lower(), value.strip("\"'").lower()) for key, value in _ATTRIBUTE.findall(attributes)]
    section = name == "section" or name == "div" and any(key == "class" and "section" in value.split() for key, value in found)
    for key, value in found:
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDING.search(value):
            return True
        if key == "role" and value in DROPPED_ROLES:
            return True
        if key == "class" or key == "id" and name in CONTAINERS:
            dropped = RESPONSES if key == "id" and section and in_article else DROPPED_WORDS
            for word in value.split():
                parts = re.split(r"[^a-z]+", re.sub(r"\d+", "", word))
                if dropped.intersection(parts) and not {"with", "has", "no", "without", "main", "content"} & {*parts}:
                    return True
    return False


def page_lines(source: str | None) -> list[tuple[str, int]]:
    """(text, role) of each non-empty block in page order, white space folded, references decoded."""
    return [(text, role) for text, role, _ in numbered_lines(source)]


def numbered_lines(source: str | None) -> list[tuple[str, int, int]]:
    """The lines and roles of a page, and the number of the outermost article or main element begun last."""
    out: list[tuple[str, int, int]] = []
    if not source:
        return out
    stack: list[tuple[str, bool, bool]] = []  # name, marks off, is an article
    off = inside = nth = 0
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            out.append((text, BOILERPLATE if off else ARTICLE if inside else OPEN, nth))

    def pop_to(at: int) -> None:
        nonlocal off, inside
        for _, marks, article in stack[at:]:
            off -= marks
            inside -= article
        del stack[at:]

    last = 0
    for m in _TAG.finditer(source):
        if m.start() > last:
            pieces.append(source[last:m.start()])
        last = m.end()
        name = m[3]
        if not name:
            continue
        name = name.lower()
        block = name in BLOCKS
        if block:
            flush()
        elif name in SPACES:
            pieces.append(" ")
        if m[2]:
            if name == "p" and not any(n == "p" for n, _, _ in stack):
                continue
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    if not block:
                        flush() if any(marks for _, marks, _ in stack[at:]) else None
                    pop_to(at)
                    break
            continue
        if name in VOID:
            continue
        if name in CLOSES_P and stack and stack[-1][0] == "p":
            pop_to(len(stack) - 1)
        attributes = m[4]
        marks = _marked_off(name, attributes, bool(inside)) if attributes or block or name in DROPPED else False
        if marks and not block:
            flush()
        if block or marks or name in ("td", "th"):
            article = name in ("article", "main") and not marks
            stack.append((name, marks, article))
            off += marks
            nth += article and not inside
            inside += article
    if last < len(source):
        pieces.append(source[last:])
    flush()
    return out


def parts_of(source: str | None) -> tuple[list[str], list[int], list[int], list[int], int | None]:
    """A page's text and its frame: (lines of articles and open ones, the place of each in the frame or -1 in an article, hashes of
    the frame's lines, places of the open ones among them, hash of the articles' text). The frame are all lines outside articles."""
    texts, at, frame, opened, own = [], [], [], [], []
    for text, role, _ in numbered_lines(source):
        if role == ARTICLE:
            texts.append(text), at.append(-1), own.append(text)
            continue
        if role == OPEN:
            texts.append(text), at.append(len(frame)), opened.append(len(frame))
        frame.append(_hash(text))
    return texts, at, frame, opened, _hash("\n".join(own)) if own else None


def shared_lines(mine: list[int], other: list[int]) -> list[int]:
    """Indexes of ``mine`` on a longest common subsequence with ``other``.

    Matches are taken in order of ``mine``; the smallest last place in ``other`` of each length of
    subsequence is kept sorted, so each match costs one binary search.
    """
    places = defaultdict(list)
    for j in range(len(other) - 1, -1, -1):
        places[other[j]].append(j)
    ends: list[int] = []
    links: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(mine):
        for j in places.get(line, ()):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    out: list[int] = []
    link = links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*|[?#].*$", "")


def neighbours(faces: DataFrame, keys: list[str], value: Column, group: str) -> DataFrame:
    """``faces`` with ``before`` and ``after``: the value of the previous and next row by ``keys``, within ``group``.

    Rows are range-partitioned, so a group of any size spreads over many tasks; the value
    across a partition's edge comes from a table of each partition's first and last row.
    """
    n = partitions(faces.sparkSession)
    placed = staged(faces.repartitionByRange(n, *keys).withColumn("pid", F.spark_partition_id()), "faces")
    held = F.struct(F.col(group).alias("g"), value.alias("v"))
    order = Window.partitionBy("pid").orderBy(*keys)
    rows = placed.withColumns({"before": F.lag(held).over(order), "after": F.lead(held).over(order)})
    sort_key = F.struct(*keys)
    edges = placed.groupBy("pid").agg(F.min_by(held, sort_key).alias("first"), F.max_by(held, sort_key).alias("last"))
    line = Window.orderBy("pid")  # one row per partition
    edges = edges.select("pid", F.lag("last").over(line).alias("edge_before"), F.lead("first").over(line).alias("edge_after"))
    rows = rows.join(edges, "pid")

    def near(own: str, edge: str) -> Column:
        c = F.coalesce(F.col(own), F.col(edge))
        return F.when(c["g"] == F.col(group), c["v"])

    return rows.select(*faces.columns, near("before", "edge_before").alias("before"), near("after", "edge_after").alias("after"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty html gives an empty text. A null url counts as host "" and path "". Rows are
    independent of ids, which may be null or repeat; pages of one url with the same lines outside articles and the same articles are one
    page when pages are paired. Very long pages are taken a few megabytes at a time. A page all of whose open lines are shared is a copy of its
    neighbour and keeps them, unless its article differs. An empty table gives an empty result. Other columns are ignored.
    """
    kind = pages.select(F.col(id_col).alias("page_id")).schema[0].dataType.simpleString()
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def faces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                host, path, lines, places, article = [], [], [], [], []
                for h, p, source in zip(part.column("host").to_pylist(), part.column("path").to_pylist(), part.column("html").to_pylist()):
                    _, _, frame, opened, own = parts_of(source)
                    if frame:
                        host.append(h), path.append(p), lines.append(frame), places.append(opened), article.append(own)
                yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(lines, pa.list_(pa.int64())),
                                                  pa.array(places, pa.list_(pa.int32())), pa.array(article, pa.int64())],
                                                 ["host", "path", "lines", "opened", "article"])

    faces = base.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "html").mapInArrow(
        faces_of, "host string, path string, lines array<long>, opened array<int>, article long")
    # pages of one url with the same lines are one face; the digest stands for the lines
    digest = F.xxhash64("lines", F.size("lines"), "opened", "article").alias("digest")
    faces = faces.groupBy("host", "path", digest).agg(
        F.first("lines").alias("lines"), F.first("opened").alias("opened"), F.first("article").alias("article"))
    near = neighbours(faces, ["host", "path", "digest"], F.struct("path", "lines", "article"), "host")

    def shared_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def alike(a: str, b: dict | None) -> int:
            if b is None:
                return -1
            n = 0
            for x, y in zip(a, b["path"]):
                if x != y:
                    break
                n += 1
            return n

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                pair = r["before"] if alike(r["path"], r["before"]) >= alike(r["path"], r["after"]) else r["after"]
                shared = shared_lines(r["lines"], pair["lines"]) if pair else []
                mine = [*{*shared} & {*r["opened"]}]
                copy = len(mine) == len(r["opened"]) and (r["article"] is None or pair and pair["article"] == r["article"])
                out.append([] if copy else mine)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("path"), batch.column("digest"),
                                              pa.array(out, pa.list_(pa.int32()))], ["host", "path", "digest", "shared"])

    shared = near.mapInArrow(shared_of, "host string, path string, digest long, shared array<int>")
    shared = staged(shared.where(F.size("shared") > 0), "shared-lines")

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts, places, lines, opened, article = ([], [], [], [], [])
                for source in part.column("html").to_pylist():
                    for out, x in zip((texts, places, lines, opened, article), parts_of(source)):
                        out.append(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host"), part.column("path"),
                     pa.array(texts, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32())), pa.array(lines, pa.list_(pa.int64())),
                     pa.array(opened, pa.list_(pa.int32())), pa.array(article, pa.int64())],
                    ["page_id", "url", "host", "path", "texts", "at", "lines", "opened", "article"])

    texts = base.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))}).mapInArrow(
        texts_of, f"page_id {kind}, url string, host string, path string, texts array<string>, at array<int>, lines array<long>,"
                  " opened array<int>, article long")
    texts = texts.select("page_id", "url", "host", "path", F.arrays_zip("texts", "at").alias("found"), digest)
    rest = F.filter("found", lambda x: ~F.array_contains(F.coalesce("shared", F.array().cast("array<int>")), x["at"]))
    text = F.array_join(F.transform(rest, lambda x: x["texts"]), "\n")
    out = texts.join(shared, ["host", "path", "digest"], "left").withColumn("text", text)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
