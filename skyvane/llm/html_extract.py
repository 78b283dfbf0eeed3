"""Main text of web pages by nearest-URL page differencing.

Each page becomes its text lines (one per block element) with the place they stand in:
page furniture (navigation, header, footer, aside, form, or a class, id or role that
says so), a declared article (article, main, role=main, articleBody), or the plain body. A class or
id says so as a whole name only ('ad', 'sidebar-left', 'cookie-notice'; not 'has-sidebar' or
'search-results', which say nothing). A class or form that holds most of the text of a page without a
declared article is not furniture, nor is an article or main for its class, but for articles
inside furniture or another article (comments, teasers). Pages of a host
are ordered by URL path; a page's partner is the neighbour with the longer common
path prefix. The two pages' lines are aligned by their longest common subsequence, and
what they share is template and deleted.

A neighbour is no evidence against a line of a declared article: two articles may share a sentence. There the
alignment only names candidates, and one goes if the host shows it to be template: it stands in the same
half of the article on most of the host's pages, three at least. Spark counts that per (host, line),
and the line then goes from every page of the host that has it, whatever its neighbours are. A page that would lose more
than half of its article this way is one of many copies and keeps it. Outside an
article what the neighbours share goes, unless that is every line; text outside a declared article stays
if the partner lacks it, and a page without a partner has no evidence but its tags and keeps the article alone.
Furniture never counts as text: its slots are the template even where their words rotate from page to page.

Scale: a host may hold a third of all pages, so hosts are not groups. Line hashes
(not texts) are range-partitioned by (host, path) and compared while they stream in order; the
few pages at the ends of a range meet their neighbours in a second pass over four rows a range.

Defined cases: null html or url counts as empty; an empty or text-free page gives an
empty string; equal pages and equal ids stay separate rows; a host with one page has no partner; an
empty table gives an empty result; extra columns are ignored; unclosed tags end with
their parent; white space (Unicode) inside a block is one space.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read, small
from skyvane.session import materialize, scratch_path

BODY, ARTICLE, CHROME, NAMED = 0, 1, 2, 3
BROADCAST_ROWS = 100_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "title",
        "select", "button", "audio", "video", "map", "xmp", "noembed", "noframes",
        "annotation", "annotation-xml"}
#: elements of _RAW whose content is no markup: an unclosed one ends with the page
_OPAQUE = {"script", "style", "noscript", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
_FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
          "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
          "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption"}
_BOX = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset", "figure",
        "footer", "form", "head", "header", "li", "main", "menu", "nav", "ol", "p", "section", "span", "table", "td", "ul"}
#: class, id and role words that mark furniture
_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
          "banner", "sidebar", "side", "comment", "comments", "reply", "replies", "disqus", "respond", "cookie", "cookies",
          "consent", "gdpr", "notice", "notices", "alert", "newsletter", "subscribe", "subscription", "signup", "login",
          "share", "sharing", "social", "related", "recommended", "breadcrumb", "breadcrumbs", "pagination", "pager",
          "menu", "nav", "navbar", "navigation", "footer", "popup", "modal", "overlay", "widget", "toolbar", "search",
          "contentinfo", "complementary", "masthead", "topbar", "skip", "copyright", "disclaimer"}
#: what else may stand in the name of such a box
_PLAIN = {"left", "right", "top", "bottom", "first", "last", "main", "primary", "secondary", "site", "page", "global", "post", "entry",
          "article", "blog", "box", "block", "bar", "area", "wrap", "wrapper", "container", "section", "inner", "outer", "body", "list",
          "item", "items", "link", "links", "posts", "articles", "stories", "button", "buttons", "icon", "icons", "form", "slot", "unit",
          "text", "title", "message", "header", "head", "content"}
_PAGE_HEADER = {"header", "head"}


def _names_furniture(name: str) -> bool:
    """Is this whole class, id or role the name of page furniture ('sidebar-left', not 'has-sidebar')?"""
    parts = [x for x in re.split(r"[^a-z0-9]+", name) if x and not x.isdigit()]
    return any(x in _WORDS for x in parts) and all(x in _WORDS or x in _PLAIN for x in parts) \
        and not (parts[0] in ("content", "body", "text") and len(parts) > 1)


def _names_header(name: str) -> bool:
    parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
    return any(x in _PAGE_HEADER for x in parts) and all(x in _PLAIN for x in parts)


def _marker(tag: str, attrs: str, in_article: bool, in_chrome: bool) -> int | None:
    """Does this element mark furniture or a declared article? None: it says nothing. NAMED: furniture
    unless it holds most of the text."""
    names: list[str] = []
    if attrs and "=" in attrs or "hidden" in attrs:
        for name, *value in _ATTR.findall(attrs):
            v, name = "".join(value).lower(), name.lower()
            if name == "hidden" or name == "aria-hidden" and v == "true":
                return CHROME
            if name == "role" and v == "main" or name == "itemprop" and v == "articlebody":
                return ARTICLE
            if name in ("class", "id", "role"):
                names += v.split()
    if tag == "main":
        return ARTICLE
    if any(map(_names_furniture, names)) and (tag != "article" or in_article or in_chrome):
        return NAMED if tag not in _FURNITURE or tag == "form" else CHROME
    if tag in _FURNITURE and not (tag == "header" and in_article):
        return NAMED if tag == "form" else CHROME
    if tag == "article":
        return ARTICLE
    return NAMED if not in_article and any(map(_names_header, names)) else None


def page_lines(source: str | None) -> tuple[list[str], list[int]]:
    """The text blocks of a page in order, and where each stands."""
    unmarked: set[int] = set()
    while True:
        lines, kinds, held = _lines(source or "", unmarked)
        half = sum(map(len, lines)) / 2
        most = [k for k, n in held.items() if n > half]
        if not most or ARTICLE in kinds or sum(len(x) for x, k in zip(lines, kinds) if k != CHROME) > half:
            return lines, kinds
        unmarked.add(min(most))


def _skip(source: str, tag: str, at: int, broken: dict[str, bool]) -> int:
    """Where the element that was opened before ``at`` ends; an unclosed one is empty unless it is opaque.
    ``broken``: tags that don't balance in the rest of the page, and whether any end is left; they are not counted again."""
    if tag in _OPAQUE:
        close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
        return close.end() if close else len(source)
    if broken.get(tag) is False:
        return at
    depth, first = 1, None
    for m in re.compile(rf"<(/?){tag}(?![\w:-])[^>]*>?", re.I).finditer(source, at):
        if m[1]:
            depth, first = depth - 1, first or m.end()
            if not depth or tag in broken:
                return m.end()
        elif tag in ("button", "select"):           # these don't nest: the next one ends an unclosed one
            return at
        elif not m[0].endswith("/>"):
            depth += 1
    broken[tag] = first is not None
    return first or at


def _lines(source: str, unmarked: set[int]) -> tuple[list[str], list[int], dict[int, int]]:
    """Lines, kinds and how much text each box marked by its name holds; boxes in ``unmarked`` (by place) are not marked."""
    lines: list[str] = []
    kinds: list[int] = []
    held: dict[int, int] = {}
    broken: dict[str, bool] = {}
    stack: list[tuple[str, int, int]] = []      # open boxes, the kind inside them, their place if marked by name
    kind, text, at, n = BODY, [], 0, len(source)

    def block() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                lines.append(line)
                kinds.append(kind)
                for box in stack if held else ():
                    if box[2] >= 0:
                        held[box[2]] += len(line)
            text.clear()

    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            text.append(source[at:])
            break
        if m.start() > at:
            text.append(source[at:m.start()])
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if not end and tag in _RAW and not attrs.endswith("/"):
            at = _skip(source, tag, at, broken)
            continue
        if tag in _BLOCK:
            block()
        if tag not in _BOX:
            continue
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag == "span" and stack[k][1] != kind:
                        block()
                    del stack[k:]
                    break
            now = stack[-1][1] if stack else BODY
        else:
            if attrs.endswith("/"):
                continue
            if tag in ("p", "li") and stack and stack[-1][0] == tag:
                stack.pop()
            now, place = _marker(tag, attrs, any(b[1] == ARTICLE for b in stack), bool(stack) and stack[-1][1] == CHROME), -1
            if now is not None and tag == "span":
                block()
            if now == NAMED:
                now = None if at in unmarked else CHROME
                if now == CHROME:
                    place = at
                    held[at] = 0
            if now is None:
                now = stack[-1][1] if stack else BODY
            stack.append((tag, now, place))
        if now != kind:
            block()
            kind = now
    block()
    return lines, kinds, held


def lcs(a: list, b: list) -> list[int]:
    """Places of ``a`` on a longest common subsequence with ``b``. Linear memory (Hirschberg) over
    bit-parallel length rows; lines that the other page lacks are left out first."""
    out: list[int] = []
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < min(hi_a, hi_b) and a[lo] == b[lo]:
        out.append(lo)
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
        out.append(hi_a)
    both = set(a[lo:hi_a]) & set(b[lo:hi_b])
    if not both:
        return sorted(out)
    pa_, x = zip(*[(i, a[i]) for i in range(lo, hi_a) if a[i] in both])
    y = [k for k in b[lo:hi_b] if k in both]

    def lengths(p, q) -> np.ndarray:
        mask: dict = {}
        for j, k in enumerate(q):
            mask[k] = mask.get(k, 0) | 1 << j
        full = (1 << len(q)) - 1
        v = full
        for k in p:
            u = v & mask.get(k, 0)
            v = ((v + u) | (v - u)) & full
        bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-len(q) // 8), "little"), np.uint8), bitorder="little")[:len(q)]
        return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])

    todo = [(0, len(x), 0, len(y))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a1 <= a0 or b1 <= b0:
            continue
        if a1 - a0 == 1:
            if x[a0] in y[b0:b1]:
                out.append(pa_[a0])
            continue
        mid = (a0 + a1) // 2
        head = lengths(x[a0:mid], y[b0:b1])
        tail = lengths(x[mid:a1][::-1], y[b0:b1][::-1])[::-1]
        k = int(np.argmax(head + tail))
        todo += [(a0, mid, b0, b0 + k), (mid, a1, b0 + k, b1)]
    return sorted(out)


def kept_lines(kinds: np.ndarray, sizes: np.ndarray, shared: list[int] | None, template: np.ndarray | None = None) -> np.ndarray:
    """Which lines are the main text, given the lines shared with the partner (None: no partner) and
    the article lines that the host shows to be template."""
    text = kinds != CHROME
    article = kinds == ARTICLE
    if shared is None:
        declared = article.any() and 2 * sizes[article].sum() >= sizes[text].sum()
        left = article if declared else text
    else:
        left = text.copy()
        left[shared] = False
        left = left | article
        left = left if left.any() else text
    if template is not None and len(template):
        rest = left.copy()
        rest[template] = False
        if 2 * sizes[rest & article].sum() >= sizes[article].sum():         # else one of many copies
            left = rest
    return left


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and the path with its query; no host: empty."""
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\s]*)([^#]*)", url or "")
    return (m[1].rpartition("@")[2].lower(), m[2].strip() or "/") if m else ("", (url or "").strip())


def _parse(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        rows = []
        for source, url in zip(b.column(2).to_pylist(), b.column(1).to_pylist()):
            lines, kinds = page_lines(source)
            host, path = split_url(url)
            keys = b"".join(hashlib.blake2b(x.encode(), digest_size=8).digest() for x in lines)
            rows.append((host, path, "\n".join(lines), bytes(kinds),
                         np.array([len(x) for x in lines], "<i4").tobytes(), keys))
        cols = list(zip(*rows)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), *[pa.array(c, pa.string()) for c in cols[:3]],
             *[pa.array(c, pa.binary()) for c in cols[3:]], ],
            names=["page_id", "url", "host", "path", "lines", "kinds", "sizes", "keys"])


def _places(kept: np.ndarray) -> bytes:
    return np.flatnonzero(kept).astype("<i4").tobytes()


def _differenced(page: tuple, before: tuple | None, after: tuple | None) -> tuple[bytes | None, bytes | None]:
    """The places of the lines that stay, as packed 32-bit numbers (None if the partner changes nothing), and the keys of
    the article lines that the partner has too."""
    _, host, path, kinds, sizes, keys = page

    def common(other: tuple | None) -> int:
        if other is None or other[1] != host:
            return -1
        n = min(len(path), len(other[2]))
        return next((i for i in range(n) if path[i] != other[2][i]), n)

    x, y = common(before), common(after)
    if max(x, y) < 0:
        return None, None
    k, s, own = np.frombuffer(kinds, np.uint8), np.frombuffer(sizes, "<i4"), np.frombuffer(keys, "<i8")
    other = before if x >= y else after
    shared = np.array(lcs(own.tolist(), np.frombuffer(other[5], "<i8").tolist()), np.int64)
    kept = _places(kept_lines(k, s, shared))
    both = np.unique(own[shared[k[shared] == ARTICLE]])
    return None if kept == _places(kept_lines(k, s, None)) else kept, both.tobytes() if len(both) else None


_ROW = ["rid", "host", "path", "kinds", "sizes", "keys"]
_DECIDED = "rid long, kept binary, both binary, first boolean, host string, path string, kinds binary, sizes binary, keys binary"


def _rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in it:
        yield from zip(*[b.column(c).to_pylist() for c in _ROW])


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=[c.split()[0] for c in _DECIDED.split(", ")])


def _compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in URL order; pages that their partner changes go out. The two rows at
    each end also go out whole: ``first`` is true for the outermost ones, whose other neighbour
    lies in another range (decided later)."""
    out: list[tuple] = []
    before: tuple | None = None
    rows = _rows(it)
    page, after, number = next(rows, None), next(rows, None), 0
    while page is not None:
        nxt = next(rows, None) if after is not None else None
        outer = number == 0 or after is None
        inner = number == 1 or after is not None and nxt is None
        kept, both = (None, None) if outer else _differenced(page, before, after)
        if outer or inner:
            out.append((page[0], kept, both, outer, *page[1:]))
        elif kept is not None or both is not None:
            out.append((page[0], kept, both, None, page[1], None, None, None, None))
        if len(out) >= 512:
            yield _emit(out)
            out = []
        before, page, after, number = page, after, nxt, number + 1
    if out:
        yield _emit(out)


def _finish(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ends of all ranges in URL order: decide the outermost rows."""
    seq = []
    for b in it:
        seq += list(zip(*[b.column(c).to_pylist() for c in [*_ROW, "first"]]))
    out = []
    for i, row in enumerate(seq):
        if row[6]:
            kept, both = _differenced(row[:6], seq[i - 1][:6] if i else None, seq[i + 1][:6] if i + 1 < len(seq) else None)
            if kept is not None or both is not None:
                out.append((row[0], kept, both, row[1]))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.string()))], names=["rid", "kept", "both", "host"])


_LINE = "rid long, host string, key long, tail boolean, place int"


def _article_lines(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, half of the article and place of every article line of (rid, host, kinds, keys)."""
    for b in it:
        rows, at, tail, keys = [], [], [], []
        for i, (kinds, own) in enumerate(zip(b.column("kinds").to_pylist(), b.column("keys").to_pylist())):
            places = np.flatnonzero(np.frombuffer(kinds, np.uint8) == ARTICLE)
            rows.append(np.full(len(places), i))
            at.append(places)
            tail.append(2 * np.arange(len(places)) >= len(places))
            keys.append(np.frombuffer(own, "<i8")[places])
        if rows:
            of = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [b.column("rid").take(of), b.column("host").take(of), pa.array(np.concatenate(keys)), pa.array(np.concatenate(tail)),
                 pa.array(np.concatenate(at), pa.int32())], names=[c.split()[0] for c in _LINE.split(", ")])


def template_lines(table: DataFrame, decided: DataFrame) -> DataFrame:
    """(rid, template): the places of each page's article lines that the host shows to be template. ``table``:
    rid, host, kinds, keys of all pages; ``decided``: host and ``both``, the candidates' keys."""
    split = F.arrow_udf(lambda col: pa.array([np.frombuffer(x, "<i8") for x in col.to_pylist()], pa.list_(pa.int64())), "array<long>")
    candidates = small(materialize(decided.filter("both is not null").select("host", F.explode(split("both")).alias("key")).distinct(),
                                   "line-candidates"))
    lines = materialize(table.select("rid", "host", "kinds", "keys").mapInArrow(_article_lines, _LINE).join(candidates, ["host", "key"]),
                        "shared-lines")
    hosts = table.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    # a page counts once for a line and half
    held = lines.groupBy("host", "key", "tail", "rid").agg(F.lit(1).alias("one")).groupBy("host", "key", "tail").agg(F.count(F.lit(1)).alias("n"))
    shown = materialize(held.filter("n >= 3").join(hosts, "host").filter(2 * F.col("n") > F.col("pages")).select("host", "key").distinct(),
                        "template-lines")
    return lines.join(small(shown), ["host", "key"], "left_semi").groupBy("rid").agg(F.collect_set("place").alias("template"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = begin(pages.sparkSession)
    path = scratch_path(spark, "page-lines")
    (pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
     .mapInArrow(_parse, pages.select("page_id").schema.add("url", "string").add("host", "string").add("path", "string")
                 .add("lines", "string").add("kinds", "binary").add("sizes", "binary").add("keys", "binary"))
     .withColumn("rid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path))
    table = spark.read.parquet(path)
    order = ["host", "path", "rid"]
    compared = scratch_path(spark, "page-decisions")
    (table.select(*_ROW).repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(_compare, _DECIDED).write.option("compression", "zstd").parquet(compared))
    decided = spark.read.parquet(compared)
    ends = decided.filter("first is not null").select(*_ROW, "first")                      # four rows a range at most
    finished = ends.repartition(1).sortWithinPartitions(*order).mapInArrow(_finish, "rid long, kept binary, both binary, host string")
    found = materialize(decided.select("rid", "kept", "both", "host").filter("kept is not null or both is not null")
                        .unionByName(finished), "page-changes")
    changed = found.filter("kept is not null").select("rid", "kept")
    if found.filter("both is not null").limit(1).count():
        changed = materialize(changed.join(template_lines(table, found), "rid", "full"), "page-lines-left")
    else:
        changed = changed.withColumn("template", F.lit(None).cast("array<int>"))

    def choose(lines: pa.Array, kinds: pa.Array, sizes: pa.Array, places: pa.Array, template: pa.Array) -> pa.Array:
        out = []
        for text, k, s, p, t in zip(*[x.to_pylist() for x in (lines, kinds, sizes, places, template)]):
            split = text.split("\n") if text else []
            k, s = np.frombuffer(k, np.uint8), np.frombuffer(s, "<i4")
            t = None if t is None else np.array(t, np.int64)
            if p is None:
                stay = kept_lines(k, s, None, t)
            else:
                gone = np.ones(len(k), bool)
                gone[np.frombuffer(p, "<i4")] = False
                stay = kept_lines(k, s, np.flatnonzero(gone & (k != CHROME)), t)
            out.append("\n".join([split[i] for i in np.flatnonzero(stay).tolist()]))
        return pa.array(out, pa.string())

    # Few pages change on sites that declare their article; then the texts need not be moved. The size is counted.
    if changed.count() <= BROADCAST_ROWS:
        changed = F.broadcast(changed)
    joined = table.select("rid", "page_id", "url", "lines", "kinds", "sizes").join(changed, "rid", "left")
    return joined.select("page_id", "url", F.arrow_udf(choose, "string")("lines", "kinds", "sizes", "kept", "template").alias("text")
                         ).withColumn("n_chars", F.char_length("text").cast("long"))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
