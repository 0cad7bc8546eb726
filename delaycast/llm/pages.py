"""The main text of web pages by page differencing, checked by what the markup says.

A page is cut into text lines (one for each block), menus and all. It is paired with
the page of its host whose URL path is nearest, the lines of both are aligned by a
longest common subsequence, and shared ones are those of the template. A pair that
shares over 0.8 of a page's words outside its frame is a pair of copies and tells
nothing of the template; the page on the other side is taken instead.

An exact check follows, as neighbours may share passages and may have menus of their
own: lines of containers that name themselves as frame (menus, footers, forms, adverts,
reader comments and the like) go also if no neighbour has them, and where a page
declares its article, the lines within stay also if a neighbour has them, and no others.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kit import lean, stored

# Fixed values of the HTML standard: elements without an end tag, and elements that start a line of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
                   "summary table tbody td tfoot th thead title tr ul".split())
CLOSED_BY_BLOCK = frozenset({"p"})
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

#: Elements that are never main text, and words in class, id or role that say the same of any element.
FRAME = frozenset("head title nav footer aside menu dialog button select textarea iframe object canvas svg audio video applet search noscript".split())
FRAME_NAME = re.compile(
    r"^(?!(?:has|with|no|without)[-_])(?:.*[-_])?(?:ad|ads|advert|adverts|advertisement|advertisements|advertising|banner|sponsor|sponsored|promo|promotion|"
    r"sidebar|widget|widgets|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|footer|cookie|cookies|consent|gdpr|notice|notices|newsletter|subscribe|"
    r"share|sharing|social|comment|comments|disqus|respond|related|recommended|popup|modal|login|signup|search|toolbar|pagination|pager|skip)(?:[-_].*)?$")
COMMENT_NAME = re.compile(r"^(?:.*[-_])?comments?(?:[-_].*)?$")
HEADER_NAME = re.compile(r"^(?:site|page|top)?[-_]?(?:header|masthead)$")
MAIN_NAME = re.compile(r"^(?:main|article|articlebody|article[-_]body|post[-_]body|post[-_]content|entry[-_]content|article[-_]content)$")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>", re.S | re.I)
NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

OPEN, MAIN, FORM, DROPPED = 0, 1, 2, 3  # what an element says of its text: nothing, main text, main text if an inner element says so, no


def zone_of(name: str, attributes: str, zone: int) -> int:
    """The zone within an element that stands in `zone`."""
    if zone == DROPPED:
        return zone
    names = [n for groups in NAMED.findall(attributes) for g in groups for n in g.lower().split()] if "=" in attributes else []
    if name in ("article", "main"):
        return DROPPED if any(map(COMMENT_NAME.match, names)) else MAIN
    if name in ("html", "body"):
        return zone
    if name in FRAME or any(map(FRAME_NAME.match, names)):
        return DROPPED
    if any(map(MAIN_NAME.match, names)):
        return MAIN
    if zone != MAIN and (name == "header" or any(map(HEADER_NAME.match, names))):
        return DROPPED
    return FORM if name == "form" else zone


def lines(html: str) -> list[tuple[str, int]]:
    """The text lines of a page, each with OPEN, MAIN (the page declares it main text) or DROPPED."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    dropped: list[str] = []
    stack: list[tuple[str, int]] = []
    zone = held_zone = at = 0

    def end() -> None:
        for parts, of in ((held, held_zone), (dropped, DROPPED)):
            text = " ".join(unescape("".join(parts)).split()) if parts else ""
            parts.clear()
            if text:
                out.append((text, of))

    def add(text: str) -> None:
        nonlocal held_zone
        if zone > MAIN:
            dropped.append(text)
            return
        if zone != held_zone:
            end()
            held_zone = zone
        held.append(text)

    def cut(to: int) -> None:
        nonlocal zone
        del stack[to:]
        zone = stack[-1][1] if stack else OPEN

    for m in TOKEN.finditer(html):
        add(html[at: m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing, attributes = (m[2], m[4]) if m[3] else (m[5], m[7])
        if name in BLOCKS:
            end()
            if not closing:
                last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS), None)
                if last is not None and stack[last][0] in CLOSED_BY_BLOCK and name != "br":
                    cut(last)
        if closing:
            open_at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if open_at is not None:
                cut(open_at)
        elif name not in VOID:
            around = CLOSED_BY_SAME.get(name)
            if around:
                near = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name or stack[i][0] in around), None)
                if near is not None and stack[near][0] == name:
                    cut(near)
            if not (attributes or "").endswith("/") or name in BLOCKS:
                zone = zone_of(name, attributes or "", zone)
                stack.append((name, zone))
    add(html[at:])
    end()
    return out


def codes_of(found: list[tuple[str, int]]) -> list[int]:
    """A number for each line; a line of the frame is never the same as one outside."""
    return [int.from_bytes(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8, person=b"frame" if z > MAIN else b"").digest(), "little", signed=True) for t, z in found]


def ends_of(a: list, b: list) -> list[int]:
    """For each j, the length of a longest common subsequence of a and b[:j] (bits of one long integer stand for b)."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    out = [0]
    for bit in reversed(f"{row:0{len(b)}b}") if b else "":
        out.append(out[-1] + (bit == "0"))
    return out


def shared(a: list, b: list) -> list[int]:
    """The places in `a` of a longest common subsequence of a and b, in memory that grows with their lengths only."""
    out, parts = [], [(0, a, b)]
    while parts:
        at, a, b = parts.pop()
        while a and b and a[0] == b[0]:
            out.append(at)
            at, a, b = at + 1, a[1:], b[1:]
        while a and b and a[-1] == b[-1]:
            out.append(at + len(a) - 1)
            a, b = a[:-1], b[:-1]
        if not a or not b:
            continue
        if len(a) == 1:
            out += [at] * (a[0] in b)
            continue
        half = len(a) // 2
        left, right = ends_of(a[:half], b), ends_of(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: left[j] + right[len(b) - j])
        parts += [(at, a[:half], b[:cut]), (at + half, a[half:], b[cut:])]
    return sorted(out)


def template_lines(codes: list[int], words: list[int], other: list[int] | None, most: float) -> list[int] | None:
    """Places of the lines that a page shares with another; None if that is a copy or there is none."""
    if other is None or not len(other):
        return None
    kept = set(codes) & set(other)
    mine = [i for i, c in enumerate(codes) if c in kept]
    found = [mine[i] for i in shared([codes[i] for i in mine], [c for c in other if c in kept])]
    return found if sum(words[i] for i in found) <= most * sum(words) else None


def common_start(a: str, b: str | None) -> int:
    if b is None:
        return -1
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def placed(keys: DataFrame, by: list[str]) -> DataFrame:
    """`keys` with `place`: whole numbers without gaps in the order `by`, by a sort over all tasks and the sums of their sizes."""
    rows = stored(keys.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id()), "sorted")
    task = F.shiftright("place", 33)
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    sizes = rows.groupBy(task.alias("task")).agg(F.count("*").alias("m")).select("task", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    rows = rows.withColumn("task", task).join(F.broadcast(sizes), "task")
    return rows.withColumn("place", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("task", "before")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def differenced(found: DataFrame, most: float = 0.8) -> DataFrame:
    """host, whole and gone (places of template lines) of each different page of a host; `found` has (url, codes, words) of all
    pages, where a line of the frame counts no words, and `whole` is the hash of `codes`.

    Pages of a host that differ in their frames only count as one. Of the pages before and after a page in the order of host
    and path, one has the longest common start of its path; it comes first, the other one if the first is a copy.
    """
    seen = found.select(*host_and_whole(), path_of(F.coalesce("url", F.lit(""))).alias("path"), "codes", "words")
    seen = stored(seen.groupBy("host", "whole").agg(F.min(F.struct("path", "codes", "words")).alias("x")).select("host", "whole", "x.*"), "lines")
    seen = seen.withColumn("print", F.xxhash64(F.filter("codes", lambda c, i: F.get("words", i) > 0)))
    keys = seen.groupBy("host", "print").agg(F.min(F.struct("path", "codes")).alias("x")).select("host", "print", "x.*")
    keys = placed(keys, ["host", "path", "print"])
    near = keys.drop("codes")
    for name, step in (("before", -1), ("after", 1)):
        other = keys.select((F.col("place") - step).alias("place"), F.col("host").alias(f"{name}_host"), F.col("path").alias(f"{name}_path"), F.col("codes").alias(name))
        near = near.join(other, "place", "left")
        near = near.withColumns({c: F.when(F.col(f"{name}_host") == F.col("host"), F.col(c)) for c in (name, f"{name}_path")}).drop(f"{name}_host")

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            gone = []
            for r in f.itertuples():
                codes, words = r.codes.tolist(), r.words.tolist()
                sides = [(r.before_path, r.before), (r.after_path, r.after)]
                sides.sort(key=lambda s: -common_start(r.path, s[0]))
                tried = (template_lines(codes, words, None if s[1] is None else s[1].tolist(), most) for s in sides)
                gone.append(next((t for t in tried if t is not None), []))
            yield pd.DataFrame({"host": f["host"], "whole": f["whole"], "gone": gone})

    pairs = seen.drop("path").join(near, ["host", "print"]).select("host", "whole", "path", "codes", "words", "before", "before_path", "after", "after_path")
    return pairs.mapInPandas(lean(align), "host string, whole long, gone array<int>")


def host_and_whole() -> list[Column]:
    return [host_of(F.coalesce("url", F.lit(""))).alias("host"), F.xxhash64("codes").alias("whole")]


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_lines, n_template of each row of `pages` (page_id, url, html).

    n_lines counts the text lines of the whole page, n_template those that the page shares with its neighbour. A null html
    has an empty text; repeated rows are pages of their own; a null url is one of an unnamed host. Other columns do not
    matter. Pages are read twice, once for the alignment and once for the texts, which
    travel compressed to the join with its results.
    """
    def outline(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [lines(html or "") for html in f["html"]]
            yield pd.DataFrame({"url": f["url"], "codes": list(map(codes_of, got)), "words": [[(t.count(" ") + 1) * (z <= MAIN) for t, z in g] for g in got]})

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for page, url, html in zip(f["page_id"].astype("Int64"), f["url"], f["html"]):
                got = lines(html or "")
                declared = any(z == MAIN for _, z in got)
                mine = [i for i, (_, z) in enumerate(got) if z == (MAIN if declared else OPEN)]
                out.append((page, url, codes_of(got), zlib.compress("\n".join(got[i][0] for i in mine).encode()), mine, declared))
            yield pd.DataFrame(out, columns=["page_id", "url", "codes", "packed", "places", "declared"]).astype({"page_id": "Int64", "declared": "bool"})

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = []
            for packed, places, declared, gone in zip(f["packed"], f["places"], f["declared"], f["gone"]):
                left, template = zlib.decompress(packed).decode().split("\n"), set() if declared else set(gone)
                texts.append(" ".join(t for t, i in zip(left, places) if i not in template))
            kept = f.assign(page_id=f["page_id"].astype("Int64"), text=texts, n_template=[len(g) for g in f["gone"]])
            yield kept[["page_id", "url", "text", "n_lines", "n_template"]]

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    gone = differenced(rows.select("url", "html").mapInPandas(lean(outline), "url string, codes array<long>, words array<int>"))
    texts = rows.mapInPandas(lean(read), "page_id long, url string, codes array<long>, packed binary, places array<int>, declared boolean")
    texts = texts.select("page_id", "url", *host_and_whole(), F.size("codes").cast("long").alias("n_lines"), "packed", "places", "declared")
    done = texts.join(gone, ["host", "whole"]).drop("host", "whole").mapInPandas(lean(check), "page_id long, url string, text string, n_lines long, n_template long")
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_lines", "n_template")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of `pages`."""
    return extracted(pages).select("page_id", "url", "text", "n_chars")
