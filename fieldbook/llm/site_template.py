"""Main text of web pages by removal of site templates (operator 12).

Every element's subtree is hashed, and the pages of a host that a hash occurs on are counted in
Spark.  Subtrees that recur across many pages of their host (menus, headers, footers, adverts) are
deleted; elements that their markup names as such go also where a host has too few pages to tell."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.joins import dimension_join, skew_join

from .shared import columns_as, keep, ship

#: A subtree is of the template if pages of so many different titles have it, and at least this
#: part of the host's titles.
MIN_PAGES, MIN_SHARE = 3, 0.002

#: Hashes of templates that are sent to every task (8 bytes each); more of them are joined.
SENT = 2_000_000

#: Elements of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
NEVER = set("head script style noscript template title textarea xmp iframe noembed noframes nav footer aside form dialog menu svg math object applet canvas audio video button select datalist input".split())
PROSE = HEADINGS | set("p li blockquote pre dl dt dd table thead tbody tfoot tr td th caption figcaption ul ol".split())
NAMED = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer header login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo related share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
COMMENTS = set("comment comments commentlist disqus replies respond".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Start tags that end an open element of these kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPES = set("article aside body button dd div dl dt fieldset footer form header li main nav ol section table td th ul".split())
#: Fixed values end.

_TOKEN = re.compile(
    r"<!--(?:>|->|(?s:.*?)(?:--!?>|\Z))|<[!?][^>]*+>?|</(?![a-zA-Z])[^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|</?[a-zA-Z](?s:.*)"  # cut off within a tag
)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]+))")
_NAME = re.compile(r"[a-z0-9]+")


class Page:
    """The elements of a page (0 is the page itself) and its blocks of text in order."""

    def __init__(self):
        self.tag, self.parent, self.hash = ["html"], [-1], [0]
        self.drop, self.kept, self.root = [False], [True], [""]
        self.blocks: list[tuple[int, str, bool]] = []
        self.title = ""


class _Open:
    """An element whose end has not come yet."""

    __slots__ = ("tag", "place", "pieces", "names", "header", "holds", "chars", "linked")

    def __init__(self, tag, place, names, header):
        self.tag, self.place, self.names, self.header = tag, place, names, header
        self.pieces, self.holds, self.chars, self.linked = [], set(), 0, 0


def parse(source: str, host: str) -> Page:
    """Read a page, however it is written: open elements end where HTML ends them, unknown end tags
    are ignored, and what is cut off ends with the page."""
    page, pos, n = Page(), 0, len(source)
    stack, links, buffer = [_Open("html", 0, (), False)], 0, []
    seed, opened = host.encode(), Counter()

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                here = stack[-1]
                page.blocks.append((here.place, text, here.header))
                here.pieces.append(text)

    def say(text: str) -> None:
        if text:
            if "&" in text:
                text = entities.unescape(text)
            buffer.append(text)
            size = len(text.strip())
            stack[-1].chars += size
            if links:
                stack[-1].linked += size

    def close() -> None:
        flush()
        e = stack.pop()
        opened[e.tag] -= 1
        at, up = e.place, stack[-1]
        inside = page.root[at]
        if e.tag in ("article", "main", "h1"):
            e.holds.add(e.tag)
        content = bool(e.holds & {"article", "main"})
        if e.names:
            named = e.names & NAMED and e.tag not in ("body", "main") and (e.tag != "article" or "article" in page.root[page.parent[at]])
            outer = content or "h1" in e.holds
            page.drop[at] = page.drop[at] or bool(e.names & COMMENTS and e.tag not in ("body", "main") or named and not (outer and not page.root[page.parent[at]]))
        prose = inside and e.tag in PROSE and not (e.tag in ("ul", "ol") and e.linked * 5 > e.chars * 4)
        body = "\1".join([e.tag, " ".join(sorted(e.names)), *e.pieces])
        key = int.from_bytes(blake2b(b"\0".join((seed, body.encode("utf-8", "replace"))), digest_size=8).digest(), "little", signed=True)
        page.hash[at] = key
        page.kept[at] = bool(prose or content or e.tag == "body" or not e.chars)
        up.pieces.append(f"\2{key}")
        if not page.drop[at]:
            up.holds |= e.holds
        up.chars, up.linked = up.chars + e.chars, up.linked + e.linked

    def end(tags: set, scope: set) -> None:
        """End the nearest open element of these kinds, and what is open within it."""
        if not any(opened[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                while len(stack) > k:
                    close()
                return
            if stack[k].tag in scope:
                return

    while pos < n:
        m = _TOKEN.search(source, pos)
        if m is None:
            say(source[pos:])
            break
        say(source[pos : m.start()])
        pos, tag = m.end(), m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "body" and (m.group(1) or opened["body"]):
            continue
        if m.group(1):
            if tag == "a":
                links = max(links - 1, 0)
            if tag == "p" or opened[tag]:
                flush()
                end({tag}, set() if tag in ("article", "main") else {"article", "main"})
            continue
        if tag in INLINE or tag == "html":
            links += tag == "a"
            if tag == "br":
                buffer.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, pos)
            inner, pos = source[pos : stop.start() if stop else n], stop.start() if stop else n
            if tag == "title" and not page.title:
                page.title = " ".join(entities.unescape(inner).split())
            if stop:
                pos = source.find(">", pos) + 1 or n
            continue
        if tag == "body":
            links = 0
            end({"head"}, set())
        end(ENDS.get(tag, set()), {"ul", "ol", "dl", "table", "select"})
        if tag not in ("li", "dt", "dd", "td", "th", "tr", "option"):
            end({"p"}, SCOPES)
        names, role, hidden = set(), "", False
        for a in _ATTRIBUTE.finditer(m.group(3)):
            value = a.group(2) or a.group(3) or a.group(4) or ""
            name = a.group(1).lower()
            if name in ("class", "id"):
                names.update(_NAME.findall(value.lower()))
            elif name == "role":
                role = value.strip().lower()
            elif name == "style":
                hidden = hidden or bool(re.search(r"display\s*:\s*none", value, re.I))
        hidden = hidden or bool(re.search(r"\shidden(?=[\s/=]|\Z)", m.group(3), re.I))
        up, place = stack[-1].place, len(page.tag)
        root = page.root[up]
        in_article = "article" in root
        page.tag.append(tag)
        page.parent.append(up)
        page.hash.append(0)
        page.kept.append(True)
        kind = tag if tag in ("article", "main") else "main" if role == "main" else ""
        page.root.append(root if kind in root else f"{root}/{kind}")
        page.drop.append(hidden or tag in NEVER or role in ROLES or tag == "header" and not in_article)
        # In the header of an article only headings count.
        stack.append(_Open(tag, place, names, tag not in HEADINGS and (stack[-1].header or tag == "header" and in_article)))
        opened[tag] += 1
        if m.group(3).endswith("/") and tag in ("svg", "math"):
            close()
    while len(stack) > 1:
        close()
    flush()
    return page


def main_text(page: Page, template: np.ndarray) -> tuple[str, int, int]:
    """The blocks of the article (of the main element or the page, if there is none), and how many
    blocks went as template and by their markup.  ``template``: sorted hashes."""
    hashes = np.array(page.hash, dtype=np.int64)
    at = np.minimum(np.searchsorted(template, hashes), max(len(template) - 1, 0))
    recurs = (template[at] == hashes) & ~np.array(page.kept) if len(template) else np.zeros(len(hashes), dtype=bool)
    by_site, by_mark = recurs.tolist(), list(page.drop)
    for e in range(1, len(by_site)):
        up = page.parent[e]
        by_site[e] = by_site[e] or by_site[up]
        by_mark[e] = by_mark[e] or by_mark[up]
    n_site = sum(by_site[e] for e, _, _ in page.blocks)
    n_mark = sum(by_mark[e] and not by_site[e] for e, _, _ in page.blocks)
    left = [(page.root[e], text) for e, text, header in page.blocks if not by_site[e] and not by_mark[e] and not header]
    for root in ("article", "main"):
        inner = [(r, text) for r, text in left if root in r]
        if inner:
            left = inner
            break
    return "\n".join(text for _, text in left), n_site, n_mark


def _host(url: str | None) -> str:
    found = re.search(r"://([^/?#]*)", url or "")
    return found.group(1).lower() if found else ""


def _number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def subtrees(pages: DataFrame) -> DataFrame:
    """``host, subtree, title`` (64-bit hashes) for every element of ``url, html`` that may be
    template; once per page with the host itself as subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, titles = [], [], []
            for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host = _host(url)
                page = parse(source or "", host)
                found = {h for h, kept in zip(page.hash, page.kept) if not kept}
                number = _number(host)
                found.add(number)
                hosts += [number] * len(found)
                keys += found
                titles += [_number(page.title or source or "")] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (hosts, keys, titles)], ["host", "subtree", "title"])

    return pages.select("url", "html").mapInArrow(run, "host bigint, subtree bigint, title bigint")


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``subtree`` of the elements that recur across a host.

    Pages are told apart by their titles, so that copies of one page, exact or not, count once.
    Counts are made before anything is shuffled by host, and only subtrees that recur go on."""
    counts = subtrees(pages).distinct().groupBy("host", "subtree").agg(F.count("*").alias("pages"))
    counts = keep(counts.where(F.col("pages") >= min_pages), "template-counts")
    hosts = counts.where("host = subtree").select("host", F.col("pages").alias("all"))
    joined = dimension_join(counts.where("host <> subtree"), hosts, ["host"], "inner")
    return keep(joined.where(F.col("pages") >= F.col("all") * min_share).select("subtree").distinct(), "templates")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, sent: int = SENT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_template, n_markup``: the main text of every page, its code
    points, and the blocks that went as part of the site's template or by their markup.

    Blocks of text are joined by one line break, white space in them is one blank.  Prose (in
    paragraphs, headings, tables and lists that are not of links) of an ``article`` or ``main``
    element is never taken for template, nor is an element that holds the article; so passages
    that many articles share stay.  Null html is empty and gives an empty text; pages without host
    count as one host; rows that repeat are all returned; an empty table gives an empty result;
    further columns are ignored.

    Up to ``sent`` template hashes are sent to the tasks that read the pages a second time; more
    are joined to the pages they occur on, with hot ones spread."""
    spark = ship(pages.sparkSession)
    pages = columns_as(pages, page_id=id_col, url=url_col, html=html_col).select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = templates(pages, min_pages, min_share)
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars bigint, n_template bigint, n_markup bigint"

    def texts(batch: pa.RecordBatch, template) -> pa.RecordBatch:
        urls, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        rows = [main_text(parse(source or "", _host(url)), template(n)) for n, (url, source) in enumerate(zip(urls, sources))]
        text, site, mark = zip(*rows) if rows else ((), (), ())
        numbers = [pa.array([len(t) for t in text], pa.int64()), pa.array(site, pa.int64()), pa.array(mark, pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), *numbers], ["page_id", "url", "text", "n_chars", "n_template", "n_markup"])

    few = found.limit(sent + 1).count() <= sent
    if few:
        shared = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in found.toLocalIterator()], dtype=np.int64)))

        def with_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield texts(batch, lambda n: shared.value)

        return pages.mapInArrow(with_all, schema)

    keyed = pages.withColumn("page", F.xxhash64(F.lower(F.regexp_extract("url", "://([^/?#]*)", 1)), "html"))

    def occurs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for n, (url, source) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                page = parse(source or "", _host(url))
                own = {h for h, kept in zip(page.hash, page.kept) if not kept}
                at += [n] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(keys, pa.int64())], ["page", "subtree"])

    marks = keep(keyed.select("page", "url", "html").mapInArrow(occurs, "page bigint, subtree bigint").distinct(), "template-places")
    own = skew_join(marks, found.withColumn("_found", F.lit(True)), ["subtree"], "inner", spread=["page"], hot_rows=10_000).groupBy("page").agg(F.sort_array(F.collect_list("subtree")).alias("template"))
    joined = skew_join(keyed, own, ["page"], "left", spread=["page_id", "url"], hot_rows=10_000).select("page_id", "url", "html", F.coalesce("template", F.array().cast("array<bigint>")).alias("template"))

    def with_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            yield texts(batch, lambda n, lists=lists: np.array(lists[n].values.to_numpy(zero_copy_only=False), dtype=np.int64))

    return joined.mapInArrow(with_own, schema)
