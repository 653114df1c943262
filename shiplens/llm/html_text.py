"""Main text of web pages by structure and a host's suffix arrays.

A page's markup is cut into text blocks. Blocks in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and comments go by their place. The words of all other blocks, of
every page, go through the suffix arrays, which tell the runs that stand on several distinct pages of
the host. Where a page marks no article, those runs are taken as boilerplate: blocks lose the covered
words and keep their unique runs. Where it marks one, its blocks are the text, whole: an article keeps
its own repeats, so there the runs are counted and not removed.

Pages are parsed once and dealt into parts. The word streams of a part's pages are concatenated and
their suffixes sorted, which gives the part's distinct runs with the pages that hold them; counts are
summed over all parts, so a host's pages are judged together however they are dealt out. So that few
runs travel, a part first sends its anchors, the least 4-word hash of each run: a run can't stand on
more pages than its anchor does, so only runs whose anchor stands on enough pages follow.

Defined results: null or empty html, or markup without text, gives the empty text; a null or odd
url has the empty host; rows are judged as they stand, so repeated rows give repeated results;
further columns are left out. Texts are never cut short. Runs are compared as 64-bit hashes.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.rows import ranges, slices, text_bytes
from shiplens.llm.url_rules import host_and_path
from shiplens.llm.words import grams, mix, words

ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
SPECIAL, NAME_END, CLOSE = re.compile("[>\"']"), re.compile(r"[\s/>]"), re.compile(">")
#: A tag that holds no further <, which most are; looking for one ends at the next < at the latest.
PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/<>\"']*)((?:[\s/](?:[^<>\"']|\"[^<\"]*\"|'[^<']*')*)?)>")
QUOTES = {q: re.compile(q) for q in "\"'"}
#: Elements whose content is no markup, and those that hold no main text.
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"))
OUTSIDE = frozenset((
    "nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "svg",
    "template", "object", "canvas", "audio", "video", "map", "fieldset", "label", "datalist",
))
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
))
BLOCK = frozenset((
    "address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "caption",
)) | OUTSIDE
#: Blocks that hold others; their ends are followed, so that what was left open inside them ends.
HOLDERS = frozenset((
    "body", "html", "div", "section", "table", "ul", "ol", "dl", "blockquote", "figure", "center", "details",
))
#: Words of class, id and role that mark an element as no main text.
HINTS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie",
    "cookies", "discussion", "disqus", "footer", "form", "gdpr", "header", "masthead", "menu", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo",
    "promoted", "reactions", "related", "replies", "search", "share", "sharing", "sidebar", "signup",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets",
))
#: Tokens of a run that counts as long, distinct pages it must stand on, and the usual size of a part.
RUN, PAGES, CHUNK_PAGES, CHUNK_BYTES = 8, 3, 512, 4 << 20
#: Tokens of an anchor, and the leading bytes of its hash that are sent.
ANCHOR, ANCHOR_BYTES = 4, 5
#: Buckets by leading bits that hashes are summed in: at least, and for so many parts one more.
BUCKETS, PARTS_A_BUCKET = 32, 32


@dataclass
class Page:
    """Blocks of text outside boilerplate, and which of them lie in an article."""

    body: list[str] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)
    marked: bool = False


def hinted(attributes: str) -> bool:
    if "=" not in attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        words = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", m[2] or m[3] or m[4] or "").lower())
        if not HINTS.isdisjoint(words):
            return True
    return False


class Marks:
    """Tags, comments and declarations of a page, one after another, in time linear in the page
    whatever is left open in it: where a search has failed or gone far, that is remembered."""

    def __init__(self, source: str):
        self.source, self.end = source, len(source)
        self.known: dict[re.Pattern, tuple[int, int]] = {}  # (searched from, found at)
        self.dead: set[int] = set()  # quotes and ends from which no tag closes

    def _next(self, pattern: re.Pattern, at: int) -> int:
        begin, found = self.known.get(pattern, (0, -1))
        if not begin <= at <= found:
            m = pattern.search(self.source, at)
            found = m.start() if m else self.end
            self.known[pattern] = (at, found)
        return found

    def _closes(self, at: int) -> int:
        """The > that ends a tag whose attributes begin at `at`, quoted ones passed over; -1 if none."""
        passed = []
        while True:
            at = self._next(SPECIAL, at)
            if at >= self.end or at in self.dead:
                break
            if self.source[at] == ">":
                return at
            passed.append(at)
            other = self._next(QUOTES[self.source[at]], at + 1)
            if other >= self.end:
                break
            at = other + 1
        self.dead.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether it closes, name, attributes) of the first mark from `at` on; without
        name for what is no tag."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            if source.startswith("<!--", start):
                stop = source.find("-->", start + 4)
                return start, stop + 3 if stop >= 0 else self.end, False, "", ""
            if m := PLAIN_TAG.match(source, start):
                return start, m.end(), bool(m[1]), m[2].lower(), m[3]
            closing = source.startswith("/", start + 1)
            first = source[start + 1 + closing : start + 2 + closing]
            if first.isascii() and first.isalpha():
                stop = self._next(NAME_END, start + 1 + closing)
                if (close := self._closes(stop)) >= 0:
                    return start, close + 1, closing, source[start + 1 + closing : stop].lower(), source[stop:close]
            if source[start + 1 : start + 2] in ("!", "?", "/"):
                if (close := self._next(CLOSE, start + 2)) < self.end:
                    return start, close + 1, False, "", ""
            at = start + 1
        return None


def parse(source: str) -> Page:
    """The page's blocks, in order, with white space inside each turned into single blanks."""
    page, text = Page(), []
    open_tags: list[tuple[str, bool, bool]] = []  # name, starts an outside part, is an article
    names: Counter[str] = Counter()  # of open_tags
    floor = 0  # an article ended what the open tags below it had begun outside
    outside = inside = 0
    at, end, marks = 0, len(source), Marks(source)

    def pop() -> str:
        nonlocal outside, inside, floor
        tag, out, art = open_tags.pop()
        outside -= out and len(open_tags) >= floor
        inside -= art
        floor = min(floor, len(open_tags))
        names[tag] -= 1
        return tag

    def close_block():
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            page.body.append(block)
            page.inside.append(inside > 0)

    while at < end:
        m = marks.next(at)
        if not outside:
            text.append(html.unescape(source[at : m[0] if m else end]))
        if not m:
            break
        _, at, closing, name, attributes = m
        if not name:
            continue
        if closing:
            if name in BLOCK and not outside:
                close_block()
            if names[name]:
                while pop() != name:
                    pass
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(source, at)
            at = close.end() if close else end
            continue
        if name == "br":
            if not outside:
                text.append(" ")
            continue
        if name in ("td", "th") and not outside:
            text.append(" ")
        art = name in ("article", "main") and not hinted(attributes)
        if art and outside:  # an article ends what was left open before it
            floor, outside = len(open_tags), 0
        if name in BLOCK and open_tags and open_tags[-1][0] == "p":
            pop()  # a block ends a paragraph that is open
        if name in BLOCK and not outside:
            close_block()
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        if art:
            page.marked = True
        out = name in OUTSIDE or hinted(attributes) and name not in ("html", "body")
        if out or art or name in HOLDERS:
            open_tags.append((name, out, art))
            names[name] += 1
            outside += out
            inside += art
    if not outside:
        close_block()
    return page


def _classes(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of the streams to RUN tokens, the class of equal runs of each of its rows, and
    the distinct streams each class stands on. The streams are concatenated, with a mark of its own
    after each; suffixes that reach over a mark are unique, for every mark stands once."""
    sizes = np.array([len(s) for s in streams])
    page = np.repeat(np.arange(len(streams)), sizes + 1)
    marks = -1 - np.arange(len(streams))
    joined = np.concatenate([x for s, m in zip(streams, marks) for x in (s, [m])])
    rank = np.unique(joined, return_inverse=True)[1].astype(np.int64)
    n, depth = len(rank), 1
    while depth < RUN:  # order suffixes by twice as many tokens each time
        step = min(depth, RUN - depth)
        after = np.concatenate([rank[step:], np.zeros(step, np.int64)])[:n] + 1
        after[max(n - step, 0) :] = 0
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        depth += step
    suffixes = np.argsort(rank * len(streams) + page, kind="stable")
    same = rank[suffixes][1:] == rank[suffixes][:-1]
    new_page = ~same | (page[suffixes][1:] != page[suffixes][:-1])
    group = np.concatenate([[0], np.cumsum(~same)])
    return suffixes, group, np.bincount(group, weights=np.concatenate([[1], new_page])).astype(np.int64)


def _covered(long: np.ndarray) -> np.ndarray:
    """Which places lie in a run that begins at a marked one."""
    begin = np.concatenate([[0], np.cumsum(long)])
    return begin[1:] - begin[np.maximum(np.arange(len(long)) - RUN + 1, 0)] > 0


def repeated_tokens(streams: list[np.ndarray]) -> list[np.ndarray]:
    """For each stream of token numbers, which tokens lie in a run of RUN tokens that stands on at
    least PAGES streams."""
    sizes = np.array([len(s) for s in streams])
    if not len(sizes) or sizes.sum() < RUN:
        return [np.zeros(n, bool) for n in sizes]
    suffixes, group, pages = _classes(streams)
    long = np.zeros(len(suffixes), bool)
    long[suffixes] = pages[group] >= PAGES
    covered, ends = _covered(long), np.cumsum(sizes + 1)
    return [covered[e - s - 1 : e - 1] for e, s in zip(ends, sizes)]


def _least_grams(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stream and the anchor of each whole run of streams that lie end to end, in order."""
    room = np.maximum(sizes - RUN + 1, 0)
    if not room.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = ranges(np.cumsum(sizes) - sizes, room)
    parts = grams(flat, np.array([len(flat)]), ANCHOR)[0]
    least = parts[at]
    for k in range(1, RUN - ANCHOR + 1):
        least = np.minimum(least, parts[at + k])
    return np.repeat(np.arange(len(sizes)), room), least & np.uint64((1 << 64) - (1 << 64 - 8 * ANCHOR_BYTES))


def distinct_anchors(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors of the streams, ascending, and how many streams hold each."""
    stream, least = _least_grams(flat, sizes)
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (stream[1:] != stream[:-1])
    stream, least = stream[new], least[new]
    order = np.lexsort((stream, least))
    stream, least = stream[order], least[order]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (stream[1:] != stream[:-1])
    return np.unique(least[new], return_counts=True)


def distinct_runs(flat: np.ndarray, sizes: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, of the distinct runs of RUN tokens whose anchor is one of `anchors`, and how
    many streams hold each."""
    _, least = _least_grams(flat, sizes)
    good = np.isin(least, anchors)
    if not good.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    number = np.unique(flat, return_inverse=True)[1].astype(np.int64)
    suffixes, group, pages = _classes(np.split(number, np.cumsum(sizes)[:-1]))
    # places of the streams, each with a mark at its end, where a wanted run begins, and its hash there
    room = np.maximum(sizes - RUN + 1, 0)
    at = ranges(np.cumsum(sizes + 1) - sizes - 1, room)[good]
    wanted, hashes = np.zeros(len(suffixes), bool), np.zeros(len(suffixes), np.uint64)
    wanted[at], hashes[at] = True, _run_hashes(flat, sizes)[good]
    first = suffixes[np.flatnonzero(np.diff(group, prepend=-1))]
    runs, pages = hashes[first][wanted[first]], pages[wanted[first]]
    order = np.argsort(runs)
    return runs[order], pages[order]


def _run_hashes(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The hash of each whole run of streams that lie end to end, in order."""
    hashes, room = grams(flat, sizes, RUN)
    return hashes[np.repeat(sizes >= RUN, room)]


#: Hashes travel as bytes: all first bytes, then all second ones and so on, since the first ones of
#: ascending hashes are much alike.
SENT = "bucket long, part long, hashes binary, pages binary"


def _pack(hashes: np.ndarray, size: int) -> bytes:
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8).T[:size].tobytes()


def _unpack(column: pa.ChunkedArray, size: int) -> list[np.ndarray]:
    out = []
    for value in column.to_pylist():
        planes = np.zeros((8, len(value) // size), np.uint8)
        planes[:size] = np.frombuffer(value, np.uint8).reshape(size, -1)
        out.append(np.ascontiguousarray(planes.T).view(">u8")[:, 0].astype(np.uint64))
    return out


def _sent(part: int, hashes: np.ndarray, pages: np.ndarray, size: int, buckets: int) -> pa.Table:
    """A part's ascending hashes cut into buckets; page counts beyond PAGES say no more than PAGES."""
    starts = np.searchsorted(hashes, np.arange(buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets))
    ends = np.append(starts[1:], len(hashes))
    counts = np.minimum(pages, PAGES).astype(np.uint8)
    rows = [(b, s, e) for b, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())) if s < e]
    return pa.table({
        "bucket": pa.array([b for b, _, _ in rows], pa.int64()),
        "part": pa.array([part] * len(rows), pa.int64()),
        "hashes": pa.array([_pack(hashes[s:e], size) for _, s, e in rows], pa.binary()),
        "pages": pa.array([counts[s:e].tobytes() for _, s, e in rows], pa.binary()),
    })


def _often(sent: DataFrame, size: int) -> DataFrame:
    """(part, hashes): of the hashes a part sent, those that stand on PAGES pages or more in all."""

    def run(table: pa.Table) -> pa.Table:
        rows = _unpack(table.column("hashes"), size)
        flat = np.concatenate(rows)
        pages = np.frombuffer(b"".join(table.column("pages").to_pylist()), np.uint8)
        number = np.unique(flat, return_inverse=True)[1]
        often = (np.bincount(number, weights=pages) >= PAGES)[number]
        kept = [h[o] for h, o in zip(rows, np.split(often, np.cumsum([len(h) for h in rows])[:-1]))]
        some = [i for i, h in enumerate(kept) if len(h)]
        return pa.table({
            "part": table.column("part").combine_chunks().take(pa.array(some, pa.int64())),
            "hashes": pa.array([_pack(kept[i], size) for i in some], pa.binary()),
        })

    return sent.groupBy("bucket").applyInArrow(run, "part long, hashes binary")


def _bodies(table: pa.Table) -> list[str]:
    codec = pa.Codec("zstd")
    return [
        codec.decompress(body, size, asbytes=True).decode() if size else ""
        for body, size in zip(table.column("body").to_pylist(), table.column("size").to_pylist())
    ]


def _streams(table: pa.Table, bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each page's tokens as hashes that tell hosts apart, end to end, and how many each page has."""
    hashes, _, _, counts = words(*text_bytes(pa.array(bodies, pa.string())), lower=False)
    host = mix(table.column("host").to_numpy().view(np.uint64))
    return mix(hashes ^ np.repeat(host, counts)), counts


def _frames(parsed: DataFrame, buckets: int) -> DataFrame:
    """(part, hashes): the runs of a part's pages that stand on PAGES pages of their host or more."""

    def anchors(table: pa.Table) -> pa.Table:
        found = distinct_anchors(*_streams(table, _bodies(table)))
        return _sent(table.column("part")[0].as_py(), *found, ANCHOR_BYTES, buckets)

    def runs(table: pa.Table, often: pa.Table) -> pa.Table:
        found = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if table.num_rows and often.num_rows:
            held = np.concatenate(_unpack(often.column("hashes"), ANCHOR_BYTES))
            found = distinct_runs(*_streams(table, _bodies(table)), held)
        return _sent(table.column("part")[0].as_py() if table.num_rows else 0, *found, 8, buckets)

    often = _often(parsed.groupBy("part").applyInArrow(anchors, SENT), ANCHOR_BYTES)
    return _often(parsed.groupBy("part").cogroup(often.groupBy("part")).applyInArrow(runs, SENT), 8)


def _text(blocks: list[str], inside: bytes, marked: bool, covered: np.ndarray) -> str:
    """The blocks of a marked article; of a page that marks none, the blocks without covered tokens."""
    if marked:
        return "\n\n".join(block for block, place in zip(blocks, inside) if place)
    if covered.all() or not covered.any():  # a copy of other pages rather than their frame, or no frame
        return "\n\n".join(blocks)
    kept, at = [], 0
    for block in blocks:
        tokens = block.split(" ")
        free = [w for w, c in zip(tokens, covered[at : at + len(tokens)]) if not c]
        at += len(tokens)
        if free:
            kept.append(" ".join(free))
    return "\n\n".join(kept)


def _judged(parsed: DataFrame, frames: DataFrame, kind: str) -> DataFrame:
    """(page_id, url, text, n_repeated) of every page."""

    def run(table: pa.Table, often: pa.Table) -> pa.Table:
        bodies = _bodies(table)
        flat, sizes = _streams(table, bodies)
        covered = np.zeros(len(flat), bool)
        if often.num_rows:
            held = np.concatenate(_unpack(often.column("hashes"), 8))
            room = np.maximum(sizes - RUN + 1, 0)
            long = np.zeros(len(flat), bool)
            long[ranges(np.cumsum(sizes) - sizes, room)] = np.isin(_run_hashes(flat, sizes), held)
            covered = _covered(long)
        pages = np.split(covered, np.cumsum(sizes)[:-1]) if len(sizes) else []
        texts = [
            _text(body.split("\n") if body else [], inside, marked, page) for body, inside, marked, page in zip(
                bodies, table.column("inside").to_pylist(), table.column("marked").to_pylist(), pages
            )
        ]
        return pa.table({
            "page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(texts, pa.string()),
            "n_repeated": pa.array([int(page.sum()) for page in pages], pa.int64()),
        })

    return parsed.groupBy("part").cogroup(frames.groupBy("part")).applyInArrow(
        run, f"page_id {kind}, url string, text string, n_repeated long"
    )


def with_repeats(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated) for every row. n_repeated counts the words in runs that
    stand on several pages of the host, in all of a page's blocks that don't go by their place. Pages
    are parsed and dealt out once; each step reads what was dealt."""
    kind = pages.schema[id_col].dataType.simpleString()
    host, _ = host_and_path(F.col(url_col))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"), F.xxhash64(F.coalesce(host, F.lit(""))).alias("host"),
    )
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()
    parts = 1 + max(count // CHUNK_PAGES, size // CHUNK_BYTES)

    def cut(batches):
        codec = pa.Codec("zstd")
        for part in slices(batches, "html"):
            found = [parse(source or "") for source in part.column("html").to_pylist()]
            bodies = ["\n".join(p.body).encode() for p in found]  # a block holds no line end
            yield pa.record_batch([
                *(part.column(c) for c in ("part", "page_id", "url", "host")),
                pa.array([p.marked for p in found], pa.bool_()),
                pa.array([codec.compress(b, asbytes=True) if b else b"" for b in bodies], pa.binary()),
                pa.array([len(b) for b in bodies], pa.int64()),
                pa.array([bytes(p.inside) for p in found], pa.binary()),
            ], names=["part", "page_id", "url", "host", "marked", "body", "size", "inside"])

    parsed = rows.withColumn("part", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(parts))).mapInArrow(
        cut, f"part long, page_id {kind}, url string, host long, marked boolean, body binary, size long, inside binary"
    ).repartition("part")
    frames = _frames(parsed, max(BUCKETS, parts // PARTS_A_BUCKET))
    return _judged(parsed, frames, kind).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated"
    )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row."""
    return with_repeats(pages, id_col, url_col, html_col).drop("n_repeated")
