"""Main text of web pages by nearest-URL differencing.

A page is cut into text lines, one per block element. Pages of a host are ordered by
URL path; each page is paired with whichever of its two neighbours has the path at the
least edit distance (ties: the earlier). The lines of every page are aligned with its mate's by a longest
common subsequence, and shared lines are deleted: they are the host's template.

What a page itself declares is checked after that. Lines inside an article or main element may be shared
because neighbouring pages carry copies of one article, or quote one line (see the README for figures).
So a shared line there is template only if, on a host of ``_FEW`` pages or more, three quarters of the
pages share it with mates that are no copies: pairs that share at most half of the article's lines.
An article of nothing but such lines keeps them. Where the lines outside the article that the pair does not
share hold more text than it, they are text too. Lines inside menus, page headers and footers, sidebars, forms,
notices, adverts and comments are deleted whether shared or not. Elements say so by their
tag, or by a class, id or role of which every part is such a word or a neutral one
(``cookie-notice``, ``site-header``; not ``with-sidebar`` or ``market-share``); a block that is marked so
only by its class and holds the main element, or most of the page's text and all of its article, is not
deleted; adverts, notices and comments always are.
So the alignment decides on lines that no such element claims, and on template inside articles.

The order is a range sort with a global rank, and pairs are joins on the rank: no host
is ever in one task.

Cases: a null or empty html has no text; a null url is a host of its own; a page alone
on its host loses no line by alignment; rows that repeat a page are pages of their own;
pages of any length are taken whole, in time linear in their markup, and aligned in memory
linear in their lines; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Collection, Iterator, Sequence
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import map_batches, staged

_OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)|<!--|<[!?]")
_STOP = re.compile(r"[>\"']")
#: Elements whose content is no markup, and elements that show no text.
_RAW = frozenset("script style title textarea".split())
_HIDDEN = frozenset("noscript template svg iframe select object".split())
_HINT = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_HOLDERS = frozenset("article aside body button details dialog div fieldset figure footer form header "
                     "main menu nav ol section table ul".split())
_NOT_TEXT = frozenset("aside button dialog footer form header menu nav".split())
#: Words in class, id or role that mark what is not the article (fixed values).
_MARKS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer header login masthead menu modal nav navbar navigation "
    "newsletter notice popup promo promoted related replies reply respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split())
#: Words that may stand beside a mark in one class name (fixed values).
_NEUTRAL = frozenset(
    "area bar block bottom box btn button buttons container fixed form global inner item items left links "
    "list main message outer overlay page panel primary right row secondary section site slot strip sub top "
    "unit wrap wrapper".split())
#: Marks that hide a block whatever it holds (fixed values).
_FIRM = frozenset(
    "ad ads advert advertisement adverts advertising comment comments consent cookie cookies disqus "
    "newsletter promo promoted replies reply respond sponsor sponsored".split())

ARTICLE, PLAIN, OUTSIDE = 0, 1, 2
#: On a host of fewer pages no line inside an article is taken for template (fixed value).
_FEW = 10
#: Words of 64 bits in the bitmap of pages that lose a line: the bound of what is broadcast.
_WORDS = 1 << 18


def _tags(text: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of the tags of a page in order; comments, declarations and
    the content of raw elements come under the name "". A quote that is never closed does not
    hide the end of its tag; a tag without an end ends the markup. Each character is looked at a bounded
    number of times."""
    lower = text.lower()        # may differ in length from the text for a few letters
    low = lower if len(lower) == len(text) else re.sub("[A-Z]", lambda m: m[0].lower(), text)
    last = {q: text.rfind(q) for q in "\"'"}
    last_end, at = text.rfind(">"), 0
    while tag := _OPEN.search(text, at):
        start, name = tag.start(), (tag[2] or "").lower()
        if text.startswith("<!--", start):
            end = text.find("-->", start + 4)
            at = len(text) if end < 0 else end + 3
            yield start, at, "", False, ""
            continue
        if last_end < tag.end():
            return
        seek = tag.end()
        while (stop := _STOP.search(text, seek)) and stop[0] != ">":
            if last[stop[0]] <= stop.start():
                stop = None
                break
            seek = text.find(stop[0], stop.end()) + 1
        end = stop.end() if stop else text.find(">", tag.end()) + 1
        yield start, end, name, bool(tag[1]), text[tag.end():end - 1]
        at = end
        if name in _RAW and not tag[1]:
            close = low.find(f"</{name}", end)
            at = len(text) if close < 0 else close
            yield end, at, "", False, ""


def _hidden(tags: list[tuple[int, int, str, bool, str]]) -> list[tuple[int, int]]:
    """Spans of elements that show no text, from each closing tag back to the last opening
    one of its name; an opening tag that is never closed hides nothing."""
    opened: dict[str, list[int]] = {}
    spans = []
    for start, end, name, closing, inside in tags:
        if name in _HIDDEN:
            if closing:
                if opened.get(name):
                    spans.append((opened[name].pop(), end))
            elif name != "svg" or not inside.endswith("/"):
                opened.setdefault(name, []).append(start)
    return sorted(spans)


def _marks(inside: str) -> set[str]:
    """The marks in an opening tag's class, id and role."""
    found = set()
    for hint in _HINT.findall(inside):
        for token in "".join(hint).lower().split():
            parts = {w for w in re.split(r"[_-]+", token) if w}
            if parts & _MARKS and parts <= _MARKS | _NEUTRAL:
                found |= parts & _MARKS
    return found


class _Element:
    """An open element: its kind, and the marked blocks that it lies in."""

    __slots__ = ("name", "kind", "blocks")

    def __init__(self, name: str, kind: int, blocks: tuple[int, ...]):
        self.name, self.kind, self.blocks = name, kind, blocks


def page_lines(markup: str | None) -> tuple[list[str], list[int]]:
    """Text lines of a page in order, and whether each is article, plain or outside."""
    text = markup or ""
    tags = list(_tags(text))
    lines: list[str] = []
    kinds: list[int] = []
    within: list[tuple[int, ...]] = []          # the marked blocks of each line
    chars: list[int] = []                       # of each marked block
    firm: list[bool] = []                       # a block that is hidden whatever it holds
    stack: list[_Element] = []
    opened: dict[str, int] = {}
    here: list[str] = []
    total = 0

    def close() -> None:
        nonlocal total
        line = " ".join(entities.unescape("".join(here)).split())
        here.clear()
        if line:
            top = stack[-1] if stack else _Element("", PLAIN, ())
            lines.append(line)
            kinds.append(top.kind)
            within.append(top.blocks)
            total += len(line) if top.kind != OUTSIDE else 0
            for b in top.blocks:
                chars[b] += len(line) if top.kind != OUTSIDE else 0

    hidden = iter([*_hidden(tags), (len(text) + 1, len(text) + 1)])
    skip, at = next(hidden), 0
    for start, end, name, closing, inside in tags:
        if start >= skip[1]:
            while start >= skip[1]:
                skip = next(hidden)
        if start >= skip[0]:                    # inside an element that shows no text
            if at < skip[0]:
                here.append(text[at:skip[0]])
            at = max(at, skip[1])
            continue
        here.append(text[at:start] if start > at else "")
        at = max(at, end)
        if not name:
            here.append(" ")
        if name == "br":
            here.append(" ")
        if name not in _BLOCKS:
            continue
        close()
        if name not in _HOLDERS:
            continue
        if closing:
            while opened.get(name):
                gone = stack.pop()
                opened[gone.name] -= 1
                if gone.name == name:
                    break
        elif not inside.endswith("/"):
            kind, blocks = (stack[-1].kind, stack[-1].blocks) if stack else (PLAIN, ())
            marked = _marks(inside) if name != "body" else set()
            nested = opened.get("article", 0) + opened.get("main", 0) > 0
            if name in ("article", "main"):     # an inner one may be a reader's comment
                kind = OUTSIDE if nested and (marked or kind == OUTSIDE or blocks) else ARTICLE
                for b in blocks if name == "main" else ():
                    chars[b] += len(text)       # holds the main element
            elif name in _NOT_TEXT:
                kind = OUTSIDE
            elif marked:
                blocks = (*blocks, len(chars))
                chars.append(0)
                firm.append(bool(marked & _FIRM))
            stack.append(_Element(name, kind, blocks))
            opened[name] = opened.get(name, 0) + 1
    while at < len(text):
        here.append(text[at:max(at, min(skip[0], len(text)))])
        at = max(at, skip[1])
        skip = next(hidden, (len(text) + 1, len(text) + 1))
    close()
    said = sum(k == ARTICLE for k in kinds)     # a wrapper of the text has all the article's lines
    inside_of = Counter(b for k, bs in zip(kinds, within) if k == ARTICLE for b in bs)
    hides = [f or 2 * c <= total or inside_of[b] < said for b, (f, c) in enumerate(zip(firm, chars))]
    kinds = [OUTSIDE if any(hides[b] for b in bs) else k for k, bs in zip(kinds, within)]
    return lines, kinds


def _prefix_lengths(a: Sequence, b: Sequence) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` with every prefix of ``b``, by
    bit-parallel rows: a bit for each place of ``b``."""
    places: dict = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    masks = {}
    for x, js in places.items():
        if len(js) > 16:
            bits = np.zeros(len(b), bool)
            bits[js] = True
            masks[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        if x in places:
            hit = row & (masks[x] if x in masks else sum(1 << j for j in places[x]))
            row = ((row + hit) | (row - hit)) & full
    raw = np.frombuffer(row.to_bytes(-(-len(b) // 8) or 1, "little"), np.uint8)
    zeros = 1 - np.unpackbits(raw, bitorder="little")[:len(b)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(zeros)])


def _by_matches(a: Sequence, b: Sequence, places: dict) -> list[int]:
    """Places in ``a`` of a longest common subsequence: a longest increasing run of matches."""
    ends: list[int] = []
    links: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    found, link = [], links[-1] if links else None
    while link:
        found.append(link[0])
        link = link[1]
    return found


def shared_lines(a: Sequence, b: Sequence) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``: equal ends first; few matching pairs
    of places by an increasing run of them, many by halving ``a`` (Hirschberg) over bit rows, in
    memory linear in the lines."""
    found: set[int] = set()
    parts = [(0, list(a), list(b))]
    while parts:
        base, x, y = parts.pop()
        head = 0
        while head < min(len(x), len(y)) and x[head] == y[head]:
            head += 1
        tail = 0
        while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
            tail += 1
        found.update(range(base, base + head), range(base + len(x) - tail, base + len(x)))
        base, x, y = base + head, x[head:len(x) - tail], y[head:len(y) - tail]
        places: dict = {}
        for j, v in enumerate(y):
            places.setdefault(v, []).append(j)
        if sum(len(places.get(v, ())) for v in x) <= 200_000 or len(x) < 2:
            found.update(base + i for i in _by_matches(x, y, places))
            continue
        half = len(x) // 2
        first = _prefix_lengths(x[:half], y)
        second = _prefix_lengths(x[half:][::-1], y[::-1])[::-1]
        cut = int((first + second).argmax())
        parts += [(base, x[:half], y[:cut]), (base + half, x[half:], y[cut:])]
    return found


def _holds_text(lines: list[str], kinds: list[int]) -> bool:
    """Whether the article's lines hold at least as much text as the plain ones."""
    size = [sum(len(x) for x, k in zip(lines, kinds) if k == kind) for kind in (ARTICLE, PLAIN)]
    return ARTICLE in kinds and size[0] >= size[1]


def main_text(lines: list[str], kinds: list[int], deleted: Collection[int] = ()) -> str:
    """The article's lines; the plain lines too if they hold more text, or there is no article. Lines at the
    places ``deleted`` are left out, but not all of an article."""
    left = [OUTSIDE if i in deleted else k for i, k in enumerate(kinds)]
    if ARTICLE not in left:
        left = [k if k == ARTICLE else x for k, x in zip(kinds, left)]
    wanted = {ARTICLE} if _holds_text(lines, left) else {ARTICLE, PLAIN}
    return "\n\n".join(x for x, k in zip(lines, left) if k in wanted)


def _place(url: str | None) -> tuple[str | None, str]:
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "") if url is not None else None, parts.path
    except ValueError:
        return url, ""


def _parsed(pages: DataFrame) -> DataFrame:
    """A row per page: its place, and a hash, the kind and the text of every line (no text of lines outside)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for pdf in batches:
            for lo in range(0, len(pdf), 512):
                part = pdf.iloc[lo:lo + 512]
                cut = [page_lines(h) for h in part["html"]]
                where = [_place(u) for u in part["url"]]
                yield pd.DataFrame({
                    "page_id": part["page_id"].astype("Int64").array, "url": part["url"].array,
                    "host": [h for h, _ in where], "path": [p for _, p in where],
                    "marks": [np.array([xxhash.xxh3_64_intdigest(x) for x in ls], np.uint64)
                              .view(np.int64) for ls, _ in cut],
                    "kinds": [ks for _, ks in cut],
                    "lines": [["" if k == OUTSIDE else x for x, k in zip(*c)] for c in cut]})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return map_batches(rows, run, "page_id long, url string, host string, path string, "
                                  "marks array<long>, kinds array<int>, lines array<string>")


def nearest_pages(places: DataFrame) -> DataFrame:
    """(row, mate) for ``places`` (row, host, path, page_id): the neighbour in the order of
    paths within the host that is nearer by edit distance."""
    order = ["host", "path", "page_id", "row"]
    ordered = staged(
        places.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "n": F.monotonically_increasing_id()}),
        "pages-order")
    sizes = ordered.groupBy("part").agg(F.count("*").alias("size"), F.min("n").alias("first"))
    ahead = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("ahead", F.coalesce(ahead, F.lit(0)))      # one row a partition
    ranked = staged(ordered.join(starts, "part").select(
        "row", "host", "path", (F.col("n") - F.col("first") + F.col("ahead")).alias("rank")),
        "pages-rank")

    def mate(step: int) -> DataFrame:
        near = ranked.select((F.col("rank") - step).alias("rank"), F.col("row").alias("mate"),
                             F.col("host").alias("mate_host"), F.col("path").alias("mate_path"))
        return (ranked.join(near, "rank").filter(F.col("host").eqNullSafe(F.col("mate_host")))
                .select("row", F.struct(F.levenshtein("path", "mate_path").alias("far"),
                                        F.lit(step).alias("step"), "mate").alias("m")))

    return mate(-1).union(mate(1)).groupBy("row").agg(F.min("m").alias("m")).select("row", "m.mate")


def _shared(rows: DataFrame) -> DataFrame:
    """Every page that has a mate, aligned with it by the hashes of their lines: ``row``, ``host``, the places
    of shared ``plain`` lines, the places and ``marks`` of shared ``article`` lines, and whether
    the mate is a ``copy``: more than half of the article's lines are shared."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for row, host, kinds, marks, mate in zip(
                    *(pdf[c] for c in ("row", "host", "kinds", "marks", "mate_marks"))):
                marks = list(marks)
                same = sorted(shared_lines(marks, list(mate)))
                plain, article = ([i for i in same if kinds[i] == k] for k in (PLAIN, ARTICLE))
                copy = 2 * len(article) > sum(k == ARTICLE for k in kinds)
                found.append((row, host, plain, article, [marks[i] for i in article], copy))
            yield pd.DataFrame(found, columns=["row", "host", "plain", "article", "marks", "copy"])

    pairs = nearest_pages(rows.select("row", "host", "path", "page_id"))
    mates = pairs.join(rows.select(F.col("row").alias("mate"), F.col("marks").alias("mate_marks")),
                       "mate").select("row", "mate_marks")
    both = rows.select("row", "host", "kinds", "marks").join(mates, "row")
    return map_batches(both, run, "row long, host string, plain array<int>, article array<int>, "
                                  "marks array<long>, copy boolean").filter(
        (F.size("plain") > 0) | (F.size("article") > 0))


def _deleted(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """(row, deleted): the places of a page's shared lines that are template, for pages that have some."""
    article = shared.select("row", "host", "copy", F.explode(F.arrays_zip("article", "marks")).alias("x")).select(
        "row", "host", "copy", F.col("x.article").alias("place"), F.col("x.marks").alias("mark"))
    sizes = rows.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("pages")).filter(
        F.col("pages") >= _FEW)
    seen = (article.filter("not copy").select("host", "mark", "row").distinct()
            .groupBy("host", "mark").agg(F.count("*").alias("seen")))
    template = (seen.join(sizes, F.col("host").eqNullSafe(F.col("_host"))).filter("4 * seen >= 3 * pages")
                .select("_host", F.col("mark").alias("_mark")))
    inside = article.join(template, F.col("host").eqNullSafe(F.col("_host"))
                          & (F.col("mark") == F.col("_mark")), "left_semi").select("row", "place")
    return (shared.select("row", F.explode("plain").alias("place")).union(inside)
            .groupBy("row").agg(F.collect_list("place").alias("deleted")))


def _with_deleted(rows: DataFrame, deleted: DataFrame) -> DataFrame:
    """``rows`` with their ``deleted`` places, null if none. Only the rows whose bit is set in a bitmap of
    those that lose lines are shuffled with their text; a full bitmap lets more pass."""
    at = F.pmod(F.xxhash64("row"), F.lit(_WORDS * 64))
    bits = deleted.select(at.alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_at & 63 as int)))").alias("_bits"))
    keyed = (rows.withColumn("_at", at).withColumn("_word", F.shiftright("_at", 6))
             .join(F.broadcast(bits), "_word", "left")
             .withColumn("_hit", F.expr(
                 "coalesce((shiftrightunsigned(_bits, cast(_at & 63 as int)) & 1) = 1, false)")))
    hit, whole = (keyed.filter(c).select(*rows.columns) for c in ("_hit", "not _hit"))
    return hit.join(deleted, "row", "left").unionByName(
        whole.withColumn("deleted", F.lit(None).cast("array<int>")))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): ``page_id``, ``url``, ``text`` and
    ``n_chars``.

    Every page is aligned with its mate by the hashes of their lines, so a pair costs eight bytes a line.
    """
    rows = staged(_parsed(pages).withColumn("row", F.monotonically_increasing_id()), "pages-lines")
    deleted = staged(_deleted(rows, staged(_shared(rows), "pages-shared")), "pages-deleted")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [main_text(list(x), list(k), () if d is None else set(d))
                    for x, k, d in zip(*(pdf[c] for c in ("lines", "kinds", "deleted")))]
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"],
                                "text": text})

    told = _with_deleted(rows.select("row", "page_id", "url", "lines", "kinds"), deleted)
    texts = map_batches(told.drop("row"), run, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
