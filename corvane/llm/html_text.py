"""Main text of web pages: page structure, and boilerplate found by host suffix arrays.

Each page becomes a stream of blocks. Markup that names its purpose decides
first: what stands in menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and comments is chrome, what stands in an article is
text. Blocks that markup leaves open are decided by the host, by the suffixes of
all its pages' token streams. Boilerplate is

- a substring of ``LONG`` times ``LENGTH`` tokens or more, or a whole block of
  ``LENGTH`` or more, that two different pages hold,
- a shorter whole block, or a substring of ``LENGTH`` or more at an edge of its
  block, that most pages of the host hold, and ``MANY`` at least.

These tokens go, all others stay: sentences of articles that share some words
with another page are not boilerplate.

The suffixes of all pages form one array, sorted by host and tokens over ranges of
all tasks. Neighbours in it with a common prefix of some length are an interval:
a repeated substring, whose pages are counted without listing them, because each
suffix knows what it shares with its page's previous one (:func:`host_array`,
:func:`repeated_runs`). Suffixes are cut at ``LONG`` times ``LENGTH`` tokens, longer
repeats are covered by those of that length. Equal suffixes are counted where their
pages are read, so a host of any size is spread over all tasks.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.bloom import without
from corvane.llm.shingles import word_hashes
from corvane.llm.tables import named, ship, written

LENGTH = 6  # tokens of the shortest repeated substring that counts
WORD = 8  # bytes of a token in a suffix
LONG = 4  # times LENGTH, the tokens of a substring that need not stand on most pages
MANY = 3  # pages that hold what counts only on most pages

TEXT, OPEN, CHROME = "text", "open", "chrome"

# Names of HTML elements.
_RAW = "script|style|noscript|template|iframe|object|svg|textarea|select|title|xmp|noembed|noframes"
_CHROME = {
    "nav", "footer", "aside", "form", "head", "button", "menu", "dialog", "label", "fieldset", "option", "datalist",
    "canvas", "audio", "video", "map", "applet",
}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
# Words in class, id or role attributes that name chrome.
_BEFORE, _AFTER = r"(?:^|\s|(?<!\bhas)(?<!\bwith)(?<!\bno)[_-])", r"(?:$|[\s_-])"
_NAMED_CHROME = re.compile(
    rf"{_BEFORE}(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed|s)?|promo(?:tion|s)?|"
    r"popup|newsletter|signup|login|nav|navbar|"
    r"navigation|menu|menubar|breadcrumbs?|pagination|pager|sidebar|aside|widget|related|recommended|recommendations|"
    rf"trending|comments?|commentlist|disqus|replies|respond|footer|complementary|contentinfo|teasers?|outbrain|taboola){_AFTER}"
)
# These too, but they also stand on wrappers of articles, as names of a topic, a state or the page's layout.
_WEAKLY_NAMED = re.compile(
    rf"{_BEFORE}(?:banner|cookies?|consent|gdpr|notices?|alert|modal|overlay|subscribe|subscription|paywall|"
    rf"share|sharing|social|masthead|toolbar|skip|search|toc|tags?|topbar|copyright|disclaimer){_AFTER}"
)
_ARTICLE_ROLE = re.compile(r"""\brole\s*=\s*["']?(?:main|article)\b""", re.I)
_BEGIN = re.compile(rf"<!--|<!\[CDATA\[|<({_RAW})\b|<(/?)([a-z][^\s/>]*)|<[!?/]", re.I)
_SPECIAL = re.compile("[>\"']")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW.split("|")}
_HOST = r"^[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)"
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


class _Weak:
    """The kind of what stands in an element of a weak name: chrome, unless the element holds an article."""

    def __init__(self, outer: str | _Weak):
        self.outer, self.holds = outer, False

    def kind(self) -> str:
        each = self
        while isinstance(each, _Weak):
            if not each.holds:
                return CHROME
            each = each.outer
        return each


def _kind_of(tag: str, attributes: str, outer: str | _Weak, main_counts: bool, all_weak: bool) -> str | _Weak:
    if outer == CHROME or tag in _CHROME or attributes and _HIDDEN.search(attributes):
        return CHROME
    if tag == "article" or main_counts and (tag == "main" or attributes and _ARTICLE_ROLE.search(attributes)):
        while isinstance(outer, _Weak) and not outer.holds:
            outer.holds, outer = True, outer.outer
        return TEXT
    if attributes and tag not in ("html", "body"):
        names = [(found[1] or found[2] or found[3] or "").lower() for found in _NAMES.finditer(attributes)]
        if any(map(_NAMED_CHROME.search, names)):
            return _Weak(outer) if all_weak else CHROME
        if any(map(_WEAKLY_NAMED.search, names)):
            return _Weak(outer)
    if tag == "header":
        inner = outer
        while isinstance(inner, _Weak):
            inner = inner.outer
        if inner != TEXT:
            return CHROME
    return outer


@dataclass(frozen=True)
class _Markup:
    start: int
    end: int
    raw: bool = False
    comment: bool = False
    slash: bool = False
    tag: str = ""
    attributes: str = ""


class _TagEnds:
    """Where tags end: at the first ``>`` outside quotes. Each quote or ``>`` of the source is passed once."""

    def __init__(self, source: str):
        self.source = source
        self.places = [found.start() for found in _SPECIAL.finditer(source)]
        self.known: dict[int, int] = {}

    def after(self, at: int) -> int:
        """The place of the ``>`` that ends a tag whose attributes begin at ``at``; -1 where quotes leave none."""
        index, passed = bisect_left(self.places, at), []
        end = -1
        while index < len(self.places):
            if index in self.known:
                end = self.known[index]
                break
            passed.append(index)
            place = self.places[index]
            if self.source[place] == ">":
                end = place
                break
            closing = self.source.find(self.source[place], place + 1)
            if closing < 0:
                break
            index = bisect_right(self.places, closing)
        self.known.update(dict.fromkeys(passed, end))
        return end


def _markups(source: str) -> Iterator[_Markup]:
    """Tags, comments and raw elements in order. The time is linear in the page, however it is written."""
    ends, at, last = _TagEnds(source), 0, source.rfind(">")
    while (begin := _BEGIN.search(source, at)) is not None:
        start, at = begin.start(), begin.end()
        opening = source[start : start + 9].upper()
        if opening.startswith("<!--") or opening == "<![CDATA[":
            mark = "-->" if opening.startswith("<!--") else "]]>"
            end = source.find(mark, at)
            at = len(source) if end < 0 else end + 3
            yield _Markup(start, at, comment=mark == "-->")
            continue
        if last < at:  # no tag ends any more
            at = start + 1
            continue
        end = source.find(">", at)
        if begin[1]:
            closing = _RAW_END[begin[1].lower()].search(source, end + 1)
            at = closing.end() if closing else len(source)
            yield _Markup(start, at, raw=True)
            continue
        if begin[3]:
            quoted = ends.after(at)
            end = quoted if quoted >= 0 else end
            yield _Markup(start, end + 1, slash=bool(begin[2]), tag=begin[3].lower(), attributes=source[at:end])
        else:
            yield _Markup(start, end + 1)
        at = end + 1


def blocks_of(source: str) -> list[tuple[str, str]]:
    """(kind, text) of the blocks of a page in order; empty blocks are left out.

    Inline markup does not end a block, every other tag does. Character
    references are decoded and white space in a block is one space. When the
    names of elements would leave nothing but chrome, they do not hide articles.
    """
    found = _blocks(source, False)
    return found if any(kind != CHROME for kind, _ in found) else _blocks(source, True)


def _blocks(source: str, all_weak: bool) -> list[tuple[str, str]]:
    main_counts = not re.search(r"<article[\s>/]", source, re.I)
    stack: list[tuple[str, str | _Weak]] = []
    kind, found, pieces, at = OPEN, [], [], 0

    def close() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append((kind, text))
            pieces.clear()

    opened: Counter[str] = Counter()
    for markup in _markups(source):
        if markup.start > at:
            pieces.append(source[at : markup.start])
        at = markup.end
        if markup.raw:
            continue  # raw elements hold no text and do not end a block
        tag, attributes = markup.tag, markup.attributes
        if not tag:
            if not markup.comment:
                close()
            continue
        if tag not in _INLINE:
            close()
        if markup.slash:
            while opened[tag]:
                last, outer = stack.pop()
                opened[last] -= 1
                if last == tag:
                    if outer != kind:
                        close()
                    kind = outer
                    break
        elif tag not in _VOID and not attributes.endswith("/"):
            inner = _kind_of(tag, attributes, kind, main_counts, all_weak)
            if inner != kind:
                close()
            stack.append((tag, kind))
            opened[tag] += 1
            kind = inner
    if at < len(source):
        rest = source[at:]
        pieces.append(rest[: rest.rfind("<")] if re.search(r"<[a-z/!][^>]*\Z", rest, re.I) else rest)
    close()
    return [(kind.kind() if isinstance(kind, _Weak) else kind, text) for kind, text in found]


def suffix_runs(tokens: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``length`` tokens of each suffix, as a fingerprint, with their place and end.

    ``stops`` holds for each token the end of its block: runs do not leave
    their block, and a block of fewer tokens is one run.
    """
    places = np.arange(len(tokens))
    begins = np.searchsorted(stops, stops)
    whole = (stops - begins < length) & (places == begins)
    kept = np.flatnonzero((places + length <= stops) | whole)
    ends = np.minimum(kept + length, stops[kept])
    runs = (ends - kept).astype(np.uint64)
    for at in range(length):
        inside = kept + at < ends
        step = np.zeros(len(kept), dtype=np.uint64)
        step[inside] = tokens[(kept + at)[inside]]
        runs = (runs ^ step) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(29)
    return runs.view(np.int64), kept, ends


def _stream(blocks) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The tokens of a page's open and chrome blocks, their hashes, and where the block of each ends."""
    words, stops = [], []
    for kind, text in blocks:
        if kind != TEXT:
            own = text.split(" ")
            words += own
            stops += [len(words)] * len(own)
    hashes, _ = word_hashes([word.encode() for word in words])
    return words, hashes, np.array(stops, dtype=np.int64)


def _page_mark(blocks) -> int:
    """Pages with the same blocks count as one page."""
    shown = "\n".join(f"{kind} {text}" for kind, text in blocks)
    return int.from_bytes(hashlib.blake2b(shown.encode(), digest_size=8).digest(), "little", signed=True)


def _pairs(column: pa.Array) -> list[list[tuple[str, str]]]:
    return [[(each["kind"], each["text"]) for each in blocks] for blocks in column.to_pylist()]


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, host, closed, mark, blocks): ``closed`` when markup decides every block.

    Of closed pages ``blocks`` holds the text as one block, of others all blocks.
    """
    rows = pages.select(
        named(id_col).alias("page_id"),
        named(url_col).alias("url"),
        F.lower(F.coalesce(F.regexp_extract(named(url_col), _HOST, 1), F.lit(""))).alias("host"),
        F.coalesce(named(html_col), F.lit("")).alias("html"),
    )
    ship(pages.sparkSession)
    block_type = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            closed, marks, kept = [], [], []
            for page in batch.column(3).to_pylist():
                blocks = blocks_of(page)
                whole = not any(kind == OPEN for kind, _ in blocks)
                chrome = [block for block in blocks if block[0] == CHROME]
                text = " ".join(text for kind, text in blocks if kind == TEXT)
                closed.append(whole)
                blocks = chrome + [(TEXT, text)] if whole else blocks
                marks.append(_page_mark(blocks))
                kept.append([{"kind": kind, "text": text} for kind, text in blocks])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at) for at in range(3)), pa.array(closed), pa.array(marks, pa.int64()),
                 pa.array(kept, block_type)],
                names=["page_id", "url", "host", "closed", "mark", "blocks"],
            )

    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    return rows.mapInArrow(
        batches,
        f"page_id {kinds['page_id']}, url {kinds['url']}, host string, closed boolean, mark bigint, "
        "blocks array<struct<kind:string,text:string>>",
    )


def _page_runs(blocks, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of a page, and whether each counts only on most pages of the host."""
    _, tokens, stops = _stream(blocks)
    wide = np.unique(suffix_runs(tokens, stops, length)[0])
    runs, places, ends = suffix_runs(tokens, stops, LONG * length)
    long = np.unique(runs[ends - places >= length])
    return np.concatenate((wide, long)), np.repeat([True, False], [len(wide), len(long)])


def _all_runs(pages: DataFrame, length: int, owner: str) -> DataFrame:
    """(host, run, wide, owner) of the runs of each page."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [_page_runs(blocks, length) for blocks in _pairs(batch.column(1))]
            at = pa.array(np.repeat(np.arange(len(found)), [len(runs) for runs, _ in found]))
            runs, wide = (np.concatenate(parts) for parts in zip(*found, strict=True)) if found else ([], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(runs, pa.int64()), pa.array(wide, pa.bool_()), batch.column(2).take(at)],
                names=["host", "run", "wide", owner],
            )

    return pages.select("host", "blocks", owner).mapInArrow(
        batches, f"host string, run bigint, wide boolean, {owner} bigint"
    )


def page_suffixes(blocks, length: int) -> list[tuple[bytes, bool, bool]]:
    """The suffixes of a page's tokens, sorted, each once: (suffix, whole, fresh).

    A suffix ends with its block and after LONG * length tokens at the latest; ``whole``
    marks a block of fewer tokens. Suffixes of fewer than ``length`` tokens are left out
    unless they are a block. ``fresh`` ones share fewer than ``length`` tokens with their predecessor.
    """
    _, tokens, stops = _stream(blocks)
    begins = np.searchsorted(stops, stops)
    data, found = tokens.tobytes(), set()
    for place, (begin, stop) in enumerate(zip(begins.tolist(), stops.tolist(), strict=True)):
        if place + length <= stop or place == begin:
            whole = place == begin and stop - begin < LONG * length
            found.add((data[WORD * place : WORD * min(place + LONG * length, stop)], whole))
    last, rows = b"", []
    for suffix, whole in sorted(found):
        rows.append((suffix, whole, common_tokens(last, suffix) < length))
        last = suffix
    return rows


def common_tokens(one: bytes, other: bytes) -> int:
    """The length of the longest common prefix of two suffixes."""
    least = min(len(one), len(other))
    return next((at for at in range(0, least, WORD) if one[at : at + WORD] != other[at : at + WORD]), least) // WORD


def host_array(pages: DataFrame, length: int) -> DataFrame:
    """(host, suffix, whole, fresh, pages): the sorted suffixes of each host, in files of consecutive ranges.

    ``pages`` counts the pages that hold the suffix with the same ``fresh``; pages
    with equal blocks count once.
    """
    if "row" not in pages.columns:
        pages = written(pages.withColumn("row", F.monotonically_increasing_id()), "numbered")
    marks = pages.groupBy("host", "mark").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("same"))
    again = pages.select("host", "mark", "row").join(marks.filter("same > 1"), ["host", "mark"])
    single = without(pages.select("row", "host", "blocks"), "row", again.filter("row <> first"), "row")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [page_suffixes(blocks, length) for blocks in _pairs(batch.column(1))]
            at = pa.array(np.repeat(np.arange(len(found)), [len(rows) for rows in found]))
            suffixes, whole, fresh = zip(*(row for rows in found for row in rows), strict=True) if any(found) else ([],) * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(suffixes, pa.binary()), pa.array(whole, pa.bool_()), pa.array(fresh, pa.bool_())],
                names=["host", "suffix", "whole", "fresh"],
            )

    suffixes = single.select("host", "blocks").mapInArrow(batches, "host string, suffix binary, whole boolean, fresh boolean")
    counted = suffixes.groupBy("host", "suffix", "whole", "fresh").agg(F.count(F.lit(1)).alias("pages"))
    counted = written(counted, "suffixes")
    return counted.repartitionByRange("host", "suffix").sortWithinPartitions("host", "suffix", "whole")


def _fingerprints(prefixes: list[bytes], length: int) -> np.ndarray:
    """What :func:`suffix_runs` gives for suffixes of these tokens, ``length`` at most."""
    stops = np.cumsum([len(prefix) // WORD for prefix in prefixes], dtype=np.int64)
    tokens = np.frombuffer(b"".join(prefixes), dtype=np.uint64)
    return suffix_runs(tokens, np.repeat(stops, [len(prefix) // WORD for prefix in prefixes]), length)[0]


def repeated_runs(pages: DataFrame, length: int = LENGTH) -> DataFrame:
    """(host, run, wide, pages) of token runs that different pages of the host hold, with the number of these.

    They are the intervals of the sorted suffixes whose neighbours have ``length`` tokens
    in common, or all. Of a page's suffixes in an interval of ``length`` tokens only the first one is
    fresh. An interval that two ranges share is added up from its parts.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = ("", b"", False)
        counts = {True: 0, False: 0}

        def closed(wide: bool) -> tuple:
            host, suffix, _ = last
            return host, suffix[: WORD * length] if wide else suffix, wide, counts[wide]

        def rows_of(found: list[tuple]) -> pa.RecordBatch:
            found = [row for row in found if row[3]]
            hosts, _, wide, held = zip(*found, strict=True) if found else ([],) * 4
            runs = np.zeros(len(found), dtype=np.int64)
            for kind, most in ((True, length), (False, LONG * length)):
                at = [place for place, row in enumerate(found) if row[2] == kind]
                if at:
                    runs[at] = _fingerprints([found[place][1] for place in at], most)
            return pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(runs), pa.array(wide, pa.bool_()), pa.array(held, pa.int64())],
                names=["host", "run", "wide", "pages"],
            )

        for batch in source:
            found = []
            for host, suffix, whole, fresh, held in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                common = common_tokens(last[1], suffix) if host == last[0] else 0
                same_size = len(suffix) == len(last[1])
                if common < min(length, len(suffix) // WORD) or common < length and not same_size or host != last[0]:
                    found.append(closed(True))
                    counts[True] = 0
                if (host, suffix, whole) != last:
                    found.append(closed(False))
                    counts[False] = 0
                last = host, suffix, whole
                counts[True] += held if fresh else 0
                long = len(suffix) == WORD * LONG * length or whole and len(suffix) >= WORD * length
                counts[False] += held if long else 0
            yield rows_of(found)
        yield rows_of([closed(True), closed(False)])

    array = host_array(pages, length)
    runs = array.mapInArrow(batches, "host string, run bigint, wide boolean, pages bigint")
    return runs.groupBy("host", "run", "wide").agg(F.sum("pages").alias("pages")).filter("pages > 1")


def unique_text(blocks: list[tuple[str, str]], long: set[int], wide: set[int], length: int) -> str:
    """The text of a page's article blocks, and of open blocks what is no boilerplate.

    ``long`` runs are boilerplate wherever they stand, ``wide`` ones at an edge of their block.
    """
    words, tokens, stops = _stream(blocks)

    def covered_by(known: set[int], length: int, least: int) -> np.ndarray:
        covered = np.zeros(len(words), dtype=bool)
        runs, places, ends = suffix_runs(tokens, stops, length)
        held = np.isin(runs, np.array(sorted(known), dtype=np.int64)) & (ends - places >= least)
        for at in np.flatnonzero(held):
            covered[places[at] : ends[at]] = True
        return covered

    covered, shared = covered_by(long, LONG * length, length), covered_by(wide, length, 1)
    kept, begin = [], 0
    for kind, text in blocks:
        if kind == TEXT:
            kept.append(text)
            continue
        stop = begin + len(text.split(" "))
        if kind == OPEN:
            own = ~covered[begin:stop]
            inner = np.flatnonzero(~shared[begin:stop])
            edges = (inner[0], inner[-1] + 1) if len(inner) else (stop - begin, 0)
            own[: edges[0]] = False
            own[edges[1] :] = False
            if own.any():
                kept.append(" ".join(words[begin + at] for at in np.flatnonzero(own)))
        begin = stop
    return " ".join(kept)


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    length: int = LENGTH,
) -> DataFrame:
    """page_id, url, text and n_chars (code points) per row.

    Suffixes of every page enter the host's array, and every block that markup
    leaves open looks up its own there; a page without such a block has nothing to look up.
    Null and empty pages have an empty text. Pages without a host form one
    host. Repeated rows and pages with equal blocks count as one page when
    runs are counted, and each gets its text. An empty table gives an empty
    result.
    """
    pages = written(
        parsed(pages, id_col, url_col, html_col).withColumn("row", F.monotonically_increasing_id()), "pages"
    )
    closed = pages.filter("closed").select(
        "page_id", "url", F.element_at("blocks", -1)["text"].alias("text")
    )
    left = pages.filter("NOT closed")
    covered = (
        _all_runs(left, length, "row")
        .join(repeated_runs(pages, length), ["host", "run", "wide"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("run", "wide", "pages")).alias("runs"))  # at most two per token of one page
    )
    totals = pages.groupBy("host").agg(F.count_distinct("mark").alias("total"))
    rows = left.join(totals, "host").join(covered, "row", "left").select("page_id", "url", "blocks", "runs", "total")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = []
            columns = (_pairs(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            for blocks, runs, total in zip(*columns, strict=True):
                long = {each["run"] for each in runs or [] if not each["wide"]}
                most = max(MANY, total // 2 + 1)
                wide = {each["run"] for each in runs or [] if each["wide"] and each["pages"] >= most}
                texts.append(unique_text(blocks, long, wide, length))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    opened = rows.mapInArrow(batches, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return closed.unionByName(opened).withColumn("n_chars", F.length("text").cast("long"))
