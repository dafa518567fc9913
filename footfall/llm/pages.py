"""Main text of web pages: structure first, then what a host repeats.

A small reader walks the tags of a page and gives every block of text a place:
*main* inside ``article`` or ``main``, *frame* inside menus, headers, footers,
sidebars, notices, adverts, forms, reader comments and the like, by element,
``role`` or words of ``class`` and ``id``, and *open* elsewhere. A page with a main part
has just that as its text. On other pages the open blocks count, without what
the host repeats: the streams of words outside main parts are concatenated by
host, and runs of at least 12 words that occur on another page of the host are
boilerplate. Equal runs meet by a hash of their windows, in an aggregation, so
a host of any number of pages is never in one task. Words that are not covered
stay; a page of which nothing would be left is a copy and keeps all.

Repetition alone cannot give right texts: menus and footers differ from page to
page, and articles may be copied. So it decides only where structure does not.

Edge cases: null or empty pages have an empty text; broken markup is read as far
as it goes, in time linear in its length, an unclosed element ends with the one around it
and a tag that is cut off at the end is no text; a null URL is a
host of its own; repeated rows get the same text each and do not count as
repetition; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.words import pieces, runs, split_words
from footfall.sources.scratch import stored

#: Words that a repeated run has at least.
RUN = 12

# Elements of HTML by what they are to a reader.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title", "textarea", "select", "canvas", "audio", "video"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
FRAME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"} | SILENT
UNSEEN = {"script", "style", "noscript", "template"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
ALONE = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
FRAME_WORDS = set(
    "ad ads advert adverts advertisement adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices "
    "notification alert popup modal newsletter subscribe subscription menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "footer header masthead comment comments disqus replies related recommended share sharing social widget toolbar".split()
)
FRAME_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())

_START = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))")
_STOP = re.compile("[>\"']")
_NAMES = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)


def _is_frame(name: str, rest: str) -> bool:
    if name in FRAME:
        return True
    if not rest or name in ("html", "body"):
        return False
    for key, value in _NAMES.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" and not value:
            return True
        if key == "role" and value in FRAME_ROLES:
            return True
        if key in ("class", "id") and FRAME_WORDS.intersection(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


def _tags(page: str):
    """``(from, to, closing, name, attributes)`` of all tags, in one pass; comments and the like have no name.

    A tag that is open at the end of the page ends with it. A quote that is never closed is a
    letter, and so are those before it from the tag on: such a stretch is scanned twice at most.
    """
    at, broken = 0, -1

    def end_of(start: int) -> int:
        nonlocal broken
        here = start
        while start > broken:
            stop = _STOP.search(page, here)
            if stop and stop[0] == ">":
                return stop.start()
            closing = page.find(stop[0], stop.end()) if stop else -1
            if closing < 0:
                broken = stop.start() if stop else len(page)
                break
            here = closing + 1
        return page.find(">", start)

    while tag := _START.search(page, at):
        if tag[0] == "<!--":
            end = page.find("-->", tag.end()) + 2
            at = end + 1 if end > 1 else len(page)
            yield tag.start(), at, False, "", ""
            continue
        end = end_of(tag.end()) if tag[2] else page.find(">", tag.end())
        at = end + 1 if end >= 0 else len(page)
        jump = yield tag.start(), at, bool(tag[1]), (tag[2] or "").lower() if end >= 0 else "", page[tag.end() : end] if tag[2] and end >= 0 else ""
        if jump:
            at = jump


def blocks(page: str) -> list[tuple[str, str]]:
    """``(place, text)`` of the blocks of a page, in order; place is main, frame or open."""
    out: list[tuple[str, str]] = []
    pieces_: list[str] = []
    stack: list[tuple[str, str]] = [("", "open")]

    def flush():
        text = " ".join("".join(pieces_).split())
        if text:
            out.append((stack[-1][1], text))
        pieces_.clear()

    opened = Counter()

    def close(name: str):
        if opened[name]:
            while True:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == name:
                    return

    at, tags = 0, _tags(page)
    tag = next(tags, None)
    while True:
        raw = page[at : tag[0] if tag else len(page)]
        if raw and stack[-1][0] not in SILENT:
            pieces_.append(html.unescape(raw) if "&" in raw else raw)
        if not tag:
            flush()
            return out
        _, at, closing, name, rest = tag
        jump = None
        place = stack[-1][1]
        if closing and name:
            if name not in INLINE or (place == "frame" and opened[name]):
                flush()
            close(name)
        elif name:
            frame = _is_frame(name, rest)
            if (name not in INLINE or frame) and name not in UNSEEN:
                flush()
            if not (name in VOID or rest.endswith("/") and name not in MAIN):
                if name not in INLINE and stack[-1][0] in ALONE and (stack[-1][0] == "p" or stack[-1][0] == name):
                    opened[stack.pop()[0]] -= 1  # a paragraph ends where the next block begins, an item at the next item
                    place = stack[-1][1]
                if frame or place == "frame":
                    inner = "frame"
                else:
                    inner = "main" if place == "main" or name in MAIN else "open"
                if name in RAW:  # markup in here is text
                    end = re.compile(rf"</{re.escape(name)}\b", re.IGNORECASE).search(page, at)
                    end = page.find(">", end.end()) if end else -1
                    jump = at = end + 1 if end >= 0 else len(page)
                else:
                    stack.append((name, inner))
                    opened[name] += 1
        try:
            tag = tags.send(jump)
        except StopIteration:
            tag = None


def _parsed(batches):
    for batch in batches:
        has_main, text, open_, around = [], [], [], []
        for page in batch.column("html").to_pylist():
            found = blocks(page or "")
            main = [t for p, t in found if p == "main"]
            has_main.append(bool(main))
            text.append(" ".join(main))
            open_.append([] if main else [t for p, t in found if p == "open"])
            around.append("\n".join(t for p, t in found if p != "main" and (main or p != "open")))
        made = [pa.array(has_main), pa.array(text), pa.array(open_, pa.list_(pa.string())), pa.array(around)]
        columns = ["page_id", "url", "host", "key"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made], [*columns, "has_main", "text", "open", "around"])


def _windows(run_words: int):
    """Hash of every run of ``run_words`` words of a page's stream, with its first word where it is of open blocks."""

    def run(batches):
        for batch in batches:
            for low, high, data, bounds in pieces(batch.column("stream")):
                words = split_words(data, bounds)
                hashes = runs(words.hashes(), run_words)
                start = np.arange(len(hashes))
                start = start[words.row[start] == words.row[start + run_words - 1]]
                first = words.first()
                rows = words.row[start]
                part = batch.slice(low, high - low).select(["host", "page_id", "key"]).take(pa.array(rows))
                made = [pa.array(hashes[start].view(np.int64)), pa.array((start - first[rows]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], ["host", "page_id", "key", "window", "at"])

    return run


def _uncovered(run_words: int):
    def run(batches):
        for batch in batches:
            texts = []
            for stream, covered in zip(batch.column("stream").to_pylist(), batch.column("covered").to_pylist()):
                words = stream.split()
                keep = np.ones(len(words), bool)
                for at in covered or ():
                    keep[at : at + run_words] = False
                texts.append(" ".join(w for w, k in zip(words, keep) if k) if keep.any() else " ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts)], ["page_id", "url", "text"])

    return run


def main_text(pages: DataFrame, run_words: int = RUN) -> DataFrame:
    """``(page_id, url, text)`` of every row of ``(page_id, url, html)``."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", "html", F.coalesce(host, F.lit("")).alias("host"), F.xxhash64("html").alias("key"))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    head = f"page_id {kinds['page_id']}, url {kinds['url']}, host string, key bigint"
    parsed = stored(rows.mapInArrow(_parsed, f"{head}, has_main boolean, text string, open array<string>, around string"), "pages")
    done = parsed.where("has_main").select("page_id", "url", "text")
    rest = parsed.where("NOT has_main").select("page_id", "url", "host", "key", F.array_join("open", " ").alias("stream"))
    fields = f"host string, page_id {kinds['page_id']}, key bigint, window bigint, at int"
    # Streams outside main parts: open blocks of these pages, and the frames of all.
    streams = rest.select("host", "page_id", "key", "stream")
    frames = parsed.select("host", "page_id", "key", F.col("around").alias("stream"))
    own = stored(streams.mapInArrow(_windows(run_words), fields), "windows")
    other = frames.mapInArrow(_windows(run_words), fields)
    met = own.select("host", "page_id", "window").unionByName(other.select("host", "page_id", "window"))
    met = met.groupBy("host", "window").agg(F.min("page_id").alias("low"), F.max("page_id").alias("high")).where("low <> high")
    hits = own.join(met.select("host", "window"), ["host", "window"], "left_semi")
    hits = hits.groupBy("page_id", "key").agg(F.collect_set("at").alias("covered"))
    joined = rest.join(
        hits.select(F.col("page_id").alias("p"), F.col("key").alias("k"), "covered"),
        F.col("page_id").eqNullSafe(F.col("p")) & F.col("key").eqNullSafe(F.col("k")), "left",
    )
    left = joined.select("page_id", "url", "stream", "covered").mapInArrow(
        _uncovered(run_words), f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    )
    return done.unionByName(left)
