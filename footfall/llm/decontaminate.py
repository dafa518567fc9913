"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are lower-cased in ASCII and reduced to words of letters, digits and all
that is not ASCII, with one blank between. A window is ten consecutive words of
a benchmark item, or the whole of a shorter one. The automaton of all windows
reads every document once; hits are mapped back to words and to code points of
the original text.

The automaton holds at most ``limit`` bytes of windows, which bounds what each
Python worker keeps. A larger benchmark is split into several automata by a hash
of the window, and what each of them finds is merged by document.

Edge cases: null or empty texts have no words and no hits; an item without
words has no window; a null item id counts as the empty string; windows that
several items share count for each. Repeated documents get the same result
each, other columns are ignored, and an empty benchmark finds nothing.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.frames import map_rows
from footfall.sources.scratch import stored

WINDOW = 10
#: Bytes of windows in one automaton; it takes roughly eighty times as much memory.
LIMIT = 2 << 20

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SPAN = "array<struct<low:int,high:int>>"
_FOUND = f"n_words bigint, words {_SPAN}, spans {_SPAN}, items array<string>"


def _split(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _joined(words: list[bytes]) -> str:
    """One character per byte, so that an automaton of characters can read it."""
    return f" {b' '.join(words).decode('latin-1')} "


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(window, n, items)``: each different window, its number of words and the items that have it."""

    def run(batches):
        for batch in batches:
            found = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = _split(text)
                for i in range(max(1, len(words) - size + 1) if words else 0):
                    part = words[i : i + size]
                    found.append({"window": _joined(part), "n": len(part), "item": item})
            yield pa.RecordBatch.from_pylist(found, pa.schema([("window", pa.string()), ("n", pa.int32()), ("item", pa.string())]))

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return (
        rows.mapInArrow(run, "window string, n int, item string")
        .groupBy("window", "n")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _characters(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where runs of words lie in the text as it was."""
    if not words:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    return [(at[low][0], at[high - 1][1]) for low, high in words]


def _automaton(patterns):
    machine = ahocorasick.Automaton()
    for window, n, items in patterns:
        machine.add_word(window, (n, items))
    machine.make_automaton()
    return machine


def _find(machine, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Runs of hit words and the items found."""
    if machine is None or not words:
        return [], set()
    text = _joined(words)
    seen, before, hits, items = 0, 0, [], set()
    for end, (n, owners) in machine.iter(text):
        seen += text.count(" ", before, end + 1)
        before = end + 1
        hits.append((seen - 1 - n, seen - 1))  # blanks stand before each word and after the last
        items.update(owners)
    return _merge(hits), items


def _spans(pairs):
    return [{"low": a, "high": b} for a, b in pairs]


def _scan(docs: DataFrame, patterns: list, keep: list[str]) -> DataFrame:
    def run(batches):
        machine = _automaton(patterns) if patterns else None
        for batch in batches:
            texts = batch.column("text")
            raw = texts.cast(pa.binary())
            counts, words, spans, items = np.zeros(len(texts), np.int64), [], [], []
            for i in range(len(texts)):
                own = _split(raw[i].as_py())
                counts[i] = len(own)
                hit, found = _find(machine, own)
                words.append(_spans(hit))
                spans.append(_spans(_characters(texts[i].as_py(), hit)) if hit else [])
                items.append(sorted(found))
            pair = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
            made = [pa.array(counts), pa.array(words, pair), pa.array(spans, pair), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *made], [*keep, "n_words", "words", "spans", "items"]
            )

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, fields + _FOUND)


def _one(rows: DataFrame) -> DataFrame:
    """Merge overlapping runs that several automata found, with the characters they cover."""

    def run(batches):
        for batch in batches:
            words, spans = [], []
            for pairs in batch.column("pairs").to_pylist():
                w, s = [], []
                for pair in sorted(pairs, key=lambda p: (p["words"]["low"], p["words"]["high"])):
                    (low, high), chars = pair["words"].values(), pair["spans"]
                    if w and low <= w[-1]["high"]:
                        if high > w[-1]["high"]:
                            w[-1]["high"], s[-1]["high"] = high, chars["high"]
                    else:
                        w.append(pair["words"])
                        s.append(chars)
                words.append(w)
                spans.append(s)
            kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
            columns = [batch.column("key"), pa.array(words, kind), pa.array(spans, kind), batch.column("items")]
            yield pa.RecordBatch.from_arrays(columns, ["key", "words", "spans", "items"])

    return rows.mapInArrow(run, f"key bigint, words {_SPAN}, spans {_SPAN}, items array<string>")


def _parts(benchmark: DataFrame, size: int, limit: int) -> list[list]:
    """Windows for each automaton; one list unless they are more than ``limit`` bytes."""
    found = stored(windows(benchmark, size), "benchmark-windows")
    total = found.agg(F.sum(F.length("window"))).first()[0] or 0
    parts = max(1, -(-total // limit))
    split = F.pmod(F.xxhash64("window"), F.lit(parts))
    return [[tuple(r) for r in found.where(split == p).collect()] for p in range(parts)]


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """``docs`` with all columns, without those that have a window of the benchmark."""

    def without(patterns):
        def run(batches):
            machine = _automaton(patterns) if patterns else None
            for batch in batches:
                raw = batch.column("text").cast(pa.binary()).to_pylist()
                yield batch.filter(pa.array([not _find(machine, _split(x))[0] for x in raw], pa.bool_()))

        return run

    for patterns in _parts(benchmark, size, limit):
        docs = map_rows(docs, without(patterns), docs.schema)
    return docs


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], size: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """Columns ``keep`` of ``docs`` with the hits of each document.

    ``n_words``; ``words`` and ``spans``, the runs of hit words by word number
    and by code point, ends excluded; ``items``, the ids found, sorted.
    """
    patterns = _parts(benchmark, size, limit)
    if len(patterns) == 1:
        return _scan(docs, patterns[0], keep)
    # A text and its hits go together, so a hash of the text finds them again.
    keyed = docs.select(*dict.fromkeys([*keep, "text"])).withColumn("key", F.xxhash64("text"))
    texts = keyed.select("key", "text")
    hits = _scan(texts, patterns[0], ["key"]).where(F.size("words") > 0)
    for part in patterns[1:]:
        hits = hits.unionByName(_scan(texts, part, ["key"]).where(F.size("words") > 0))
    merged = hits.groupBy("key").agg(
        F.flatten(F.collect_set(F.arrays_zip("words", "spans"))).alias("pairs"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    base = _scan(keyed, [], [*keep, "key"]).drop("words", "spans", "items")
    out = base.join(_one(merged.select("key", "pairs", "items")), "key", "left")
    empty = {"words": _SPAN, "spans": _SPAN, "items": "array<string>"}
    return out.select(*keep, "n_words", *(F.coalesce(c, F.array().cast(t)).alias(c) for c, t in empty.items()))


def n_hit(words) -> object:
    """Number of words in the runs of a ``words`` column."""
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda total, s: total + (s["high"] - s["low"]))
