"""Passages repeated across documents, by a sparse suffix array.

Words are runs between white space, lower-cased in ASCII. A passage is repeated
if 50 consecutive words of it occur in another document too. Of every window of
50 words the least hash of its ten-word seeds selects one position, so equal
windows select equal positions, and only about one suffix in twenty is kept.

A kept suffix is extended left and right over all windows that select it: its
reach. Suffixes are brought together by seed and, within a seed, by reach. Where
all copies of a seed have one reach, the whole of it is repeated. Else each
different reach is taken apart once into its windows, and these are compared.
So copies, however many, cost one row each and are never paired with another.

The copy in the least document id stays, the others are removed. Windows are
compared by two independent 64-bit hashes, seeds and reaches by one.

Edge cases: a null or short text has no window; a repeat within one document
only is no repeat; rows with a null id are left alone; rows that repeat an id
are one document; other columns are kept by ``cut`` and ignored else; no
documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.frames import map_rows, perhaps_among
from footfall.llm.words import Words, char_at, mix, pieces, runs, split_words, stretches
from footfall.sources.scratch import stored

LENGTH = 50
SEED = 10

_U = np.uint64
_PLACE = _U((1 << 28) - 1)


def select(words: Words, hashes: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and selected seed of every window, and the hash of every seed."""
    marks = runs(hashes, seed)
    starts = np.arange(max(0, len(hashes) - length + 1))
    starts = starts[words.row[starts] == words.row[starts + length - 1]]
    if not len(starts):
        return starts, starts, marks
    # The place breaks ties to the left, which depends on the window alone.
    least, span, width = (marks & ~_PLACE) | np.arange(len(marks)).astype(_U), 1, length - seed + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return starts, (least[starts] & _PLACE).astype(np.int64), marks


def _reaches(starts: np.ndarray, chosen: np.ndarray, hashes: np.ndarray, length: int):
    """Windows that select one place are neighbours: first index of each run, and the hash of its words."""
    head = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (np.diff(starts) != 1)])
    size = np.diff(np.r_[head, len(starts)])
    low, high = starts[head], starts[head] + size - 1 + length
    return head, size, low, high, mix(stretches(hashes, low, high), 7)


def _each(batches, length: int, seed: int):
    for batch in batches:
        for low, high, data, bounds in pieces(batch.column("text")):
            words = split_words(data, bounds)
            hashes = words.hashes()
            starts, chosen, marks = select(words, hashes, length, seed)
            yield batch.slice(low, high - low), words, hashes, starts, chosen, marks


def _suffixes(length: int, seed: int):
    def run(batches):
        for rows, words, hashes, starts, chosen, marks in _each(batches, length, seed):
            if len(starts):
                head, _, low, _, reach = _reaches(starts, chosen, hashes, length)
                found = [rows.column("doc_id").take(pa.array(words.row[low])), _long(marks[chosen[head]]), _long(reach)]
                yield pa.RecordBatch.from_arrays(found, ["doc_id", "seed", "reach"])

    return run


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _windows(length: int, seed: int):
    """Windows of the wanted reaches, as two hashes and the place in the reach."""

    def run(batches):
        for rows, words, hashes, starts, chosen, _ in _each(batches, length, seed):
            if not len(starts):
                continue
            head, size, low, _, reach = _reaches(starts, chosen, hashes, length)
            wanted = rows.column("reaches").to_pylist()
            signed = reach.view(np.int64)
            owner = words.row[low]
            want = np.zeros(len(head), bool)
            for i, own in enumerate(wanted):
                a, b = np.searchsorted(owner, [i, i + 1])
                want[a:b] = np.isin(signed[a:b], own)
            pick = np.repeat(want, size)
            at = starts[pick]
            if len(at):
                one, two = runs(hashes, length), runs(mix(hashes, 9), length)
                place = (np.arange(len(starts)) - np.repeat(head, size))[pick]
                found = [_long(one[at]), _long(two[at]), _long(np.repeat(reach, size)[pick]), pa.array(place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(found, ["one", "two", "reach", "place"])

    return run


def _spans(length: int, seed: int, names: list[str], cut: bool):
    """Repeated spans of each text, or the text without the ones to remove."""

    def run(batches):
        for rows, words, hashes, starts, chosen, _ in _each(batches, length, seed):
            ids, flagged = rows.column("doc_id").to_pylist(), rows.column("__flagged").to_pylist()
            spans: list[list[dict]] = [[] for _ in ids]
            if len(starts):
                head, size, low, _, reach = _reaches(starts, chosen, hashes, length)
                owner, signed = words.row[low], reach.view(np.int64).tolist()
                known = {(i, f["reach"]): f["runs"] for i, own in enumerate(flagged) for f in own or ()}
                for i, r, first, n in zip(owner.tolist(), signed, low.tolist(), size.tolist()):
                    for part in known.get((i, r), ()):
                        last = n - 1 if part["high"] is None else part["high"]
                        spans[i].append((first + part["low"], first + last + length, part["first"]))
            yield _finish(rows, words, ids, spans, names, cut)

    return run


def _finish(rows, words: Words, ids: list, spans: list, names: list[str], cut: bool):
    merged = [_merged(own, doc) for own, doc in zip(spans, ids)]
    if not cut:
        made = []
        for i, own in enumerate(merged):
            base = words.bounds[i]
            text = words.data[base : words.bounds[i + 1]]
            ends = np.array([(words.start[a] - base, words.end[b - 1] - base) for a, b, _, _ in own], np.int64).reshape(-1, 2)
            at = char_at(text, ends)
            made.append(
                [
                    {"start": int(p), "end": int(q), "n_words": b - a, "first_doc": first, "removed": removed}
                    for (a, b, first, removed), (p, q) in zip(own, at)
                ]
            )
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()), ("first_doc", rows.column("doc_id").type), ("removed", pa.bool_())])
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(made, pa.list_(kind))], ["doc_id", "spans"])
    texts, whole = rows.column("text").to_pylist(), np.ones(len(ids), bool)
    sizes = rows.column("n_chars").to_pylist() if "n_chars" in names else []
    for i, own in enumerate(merged):
        kept, at = [], words.bounds[i]
        for a, b, _, removed in own:
            if removed:
                kept.append(words.data[at : words.start[a]].tobytes())
                at = words.end[b - 1]
        if kept:
            kept.append(words.data[at : words.bounds[i + 1]].tobytes())
            texts[i] = b"".join(kept).decode()
            whole[i] = any(texts[i].split())
            if sizes:
                sizes[i] = len(texts[i])
    made = {"text": texts} | ({"n_chars": sizes} if sizes else {})
    out = [pa.array(made[n], rows.schema.field(n).type) if n in made else rows.column(n) for n in names]
    return pa.RecordBatch.from_arrays(out, names).filter(pa.array(whole))


def _merged(spans: list[tuple], doc) -> list[tuple]:
    """``(low, high, first document, removed)`` in word numbers; what is removed and what stays are merged apart."""
    out = []
    for removed in (True, False):
        last = None
        for low, high, first in sorted(s for s in spans if (s[2] != doc) == removed):
            if last and low <= last[1]:
                last[1], last[2] = max(last[1], high), min(last[2], first)
            else:
                last = [low, high, first, removed]
                out.append(last)
    return sorted(map(tuple, out))


def flagged_reaches(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``(doc_id, flagged)``: for each document with repeated windows, its reaches and the runs of windows in them.

    A run has the place of its first and last window in the reach and the least
    document that has it.
    """
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    kind = docs.schema["doc_id"].dataType.simpleString()
    suffixes = stored(docs.mapInArrow(_suffixes(length, seed), f"doc_id {kind}, seed bigint, reach bigint"), "suffixes")
    told = stored(repeated_reaches(docs, suffixes, length, seed), "flagged")
    return (
        suffixes.select("doc_id", "reach").distinct().join(told, "reach")
        .groupBy("doc_id").agg(F.collect_list(F.struct("reach", "runs")).alias("flagged"))
    )


def repeated_reaches(docs: DataFrame, suffixes: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``(reach, runs)``: the reaches among ``suffixes``, rows ``(doc_id, seed, reach)``, that have repeated windows.

    Few other texts than those whose windows are compared are moved.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    reaches = suffixes.groupBy("seed", "reach").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    reaches = stored(reaches, "reaches")
    seeds = reaches.groupBy("seed").agg(F.count("*").alias("n"), F.min("first").alias("low"), F.max("last").alias("high"))
    shared = stored(reaches.join(seeds.where("low <> high").select("seed", "n"), "seed"), "shared")
    # One reach only: repeated as a whole.
    run = "array<struct<low:int,high:int,first:%s>>" % kind
    whole = shared.where("n = 1").select(
        "reach", F.array(F.struct(F.lit(0).alias("low"), F.lit(None).cast("int").alias("high"), F.col("first"))).cast(run).alias("runs")
    )
    # Several: the windows of each, from the first document that has it.
    parts = shared.where("n > 1").select("reach", "first", "last")
    wanted = parts.groupBy("first").agg(F.collect_set("reach").alias("reaches")).withColumnRenamed("first", "doc_id")
    wanted = stored(wanted, "wanted")
    windows = perhaps_among(docs, wanted, "doc_id").join(wanted, "doc_id").mapInArrow(
        _windows(length, seed), "one bigint, two bigint, reach bigint, place int"
    )
    windows = stored(windows.distinct().join(parts.groupBy("reach").agg(F.min("first").alias("first"), F.max("last").alias("last")), "reach"), "windows")
    met = windows.groupBy("one", "two").agg(F.min("first").alias("low_doc"), F.max("last").alias("high_doc")).where("low_doc <> high_doc")
    hits = windows.join(met, ["one", "two"]).select("reach", F.struct("place", F.col("low_doc").alias("first")).alias("hit"))
    each = hits.groupBy("reach").agg(F.sort_array(F.collect_set("hit")).alias("hits"))
    # Places that follow each other and have one first document make one run.
    step = lambda runs, h: F.when(
        (F.size(runs) > 0) & (F.element_at(runs, -1)["high"] + 1 == h["place"]) & (F.element_at(runs, -1)["first"] == h["first"]),
        F.concat(
            F.slice(runs, F.lit(1), F.size(runs) - 1),
            F.array(F.struct(F.element_at(runs, -1)["low"].alias("low"), h["place"].alias("high"), h["first"].alias("first"))),
        ),
    ).otherwise(F.concat(runs, F.array(F.struct(h["place"].alias("low"), h["place"].alias("high"), h["first"].alias("first")))))
    part = each.select("reach", F.aggregate("hits", F.array().cast(run), lambda r, h: step(r, h).cast(run)).alias("runs"))
    return whole.unionByName(part)


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``(doc_id, start, end, n_words, first_doc, removed)``: every repeated passage of every document.

    ``start`` and ``end`` are code points of the text, end excluded. ``first_doc``
    is the least document that has a window of the passage; where that is the
    document itself, the passage stays.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    flagged = stored(flagged_reaches(docs, length, seed), "flagged")
    rows = perhaps_among(docs.select("doc_id", "text"), flagged, "doc_id").join(flagged, "doc_id").withColumnRenamed("flagged", "__flagged")
    spans = f"doc_id {kind}, spans array<struct<start:bigint,end:bigint,n_words:bigint,first_doc:{kind},removed:boolean>>"
    return rows.mapInArrow(_spans(length, seed, [], False), spans).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")


def cut(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``docs`` with all columns, without the passages that an earlier document has.

    Texts without such passages stay as they are, to the byte. Of a text that is
    cut ``n_chars``, if there is one, becomes the new length; a document that is
    left without a word goes.
    """
    flagged = stored(flagged_reaches(docs, length, seed), "flagged")
    tag = flagged.select(F.col("doc_id").alias("__doc"), F.col("flagged").alias("__flagged"))
    # What is repeated grows with the corpus and is not broadcast.
    joined = docs.join(tag.hint("merge"), F.col("doc_id") == F.col("__doc"), "left").drop("__doc")
    return map_rows(joined, _spans(length, seed, docs.columns, True), docs.schema)
