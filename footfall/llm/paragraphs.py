"""Near-identical paragraphs of different documents, by banded MinHash.

A paragraph is a line of a text; those of fewer than ``min_words`` words are not
compared. The query compares every line with a word.
Its shingles are five consecutive words, lower-cased in ASCII. Equal paragraphs
are one, and shorter ones than a shingle are similar to equal ones only; the
others are signed with twelve bands of two minima each, which at a
similarity of 0.8 misses five pairs in a million. Paragraphs that meet in a
band are joined through pivots, verified by the exact Jaccard similarity of
their shingle sets, and clustered by connected components. Of each cluster the
first paragraph, by document and place, stays.

With ``passage`` lines that hold words of a passage of so many words or more that
stands in another document too, inside of lines or over several, are told as
well, and how many words of each line are in such passages. These are found as
in ``repeats``; only seeds that a filter of bits takes for shared are gone into.

Edge cases: null, empty and shorter paragraphs are left alone; a cluster within
one document is no repeat, unless ``across`` is off; rows with a null id are
left alone; rows that repeat an id are one document, and equal paragraphs in the
same place of it are one; other columns are ignored; no documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.frames import perhaps_among
from footfall.llm.linking import bag, links_among, shared
from footfall.llm.nearcopies import K, fingerprints, kmers
from footfall.llm.repeats import SEED, _reaches, repeated_reaches, select
from footfall.llm.words import Words, mix, pieces, runs, split_words
from footfall.sources.scratch import cleared, scratch_path, stored

MIN_WORDS = 20
SIMILARITY = 0.8
BANDS = 12
ROWS = 2

NAMES = ["doc_id", "para", "id", "n_words", *(f"b{b}" for b in range(BANDS))]

_MARKS = pa.list_(pa.struct([("seed", pa.int64()), ("reach", pa.int64()), ("low", pa.int32()), ("size", pa.int32())]))
_LINES = pa.list_(pa.struct([("id", pa.int64()), ("n_words", pa.int32())]))
_U = np.uint64
_A = mix(np.arange(BANDS * ROWS).astype(_U), 21) | _U(1)
_B = mix(np.arange(BANDS * ROWS).astype(_U), 22) | _U(1)


def _lines(batch):
    """Per piece: text row and place of every line, and the words with lines as rows."""
    for low, high, data, bounds in pieces(batch.column("text")):
        ends = np.flatnonzero(data == 10) + 1
        starts = np.unique(np.r_[bounds[:-1], ends]) if len(data) else np.zeros(0, np.int64)
        starts = starts[starts < len(data)].astype(np.int64)
        # Of texts that start at one place all but the last are empty.
        row = np.searchsorted(bounds, starts, side="right") - 1
        place = np.arange(len(starts)) - np.searchsorted(row, row)
        yield batch.slice(low, high - low), row, place, split_words(data, np.r_[starts, len(data)].astype(np.int64))


def _bands(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Band hashes of each line that has shingles, in order of ``rows``."""
    start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    out = np.empty((len(start), BANDS), _U)
    for b in range(BANDS):
        key = np.zeros(len(start), _U)
        for r in range(b * ROWS, (b + 1) * ROWS):
            h = values * _A[r]
            h ^= h >> _U(32)
            h *= _B[r]
            key = mix(key ^ np.minimum.reduceat(h, start), 30 + r)
        out[:, b] = mix(key, 60 + b)
    return out


def _lists(owner: np.ndarray, rows: int, columns: dict[str, np.ndarray]) -> pa.Array:
    """Structs as one list for each row; ``owner`` is sorted."""
    offsets = pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns.values()], list(columns)))


def _marked(part, row: np.ndarray, words: Words, hashes: np.ndarray, ids: np.ndarray, count: np.ndarray, passage: int):
    """Suffixes at minimisers and lines of every text of ``passage`` words or more."""
    own = Words(words.data, words.bounds, row[words.row], words.start, words.end)
    starts, chosen, seeds = select(own, hashes, passage, min(SEED, passage))
    if not len(starts):
        return None
    head, size, low, _, reach = _reaches(starts, chosen, hashes, passage)
    at, texts = np.searchsorted(own.row, np.arange(part.num_rows)), own.row[low]
    marks = {
        "seed": seeds[chosen[head]].view(np.int64), "reach": reach.view(np.int64),
        "low": (low - at[texts]).astype(np.int32), "size": size.astype(np.int32),
    }
    lists = [
        _lists(texts, part.num_rows, marks),
        _lists(row, part.num_rows, {"id": ids.view(np.int64), "n_words": count.astype(np.int32)}),
    ]
    some = pa.array(np.unique(texts))
    return part.column("doc_id").take(some), [c.take(some) for c in lists]


def _signed(min_words: int, passage: int | None):
    def run(batches):
        for batch in batches:
            for part, row, place, words in _lines(batch):
                count = np.diff(words.first())
                want = count >= min_words
                if not want.any() and not passage:
                    continue
                hashes = words.hashes()
                every = fingerprints(words, hashes)
                found = _marked(part, row, words, hashes, every, count, passage) if passage else None
                if found:
                    docs, lists = found
                    none = [pa.nulls(len(docs), t) for t in (pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * BANDS)]
                    yield pa.RecordBatch.from_arrays([docs, *none, *lists], NAMES + ["marks", "lines"])
                if not want.any():
                    continue
                rows, values = kmers(words, hashes)
                own = want[rows]
                ids = every[want]
                bands = _bands(rows[own], values[own]).view(np.int64)
                columns = [
                    part.column("doc_id").take(pa.array(row[want])), pa.array(place[want].astype(np.int32)),
                    pa.array(ids.view(np.int64)), pa.array(count[want].astype(np.int32)),
                    *(pa.array(np.ascontiguousarray(bands[:, b])) for b in range(BANDS)),
                ]
                if passage:
                    columns += [pa.nulls(len(ids), _MARKS), pa.nulls(len(ids), _LINES)]
                yield pa.RecordBatch.from_arrays(columns, NAMES + ["marks", "lines"] * bool(passage))

    return run


def _covered(batches):
    """Lines that passages reach, and how many of their words are in passages, and in those of an earlier document."""
    for batch in batches:
        docs, out = [], []
        for r, (lines, spans) in enumerate(zip(batch.column("lines"), batch.column("spans"))):
            ids, count = (lines.values.field(c).to_numpy() for c in ("id", "n_words"))
            low, high = (spans.values.field(c).to_numpy() for c in ("low", "high"))
            later = spans.values.field("later").to_numpy(zero_copy_only=False)
            ends, made = np.r_[0, np.cumsum(count)], []
            for own in (slice(None), later):
                step = np.zeros(ends[-1] + 1, np.int64)
                np.add.at(step, low[own], 1)
                np.add.at(step, high[own], -1)
                made.append(np.diff(np.r_[0, np.cumsum(np.cumsum(step[:-1]) > 0)][ends]))
            at = np.flatnonzero(made[0])
            docs.append(np.full(len(at), r))
            out.append(np.stack([at, ids[at], count[at], made[0][at], made[1][at]]))
        if docs:
            para, ids, count, repeated, removed = np.concatenate(out, axis=1).astype(np.int64)
            columns = [
                batch.column("doc_id").take(pa.array(np.concatenate(docs))), pa.array(para.astype(np.int32)), pa.array(ids),
                pa.array(count.astype(np.int32)), pa.array(repeated), pa.array(removed),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "para", "id", "n_words", "n_repeated", "n_removed"])


def _in_passages(docs: DataFrame, rows: DataFrame, passage: int) -> DataFrame:
    """``(doc_id, para, id, n_words, n_repeated, n_removed)`` of the lines that passages reach."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Texts of a repeated id are told apart by their lines.
    texts = rows.where("marks IS NOT NULL").withColumn("text", F.xxhash64("lines"))
    marks = texts.select("doc_id", "text", F.inline("marks"))
    seeds = marks.groupBy("seed").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    seeds = stored(seeds.where("least <> most").select("seed"), "seeds")
    marks = stored(perhaps_among(marks, seeds, "seed"), "marks")
    told = repeated_reaches(docs, marks.select("doc_id", "seed", "reach"), passage, min(SEED, passage))
    each = marks.join(told, "reach").select("doc_id", "text", F.col("low").alias("at"), "size", F.inline("runs"))
    span = F.struct(
        (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.coalesce("high", F.col("size") - 1) + passage).alias("high"),
        (F.col("first") != F.col("doc_id")).alias("later"),
    )
    held = each.groupBy("doc_id", "text").agg(F.collect_list(span).alias("spans"))
    held = texts.select("doc_id", "text", "lines").join(held, ["doc_id", "text"])
    return held.mapInArrow(_covered, f"doc_id {kind}, para int, id bigint, n_words int, n_repeated bigint, n_removed bigint")


def _is(hashes: np.ndarray, id_: int) -> bool:
    """Whether a line with these words has the fingerprint."""
    return len(hashes) > 0 and int((runs(hashes, len(hashes))[:1] | _U(1)).view(np.int64)[0]) == id_


def _shingles(batches):
    """Sorted shingle hashes of the wanted lines, packed, and their bag; lines of another text of the document go."""
    for batch in batches:
        for part, row, place, words in _lines(batch):
            wanted = part.column("wanted").to_pylist()
            hashes, at = words.hashes(), words.first()
            rows, values = kmers(words, hashes)
            first = np.searchsorted(rows, np.arange(len(row) + 1))
            line = {(r, p): i for i, (r, p) in enumerate(zip(row.tolist(), place.tolist()))}
            ids, packed, bags = [], [], []
            for r, own in enumerate(wanted):
                for w in own:
                    i = line.get((r, w["para"]))
                    if i is not None and _is(hashes[at[i] : at[i + 1]], w["id"]):
                        ids.append(w["id"])
                        own_set = np.unique(values[first[i] : first[i + 1]])
                        packed.append(own_set.tobytes())
                        bags.append(bag(own_set))
            columns = [pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(bags, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "shingles", "bag"])


def _similar(similarity: float):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                a, b = np.frombuffer(x, _U), np.frombuffer(y, _U)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(common >= similarity * (len(a) + len(b) - common) - 1e-9)
            yield batch.drop_columns(["left", "right"]).filter(pa.array(keep, pa.bool_()))

    return run


def repeated_paragraphs(
    docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, across: bool = True, passage: int | None = None
) -> DataFrame:
    """``(doc_id, para, n_words, first_doc, first_para, kept)`` of every paragraph that is in a cluster with another.

    ``para`` counts the lines of a text from 0; ``first_doc`` and ``first_para``
    name the paragraph of the cluster that stays. With ``passage`` there are rows
    of paragraphs in no cluster too, which stay, and two columns more:
    ``n_repeated`` words are in passages of so many words that stand in another
    document, ``n_removed`` of them in those of an earlier document.
    """
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, para int, id bigint, n_words int, " + ", ".join(f"b{b} bigint" for b in range(BANDS))
    if passage:
        fields += ", marks array<struct<seed:bigint,reach:bigint,low:int,size:int>>, lines array<struct<id:bigint,n_words:int>>"
    rows = stored(docs.mapInArrow(_signed(min_words, passage), fields), "paragraphs")
    counts = ["n_repeated", "n_removed"] if passage else []
    if passage:
        path = scratch_path(docs.sparkSession, "passages")
        with cleared():  # What they were made of goes before the lines are linked.
            covered = _in_passages(docs, rows, passage).where(F.col("n_words") >= min_words)
            covered.write.parquet(path)
        covered = docs.sparkSession.read.schema(covered.schema).parquet(path)
        rows = rows.where("para IS NOT NULL")
    # Lines shorter than a shingle are one, and meet their equals by id.
    texts = rows.where(F.col("n_words") >= K).groupBy("id").agg(*(F.first(f"b{b}").alias(f"b{b}") for b in range(BANDS)))
    texts = stored(texts.select("id", F.array(*(f"b{b}" for b in range(BANDS))).alias("sketches")), "signed")
    members = shared(texts)
    # Each different candidate once, from the first document that has it.
    place = F.struct("doc_id", "para")
    chosen = rows.join(members.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min(place).alias("at"))
    wanted = chosen.groupBy("at.doc_id").agg(F.collect_list(F.struct("id", "at.para")).alias("wanted"))
    # The file of places has a size that Spark knows: it is broadcast below Spark's own threshold only.
    wanted = stored(wanted, "candidates")
    few = perhaps_among(docs, wanted, "doc_id")
    packed = few.join(wanted, "doc_id").select("text", "wanted").mapInArrow(_shingles, "id bigint, shingles binary, bag binary")
    packed = stored(packed.dropDuplicates(["id"]), "shingles")

    def verify(pairs: DataFrame) -> DataFrame:
        size = F.length("shingles")
        left = packed.select(F.col("id").alias("a"), F.col("shingles").alias("left"), size.alias("n_left"))
        right = packed.select(F.col("id").alias("b"), F.col("shingles").alias("right"), size.alias("n_right"))
        near = F.least("n_left", "n_right") >= F.greatest("n_left", "n_right") * F.lit(similarity)
        both = pairs.join(left, "a").join(right, "b").where(near)
        return both.select(*pairs.columns, "left", "right").mapInArrow(_similar(similarity), pairs.schema)

    def alike(n, m, common):
        return common * (1 + similarity) >= similarity * (n + m) - 1e-6

    bags = packed.select("id", (F.length("shingles") / 8).cast("bigint").alias("size"), "bag")
    named = links_among(members, texts, verify, bags, alike, similarity)[1]
    lines = ["doc_id", "para", "id", "n_words"]
    if passage:
        told = rows.select(*lines, *(F.lit(0).cast("bigint").alias(c) for c in counts)).unionByName(covered)
        told = told.groupBy(*lines).agg(*(F.max(c).alias(c) for c in counts))
    else:
        told = rows.select(*lines).distinct()
    told = told.join(named, "id", "left")
    told = stored(told.select("doc_id", "para", "n_words", *counts, F.coalesce("component", "id").alias("cluster")), "clustered")
    cluster = told.groupBy("cluster").agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    cluster = cluster.where("n > 1 AND low <> high" if across else "n > 1").select("cluster", "first")
    told = told.join(cluster, "cluster", "left").where("first IS NOT NULL OR n_repeated > 0" if passage else "first IS NOT NULL")
    first = F.coalesce("first", place)
    return told.select(
        "doc_id", "para", "n_words", first["doc_id"].alias("first_doc"), first["para"].alias("first_para"),
        (place == first).alias("kept"), *counts,
    )
