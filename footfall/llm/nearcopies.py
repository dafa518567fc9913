"""Near copies of documents by Order MinHash, verified by alignment.

Words are runs between white space, lower-cased in ASCII. A k-mer is five
consecutive words, labelled with how often it occurred before in the text; a
shorter text is one k-mer. Each of several hash functions picks the two least
labelled k-mers of a text and keeps them in text order: one sketch. Texts with
a sketch in common are candidates. The share of common sketches falls both with
words that differ and with words that moved, so it follows edit similarity.

Candidates are aligned word by word, with bit-parallel columns, and given up as
soon as the cost leaves the band that the threshold allows. Two texts are
near copies if ``1 - edits / longer length`` is at least 0.8.

Texts with the same words form one class without being compared. Edge cases:
texts that are null or without words are classes of their own; rows with a null
id are not in the result; rows that repeat an id are one document, which has
all their texts; other columns are ignored; no documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.frames import perhaps_among
from footfall.llm.linking import bag, links_among, shared
from footfall.llm.words import Words, mix, pieces, runs, split_words, stretches
from footfall.sources.scratch import stored

K = 5
SKETCHES = 24
SIMILARITY = 0.8

_U = np.uint64
_A = mix(np.arange(SKETCHES).astype(_U), 11) | _U(1)
_B = mix(np.arange(SKETCHES).astype(_U), 12) | _U(1)


def fingerprints(words: Words, hashes: np.ndarray) -> np.ndarray:
    """One 64-bit hash of the word sequence of each text; 0 where there is no word."""
    first = words.first()
    out = np.zeros(len(first) - 1, _U)
    some = np.flatnonzero(np.diff(first))
    out[some] = stretches(hashes, first[some], first[some + 1]) | _U(1)
    return out


def kmers(words: Words, hashes: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every k-mer, in text order; a text of fewer words has one."""
    first = words.first()
    count = np.diff(first)
    long = runs(hashes, k)
    own = words.row[: len(long)]
    whole = own == words.row[k - 1 :] if len(long) else np.zeros(0, bool)
    short = np.flatnonzero((count > 0) & (count < k))
    if not len(short):
        return own[whole], long[whole]
    alone = stretches(hashes, first[short], first[short + 1])
    rows, values = np.concatenate([own[whole], short]), np.concatenate([long[whole], alone])
    order = np.argsort(rows, kind="stable")
    return rows[order], values[order]


def labelled(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """K-mers told apart by how often they occurred before in the same text."""
    key = mix(values ^ mix(rows.astype(_U), 3), 4)
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order][1:] == key[order][:-1]
    place = np.arange(len(key))
    seen = np.empty(len(key), np.int64)
    seen[order] = place - np.maximum.accumulate(np.where(same, 0, place))
    return mix(values + seen.astype(_U) * _U(0xD6E8FEB86659FD93), 5)


def sketches(rows: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
    """Order MinHash sketches, text x hash function; texts without k-mers are left at 0."""
    out = np.zeros((texts, SKETCHES), _U)
    if not len(rows):
        return out
    start = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    size = np.diff(np.r_[start, len(rows)])
    marks = labelled(rows, values)
    top = ~_U(0)
    for s in range(SKETCHES):
        h = marks * _A[s]
        h ^= h >> _U(32)
        h *= _B[s]
        least = np.minimum.reduceat(h, start)
        at = np.flatnonzero(h == np.repeat(least, size))
        at = at[np.unique(rows[at], return_index=True)[1]]
        h[at] = top
        least = np.minimum.reduceat(h, start)
        next_ = np.flatnonzero(h == np.repeat(least, size))
        next_ = next_[np.unique(rows[next_], return_index=True)[1]]
        a, b = np.minimum(at, next_), np.maximum(at, next_)
        out[rows[start], s] = mix(marks[a] * _U(3) + np.where(a == b, _U(0), marks[b]), 100 + s)
    return out


def _sketch(batches):
    for batch in batches:
        for low, high, data, bounds in pieces(batch.column("text")):
            words = split_words(data, bounds)
            hashes = words.hashes()
            rows, values = kmers(words, hashes)
            made = sketches(rows, values, high - low)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, high - low),
                    pa.array(fingerprints(words, hashes).view(np.int64)),
                    pa.array(np.diff(words.first()).astype(np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(made.view(np.int64).ravel()), SKETCHES).cast(pa.list_(pa.int64())),
                ],
                ["doc_id", "id", "n_words", "sketches"],
            )


def _tokens(batches):
    """Of each text the id, the words as 32-bit hashes, packed, and their bag."""
    for batch in batches:
        for low, high, data, bounds in pieces(batch.column("text")):
            words = split_words(data, bounds)
            hashes = words.hashes()
            ids = pa.array(fingerprints(words, hashes).view(np.int64))
            hashes = (hashes >> _U(32)).astype(np.uint32)
            first = words.first()
            packed = [hashes[first[i] : first[i + 1]].tobytes() for i in range(high - low)]
            bags = [bag(hashes[first[i] : first[i + 1]]) for i in range(high - low)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(packed, pa.binary()), pa.array(bags, pa.binary())], ["id", "words", "bag"])


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """Edits that are needed whatever the order of the words."""
    both, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    common = np.minimum(np.bincount(at[: len(a)], minlength=len(both)), np.bincount(at[len(a) :], minlength=len(both))).sum()
    return max(len(a), len(b)) - int(common)


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Least number of inserted, deleted and replaced words between two texts; ``most + 1`` if above ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    n = min(len(a), len(b))
    same = np.flatnonzero(a[:n] != b[:n])
    head = int(same[0]) if len(same) else n
    a, b, n = a[head:], b[head:], n - head
    same = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(same[0]) if len(same) else n
    a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    where: dict[int, int] = {}
    for i, word in enumerate(a):
        where[word] = where.get(word, 0) | (1 << i)
    # Bits tell, down a column of the alignment, where the cost rises and where it falls by one.
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    rise, fall, cost = full, 0, len(a)
    for left, word in zip(range(len(b) - 1, -1, -1), b):
        match = where.get(word, 0) | fall
        diagonal = (((match & rise) + rise) ^ rise) | match
        right_rise, right_fall = fall | (full & ~(diagonal | rise)), rise & diagonal
        cost += 1 if right_rise & last else -1 if right_fall & last else 0
        if cost - left > most:
            return most + 1
        right_rise, right_fall = (right_rise << 1) | 1, right_fall << 1
        rise, fall = (right_fall | ~(diagonal | right_rise)) & full, diagonal & right_rise & full
    return cost


def _aligned(similarity: float):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
                keep.append(apart(a, b) <= most and edits(a, b, most) <= most)
            yield batch.drop_columns(["left", "right"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, class_id, kept, n_links, n_words)``: ``class_id`` is the least id of the class, which is kept.

    ``n_links`` counts the links that joined the text to others of its class: not
    every similar text, as texts that are joined by then are not compared.
    """
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(docs.mapInArrow(_sketch, f"doc_id {kind}, id bigint, n_words bigint, sketches array<bigint>"), "sketches")
    texts = rows.where("n_words > 0").groupBy("id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("sketches").alias("sketches")
    )
    texts = stored(texts, "different-texts")
    # Texts of candidates, one document for each different text, and of a few others: no text is moved to be chosen.
    members = shared(texts)
    chosen = stored(texts.join(members.select("id").distinct(), "id", "left_semi").select("doc_id"), "candidates")
    packed = perhaps_among(docs, chosen, "doc_id").select("text").mapInArrow(_tokens, "id bigint, words binary, bag binary")
    packed = stored(packed.dropDuplicates(["id"]), "words")

    def verify(pairs: DataFrame) -> DataFrame:
        size = F.length("words")
        left = packed.select(F.col("id").alias("a"), F.col("words").alias("left"), size.alias("n_left"))
        right = packed.select(F.col("id").alias("b"), F.col("words").alias("right"), size.alias("n_right"))
        near = F.least("n_left", "n_right") >= F.greatest("n_left", "n_right") * F.lit(similarity)
        both = pairs.join(left, "a").join(right, "b").where(near)
        return both.select(*pairs.columns, "left", "right").mapInArrow(_aligned(similarity), pairs.schema)

    def alike(n, m, common):
        longer = np.maximum(n, m)
        return longer - common <= ((1 - similarity) * longer + 1e-9).astype(np.int64)

    bags = packed.select("id", (F.length("words") / 4).cast("bigint").alias("size"), "bag")
    # Rows that repeat an id tie their texts together.
    tied = rows.where("n_words > 0").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    again = rows.where("n_words > 0").join(tied.where("a <> b"), "doc_id").select("a", F.col("id").alias("b"))
    links, named = links_among(members, texts, verify, bags, alike, similarity, again)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    told = rows.where("n_words > 0").select("doc_id", "id", "n_words").join(named, "id", "left").join(degree, "id", "left")
    told = told.withColumn("group", F.coalesce("component", "id"))
    heads = told.groupBy("group").agg(F.min("doc_id").alias("class_id"))
    out = told.join(heads, "group").select(
        "doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_words"
    )
    empty = rows.where("n_words = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), F.lit(0).cast("bigint").alias("n_links"), "n_words"
    )
    return out.unionByName(empty)


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with all columns, one document of each class; rows with a null id stay.

    Rows that repeat an id are reduced to those with different texts.
    """
    found = stored(near_classes(docs, similarity), "classes")
    chosen = found.where("kept").groupBy(F.col("doc_id").alias("__doc")).agg(F.count("*").alias("__rows"))
    # One row a document: this side grows with the corpus and is not broadcast.
    rows = docs.join(chosen.hint("merge"), F.col("doc_id") == F.col("__doc"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = rows.where("__rows = 1").select(own)
    again = rows.where("__rows > 1").select(own).dropDuplicates(["doc_id", "text"])
    return once.unionByName(again).unionByName(docs.where("doc_id IS NULL"))
