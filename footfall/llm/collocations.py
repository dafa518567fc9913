"""Phrases whose words stand together more often than chance, by direct-address tiles.

Texts are cut into chunks of words once. Words that are frequent enough to be part
of a result are ranked by frequency, so that common words are neighbours. Of each chunk
the pairs of adjacent ranks are counted in tiles: pairs of common words fall into few
tiles, which are counted by direct address with a dense array; the others become
sorted coordinates. Pairs that may be frequent are ranked by frequency again and take the
place of words: a pair of adjacent pairs is a phrase of three words, and so on. A part of a
frequent phrase is frequent, so nothing is lost on the way.

What may be frequent is seen by hash: each chunk adds its counts of phrases of one length to
buckets, and a phrase in a bucket of less than the least count is rare. The buckets are summed in
Spark, and one bit of each, 16 MB at most, is broadcast for the next length. Only phrases whose buckets,
and whose parts' buckets, have enough are shuffled with their counts, once, by their words; those that
share a bucket with others are dropped by their exact counts then. From five hundred million words on
the buckets fill up, and more rare phrases are counted exactly, but none that is frequent goes.

Edge cases: a null text is empty, a null language is ``und``; rows without a word add
nothing; repeated rows count each; ids and other columns are not read. A piece of text
without a mark at its end is held in memory whole, with four bytes a word. Counts are
exact up to 10^16, with products in 38 digits.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from footfall.llm.frames import map_rows
from footfall.llm.words import Words, mix
from footfall.sources.scratch import stored

MOST_WORDS = 5
LEAST = 100
TOP = 2000
#: A phrase goes if a longer one has this share of its occurrences, in percent.
ABSORB = 100
#: Words of a chunk about, and bytes of a text split at once.
CHUNK = 300_000
SLICE = 4 << 20
#: Side of a tile in ids, tiles along a side that are addressed directly, and pairs that make a tile dense.
TILE, HEAD, DENSE = 256, 64, 256 * 256 // 8
#: Parts of a language that are ranked by themselves first.
PARTS = 64

#: Lengths of phrases that are sifted by buckets, words for a bucket, and buckets as powers of two: of a block, and at most.
SIFTED, LOAD, BLOCK, MOST_BUCKETS = 4, 4, 16, 27
#: Phrases whose buckets are added up at once, and rows sent at once.
TOGETHER, SENT = 3_000_000, 50_000

_CHUNKS = T.StructType([
    T.StructField("codes", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("langs", T.ArrayType(T.StringType())),
    T.StructField("lang", T.BinaryType()), T.StructField("word", T.BinaryType()), T.StructField("length", T.BinaryType()),
    T.StructField("n", T.BinaryType()),
])
_U = np.uint64
_FULL = 255  # most that a chunk adds to a bucket
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_GONE, _END = -2, -1  # codes of an empty token and of the end of a piece


class _Chunk:
    """Words of some texts as numbers, with their own dictionary."""

    def __init__(self):
        self.clear()
        self.parts: list[np.ndarray] = []
        self.size = 0

    def clear(self):
        self.next = count()
        self.numbers: dict[str, defaultdict] = {}

    def add(self, lang: str, text: bytes):
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = defaultdict(self.next.__next__)
            numbers[b""], numbers[b"\n"] = _GONE, _END
        tokens = text.replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
        self.parts.append(codes[codes > _GONE])
        self.size += len(self.parts[-1])

    def end(self):
        self.parts.append(np.array([_END], np.int32))

    def take(self, whole: bool):
        """Codes, languages, words and counts so far, most frequent first; up to the last end of a piece, unless ``whole``."""
        codes = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        cut = len(codes)
        if not whole:
            ends = np.flatnonzero(codes == _END)
            cut = int(ends[-1]) + 1 if len(ends) else 0
        codes, rest = codes[:cut], codes[cut:]
        self.parts, self.size = [rest] if len(rest) else [], len(rest)
        n = np.bincount(codes[codes >= 0]) if (codes >= 0).any() else np.zeros(0, np.int64)
        used = np.argsort(-n, kind="stable")[: np.count_nonzero(n)]
        known = np.full(len(n) + 1, _END, np.int32)  # the last is for ends
        known[used] = np.arange(len(used))
        langs, words = [None] * len(n), [None] * len(n)
        for lang, numbers in self.numbers.items():
            for word, i in numbers.items():
                if 0 <= i < len(n):
                    langs[i], words[i] = lang, word
        if whole:
            self.clear()
        return known[codes], [langs[i] for i in used], [words[i] for i in used], n[used]


def _slices(text: bytes):
    """Pieces of a long text, cut at blanks."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE) if len(text) - at > SLICE else -1
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _thin(values: np.ndarray) -> bytes:
    """Numbers that are mostly small: the first bytes of all together, then the second ones, .."""
    return zlib.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _wide(packed: pa.BinaryScalar, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed.as_buffer()), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _hashes(words: pa.Array) -> np.ndarray:
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    values = words.buffers()[2]
    data = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]] if values else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    return Words(data, ends, ends[1:], ends[:-1], ends[1:]).hashes(lower=False)


def _cut(batches):
    """Chunks of ``(text, lang)``."""
    chunk = _Chunk()

    def row(whole):
        codes, langs, words, n = chunk.take(whole)
        if len(n):
            names = sorted(set(langs))
            number = {name: i for i, name in enumerate(names)}
            lang = np.array([number[x] for x in langs], np.int32)
            length = np.array([len(w) for w in words], np.int32)
            packed = [_thin(codes.astype(np.int32) + 1), _thin(lang), zlib.compress(b"".join(words), 1), _thin(length), _thin(n.astype(np.int64))]
            codes, *packed = (pa.array([x], pa.binary()) for x in packed)
            yield pa.RecordBatch.from_arrays([codes, pa.array([int(n.sum())]), pa.array([names], pa.list_(pa.string())), *packed], _CHUNKS.names)

    for batch in batches:
        texts = batch.column(0)
        texts = texts.view(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
        for text, lang in zip(texts, batch.column(1).to_pylist()):
            for part in _slices((text.as_py() or b"").lower().translate(_MARKS)):
                chunk.add("und" if lang is None else lang, part)
                if chunk.size >= 2 * CHUNK:
                    yield from row(False)
            chunk.end()
            if chunk.size >= CHUNK:
                yield from row(True)
    yield from row(True)


def count_pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of adjacent ids, ranks by frequency, with their counts; a negative number is no id."""
    ok = (ids[:-1] >= 0) & (ids[1:] >= 0)
    a, b = ids[:-1][ok], ids[1:][ok]
    side = int(b.max(initial=0)) + 1
    near = (a < TILE * HEAD) & (b < TILE * HEAD)
    tile = a // TILE * HEAD + b // TILE
    sizes = np.bincount(tile[near], minlength=HEAD * HEAD)
    dense = near.copy()
    dense[near] = sizes[tile[near]] >= DENSE
    # Sparse tiles: sorted coordinates.
    keys, n = np.unique(a[~dense] * side + b[~dense], return_counts=True)
    found = [(keys // side, keys % side, n)]
    # Dense tiles: one array each, addressed by both ids.
    a, b, tile = a[dense], b[dense], tile[dense].astype(np.uint16)
    order = np.argsort(tile, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(tile[order])) + 1) if len(order) else []:
        left, right = (int(v[part[0]]) // TILE * TILE for v in (a, b))
        cells = np.bincount((a[part] - left) * TILE + (b[part] - right), minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        found.append((at // TILE + left, at % TILE + right, cells[at]))
    a, b, n = (np.concatenate(x) for x in zip(*found))
    return a, b, n


def _squeezed(ids: np.ndarray) -> np.ndarray:
    """Without numbers that have no neighbour: of a run of negative ones the first is enough."""
    keep = ids >= 0
    keep[1:] |= ids[:-1] >= 0
    return ids[keep]


def _among(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the buckets of ``hashes`` have their bit."""
    at = hashes >> _U(64 - len(bits).bit_length() - 2)
    return (bits[at >> _U(3)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)


def _grown(codes: np.ndarray, n: np.ndarray, hashes: np.ndarray, bits: list[np.ndarray], most: int):
    """For 1, 2, .. words the phrases of a chunk that ``bits`` let pass: their words, as numbers, hashes and counts.

    Of a length without bits all pass.
    """
    single, words = hashes, np.arange(len(n))[:, None]
    keys = None  # of pairs, by which they are found in the codes
    for k in range(1, most + 1):
        kept = np.flatnonzero(_among(bits[k - 1], hashes)) if k <= len(bits) else np.arange(len(n))
        kept = kept[np.argsort(-n[kept], kind="stable")]
        yield words[kept], hashes[kept], n[kept]
        if k == most or not len(kept):
            return
        words, hashes, rank = words[kept], hashes[kept], np.arange(len(kept))
        if keys is None:
            new = np.full(len(n) + 1, -1, np.int64)  # the last stands for ends
            new[kept] = rank
            codes = new[codes]
        else:
            by_key = np.argsort(keys[kept])
            found = keys[kept][by_key]
            here = np.where((codes[:-1] >= 0) & (codes[1:] >= 0), codes[:-1] * side + codes[1:], -1)
            at = np.minimum(np.searchsorted(found, here), len(found) - 1)
            codes = np.where(found[at] == here, rank[by_key][at], -1)
        codes = _squeezed(codes)
        a, b, n = count_pairs(codes)
        side = len(kept)
        keys = a * side + b
        last = words[b, -1]
        words, hashes = np.column_stack([words[a], last]), mix(hashes[a] * _U(3) + single[last], k + 2)


def _opened(batches, bits: list[np.ndarray], most: int):
    """Languages and words of each chunk, the language and the count of each word, and the phrases of 1, 2, .. words."""
    for batch in batches:
        for i in range(batch.num_rows):
            codes, lang, length, n = (
                _wide(batch.column(c)[i], kind) for c, kind in (("codes", np.int32), ("lang", np.int32), ("length", np.int32), ("n", np.int64))
            )
            codes, ends = codes - 1, np.r_[0, np.cumsum(length)].astype(np.int32)
            data = zlib.decompress(batch.column("word")[i].as_buffer())
            words = pa.StringArray.from_buffers(len(length), pa.py_buffer(ends), pa.py_buffer(data))
            langs = batch.column("langs")[i].values
            hashes = mix(_hashes(words) ^ mix(_hashes(langs), 1)[lang], 2)
            yield langs, words, lang, n, _grown(codes, n, hashes, bits, most)


def _by_block(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """What ``n`` adds to the buckets ``at``, one row a block: steps from bucket to bucket, and counts."""
    order = np.argsort(at, kind="stable")
    at, n = at[order], n[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    n, at = np.minimum(np.add.reduceat(n, first, dtype=np.int64), _FULL).astype(np.uint8), at[first]
    block, at = (at >> _U(BLOCK)).astype(np.int32), (at & _U((1 << BLOCK) - 1)).astype(np.uint16)
    edges = np.r_[np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(block)]
    steps = np.diff(at, prepend=at[:1])
    steps[edges[:-1]] = at[edges[:-1]]
    each = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    rows = [[_thin(steps[i:j]) for i, j in each], [_thin(n[i:j]) for i, j in each]]
    return pa.RecordBatch.from_arrays([pa.array(block[edges[:-1]]), *(pa.array(x, pa.binary()) for x in rows)], ["block", "at", "n"])


def _loads(sent, power: int):
    """What the chunks add to the buckets, by block, of phrases one word longer than those with bits."""

    def run(batches):
        bits, held, size = [b.value for b in sent], [], 0
        for *_, levels in _opened(batches, bits, len(bits) + 1):
            for k, (_, hashes, n) in enumerate(levels):
                if k == len(bits):
                    held.append(((hashes >> _U(64 - power)).astype(np.uint32), np.minimum(n, _FULL).astype(np.uint8)))
                    size += len(n)
            if size >= TOGETHER:
                yield _by_block(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield _by_block(*map(np.concatenate, zip(*held)))

    return run


def _summed(least: int):
    """The bits of a block's buckets that have ``least`` in all."""

    def run(loads: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK, np.int64)
        for at, n in zip(loads["at"], loads["n"]):
            total[np.cumsum(_wide(at, np.uint16), dtype=np.int64)] += _wide(n, np.uint8)
        bits = np.packbits(total >= min(least, _FULL), bitorder="little")
        return pa.table({"block": loads["block"][:1].cast(pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    return run


def _told(sent, most: int):
    """Counts of the phrases that pass, in each chunk; of 0 words those of the languages."""

    def run(batches):
        names = ["words", "lang", "phrase", "n"]
        for langs, word, lang, n, levels in _opened(batches, [b.value for b in sent], most):
            total = np.zeros(len(langs), np.int64)
            np.add.at(total, lang, n)
            none = pa.array([""] * len(langs), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(langs), np.int32)), langs, none, pa.array(total)], names)
            for k, (words, _, n) in enumerate(levels, 1):
                for i in range(0, len(n), SENT):
                    part = words[i : i + SENT]
                    phrase = pc.binary_join_element_wise(*(word.take(pa.array(w)) for w in part.T), " ")
                    own = langs.take(pa.array(lang[part[:, 0]]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k, np.int32)), own, phrase, pa.array(n[i : i + SENT])], names)

    return run


def phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most_words: int = MOST_WORDS
) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language ``(lang, n)``, and for 1, 2, .. words the phrases that occur ``least`` times.

    Phrases ``(lang, phrase, first, rest)`` have their counts: ``first`` of the first 1, 2, ..
    words and ``rest`` of the last 1, 2, .. words.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    chunks = stored(map_rows(rows, _cut, _CHUNKS), "chunks")
    context = docs.sparkSession.sparkContext
    size = chunks.agg(F.sum("size")).first()[0] or 0
    power = min(max((size // LOAD).bit_length(), BLOCK), MOST_BUCKETS)
    sent = []
    for _ in range(min(SIFTED, most_words)):
        loads = chunks.drop("size").mapInArrow(_loads(sent, power), "block int, at binary, n binary")
        bits = np.zeros(1 << power - 3, np.uint8)
        for block in loads.groupBy("block").applyInArrow(_summed(least), "block int, bits binary").collect():
            at = block["block"] << BLOCK - 3
            bits[at : at + (1 << BLOCK - 3)] = np.frombuffer(block["bits"], np.uint8)
        sent.append(context.broadcast(bits))
    counts = chunks.drop("size").mapInArrow(_told(sent, most_words), "words int, lang string, phrase string, n bigint")
    counts = counts.groupBy("words", "lang", "phrase").agg(F.sum("n").alias("n")).where((F.col("words") == 0) | (F.col("n") >= least))
    counts = stored(counts, "phrases")
    for b in sent:
        b.unpersist()
    found = []
    for k in range(1, most_words + 1):
        here = counts.where(F.col("words") == k).select("lang", "phrase", F.array("n").alias("n"))
        if k == 1:
            here = here.select("lang", "phrase", F.col("n").alias("first"), F.col("n").alias("rest"))
        else:
            p = found[-1].select("lang", F.col("phrase").alias("p"), "first")
            q = found[-1].select("lang", F.col("phrase").alias("q"), "rest")
            here = here.withColumns({"p": F.substring_index("phrase", " ", k - 1), "q": F.substring_index("phrase", " ", 1 - k)})
            here = here.join(p, ["lang", "p"]).join(q, ["lang", "q"])
            here = here.select("lang", "phrase", F.concat("first", "n").alias("first"), F.concat("rest", "n").alias("rest"))
        found.append(stored(here, "counted"))
    return counts.where("words = 0").select("lang", "n"), found


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most_words: int = MOST_WORDS,
    top: int = TOP, absorb: int = ABSORB,
) -> DataFrame:
    """The first ``top`` phrases of each language, ``(lang, rank, phrase, a, l, r, n, score)``.

    A phrase that occurs ``a`` times, in a language of ``n`` words, is cut in two, which
    occur ``l`` and ``r`` times, where that gives the least score ``1000 a n / (l r)``. Phrases
    inside a longer one with ``absorb`` percent of their occurrences go. One word more is
    enough to see that: longer ones occur less.
    """
    total, found = phrases(docs, text, lang, least, most_words)
    kept = []
    for here, longer in zip(found[1:], [*found[2:], None]):
        here = here.withColumn("a", F.element_at("first", -1))
        if longer is not None:
            inside = F.explode(F.array(F.expr("substring_index(phrase, ' ', size(first) - 1)"), F.expr("substring_index(phrase, ' ', 1 - size(first))")))
            most = longer.select("lang", inside.alias("phrase"), F.element_at("first", -1).alias("f")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
            here = here.join(most, ["lang", "phrase"], "left").where(~F.coalesce(100 * F.col("f") >= absorb * F.col("a"), F.lit(False)))
        kept.append(here.select("lang", "phrase", "a", "first", "rest"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    exact = lambda c: f"cast({c} as decimal(38, 0))"
    left, right = "element_at(first, k)", "element_at(rest, size(first) - k)"
    cut = f"struct(({exact(1000)} * {exact('a')} * {exact('n')}) div ({exact(left)} * {exact(right)}) AS score, k, {left} AS l, {right} AS r)"
    rows = rows.join(total, "lang").withColumn("cut", F.expr(f"array_min(transform(sequence(1, size(first) - 1), k -> {cut}))"))
    rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
