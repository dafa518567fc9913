"""Links between texts with equal sketches, with work in proportion to the texts where they are alike.

Texts with the same sketch in the same place of their lists share a bucket. All
pairs of a bucket would be quadratic in a group of copies. So every text is
compared with one other at first: of the least texts of its buckets the one that
it shares most buckets with. What the links join gets one label, and two texts
with one label need no comparison any more.

Buckets that hold several labels go on. A count of hashed parts of each text
gives a bound that sorts out, before any text is read, most pairs that are not
similar. Members are dealt to blocks by their size, as sizes that are too far
apart need not meet, and blocks to tasks. Where the bound leaves no more pairs of
two blocks than these have members, all are compared, and the blocks are done.
Elsewhere a text is compared with one member of another label a turn, the
likeliest first, so a turn has no more pairs than there are members, and labels
at least halve where texts are alike; only buckets with such blocks have another
turn. When a turn joins little, or leaves no more pairs than the buckets
have members, all pairs that are left are compared.

Blocks meet in pairs, so a bucket of texts that share a sketch but are not alike
is quadratic in those bounds, though not in rows. No member is dropped, no bucket
is capped, and no sketch has to agree besides the shared one.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import HELD, components, forest
from footfall.sources.scratch import stored

#: Turns with one pair a text, at most; what they leave is compared in full.
TURNS = 6
#: A turn that joins less than one pair of so many is the last before all pairs.
WORTH = 4
#: Pairs that a task joins before the others are heard of.
EDGES = 1 << 20
#: Members of a block, and the bytes of its bags from which on it has fewer.
BLOCK, BLOCK_BYTES = 128, 1 << 19
#: Least and most bins of a bag, powers of two; in between there are two to four for each part of a text.
BINS, MOST_BINS = 64, 1 << 16


def bag(values: np.ndarray) -> bytes:
    """How many of the hashes fall into each bin, up to 255."""
    bins = min(max(1 << (2 * len(values)).bit_length(), BINS), MOST_BINS)
    return np.minimum(np.bincount((values % values.dtype.type(bins)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def _level(bags: list[bytes], bins: int) -> np.ndarray:
    """Bags in rows, wider ones folded to ``bins``."""
    rows = (np.frombuffer(v, np.uint8).reshape(-1, bins).sum(axis=0, dtype=np.int64) for v in bags)
    return np.stack([np.minimum(row, 255).astype(np.uint8) for row in rows])


def _common(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most parts that texts of ``n`` and ``m`` parts with these bags can have in common, pair by pair."""
    least = np.stack([np.minimum(own, y).sum(axis=1, dtype=np.int64) for own in x])
    return least + np.minimum((n - x.sum(axis=1, dtype=np.int64))[:, None], (m - y.sum(axis=1, dtype=np.int64))[None, :])


def _chance(a: np.ndarray, b: np.ndarray, turn: int) -> np.ndarray:
    """A number from 0 to 1 for each pair, another one in each turn."""
    mark = (a[:, None] ^ b[None, :]).astype(np.uint64) + np.uint64(turn)
    mark = (mark ^ (mark >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (mark >> np.uint64(11)) / float(1 << 53)


def _unlike(alike, turn: int | None):
    """Pairs of two blocks that have different labels and can be similar, rows ``(bucket, a, b, p, q, rank, whole, more)``.

    A pair belongs to the bucket of its first common sketch and is passed over
    in the others. ``p`` and ``q`` are the labels. Pairs are all there, and
    ``whole``, if they are no more than the members of both blocks, or without
    a ``turn``. Else each member, as ``a``, has the one pair of highest rank, and
    the first row of the blocks tells in ``more`` how many pairs there are.
    """

    def run(batches):
        for batch in batches:
            places = zip(batch.column("bucket").to_pylist(), batch.column("own").to_pylist(), batch.column("left"), batch.column("right"))
            for bucket, own, left, right in places:
                (a, p), (b, q) = ([side.values.field(c).to_numpy() for c in ("id", "label")] for side in (left, right))
                want = p[:, None] != q[None, :]
                if want.any():
                    u, v = (side.values.field("sketches").flatten().to_numpy().reshape(len(side.values), -1) for side in (left, right))
                    first = (u[:, None, :] == v[None, :, :]).argmax(axis=2)
                    want &= u[np.arange(len(u))[:, None], first] == bucket
                if not want.any():
                    continue
                rank = None
                if alike is not None:
                    n, m = (side.values.field("size").to_numpy() for side in (left, right))
                    x, y = (side.values.field("bag").to_pylist() for side in (left, right))
                    bins = min(len(v) for v in (*x, *y))
                    common = _common(_level(x, bins), _level(y, bins), n, m)
                    want &= alike(n[:, None], m[None, :], common)
                    rank = common / np.maximum(n[:, None], m[None, :])
                once = want & (a[:, None] < b[None, :]) if own else want
                there = np.count_nonzero(once)
                whole = turn is None or there <= len(a) + (0 if own else len(b))
                if whole:
                    i, j = np.nonzero(once)
                    i, j, p, q, rank = a[i], b[j], p[i], q[j], np.zeros(len(i))
                else:
                    rank = np.where(want, _chance(a, b, turn) if turn or rank is None else rank, -1.0)
                    x, y = (np.arange(len(a)), rank.argmax(axis=1)), (rank.argmax(axis=0), np.arange(len(b)))
                    high, wide = rank[x], rank[y]
                    if own:  # The members of one block are on either side.
                        y, wide = (y[0][:0], y[1][:0]), wide[:0]
                    i, j = np.concatenate([a[x[0]], b[y[1]]]), np.concatenate([b[x[1]], a[y[0]]])
                    p, q, rank = np.concatenate([p[x[0]], q[y[1]]]), np.concatenate([q[x[1]], p[y[0]]]), np.concatenate([high, wide])
                    i, j, p, q, rank = (c[rank >= 0] for c in (i, j, p, q, rank))
                more = np.zeros(len(i), np.int64)
                more[:1] = 0 if whole else there
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), bucket)), *(pa.array(c) for c in (i, j, p, q, rank)), pa.array(np.full(len(i), whole)), pa.array(more)],
                    ["bucket", "a", "b", "p", "q", "rank", "whole", "more"],
                )

    return run


def _candidates(here: DataFrame, signs: DataFrame, alike, turn: int | None) -> DataFrame:
    """What ``_unlike`` gives for the members of each bucket, rows ``(bucket, id, label, band, bytes)``."""
    size = F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)
    held = here.groupBy("bucket", "band").agg(F.ceil(size).alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")
    # Sketches and bags are joined once, to members that know their block.
    dealt = here.join(held, ["bucket", "band"]).select("bucket", "band", block, "id", "label").join(signs, "id")
    packed = dealt.groupBy("bucket", "band", "block").agg(F.collect_list(F.struct("label", *signs.columns)).alias("left"))
    packed = stored(packed, "blocks")
    other = packed.select(
        "bucket", F.col("band").alias("to"), F.col("block").alias("with"), F.col("left").alias("right"),
        F.explode(F.array("band", F.col("band") - 1)).alias("band"),
    )
    both = packed.join(other, ["bucket", "band"]).where("to > band OR block <= with").repartition("bucket", "band", "block", "to", "with")
    own = (F.col("band") == F.col("to")) & (F.col("block") == F.col("with"))
    kinds = "bucket bigint, a bigint, b bigint, p bigint, q bigint, rank double, whole boolean, more bigint"
    return both.select("bucket", own.alias("own"), "left", "right").mapInArrow(_unlike(alike, turn), kinds)


def _once(offers: DataFrame) -> DataFrame:
    """Distinct pairs ``(a, b, low, high, whole)``, a < b, with both labels: all whole ones, and one of the others a text."""
    best = offers.where("NOT whole").groupBy("a").agg(F.max(F.struct("rank", "b", "p", "q")).alias("best"))
    best = best.select("a", "best.b", "best.p", "best.q", F.lit(False).alias("whole"))
    every = offers.where("whole").select("a", "b", "p", "q", "whole").unionByName(best)
    ends = (end(*c).alias(n) for c, names in ((("a", "b"), ("a", "b")), (("p", "q"), ("low", "high"))) for end, n in zip((F.least, F.greatest), names))
    # A pair has the labels of its texts, the same in every offer.
    return every.select(*ends, "whole").groupBy("a", "b").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.max("whole").alias("whole"))


def _merged(pairs: DataFrame, rows: int) -> DataFrame:
    """``(id, component)`` of pairs ``(a, b)``, some of which tasks of ``EDGES`` pairs or so have joined before."""
    stars = pairs.coalesce(1 + rows // EDGES).mapInArrow(forest, "a bigint, b bigint")
    if rows < min(EDGES, HELD):  # One task has joined them all.
        return stored(stars.select(F.col("b").alias("id"), F.col("a").alias("component")), "components")
    return components(stars)


def shared(signed: DataFrame) -> DataFrame:
    """Members ``(bucket, id, first)`` of the buckets of several texts, with the least id of the bucket.

    ``signed`` has rows ``(id, sketches)``, one a text.
    """
    entries = signed.select("id", F.explode(F.array_distinct("sketches")).alias("bucket"))
    met = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    return stored(entries.join(stored(met.select("bucket", "first"), "met"), "bucket"), "members")


def links_among(
    members: DataFrame, signed: DataFrame, verify: Callable[[DataFrame], DataFrame], bags: DataFrame | None = None,
    alike: Callable | None = None, similarity: float = 1.0, given: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Verified pairs ``(a, b)``, a < b, among the ``members`` of buckets, and the ``(id, component)`` of all linked ids.

    ``signed`` has the rows ``(id, sketches)`` that ``members`` were made of.
    ``verify`` gets distinct pairs and returns those that are similar, with all
    their columns. The links join what the similar pairs among all pairs with a
    common sketch would join, together with the pairs ``given``, which are not
    among the links. ``bags`` has ``(id, size, bag)`` of every member. ``alike``
    tells by two sizes and the most that both can have in common if ``verify``
    could accept the pair; of such a pair one size is at least ``similarity`` of
    the other.
    """
    often = members.where("id <> first").groupBy("id", "first").agg(F.count("*").alias("n"))
    best = often.groupBy("id").agg(F.max(F.struct("n", F.bitwise_not("first").alias("least"))).alias("best"))
    checked = stored(best.select(F.bitwise_not("best.least").alias("a"), F.col("id").alias("b")), "pairs")
    links = stored(verify(checked), "links")
    known = links if given is None else stored(links.unionByName(given), "known")
    labels = _merged(known, known.count())
    here = members.select("bucket", "id").join(labels, "id", "left")
    here = here.select("bucket", "id", F.coalesce("component", "id").alias("label"))
    # Sizes of similar texts lie in one band or in two neighbours.
    width = max(-math.log(similarity), 1e-6) * (1 + 1e-9)
    if bags is not None:
        bags = bags.select("*", F.floor(F.log("size") / width).alias("band"), F.length("bag").alias("bytes"))
    turns = iter((*range(1, TURNS), None))
    turn: int | None = 0
    while True:
        split = here.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        here = here.join(split.select("bucket"), "bucket", "left_semi")
        if turn == 0:
            here = here.withColumns({"band": F.lit(0), "bytes": F.lit(0)}) if bags is None else here.join(bags.select("id", "band", "bytes"), "id")
        here = stored(here, "split")
        if turn == 0:
            places = here.count()
            signs = signed.select("id", "sketches").join(here.select("id").distinct(), "id", "left_semi")
            signs = stored(signs if bags is None else signs.join(bags.select("id", "size", "bag"), "id"), "signs")
        if here.isEmpty():
            return links, labels
        offers = stored(_candidates(here, signs, alike, turn), "offers")
        pairs = stored(_once(offers).join(checked, ["a", "b"], "left_anti"), "pairs")
        found = stored(verify(pairs), "links")
        links, checked = links.unionByName(found.select("a", "b")), checked.unionByName(pairs.select("a", "b"))
        # Classes are joined by their labels: a graph of what is new, not of all links.
        again = _merged(found.select(F.col("low").alias("a"), F.col("high").alias("b")), found.count())
        moved = again.select(F.col("id").alias("component"), F.col("component").alias("joined"))
        more = again.join(labels.select("id"), "id", "left_anti")
        labels = labels.join(moved, "component", "left").select("id", F.coalesce("joined", "component").alias("component"))
        labels = stored(labels.unionByName(more), "labels")
        cut = stored(offers.where("NOT whole").select("bucket").distinct(), "cut")
        if cut.isEmpty():
            return links, labels
        here = here.join(cut, "bucket", "left_semi").join(moved.withColumnRenamed("component", "label"), "label", "left")
        here = here.select("bucket", "id", F.coalesce("joined", "label").alias("label"), "band", "bytes")
        some, worth = (rows.where("NOT whole").count() for rows in (pairs, found))
        few = offers.agg(F.sum("more")).first()[0] <= places
        turn = next(turns) if worth * WORTH >= some > 0 and not few else None


def pivot_links(
    signed: DataFrame, verify: Callable[[DataFrame], DataFrame], bags: DataFrame | None = None,
    alike: Callable | None = None, similarity: float = 1.0,
) -> DataFrame:
    """The links of ``links_among`` for all buckets of ``signed``, rows ``(id, sketches)``; ``verify`` may return ``(a, b)`` alone."""

    def kept(pairs: DataFrame) -> DataFrame:
        return pairs.join(verify(pairs.select("a", "b")).select("a", "b"), ["a", "b"], "left_semi")

    return links_among(shared(signed), signed, kept, bags, alike, similarity)[0]
