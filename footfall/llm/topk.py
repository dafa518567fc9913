"""Exact search of the largest inner products, score at a time over an impact-ordered index.

Components are whole numbers, ``floor(1024 x)``. The index deals vectors into shards. For each
dimension a shard lists its vectors by value, cut into segments of one quantised impact. A query
meets a shard segment by segment, by descending impact: what a segment can add to a score at
most. After any number of segments, the impact of the next one bounds all that a vector has not
been seen with, so sums of impacts bound its score. Vectors that the bound rules out against
the k-th best score known so far are dropped; segments are read on until those left are few
or no segment is left. They are scored exactly then: nothing is dropped without that proof.

Shards are met in waves, one at first and then eight times as many in each, and the k-th best
score of a wave is the bar of the next. A group is one shard and a bounded part of the
queries; queries are dealt to shards in Spark, and nothing but counts reaches the driver.

Edge cases: vectors that are null or hold null or non-finite components, and rows without an
id, take no part. Only vectors of one length meet; empty ones score 0. Repeated rows are
vectors and queries of their own, and a query leaves out its own row only; ties go to the
smaller id. Scores have to fit 64 bits, else the search fails. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.sources.scratch import stored

SCALE = 1024
K = 10
#: Vectors of a shard and queries of a part, about.
SHARD, PART = 8192, 2048
#: Levels of impact a dimension has at most, and times more shards in each wave.
LEVELS, GROWTH = 64, 8
#: Shares of a shard's postings after which the bounds are looked at, and vectors that are few enough to be scored, beside the k best.
LOOKS, FEW = (0.25, 0.5, 0.625, 0.75, 0.875), 64

_INDEX = "dim bigint, shard bigint, ids binary, rows binary, x binary, listed binary, segments binary"
_FOUND = "query bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(row, vec_id, dim, x)`` of all vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    rows = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.size(vector).cast("bigint").alias("dim"), whole.alias("x"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "integers")


def _bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.int64).tobytes()


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), dim)


def _build(shard: pa.Table) -> pa.Table:
    """One row: the vectors, and for each dimension their numbers by value with the ends of its segments."""
    dim, n = shard["dim"][0].as_py(), len(shard)
    x = _matrix(shard["x"], dim)
    listed, segments = [np.zeros(0, np.int64)], [np.zeros((0, 5), np.int64)]
    for d in range(dim):
        order = np.argsort(x[:, d], kind="stable")
        values = x[order, d]
        width = max(1, -(-int(values[-1] - values[0] + 1) // LEVELS))
        level = (values - values[0]) // width
        start = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1])
        end = np.append(start[1:], n)
        listed.append(order)
        segments.append(np.stack([np.full(len(start), d), values[start], values[end - 1], start + d * n, end + d * n], axis=1))
    made = [_bytes(shard["vec_id"].to_numpy()), _bytes(shard["row"].to_numpy()), _bytes(x)]
    made += [_bytes(np.concatenate(listed)), _bytes(np.concatenate(segments))]
    names = ["ids", "rows", "x", "listed", "segments"]
    return pa.table({"dim": [dim], "shard": [shard["shard"][0].as_py()]} | {n: pa.array([b], pa.binary()) for n, b in zip(names, made)})


def members(q: np.ndarray, x: np.ndarray, listed: np.ndarray, segments: np.ndarray, k: int, bar: int | None, own: np.ndarray):
    """Numbers of vectors that may be among the ``k`` best of a query, and their exact scores.

    ``bar`` is a score that k other vectors reach, if one is known; ``own`` marks what is left out.
    """
    n, dim = x.shape
    exact = lambda at: x[at] @ q
    left = np.flatnonzero(~own)
    if dim == 0 or len(left) <= max(FEW, k):
        return left, exact(left)
    ends = segments[:, 1:3] * q[segments[:, 0]][:, None]
    impact = ends.max(axis=1)
    order = np.argsort(-impact, kind="stable")
    sizes = (segments[:, 4] - segments[:, 3])[order]
    read = np.cumsum(sizes)
    sums, seen, done = np.zeros(n), np.zeros(n, np.int64), 0
    for look in LOOKS:
        upto = int(np.searchsorted(read, look * read[-1])) + 1
        if upto >= len(order):
            break
        if upto <= done:
            continue
        new = order[done:upto]
        at = np.concatenate([listed[a:b] for a, b in segments[new, 3:5].tolist()])
        sums += np.bincount(at, np.repeat(impact[new], sizes[done:upto]), n)
        seen += np.bincount(at, minlength=n)
        done = upto
        bound = sums + (dim - seen) * float(impact[order[done]])  # each posting not read adds no more than the next segment
        if bar is None or look == LOOKS[1]:
            # The scores of any k vectors are a bar.
            best = left[np.argpartition(-bound[left], k - 1)[:k]] if len(left) > k else left
            if len(best) >= k:
                low = int(exact(best).min())
                bar = low if bar is None else max(bar, low)
        if bar is not None:
            left = left[bound[left] >= bar]
        if len(left) <= max(FEW, k):
            break
    return left, exact(left)


def _search(k: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        names = [c.split(" ")[0] for c in _FOUND.split(", ")]
        out = [np.zeros((0, len(names)), np.int64)]
        if len(index) and len(queries):
            dim = index["dim"][0].as_py()
            ids, rows, x, listed, segments = (np.frombuffer(index[c][0].as_py(), np.int64) for c in ("ids", "rows", "x", "listed", "segments"))
            x, segments = x.reshape(len(ids), dim), segments.reshape(-1, 5)
            asked = _matrix(queries["x"], dim)
            if dim and dim * float(np.abs(x).max()) * float(np.abs(asked).max()) >= 2.0**52:  # beyond it sums of doubles are not exact
                return _in_python(index, queries, k, x, asked, ids, rows, names)
            for q, row, name, bar in zip(asked, *(queries[c].to_pylist() for c in ("row", "vec_id", "bar"))):
                at, scores = members(q, x, listed, segments, k, bar, rows == row)
                best = np.lexsort((rows[at], ids[at], -scores))[:k]
                at, scores = at[best], scores[best]
                out.append(np.stack([np.full(len(at), row), np.full(len(at), name), rows[at], ids[at], scores], axis=1))
        return pa.table(dict(zip(names, np.concatenate(out).T.copy())))

    return run


def _in_python(index, queries, k, x, asked, ids, rows, names) -> pa.Table:
    """Vectors with huge components: exact scores of all, in whole numbers of any size."""
    out, big = [], x.astype(object)
    for q, row, name in zip(asked.astype(object), queries["row"].to_pylist(), queries["vec_id"].to_pylist()):
        scores = [int(s) for s in big @ q]
        best = sorted((i for i in range(len(ids)) if rows[i] != row), key=lambda i: (-scores[i], ids[i], rows[i]))[:k]
        out += [(row, name, int(rows[i]), int(ids[i]), scores[i]) for i in best]
    return pa.table({c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(names)})


def top_k(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` vectors with the largest scores for each query, ``(query_id, rank, vec_id, score)``.

    ``is_query`` is a condition over ``vec_id``.
    """
    spark, rows = vectors.sparkSession, integers(vectors, vec_id, vector)
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("asked"))
    # One row for each length of vectors.
    sizes = stored(counts.select("dim", F.ceil(F.col("n") / SHARD).alias("shards"), F.ceil(F.col("asked") / PART).alias("parts")), "sizes")
    dealt = rows.join(F.broadcast(sizes), "dim")
    shard = F.pmod(F.xxhash64("row"), "shards").alias("shard")
    index = stored(dealt.where("parts > 0").select("*", shard).groupBy("dim", "shard").applyInArrow(_build, _INDEX), "index")
    part = F.pmod(F.xxhash64("row"), F.greatest("parts", F.lit(1))).alias("part")
    asked = stored(dealt.where(is_query).select("row", "vec_id", "dim", "x", "shards", part), "queries")
    last = sizes.where("parts > 0").agg(F.max("shards")).first()[0] or 0
    best, low, wave = None, 0, 1
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    while low < last:
        high = low + wave
        bars = asked.withColumn("bar", F.lit(None).cast("bigint"))
        if best is not None:
            known = best.where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("bar"))
            bars = asked.join(known, "row", "left")
        met = F.explode(F.sequence(F.lit(low).cast("bigint"), F.least(F.lit(high), "shards") - 1)).alias("at")
        queries = bars.where(F.col("shards") > low).select(F.col("dim").alias("of"), met, F.col("part").alias("piece"), "row", "vec_id", "x", "bar")
        here = index.where((F.col("shard") >= low) & (F.col("shard") < high)).join(F.broadcast(sizes.select("dim", "parts")), "dim")
        here = here.select(*index.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
        found = here.groupBy("dim", "shard", "part").cogroup(queries.groupBy("of", "at", "piece")).applyInArrow(_search(k), _FOUND)
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        low, wave = high, wave * GROWTH
    if best is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return best.select(F.col("query_id"), "rank", "vec_id", "score")
