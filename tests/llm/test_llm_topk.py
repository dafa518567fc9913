"""The search against all inner products."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import topk


def plain(rows, k):
    fit = [(i, v, [int(np.floor(1024 * float(np.float32(x)))) for x in e]) for i, (v, e) in enumerate(rows)
           if v is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, v, q in fit:
        if v % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, x)), w, j) for j, w, x in fit if j != i and len(x) == len(q))
            out += [(v, r, w, -s) for r, (s, w, _) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, k=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"row": F.lit("r"), "x": F.lit(1), "dim": F.lit(2)})
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0, k).collect()))


def vectors(seed, n, dim, few=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * 2.0 ** rng.integers(-3, 3, size=(n, 1))
    if few:
        x[rng.random(n) < 0.4] = rng.normal(size=(few, dim))[0]
        x[rng.random((n, dim)) < 0.5] = 0
    return x


@pytest.mark.parametrize("seed, n, dim, few", [(0, 400, 8, None), (1, 400, 8, 3), (2, 90, 1, 2)])
def test_members_lose_nothing(seed, n, dim, few):
    x = np.floor(1024 * vectors(seed, n, dim, few)).astype(np.int64)
    shard = pa.table({"dim": [dim] * n, "shard": [0] * n, "vec_id": np.arange(n), "row": np.arange(n), "x": list(x)})
    made = topk._build(shard)
    listed, segments = (np.frombuffer(made[c][0].as_py(), np.int64) for c in ("listed", "segments"))
    cut = 0
    for i in range(0, n, 7):
        scores, own = x @ x[i], np.arange(n) == i
        want = np.sort(scores[~own])[::-1][:5]
        for bar in (None, int(want[-1]), int(want[-1]) - 1000):
            at, got = topk.members(x[i], x, listed, segments.reshape(-1, 5), 5, bar, own)
            cut += len(at) < n // 2
            assert (got == scores[at]).all() and i not in at
            assert set(np.flatnonzero(~own & (scores >= want[-1]))) <= set(at.tolist())  # ties included
    assert cut


def test_against_all_products(spark, monkeypatch):
    """Many shards, waves and parts."""
    monkeypatch.setattr(topk, "SHARD", 60)
    monkeypatch.setattr(topk, "PART", 30)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(5, 900, 6, 4))]
    assert found(spark, rows) == plain(rows, 3)


def test_edges(spark):
    rows = [(5, [1.0, 2.0]), (5, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.0, 0.0]), (10, [-1.0, 0.5]), (15, [0.0005, -0.0005])]
    rows += [(20, []), (21, []), (25, [1.0]), (30, None), (35, [None, 1.0]), (40, [float("nan"), 1.0]), (45, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    rows += [(50, [3e4, 1e4, -2e5]), (51, [1e5, 1.0, 0.3]), (52, [1e5, 1.0, 0.3])]  # sums beyond what doubles hold
    got = found(spark, rows, 3)
    assert got == plain(rows, 3)
    assert [g for g in got if g[0] in (20, 25, 30)] == [(20, 1, 21, 0)]
    assert found(spark, []) == [] and found(spark, [(1, [1.0])]) == []


def test_scores_that_do_not_fit(spark):
    with pytest.raises(Exception):
        found(spark, [(5, [3e15]), (1, [3e15])])
