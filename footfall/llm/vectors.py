"""Near copies among vectors: an exact metric range join.

Vectors link if their labels and lengths agree and their cosine, in double
precision, is at least 0.98: for vectors of length one that is a Euclidean
distance of at most 0.2. Equal vectors are joined into one first. The vectors of
a label are dealt to the nearest of some pivots. A vector may have a partner in
another cell only if it passes two tests that follow from the triangle
inequality and from the mirror plane between the pivots; only then it is copied
to that cell, and only to cells before its own, as one meeting is enough. Cells
are joined independently, large ones block against block, by matrix products.

Edge cases: a vector that is null, empty or zero, or has a null or non-finite
component, or whose label or id is null, links with nothing and is a component
of its own; vectors of different lengths never link; repeated rows are vectors
of their own, whether their ids differ or not; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.sources.scratch import stored

COSINE = 0.98
#: Vectors in a cell about, and in a block at most about.
CELL = 2048
BLOCK = 2048
#: Most pivots altogether; with more vectors the cells grow, and are split into blocks.
PIVOTS = 8192
#: Linked pairs of two blocks that are passed on as they are; of more only a forest is.
PLAIN = 20_000

_GROUP = ["label", "dim", "cell", "kind", "i", "j"]


def valid(column: str = "embedding"):
    """Whether a vector can have links."""
    return F.coalesce(
        F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(column, lambda x: x != 0),
        F.lit(False),
    )


def _unit(x: list) -> np.ndarray:
    v = np.stack([np.asarray(e, float) for e in x])
    v = v / np.abs(v).max(1, keepdims=True)  # no overflow of squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _deal(pivots: dict, radius: float):
    """Home cell of each vector, and the cells before it where it may have partners."""
    units = {key: _unit(v) for key, v in pivots.items()}
    planes = {key: np.linalg.norm(u[:, None, :] - u[None, :, :], axis=2) for key, u in units.items()}

    def run(frames):
        for frame in frames:
            parts = []
            for key, group in frame.groupby(["label", "dim"], sort=False):
                key = tuple(int(k) for k in key)
                if key not in units:
                    parts.append(group.assign(cell=0, home=True))
                    continue
                x = _unit(group["embedding"].tolist())
                square = np.maximum(2 - 2 * x @ units[key].T, 0)
                home = square.argmin(1)
                d = np.sqrt(square)
                own = np.arange(len(x))
                near = d - d[own, home][:, None] <= 2 * radius + 1e-9
                near &= square - square[own, home][:, None] <= 2 * radius * planes[key][home] + 1e-9
                near &= np.arange(near.shape[1]) < home[:, None]
                parts.append(group.assign(cell=home, home=True))
                row, cell = np.nonzero(near)
                if len(row):
                    parts.append(group.iloc[row].assign(cell=cell, home=False))
            if parts:
                yield pd.concat(parts)[["label", "dim", "rep", "n", "embedding", "cell", "home"]]

    return run


def _forest(left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the linked pairs join."""
    if linked.sum() <= PLAIN:
        i, j = np.nonzero(linked)
        return list(zip(left[i].tolist(), right[j].tolist()))
    big = np.iinfo(np.int64).max
    name = left.copy()
    while True:
        other = np.minimum(right, np.where(linked, name[:, None], big).min(0))
        new = np.minimum(name, np.where(linked, other[None, :], big).min(1))
        if (new == name).all():
            break
        name = new
    a, b = linked.any(1), linked.any(0)
    return list(zip(left[a].tolist(), name[a].tolist())) + list(zip(right[b].tolist(), other[b].tolist()))


def _compare(cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        kind, same = group["kind"].iloc[0], group["i"].iloc[0] == group["j"].iloc[0]
        left = group[group["side"] == 0]
        right = left if kind == 0 and same else group[group["side"] == 1]
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "links": [], "other": []}).astype({"id": "int64", "links": "int64", "other": "float64"})
        linked = _unit(left["embedding"].tolist()) @ _unit(right["embedding"].tolist()).T >= cosine
        if right is left:
            np.fill_diagonal(linked, False)
        a, b = left["rep"].to_numpy(np.int64), right["rep"].to_numpy(np.int64)
        counts = [(a, linked @ right["n"].to_numpy(np.int64))]
        if right is not left:
            counts.append((b, linked.T @ left["n"].to_numpy(np.int64)))
        out = [pd.DataFrame({"id": i[c > 0], "links": c[c > 0]}) for i, c in counts]
        edges = _forest(a, b, linked)
        out.append(pd.DataFrame({"id": [e[0] for e in edges], "links": 0, "other": [e[1] for e in edges]}))
        return pd.concat(out).reindex(columns=["id", "links", "other"]).astype({"id": "int64", "links": "int64", "other": "Int64"})

    return run


def vector_links(rows: DataFrame, cosine: float = COSINE, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``(vec_id, embedding, label)``."""
    rows = rows.select("vec_id", "embedding", F.col("label").cast("bigint").alias("label"))
    fit = valid() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = rows.select(
        "vec_id", "label", F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("k1"), F.hash("embedding").alias("k2"),
        fit.alias("fit"), "embedding",
    )
    key = ["label", "dim", "k1", "k2"]
    unlike = keyed.where("NOT fit").select("vec_id")
    names = stored(keyed.where("fit").select("vec_id", *key), "vector-keys")
    alike = keyed.where("fit").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    alike = stored(alike.withColumn("rep", F.col("rep").cast("bigint")), "vectors")

    # Pivots: of every hash bucket of a large label's vectors the least id.
    sizes = alike.groupBy("label", "dim").agg(F.count("*").alias("m"))
    total = sizes.agg(F.sum("m")).first()[0] or 0
    width = max(cell, -(-total // PIVOTS))
    large = sizes.where(F.col("m") > width).withColumn("cells", F.ceil(F.col("m") / F.lit(width)))
    bucket = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("cells"))
    chosen = alike.join(large, ["label", "dim"]).groupBy("label", "dim", bucket.alias("b")).agg(F.min("rep").alias("rep"))
    picked = alike.join(chosen.select("label", "dim", "rep"), ["label", "dim", "rep"]).select("label", "dim", "rep", "embedding")
    pivots: dict = {}
    for r in sorted(picked.collect(), key=lambda r: (r.label, r.dim, r.rep)):  # at most twice PIVOTS
        pivots.setdefault((r.label, r.dim), []).append(r.embedding)

    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    vector = alike.schema["embedding"].dataType.simpleString()
    dealt = alike.select("label", "dim", "rep", "n", "embedding").mapInPandas(
        _deal(pivots, radius), f"label bigint, dim int, rep bigint, n bigint, embedding {vector}, cell int, home boolean"
    )
    dealt = stored(dealt, "cells")
    counts = dealt.groupBy("label", "dim", "cell").agg(
        F.ceil(F.count(F.when(F.col("home"), 1)) / F.lit(block)).cast("int").alias("homes"),
        F.ceil(F.count(F.when(~F.col("home"), 1)) / F.lit(block)).cast("int").alias("guests"),
    )
    placed = dealt.join(counts, ["label", "dim", "cell"])
    mine = F.pmod(F.xxhash64("rep", F.lit(2)), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))).cast("int")
    placed = placed.withColumn("mine", mine)

    def task(kind: int, i, j, side: int):
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    b = F.col("mine")
    home_tasks = F.concat(
        F.transform(F.sequence(b, F.col("homes") - 1), lambda j: task(0, b, j, 0)),
        F.transform(upto(b), lambda i: task(0, i, b, 1)),
        F.transform(upto(F.col("guests")), lambda j: task(1, b, j, 0)),
    )
    guest_tasks = F.transform(upto(F.col("homes")), lambda i: task(1, i, b, 1))
    tasks = placed.withColumn("t", F.explode(F.when(F.col("home"), home_tasks).otherwise(guest_tasks)))
    tasks = tasks.select("label", "dim", "cell", "rep", "n", "embedding", "t.*")
    found = stored(tasks.groupBy(*_GROUP).applyInPandas(_compare(cosine), "id bigint, links bigint, other bigint"), "vector-links")

    named = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    told = alike.select(*key, "rep", "n").join(degree, F.col("rep") == F.col("id"), "left").drop("id")
    told = told.join(named, F.col("rep") == F.col("id"), "left").drop("id")
    told = told.select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    out = names.join(told, key).select("vec_id", "n_links", "component_id")
    out = out.unionByName(unlike.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").cast("bigint").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
