"""Numbers, running totals and bursts along an order, without a group in one task.

A window over a key puts all rows of the key into one task. Here rows are sorted
into range partitions by key and order, so a key with very many rows is cut over
several. A first pass works inside each partition; what the earlier partitions
hold of the same key is added in a second one. Only the first key of a partition
can begin before it, so there are no more such offsets than partitions, and only
they are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions import clock
from footfall.sources.scratch import stored

PART, PLACE = "__part", "__place"
BEFORE = "__before"
_ROW_BITS = 33  # of a row's place, in monotonically_increasing_id


def dealt(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``rows`` sorted into range partitions and stored, with partition and place of each row.

    Rows that agree in all of ``order`` share a partition: let it end in
    something that tells rows apart.
    """
    clash = [c for c in rows.columns if c.startswith((PART, PLACE, BEFORE))]
    if clash:
        raise ValueError(f"columns {clash} are needed here")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn(PART, F.monotonically_increasing_id()), "dealt")
    place = F.col(PART).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn(PLACE, place).withColumn(PART, F.shiftright(PART, _ROW_BITS))


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str = "number") -> DataFrame:
    """Add the number of each row along ``order``, from 0, over all rows."""
    placed = dealt(rows, order)
    sizes = placed.groupBy(PART).agg(F.count("*").alias("_n"))
    # One row a partition.
    before = sizes.select(PART, (F.sum("_n").over(Window.orderBy(PART)) - F.col("_n")).alias(BEFORE))
    found = placed.join(F.broadcast(before), PART)
    return found.select(*_columns(rows), (F.col(BEFORE) + F.col(PLACE)).alias(name))


def positions(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add the place of each row among those of its key, from 0."""
    placed = dealt(rows, [*keys, *order])
    within = F.row_number().over(_so_far(keys)).cast("long") - 1
    found = _with_earlier(placed.withColumn(name, within), placed, keys, {"rows": F.count("*")})
    return found.select(*_columns(rows), (F.col(name) + F.coalesce(BEFORE + "rows", F.lit(0))).alias(name))


def running_totals(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, Column],
    combine: Callable = F.sum, both: Callable = Column.__add__,
) -> DataFrame:
    """Sums of ``totals`` up to each value of ``order`` per key; rows that tie share them.

    One row per distinct (keys, order). A null adds nothing; a sum is null until
    there was a value. Instead of a sum it can be another aggregate ``combine``, where
    ``both`` makes that of two sets of rows out of theirs.
    """
    sums = [combine(value).alias(name) for name, value in totals.items()]
    placed = dealt(rows.groupBy(*keys, *order).agg(*sums), [*keys, *order])
    within = placed.withColumns({name: combine(name).over(_so_far(keys)) for name in totals})
    found = _with_earlier(within, placed, keys, {name: combine(name) for name in totals}, combine)
    both = [F.coalesce(both(F.col(name), F.col(BEFORE + name)), name, BEFORE + name).alias(name) for name in totals]
    return found.select(*keys, *order, *both)


def bursts(rows: DataFrame, keys: Sequence[str], time: str, gap_s: int, first_group: int = 0) -> DataFrame:
    """Number the bursts per key as ``gap_groups`` does, however many times a key has.

    Returns one row per distinct (keys, time) with its ``group_id``.
    """
    placed = dealt(rows.select(*keys, time).distinct(), [*keys, time])
    here = _with_earlier(placed, placed, keys, {"last": F.max(time)}, F.max)
    previous = F.coalesce(F.lag(time).over(_so_far(keys)), BEFORE + "last")
    far = clock.elapsed_seconds(previous, F.col(time)) > gap_s
    starts = F.coalesce(far.cast("long"), F.lit(first_group).cast("long"))
    flagged = stored(here.select(*keys, time, PART, PLACE, starts.alias("_starts")), "bursts")
    within = flagged.withColumn("group_id", F.sum("_starts").over(_so_far(keys)))
    found = _with_earlier(within, flagged, keys, {"starts": F.sum("_starts")})
    return found.select(*keys, time, (F.col("group_id") + F.coalesce(BEFORE + "starts", F.lit(0))).alias("group_id"))


def _so_far(keys: Sequence[str]):
    return Window.partitionBy(PART, *keys).orderBy(PLACE)


def _with_earlier(
    rows: DataFrame, placed: DataFrame, keys: Sequence[str], each: dict[str, Column], combine: Callable = F.sum
) -> DataFrame:
    """Add what the aggregates ``each`` give for the key in earlier partitions of ``placed``, null where it has none."""
    edges = placed.where(F.col(PLACE) == 0).select(*keys).distinct()
    parts = _null_safe(placed, edges, keys, "left_semi").groupBy(PART, *keys)
    parts = parts.agg(*(value.alias(BEFORE + name) for name, value in each.items()))
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumns({BEFORE + name: combine(BEFORE + name).over(earlier) for name in each})
    return _null_safe(rows, before, [PART, *keys], "left")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys, nulls included, with a right side of a few rows for each partition at most."""
    renamed = right.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    joined = left.join(F.broadcast(renamed), same, how)
    return joined if how == "left_semi" else joined.drop(*(f"_r{i}" for i in range(len(keys))))


def _columns(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in rows.columns]
