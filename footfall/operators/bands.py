"""Join of rows whose times lie within a band of each other.

Time is cut into cells of the band's width, counted from a fixed origin. What a left row can
meet lies in two neighbouring cells at most, so it is sent to these; a right row stays in its
own. The join is one of equal keys and cells: a key with very many rows is cut along time, each
pair is met once, and no pair is formed that is two cells or more apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MICROS = 1_000_000


def band_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, low: float, high: float
) -> DataFrame:
    """All pairs with equal ``keys`` and ``low <= right_time - left_time <= high``, both ends included.

    Times are numbers, or dates and timestamps with ``low`` and ``high`` in seconds. Both sides
    have columns of other names, but for the keys. Rows with a null key or time have no partner.
    """
    if low > high:
        raise ValueError(f"the band from {low} to {high} is empty")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"both sides have the columns {sorted(clash)}")
    (at, scale, whole), (to, _, other) = (_position(df, c) for df, c in ((left, left_time), (right, right_time)))
    low, high = low * scale, high * scale
    if whole and other:
        low, high = int(-(-low // 1)), int(high // 1)  # whole numbers differ by whole numbers
    width = max(high - low, 1)
    exact = whole and other
    cell = lambda t: _floored(t, width) if exact else F.floor(t / F.lit(float(width)))
    here = left.withColumn("_at", at).where(F.col("_at").isNotNull())
    more = 0 if exact else width / 1024  # sums of fractions are rounded
    here = here.withColumn("_cell", F.explode(F.sequence(cell(F.col("_at") + F.lit(low - more)), cell(F.col("_at") + F.lit(high + more)))))
    there = right.withColumn("_to", to).where(F.col("_to").isNotNull()).withColumn("_cell", cell(F.col("_to")))
    gap = F.col("_to") - F.col("_at")
    pairs = here.join(there, [*keys, "_cell"]).where((gap >= low) & (gap <= high))
    named = [*left.columns, *(c for c in right.columns if c not in keys)]
    return pairs.select(*(F.col(f"`{c}`") for c in named))


def _floored(t: Column, width: int) -> Column:
    """Division of whole numbers towards minus infinity, exact for all of 64 bits."""
    rest = F.pmod(t, F.lit(width).cast("long"))
    return F.call_function("div", t - rest, F.lit(width).cast("long"))


def _position(df: DataFrame, name: str) -> tuple[Column, int, bool]:
    """A number for a time, units in a second of it, and whether it is whole."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.IntegralType):
        return column.cast("long"), 1, True
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")), _MICROS, True
    return column.cast("double"), 1, False
