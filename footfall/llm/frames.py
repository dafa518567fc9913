"""Python over whole rows, whatever their columns are called, and rows sorted out without moving them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a filter for each key, and at most; bits of one of its parts, which Spark's bitmaps have.
KEY_BITS, MOST_BITS, PART_BITS = 16, 1 << 26, 1 << 15


def perhaps_among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is in a column of ``keys``, and about one of sixteen others; rows without a key go.

    The keys become bits by their hash, 16 for each, which are broadcast: 8 MB at
    most. From four million keys on more others stay, and no row that is wanted goes.
    """
    parts = min(max(keys.count() * KEY_BITS // PART_BITS, 1), MOST_BITS // PART_BITS)
    hashed = F.xxhash64(key)
    part, at = F.pmod(hashed, F.lit(parts)), F.pmod(F.shiftrightunsigned(hashed, 32), F.lit(PART_BITS))
    bits = keys.where(F.col(key).isNotNull()).groupBy(part.alias("__part")).agg(F.bitmap_construct_agg(at).alias("__bits"))
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    marked = rows.where(F.col(key).isNotNull()).select("*", part.alias("__part"), at.alias("__at"))
    hit = F.getbit(byte, (F.col("__at") % 8).cast("int")) == 1
    return marked.join(F.broadcast(bits), "__part").where(hit).select(rows.columns)


def map_rows(
    rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` that also takes names with dots or blanks: Spark sees numbered columns only."""
    given, made = rows.columns, schema.names
    numbered = [f"c{i}" for i in range(len(made))]
    safe = T.StructType([T.StructField(n, f.dataType) for n, f in zip(numbered, schema.fields)])

    def renamed(batches):
        for batch in run(b.rename_columns(given) for b in batches):
            yield batch.rename_columns(numbered)

    return rows.toDF(*(f"c{i}" for i in range(len(given)))).mapInArrow(renamed, safe).toDF(*made)
