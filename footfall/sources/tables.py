"""Writing to catalog tables: create, append by name, replace dates, delete."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.sources.scratch import cleared, stored

DATE_PARTITION = "dt"
LOAD_TIME = "batch_time"
_BUCKET = "_bucket"


def create_table(
    spark: SparkSession, table: str, schema: StructType, partition_by: Sequence[str] = (),
    buckets: tuple[str, int] | None = None,
) -> None:
    """Create a Parquet table unless it exists; ``buckets`` are a column and a number of buckets by it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    cut = f" CLUSTERED BY ({buckets[0]}) SORTED BY ({buckets[0]}) INTO {buckets[1]} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{partitions}{cut}")


def append(df: DataFrame, table: str) -> None:
    """Append by column name. Columns the table lacks are an error."""
    by_name(df, table).write.insertInto(table)


def append_query(spark: SparkSession, query: str, table: str, args: dict | None = None) -> None:
    """Append the result of a query with named parameters (``:name``)."""
    append(spark.sql(query, args=args or {}), table)


def append_rows(spark: SparkSession, table: str, rows: Sequence[dict]) -> None:
    """Append a few literal rows; columns left out become null."""
    append(spark.createDataFrame(list(rows), _schema_of(spark, table, rows)), table)


def copy_columns(spark: SparkSession, source: str, target: str, columns: Sequence[str]) -> None:
    append(spark.table(source).select(*columns), target)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def overwrite_dates(
    df: DataFrame, table: str, dates: Iterable[date], day: Column, buckets: tuple[str, int] | None = None
) -> None:
    """Replace ``dates`` in ``table`` with the rows of ``df`` on those dates.

    ``day`` is the date of a row; it becomes the partition column ``dt``. The
    load time is stamped here. Running it again gives the same table, and a date
    for which ``df`` has no rows ends up empty. Everything that can be wrong with
    the columns is checked before the table is touched. A table that is created here is cut into
    ``buckets``, a column and a number: tables with the same buckets are joined by that column
    without being shuffled.
    """
    spark = df.sparkSession
    wanted = sorted(set(dates))
    # A fixed stamp, so that a task run twice writes the same value.
    stamp = F.lit(datetime.now(timezone.utc))
    rows = (
        df.withColumn(DATE_PARTITION, day)
        .where(F.col(DATE_PARTITION).isin(wanted))
        .withColumn(LOAD_TIME, stamp)
    )
    existed = spark.catalog.tableExists(table)
    if not existed:
        create_table(spark, table, rows.schema, [DATE_PARTITION], buckets)
    elif _partition_columns(spark, table) != [DATE_PARTITION]:
        raise ValueError(f"{table} is not partitioned by {DATE_PARTITION}")
    # Splits a large date over several files and merges small ones.
    # The dates that get rows are noted on the way: as many as there are dates.
    written = Observation()
    # Above the exchange, as an empty one is left out of the plan with all below it.
    rows = by_name(rows, table)
    cut = buckets_of(spark, table)
    if cut:
        # A bucket of a date goes to one task, and to one file of it unless it is large. Spark leaves a shuffle by
        # the bucket column alone out where the rows come in buckets, and then sorts all of them in a few tasks.
        rows = rows.withColumn(_BUCKET, F.pmod(F.hash(cut[0]), F.lit(cut[1])))
        rows = rows.hint("rebalance", DATE_PARTITION, _BUCKET).drop(_BUCKET)
    else:
        rows = rows.hint("rebalance", DATE_PARTITION)
    rows = rows.observe(written, F.collect_set(DATE_PARTITION).alias("dates"))
    with _overwrite_mode(spark, "dynamic"):
        rows.write.mode("overwrite").insertInto(table)
    if existed:
        # Dynamic overwrite leaves dates alone that got no rows.
        for day in sorted(set(wanted) - set(written.get["dates"] or [])):
            drop_partition(spark, table, {DATE_PARTITION: day})


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` has rows for, by column name."""
    with _overwrite_mode(df.sparkSession, "dynamic"):
        by_name(df, table).write.mode("overwrite").insertInto(table)


def delete_where(spark: SparkSession, table: str, predicate: Column) -> None:
    """Delete the rows for which ``predicate`` is true.

    Only partitions that hold such rows are rewritten. Their other rows go to a
    shared scratch folder first, as Spark cannot overwrite what it is reading;
    the folder is removed afterwards.
    """
    with cleared():
        _delete(spark, table, predicate)


def _delete(spark: SparkSession, table: str, predicate: Column) -> None:
    rows = spark.table(table)
    columns, partitions = rows.columns, _partition_columns(spark, table)
    keep = rows.where(~F.coalesce(predicate, F.lit(False)))
    if not partitions:
        kept = stored(keep, "kept")
        kept.select(columns).write.mode("overwrite").insertInto(table)
        return
    touched = rows.where(predicate).select(*partitions).distinct()
    # Partition values are metadata: as many rows here as folders in the table.
    touched_values = touched.collect()
    if not touched_values:
        return
    same = [rows[p].eqNullSafe(F.col(f"_t_{p}")) for p in partitions]
    renamed = spark.createDataFrame(touched_values, touched.schema).toDF(*[f"_t_{p}" for p in partitions])
    kept = stored(keep.join(renamed, same, "left_semi"), "kept")
    with _overwrite_mode(spark, "dynamic"):
        kept.select(columns).hint("rebalance", *partitions).write.mode("overwrite").insertInto(table)
    left = {tuple(r) for r in kept.select(*partitions).distinct().collect()}
    for values in touched_values:
        if tuple(values) not in left:
            drop_partition(spark, table, values.asDict())


def by_name(df: DataFrame, table: str) -> DataFrame:
    target = df.sparkSession.table(table).schema
    unknown = [c for c in df.columns if c not in target.names]
    if unknown:
        raise ValueError(f"{table} has no columns {unknown}")
    have = set(df.columns)
    return df.select(
        *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    )


def _schema_of(spark: SparkSession, table: str, rows: Sequence[dict]) -> StructType:
    used = {c for row in rows for c in row}
    schema = spark.table(table).schema
    unknown = used - set(schema.names)
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    return StructType([f for f in schema.fields if f.name in used])


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    """From ``DESCRIBE``, which lists the partition columns in a section of their own."""
    described = [r.col_name for r in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    if "# Partition Information" not in described:
        return []
    section = described[described.index("# Partition Information") + 1 :]
    return [c for c in section if c and not c.startswith("#")]


def buckets_of(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """Column and number of the buckets of a table, if it has any."""
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return (said["Bucket Columns"].strip("[]`"), int(said["Num Buckets"])) if "Num Buckets" in said else None


def drop_partition(spark: SparkSession, table: str, values: dict) -> None:
    spec = ", ".join(f"`{name}` = {sql_literal(value)}" for name, value in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, date):
        return f"DATE '{value}'"
    return "'" + str(value).replace("'", "\\'") + "'"


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)
