"""Tables that change by commits: a reader sees all of a change or nothing of it.

A table ``t`` is a view of its last version, the catalog table ``t__v<n>``. The partitions
of a version lie in the folders of the commits that wrote them, so a commit writes only
the partitions it changes, into a folder of its own, and registers the others where they
are. Replacing the view is the last step and the only one that readers see; a query that was
planned before reads the old files to its end. What a failed commit leaves is never read, and
goes with ``vacuum``. One writer at a time.

Partition values must not be null. Tables without partitions are written whole.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sources.tables import DATE_PARTITION, LOAD_TIME, by_name, sql_literal

_VERSION, _ROOT, _PARTITIONS = "footfall.version", "footfall.root", "footfall.partitions"
_COMMIT = "commit-[0-9a-f]{32}"
#: Partitions registered by one statement.
_STATEMENT = 500


def create(spark: SparkSession, table: str, schema: T.StructType, root: str, partition_by: Sequence[str] = ()) -> None:
    """Create an empty table with its files under ``root``, unless it exists."""
    if not spark.catalog.tableExists(table):
        last = [f for f in schema if f.name in partition_by]
        schema = T.StructType([*(f for f in schema if f.name not in partition_by), *last])
        folder = _write(spark.createDataFrame([], schema), root, partition_by)
        _register(spark, table, 0, schema, root, partition_by, folder, {})
        _switch(spark, table, 0, root, partition_by)


def overwrite_dates(df: DataFrame, table: str, dates: Iterable[date], day: Column) -> int:
    """Replace ``dates`` with the rows of ``df`` on those dates, as one commit; returns the version.

    As ``tables.overwrite_dates``: ``day`` becomes the partition ``dt``, the load time is stamped,
    and dates without rows end up empty.
    """
    wanted = sorted(set(dates))
    rows = df.withColumn(DATE_PARTITION, day).where(F.col(DATE_PARTITION).isin(wanted))
    rows = rows.withColumn(LOAD_TIME, F.lit(datetime.now(timezone.utc)))
    return _commit(df.sparkSession, table, rows, {(d,) for d in wanted})


def delete_where(spark: SparkSession, table: str, predicate: Column) -> int:
    """Delete the rows for which ``predicate`` is true, as one commit; returns the version.

    Only partitions with such rows are written anew, and no row is written twice.
    """
    n, _, partitions = _head(spark, table)
    rows = spark.table(f"{table}__v{n}")
    keep = rows.where(~F.coalesce(predicate, F.lit(False)))
    if not partitions:
        return _commit(spark, table, keep, set())
    # As many values as folders that are touched.
    touched = rows.where(predicate).select(*partitions).distinct()
    values = touched.collect()
    if not values:
        return n
    # The values are a small table, and pruned by like those of a query.
    here = F.broadcast(spark.createDataFrame(values, touched.schema))
    return _commit(spark, table, keep.join(here, partitions, "left_semi"), {tuple(v) for v in values})


def version(spark: SparkSession, table: str) -> int:
    return _head(spark, table)[0]


def read_version(spark: SparkSession, table: str, n: int) -> DataFrame:
    """An earlier version, as long as ``vacuum`` has left it."""
    return spark.table(f"{table}__v{n}")


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` versions, and files that none of these reads."""
    n, root, _ = _head(spark, table)
    kept = range(max(0, n - keep + 1), n + 1)
    database, _, name = table.rpartition(".")
    for r in spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''} LIKE '{name}__v*'").collect():
        if int(r.tableName.rpartition("__v")[2]) not in kept:
            spark.sql(f"DROP TABLE {database + '.' if database else ''}{r.tableName}")
    used = {f"manifest-{i}" for i in kept}
    for i in kept:
        used |= {re.search(_COMMIT, place)[0] for place in _places(spark, root, i).values()}
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        if status.getPath().getName() not in used:
            files.delete(status.getPath(), True)


def _commit(spark: SparkSession, table: str, rows: DataFrame, replaced: set[tuple]) -> int:
    n, root, partitions = _head(spark, table)
    rows = by_name(rows, f"{table}__v{n}")
    folder = _write(rows, root, partitions)
    kept = {v: place for v, place in _places(spark, root, n).items() if partitions and v not in replaced}
    _register(spark, table, n + 1, rows.schema, root, partitions, folder, kept)
    _switch(spark, table, n + 1, root, partitions)
    return n + 1


def _write(rows: DataFrame, root: str, partitions: Sequence[str]) -> str:
    folder = f"{root.rstrip('/')}/commit-{uuid.uuid4().hex}"
    if partitions:
        rows = rows.hint("rebalance", *partitions)
    rows.write.partitionBy(*partitions).parquet(folder)
    return folder


def _register(spark, table, n, schema, root, partitions, folder, kept) -> None:
    """Create the catalog table of a version: the new folder, and the kept partitions where they are."""
    places = {(): folder}
    if partitions:
        file = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
        place = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
        # As many rows as folders that were written.
        written = spark.read.schema(schema).parquet(folder).select(*partitions, place).distinct().collect()
        if any(v is None for r in written for v in r):
            raise ValueError(f"partition values of {table} must not be null")
        places = kept | {tuple(r)[:-1]: r[-1] for r in written}
    values = T.StructType([*(schema[p] for p in partitions), T.StructField("place", T.StringType())])
    manifest = spark.createDataFrame([(*v, place) for v, place in places.items()], values)
    manifest.coalesce(1).write.mode("overwrite").parquet(_manifest(root, n))
    spark.sql(f"DROP TABLE IF EXISTS {table}__v{n}")  # of a commit that failed; files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {table}__v{n} ({columns}) USING parquet{by} LOCATION '{folder}'")
    specs = [f"PARTITION ({_spec(partitions, v)}) LOCATION '{place}'" for v, place in places.items() if partitions]
    for i in range(0, len(specs), _STATEMENT):
        spark.sql(f"ALTER TABLE {table}__v{n} ADD {' '.join(specs[i : i + _STATEMENT])}")


def _switch(spark: SparkSession, table: str, n: int, root: str, partitions: Sequence[str]) -> None:
    said = f"'{_VERSION}' = '{n}', '{_ROOT}' = '{root}', '{_PARTITIONS}' = '{','.join(partitions)}'"
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({said}) AS SELECT * FROM {table}__v{n}")


def _head(spark: SparkSession, table: str) -> tuple[int, str, list[str]]:
    said = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _VERSION not in said:
        raise ValueError(f"{table} is not a table with versions")
    return int(said[_VERSION]), said[_ROOT], [p for p in said[_PARTITIONS].split(",") if p]


def _manifest(root: str, n: int) -> str:
    return f"{root.rstrip('/')}/manifest-{n}"


def _places(spark: SparkSession, root: str, n: int) -> dict[tuple, str]:
    """Folder of each partition of a version: as many rows as partitions."""
    return {tuple(r)[:-1]: r.place for r in spark.read.parquet(_manifest(root, n)).collect()}


def _spec(partitions: Sequence[str], values: tuple) -> str:
    return ", ".join(f"`{p}` = {sql_literal(v)}" for p, v in zip(partitions, values))
