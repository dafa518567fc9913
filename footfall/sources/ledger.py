"""Loads that can be cut short and called again: every row of every file once.

A ledger table notes which files went into a table, up to which row. A load is a
partition of its table, written before the ledger calls it done. A load that is not
done when the next one begins was cut short: its partition is dropped, and its files are
loaded anew. Files that have grown since give the rows after those that were loaded.
Files may only grow at their end; one that became smaller or has fewer rows is refused.

Row numbers take two passes over the rows as they were stored: rows are counted for each
split, the counts of earlier splits of a file are added up, and rows before the first
new one are left out. No file has to be read by one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from footfall.sources import csv_files
from footfall.sources.scratch import cleared, stored
from footfall.sources.tables import append, create_table, drop_partition, overwrite_partitions

LEDGER, LOAD = "load_ledger", "load_id"
BEGUN, DONE, UNDONE = "begun", "done", "undone"
_TYPES = {"size": T.LongType(), "modified": T.TimestampType(), "first_row": T.LongType(), "rows": T.LongType()}
_SCHEMA = T.StructType([
    T.StructField(name, _TYPES.get(name, T.StringType()))
    for name in ("target", "file", "size", "modified", "first_row", "rows", LOAD, "state")
])


@dataclass(frozen=True)
class Load:
    """Files for one table: ``(path, file, size, modified, first_row)`` of each."""

    table: str
    ledger: str
    load_id: str
    files: list


def load_new(
    spark: SparkSession, folder: str, database: str = "default", skip: Sequence[str] = (), **options
) -> dict[str, int]:
    """Append what is new in a folder to the tables named after its entries; returns the rows added to each.

    Entries, names and ``options`` are those of ``load_csv_folder``. Tables get the load in
    a partition column ``load_id``. One load into a database at a time.
    """
    added = {}
    for entry, name in csv_files.table_names(spark, folder, skip).items():
        load = begin(spark, f"{folder.rstrip('/')}/{entry}", f"{database}.{name}", f"{database}.{LEDGER}")
        with cleared():
            counts = write(spark, load, **options) if load.files else None
            added[load.table] = finish(spark, load, counts) if load.files else 0
    return added


def begin(spark: SparkSession, path: str, table: str, ledger: str) -> Load:
    """Undo loads into ``table`` that were cut short, and note a new one of what is new at ``path``."""
    create_table(spark, ledger, _SCHEMA)
    mine = spark.table(ledger).where(F.col("target") == table)
    last = mine.groupBy(LOAD).agg(F.max(F.col("state") == DONE).alias("done"), F.max(F.col("state") == UNDONE).alias("undone"))
    for cut in [r[0] for r in last.where("NOT done AND NOT undone").collect()]:
        if spark.catalog.tableExists(table):
            drop_partition(spark, table, {LOAD: cut})
        _note(spark, ledger, [{"target": table, LOAD: cut, "state": UNDONE}])
    loaded = mine.where(F.col("state") == DONE).groupBy("file").agg(
        F.sum("rows").alias("first_row"), F.max("size").alias("_size"), F.max("modified").alias("_modified")
    )
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    there = there.select("path", csv_files.bare_path(F.col("path")).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    # Only files that are new or have changed reach the driver, which has to name them to the reader.
    new = there.join(loaded, "file", "left").where("_size IS NULL OR size <> _size OR modified <> _modified").collect()
    shrunk = [r.path for r in new if r._size is not None and r.size < r._size]
    if shrunk:
        raise ValueError(f"files that were loaded are smaller now: {shrunk[:5]}")
    files = sorted((r.path, r.file, r.size, r.modified, r.first_row or 0) for r in new)
    load = Load(table, ledger, uuid.uuid4().hex, files)
    if files:
        _note(spark, ledger, [_row(load, f, None, BEGUN) for f in files])
    return load


def write(spark: SparkSession, load: Load, **options) -> dict[str, int]:
    """Write the new rows as the partition of the load, again if need be; returns the rows each file has."""
    empty = [f[0] for f in load.files if f[2] == 0]
    parts = [f[0] for f in load.files if f[2] > 0]
    counts = {f[1]: 0 for f in load.files if f[0] in empty}
    if not parts:
        return counts
    rows = stored(csv_files.read_parts(spark, parts, **options), "staged")
    file, split, row = csv_files.PROVENANCE
    splits = stored(rows.groupBy(file, split).agg(F.min(row).alias("_first"), F.count("*").alias("_n")), "splits")
    counts |= {f[1]: 0 for f in load.files} | {r[0]: r[1] for r in splits.groupBy(file).agg(F.sum("_n")).collect()}
    short = [f[0] for f in load.files if counts[f[1]] < f[4]]
    if short:
        raise ValueError(f"files have fewer rows than were loaded: {short[:5]}")
    grown = [(f[1], f[4]) for f in load.files if f[4]]
    if grown:
        earlier = Window.partitionBy(file).orderBy(split).rowsBetween(Window.unboundedPreceding, -1)
        before = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        wanted = spark.createDataFrame(grown, f"{file} string, _skip long")
        place = F.col("_before") + F.col(row) - F.col("_first")
        rows = rows.join(before, [file, split]).join(wanted, file, "left").where(place >= F.coalesce("_skip", F.lit(0)))
        rows = rows.drop("_first", "_n", "_before", "_skip")
    rows = rows.drop(*csv_files.PROVENANCE).withColumn(LOAD, F.lit(load.load_id))
    create_table(spark, load.table, rows.schema, [LOAD])
    overwrite_partitions(rows, load.table)
    return counts


def finish(spark: SparkSession, load: Load, counts: dict[str, int]) -> int:
    """Note the load as done; returns its rows."""
    _note(spark, load.ledger, [_row(load, f, counts[f[1]] - f[4], DONE) for f in load.files])
    return sum(counts[f[1]] - f[4] for f in load.files)


def _row(load: Load, f: tuple, rows: int | None, state: str) -> dict:
    _, file, size, modified, first_row = f
    found = {"target": load.table, "file": file, "size": size, "modified": modified, "first_row": first_row, "rows": rows}
    return found | {LOAD: load.load_id, "state": state}


def _note(spark: SparkSession, ledger: str, rows: list[dict]) -> None:
    noted: DataFrame = spark.createDataFrame([tuple(r.get(f.name) for f in _SCHEMA) for r in rows], _SCHEMA)
    append(noted.coalesce(1), ledger)
