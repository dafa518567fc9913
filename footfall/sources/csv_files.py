"""Bulk load of CSV files into tables."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from fnmatch import fnmatch
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_ROW = "_corrupt_record"
#: File, first byte of the split, and number of the row in the scan.
PROVENANCE = ("_file", "_split", "_row")
SCHEME = "^[a-zA-Z0-9]+:(//[^/]*)?"


def clean_name(name: str) -> str:
    return re.sub(r"[ .\-]", "_", name)


def clean_names(df: DataFrame) -> DataFrame:
    """Blank, dash and dot in column names become an underscore."""
    names = [clean_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names clash after cleaning: {twice}")
    return df.toDF(*names)


def read_csv(
    spark: SparkSession,
    path: str,
    stringify_floats: bool = False,
    sampling_ratio: float = 1.0,
    schema: T.StructType | None = None,
    keep_bad_rows: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV file, or a folder of parts, with a header row.

    Types are inferred from ``sampling_ratio`` of the rows, unless ``schema``
    (over the raw header names) is given, and then mapped: whole numbers to long, booleans to
    0 / 1, dates and times kept, fractions to double (or text), everything else
    to text. Missing text becomes an empty string, missing numbers stay null.

    Parts are matched by their headers: one with another order of columns is read
    by name, one with other columns is an error. Headers and types of all parts are
    found in one aggregation, however many parts there are.

    A row that does not fit fails the read; with ``keep_bad_rows`` it is kept, with
    what could be read of it, and its text is in ``_corrupt_record``. Files with line
    breaks inside quotes need ``multi_line``, which reads each file in one task, and
    the header of each file in a job of its own.
    """
    found = read_parts(spark, _files(spark, path), stringify_floats, sampling_ratio, schema, keep_bad_rows, multi_line)
    return found.drop(*PROVENANCE)


def read_parts(
    spark: SparkSession,
    parts: Sequence[str],
    stringify_floats: bool = False,
    sampling_ratio: float = 1.0,
    schema: T.StructType | None = None,
    keep_bad_rows: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """The rows of some files as ``read_csv`` gives them, each with its file, split and number in the scan.

    Numbers grow along a split. They hold for one run of the scan: store the rows
    before using them twice.
    """
    if multi_line:
        orders, inferred = _orders_by_part(spark, parts, sampling_ratio, schema)
    else:
        orders, inferred = _orders_in_one_pass(spark, parts, sampling_ratio)
    if not orders:
        raise ValueError(f"no CSV with a header among {list(parts)[:3]}")
    first = next(iter(orders))
    for other, some in orders.items():
        if sorted(other) != sorted(first):
            raise ValueError(f"{some[0]} has the columns {list(other)}, other parts have {list(first)}")
    schema = schema or inferred
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    # Headers are matched already; Spark cannot check one without a name.
    reader = reader.option("enforceSchema", any(re.fullmatch(r"_c\d+", c) for c in first))
    if keep_bad_rows:
        reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
    else:
        reader = reader.option("mode", "FAILFAST")
    extra = [T.StructField(BAD_ROW, T.StringType())] if keep_bad_rows else []
    frames = [
        _with_origin(reader.schema(T.StructType([*(schema[c] for c in header), *extra])).csv(some))
        for header, some in orders.items()
    ]
    raw = clean_names(reduce(DataFrame.unionByName, frames))
    return raw.select(
        *[
            F.col(f.name) if f.name in (BAD_ROW, *PROVENANCE) else _mapped(f, stringify_floats).alias(f.name)
            for f in raw.schema.fields
        ]
    )


def _with_origin(rows: DataFrame) -> DataFrame:
    """Add ``PROVENANCE``. Spark gives the file as a URL, in which a plus sign is itself."""
    url = F.col("_metadata.file_path")
    file = bare_path(F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))))
    values = (file, F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return rows.select("*", *(value.alias(name) for name, value in zip(PROVENANCE, values)))


def bare_path(path):
    """Without scheme and host, which Spark writes in several ways."""
    return F.regexp_replace(path, SCHEME, "")


# What a cell can be read as; the kinds of several cells are those of each, as bits.
WHOLE, FRACTION, DAY, TIME, TRUTH, TEXT = (1 << i for i in range(6))


def _kind(cell: Column) -> Column:
    """The kind of a cell; 0 says nothing, as a missing value."""
    day = r"\d{4}-\d{2}-\d{2}"
    return (
        F.when(cell.isNull() | (cell == ""), 0)
        .when(cell.rlike(r"^[+-]?\d{1,19}$") & cell.try_cast("long").isNotNull(), WHOLE)
        .when(cell.rlike(r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|-?Inf)$"), FRACTION)
        .when(cell.rlike(f"^{day}$") & cell.try_cast("date").isNotNull(), DAY)
        .when(cell.rlike(rf"^{day}[T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?(Z|[+-]\d{{2}}:?\d{{2}})?$") & cell.try_cast("timestamp").isNotNull(), TIME)
        .when(F.lower(cell).isin("true", "false"), TRUTH)
        .otherwise(TEXT)
    )


def _type(kinds: int) -> T.DataType:
    """The type that holds cells of all these kinds."""
    known = {
        WHOLE: T.LongType(), FRACTION: T.DoubleType(), WHOLE | FRACTION: T.DoubleType(), DAY: T.DateType(),
        TIME: T.TimestampType(), DAY | TIME: T.TimestampType(), TRUTH: T.BooleanType(),
    }
    return known.get(kinds, T.StringType())


def _orders_in_one_pass(
    spark: SparkSession, parts: Sequence[str], sampling_ratio: float
) -> tuple[dict[tuple[str, ...], list[str]], T.StructType | None]:
    """Files by the order of their columns, and the types of all, from one aggregation of lines by file.

    Which lines are headers is known from any one: they have its names in some order.
    """
    lines = spark.read.text(list(parts)).where(F.trim("value") != "")
    # The first line of any file names all columns.
    some = lines.where("_metadata.file_block_start = 0").first()
    if some is None:
        return {}, None
    names = [c or f"_c{i}" for i, c in enumerate(next(csv.reader([some.value])))]
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
    rows = lines.select(
        "value", F.col("_metadata.file_path").alias("_url"), F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_id"), F.from_csv("value", F.lit(cells.simpleString()[7:-1].replace(":", " "))).alias("_c"),
    )
    every = [F.col(f"_c.c{i}") for i in range(len(names))]
    named = [F.coalesce(cell, F.lit(f"_c{i}")) for i, cell in enumerate(every)]
    header = F.array_sort(F.array(*named)) == F.array_sort(F.array(*map(F.lit, names)))
    rows = rows.withColumn("_header", F.coalesce(header, F.lit(False)))
    counted = ~F.col("_header") if sampling_ratio >= 1 else ~F.col("_header") & (F.rand(0) < sampling_ratio)
    masks = [F.bit_or(F.when(counted, _kind(cell))).alias(f"_k{i}") for i, cell in enumerate(every)]
    first = F.min_by(F.when(F.col("_at") == 0, F.col("_c")), F.when(F.col("_at") == 0, F.col("_id")))
    files = rows.groupBy("_url").agg(first.alias("_first"), F.count(F.when(F.col("_header"), 1)).alias("_headers"), *masks)
    found: dict[tuple[str, ...], list[str]] = {}
    kinds = dict.fromkeys(names, 0)
    for r in files.collect():  # a row a file, as the reader is given the files by name
        cells_of = list(r._first or [])
        order = tuple(c or f"_c{i}" for i, c in enumerate(cells_of) if c is not None or i < len(names))
        found.setdefault(order, []).append(r._url)
        if sorted(order) == sorted(names):
            for i, name in enumerate(order):
                # A header in the midst of a file is a row of text.
                kinds[name] |= (r[f"_k{i}"] or 0) | (TEXT if r._headers > 1 else 0)
    by_name = {re.sub(SCHEME, "", p): p for p in parts}
    part = lambda url: by_name[unquote(re.sub(SCHEME, "", url))]
    found = {order: sorted(map(part, urls)) for order, urls in sorted(found.items(), key=lambda x: min(x[1]))}
    given = next((order for order in found if sorted(order) == sorted(names)), None)
    return found, given and T.StructType([T.StructField(c, _type(kinds[c])) for c in given])


def _widest(kinds: list[T.DataType]) -> T.DataType:
    """The type that holds all of ``kinds``, which parts of a file were inferred to have."""
    known = [k for k in kinds if not isinstance(k, T.NullType)]
    if len(set(known)) <= 1:
        return known[0] if known else T.StringType()
    for family, wide in (((T.IntegralType,), T.LongType()), ((T.IntegralType, T.DoubleType), T.DoubleType())):
        if all(isinstance(k, family) for k in known):
            return wide
    return T.StringType()


def _orders_by_part(
    spark: SparkSession, parts: Sequence[str], sampling_ratio: float, schema: T.StructType | None
) -> tuple[dict[tuple[str, ...], list[str]], T.StructType | None]:
    """The same with line breaks inside quotes, a job a file and a scan an order."""
    lines = spark.read.option("header", True).option("multiLine", True)
    orders: dict[tuple[str, ...], list[str]] = {}
    for part in parts:
        header = tuple(lines.csv(part).columns)
        if header:  # an empty file has none
            orders.setdefault(header, []).append(part)
    if schema is not None or not orders:
        return orders, schema
    inferring = lines.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    found = [inferring.csv(some).schema for some in orders.values()]
    first = next(iter(orders))
    if any(sorted(other) != sorted(first) for other in orders):
        return orders, None
    return orders, T.StructType([T.StructField(c, _widest([f[c].dataType for f in found])) for c in first])


def _mapped(field: T.StructField, stringify_floats: bool):
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column.cast("string" if stringify_floats else "double")
    if isinstance(kind, T.DateType):
        return column
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("timestamp_ntz")
    return F.coalesce(column.cast("string"), F.lit(""))


def _files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files at ``path``: itself, or those of a folder and its subfolders."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return sorted(r.path for r in found.collect())


def list_csv(spark: SparkSession, folder: str, skip: Sequence[str] = ()) -> list[str]:
    """Names of the entries of a folder: files of any name, and ``.csv`` folders of parts.

    Entries that match a pattern of ``skip`` are left out; another subfolder is an
    error. Names that start with a dot or an underscore are hidden, as elsewhere in Spark.
    """
    root = re.sub(SCHEME, "", folder).rstrip("/")
    names = set()
    for path in _files(spark, folder):
        entry, _, below = re.sub(SCHEME, "", path)[len(root) + 1 :].partition("/")
        if any(fnmatch(entry, pattern) for pattern in skip):
            continue
        if below and not entry.lower().endswith(".csv"):
            raise ValueError(f"{folder} has a subfolder {entry!r}; name it in skip to leave it out")
        names.add(entry)
    return sorted(names)


def table_name(entry: str) -> str:
    """``Past orders.CSV`` gives ``Past_orders``; another extension stays in the name."""
    return re.sub(r"\W", "_", re.sub(r"\.csv$", "", entry, flags=re.IGNORECASE))


def load_csv_folder(
    spark: SparkSession,
    folder: str,
    database: str = "default",
    skip: Sequence[str] = (),
    **options,
) -> list[str]:
    """Append every CSV file of a folder to the table named after it.

    Returns the table names. Two entries that would go to one table are an error,
    before anything is loaded. Each load is one distributed read and write;
    ``options`` are those of ``read_csv``. No row is skipped.
    """
    loaded = []
    for entry, name in table_names(spark, folder, skip).items():
        table = f"{database}.{name}"
        rows = read_csv(spark, f"{folder.rstrip('/')}/{entry}", **options)
        rows.write.mode("append").saveAsTable(table)
        loaded.append(table)
    return loaded


def table_names(spark: SparkSession, folder: str, skip: Sequence[str] = ()) -> dict[str, str]:
    """Entries of a folder with the names of their tables, which have to differ."""
    entries = list_csv(spark, folder, skip)
    names = [table_name(e) for e in entries]
    lowered = [n.lower() for n in names]
    twice = [e for e, n in zip(entries, lowered) if lowered.count(n) > 1]
    if twice:
        raise ValueError(f"several entries make one table name: {twice}")
    return dict(zip(entries, names))
