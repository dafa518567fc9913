"""Compare a Spark result with the same query in DuckDB, as sorted rows."""

import decimal
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
}


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return names, types, rows


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def assert_same(df, con, sql):
    names, types, rows = duck_rows(con, sql)
    assert sorted(df.columns) == sorted(names)
    for field in df.schema.fields:
        expected = DUCK_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString().upper())
        assert types[field.name] == expected, (field.name, types[field.name], expected)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    theirs = canonical(names, rows)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not different, different[:3]
    return len(ours)
