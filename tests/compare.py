"""Compare a Spark result with a DuckDB one: column names, types, and rows in any order."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(columns)
    for name, kind in df.dtypes:
        assert TYPES[kind] == kinds[name], f"{name}: {kind} against {kinds[name]}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(columns, result.fetchall())
    assert len(ours) == len(theirs)
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not differing, f"{len(differing)} of {len(ours)} rows differ, first {differing[0]}"
    return len(ours)
