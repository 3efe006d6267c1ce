"""Runs a registered query and its oracle SQL over the same tables."""

import duckdb

SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connection(sf_dir):
    con = duckdb.connect()
    for name in ("customer", "nation", "events"):
        con.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def assert_same(df, con, sql):
    names = sorted(df.columns)
    expected = con.execute(sql)
    types = {d[0]: str(d[1]) for d in expected.description}
    place = [list(types).index(n) for n in names if n in types]
    assert names == sorted(types)
    assert {n: SQL_TYPES[t] for n, t in df.dtypes} == types
    left = ordered(tuple(row[n] for n in names) for row in df.collect())
    right = ordered(tuple(row[i] for i in place) for row in expected.fetchall())
    assert left == right
