"""Compare a Spark result with DuckDB's, order-insensitively and exactly."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(df, con, sql):
    """None if equal, else a short text."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
             "TINYINT": "tinyint"}
    wrong = {c: (t, types[c]) for c, t in df.dtypes if names.get(types[c]) != t}
    if wrong:
        return f"types {wrong}"
    spark_rows = rows_of(df.columns, df.collect())
    duck_rows = rows_of(relation.columns, relation.fetchall())
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
