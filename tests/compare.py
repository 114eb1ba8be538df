"""Run queries against their SQL: same columns, same rows in any order."""

from __future__ import annotations

import math
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> dict:
    start = time.time()
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark_seconds = time.time() - start
    start = time.time()
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    types = {d[0]: str(d[1]) for d in relation.description}
    want = rows_of(columns, relation.fetchall())
    problems = []
    if sorted(df.columns) != sorted(columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, data_type in df.dtypes:
        if names.get(data_type) != types.get(name):
            problems.append(f"type of {name}: {data_type} != {types.get(name)}")
    if got != want:
        missing, extra = list((want - got).items()), list((got - want).items())
        problems.append(f"{sum(want.values())} rows wanted, {sum(got.values())} got")
        problems.append(f"missing {len(missing)}: {missing[:3]}; extra {len(extra)}: {extra[:3]}")
    return {
        "rows": sum(got.values()),
        "spark_seconds": round(spark_seconds, 2),
        "sql_seconds": round(time.time() - start, 2),
        "problems": problems,
    }
