"""Comparison of a query with its SQL: rows as a multiset, columns by name."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.001"


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    if isinstance(value, dict) or hasattr(value, "asDict"):
        items = value.asDict() if hasattr(value, "asDict") else value
        return tuple(sorted((k, normal(v)) for k, v in items.items()))
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(normal(row[c]) for c in names) for row in df.collect())


def sql_rows(sql: str, sf_dir: str = SF_DIR) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in found.fetchall())


def assert_same(df, sql: str, sf_dir: str = SF_DIR) -> None:
    names, rows = spark_rows(df)
    sql_names, wanted = sql_rows(sql, sf_dir)
    assert names == sql_names
    assert rows == wanted, f"only in Spark {list((rows - wanted).items())[:5]}, only in SQL {list((wanted - rows).items())[:5]}"
