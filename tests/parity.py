"""Runs queries against their SQL and reports differences."""

from __future__ import annotations

import datetime
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, query, sql, sf_dir):
    """None when equal, else a text; and the seconds Spark took."""
    start = time.time()
    frame = query(spark, sf_dir)
    got = frame.collect()
    seconds = time.time() - start
    relation = con.execute(sql)
    expected_names = [d[0] for d in relation.description]
    types = {d[0]: str(d[1]) for d in relation.description}
    expected = relation.fetchall()
    if sorted(frame.columns) != sorted(expected_names):
        return f"columns {sorted(frame.columns)} <> {sorted(expected_names)}", seconds
    wrong = {n: (t, types[n]) for n, t in frame.dtypes if TYPES.get(t) != types[n]}
    if wrong:
        return f"types {wrong}", seconds
    a, b = rows_of(frame.columns, got), rows_of(expected_names, expected)
    if a == b:
        return None, seconds
    only_a = [r for r in a if r not in set(b)][:3] if len(a) < 200_000 else []
    only_b = [r for r in b if r not in set(a)][:3] if len(b) < 200_000 else []
    return f"{len(a)} rows <> {len(b)} rows; only Spark {only_a}; only SQL {only_b}", seconds
