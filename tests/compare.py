"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math

import duckdb

from cabflow.queries import load
from cabflow.queries.base import Tables

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(table, names):
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def differences(spark, con, folder: str, name: str) -> str | None:
    """None if the rows and types are equal, else what is not."""
    query = load()[name]
    got = query.build(Tables(spark, folder)).toArrow()
    if query.sql is None:
        return None if got.num_rows else "no rows"
    want = con.sql(query.sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    names = sorted(got.column_names)
    types = [
        (n, str(got.schema.field(n).type), str(want.schema.field(n).type))
        for n in names
        if str(got.schema.field(n).type) != str(want.schema.field(n).type)
    ]
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}; types {types}"
    mine, theirs = _rows(got, names), _rows(want, names)
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ in {names}: {bad[:3]}; types {types}"
    if types:
        return f"types {types}"
    return None if mine else "no rows"
