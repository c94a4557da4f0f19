"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import differences, oracle

from cabflow.queries import load

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = oracle(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(load()))
def test_query(spark, con, name):
    assert differences(spark, con, FOLDER, name) is None


def test_every_query_has_sql():
    assert [name for name, query in load().items() if query.sql is None] == []


def test_comparison_notices_a_changed_value(spark, con, monkeypatch):
    from dataclasses import replace

    from cabflow.queries.base import QUERIES

    query = QUERIES["a13_orders_per_user"]
    changed = replace(query, sql=query.sql.replace("count(*)", "count(*) + 1"))
    monkeypatch.setitem(QUERIES, "a13_orders_per_user", changed)
    assert "rows differ" in differences(spark, con, FOLDER, "a13_orders_per_user")


def test_observed_rows_are_all_there(spark):
    from cabflow.queries.base import Tables

    tables = Tables(spark, FOLDER)
    got = load()["a11_observed"].build(tables)
    assert got.count() == tables.orders.count() > 1
    assert [r.rows for r in got.select("rows").distinct().collect()] == [tables.orders.count()]


def test_orders_of_the_stream_are_computed_once(spark, monkeypatch):
    """Each turn of the stream reads them from where they were written by turn."""
    from cabflow.queries import groups
    from cabflow.queries.base import Tables

    written = []
    write = groups.write_dealt
    monkeypatch.setattr(groups, "write_dealt", lambda df, path, by: (written.append(by), write(df, path, by)))
    assert load()["a7_supply_demand_stream"].build(Tables(spark, FOLDER)).count() > 0
    assert written == [["_turn"]]
