"""Every registered query against its SQL counterpart on the given tables."""

import datetime as dt
import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from oracle import feeds as fixture

# the text operators have tests of their own
TEXT = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry_module.queries().items() if not TEXT.match(n)}
SQL = {n: q for n, q in entry_module.oracle_sql().items() if not TEXT.match(n)}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_checks_find_something(spark, tables):
    def total(name, column):
        return QUERIES[name](spark, tables).agg({column: "sum"}).first()[0]

    assert total("q_enum_violations", "violations") > 0
    assert total("x_order_total_check", "differing") > 0
    assert total("x_order_total_check", "without_items") > 0
    assert total("x_eta_accuracy", "unresolved") > 0
    found = QUERIES["q_impossible_durations"](spark, tables).collect()
    assert found and not [r for r in found if 30 <= r.seconds <= 60 and r.to_status == "ACCEPTED"]
    late = QUERIES["stream_late_rows"](spark, tables).collect()
    assert sum(r.events_lost for r in late) > 0 and all(r.as_dropped for r in late)
    gaps = QUERIES["q_lifecycle_gaps"](spark, tables)
    kinds = {(r.gap, r.after_end) for r in gaps.select("gap", "after_end").distinct().collect()}
    assert {("SKIPPED_STEP", False), ("STEP_BACK", False), ("REPEATED", False), ("ILLEGAL", True)} <= kinds
    pivot = QUERIES["dash_ratio_pivot"](spark, tables)
    assert pivot.where("other_zones IS NOT NULL").count() > 0


def test_vanished_couriers_are_no_violation(spark, tables):
    feed = fixture.order_feed(spark, tables)
    left = feed.where("previous_status = 'PICKED_UP' AND order_status = 'CANCELLED'")
    assert left.count() > 0
    found = QUERIES["q_impossible_durations"](spark, tables)
    assert found.where("from_status = 'PICKED_UP' AND to_status = 'CANCELLED'").count() == 0


@pytest.fixture(scope="module")
def duck(tables):
    con = duckdb.connect()
    for path in glob.glob(f"{tables}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, tables, duck, name):
    frame = QUERIES[name](spark, tables)
    columns = sorted(frame.columns)
    found = [tuple(plain(row[c]) for c in columns) for row in frame.collect()]
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    where = [relation.columns.index(c) for c in columns]
    expected = [tuple(plain(row[i]) for i in where) for row in relation.fetchall()]
    assert ordered(found) == ordered(expected)


def test_feeds_grow_with_the_tables(spark):
    def sizes(tables):
        orders, couriers = fixture.order_feed(spark, tables), fixture.courier_feed(spark, tables)
        minutes = orders.selectExpr("date_trunc('minute', event_timestamp) AS m").distinct()
        return (
            minutes.count(),
            orders.select("restaurant_id").distinct().count(),
            couriers.select("courier_id").distinct().count(),
            couriers.select("session_id").distinct().count(),
        )

    folders = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
    if not all(os.path.exists(f"{f}/orders.parquet") for f in folders):
        pytest.skip("needs two sizes of the tables")
    small, large = map(sizes, folders)
    assert all(b > 2 * a for a, b in zip(small, large))


def test_entry_returns_rows(spark, tables):
    frame = entry_module.entry(spark)
    assert frame.columns[:3] == ["window_start", "window_end", "window_date"]
    assert frame.count() > 0
