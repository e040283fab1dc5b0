"""Every registered query of the library over the smallest tables, against its SQL in DuckDB."""

from pathlib import Path

import duckdb
import pytest

from ordermill.registry import all_queries, all_sql

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(FOLDER.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def as_text(columns, records):
    """Rows as sorted text over name-sorted columns; value types are part of the text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([record[i] for i in order]) for record in records)


def test_every_query_has_sql():
    assert sorted(all_queries()) == sorted(all_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_its_sql(spark, duck, name):
    frame = all_queries()[name](spark, str(FOLDER))
    got = as_text(frame.columns, [tuple(row) for row in frame.collect()])
    result = duck.execute(all_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert got == as_text(columns, result.fetchall())


def test_every_rule_fires(spark):
    counts = all_queries()["dq_every_rule"](spark, str(FOLDER)).collect()
    assert len(counts) == 34 and all(row["failed_records"] for row in counts)


def test_gate_is_passed_and_stops(spark):
    passed = all_queries()["run_gate_passed"](spark, str(FOLDER)).collect()
    assert {r["status"] for r in passed if r["kind"] == "audit"} == {"SUCCESS"}
    assert sum(r["records_rejected"] or 0 for r in passed if r["name"] == "validation") > 0
    stopped = all_queries()["run_gate_stopped"](spark, str(FOLDER)).collect()
    failed = {(r["name"], r["dataset"]) for r in stopped if r["status"] == "FAILED"}
    assert failed == {("validation", "payments"), ("validation", "_pipeline"), ("pipeline", "_pipeline")}


def test_history_holds_raw_orders(spark, duck):
    """Damaged dates too: an order without a readable one is read with the first year's."""
    rows = {r["year"]: r["orders"] for r in all_queries()["src_history_before"](spark, str(FOLDER)).collect()}
    undated, dated = duck.execute(
        """SELECT COUNT(*) FILTER (WHERE unread), COUNT(*) FILTER (WHERE NOT unread AND year(o_orderdate) < 1999)
           FROM (SELECT *, o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' AS unread FROM orders)"""
    ).fetchone()
    assert undated and rows.pop(None) == undated
    assert sum(rows.values()) == dated and max(rows) == 1998


def test_larger_tables_give_more_files_of_a_drop(spark, duck, monkeypatch):
    """No task of ``src_counts`` writes or reads a fixed share of a table."""
    from ordermill.registry import running

    rows, files, write = {}, {}, running.trade_drops.write_drop

    def spy(records, root, name, *rest):
        write(records, root, name, *rest)
        drop = running.Lake(spark, root).names(running.layout.drop(name, "historical", running.FIRST))
        files[name] = sum(part.startswith("part-") for part in drop)

    monkeypatch.setattr(running, "FILE_RECORDS", 500)
    monkeypatch.setattr(running.trade_drops, "write_drop", spy)
    all_queries()["src_counts"](spark, str(FOLDER)).collect()
    for name, table in (("customers", "customer"), ("orders", "orders"), ("payments", "lineitem")):
        rows[name] = duck.execute(f"SELECT COUNT(*) FROM {table}").fetchone()[0]
        assert files[name] == max(3, rows[name] // 500)
    assert files["payments"] > 3
