"""Warehouse loads: statements, staging, load ids, failed loads."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import constraints as C
from shelfwise.operators.star import build_gold_layers
from shelfwise.plans import layers
from shelfwise.session import scratch_path
from shelfwise.sinks import ddl
from shelfwise.sinks.warehouse import TableWarehouse, load_warehouse


@pytest.fixture(scope="module")
def gold(spark):
    path = scratch_path(spark, "wh-silver")
    layers.silver_lazy(spark, SF_SMALL).write.parquet(path)
    return build_gold_layers(spark.read.parquet(path))


def test_columns_are_those_of_the_gold_tables(gold):
    for table, columns in ddl.COLUMNS.items():
        have = (["sales_id"] if table == "fact_sales" else []) + gold[table].columns
        assert sorted(columns) == sorted(have), table


def run(db, statements):
    db.execute("BEGIN")
    try:
        for text in statements:
            db.execute(text)
        db.execute("COMMIT")
    except Exception:
        db.execute("ROLLBACK")
        raise


def stage(db, load_id, tables):
    for table, columns in ddl.COLUMNS.items():
        names = ", ".join(f"{c} {k}" for c, k in columns.items())
        db.execute(f"CREATE TABLE {ddl.staging('sales', table, load_id)} ({names})")
        for row in tables.get(table, []):
            db.execute(f"INSERT INTO {ddl.staging('sales', table, load_id)} ({', '.join(row)}) VALUES ({', '.join('?' * len(row))})", list(row.values()))


def test_statements_hold_the_keys_and_reload_in_foreign_key_order():
    create, reload = ddl.create_statements("sales"), ddl.reload_statements("sales", "a1")
    fact = next(s for s in create if "sales.fact_sales" in s)
    assert [fact.count(f"FOREIGN KEY ({k}) REFERENCES sales.{d} ({k})") for k, d in ddl.FOREIGN.items()] == [1, 1, 1]
    assert all("PRIMARY KEY" in s for s in create[1:])
    deleted = [s.split(".")[1] for s in reload if s.startswith("DELETE")]
    filled = [s.split(".")[1].split(" ")[0] for s in reload if s.startswith("INSERT")]
    assert deleted == ["fact_sales", "dim_date", "dim_outlet", "dim_item"]
    assert filled == ["dim_item", "dim_outlet", "dim_date", "fact_sales", "loads"]
    with pytest.raises(ValueError):
        ddl.staging("sales", "dim_item", "x; drop")


def test_statements_run_in_a_database_of_this_process():
    db = duckdb.connect()
    run(db, ddl.create_statements("sales"))
    run(db, ddl.create_statements("sales"))
    item = {"item_key": "i", "item_identifier": "P1", "item_type": "T", "item_fat_content": "F"}
    outlet = {"outlet_key": "o", "outlet_identifier": "O", "outlet_location_type": "L", "outlet_size": "S", "outlet_type": "T", "outlet_establishment_year": 1}
    sale = {"sales_id": 1, "item_key": "i", "outlet_key": "o", "date_key": "d", "total_sales": 2.0}
    stage(db, "a1", {"dim_item": [item], "dim_outlet": [outlet], "dim_date": [{"date_key": "d", "event_date": "2024-01-02"}], "fact_sales": [sale]})
    run(db, ddl.reload_statements("sales", "a1"))
    run(db, ddl.drop_statements("sales", "a1"))
    assert db.execute("SELECT total_sales FROM sales.fact_sales").fetchall() == [(2.0,)]
    stage(db, "a2", {"dim_item": [item], "fact_sales": [sale]})  # no outlet and no date: the keys refuse it
    with pytest.raises(duckdb.Error):
        run(db, ddl.reload_statements("sales", "a2"))
    assert db.execute("SELECT count(*) FROM sales.fact_sales").fetchall() == [(1,)]
    assert db.execute("SELECT load_id FROM sales.loads").fetchall() == [("a1",)]


def test_a_load_with_the_same_id_is_run_once(spark, gold):
    wh = TableWarehouse(scratch_path(spark, "wh-ids"))
    load_warehouse(gold, wh, load_id="day1")
    n = wh.read(spark, "fact_sales").count()
    small = {**gold, "fact_sales": gold["fact_sales"].limit(3)}
    checks = load_warehouse(small, wh, load_id="day1")
    assert wh.read(spark, "fact_sales").count() == n and set(checks) == {"primary_keys", "not_null", "foreign_keys"}
    load_warehouse(small, wh, load_id="day2")
    assert wh.read(spark, "fact_sales").count() == 3


def test_a_failed_load_leaves_the_last_one(spark, gold):
    wh = TableWarehouse(scratch_path(spark, "wh-failed"))
    load_warehouse(gold, wh)
    n = wh.read(spark, "dim_item").count()
    bad = {**gold, "dim_item": gold["dim_item"].withColumn("item_key", F.lit("same"))}
    with pytest.raises(ValueError):
        load_warehouse(bad, wh)
    assert wh.read(spark, "dim_item").count() == n


def scans(frame):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def test_each_check_reads_each_table_once(spark, gold):
    wh = TableWarehouse(scratch_path(spark, "wh-scans"))
    load_warehouse(gold, wh)
    tables = {t: wh.read(spark, t) for t in ddl.COLUMNS}
    assert scans(C.check_primary_keys(tables)) == 3
    assert scans(C.check_not_null(tables)) == 4
    assert scans(C.check_foreign_keys(tables)) == 4
