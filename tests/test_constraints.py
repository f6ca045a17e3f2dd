"""Constraint checks catch violations, and the warehouse load refuses them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import constraints as C
from shelfwise.operators.star import build_gold_layers
from shelfwise.plans import layers
from shelfwise.session import scratch_path
from shelfwise.sinks.warehouse import TableWarehouse, load_warehouse


@pytest.fixture(scope="module")
def gold(spark):
    return build_gold_layers(layers.silver_lazy(spark, SF_SMALL))


def test_clean_gold_has_no_violations(gold):
    pk, nn, fk = C.check_primary_keys(gold), C.check_not_null(gold), C.check_foreign_keys(gold)
    assert C.violations(pk, nn, fk).first()["violations"] == 0


def test_violations_are_counted_and_block_the_load(spark, gold):
    bad = dict(gold)
    # A duplicated dimension key, a fact row whose item key is unknown, and a
    # fact row with a null outlet key.
    bad["dim_item"] = gold["dim_item"].unionByName(gold["dim_item"].limit(1))
    broken = gold["fact_sales"].limit(2).withColumn(
        "item_key", F.when(F.col("rating") >= 0, F.lit("no-such-key")))
    nulls = gold["fact_sales"].limit(1).withColumn("outlet_key", F.lit(None).cast("string"))
    bad["fact_sales"] = gold["fact_sales"].unionByName(broken).unionByName(nulls)

    pk = {r.table_name: r for r in C.check_primary_keys(bad).collect()}
    assert pk["dim_item"].duplicate_keys == 1
    fk = {r.foreign_key: r.orphan_rows for r in C.check_foreign_keys(bad).collect()}
    assert fk["item_key"] == 2 and fk["outlet_key"] == 1
    nn = {(r.table_name, r.column_name): r.nulls for r in C.check_not_null(bad).collect()}
    assert nn[("fact_sales", "outlet_key")] == 1

    with pytest.raises(ValueError, match="constraints violated"):
        load_warehouse(bad, TableWarehouse(scratch_path(spark, "bad-warehouse")))
