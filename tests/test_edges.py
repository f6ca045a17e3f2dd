"""Edge cases of FIXTURES.md §4, each on a small frame built in the test."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import dashboard as dash
from shelfwise.operators import star
from shelfwise.operators.clean import clean_frame, impute_weight, with_event_date
from shelfwise.schemas import RAW_SCHEMA
from shelfwise.sources import messages

def raw_row(fat="Low Fat", item="FDA15", typ="Dairy", year=1999, outlet="OUT049", loc="Tier 1",
            size="Medium", otype="Supermarket Type1", vis=0.016, weight=9.3, sales=3735.14, rating=5.0):
    return (fat, item, typ, year, outlet, loc, size, otype, vis, weight, sales, rating)


def silver_rows(spark, rows):
    import datetime as dt

    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    data = [(*r, ts, f"r{i}") for i, r in enumerate(rows)]
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField("ingest_ts", T.TimestampType()),
                                               T.StructField("record_id", T.StringType())])
    return clean_frame(spark.createDataFrame(data, schema))


def test_label_canonicalisation(spark):
    rows = [raw_row(fat=f) for f in ("\tlf", None, " LF ", "reg", "Regular", "  Non Edible ")]
    got = [r.item_fat_content for r in silver_rows(spark, rows).collect()]
    assert got == ["lf", None, "Low Fat", "Regular", "Regular", "non edible"]


def test_json_edge_values(spark):
    payloads = [
        '{"Item Identifier": "A", "Item Weight": ""}',
        '{"Item Identifier": "B", "Item Weight": "3.5"}',
        '{"Item Identifier": "C", "Item Weight": 4.5}',
        'this is not json',
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    decoded = messages.decode(df).collect()
    weights = {r["Item Identifier"]: r["Item Weight"] for r in decoded if r["Item Identifier"]}
    assert weights == {"A": None, "B": None, "C": 4.5}
    assert messages.rejects(messages.decode(df)).count() == 1
    assert messages.decode(df, keep_rejects=False).count() == 3


def test_all_weights_null_stay_null(spark):
    rows = [raw_row(weight=None) for _ in range(4)]
    out = impute_weight(silver_rows(spark, rows), mode="approx").collect()
    assert [r.item_weight for r in out] == [None] * 4


def test_impute_fills_with_median(spark):
    rows = [raw_row(weight=w) for w in (1.0, 2.0, 10.0, None)]
    exact = [r.item_weight for r in impute_weight(silver_rows(spark, rows), mode="exact").collect()]
    assert exact == [1.0, 2.0, 10.0, 2.0]


def test_filter_matching_nothing(spark):
    s = silver_rows(spark, [raw_row(), raw_row(sales=10.0)])
    empty = dash.apply_filters(s, item_type=["no such type"])
    m = dash.headline_metrics(empty).first()
    assert (m.total_records, m.avg_sales, m.total_sales, m.avg_rating) == (0, 0.0, 0.0, 0.0)
    assert dash.histogram(empty).count() == 0
    assert dash.chart_rollup(empty).count() == 0


@pytest.mark.parametrize("value,start,end", [(5.0, 4.9995, 5.0), (0.0, -0.0001, 0.0)])
def test_constant_histogram(spark, value, start, end):
    s = silver_rows(spark, [raw_row(sales=value), raw_row(sales=value)])
    rows = dash.histogram(s).collect()
    assert len(rows) == 20
    tenth = rows[9]
    assert tenth["count"] == 2 and sum(r["count"] for r in rows) == 2
    assert tenth.bin_start == pytest.approx(start) and tenth.bin_end == pytest.approx(end)


def test_histogram_right_closed(spark):
    # Bins over [0, 10]: 2.5 lies on an edge → the lower (right-closed) bin.
    s = silver_rows(spark, [raw_row(sales=v) for v in (0.0, 2.5, 10.0)])
    rows = {r.bin: r["count"] for r in dash.histogram(s).collect()}
    assert rows[1] == 1 and rows[5] == 1 and rows[6] == 0 and rows[20] == 1


def test_null_keys_and_null_measures(spark):
    s = silver_rows(spark, [raw_row(typ=None), raw_row(typ="X", sales=None), raw_row(typ="X", sales=None)])
    got = {r.item_type: r for r in dash.chart(s, "sales_by_item_type").collect()}
    assert set(got) == {"X"}
    assert got["X"].total_sales == 0.0 and got["X"].avg_sales is None and got["X"]["count"] == 0


def test_half_even_rounding(spark):
    s = silver_rows(spark, [raw_row(sales=0.125, item="a"), raw_row(sales=0.375, item="b")])
    rows = dash.sample_rows(s, limit=10).orderBy("item_identifier").collect()
    assert [r.total_sales for r in rows] == [0.12, 0.38]


@pytest.mark.parametrize("limit,expected", [(0, 1), (500, 100), (7, 7)])
def test_limit_clamp(limit, expected):
    assert dash.clamp_limit(limit) == expected


def test_null_natural_key_modes(spark):
    rows = [raw_row(size=None, item=f"I{i}") for i in range(3)]
    g = with_event_date(silver_rows(spark, rows))
    joined = star.fact_sales(g, mode="join")
    inline = star.fact_sales(g, mode="inline")
    dim = star.dim_outlet(g)
    assert joined.where(F.col("outlet_key").isNull()).count() == 3
    assert inline.where(F.col("outlet_key").isNull()).count() == 0
    assert inline.join(dim, "outlet_key", "left_anti").count() == 0
    safe = star.fact_sales(g, mode="join", null_safe=True)
    assert safe.where(F.col("outlet_key").isNull()).count() == 0
    assert safe.exceptAll(inline).count() == 0 and inline.exceptAll(safe).count() == 0


def test_null_token_separates_keys(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    from shelfwise.functions.columns import surrogate_key

    plain = {r.k for r in df.select(surrogate_key(F.col("x"), F.col("y"), F.col("z")).alias("k")).collect()}
    tokened = {r.k for r in df.select(surrogate_key(F.col("x"), F.col("y"), F.col("z"),
                                                    null_token="\u0000").alias("k")).collect()}
    assert len(plain) == 1 and len(tokened) == 2


def test_sized_broadcast_checks_rows(spark):
    from shelfwise.operators.joins import has_at_most

    df = spark.range(100)
    assert has_at_most(df, 100) and not has_at_most(df, 99)


def test_fill_empty_serves_text(spark):
    from shelfwise.sources.files import fill_empty, page

    df = spark.createDataFrame([("A", None, 1.5), (None, 2, None)], "a string, b int, c double")
    rows = fill_empty(page(df, 0, 10, order_by="c")).collect()
    assert [tuple(r) for r in rows] == [("", "2", ""), ("A", "", "1.5")]


def test_paging_bounds(spark):
    from shelfwise.sources.files import clamp_page, page

    assert clamp_page(0) == 1 and clamp_page(5000) == 1000 and clamp_page(10) == 10
    with pytest.raises(ValueError):
        page(spark.range(3), offset=-1, order_by="id")
    assert [r.id for r in page(spark.range(10), offset=8, limit=5, order_by="id").collect()] == [8, 9]


def test_lookup_counts_matches(spark):
    from shelfwise.sources.files import lookup

    df = spark.createDataFrame([("A",), ("B",), ("A",)], "`Item Identifier` string")
    rows = lookup(df, "A").collect()
    assert len(rows) == 2 and {r.match_count for r in rows} == {2}
    assert lookup(df, "Z").count() == 0


def test_message_key_falls_back_to_unknown(spark):
    df = spark.createDataFrame([(None, 1.0), ("P1", 2.0)], "`Item Identifier` string, `Total Sales` double")
    keys = sorted(r.key for r in messages.encode(df).collect())
    assert keys == ["P1", "unknown"]
    back = messages.decode(messages.encode(df)).orderBy("Total Sales").collect()
    assert back[0]["Item Identifier"] is None and back[1]["Item Identifier"] == "P1"


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    from shelfwise.session import ensure_checkpoint_dir, scratch_path

    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/shelfwise/")
