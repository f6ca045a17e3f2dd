"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The tables ``lineitem part supplier nation …`` are views in DuckDB. Every
statement starts from the same CTE chain that mirrors the Spark side:
``raw`` (fixture mapping, FIXTURES.md §2) → ``clean`` → ``silver``
(exact-median weight imputation) → ``gold`` (+ event_date). Numbers that
are sums of floats are rounded half-even to 2 decimals on both sides.
"""

from __future__ import annotations

RAW = r"""
raw AS (
  SELECT
    CASE WHEN l.l_partkey % 10 = 9 THEN 'Non Edible'
         WHEN l.l_partkey % 2 = 0 THEN
           CASE l.l_linenumber % 4 WHEN 0 THEN 'LF' WHEN 1 THEN 'low fat'
                                   WHEN 2 THEN ' Low Fat ' ELSE 'Low Fat' END
         ELSE CASE l.l_linenumber % 3 WHEN 0 THEN 'reg' WHEN 1 THEN 'Regular'
                                      ELSE ' regular' END
    END AS "Item Fat Content",
    'P' || CAST(l.l_partkey AS VARCHAR) AS "Item Identifier",
    p.p_type AS "Item Type",
    CAST(1985 + l.l_suppkey % 25 AS INTEGER) AS "Outlet Establishment Year",
    s.s_name AS "Outlet Identifier",
    'Tier ' || CAST(n.n_regionkey % 3 + 1 AS VARCHAR) AS "Outlet Location Type",
    CASE l.l_suppkey % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' ELSE 'High' END AS "Outlet Size",
    CASE n.n_nationkey % 4 WHEN 0 THEN 'Grocery Store' WHEN 1 THEN 'Supermarket Type1'
         WHEN 2 THEN 'Supermarket Type2' ELSE 'Supermarket Type3' END AS "Outlet Type",
    CAST(l.l_discount AS DOUBLE) AS "Item Visibility",
    CASE WHEN l.l_orderkey % 6 = 0 THEN NULL ELSE CAST(l.l_quantity AS DOUBLE) END AS "Item Weight",
    CAST(l.l_extendedprice AS DOUBLE) AS "Total Sales",
    CAST(1.0 + 0.5 * (l.l_linenumber % 9) AS DOUBLE) AS "Rating",
    l.l_shipdate AS ingest_ts,
    concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
              strftime(l.l_shipdate, '%Y%m%d')) AS record_id
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

FAT = """CASE WHEN lower(trim({c})) IN ('lf', 'low fat') THEN 'Low Fat'
         WHEN lower(trim({c})) IN ('regular', 'reg') THEN 'Regular'
         ELSE regexp_replace(lower(trim({c})), '^\\s+|\\s+$', '', 'g') END"""

CLEAN = """
clean AS (
  SELECT
    """ + FAT.format(c='"Item Fat Content"') + """ AS item_fat_content,
    trim("Item Identifier") AS item_identifier,
    trim("Item Type") AS item_type,
    TRY_CAST("Outlet Establishment Year" AS INTEGER) AS outlet_establishment_year,
    trim("Outlet Identifier") AS outlet_identifier,
    trim("Outlet Location Type") AS outlet_location_type,
    trim("Outlet Size") AS outlet_size,
    trim("Outlet Type") AS outlet_type,
    TRY_CAST("Item Visibility" AS DOUBLE) AS item_visibility,
    TRY_CAST("Item Weight" AS DOUBLE) AS item_weight,
    TRY_CAST("Total Sales" AS DOUBLE) AS total_sales,
    TRY_CAST("Rating" AS DOUBLE) AS rating,
    ingest_ts, record_id
  FROM raw
)"""

SILVER = """
silver AS (
  SELECT item_fat_content, item_identifier, item_type, outlet_establishment_year,
         outlet_identifier, outlet_location_type, outlet_size, outlet_type, item_visibility,
         coalesce(item_weight, (SELECT median(item_weight) FROM clean)) AS item_weight,
         total_sales, rating, ingest_ts, record_id
  FROM clean
)"""

GOLD = """
gold AS (SELECT *, CAST(ingest_ts AS DATE) AS event_date FROM silver)"""

ITEM_KEY = "sha256(concat_ws('||', item_identifier, item_type, item_fat_content))"
OUTLET_KEY = ("sha256(concat_ws('||', outlet_identifier, outlet_location_type, outlet_size, "
              "outlet_type, CAST(outlet_establishment_year AS VARCHAR)))")
DATE_KEY = "sha256(concat_ws('||', CAST(event_date AS VARCHAR)))"

DIMS = f"""
dim_item AS (SELECT *, {ITEM_KEY} AS item_key
             FROM (SELECT DISTINCT item_identifier, item_type, item_fat_content FROM gold)),
dim_outlet AS (SELECT *, {OUTLET_KEY} AS outlet_key
               FROM (SELECT DISTINCT outlet_identifier, outlet_location_type, outlet_size,
                            outlet_type, outlet_establishment_year FROM gold)),
dim_date AS (SELECT *, {DATE_KEY} AS date_key FROM (SELECT DISTINCT event_date FROM gold)),
fact AS (SELECT {ITEM_KEY} AS item_key, {OUTLET_KEY} AS outlet_key, {DATE_KEY} AS date_key,
                item_visibility, item_weight, total_sales, rating, ingest_ts FROM gold)"""


def with_ctes(body: str, *, silver: bool = True, gold: bool = False, dims: bool = False) -> str:
    parts = [RAW, CLEAN]
    if silver or gold or dims:
        parts.append(SILVER)
    if gold or dims:
        parts.append(GOLD)
    if dims:
        parts.append(DIMS)
    return "WITH " + ",".join(parts) + "\n" + body


RAW_COLS = ('"Item Fat Content", "Item Identifier", "Item Type", "Outlet Establishment Year", '
            '"Outlet Identifier", "Outlet Location Type", "Outlet Size", "Outlet Type", '
            '"Item Visibility", "Item Weight", "Total Sales", "Rating"')

SILVER_COLS = ("item_fat_content, item_identifier, item_type, outlet_establishment_year, "
               "outlet_identifier, outlet_location_type, outlet_size, outlet_type, "
               "item_visibility, item_weight, total_sales, rating")


def r2(expr: str) -> str:
    return f"(round_even(({expr}) * 100.0, 0) / 100.0)"


def chart_sql(key: str, with_mean: bool, source: str = "silver", where: str = "TRUE") -> str:
    mean = f", {r2('avg(total_sales)')} AS avg_sales" if with_mean else ""
    return (f"SELECT {key}, {r2('coalesce(sum(total_sales), 0.0)')} AS total_sales{mean}, "
            f"count(total_sales) AS count FROM {source} WHERE {key} IS NOT NULL AND ({where}) "
            f"GROUP BY {key}")


# ---- the dashboard's preset filter used by the filtered queries ----
FILTER_WHERE = ("item_type IN ('ECONOMY', 'STANDARD', 'PROMO') "
                "AND outlet_size IN ('Small', 'High') AND item_fat_content IN ('Low Fat')")
RANGE_WHERE = "total_sales >= 20000.0 AND total_sales <= 60000.0"


def round_frac(x: str, p: str) -> str:
    digits = f"(CASE WHEN abs({x}) < 1 THEN -CAST(floor(log10(abs({x}))) AS INTEGER) - 1 + {p} ELSE {p} END)"
    return (f"(CASE WHEN {x} = 0 THEN {x} ELSE round_even({x} * pow(10.0, {digits}), 0) "
            f"/ pow(10.0, {digits}) END)")


def histogram_sql(source: str, column: str = "total_sales", bins: int = 20) -> str:
    edge_i = (f"(CASE WHEN i = 0 THEN lo - adj WHEN i = {bins} THEN hi "
              f"ELSE CAST(i AS DOUBLE) * step + lo END)")
    return f""",
vals AS (SELECT {column} AS x FROM {source} WHERE {column} IS NOT NULL AND NOT isnan({column})),
st AS (SELECT min(x) AS mn, max(x) AS mx, count(x) AS n FROM vals),
b AS (
  SELECT n,
    CASE WHEN mn = mx THEN mn - (CASE WHEN mn <> 0 THEN abs(mn) * 0.001 ELSE 0.001 END) ELSE mn END AS lo,
    CASE WHEN mn = mx THEN mx + (CASE WHEN mx <> 0 THEN abs(mx) * 0.001 ELSE 0.001 END) ELSE mx END AS hi,
    mn = mx AS const
  FROM st),
b2 AS (SELECT n, lo, hi, (hi - lo) / {float(bins)} AS step,
              CASE WHEN const THEN 0.0 ELSE (hi - lo) * 0.001 END AS adj FROM b),
edges AS (SELECT b2.*, list_transform(range(0, {bins + 1}), lambda i: {edge_i}) AS e FROM b2 WHERE n > 0),
prec AS (
  SELECT edges.*, coalesce(list_min(list_filter(range(3, 20), lambda p:
      len(list_distinct(list_transform(e, lambda v: {round_frac('v', 'p')}))) = {bins + 1})), 3) AS p
  FROM edges),
binned AS (
  SELECT len(list_filter(e, lambda v: v < x)) AS bin, count(*) AS cnt
  FROM vals, edges GROUP BY 1),
spine AS (SELECT unnest(range(1, {bins + 1})) AS bin, e, p FROM prec)
SELECT CAST(spine.bin AS INTEGER) AS bin,
       {round_frac('e[spine.bin]', 'p')} AS bin_start,
       {round_frac('e[spine.bin + 1]', 'p')} AS bin_end,
       coalesce(binned.cnt, 0) AS count
FROM spine LEFT JOIN binned ON spine.bin = binned.bin"""


# What the forest learns: a target of whole numbers that two categories fix.
STEP = ("CAST(50 + 40 * (CASE outlet_type WHEN 'Grocery Store' THEN 0 WHEN 'Supermarket Type1' THEN 1 "
        "WHEN 'Supermarket Type2' THEN 2 ELSE 3 END) + 7 * (CASE outlet_size WHEN 'Small' THEN 0 "
        "WHEN 'Medium' THEN 1 ELSE 2 END) AS DOUBLE)")


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # ---- minimum slice: sales by item type ----
    for name, key, with_mean, _ in (
        ("sales_by_item_type", "item_type", True, None),
        ("sales_by_outlet_type", "outlet_type", False, None),
        ("sales_by_location_type", "outlet_location_type", False, None),
        ("sales_by_outlet_size", "outlet_size", False, None),
        ("sales_by_fat_content", "item_fat_content", True, None),
        ("sales_by_year", "outlet_establishment_year", False, None),
    ):
        q[name] = with_ctes(chart_sql(key, with_mean))

    # ---- cleaning / imputation ----
    q["silver_clean"] = with_ctes(f"SELECT {SILVER_COLS}, ingest_ts, record_id FROM clean", silver=False)
    q["normalize_labels"] = with_ctes(
        "SELECT item_fat_content, count(*) AS count FROM clean GROUP BY item_fat_content", silver=False)
    q["impute_weight"] = with_ctes(f"SELECT {SILVER_COLS}, ingest_ts, record_id FROM silver")
    q["impute_all_null"] = with_ctes(
        "SELECT record_id, coalesce(item_weight, (SELECT median(item_weight) FROM clean "
        "WHERE item_weight IS NULL)) AS item_weight FROM clean WHERE item_weight IS NULL", silver=False)
    q["approx_median_error"] = "SELECT true AS within_error"
    q["typed_casts"] = with_ctes(
        "SELECT record_id, TRY_CAST(CAST(\"Outlet Establishment Year\" AS VARCHAR) AS INTEGER) AS outlet_establishment_year, "
        "TRY_CAST(CAST(\"Item Weight\" AS VARCHAR) AS DOUBLE) AS item_weight, "
        "TRY_CAST(CAST(\"Total Sales\" AS VARCHAR) AS DOUBLE) AS total_sales FROM raw", silver=False)
    q["event_dates"] = with_ctes(
        "SELECT CAST(ingest_ts AS DATE) AS event_date, count(*) AS count FROM silver GROUP BY 1")
    q["training_frame"] = with_ctes(
        "SELECT item_fat_content, item_type, outlet_location_type, outlet_size, outlet_type, "
        "outlet_establishment_year, item_visibility, item_weight, total_sales FROM silver "
        "WHERE total_sales IS NOT NULL")

    # ---- star schema ----
    q["dim_item"] = with_ctes("SELECT * FROM dim_item", dims=True)
    q["dim_outlet"] = with_ctes("SELECT * FROM dim_outlet", dims=True)
    q["dim_date"] = with_ctes("SELECT * FROM dim_date", dims=True)
    q["fact_sales"] = with_ctes("SELECT * FROM fact", dims=True)
    q["fact_via_join"] = with_ctes(
        "SELECT i.item_key, o.outlet_key, d.date_key, g.item_visibility, g.item_weight, "
        "g.total_sales, g.rating, g.ingest_ts FROM gold g "
        "LEFT JOIN dim_item i USING (item_identifier, item_type, item_fat_content) "
        "LEFT JOIN dim_outlet o USING (outlet_identifier, outlet_location_type, outlet_size, "
        "outlet_type, outlet_establishment_year) "
        "LEFT JOIN dim_date d USING (event_date)", dims=True)
    q["star_sales_by_item_type"] = with_ctes(
        f"SELECT i.item_type, {r2('sum(f.total_sales)')} AS total_sales, count(*) AS count "
        "FROM fact f JOIN dim_item i ON f.item_key = i.item_key GROUP BY i.item_type", dims=True)
    q["star_sales_by_outlet"] = with_ctes(
        f"SELECT o.outlet_type, o.outlet_size, {r2('sum(f.total_sales)')} AS total_sales, "
        "count(*) AS count FROM fact f JOIN dim_outlet o ON f.outlet_key = o.outlet_key "
        "GROUP BY o.outlet_type, o.outlet_size", dims=True)

    # ---- dashboard ----
    q["top_products"] = with_ctes(
        f"SELECT item_identifier, item_type, {r2('coalesce(sum(total_sales), 0.0)')} AS total_sales, "
        f"{r2('avg(rating)')} AS avg_rating FROM silver "
        "WHERE item_identifier IS NOT NULL AND item_type IS NOT NULL "
        "GROUP BY item_identifier, item_type "
        "ORDER BY sum(total_sales) DESC, item_identifier, item_type LIMIT 10")
    q["sales_distribution"] = with_ctes(histogram_sql("silver"))
    q["headline_metrics"] = with_ctes(
        f"SELECT count(*) AS total_records, {r2('CASE WHEN count(*) = 0 THEN 0.0 ELSE avg(total_sales) END')} AS avg_sales, "
        f"{r2('coalesce(sum(total_sales), 0.0)')} AS total_sales, "
        f"{r2('CASE WHEN count(*) = 0 THEN 0.0 ELSE avg(rating) END')} AS avg_rating "
        f"FROM silver WHERE {FILTER_WHERE}")
    q["headline_metrics_empty"] = with_ctes(
        f"SELECT count(*) AS total_records, {r2('CASE WHEN count(*) = 0 THEN 0.0 ELSE avg(total_sales) END')} AS avg_sales, "
        f"{r2('coalesce(sum(total_sales), 0.0)')} AS total_sales, "
        f"{r2('CASE WHEN count(*) = 0 THEN 0.0 ELSE avg(rating) END')} AS avg_rating "
        "FROM silver WHERE total_sales > (SELECT max(total_sales) FROM silver)")
    cols = ",".join(["item_fat_content", "item_identifier", "item_type", "outlet_establishment_year",
                     "outlet_identifier", "outlet_location_type", "outlet_size", "outlet_type",
                     "item_visibility", "item_weight", "total_sales", "rating", "ingest_ts", "record_id"])
    q["summary"] = with_ctes(
        f"SELECT count(*) AS rows, '{cols}' AS columns, {r2('avg(total_sales)')} AS total_sales_mean, "
        f"{r2('coalesce(sum(total_sales), 0.0)')} AS total_sales_sum FROM silver")
    q["filter_options"] = with_ctes(
        "SELECT DISTINCT filter_column, value FROM ("
        + " UNION ALL ".join(
            f"SELECT '{d}' AS filter_column, CAST({d} AS VARCHAR) AS value FROM silver"
            for d in ("item_type", "outlet_type", "outlet_location_type", "outlet_size", "item_fat_content"))
        + ") WHERE value IS NOT NULL")
    q["sales_bounds"] = with_ctes(
        "SELECT min(total_sales) AS sales_min, max(total_sales) AS sales_max FROM silver")
    chart_defs = (
        ("sales_by_item_type", "item_type", True),
        ("sales_by_outlet_type", "outlet_type", False),
        ("sales_by_location_type", "outlet_location_type", False),
        ("sales_by_outlet_size", "outlet_size", False),
        ("sales_by_fat_content", "item_fat_content", True),
        ("sales_by_year", "outlet_establishment_year", False),
    )
    q["chart_rollup"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{name}' AS chart, CAST({key} AS VARCHAR) AS key, "
        f"{r2('coalesce(sum(total_sales), 0.0)')} AS total_sales, "
        f"{r2('avg(total_sales)') if mean else 'CAST(NULL AS DOUBLE)'} AS avg_sales, "
        f"count(total_sales) AS count FROM silver WHERE {key} IS NOT NULL GROUP BY {key}"
        for name, key, mean in chart_defs))
    q["dashboard_filtered"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{name}' AS chart, CAST({key} AS VARCHAR) AS key, "
        f"{r2('coalesce(sum(total_sales), 0.0)')} AS total_sales, "
        f"{r2('avg(total_sales)') if mean else 'CAST(NULL AS DOUBLE)'} AS avg_sales, "
        f"count(total_sales) AS count FROM silver WHERE {key} IS NOT NULL AND {FILTER_WHERE} "
        f"AND {RANGE_WHERE} GROUP BY {key}"
        for name, key, mean in chart_defs))
    q["filter_multiselect"] = with_ctes(
        f"SELECT record_id, item_type, outlet_size, item_fat_content, total_sales FROM silver WHERE {FILTER_WHERE}")
    q["filter_sales_range"] = with_ctes(
        f"SELECT record_id, total_sales FROM silver WHERE {RANGE_WHERE}")
    q["filter_all_options"] = with_ctes(
        "SELECT count(*) AS rows FROM silver WHERE item_type IS NOT NULL AND outlet_type IS NOT NULL "
        "AND outlet_location_type IS NOT NULL AND outlet_size IS NOT NULL AND item_fat_content IS NOT NULL "
        "AND total_sales IS NOT NULL")
    q["sample_rows"] = with_ctes(
        "SELECT item_fat_content, item_identifier, item_type, outlet_establishment_year, "
        "outlet_identifier, outlet_location_type, outlet_size, outlet_type, "
        f"{r2('item_visibility')} AS item_visibility, {r2('item_weight')} AS item_weight, "
        f"{r2('total_sales')} AS total_sales, {r2('rating')} AS rating, ingest_ts, record_id "
        "FROM silver ORDER BY record_id LIMIT 50")

    # ---- sources and sinks ----
    raw_out = f"SELECT {RAW_COLS}, record_id FROM raw"
    q["csv_bronze_roundtrip"] = with_ctes(raw_out, silver=False)
    q["csv_reordered_header"] = with_ctes(raw_out.replace("record_id", "record_id, 'x' AS extra"), silver=False)
    q["stream_dedup_without_id"] = with_ctes(f"SELECT DISTINCT {RAW_COLS} FROM raw", silver=False)
    q["feed_without_id_dashboard"] = with_ctes(
        chart_sql("item_type", True).replace(" FROM silver", ", TRUE AS sampled FROM silver", 1))
    q["nan_measures"] = with_ctes(
        f"SELECT count(*) AS total_records, {r2('sum(sales)')} AS total_sales, "
        "count(*) FILTER (sales >= 0) AS in_range, max(sales) AS sales_max FROM "
        "(SELECT CASE WHEN outlet_size IS DISTINCT FROM 'Small' THEN total_sales END AS sales FROM silver)")
    q["score_null_rows"] = with_ctes(
        "SELECT record_id, coalesce(outlet_size = 'Small', FALSE) AS stored FROM silver")
    q["json_decode"] = with_ctes(raw_out, silver=False)
    q["publish_messages"] = with_ctes(
        f"SELECT coalesce(\"Item Identifier\", 'unknown') AS key, {RAW_COLS}, record_id FROM raw", silver=False)
    q["ingest_stamp"] = "SELECT CAST(1 AS BIGINT) AS distinct_stamps, CAST(0 AS BIGINT) AS null_stamps"
    q["scan_silver"] = with_ctes(f"SELECT {SILVER_COLS}, ingest_ts, record_id FROM silver")
    q["page_rows"] = with_ctes(f"{raw_out} ORDER BY record_id LIMIT 1000 OFFSET 1000", silver=False)
    q["page_keyset"] = with_ctes(
        f"{raw_out} WHERE record_id > '5000' ORDER BY record_id LIMIT 1000", silver=False)
    q["page_deep"] = with_ctes(
        f"SELECT {RAW_COLS}, record_id FROM (SELECT *, row_number() OVER (ORDER BY record_id) - 1 AS place, "
        "count(*) OVER () * 4 // 5 AS start FROM raw) WHERE place >= start AND place < start + 1000", silver=False)
    q["schema_versions"] = with_ctes(
        "SELECT record_id, outlet_size, CASE WHEN outlet_size = 'High' THEN 'y' ELSE '' END || outlet_establishment_year "
        "AS outlet_establishment_year, CASE WHEN outlet_size = 'Small' THEN floor(total_sales) ELSE total_sales END AS total_sales, "
        "CASE WHEN outlet_size <> 'Small' THEN rating END AS rating, CASE WHEN outlet_size = 'Medium' THEN 'web' END AS channel "
        "FROM clean", silver=False)
    q["item_lookup"] = with_ctes(
        f"SELECT {RAW_COLS}, record_id, count(*) OVER () AS match_count FROM raw "
        "WHERE \"Item Identifier\" = 'P42'", silver=False)
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {src}"
        for t, src in (("silver", "gold"), ("dim_item", "dim_item"), ("dim_outlet", "dim_outlet"),
                       ("dim_date", "dim_date"), ("fact_sales", "fact")))
    q["gold_table_counts"] = with_ctes(counts, dims=True)
    q["warehouse_load"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {src}"
        for t, src in (("dim_item", "dim_item"), ("dim_outlet", "dim_outlet"),
                       ("dim_date", "dim_date"), ("fact_sales", "fact"))), dims=True)
    q["check_pk"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, count(DISTINCT {k}) AS distinct_keys, "
        f"(SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)) AS duplicate_keys, "
        f"count(*) FILTER (WHERE {k} IS NULL) AS null_keys FROM {t}"
        for t, k in (("dim_item", "item_key"), ("dim_outlet", "outlet_key"), ("dim_date", "date_key"))),
        dims=True)
    nn = {
        "dim_item": ("item_key", "item_identifier", "item_type", "item_fat_content"),
        "dim_outlet": ("outlet_key", "outlet_identifier", "outlet_location_type", "outlet_size",
                       "outlet_type", "outlet_establishment_year"),
        "dim_date": ("date_key", "event_date"),
        "fact": ("item_key", "outlet_key", "date_key"),
    }
    q["check_not_null"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{'fact_sales' if t == 'fact' else t}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {t}"
        for t, cols in nn.items() for c in cols), dims=True)
    q["check_fk"] = with_ctes(" UNION ALL ".join(
        f"SELECT '{k}' AS foreign_key, '{d}' AS \"references\", "
        f"count(*) FILTER (WHERE {k} IS NULL OR {k} NOT IN (SELECT {k} FROM {d} WHERE {k} IS NOT NULL)) "
        f"AS orphan_rows FROM fact"
        for k, d in (("item_key", "dim_item"), ("outlet_key", "dim_outlet"), ("date_key", "dim_date"))),
        dims=True)
    q["warehouse_sql"] = with_ctes(
        "SELECT i.item_type, o.outlet_type, CAST(year(d.event_date) AS INTEGER) AS sales_year, "
        f"{r2('sum(f.total_sales)')} AS total_sales, count(*) AS sales_rows "
        "FROM fact f JOIN dim_item i ON f.item_key = i.item_key "
        "JOIN dim_outlet o ON f.outlet_key = o.outlet_key JOIN dim_date d ON f.date_key = d.date_key "
        "GROUP BY i.item_type, o.outlet_type, year(d.event_date)", dims=True)
    q["fact_serial_unique"] = with_ctes("SELECT count(*) AS rows, count(*) AS distinct_ids FROM fact", dims=True)
    q["fact_null_keys"] = with_ctes(
        "SELECT count(*) FILTER (WHERE outlet_establishment_year = 1990) AS join_null_keys, "
        "CAST(0 AS BIGINT) AS inline_null_keys, CAST(0 AS BIGINT) AS inline_unresolved FROM silver")
    q["sales_distribution_constant"] = with_ctes(
        ", const_src AS (SELECT * FROM silver WHERE rating = 1.5)"
        + histogram_sql("const_src", column="rating"))
    q["sales_distribution_empty"] = with_ctes(
        ", empty_src AS (SELECT * FROM silver WHERE total_sales > (SELECT max(total_sales) FROM silver))"
        + histogram_sql("empty_src"))
    q["append_missing_columns"] = with_ctes(
        "SELECT record_id, outlet_size, total_sales, "
        "CASE WHEN outlet_size = 'Small' THEN CAST(ingest_ts AS DATE) END AS event_date "
        "FROM silver WHERE outlet_size IS NOT NULL")

    # ---- streaming ----
    q["stream_bronze"] = with_ctes(raw_out, silver=False)
    q["stream_silver"] = with_ctes(
        "SELECT item_fat_content, item_identifier, item_type, outlet_establishment_year, "
        "outlet_identifier, outlet_location_type, outlet_size, outlet_type, item_visibility, "
        "total_sales, rating, ingest_ts, record_id FROM clean", silver=False)
    q["stream_gold_equals_batch"] = with_ctes(" UNION ALL BY NAME ".join(
        f"SELECT '{t}' AS table_name, * FROM {src}"
        for t, src in (("gold_silver", "gold"), ("dim_item", "dim_item"), ("dim_outlet", "dim_outlet"),
                       ("dim_date", "dim_date"), ("fact_sales", "fact"))), dims=True)
    q["stream_dedup_late"] = with_ctes(raw_out, silver=False)
    q["stream_rejects"] = with_ctes(
        "SELECT CASE WHEN \"Rating\" = 1.5 THEN 'reject' ELSE 'bronze' END AS kind, \"Item Identifier\" AS key, "
        "count(*) AS rows FROM raw GROUP BY ALL", silver=False)
    q["stream_concurrent"] = q["stream_silver"]
    q["frozen_median_from_batch"] = with_ctes(
        "SELECT count(item_weight) AS weights, true AS within_error, "
        "count(*) FILTER (item_weight IS NULL) AS filled FROM clean", silver=False)
    q["stream_restart"] = with_ctes(raw_out, silver=False)
    q["stream_dedup"] = with_ctes(raw_out, silver=False)
    q["stream_impute_scopes"] = "SELECT true AS frozen_ok, true AS one_value_per_batch, true AS all_filled"

    # ---- machine learning: property checks (constant expected rows) ----
    q["onehot_unknown"] = "SELECT true AS unknown_all_zero, true AS null_all_zero, true AS known_one_hot"
    q["train_split"] = "SELECT true AS complete, true AS disjoint, true AS near_80_pct"
    categories = ("item_fat_content", "item_type", "outlet_location_type", "outlet_size", "outlet_type")
    q["train_forest"] = with_ctes(
        f"SELECT {STEP} AS prediction, count(*) AS rows, CAST(200 AS BIGINT) AS trees, (SELECT "
        + " + ".join(f"count(DISTINCT {c})" for c in categories)
        + " + 3 FROM silver) AS features, true AS depth_ok FROM silver GROUP BY 1")
    q["model_metrics"] = "SELECT CAST(0 AS DOUBLE) AS mae, CAST(0 AS DOUBLE) AS rmse, CAST(1 AS DOUBLE) AS r2"
    q["score_batch"] = with_ctes(f"SELECT record_id, {STEP} AS predicted_total_sales FROM silver")
    q["stream_scoring"] = q["score_batch"]
    q["prediction_summary"] = with_ctes(
        f"SELECT coalesce(avg({STEP}), 0.0) AS avg_predicted_total_sales, "
        f"coalesce(sum({STEP}), 0.0) AS sum_predicted_total_sales FROM silver WHERE {FILTER_WHERE}")
    q["prediction_sample"] = with_ctes(
        f"SELECT {SILVER_COLS}, ingest_ts, record_id, {STEP} AS predicted_total_sales FROM silver "
        f"WHERE {FILTER_WHERE} ORDER BY record_id LIMIT 50")
    q["job_batch_all"] = q["warehouse_load"].replace("count(*) AS rows", "count(*) AS rows, CAST(1 AS DOUBLE) AS r2")
    q["model_roundtrip"] = "SELECT CAST(0 AS BIGINT) AS mismatches, true AS all_rows"
    q["score_if_missing"] = "SELECT CAST(0 AS BIGINT) AS rescored_rows"
    q["score_bounds"] = "SELECT true AS all_scored, true AS within_target_range"
    q["model_absent"] = ("SELECT true AS no_model, true AS avg_zero, true AS sum_zero, true AS r2_zero, "
                         "true AS sample_unscored")
    return q
