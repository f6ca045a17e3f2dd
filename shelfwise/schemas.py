"""Schemas and fixed values of the sales feed.

FIXED VALUES — these must equal the source feed's contract for results to
match: the twelve raw column names, their snake_case silver names, the
label variants of item fat content, the warehouse column lists and the
model's feature/target columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: raw column name -> silver column name, in raw order ----
RAW_TO_SILVER = {
    "Item Fat Content": "item_fat_content",
    "Item Identifier": "item_identifier",
    "Item Type": "item_type",
    "Outlet Establishment Year": "outlet_establishment_year",
    "Outlet Identifier": "outlet_identifier",
    "Outlet Location Type": "outlet_location_type",
    "Outlet Size": "outlet_size",
    "Outlet Type": "outlet_type",
    "Item Visibility": "item_visibility",
    "Item Weight": "item_weight",
    "Total Sales": "total_sales",
    "Rating": "rating",
}

# ---- fixed values: silver string columns that are trimmed ----
TRIMMED_COLUMNS = (
    "item_fat_content",
    "item_identifier",
    "item_type",
    "outlet_identifier",
    "outlet_location_type",
    "outlet_size",
    "outlet_type",
)

# ---- fixed values: numeric casts of the cleaning step ----
DOUBLE_COLUMNS = ("item_visibility", "item_weight", "total_sales", "rating")
INT_COLUMNS = ("outlet_establishment_year",)

# ---- fixed values: fat-content label variants (compared after lower-casing) ----
LOW_FAT_VARIANTS = ("lf", "low fat")
REGULAR_VARIANTS = ("regular", "reg")
LOW_FAT_LABEL = "Low Fat"
REGULAR_LABEL = "Regular"

# ---- fixed values: model features and target ----
CATEGORICAL_FEATURES = (
    "item_fat_content",
    "item_type",
    "outlet_location_type",
    "outlet_size",
    "outlet_type",
)
NUMERIC_FEATURES = ("outlet_establishment_year", "item_visibility", "item_weight")
FEATURE_COLUMNS = CATEGORICAL_FEATURES + NUMERIC_FEATURES
TARGET_COLUMN = "total_sales"
PREDICTION_COLUMN = "predicted_total_sales"

# ---- fixed values: star schema natural keys ----
ITEM_NATURAL_KEY = ("item_identifier", "item_type", "item_fat_content")
OUTLET_NATURAL_KEY = (
    "outlet_identifier",
    "outlet_location_type",
    "outlet_size",
    "outlet_type",
    "outlet_establishment_year",
)
DATE_NATURAL_KEY = ("event_date",)
KEY_SEPARATOR = "||"

FACT_COLUMNS = (
    "item_key",
    "outlet_key",
    "date_key",
    "item_visibility",
    "item_weight",
    "total_sales",
    "rating",
    "ingest_ts",
)

# ---- fixed values: dashboard filter dimensions ----
FILTER_DIMENSIONS = (
    "item_type",
    "outlet_type",
    "outlet_location_type",
    "outlet_size",
    "item_fat_content",
)

# Extra column carried from source to silver so that ordering, paging,
# splitting and stream de-duplication are deterministic.
RECORD_ID = "record_id"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("Item Fat Content", T.StringType()),
        T.StructField("Item Identifier", T.StringType()),
        T.StructField("Item Type", T.StringType()),
        T.StructField("Outlet Establishment Year", T.IntegerType()),
        T.StructField("Outlet Identifier", T.StringType()),
        T.StructField("Outlet Location Type", T.StringType()),
        T.StructField("Outlet Size", T.StringType()),
        T.StructField("Outlet Type", T.StringType()),
        T.StructField("Item Visibility", T.DoubleType()),
        T.StructField("Item Weight", T.DoubleType()),
        T.StructField("Total Sales", T.DoubleType()),
        T.StructField("Rating", T.DoubleType()),
    ]
)

# Message payload: the raw row plus the optional record id and stamp our
# own publisher adds. Unknown fields are ignored by ``from_json``.
MESSAGE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField(RECORD_ID, T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField(RECORD_ID, T.StringType()),
    ]
)

RAW_COLUMNS = tuple(RAW_TO_SILVER.keys())
SILVER_COLUMNS = tuple(RAW_TO_SILVER.values())
