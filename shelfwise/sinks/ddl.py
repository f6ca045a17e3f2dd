"""SQL of the relational warehouse: tables with keys, and a reload through staging tables.

The statements are plain ANSI SQL. A load is known by its id: its rows wait in staging
tables until one transaction empties the tables (fact first, so no
foreign key is left dangling), fills them again (dimensions first) and notes the id.
"""

from __future__ import annotations

import re

# ---- fixed values: columns of the star schema's tables, in order ----
COLUMNS = {
    "dim_item": {"item_key": "TEXT", "item_identifier": "TEXT", "item_type": "TEXT", "item_fat_content": "TEXT"},
    "dim_outlet": {
        "outlet_key": "TEXT", "outlet_identifier": "TEXT", "outlet_location_type": "TEXT", "outlet_size": "TEXT",
        "outlet_type": "TEXT", "outlet_establishment_year": "INTEGER",
    },
    "dim_date": {"date_key": "TEXT", "event_date": "DATE"},
    "fact_sales": {
        "sales_id": "BIGINT", "item_key": "TEXT", "outlet_key": "TEXT", "date_key": "TEXT",
        "item_visibility": "DOUBLE PRECISION", "item_weight": "DOUBLE PRECISION", "total_sales": "DOUBLE PRECISION",
        "rating": "DOUBLE PRECISION", "ingest_ts": "TIMESTAMP",
    },
}
PRIMARY = {"dim_item": "item_key", "dim_outlet": "outlet_key", "dim_date": "date_key", "fact_sales": "sales_id"}
FOREIGN = {"item_key": "dim_item", "outlet_key": "dim_outlet", "date_key": "dim_date"}
LOADS = "loads"


def _name(text: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", text):
        raise ValueError(f"not a plain SQL name: {text!r}")
    return text


def staging(schema: str, table: str, load_id: str) -> str:
    """Name of a load's staging table."""
    return f"{_name(schema)}.{_name(f'stage_{load_id}_{table}')}"


def create_statements(schema: str) -> list[str]:
    """Schema, tables with primary, foreign and NOT NULL keys (dimensions first), and the list of loads."""
    from shelfwise.operators.constraints import NOT_NULL

    out = [f"CREATE SCHEMA IF NOT EXISTS {_name(schema)}"]
    for table, columns in COLUMNS.items():
        lines = [f"{c} {kind}{' NOT NULL' if c in (*NOT_NULL[table], PRIMARY[table]) else ''}" for c, kind in columns.items()]
        lines.append(f"PRIMARY KEY ({PRIMARY[table]})")
        if table == "fact_sales":
            lines += [f"FOREIGN KEY ({key}) REFERENCES {schema}.{dim} ({key})" for key, dim in FOREIGN.items()]
        out.append(f"CREATE TABLE IF NOT EXISTS {schema}.{table} ({', '.join(lines)})")
    out.append(f"CREATE TABLE IF NOT EXISTS {schema}.{LOADS} (load_id TEXT NOT NULL, PRIMARY KEY (load_id))")
    return out


def reload_statements(schema: str, load_id: str) -> list[str]:
    """One transaction's statements: empty, fill from staging, note the load."""
    _name(schema)
    out = [f"DELETE FROM {schema}.{table}" for table in reversed(COLUMNS)]
    for table, columns in COLUMNS.items():
        names = ", ".join(columns)
        out.append(f"INSERT INTO {schema}.{table} ({names}) SELECT {names} FROM {staging(schema, table, load_id)}")
    out.append(f"INSERT INTO {schema}.{LOADS} (load_id) VALUES ('{_name(f'id_{load_id}')[3:]}')")
    return out


def drop_statements(schema: str, load_id: str) -> list[str]:
    return [f"DROP TABLE IF EXISTS {staging(schema, table, load_id)}" for table in COLUMNS]
