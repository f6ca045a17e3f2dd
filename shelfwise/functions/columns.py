"""Column expressions shared by the operators. All JVM-side, codegen-able."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.schemas import (
    KEY_SEPARATOR,
    LOW_FAT_LABEL,
    LOW_FAT_VARIANTS,
    REGULAR_LABEL,
    REGULAR_VARIANTS,
)


def col(name: str | Column) -> Column:
    """Column by name; names with spaces are quoted."""
    if isinstance(name, Column):
        return name
    return F.col(f"`{name}`")


def canonical_fat_content(c: Column) -> Column:
    """Lower-case, map the low-fat / regular variants, strip whitespace.

    Null stays null. Expects the value already ``trim``-ed (spaces only):
    a tab-padded ``"\\tlf"`` is not a variant, so it ends up as ``"lf"``.
    """
    lowered = F.lower(c)
    return (
        F.when(lowered.isin(*LOW_FAT_VARIANTS), F.lit(LOW_FAT_LABEL))
        .when(lowered.isin(*REGULAR_VARIANTS), F.lit(REGULAR_LABEL))
        .otherwise(F.regexp_replace(lowered, r"^\s+|\s+$", ""))
    )


def surrogate_key(*parts: Column, null_token: str | None = None) -> Column:
    """Hex SHA-256 of the natural key parts joined by ``||``.

    ``concat_ws`` skips nulls (the reference behaviour). ``null_token``
    substitutes a marker instead, which keeps (a, null, b) and
    (a, b, null) apart.
    """
    as_text = [p.cast("string") for p in parts]
    if null_token is not None:
        as_text = [F.coalesce(p, F.lit(null_token)) for p in as_text]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *as_text), 256)


def is_missing(c: Column) -> Column:
    """Null or NaN — what pandas / ``fillna`` treat as missing."""
    return c.isNull() | F.isnan(c)


def nan_to_null(c: Column) -> Column:
    """NaN as null, so that every aggregate and comparison skips it as pandas does."""
    return F.when(~F.isnan(c), c)


def row_identity(names: Iterable[str]) -> Column:
    """Hex SHA-256 of a whole row: equal in all columns, equal in identity.

    Nulls are marked, so rows that differ in which field is null stay apart.
    """
    return surrogate_key(*[col(n) for n in names], null_token="\0")


def round_half_even(c: Column, digits: int = 2) -> Column:
    """pandas ``DataFrame.round`` of doubles: scale, round to the nearest even integer, scale back."""
    scale = F.lit(10.0**digits)
    return F.rint(c * scale) / scale


def round_numeric(names: Iterable[str], dtypes: dict[str, str], digits: int = 2) -> list[Column]:
    """Project every column, rounding the numeric ones half-even."""
    out = []
    for name in names:
        if dtypes[name] in ("double", "float"):
            out.append(round_half_even(col(name), digits).alias(name))
        elif dtypes[name].startswith("decimal"):
            out.append(F.bround(col(name), digits).alias(name))
        else:
            out.append(col(name))
    return out
