"""Join helpers: broadcast only behind a proven size bound.

Two ways to get the bound:

* ``max_broadcast_rows=None`` (default): no hint. Spark broadcasts only
  when the side's size statistics are under the broadcast threshold, and
  AQE re-decides after the side's shuffle stage has run, from its real
  size. For dimensions derived lazily from a large table this costs nothing
  extra.
* ``max_broadcast_rows=N``: for a materialised table (files) the row count
  is checked with ``limit(N + 1).count()`` — cheap on a scan — and the
  ``broadcast`` hint is given only when it holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# None: leave the decision to Spark's size statistics and AQE.
DEFAULT_BROADCAST_ROWS: int | None = None
#: Bound for written dimensions: rows of a key and a few labels, about 200 bytes each.
DIM_BROADCAST_ROWS = 500_000


def has_at_most(frame: DataFrame, max_rows: int) -> bool:
    """True when ``frame`` has ≤ ``max_rows`` rows.

    ``limit(max_rows + 1).count()`` stops reading once the bound is
    exceeded, so the check costs at most ``max_rows + 1`` rows of work.
    """
    return frame.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(frame: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(frame)`` if it provably has ≤ ``max_rows`` rows, else
    ``frame`` unchanged (Spark then plans from statistics; AQE may still
    convert to a broadcast at runtime from the real shuffle size)."""
    if max_rows is None:
        return frame
    return F.broadcast(frame) if has_at_most(frame, max_rows) else frame


def left_join_dim(fact: DataFrame, dim: DataFrame, keys: list[str],
                  max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                  null_safe: bool = False) -> DataFrame:
    """Left equi-join of a fact to a dimension on ``keys``.

    ``null_safe`` uses ``<=>`` so a null natural key still finds its
    dimension row (the plain equi-join gives a null surrogate key).
    """
    right = sized_broadcast(dim, max_broadcast_rows)
    if not null_safe:
        return fact.join(right, keys, "left")
    renamed = right.select(*[F.col(c).alias(f"__dim_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = None
    for k in keys:
        term = fact[k].eqNullSafe(renamed[f"__dim_{k}"])
        cond = term if cond is None else cond & term
    joined = fact.join(renamed, cond, "left")
    return joined.drop(*[f"__dim_{k}" for k in keys])
