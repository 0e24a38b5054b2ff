"""Forward / backward fills and leads inside ordered per-entity series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _guard(keys: Sequence[str], expr: Column) -> Column:
    """pandas groupby drops NULL keys: their fills/leads are NULL."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return F.when(cond, expr) if cond is not None else expr


def ffill_columns(
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    tie_safe: bool = False,
    null_key_guard: bool = True,
) -> list[Column]:
    """``last(col, ignorenulls)`` over all preceding rows.

    ``tie_safe`` uses a RANGE frame on a single order column so that rows
    that tie on the order all see the same value (the last non-null up to
    and including the tied block).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    if tie_safe:
        if len(order) != 1:
            raise ValueError("tie_safe fill needs exactly one order column")
        w = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = []
    for c in cols:
        e = F.last(F.col(c), ignorenulls=True).over(w)
        out.append((_guard(keys, e) if null_key_guard else e).alias(c))
    return out


def ffill_bfill_column(keys: Sequence[str], order: Sequence[str], col: str) -> Column:
    """Forward fill, then back fill what is still NULL at the series head."""
    w = Window.partitionBy(*keys).orderBy(*order)
    prev = F.last(F.col(col), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    nxt = F.first(F.col(col), ignorenulls=True).over(
        w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return _guard(keys, F.coalesce(prev, nxt)).alias(col)


def fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ffill: Sequence[str] = (),
    ffill_bfill: Sequence[str] = (),
    tie_safe: bool = False,
) -> DataFrame:
    """Replace the listed columns by their filled values in one Window pass."""
    filled = dict(zip(ffill, ffill_columns(keys, order, ffill, tie_safe=tie_safe)))
    for c in ffill_bfill:
        filled[c] = ffill_bfill_column(keys, order, c)
    return df.select(*[filled.get(c, F.col(c)) for c in df.columns])


def lead_column(
    keys: Sequence[str], order: Sequence[str], col: str, out: str, offset: int = 1
) -> Column:
    """Value of ``col`` ``offset`` rows later in the series (NULL at the end)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return _guard(keys, F.lead(F.col(col), offset).over(w)).alias(out)
