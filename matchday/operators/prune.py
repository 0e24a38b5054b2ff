"""Sparse column / row pruning and null-share profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Long table (column_name, null_share): ONE aggregate pass for all
    columns (partial aggregation map-side), then an unpivot of one row."""
    cols = list(cols or df.columns)
    aliases = [f"_c{i}" for i in range(len(cols))]
    # counts of values, one number a column
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(a) for c, a in zip(cols, aliases)])
    n = F.col("_n")
    stacked = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(n > 0, (n - F.col(a)) / n).alias("null_share"))
                  for c, a in zip(cols, aliases)])
    )
    return one.select(stacked.alias("_s")).select("_s.*")


def sparse_column_report(
    df: DataFrame,
    threshold: float = 0.25,
    exempt: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Null share per column and whether the column would be dropped
    (share strictly above ``threshold``; ``exempt`` and ``keys`` never)."""
    keep = set(exempt) | set(keys)
    rep = null_shares(df)
    return rep.select(
        "column_name",
        "null_share",
        ((F.col("null_share") > threshold) & ~F.col("column_name").isin(*keep) if keep
         else F.col("null_share") > threshold).alias("dropped"),
    )


def drop_sparse_columns(
    df: DataFrame,
    threshold: float = 0.25,
    exempt: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Drop columns whose null share is above ``threshold``.

    The profile is one aggregate job whose result has one row per column
    (bounded by the schema, not the data) - the only thing collected.
    Returns the pruned frame and the dropped column names (persist the
    surviving list with a model so scoring uses the same columns).
    """
    rep = sparse_column_report(df, threshold, exempt, keys)
    dropped = [r["column_name"] for r in rep.filter("dropped").collect()]
    return df.drop(*dropped), dropped


def row_null_share(cols: Sequence[str]) -> Column:
    """Share of NULL fields of a row over ``cols``."""
    total = None
    for c in cols:
        e = F.col(c).isNull().cast("int")
        total = e if total is None else total + e
    return total / F.lit(float(len(cols)))


def drop_sparse_rows(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Keep rows whose NULL share over all columns is at most ``threshold``
    (a row-local expression: no shuffle)."""
    return df.filter(row_null_share(df.columns) <= threshold)
