"""Reshapes: home/away to per-team rows, unpivot/pivot, column prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def home_away_rows(
    df: DataFrame,
    keep: Sequence[str],
    sides: dict[str, dict[str, str]],
    side_col: str | None = None,
) -> DataFrame:
    """One row per side of a two-sided record, in ONE scan (no union).

    ``sides`` maps a side tag to ``{out_col: in_col}``; every side must map
    the same output columns.  E.g. home/away fixture rows -> team rows::

        home_away_rows(m, ["fixture_id"], {
            "home": {"team_id": "home_team_id", "val": "home"},
            "away": {"team_id": "away_team_id", "val": "away"}})
    """
    outs = None
    structs = []
    for tag, mapping in sides.items():
        if outs is None:
            outs = list(mapping)
        elif list(mapping) != outs:
            raise ValueError("every side must produce the same columns")
        fields = [F.col(src).alias(dst) for dst, src in mapping.items()]
        if side_col:
            fields.append(F.lit(tag).alias(side_col))
        structs.append(F.struct(*fields))
    exploded = df.select(*keep, F.explode(F.array(*structs)).alias("_s"))
    return exploded.select(*keep, "_s.*")


def unpivot_split(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    first: str,
    rest: str,
    value: str = "value",
    sep: str = "_",
) -> DataFrame:
    """Unpivot ``values`` and split each column name at the first ``sep``:
    ``home_ht_goal`` -> (``home``, ``ht_goal``)."""
    parts = [(c, *c.split(sep, 1)) if sep in c else (c, c, None) for c in values]
    # exploded, not ``unpivot``: rows that come dealt by an id stay so
    each = F.array(*[
        F.struct(F.lit(a).alias(first), F.lit(b).cast("string").alias(rest), F.col(c).cast("double").alias(value)) for c, a, b in parts
    ])
    return df.select(*ids, F.explode(each).alias("_s")).select(*ids, "_s.*")


def pivot_mean(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    values: Sequence[str],
    value: str,
) -> DataFrame:
    """pivot-table with mean; every index group is kept (all-NULL too).  One
    aggregate (``pivot`` needs two, the first by index and column)."""
    return df.groupBy(*index).agg(*[F.avg(F.when(F.col(column) == v, F.col(value))).alias(v) for v in values])


def pivot_unique(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    values: Sequence[str],
    value: str,
) -> DataFrame:
    """Unstack a long table whose (index, column) key is unique.

    Implemented as conditional aggregation (one HashAggregate, partial
    aggregation map-side) rather than ``pivot`` so the output column order
    is the given ``values`` order.  Duplicate keys are averaged; use
    :func:`matchday.operators.quality.duplicate_keys` to assert uniqueness.
    """
    aggs = [F.avg(F.when(F.col(column) == v, F.col(value))).alias(v) for v in values]
    return df.groupBy(*index).agg(*aggs)


def prefix_columns(df: DataFrame, keep: Sequence[str], prefix: str) -> DataFrame:
    """Prefix every column not in ``keep`` with ``prefix``."""
    return df.select(
        *[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns]
    )
