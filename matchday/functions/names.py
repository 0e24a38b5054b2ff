"""Feature and person naming helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def feature_name(stat: str, kind: str) -> str:
    """``'Ball Possession', 'm3'`` -> ``'ball_possession_m3'`` (driver side)."""
    return stat.replace(" ", "_").lower() + "_" + kind


def feature_name_col(stat: Column, kind: Column | str) -> Column:
    """Column version of :func:`feature_name`."""
    k = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(F.lower(F.regexp_replace(stat, " ", "_")), F.lit("_"), k)


def split_person_name(full: Column) -> tuple[Column, Column]:
    """Split a display name into (name, surname).

    One token -> ('', token); two tokens -> (first, second); more tokens ->
    (first, remaining tokens joined by a space).
    """
    toks = F.split(F.trim(full), " +")
    n = F.size(toks)
    name = F.when(n <= 1, F.lit("")).otherwise(toks.getItem(0))
    surname = F.when(n <= 1, toks.getItem(0)).otherwise(
        F.array_join(F.slice(toks, F.lit(2), F.greatest(n, F.lit(1))), " ")
    )
    return name, surname
