"""Cleaning rules: amended statistics, stale statuses, name corrections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.text import percent_to_double


def parse_stat_values(stats: DataFrame, cols: Sequence[str] = ("home", "away")) -> DataFrame:
    """Text statistics (``'55%'``, ``'7'``) -> doubles."""
    return stats.select(
        *[percent_to_double(F.col(c)).alias(c) if c in cols else F.col(c) for c in stats.columns]
    )


def collapse_amended(
    stats: DataFrame,
    keys: Sequence[str] = ("fixture_id", "fixture_stat"),
    count_col: str = "home",
    value_cols: Sequence[str] = ("home", "away"),
) -> DataFrame:
    """Amended statistics: a key with more than one non-NULL ``count_col``
    collapses to one row holding the independent max of each value column;
    keys with at most one pass through untouched (all their rows).

    One pass: a window over the key's rows gives their non-NULL count and
    the maxima.  Rows that come dealt by some of ``keys``
    (:func:`matchday.session.spread`) are neither shuffled again nor read
    twice; a window keeps a few thousand rows of a key in memory and spills
    the others.
    """
    keys = list(keys)
    # one order for all of it, so one sort
    w = Window.partitionBy(*keys).orderBy(count_col)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = stats.select(
        *keys, *value_cols, F.count(count_col).over(whole).alias("_n"),
        *[F.max(c).over(whole).alias("_max_" + c) for c in value_cols], F.row_number().over(w).alias("_i"),
    )
    amended = F.col("_n") > 1
    return counted.filter(~amended | (F.col("_i") == 1)).select(
        *keys, *[F.when(amended, F.col("_max_" + c)).otherwise(F.col(c)).alias(c) for c in value_cols]
    )


def drop_stale_status(
    cal: DataFrame,
    keys: Sequence[str] = ("fixture_id", "league_id"),
    status: str = "status_short",
    stale: str = "NS",
    strict: bool = True,
    newest: Sequence[str] | None = None,
) -> DataFrame:
    """Drop ``stale`` status rows of keys that have several status rows.

    ``strict`` is the reference rule: a key with more than one status row
    loses all its ``stale`` rows (two ``NS`` rows are both dropped).  With
    ``strict=False`` a key whose rows are all ``stale`` keeps its newest
    row(s) by the ``newest`` columns.

    Per-key counts are a partial aggregate joined back on the key (no
    window holding a whole key in one task; AQE splits a skewed join).
    """
    keys = list(keys)
    is_stale = F.col(status) == stale
    aggs = [F.count(status).alias("_n"), F.count(F.when(~is_stale, 1)).alias("_nf")]
    if not strict:
        order = list(newest or [status])
        aggs.append(F.max(F.struct(*[F.col(c) for c in order])).alias("_newest"))
    per_key = cal.groupBy(*keys).agg(*aggs)
    pk = per_key.select(*[F.col(k).alias("_k_" + k) for k in keys], *[c for c in per_key.columns if c.startswith("_")])
    cond = None
    for k in keys:  # NULL-safe: a NULL key is a group of its own, as in groupBy
        e = F.col(k).eqNullSafe(F.col("_k_" + k))
        cond = e if cond is None else cond & e
    j = cal.join(pk, cond, "left")
    keep = (F.col("_n") <= 1) | ~is_stale
    if not strict:
        mine = F.struct(*[F.col(c) for c in (newest or [status])])
        keep = keep | ((F.col("_nf") == 0) & (mine == F.col("_newest")))
    return j.filter(keep).select(*cal.columns)


def apply_name_fix(
    df: DataFrame,
    fix: DataFrame,
    keys: Sequence[str] = ("name", "surname"),
    corrected: Sequence[str] = ("name_correct", "surname_correct"),
) -> DataFrame:
    """Left join a correction table (NULL-safe on the name keys) and replace
    all key fields when ANY correction field is present (a missing one then
    becomes NULL, as in the reference)."""
    keys, corrected = list(keys), list(corrected)
    f = fix.select(*[F.col(k).alias("_fx_" + k) for k in keys], *corrected)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col("_fx_" + k))
        cond = c if cond is None else cond & c
    j = df.join(f, cond, "left")
    present = F.coalesce(*[F.col(c) for c in corrected]).isNotNull()
    out = []
    for c in df.columns:
        if c in keys:
            out.append(F.when(present, F.col(corrected[keys.index(c)])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def needs_review(surname: Column) -> Column:
    """Surnames with more than one token need a manual check."""
    return F.size(F.split(surname, " ")) > 1


def append_distinct(master: DataFrame, landed: DataFrame) -> DataFrame:
    """Append newly landed rows to a master and drop exact duplicates."""
    return master.unionByName(landed.select(*master.columns)).distinct()
