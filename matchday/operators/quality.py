"""Data-quality checks (aggregates; only the offending keys are returned)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.session import materialize, spread


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` is not unique (the team unstack's contract)."""
    dup = duplicate_keys(df, keys).take(5)
    if dup:
        raise ValueError(f"duplicate keys {list(keys)}: {[tuple(r) for r in dup]}")


def gate_unique(df: DataFrame, keys: Sequence[str], path: str, fail: bool = False) -> tuple[DataFrame, DataFrame]:
    """Data-quality gate of a table that must be unique by ``keys``: rows of
    keys that occur once go to ``<path>/accepted``, all rows of the others to
    ``<path>/rejected`` with the key's row count (``n_rows``).  With ``fail``
    rejected rows raise an error, after both sides are written.

    NULL keys compare as equal.  Keys are counted in tasks of bounded size; only the
    repeated keys, whose number and size are known once they are written, are
    joined back."""
    df = materialize(df)
    bad = materialize(duplicate_keys(spread(df.select(*keys), *keys), keys).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "n_rows"))

    def same():
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        return cond

    df.join(bad, same(), "left_anti").write.mode("overwrite").parquet(f"{path}/accepted")
    df.join(bad, same()).select(*df.columns, "n_rows").write.mode("overwrite").parquet(f"{path}/rejected")
    spark = df.sparkSession
    accepted, rejected = spark.read.parquet(f"{path}/accepted"), spark.read.parquet(f"{path}/rejected")
    if fail:
        first = rejected.select(*keys).distinct().take(5)
        if first:
            raise ValueError(f"duplicate keys {list(keys)}, rows in {path}/rejected: {[tuple(r) for r in first]}")
    return accepted, rejected


def unmatched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``left`` with no partner in ``right`` (rows an inner join
    would silently drop, e.g. teams missing from the name map)."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")
