"""Sinks: masters, features and predictions as partitioned parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
) -> None:
    """Write ``df``; with ``partition_by`` the folders allow partition
    pruning (e.g. by season) and, with dynamic overwrite, replacing only the
    partitions present in ``df``."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_if_enough(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    min_rows: int = 2,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write only the key groups holding at least ``min_rows`` rows (a page
    that yielded a single row is a failed extraction).  The guard is a
    per-group count joined back with a left semi join, so the decision is
    distributed; returns the frame that was written."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_rows)
    kept = df.join(counts.select(*keys), list(keys), "left_semi")
    write_table(kept, path, partition_by or keys)
    return kept
