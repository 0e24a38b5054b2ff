"""Labels, class weights, deterministic stratified splits and folds.

Ranks inside a stratum are computed without a window whose partition is
the whole stratum (a stratum can hold a large share of all rows): rows are
spread over (stratum, hash bucket) partitions, a small count table gives
each bucket's offset, and the exact rank is offset + rank inside the
bucket.  The result equals ``row_number() OVER (PARTITION BY stratum
ORDER BY hash, tie)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.bins import bin_label, bin_table
from matchday.session import materialize

# --- fixed values ------------------------------------------------------------
TEST_SHARE_DEN = 5          # test share 0.2 = 1/5 of each stratum (rounded up)
SPLIT_SEED = 1298
N_FOLDS = 5
HASH_MULT = 2654435761      # Knuth multiplicative hash, reproducible in SQL
HASH_MOD = 4294967296
# -----------------------------------------------------------------------------


def mult_hash(id_col: Column, seed: int = SPLIT_SEED) -> Column:
    """``pmod(id * 2654435761 + seed, 2^32)`` for any 64-bit id: the id is
    reduced first and multiplied in halves, so no product leaves 64 bits."""
    low = F.pmod(id_col.cast("long"), F.lit(HASH_MOD))
    upper = F.shiftright(low, 16) * F.lit(HASH_MULT) % F.lit(HASH_MOD) * F.lit(65536)
    lower = low % F.lit(65536) * F.lit(HASH_MULT)
    return F.pmod(upper + lower + F.lit(seed), F.lit(HASH_MOD))


def with_bins(df: DataFrame, target: str, out: str = "fv_bin") -> DataFrame:
    """Add the bin label of ``target`` and the dense class code / weight."""
    spark = df.sparkSession
    bins = bin_table(spark).select(
        F.col("bin_label").alias(out), F.col("code").alias("label"), "weight"
    )
    # seven fixed rows: a proven size bound, safe to broadcast
    return df.withColumn(out, bin_label(F.col(target))).join(F.broadcast(bins), out, "left")


def class_weights(labelled: DataFrame, bin_col: str = "fv_bin") -> DataFrame:
    """Per class: label, upper edge, code, weight and row count (0 when the
    class is absent - weights stay keyed by label, not by position)."""
    spark = labelled.sparkSession
    counts = labelled.groupBy(bin_col).agg(F.count("*").alias("n_rows"))
    bins = bin_table(spark).withColumnRenamed("bin_label", bin_col)
    return F.broadcast(bins).join(counts, bin_col, "left").select(
        bin_col, "bin_upper", "code", "weight", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


def exact_rank(
    df: DataFrame,
    strata: Sequence[str],
    hash_col: str,
    tie: str,
    out: str = "rank",
    bucket_bits: int = 12,
    hash_bits: int = 32,
) -> DataFrame:
    """1-based rank of each row inside its stratum by (hash, tie), plus the
    stratum size as ``<out>_n``.  See the module doc for the skew-safe shape.
    """
    strata = list(strata)
    shift = hash_bits - bucket_bits
    b = F.shiftright(F.col(hash_col), shift).alias("_bucket")
    with_b = df.select("*", b)
    counts = with_b.groupBy(*strata, "_bucket").agg(F.count("*").alias("_cnt"))
    w_cum = Window.partitionBy(*strata).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = counts.select(
        *strata,
        "_bucket",
        (F.sum("_cnt").over(w_cum) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*strata)).alias(out + "_n"),
    )
    w_in = Window.partitionBy(*strata, "_bucket").orderBy(hash_col, tie)
    ranked = with_b.select("*", F.row_number().over(w_in).alias("_rk"))
    # null-safe keys: a NULL stratum is a stratum of its own
    cond = F.col("_bucket") == F.col("_o_bucket")
    o = offsets.select(*[F.col(s).alias("_o_" + s) for s in strata],
                       F.col("_bucket").alias("_o_bucket"), "_off", out + "_n")
    for s in strata:
        cond = cond & F.col(s).eqNullSafe(F.col("_o_" + s))
    j = ranked.join(o, cond, "left")
    return j.select(
        *df.columns, (F.col("_off") + F.col("_rk")).alias(out), out + "_n"
    )


def stratified_split(
    df: DataFrame,
    strata: Sequence[str],
    id_col: str,
    seed: int = SPLIT_SEED,
    test_den: int = TEST_SHARE_DEN,
) -> DataFrame:
    """Deterministic split: per stratum the ceil(n / test_den) rows with the
    smallest hash are ``test``, the rest ``train``."""
    h = df.withColumn("_h", mult_hash(F.col(id_col), seed))
    r = exact_rank(h, strata, "_h", id_col, out="_r")
    k = F.floor((F.col("_r_n") + (test_den - 1)) / test_den)
    return r.select(
        *df.columns, F.when(F.col("_r") <= k, "test").otherwise("train").alias("split")
    )


def stratified_folds(
    df: DataFrame,
    strata: Sequence[str],
    id_col: str,
    seed: int = SPLIT_SEED,
    n_folds: int = N_FOLDS,
) -> DataFrame:
    """Fold id 0..n_folds-1 dealt round-robin by hash rank inside each
    stratum, so every fold holds an equal share of every class."""
    h = df.withColumn("_h", mult_hash(F.col(id_col), seed + 1))
    r = exact_rank(h, strata, "_h", id_col, out="_r")
    return r.select(*df.columns, F.pmod(F.col("_r") - 1, F.lit(n_folds)).cast("int").alias("fold"))


def ordered_rank(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """0-based position of each row in ``order`` over the whole table, and the
    row count as ``<out>_n``: rows are sorted by range, ranked inside their
    range, and the counts of the ranges before (one row per range) are added."""
    part = "_part"
    ranged = materialize(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    rows, total = [], 0
    for r in sorted(ranged.groupBy(part).count().collect()):  # one row per range
        rows.append((r[part], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(rows, f"{part} int, _off long")
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    ranked = ranged.withColumn("_r", inside).join(offsets, part)
    return ranked.select(
        *df.columns, (F.col("_off") + F.col("_r") - 1).alias(out), F.lit(total).cast("long").alias(out + "_n")
    )


def contiguous_folds(df: DataFrame, order: Sequence[str], n_folds: int = N_FOLDS) -> DataFrame:
    """Fold id 0..n_folds-1 of consecutive rows in ``order`` (the regressor's
    folds): sizes differ by one at most, the larger ones first."""
    r = ordered_rank(df, order, "_k")
    size, more = F.floor(F.col("_k_n") / n_folds), F.col("_k_n") % n_folds
    head = more * (size + 1)
    fold = F.when(F.col("_k") < head, F.floor(F.col("_k") / (size + 1))).otherwise(
        more + F.floor((F.col("_k") - head) / F.greatest(size, F.lit(1)))
    )
    return r.select(*df.columns, fold.cast("int").alias("fold"))


def validation_sample(df: DataFrame, id_col: str, n: int = 1000, seed: int = SPLIT_SEED) -> DataFrame:
    """A fixed sample of ``n`` rows: the smallest by hash (a top-k, each task
    keeps only its best ``n`` rows) instead of "the first n rows", which has
    no meaning on a distributed table."""
    return df.withColumn("_h", mult_hash(F.col(id_col), seed)).orderBy("_h", id_col).limit(n).drop("_h")


def label_codes(labels: DataFrame, col: str, out: str = "code") -> DataFrame:
    """(label, code): dense codes 0, 1, ... of the distinct labels in their
    order, read from the data.  NULL labels get no code.  The distinct labels
    are sorted and counted by range; no list of them goes through the driver."""
    distinct = labels.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
    return ordered_rank(distinct, [col], out).select(col, F.col(out).cast("int").alias(out))


def encode_labels(df: DataFrame, col: str, codes: DataFrame, out: str = "label") -> DataFrame:
    """``df`` with the code of its label from :func:`label_codes` (NULL: none)."""
    table = codes.select(F.col(col).alias("_label"), F.col("code").alias(out))
    return df.drop(out).join(table, F.col(col) == F.col("_label"), "left").drop("_label")
