"""Permutation importance as one distributed job.

Each test row is paired with a donor row (the row ``n // 2`` places further
in a hash order; the exact rank comes from the skew-safe
:func:`matchday.operators.split.exact_rank`).  ``explode(sequence(0, K-1))``
then makes K copies of every row, copy k carrying the donor's value of
feature k; one ``transform`` scores all copies and one aggregate gives the
accuracy per permuted feature.  Work is linear in rows x features.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.ml.boost import Booster, bytes_matrix, packed_bins
from matchday.operators.split import exact_rank, mult_hash


def with_donors(rows: DataFrame, columns: Sequence[str], id_col: str, seed: int) -> DataFrame:
    """``rows`` with, as ``_d_<column>``, the columns of the row half the
    table further on in the order of a hash of the id."""
    ranked = exact_rank(rows.withColumn("_h", mult_hash(F.col(id_col), seed)), [], "_h", id_col, out="_r")
    shift = F.greatest(F.floor(F.col("_r_n") / 2), F.lit(1))
    donor = ranked.select(
        (F.pmod(F.col("_r") - 1 + shift, F.col("_r_n")) + 1).alias("_r"),
        *[F.col(c).alias("_d_" + c) for c in columns],
    )
    return ranked.join(donor, "_r")


#: bytes of leaf values (one per row and tree) that a task holds at once
LEAF_BYTES = 16 << 20


def right_answers(m: Booster, x: np.ndarray, donor: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of right answers with each feature taken from ``donor``, and, last,
    with none.  Another value changes only trees that split on its feature, and
    only for rows whose donor has another bin: the values of all other leaves
    are kept, and added in the order of :meth:`Booster.margins`, so that the
    margins are the same to the last bit."""
    width = len(m.features)
    values = [[t.value[t.leaf_of(x)] for t in trees] for trees in m.trees]
    uses = [[np.bincount(t.feature[t.feature >= 0], minlength=width) > 0 for t in trees] for trees in m.trees]
    z = np.zeros((len(x), m.outputs))
    for row in values:
        for k, v in enumerate(row):
            z[:, k] += v
    right = z.argmax(axis=1) == y
    out = np.full(width + 1, int(right.sum()), np.int64)
    for i in range(width):
        classes = [k for k in range(m.outputs) if any(u[k][i] for u in uses)]
        moved = np.flatnonzero(x[:, i] != donor[:, i]) if classes else ()
        if not len(moved):
            continue
        xs, zs = x[moved], z[moved]
        xs[:, i] = donor[moved, i]
        for k in classes:
            zs[:, k] = 0
            for trees, u, v in zip(m.trees, uses, values, strict=True):
                zs[:, k] += trees[k].value[trees[k].leaf_of(xs)] if u[k][i] else v[k][moved]
        out[i] += int((zs.argmax(axis=1) == y[moved]).sum()) - int(right[moved].sum())
    return out


def booster_importance(model: Booster, test: DataFrame, id_col: str, label: str = "label", seed: int = 7) -> DataFrame:
    """:func:`permutation_importance` of a booster.  A row and its donor are
    one byte per feature each; a task puts the donor's byte in for one
    feature after the other and returns the number of right answers per
    feature, so no copy of a row leaves it."""
    feats, cuts = model.features, model.cuts
    rows = packed_bins(test.where(F.col(label).isNotNull()), feats, cuts, [F.col(id_col).alias(id_col), F.col(label).cast("double").alias("y")])
    paired = with_donors(rows, ["x"], id_col, seed).select("y", "x", "_d_x")
    shared = test.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m: Booster = shared.value
        width = len(m.features)
        step = max(1, LEAF_BYTES // (8 * max(1, len(m.trees) * m.outputs)))
        right, n = np.zeros(width + 1, np.int64), 0
        for batch in batches:
            x, donor = bytes_matrix(batch.column("x"), width), bytes_matrix(batch.column("_d_x"), width)
            y = batch.column("y").to_numpy()
            n += len(y)
            for a in range(0, len(y), step):
                right += right_answers(m, x[a : a + step], donor[a : a + step], y[a : a + step])
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width + 1, dtype=np.int32)), pa.array(right), pa.array(np.full(width + 1, n, np.int64))],
                names=["k", "right", "n"],
            )

    got = paired.mapInArrow(run, "k int, right long, n long").groupBy("k").agg((F.sum("right") / F.sum("n")).alias("acc"))
    rows = {r["k"]: r["acc"] for r in got.collect()}  # one row per feature and one for all
    base = rows.get(len(feats))
    out = [(c, base, rows.get(i), None if base is None else base - rows[i]) for i, c in enumerate(feats)]
    return test.sparkSession.createDataFrame(out, "feature string, base_accuracy double, permuted_accuracy double, importance double")


def permutation_importance(
    model: PipelineModel,
    test: DataFrame,
    feats: Sequence[str],
    id_col: str,
    label: str = "label",
    seed: int = 7,
) -> DataFrame:
    feats = list(feats)
    base = test.select(id_col, label, *feats)
    paired = with_donors(base, feats, id_col, seed)
    k = F.col("_k")
    copies = paired.select("*", F.explode(F.sequence(F.lit(-1), F.lit(len(feats) - 1))).alias("_k"))
    permuted = copies.select(
        id_col, label, "_k",
        *[F.when(k == i, F.col("_d_" + c)).otherwise(F.col(c)).alias(c) for i, c in enumerate(feats)],
    )
    scored = model.transform(permuted)
    acc = scored.groupBy("_k").agg(
        F.avg((F.col(label).cast("double") == F.col("prediction")).cast("double")).alias("acc")
    )
    # one row per feature (+1 for the unpermuted copy): bounded by the schema
    rows = {r["_k"]: r["acc"] for r in acc.collect()}
    base_acc = rows.get(-1)
    out = [
        (c, base_acc, rows.get(i), None if base_acc is None or rows.get(i) is None else base_acc - rows[i])
        for i, c in enumerate(feats)
    ]
    schema = "feature string, base_accuracy double, permuted_accuracy double, importance double"
    return test.sparkSession.createDataFrame(out, schema)
