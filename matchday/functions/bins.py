"""Target binning (left-closed intervals labelled by their lower edge)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (must equal the reference for identical results) ---------
# Bin edges of the forward score target, left-closed; a value is labelled by
# the lower edge of its bin; values below the first or at/above the last
# edge get no bin.
BIN_EDGES = [-20.0, -2.5, -0.5, 0.0, 0.5, 2.5, 4.5, 20.0]
# Relative importance of each class, in ascending bin order.
CLASS_WEIGHTS = [5.0, 4.0, 3.0, 1.0, 3.0, 4.0, 5.0]
# ---------------------------------------------------------------------------


def bin_label(value: Column | str, edges: list[float] = BIN_EDGES) -> Column:
    """Lower edge of the left-closed bin holding ``value``; NULL outside.

    A ``when`` chain instead of ``Bucketizer``: the latter closes the last
    bin on the right and raises on out-of-range values.
    """
    v = F.col(value) if isinstance(value, str) else value
    branches = [(lo, hi) for lo, hi in zip(edges[:-1], edges[1:])]
    expr = None
    for lo, hi in branches:
        cond = (v >= F.lit(lo)) & (v < F.lit(hi))
        expr = F.when(cond, F.lit(lo)) if expr is None else expr.when(cond, F.lit(lo))
    return expr.cast("double")


def bin_table(
    spark: SparkSession,
    edges: list[float] = BIN_EDGES,
    weights: list[float] = CLASS_WEIGHTS,
) -> DataFrame:
    """Dimension table: one row per bin with code, bounds and class weight.

    ``code`` is the dense class index in ascending numeric order of the
    label (a ``StringIndexer`` would order ``-0.5, -2.5, -20`` lexically).
    Seven rows: safe to broadcast.
    """
    schema = T.StructType(
        [
            T.StructField("bin_label", T.DoubleType(), False),
            T.StructField("bin_upper", T.DoubleType(), False),
            T.StructField("code", T.IntegerType(), False),
            T.StructField("weight", T.DoubleType(), False),
        ]
    )
    rows = [
        (float(lo), float(hi), i, float(w))
        for i, (lo, hi, w) in enumerate(zip(edges[:-1], edges[1:], weights))
    ]
    return spark.createDataFrame(rows, schema)


def encode_label(label: Column, edges: list[float] = BIN_EDGES) -> Column:
    """Saved bin label (its lower edge) -> class code, NULL for any other value."""
    code = None
    for i, lo in enumerate(edges[:-1]):
        here = label.cast("double") == F.lit(float(lo))
        code = F.when(here, F.lit(i)) if code is None else code.when(here, F.lit(i))
    return code.cast("int")


def decode_bin(code: Column, edges: list[float] = BIN_EDGES) -> Column:
    """Class code -> its bin label (the lower edge)."""
    pairs = [F.lit(x) for i, lo in enumerate(edges[:-1]) for x in (i, float(lo))]
    return F.element_at(F.create_map(*pairs), code.cast("int"))


def decode_expected(code: Column, edges: list[float] = BIN_EDGES, centre: float = 6.0) -> Column:
    """Class code -> (bin label + centre), the expected mark of a class."""
    pairs = reduce(
        lambda acc, kv: acc + [F.lit(kv[0]), F.lit(kv[1])],
        enumerate(edges[:-1]),
        [],
    )
    return F.element_at(F.create_map(*pairs), code.cast("int")) + F.lit(centre)
