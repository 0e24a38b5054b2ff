"""Second-order gradient boosting as Spark jobs: softmax over the classes or
squared loss, row weights, gain and L2 penalties, row and column sampling,
missing values with a learned side.

Features are binned once (quantile cuts from one aggregate) and kept as one
byte per feature.  A level of all trees of a round - every class, and every
model when several are fitted together - is one pass: tasks add up the
gradients per (model, class, node, feature, bin), the partial sums meet by
(model, class, node), the best split of each node comes back to the driver,
which holds nothing but trees.  Gradients are added as whole numbers of
2^-24, so the result does not depend on partitioning or lost tasks.  Margins
are recomputed from the trees since the last snapshot, which is written to
the shared checkpoint folder every few rounds.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.session import discard, materialize, written

MISSING = 255
UNIT = float(1 << 24)
#: rounds after which margins are written
SNAPSHOT = 8
#: bytes of partial sums that a task may hold at once
SUMS_BYTES = 64 << 20
#: bytes of the trees since the last snapshot that models grown together may have
TREE_BYTES = 64 << 20
#: bytes of binned rows that a search sends to every task, which grows whole models on them
WHOLE_BYTES = 32 << 20
BASE_SCORE = 0.5


@dataclass(frozen=True)
class BoostParams:
    """Defaults are the one grid point of the training job."""

    rounds: int = 1000
    depth: int = 7
    rate: float = 0.005
    gain: float = 0.1          # least loss reduction of a split
    l2: float = 0.1
    rows: float = 0.8          # share of rows per round
    columns: float = 0.8       # share of features per tree
    min_weight: float = 1.0    # least sum of second derivatives of a child
    seed: int = 1298


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i+1 and 2i+2."""

    feature: np.ndarray   # -1: a leaf
    cut: np.ndarray       # bins up to this one go left
    left: np.ndarray      # whether missing values go left
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << (depth + 1)) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.uint8), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Heap position that each row of bins reaches."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            b = x[rows, np.maximum(f, 0)]
            goes_left = np.where(b == MISSING, self.left[at], b <= self.cut[at])
            at = np.where(inner, 2 * at + np.where(goes_left, 1, 2), at)


@dataclass
class Booster:
    """A fitted model: ``trees[round][class]``."""

    features: list[str]
    cuts: list[list[float]]
    n_classes: int             # 0: squared loss
    params: BoostParams
    trees: list[list[Tree]] = field(default_factory=list)

    @property
    def outputs(self) -> int:
        return max(1, self.n_classes)

    def margins(self, x: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros((len(x), self.outputs))
        for trees in self.trees[first:]:
            for k, t in enumerate(trees):
                out[:, k] += t.value[t.leaf_of(x)]
        return out

    # ------------------------------------------------------------ applying

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` (class code or value) and, for classes,
        ``probability`` (an array that adds up to 1)."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        fields = list(df.schema.fields) + [T.StructField("prediction", T.DoubleType())]
        if self.n_classes:
            fields.append(T.StructField("probability", T.ArrayType(T.DoubleType())))

        def run(batches):
            m: Booster = shared.value
            for batch in batches:
                z = m.margins(bin_matrix(batch, m.features, m.cuts)) + BASE_SCORE
                arrays = [batch.column(i) for i in range(batch.num_columns)]
                if m.n_classes:
                    p = softmax(z)
                    arrays.append(pa.array(p.argmax(axis=1).astype(np.float64)))
                    offsets = pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1])
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(p.ravel())))
                else:
                    arrays.append(pa.array(z[:, 0]))
                names = [*batch.schema.names, "prediction", *(["probability"] if m.n_classes else [])]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        return df.mapInArrow(run, T.StructType(fields))

    def importance(self) -> list[tuple[str, float]]:
        """(feature, mean gain of its splits as a share of all features')."""
        total, n = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in (t for trees in self.trees for t in trees):
            some = t.feature >= 0
            np.add.at(total, t.feature[some], t.gain[some])
            np.add.at(n, t.feature[some], 1)
        mean = total / np.maximum(n, 1)
        share = mean / mean.sum() if mean.sum() > 0 else mean
        return sorted(zip(self.features, share.tolist(), strict=True), key=lambda e: (-e[1], e[0]))

    # ------------------------------------------------------------ keeping

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes as a Parquet table, the rest as one JSON line."""
        rows = [
            (r, k, int(i), int(t.feature[i]), int(t.cut[i]), bool(t.left[i]), float(t.value[i]), float(t.gain[i]))
            for r, trees in enumerate(self.trees) for k, t in enumerate(trees)
            for i in np.flatnonzero((t.feature >= 0) | (t.value != 0)).tolist()
        ]
        schema = "round int, output int, node int, feature int, cut int, missing_left boolean, value double, gain double"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = {
            "features": self.features, "cuts": self.cuts, "n_classes": self.n_classes, "params": asdict(self.params),
            "rounds": len(self.trees),
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        params = BoostParams(**meta["params"])
        out = cls(meta["features"], meta["cuts"], meta["n_classes"], params)
        out.trees = [[Tree.empty(params.depth) for _ in range(out.outputs)] for _ in range(meta["rounds"])]
        for r in spark.read.parquet(f"{path}/nodes").toLocalIterator():
            t, i = out.trees[r["round"]][r["output"]], r["node"]
            t.feature[i], t.cut[i], t.left[i], t.value[i], t.gain[i] = r["feature"], r["cut"], r["missing_left"], r["value"], r["gain"]
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    """Rows of probabilities; the greatest margin is subtracted first, so no
    exponential overflows."""
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


# ------------------------------------------------------------------ bins


def quantile_cuts(df: DataFrame, feats: Sequence[str], bins: int = 32) -> list[list[float]]:
    """Per feature at most ``bins`` - 1 increasing cuts, from one aggregate of
    mergeable sketches; a value goes to the bin of the number of cuts that are
    not above it.  The least value is no cut (nothing would be below it)."""
    if not 2 <= bins <= MISSING:
        raise ValueError("bins must be 2 to 255")
    shares = [i / bins for i in range(1, bins)]
    aggs = []
    for i, c in enumerate(feats):
        x = F.col(f"`{c}`").cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.percentile_approx(x, shares, 10_000).alias(f"q{i}"), F.min(x).alias(f"m{i}")]
    row = df.agg(*aggs).first()
    return [sorted({float(v) for v in row[f"q{i}"] or () if v > row[f"m{i}"]}) for i in range(len(feats))]


def bin_matrix(batch: pa.RecordBatch, feats: Sequence[str], cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """(rows, features) bins of a batch; NULL and NaN are MISSING."""
    out = np.empty((batch.num_rows, len(feats)), np.uint8)
    for j, (c, edges) in enumerate(zip(feats, cuts, strict=True)):
        v = batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
        b = np.searchsorted(np.asarray(edges, np.float64), v, "right").astype(np.uint8)
        b[np.isnan(v)] = MISSING
        out[:, j] = b
    return out


def binned(
    df: DataFrame, feats: Sequence[str], cuts: Sequence[Sequence[float]], label: str, weight: str | None, id_col: str,
    fold_col: str | None = None,
) -> DataFrame:
    """(row, fold, y, w, x): the rows with a label, x one byte per feature."""
    return packed_bins(df.where(F.col(label).isNotNull()), feats, cuts, [
        F.xxhash64(F.col(id_col)).alias("row"),
        (F.col(fold_col).cast("int") if fold_col else F.lit(-1)).alias("fold"),
        F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    ])


def packed_bins(df: DataFrame, feats: Sequence[str], cuts: Sequence[Sequence[float]], columns: Sequence[Column]) -> DataFrame:
    """``columns`` and x, the bins of the features, one byte each."""
    base = df.select(*columns, *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(feats)])
    names, edges = [f"_f{i}" for i in range(len(feats))], [list(c) for c in cuts]
    kept = base.columns[: len(columns)]

    def run(batches):
        for batch in batches:
            x = bin_matrix(batch, names, edges)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            blob = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], blob], names=[*kept, "x"])

    return base.mapInArrow(run, T.StructType([*base.select(*kept).schema.fields, T.StructField("x", T.BinaryType())]))


def bytes_matrix(column: pa.Array, width: int, kind=np.uint8) -> np.ndarray:
    """Rows of equal binary values as a matrix."""
    n = len(column)
    if not n or not width:
        return np.zeros((n, width), kind)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset]
    size = width * np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8)[at : at + n * size].view(kind).reshape(n, width)


# ------------------------------------------------------------------ fitting


@dataclass
class Fit:
    """One of the models fitted together: it sees the rows outside ``skip``."""

    params: BoostParams
    skip: int | None = None
    booster: Booster | None = None
    growing: list[Tree] = field(default_factory=list)
    active: list[list[int]] = field(default_factory=list)    # per class the nodes to split
    columns: list[np.ndarray] = field(default_factory=list)  # per class the sampled features
    done: bool = False

    def begin(self, n_features: int) -> None:
        r, p = len(self.booster.trees), self.params
        self.growing = [Tree.empty(p.depth) for _ in range(self.booster.outputs)]
        self.active = [[0] for _ in self.growing]
        self.columns = sampled_columns(p, r, len(self.growing), n_features)

    def finish(self) -> None:
        self.booster.trees.append(self.growing)
        self.growing, self.active = [], []
        self.done = len(self.booster.trees) >= self.params.rounds


def _gradients(z: np.ndarray, y: np.ndarray, w: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives per output, as whole numbers of 1 / UNIT."""
    if n_classes:
        p = softmax(z)
        g = p.copy()
        g[np.arange(len(y)), y.astype(np.int64)] -= 1
        h = np.maximum(2 * p * (1 - p), 1e-16)
    else:
        g, h = z - y[:, None], np.ones_like(z)
    return np.rint(g * w[:, None] * UNIT), np.rint(h * w[:, None] * UNIT)


def _sampled(row: np.ndarray, rate: float, seed: int, round_: int) -> np.ndarray:
    """Whether a row is in the round's sample, from a hash of its id."""
    if rate >= 1:
        return np.ones(len(row), bool)
    x = row.view(np.uint64) ^ np.uint64((seed * 1_000_003 + round_ * 7_919 + 1) & 0xFFFFFFFFFFFFFFFF)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) < rate


def sampled_columns(p: BoostParams, round_: int, outputs: int, n_features: int) -> list[np.ndarray]:
    """Per output the features that the round's tree may split on."""
    take = max(1, round(p.columns * n_features))
    if take >= n_features:
        return [np.arange(n_features)] * outputs
    seeds = [[p.seed & 0x7FFFFFFF, round_, k] for k in range(outputs)]
    return [np.sort(np.random.default_rng(s).choice(n_features, take, replace=False)) for s in seeds]


_SUMS = "model int, output int, node int, sums binary"


def _level_sums(shared):
    """Per task the gradient sums of the nodes to split."""

    def run(batches):
        fits, first, n_features, n_bins, jobs = shared.value  # jobs: (model, class, [nodes])
        held = {(i, k): np.zeros((len(nodes), len(fits[i].columns[k]), n_bins + 1, 2), np.int64) for i, k, nodes in jobs}
        by_model: dict[int, list] = {}
        for i, k, nodes in jobs:
            by_model.setdefault(i, []).append((k, nodes))
        width = sum(f.booster.outputs for f in fits)
        for batch in batches:
            x = bytes_matrix(batch.column("x"), n_features)
            base = bytes_matrix(batch.column("m"), width, np.float64)
            row, fold = batch.column("row").to_numpy(), batch.column("fold").to_numpy()
            y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
            at = 0
            for i, f in enumerate(fits):
                outputs = f.booster.outputs
                z, at = base[:, at : at + outputs], at + outputs
                if i not in by_model:
                    continue
                use = _sampled(row, f.params.rows, f.params.seed, len(f.booster.trees))
                if f.skip is not None:
                    use = use & (fold != f.skip)
                xs = x[use]
                if not len(xs):
                    continue
                z = z[use] + f.booster.margins(xs, first[i]) + BASE_SCORE
                g, h = _gradients(z, y[use], w[use], f.booster.n_classes)
                # one run of bins per feature, used by all classes; missing: the last bin
                bins = np.minimum(np.ascontiguousarray(xs.T), n_bins).astype(np.int64)
                for k, nodes in by_model[i]:
                    place = np.full(2 * max(nodes) + 3, len(nodes), np.int64)
                    place[nodes] = np.arange(len(nodes))
                    leaf = f.growing[k].leaf_of(xs)
                    # rows at no node to split go to a place behind the last
                    at_node = place[np.minimum(leaf, len(place) - 1)] * (n_bins + 1)
                    sums, gk, hk = held[i, k], np.ascontiguousarray(g[:, k]), np.ascontiguousarray(h[:, k])
                    size = (len(nodes) + 1) * (n_bins + 1)
                    for j, c in enumerate(f.columns[k]):
                        index = at_node + bins[c]
                        for s, d in enumerate((gk, hk)):
                            found = np.bincount(index, d, size).reshape(-1, n_bins + 1)[:-1]
                            sums[:, j, :, s] += found.astype(np.int64)
        out = [(i, k, n, held[i, k][j].tobytes()) for i, k, nodes in jobs for j, n in enumerate(nodes) if held[i, k][j].any()]
        for a in range(0, len(out), 256):
            cols = list(zip(*out[a : a + 256], strict=True))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int32()) for c in cols[:3]], pa.array(cols[3], pa.binary())], names=["model", "output", "node", "sums"]
            )

    return run


_BEST = "model int, output int, node int, feature int, cut int, missing_left boolean, gain double, gl double, hl double, g double, h double"


def best_split(sums: np.ndarray, l2: float, least: float):
    """(feature position, cut, missing left, gain, gl, hl, g, h) of a node's
    sums (features, bins + missing, 2); the first of equal gains, and no gain
    where no split leaves both children enough weight."""
    s = sums.astype(np.float64) / UNIT
    total = s[0].sum(axis=0)
    missing, s = s[:, -1], s[:, :-1]
    below = np.cumsum(s, axis=1)[:, :-1]
    g, h = total

    def score(gg, hh):
        return gg * gg / np.maximum(hh + l2, 1e-12)

    best = (0, 0, False, -math.inf, 0.0, 0.0, g, h)
    for left in (False, True):
        gl = below[..., 0] + (missing[:, None, 0] if left else 0)
        hl = below[..., 1] + (missing[:, None, 1] if left else 0)
        gain = 0.5 * (score(gl, hl) + score(g - gl, h - hl) - score(g, h))
        gain = np.where((hl >= least) & (h - hl >= least), gain, -math.inf)
        if gain.size and gain.max() > best[3]:
            f, b = np.unravel_index(int(gain.argmax()), gain.shape)
            best = (int(f), int(b), left, float(gain[f, b]), float(gl[f, b]), float(hl[f, b]), g, h)
    return best


def _best_splits(shared):
    """Sums sorted by (model, class, node) in, one best split per node out."""

    def run(batches):
        fits, n_bins = shared.value

        def done(key, sums):
            i, k, n = key
            f = fits[i]
            cols = f.columns[k]
            s = sums.reshape(len(cols), n_bins + 1, 2)
            pos, cut, left, gain, gl, hl, g, h = best_split(s, f.params.l2, f.params.min_weight)
            return i, k, n, int(cols[pos]), cut, left, gain, gl, hl, g, h

        now, held, out = None, None, []
        for batch in batches:
            for i, k, n, blob in zip(*[batch.column(j).to_pylist() for j in range(4)], strict=True):
                part = np.frombuffer(blob, np.int64)
                if (i, k, n) == now:
                    held += part
                    continue
                if now is not None:
                    out.append(done(now, held))
                now, held = (i, k, n), part.copy()
        if now is not None:
            out.append(done(now, held))
        if out:
            types = [pa.int32()] * 5 + [pa.bool_()] + [pa.float64()] * 5
            names = [c.split()[0] for c in _BEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return run


def _jobs(fits: list[Fit], n_bins: int, bound: int) -> Iterator[list[tuple[int, int, list[int]]]]:
    """Nodes to split in groups whose sums a task can hold."""
    group, size = [], 0
    for i, f in enumerate(fits):
        for k, nodes in enumerate(f.active):
            each = len(f.columns[k]) * (n_bins + 1) * 16
            step = max(1, bound // each)
            for a in range(0, len(nodes), step):
                part = nodes[a : a + step]
                if group and (size + each * len(part) > bound or any(g[:2] == (i, k) for g in group)):
                    yield group
                    group, size = [], 0
                group.append((i, k, part))
                size += each * len(part)
    if group:
        yield group


def _one_level(rows: DataFrame, fits: list[Fit], first: list[int], n_features: int, n_bins: int) -> None:
    spark = rows.sparkSession
    for group in list(_jobs(fits, n_bins, SUMS_BYTES)):
        light = _recent(fits, first)
        shared = spark.sparkContext.broadcast((light, first, n_features, n_bins, group))
        rules = spark.sparkContext.broadcast(([_rules(f) for f in fits], n_bins))
        sums = rows.mapInArrow(_level_sums(shared), _SUMS).repartition("model", "output", "node")
        best = sums.sortWithinPartitions("model", "output", "node").mapInArrow(_best_splits(rules), _BEST)
        for s in best.collect():  # one row per node
            f = fits[s["model"]]
            p, t, n = f.params, f.growing[s["output"]], s["node"]
            if n == 0:
                t.value[0] = -p.rate * s["g"] / (s["h"] + p.l2)
            if s["gain"] > p.gain:
                t.feature[n], t.cut[n], t.left[n], t.gain[n] = s["feature"], s["cut"], s["missing_left"], s["gain"]
                gl, hl = s["gl"], s["hl"]
                t.value[2 * n + 1] = -p.rate * gl / (hl + p.l2)
                t.value[2 * n + 2] = -p.rate * (s["g"] - gl) / (s["h"] - hl + p.l2)
                t.value[n] = 0.0
        shared.destroy()  # with the driver's file: a whole training has thousands of levels
        rules.destroy()


def _rules(f: Fit) -> Fit:
    """What the reducing side needs of a fit: parameters and columns."""
    return Fit(params=f.params, columns=f.columns)


def _recent(fits: list[Fit], first: list[int]) -> list[Fit]:
    """The fits without the trees that the written margins contain."""
    return [
        replace(f, booster=replace(f.booster, trees=[[]] * a + f.booster.trees[a:])) for f, a in zip(fits, first, strict=True)
    ]


def _snapshot(rows: DataFrame, fits: list[Fit], first: list[int], n_features: int) -> tuple[DataFrame, str]:
    """The rows with margins of all trees so far, written, and their folder."""
    shared = rows.sparkSession.sparkContext.broadcast((_recent(fits, first), first, n_features))

    def run(batches):
        fits_, first_, n = shared.value
        width = sum(f.booster.outputs for f in fits_)
        for batch in batches:
            x = bytes_matrix(batch.column("x"), n)
            m = bytes_matrix(batch.column("m"), width, np.float64).copy()
            at = 0
            for f, a in zip(fits_, first_, strict=True):
                m[:, at : at + f.booster.outputs] += f.booster.margins(x, a)
                at += f.booster.outputs
            offsets = np.arange(len(m) + 1, dtype=np.int32) * (8 * width)
            blob = pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(m))])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "fold", "y", "w", "x")], blob], names=["row", "fold", "y", "w", "x", "m"])

    out = written(rows.mapInArrow(run, "row long, fold int, y double, w double, x binary, m binary"))
    shared.destroy()
    return out


class Training:
    """Several models grown together on one table of :func:`binned` rows.
    ``keep``: whether the trees stay; the written margins contain them."""

    def __init__(
        self, rows: DataFrame, feats: Sequence[str], cuts: Sequence[Sequence[float]], n_classes: int, fits: list[Fit], keep: bool = True,
    ):
        self.feats, self.cuts, self.fits, self.keep = list(feats), [list(c) for c in cuts], fits, keep
        self.n_bins = max([len(c) for c in self.cuts], default=0) + 1
        for f in fits:
            f.booster = Booster(self.feats, self.cuts, n_classes, f.params)
        width = sum(f.booster.outputs for f in fits)
        zeros = F.lit(bytearray(8 * width))
        self.rows, self.path = written(rows.select("row", "fold", "y", "w", "x", zeros.alias("m")))
        self.first = [0] * len(fits)

    def round(self) -> None:
        """One more round for every model that wants one."""
        open_ = [f for f in self.fits if not f.done]
        for f in open_:
            f.begin(len(self.feats))
        for level in range(max(f.params.depth for f in open_)):
            for f in self.fits:
                if level and f.active:
                    split = [[n for n in nodes if t.feature[n] >= 0] for t, nodes in zip(f.growing, f.active, strict=True)]
                    deeper = level < f.params.depth
                    f.active = [[c for n in nodes for c in (2 * n + 1, 2 * n + 2)] if deeper else [] for nodes in split]
            if not any(nodes for f in open_ for nodes in f.active):
                break
            _one_level(self.rows, self.fits, self.first, len(self.feats), self.n_bins)
        for f in open_:
            f.finish()
        if max(len(f.booster.trees) - a for f, a in zip(self.fits, self.first, strict=True)) >= SNAPSHOT:
            old = self.path
            self.rows, self.path = _snapshot(self.rows, self.fits, self.first, len(self.feats))
            discard(self.rows.sparkSession, old)
            self.first = [len(f.booster.trees) for f in self.fits]
            if not self.keep:
                for f, a in zip(self.fits, self.first, strict=True):
                    f.booster.trees = [[]] * a

    def run(self, rounds: int | None = None) -> list[Booster]:
        """All rounds, or up to a number of them per model."""
        while any(not f.done and (rounds is None or len(f.booster.trees) < rounds) for f in self.fits):
            self.round()
        return [f.booster for f in self.fits]

    def only(self, some: list[int]) -> None:
        """Goes on with some of the models."""
        for i, f in enumerate(self.fits):
            f.done = f.done or i not in some

    def errors(self) -> list[tuple[int, int, float]]:
        """Per model of the rows it did not see: model, rows, sum of squared
        errors of the predicted code (or value) and number of right codes."""
        shared = self.rows.sparkSession.sparkContext.broadcast((_recent(self.fits, self.first), self.first, len(self.feats)))

        def run(batches):
            fits, first, n = shared.value
            width = sum(f.booster.outputs for f in fits)
            for batch in batches:
                x, m = bytes_matrix(batch.column("x"), n), bytes_matrix(batch.column("m"), width, np.float64)
                fold, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy()
                out, at = [], 0
                for i, f in enumerate(fits):
                    k = f.booster.outputs
                    seen = fold == f.skip if f.skip is not None else np.ones(len(y), bool)
                    z = m[seen, at : at + k] + f.booster.margins(x[seen], first[i]) + BASE_SCORE
                    at += k
                    p = z.argmax(axis=1) if f.booster.n_classes else z[:, 0]
                    out.append((i, int(seen.sum()), float(((p - y[seen]) ** 2).sum()), int((p == y[seen]).sum())))
                cols = list(zip(*out, strict=True))
                types = [pa.int32(), pa.int64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["model", "n", "sse", "right"])

        got = self.rows.mapInArrow(run, "model int, n long, sse double, right long")
        out = got.groupBy("model").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse"), F.sum("right").alias("right")).orderBy("model").collect()
        shared.destroy()
        return out


def fit_booster(
    train: DataFrame, feats: Sequence[str], label: str, weight: str | None, id_col: str, n_classes: int,
    params: BoostParams = BoostParams(), bins: int = 32,
) -> Booster:
    """One model on all rows of ``train`` that have a label (0..n_classes - 1;
    ``n_classes`` 0: squared loss on any number)."""
    cuts = quantile_cuts(train, feats, bins)
    rows = binned(train, feats, cuts, label, weight, id_col)
    return Training(rows, feats, cuts, n_classes, [Fit(params)]).run()[0]


def fit_folds(
    table: DataFrame, feats: Sequence[str], label: str, weight: str | None, id_col: str, n_classes: int, fold_col: str, folds: int,
    params: BoostParams = BoostParams(), bins: int = 32,
) -> tuple[list[Booster], list]:
    """The models that each leave one fold out, and their errors on it."""
    cuts = quantile_cuts(table, feats, bins)
    rows = binned(table, feats, cuts, label, weight, id_col, fold_col)
    t = Training(rows, feats, cuts, n_classes, [Fit(params, skip=i) for i in range(folds)])
    return t.run(), t.errors()


# ------------------------------------------------------------------ search


def random_draws(n: int, seed: int = 1298) -> list[BoostParams]:
    """Draws of the random search: rounds U{300..999}, depth U{4..12}, rate one
    of 0.01, 0.1, 0.5, least gain InvGamma(1.8), L2 LogNormal(0, 0.75), rows
    and columns 0.85."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append(BoostParams(
            rounds=rng.randint(300, 999), depth=rng.randint(4, 12), rate=rng.choice([0.01, 0.1, 0.5]),
            gain=1.0 / rng.gammavariate(1.8, 1.0), l2=rng.lognormvariate(0.0, 0.75), rows=0.85, columns=0.85, seed=seed + i,
        ))
    return out


def _whole_models(rows: DataFrame, cuts: Sequence[Sequence[float]], n_classes: int, fits: list[Fit]) -> list[dict]:
    """Errors as of :meth:`Training.errors`, a task per model: ``rows`` are few
    enough (``WHOLE_BYTES``) for each to hold them all."""
    from matchday.ml import grow

    spark = rows.sparkSession
    table = rows.select("row", "fold", "y", "w", "x").toArrow().combine_chunks()
    if not table.num_rows:
        return [{"n": 0, "sse": 0.0, "right": 0}] * len(fits)
    plain = [table.column(c).to_numpy() for c in ("row", "fold", "y", "w")]
    x = bytes_matrix(table.column("x").chunk(0), len(cuts))
    order = np.argsort(plain[0], kind="stable")
    # the longest first
    models = sorted(enumerate(fits), key=lambda e: -e[1].params.rounds * e[1].params.depth)
    models = [(i, f.params, f.skip) for i, f in models]
    shared = spark.sparkContext.broadcast(([c[order] for c in plain], x[order], cuts, models, n_classes, SNAPSHOT))

    def run(batches):
        columns, bins, cuts_, models_, classes, snapshot = shared.value
        held = grow.Rows(*columns, bins, cuts_)
        for batch in batches:
            for at in batch.column("id").to_pylist():
                i, p, skip = models_[at]
                z = grow.margins(held, p, skip, classes, snapshot)
                test = np.ones(len(z), bool) if skip is None else held.fold == skip
                z, y = z[test], held.y[test]
                got = z.argmax(axis=1) if classes else z[:, 0]
                out = [[i], [len(y)], [float(((got - y) ** 2).sum())], [int((got == y).sum())]]
                types = [pa.int32(), pa.int64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["model", "n", "sse", "right"]
                )

    got = spark.range(0, len(models), 1, len(models)).mapInArrow(run, "model int, n long, sse double, right long").collect()
    shared.destroy()
    return [r.asDict() for r in sorted(got)]


def _groups(fits: list[Fit], outputs: int) -> Iterator[list[Fit]]:
    """Models in groups whose trees since a snapshot the driver and a task can hold."""
    group, size = [], 0
    for f in fits:
        t = Tree.empty(f.params.depth)
        each = SNAPSHOT * outputs * sum(a.nbytes for a in (t.feature, t.cut, t.left, t.value, t.gain))
        if group and size + each > TREE_BYTES:
            yield group
            group, size = [], 0
        group.append(f)
        size += each
    if group:
        yield group


def search(
    table: DataFrame, feats: Sequence[str], label: str, weight: str | None, id_col: str, n_classes: int, fold_col: str, folds: int,
    draws: Sequence[BoostParams], rungs: Sequence[int] = (), bins: int = 32,
) -> DataFrame:
    """One row per (draw, fold): the parameters, the rounds that the draw ran,
    the held-out rows, the mean squared error of the class codes (the score of
    the search), accuracy, the draw's mean score and its rank.

    Every draw runs to its end.  Where a task can hold the binned rows, each
    model is one task; else models grow together, each level a pass over the
    rows.  Both give the same trees.  ``rungs`` are numbers of rounds after
    which the worse half of the draws stops (its last score stays); all models
    then grow together."""
    spark = table.sparkSession
    cuts = quantile_cuts(table, feats, bins)
    rows = materialize(binned(table, feats, cuts, label, weight, id_col, fold_col))
    fits = [Fit(p, skip=f) for p in draws for f in range(folds)]
    alive = list(range(len(draws)))

    def mean(errors, d):
        mine = [errors[d * folds + f] for f in range(folds)]
        mine = [e["sse"] / e["n"] for e in mine if e["n"]]
        return sum(mine) / len(mine) if mine else math.inf

    if rungs:
        t = Training(rows, feats, cuts, n_classes, fits, keep=False)
        for rung in sorted(rungs):
            if len(alive) <= 1:
                break
            t.run(rung)
            errors = t.errors()
            alive = sorted(alive, key=lambda d: (mean(errors, d), d))[: max(1, -(-len(alive) // 2))]
            t.only([d * folds + f for d in alive for f in range(folds)])
        t.run()
        errors, ran = t.errors(), [len(f.booster.trees) for f in fits]
    else:
        ran = [f.params.rounds for f in fits]
        if rows.count() * (len(feats) + 28) <= WHOLE_BYTES:  # bins, and four numbers
            errors = _whole_models(rows, cuts, n_classes, fits)
        else:
            errors = []
            for group in _groups(fits, max(1, n_classes)):
                t = Training(rows, feats, cuts, n_classes, group, keep=False)
                t.run()
                errors += t.errors()
                discard(spark, t.path)
    score = [mean(errors, d) for d in range(len(draws))]
    # draws that went on come first, whatever an early score was
    order = sorted(range(len(draws)), key=lambda d: (d not in alive, score[d], d))
    out = []
    for d, p in enumerate(draws):
        for f in range(folds):
            e = errors[d * folds + f]
            n = int(e["n"])
            out.append((
                d, f, ran[d * folds + f], p.depth, p.rate, p.gain, p.l2, p.rows, p.columns, n,
                float(e["sse"]) / n if n else None, int(e["right"]) / n if n else None, score[d] if n else None, order.index(d) + 1,
            ))
    schema = (
        "draw int, fold int, rounds int, depth int, rate double, gain double, l2 double, rows double, columns double, "
        "n_rows long, mse double, accuracy double, mean_mse double, rank int"
    )
    return spark.createDataFrame(out, schema)


def best_of(results: DataFrame, draws: Sequence[BoostParams]) -> BoostParams:
    """The parameters of rank 1."""
    return draws[results.where("rank = 1").first()["draw"]]


def shortened(draws: Sequence[BoostParams], share: float, depth: int) -> list[BoostParams]:
    """The draws with a share of their rounds and a bounded depth, for tests: no query runs them."""
    return [replace(p, rounds=max(1, round(p.rounds * share)), depth=min(p.depth, depth)) for p in draws]
