"""Operator 9, embedding near-dedup by int8 tile products.

Unit vectors are rounded to int8 codes with one scale per vector; the length
of what rounding left over is computed exactly per vector.  For two vectors
x = a + e, y = b + f (a, b decoded codes) the cosine differs from a.b by at
most |a||f| + |b||e| + |e||f|, so a tile product of the codes tells most
pairs apart for certain; only pairs that the bound leaves open are computed
again from the vectors in double precision.

Equal vectors are one class.  A cell of two blocks reports for each vector
how many vectors it links with, and the components inside the cell as at most
one edge per vector: never a row per linked pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import connected_components, keep, mix64, release

THRESHOLD = 0.9
#: vectors of a block; a cell holds two blocks, whatever the size of the table
BLOCK = 8192
#: rows of a tile of a cell
TILE = 1024
#: directions by which similar vectors get into the same blocks and tiles
DIRECTIONS = 64
#: for the rounding of the float32 tile product (codes and their products are whole numbers below 2^24)
SLACK = 4e-6


def _unit(values: pa.ListArray) -> tuple[np.ndarray, list]:
    """Which rows can link, and per row its unit vector in double precision."""
    out = []
    for x in values:
        v = None if x.values is None else np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64)
        if v is None or not len(v) or not np.isfinite(v).all():
            out.append(None)
            continue
        top = np.abs(v).max()
        if top == 0:
            out.append(None)
            continue
        v = v / top  # no overflow, no underflow to zero
        out.append(v / math.sqrt(float(v @ v)))
    return np.array([v is not None for v in out], bool), out


def _direction(v: np.ndarray, cache: dict) -> int:
    d = len(v)
    if d not in cache:
        x = mix64(np.arange(1, d * DIRECTIONS + 1, dtype=np.uint64)).astype(np.float64) / 2.0**64 - 0.5
        cache[d] = x.reshape(d, DIRECTIONS)
    p = v @ cache[d]
    best = int(np.abs(p).argmax())
    return 2 * best + int(p[best] < 0)


_PREPARED = "vec_id long, node long, place long, vector binary"


def _prepare(batches):
    cache: dict = {}
    for batch in batches:
        ok, units = _unit(batch.column("embedding"))
        nodes, places, blobs = [], [], []
        for v in units:
            if v is None:
                nodes.append(None)
                places.append(None)
                blobs.append(None)
                continue
            blob = v.tobytes()
            h = xxhash.xxh3_64_intdigest(blob)
            nodes.append(h - (1 << 64) if h >= 1 << 63 else h)
            places.append((_direction(v, cache) << 32) | (h >> 32))
            blobs.append(blob)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").cast(pa.int64()), pa.array(nodes, pa.int64()), pa.array(places, pa.int64()),
             pa.array(blobs, pa.binary())],
            names=["vec_id", "node", "place", "vector"],
        )


_CELL_ROW = "i int, j int, side int, node long, copies long, vector binary"


def _cells(cuts: list[int]):
    """Each vector once for every cell (i, j), i <= j, of its block."""
    n = len(cuts) + 1

    def run(batches):
        edges = np.array(cuts, np.int64)
        for batch in batches:
            block = np.searchsorted(edges, batch.column("place").to_numpy(), "right").astype(np.int32)
            for other in range(n):
                low, high = np.minimum(block, other), np.maximum(block, other)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low), pa.array(high), pa.array((block != low).astype(np.int32)), batch.column("node"),
                     batch.column("copies"), batch.column("vector")],
                    names=["i", "j", "side", "node", "copies", "vector"],
                )

    return run


class _Tile:
    """Up to TILE unit vectors of one length, their codes and error bounds."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray):
        self.rows, self.x = rows, vectors
        scale = np.abs(vectors).max(axis=1) / 127.0
        codes = np.rint(vectors / scale[:, None])
        decoded = codes * scale[:, None]
        self.codes = codes.astype(np.int8)
        self.scale = scale.astype(np.float32)
        self.error = np.sqrt(((vectors - decoded) ** 2).sum(axis=1))
        self.length = np.sqrt((decoded**2).sum(axis=1))
        centre = vectors.mean(axis=0)
        size = math.sqrt(float(centre @ centre))
        self.centre = centre / size if size > 1e-12 else None
        self.radius = math.pi if self.centre is None else math.acos(
            max(-1.0, min(1.0, float((vectors @ self.centre).min())))
        )


def _linked(a: _Tile, b: _Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of the pairs of cosine >= threshold."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if a.centre is not None and b.centre is not None:
        apart = math.acos(max(-1.0, min(1.0, float(a.centre @ b.centre)))) - a.radius - b.radius
        if apart > math.acos(threshold) + 1e-9:  # no pair of these tiles can be near enough
            return none
    near = (a.codes.astype(np.float32) @ b.codes.astype(np.float32).T) * a.scale[:, None] * b.scale[None, :]
    most = a.length.max() * b.error.max() + b.length.max() * a.error.max() + a.error.max() * b.error.max() + SLACK
    ii, jj = np.nonzero(near >= np.float32(threshold - most - SLACK))
    if not len(ii):
        return none
    value = near[ii, jj].astype(np.float64)
    bound = a.length[ii] * b.error[jj] + b.length[jj] * a.error[ii] + a.error[ii] * b.error[jj] + SLACK
    sure = value - bound >= threshold
    open_ = np.flatnonzero(~sure & (value + bound >= threshold))
    for k in range(0, len(open_), 65536):
        part = open_[k : k + 65536]
        sure[part] = np.einsum("ij,ij->i", a.x[ii[part]], b.x[jj[part]]) >= threshold
    return ii[sure], jj[sure]


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels (smallest position of a component) after linking x[k] with y[k]."""
    while True:
        a, b = label[x], label[y]
        open_ = a != b
        if not open_.any():
            return label
        x, y = x[open_], y[open_]
        a, b = a[open_], b[open_]
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
        label = to[label]
        while not np.array_equal(again := label[label], label):
            label = again


def _join_cell(threshold: float):
    def run(key, table):
        i, j = key[0].as_py(), key[1].as_py()
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        blobs = table.column("vector").to_pylist()
        order = np.lexsort((nodes, [len(x) for x in blobs], side))
        tiles: list[tuple[int, int, _Tile]] = []
        start = 0
        while start < len(order):
            first = order[start]
            end = start + 1
            while end < len(order) and end - start < TILE and side[order[end]] == side[first] and len(blobs[order[end]]) == len(blobs[first]):
                end += 1
            rows = order[start:end]
            tiles.append((int(side[first]), len(blobs[first]), _Tile(rows, np.stack([np.frombuffer(blobs[r], np.float64) for r in rows]))))
            start = end
        counts = np.zeros(len(nodes), np.int64)
        label = np.arange(len(nodes))
        for p, (s, d, a) in enumerate(tiles):
            for q, (t, e, b) in enumerate(tiles[p:], p):
                if d != e or (i != j and s == t):  # the blocks' own pairs belong to cells (i, i) and (j, j)
                    continue
                x, y = _linked(a, b, threshold)
                if p == q:
                    x, y = x[x < y], y[x < y]
                if not len(x):
                    continue
                x, y = a.rows[x], b.rows[y]
                np.add.at(counts, x, copies[y])
                np.add.at(counts, y, copies[x])
                label = _merge(label, x, y)
        some = np.flatnonzero(counts)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({
            "a": np.concatenate([nodes[some], nodes[moved]]),
            "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(nodes[label[moved]], pa.int64())]),
            "n": np.concatenate([counts[some], np.zeros(len(moved), np.int64)]),
        })

    return run


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """Per row of ``table`` vec_id, n_links, component_id and kept.

    Two rows link when the cosine of their vectors, in double precision, is
    at least ``threshold``; ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable by links and
    ``kept`` says that this is the row's own.

    Vectors that are null, empty or zero or hold null or non-finite
    components link with nothing, nor do vectors of different lengths.  Equal
    vectors (after scaling to unit length) are compared once.  Rows that
    repeat count as rows; a row with a null id has the component of the rows
    it links with and is kept only if none of them has an id.  An empty table
    gives no rows; further columns are not looked at.
    """
    base = table.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding")
    )
    rows = keep(base.mapInArrow(_prepare, _PREPARED), "vectors")
    classes = rows.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("place").alias("place"), F.first("vector").alias("vector")
    )
    classes = keep(classes, "classes")
    n = classes.count()
    blocks = max(1, -(-n // block))
    cuts: list[int] = []
    if blocks > 1:
        shares = [k / blocks for k in range(1, blocks)]
        cuts = sorted(classes.agg(F.percentile_approx("place", F.array(*map(F.lit, shares)), F.lit(max(10_000, 100 * blocks)))).first()[0])
    dealt = classes.select("place", "node", "copies", "vector").mapInArrow(_cells(cuts), _CELL_ROW)
    found = dealt.groupBy("i", "j").applyInArrow(_join_cell(threshold), "a long, b long, n long")
    found = keep(found, "links")
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    edges = found.where("b is not null")
    names = classes.select("node", "rep", "copies")
    if edges.limit(1).count():
        parts = keep(connected_components(edges, "a", "b"), "components")
        names = names.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    else:
        names = names.withColumn("component", F.col("node"))
    least = names.groupBy("component").agg(F.min("rep").alias("component_id"))
    names = names.join(least, "component").join(links, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    names = keep(names, "names")
    release(classes)
    out = rows.select("vec_id", "node").join(names, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
