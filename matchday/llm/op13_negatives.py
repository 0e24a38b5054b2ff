"""Operator 13, hard-negative mining by a secondary-sort shuffle.

Anchors meet all rows in blocks of integer vectors.  A pair's score goes into
a packed key (anchor, descending score, positive before negative, id, row)
whose bytes sort as the pairs should; the pairs are dealt by anchor and
sorted inside the partitions, and a streaming iterator opens a window for
each positive as it comes by, gives it the negatives that follow and closes
it: an anchor's pairs are never held together.

Before the shuffle, a block keeps of an anchor's pairs what any window can
take from it: its first positives, and per positive of the anchor its first
negatives inside the window.  Both are exact, since the first of all are
among the first of each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import keep, release

POSITIVES = 5
NEGATIVES = 5
#: a negative's score lies between LOW / 100 of the positive's and HIGH / 100 of it
LOW, HIGH = 80, 100
#: rows that a task scores at once
BLOCK = 16_384
#: anchors scored at once against a block
TILE = 256
#: bound of the anchors that are sent to all tasks at once
ANCHOR_BYTES = 32 << 20

_LONG = np.iinfo(np.int64)
_FLIP = np.uint64(1 << 63)


# ------------------------------------------------------------------ keys

#: anchor row 8, ~score 8, kind 1, null id 1, id 8, row 8
KEY_BYTES = 34


def pack_keys(anchor, score, negative, vec_id, no_id, row) -> np.ndarray:
    """Keys as an (n, KEY_BYTES) array of bytes; their order is (anchor, score
    descending, positives first, id ascending with nulls last, row)."""
    n = len(anchor)
    out = np.empty((n, KEY_BYTES), np.uint8)

    def big_endian(x: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(x).astype(">u8").view(np.uint8).reshape(n, 8)

    out[:, 0:8] = big_endian(np.asarray(anchor, np.int64).view(np.uint64) ^ _FLIP)
    out[:, 8:16] = big_endian(~(np.asarray(score, np.int64).view(np.uint64) ^ _FLIP))
    out[:, 16] = negative
    out[:, 17] = no_id
    out[:, 18:26] = big_endian(np.asarray(vec_id, np.int64).view(np.uint64) ^ _FLIP)
    out[:, 26:34] = big_endian(np.asarray(row, np.int64).view(np.uint64) ^ _FLIP)
    return out


def unpack_keys(raw: np.ndarray):
    """(anchor row, score, is negative, id, id is null, row) of packed keys."""

    def number(part: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(part).view(">u8").ravel().astype(np.uint64)

    anchor = (number(raw[:, 0:8]) ^ _FLIP).view(np.int64)
    score = (~number(raw[:, 8:16]) ^ _FLIP).view(np.int64)
    vec_id = (number(raw[:, 18:26]) ^ _FLIP).view(np.int64)
    row = (number(raw[:, 26:34]) ^ _FLIP).view(np.int64)
    return anchor, score, raw[:, 16] == 1, vec_id, raw[:, 17] == 1, row


def _key_array(keys: np.ndarray) -> pa.Array:
    n = len(keys)
    offsets = np.arange(n + 1, dtype=np.int32) * KEY_BYTES
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(keys))])


def _raw_keys(column: pa.Array) -> np.ndarray:
    n = len(column)
    if not n:
        return np.zeros((0, KEY_BYTES), np.uint8)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[first : first + n * KEY_BYTES].reshape(n, KEY_BYTES)


# ------------------------------------------------------------------ scores


class _Rows:
    """Rows of one vector length: row number, id, label and integer vectors."""

    def __init__(self, row, vec_id, no_id, label, vectors):
        self.row, self.vec_id, self.no_id, self.label, self.x = row, vec_id, no_id, label, vectors
        self.top = float(np.abs(vectors.astype(np.float64)).max()) if vectors.size else 0.0
        # order of ids, nulls last: ties of a score go by it
        self.rank = np.lexsort((row, vec_id, no_id)).argsort()


def _dots(a: np.ndarray, b: np.ndarray, top_a: float, top_b: float) -> np.ndarray:
    """Exact integer inner products: in double precision where no sum leaves
    53 bits, else in Python's integers (a result beyond 64 bits saturates)."""
    if top_a * top_b * max(1, a.shape[1]) < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, int(_LONG.min), int(_LONG.max)).astype(np.int64)


def _by_length(batches, size: int) -> Iterator[_Rows]:
    """Batches of (row, vec_id, label, v) as blocks of ``size`` rows of one
    vector length."""
    waiting: dict[int, list] = {}
    held: dict[int, int] = {}

    def block(d):
        parts = waiting.pop(d)
        held.pop(d)
        return _Rows(*[np.concatenate([p[i] for p in parts]) for i in range(5)])

    for batch in batches:
        v = batch.column("v")
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        lengths = v.value_lengths().to_numpy(zero_copy_only=False)
        offsets = v.offsets.to_numpy()
        values = v.values.to_numpy(zero_copy_only=False)
        ids = batch.column("vec_id")
        no_id = ids.is_null().to_numpy(zero_copy_only=False)
        vec_id = ids.fill_null(0).to_numpy()
        row, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
        for d in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == d)
            x = values[offsets[at][:, None] + np.arange(d)] if d else np.zeros((len(at), 0), np.int64)
            waiting.setdefault(d, []).append((row[at], vec_id[at], no_id[at], label[at], x))
            held[d] = held.get(d, 0) + len(at)
            if held[d] >= size:
                yield block(d)
    for d in list(waiting):
        yield block(d)


def _tiles(anchors: list[_Rows], rows: _Rows):
    """(anchors, first, scores) for tiles of the anchors of the rows' length."""
    for a in anchors:
        if a.x.shape[1] != rows.x.shape[1]:
            continue
        for start in range(0, len(a.row), TILE):
            yield a, start, _dots(a.x[start : start + TILE], rows.x, a.top, rows.top)


def _first(score: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` by descending score, then rank."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
        return some[np.lexsort((rank[some], ~score[some]))[:k]]
    return np.lexsort((rank, ~score))[:k]


def _keys(anchor: int, score, negative: int, rows: _Rows, at: np.ndarray) -> np.ndarray:
    n = len(at)
    return pack_keys(np.full(n, anchor, np.int64), score, negative, rows.vec_id[at], rows.no_id[at], rows.row[at])


def _positive_pairs(shared, size: int, k: int):
    """Per block and anchor the keys of the first ``k`` rows of its label."""

    def run(batches):
        anchors = shared.value
        for rows in _by_length(batches, size):
            found = []
            for a, start, scores in _tiles(anchors, rows):
                for i, s in enumerate(scores, start):
                    same = np.flatnonzero((rows.label == a.label[i]) & (rows.row != a.row[i]))
                    best = same[_first(s[same], rows.rank[same], k)]
                    if len(best):
                        found.append(_keys(int(a.row[i]), s[best], 0, rows, best))
            if found:
                yield pa.RecordBatch.from_arrays([_key_array(np.concatenate(found))], names=["key"])

    return run


def _negative_pairs(shared, windows, size: int, k: int, low: int, high: int):
    """Per block and anchor the keys of the first ``k`` rows of another label
    inside each of the anchor's windows, each row once."""

    def run(batches):
        anchors, scores_of = shared.value, windows.value
        for rows in _by_length(batches, size):
            found = []
            for a, start, scores in _tiles(anchors, rows):
                for i, s in enumerate(scores, start):
                    ranges = [(lo, hi) for lo, hi in (window(p, low, high) for p in scores_of.get(int(a.row[i]), ())) if lo <= hi]
                    if not ranges:
                        continue
                    inside = (s >= min(lo for lo, _ in ranges)) & (s <= max(hi for _, hi in ranges))
                    other = np.flatnonzero(inside & (rows.label != a.label[i]))
                    picked = [np.zeros(0, np.int64)]
                    for lo, hi in ranges:
                        here = other[(s[other] >= lo) & (s[other] <= hi)]
                        picked.append(here[_first(s[here], rows.rank[here], k)])
                    best = np.unique(np.concatenate(picked))
                    if len(best):
                        found.append(_keys(int(a.row[i]), s[best], 1, rows, best))
            if found:
                yield pa.RecordBatch.from_arrays([_key_array(np.concatenate(found))], names=["key"])

    return run


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score s with low * p <= 100 * s <= high * p."""
    lo, hi = -(-low * positive // 100), high * positive // 100
    return max(lo, int(_LONG.min)), min(hi, int(_LONG.max))


# ------------------------------------------------------------------ the streaming iterator

RESULT = "anchor_row long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _emit(n_positives: int, n_negatives: int, low: int, high: int):
    """Reads keys in order.  A positive opens a window (the first
    ``n_positives`` of an anchor do), a negative goes to each open window
    that takes its score, a window closes when full or when scores have sunk
    below it: at most ``n_positives`` windows are held."""

    def run(batches):
        anchor, seen, open_ = None, 0, []
        for batch in batches:
            columns = [x.tolist() for x in unpack_keys(_raw_keys(batch.column("key")))]
            out = []
            for a, score, negative, vec_id, no_id, _ in zip(*columns, strict=True):
                if a != anchor:
                    anchor, seen, open_ = a, 0, []
                vec_id = None if no_id else vec_id
                if not negative:
                    if seen < n_positives:
                        seen += 1
                        lo, hi = window(score, low, high)
                        open_.append([vec_id, score, lo, hi, 0])
                    continue
                open_ = [w for w in open_ if score >= w[2] and w[4] < n_negatives]
                for w in open_:
                    if score <= w[3]:
                        w[4] += 1
                        out.append((a, w[0], w[4], vec_id, w[1], score))
            if out:
                cols = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["anchor_row", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


# ------------------------------------------------------------------ the operator


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v) of the rows that take part: label and vector are
    there and every component is a finite number; v holds floor(256 * x)."""
    rows = df.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull() & good)
    return rows.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * 256).cast("long")).alias("v"))


def _chunks(anchors: DataFrame, bound: int) -> Iterator[list[_Rows]]:
    """The anchors in chunks of about ``bound`` bytes; the driver holds one."""
    part, size = [], 0
    for r in anchors.select("row", "vec_id", "label", "v").toLocalIterator(prefetchPartitions=False):
        part.append(r)
        size += 8 * len(r["v"]) + 32
        if size >= bound:
            yield _as_rows(part)
            part, size = [], 0
    if part:
        yield _as_rows(part)


def _as_rows(part: list) -> list[_Rows]:
    out = []
    for d in sorted({len(r["v"]) for r in part}):
        mine = [r for r in part if len(r["v"]) == d]
        out.append(_Rows(
            np.array([r["row"] for r in mine], np.int64),
            np.array([0 if r["vec_id"] is None else r["vec_id"] for r in mine], np.int64),
            np.array([r["vec_id"] is None for r in mine], bool), np.array([r["label"] for r in mine], np.int64),
            np.array([r["v"] for r in mine], np.int64).reshape(len(mine), d),
        ))
    return out


def hard_negatives(
    rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    block: int = BLOCK, anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """For each anchor (the rows for which the column ``is_anchor`` holds) and
    each of its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of another label whose score lies between ``low`` and
    ``high`` hundredths of the positive's: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and v (an array of whole numbers), as
    :func:`integer_vectors` gives.  A score is the integer inner product;
    higher ones come first, ties by smaller id (nulls last).  Repeated rows
    and rows of one id are rows of their own: each is an anchor, a positive
    or a negative by itself.  Vectors of different lengths don't meet.  An
    empty table, or one without anchors, gives no rows; a score beyond 64
    bits saturates.  Further columns are not looked at.
    """
    spark = rows.sparkSession
    numbered = keep(
        rows.select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"), F.col("v").cast("array<long>").alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        ).where("label is not null and v is not null"),
        "vectors",
    )
    base = numbered.select("row", "vec_id", "label", "v")
    out = None
    for anchors in _chunks(numbered.where("anchor"), anchor_bytes):
        shared = spark.sparkContext.broadcast(anchors)
        near = base.mapInArrow(_positive_pairs(shared, block, positives), "key binary")
        order = Window.partitionBy(F.substring("key", 1, 8)).orderBy("key")
        # at most `positives` rows per anchor of the chunk
        near = keep(near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).select("key"), "positives")
        at: dict[int, list[int]] = {}
        for batch in near.toArrow().to_batches():
            anchor, score, *_ = unpack_keys(_raw_keys(batch.column("key")))
            for a, s in zip(anchor.tolist(), score.tolist(), strict=True):
                at.setdefault(a, []).append(s)
        windows = spark.sparkContext.broadcast(at)
        far = base.mapInArrow(_negative_pairs(shared, windows, block, negatives, low, high), "key binary")
        pairs = near.union(far).repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")
        found = pairs.mapInArrow(_emit(positives, negatives, low, high), RESULT)
        ids = F.broadcast(_anchor_ids(spark, anchors))  # as many rows as the chunk has
        found = keep(found.join(ids, "anchor_row").select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        ), "negatives")
        release(near)
        shared.unpersist()
        windows.unpersist()
        out = found if out is None else out.union(found)
    release(numbered)
    if out is None:
        schema = RESULT.replace("anchor_row", "anchor_id")
        return spark.createDataFrame([], schema)
    return out


def _anchor_ids(spark, anchors: list[_Rows]) -> DataFrame:
    table = pa.table({
        "anchor_row": np.concatenate([a.row for a in anchors]),
        "anchor_id": pa.concat_arrays([pa.array(a.vec_id, pa.int64(), mask=a.no_id) for a in anchors]),
    })
    return spark.createDataFrame(table)


def mine_embeddings(embeddings: DataFrame, anchor_every: int = 100, move_every: int = 7, classes: int = 10) -> DataFrame:
    """:func:`hard_negatives` of a table (vec_id, embedding, label) whose
    anchors are the ids divisible by ``anchor_every``; the label of ids
    divisible by ``move_every`` first becomes the next of ``classes``."""
    moved = F.when(F.col("vec_id") % move_every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    rows = integer_vectors(embeddings.select("vec_id", "embedding", moved.alias("label")))
    return hard_negatives(rows, F.col("vec_id") % anchor_every == 0)
