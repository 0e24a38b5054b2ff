"""Helpers shared by the operators of this package.

* written intermediate tables in the shared checkpoint folder,
* exact running sums inside (possibly hot) groups without one task per group,
* views of Arrow text columns as numpy byte arrays, word hashes, shingles,
* connected components by alternating large-star / small-star steps.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchday.session import checkpoint_dir

# --------------------------------------------------------------- written tables

_WRITTEN: dict[str, SparkSession] = {}
_CLEAN_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: Spark removes them when
    the write ends, and not only when the driver collects garbage, which on a
    cluster it hardly needs to.  The tables are read back from their files, so
    nothing reads the shuffles again."""
    before = spark.conf.get(_CLEAN_CONF, None)
    spark.conf.set(_CLEAN_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_CONF)
        else:
            spark.conf.set(_CLEAN_CONF, before)


def keep(df: DataFrame, name: str = "table", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage is cut, a lost executor re-reads the files, later scans
    prune columns.  Its shuffles go with the write.  :func:`release` removes
    it; what is left goes when the driver ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _shuffles_go(spark):
        writer.parquet(path)
    _WRITTEN[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables written by :func:`keep` that nothing reads any more."""
    for t in tables:
        path = getattr(t, "kept_path", None)
        if path:
            _delete(path)


def _delete(path: str) -> None:
    spark = _WRITTEN.pop(path, None)
    if spark is None:
        return
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _delete_all() -> None:
    for path, spark in list(_WRITTEN.items()):
        if spark.sparkContext._jsc is not None:
            _delete(path)


# --------------------------------------------------------------- running sums

#: rows that one task orders at once in :func:`running_sum`
ROWS_PER_BUCKET = 100_000


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    key: Column,
    ties: Sequence[Column],
    sums: dict[str, Column],
    n_rows: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add, per entry of ``sums``, the exclusive running sum inside ``group``.

    Rows of a group are ordered by ``key`` (a uniformly distributed
    non-negative 31-bit integer, e.g. a hash) and then by ``ties``.  The key
    range is cut into equal buckets, so that a group holding a third of all
    rows is ordered by many tasks; the totals per (group, bucket) give every
    bucket its offset.  Rows that tie in everything are interchangeable.
    """
    buckets = max(1, -(-n_rows // rows_per_bucket))
    width = -(-(1 << 31) // buckets)
    group = list(group)
    rows = df.withColumn("_key", key).withColumn("_bucket", F.floor(F.col("_key") / width).cast("int"))
    at = [F.col(g) for g in group]
    totals = rows.groupBy(*group, "_bucket").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*at).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_bucket").alias("_b"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
    )
    # written: the planner knows its size, and does not shuffle the rows again if it is small
    offsets = keep(offsets, "offsets")
    inside = (
        Window.partitionBy(*at, "_bucket").orderBy("_key", *ties).rowsBetween(Window.unboundedPreceding, -1)
    )
    for n, c in sums.items():
        rows = rows.withColumn(f"_i_{n}", F.coalesce(F.sum(c).over(inside), F.lit(0)))
    on = [F.col("_bucket") == F.col("_b")] + [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    out = rows.join(offsets, on, "left")
    for n in sums:
        out = out.withColumn(n, F.col(f"_i_{n}") + F.col(f"_o_{n}"))
    return out.select(*[c for c in df.columns], *sums)


# --------------------------------------------------------------- Arrow text as bytes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without copying; a null
    has an empty range."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[at[0] : at[-1]]
    return raw, at - at[0]


def row_groups(column: pa.Array, size: int = 1 << 23) -> Iterator[pa.Array]:
    """Slices of whole rows of about ``size`` bytes (a longer row alone)."""
    _, offsets = text_bytes(column)
    start, n = 0, len(column)
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), n)
        yield column.slice(start, end - start)
        start = end


#: space, tab, newline, vertical tab, form feed, carriage return
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiply and shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, _BLOCK + 1)
_INV = _powers(_INVERSE, _BLOCK + 1)


def words_of(
    raw: np.ndarray, offsets: np.ndarray, lower: bool = True, separators: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash per word, word offsets per row).

    Words are maximal runs of bytes outside ``separators`` that do not cross
    a row; ``lower`` folds A-Z.  Bytes are processed in blocks of 1 MB cut at
    word or row borders (a longer single word gets a block of its own), so
    the working memory does not grow with a text.
    """
    n = len(raw)
    hashes: list[np.ndarray] = []
    starts_all: list[np.ndarray] = []
    gap = separators[raw]
    pos = 0
    borders = offsets[1:-1]
    while pos < n:
        end = min(n, pos + _BLOCK)
        if end < n:
            back = np.flatnonzero(gap[pos:end])
            cut = pos + int(back[-1]) + 1 if len(back) else pos
            row = int(np.searchsorted(borders, end, "right"))
            cut = max(cut, int(borders[row - 1]) if row else 0)
            if cut <= pos:  # one word of more than a block
                ahead = np.flatnonzero(gap[end:])
                cut = end + int(ahead[0]) if len(ahead) else n
                later = borders[np.searchsorted(borders, pos, "right") :]
                cut = min(cut, int(later[0])) if len(later) else cut
            end = cut
        size = end - pos
        block = raw[pos:end]
        solid = ~gap[pos:end]
        first = np.empty(size, bool)
        first[0] = True
        first[1:] = ~solid[:-1]
        lo, hi = np.searchsorted(offsets, pos, "left"), np.searchsorted(offsets, end, "left")
        cuts = offsets[lo:hi] - pos
        first[cuts] = True
        starts = np.flatnonzero(solid & first)
        last = np.empty(size, bool)
        last[-1] = True
        last[:-1] = ~solid[1:]
        inner = cuts[cuts > 0]
        last[inner - 1] = True
        ends = np.flatnonzero(solid & last) + 1
        power, inverse = (_POW, _INV) if size <= _BLOCK else (_powers(_BASE, size + 1), _powers(_INVERSE, size + 1))
        total = np.empty(size + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE_CODE[_LOWER[block] if lower else block] * power[:size], out=total[1:])
        hashes.append(mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
        starts_all.append(starts + pos)
        pos = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = np.concatenate(starts_all)
    return np.concatenate(hashes), np.searchsorted(starts, offsets, "left").astype(np.int64)


_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                                0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D)]


def shingle_sets(words: np.ndarray, rows: np.ndarray, q: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct 64-bit hashes of its ``q``-word shingles;
    a row with fewer words has its whole sequence as one, without words none."""
    mult = _MULT[:q]
    n = len(words)
    if n >= q:
        whole = words[: n - q + 1] * mult[0]
        for i in range(1, q):
            whole += words[i : n - q + 1 + i] * mult[i]
        whole = mix64(whole)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= q:
            yield np.unique(whole[a : b - q + 1])
        elif b > a:
            short = sum((words[a + i : a + i + 1] * mult[i] for i in range(b - a)), np.zeros(1, np.uint64))
            yield mix64(short + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.int64).view(np.uint64)


def hash31(*columns: Column) -> Column:
    """A uniformly distributed non-negative 31-bit integer of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 33)


def md5_31(text: Column) -> Column:
    """Like :func:`hash31`, from the MD5 of a string, which any SQL engine has."""
    return F.shiftright(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), 1)


#: rows of an Arrow batch: whole texts, so a tenth of Spark's default
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to BATCH_ROWS rows, unless it has a
    setting other than Spark's default: a batch of whole texts lies in memory
    several times on its way to a task's Python and back."""
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def document_columns(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns an operator reads, by fixed inner names, so that further
    columns of the input can have any name."""
    small_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(c) for c in more],
    )


# --------------------------------------------------------------- components


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) for all nodes of ``edges``; component is the
    smallest reachable node.

    Alternating large-star and small-star steps (Kiveris et al., 2014) until
    the edge set stays the same.  A hub of any degree is safe: its minimum is
    a partial aggregate, and the join back on it can be split by AQE.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct()
    now = keep(e, "edges")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        spread = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = keep(spread.union(low2.select("u", F.col("m").alias("v"))).distinct(), "edges")
        release(now)
        now = after
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (row["n"], row["s"]) == mark:
            break
        mark = (row["n"], row["s"])
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    return labels
